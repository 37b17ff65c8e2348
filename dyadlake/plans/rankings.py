"""Leaderboards, aggregates, windows and bins on the star tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scoring import capri, dockq
from ..operators import leaderboard, rel, stats
from .catalog import query


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _scored_orders(spark, d):
    customers = t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate").join(customers, "o_custkey")


_RANKED = """ranked AS (SELECT c_mktsegment, o_custkey, o_totalprice,
  row_number() OVER (PARTITION BY c_mktsegment, o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


@query(
    "leaderboard_topk_median",
    f"""WITH {_RANKED}, best AS (SELECT c_mktsegment, o_custkey,
  max(CASE WHEN rn <= 1 THEN o_totalprice END) AS top1, max(CASE WHEN rn <= 5 THEN o_totalprice END) AS top5
  FROM ranked WHERE rn <= 5 GROUP BY ALL)
SELECT c_mktsegment, count(*) AS n_systems, round(median(top1), 6) AS median_top1,
  round(avg(CASE WHEN top1 >= 200000 THEN 100.0 ELSE 0.0 END), 6) AS hit_top1,
  round(median(top5), 6) AS median_top5, round(avg(CASE WHEN top5 >= 200000 THEN 100.0 ELSE 0.0 END), 6) AS hit_top5
FROM best GROUP BY c_mktsegment""",
)
def leaderboard_topk_median(spark, d):
    return leaderboard.leaderboard(_scored_orders(spark, d), ["c_mktsegment"], "o_custkey", "o_totalprice", 200000, (1, 5), "o_orderdate", "o_orderkey")


@query(
    "leaderboard_wide_merge",
    f"""WITH {_RANKED}, sysmed AS (SELECT c_mktsegment, o_custkey, median(o_totalprice) AS m, max(o_totalprice) AS x FROM ranked GROUP BY ALL)
SELECT c_mktsegment, round(median(m), 6) AS median_of_medians, round(median(x), 6) AS median_of_best, max(x) AS best, count(*) AS n_systems FROM sysmed GROUP BY c_mktsegment""",
)
def leaderboard_wide_merge(spark, d):
    per = _scored_orders(spark, d).groupBy("c_mktsegment", "o_custkey").agg(F.median("o_totalprice").alias("m"), F.max("o_totalprice").alias("x"))
    blocks = [
        per.groupBy("c_mktsegment").agg(F.round(F.median("m"), 6).alias("median_of_medians")),
        per.groupBy("c_mktsegment").agg(F.round(F.median("x"), 6).alias("median_of_best"), F.max("x").alias("best"), F.count("*").alias("n_systems")),
    ]
    return rel.outer_fold("c_mktsegment", blocks)


@query("top_percentile_rows", "SELECT event_id, user_id, value FROM (SELECT *, quantile_cont(value, 0.25) OVER (PARTITION BY user_id) AS q FROM events) WHERE value <= q")
def top_percentile_rows(spark, d):
    return stats.within_quantile(t(spark, d, "events").select("event_id", "user_id", "value"), ["user_id"], "value", 0.25)


@query("system_oracle", "SELECT l_returnflag, l_linestatus, l_suppkey, max(l_quantity) AS l_quantity, max(l_extendedprice) AS l_extendedprice, min(l_discount) AS l_discount, min(l_tax) AS l_tax FROM lineitem GROUP BY ALL")
def system_oracle(spark, d):
    return stats.extremes(t(spark, d, "lineitem"), ["l_returnflag", "l_linestatus", "l_suppkey"], ["l_quantity", "l_extendedprice"], ["l_discount", "l_tax"])


@query("system_median", "SELECT l_suppkey, l_returnflag, round(median(l_extendedprice), 6) AS l_extendedprice, round(median(l_quantity), 6) AS l_quantity FROM lineitem GROUP BY ALL")
def system_median(spark, d):
    return stats.medians(t(spark, d, "lineitem"), ["l_suppkey", "l_returnflag"], ["l_extendedprice", "l_quantity"])


@query("method_median", "SELECT l_returnflag, l_linestatus, round(median(l_extendedprice), 6) AS l_extendedprice FROM lineitem GROUP BY ALL")
def method_median(spark, d):
    return stats.medians(t(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], ["l_extendedprice"])


@query(
    "median_oracle",
    "SELECT l_returnflag, round(median(b), 6) AS l_extendedprice FROM (SELECT l_returnflag, l_suppkey, max(l_extendedprice) AS b FROM lineitem GROUP BY ALL) GROUP BY l_returnflag",
)
def median_oracle(spark, d):
    return leaderboard.median_oracle(t(spark, d, "lineitem"), ["l_returnflag", "l_suppkey"], ["l_returnflag"], "l_extendedprice")


@query(
    "oracle_median_summary",
    """SELECT l_returnflag, round(median(l_extendedprice), 6) AS l_extendedprice,
  (SELECT round(avg(CASE WHEN l_discount >= 0.05 THEN 100.0 ELSE 0.0 END), 6) FROM lineitem) AS hit_rate FROM lineitem GROUP BY l_returnflag""",
)
def oracle_median_summary(spark, d):
    return leaderboard.summary(t(spark, d, "lineitem").select("l_returnflag", "l_extendedprice", "l_discount"), ["l_returnflag"], "l_extendedprice", F.col("l_discount") >= 0.05)


@query(
    "hit_rate_thresholds",
    "SELECT l_returnflag, l_linestatus, "
    + ", ".join(f"round(avg(CASE WHEN l_quantity >= {q} THEN 100.0 ELSE 0.0 END), 6) AS hit_{q}" for q in (5, 10, 20, 30, 40, 45))
    + " FROM lineitem GROUP BY ALL",
)
def hit_rate_thresholds(spark, d):
    return stats.hit_rates(t(spark, d, "lineitem"), ["l_returnflag", "l_linestatus"], {f"hit_{q}": F.col("l_quantity") >= q for q in (5, 10, 20, 30, 40, 45)})


@query(
    "categorical_hit_rate",
    """WITH r AS (SELECT o_orderpriority, o_orderstatus, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders),
u AS (SELECT *, k FROM r, (VALUES (1), (3), (5)) AS v(k) WHERE rn <= k)
SELECT o_orderpriority, o_orderstatus, k AS top_n, count(*) AS n, round(sum(CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END) / count(*), 6) AS rate FROM u GROUP BY ALL""",
)
def categorical_hit_rate(spark, d):
    w = rel.Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    ranked = t(spark, d, "orders").withColumn("rn", F.row_number().over(w)).where("rn <= 5")
    every = ranked.withColumn("top_n", F.explode(F.filter(F.array(*map(F.lit, (1, 3, 5))), lambda k: F.col("rn") <= k)))
    return every.groupBy("o_orderpriority", "o_orderstatus", "top_n").agg(F.count("*").alias("n"), F.round(F.sum(F.when(F.col("o_totalprice") > 250000, 1).otherwise(0)) / F.count("*"), 6).alias("rate"))


@query(
    "tercile_bins",
    """WITH q AS (SELECT quantile_cont(l_extendedprice, 1.0/3) AS a, quantile_cont(l_extendedprice, 2.0/3) AS b FROM lineitem)
SELECT CASE WHEN l_extendedprice <= a THEN 'low' WHEN l_extendedprice <= b THEN 'medium' ELSE 'high' END AS bin, count(*) AS n, min(l_extendedprice) AS low, max(l_extendedprice) AS high FROM lineitem, q GROUP BY ALL""",
)
def tercile_bins(spark, d):
    return stats.tercile_label(t(spark, d, "lineitem").select("l_extendedprice"), "l_extendedprice").groupBy("bin").agg(F.count("*").alias("n"), F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high"))


@query(
    "equal_width_bins",
    """WITH e AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem)
SELECT CAST(greatest(1, least(7, ceil((l_quantity - lo) * 7 / (hi - lo)))) AS INTEGER) AS bin, count(*) AS n FROM lineitem, e GROUP BY ALL""",
)
def equal_width_bins(spark, d):
    return stats.equal_width_bin(t(spark, d, "lineitem").select("l_quantity"), "l_quantity", 7).groupBy("bin").agg(F.count("*").alias("n"))


@query(
    "zscore_composite",
    """WITH p AS (SELECT l_suppkey, l_partkey, sum(l_quantity) AS q, avg(l_discount) AS s FROM lineitem GROUP BY ALL),
z AS (SELECT *, ((q - avg(q) OVER w) / (CASE WHEN stddev_pop(q) OVER w = 0 THEN 1 ELSE stddev_pop(q) OVER w END)
  - (s - avg(s) OVER w) / (CASE WHEN stddev_pop(s) OVER w = 0 THEN 1 ELSE stddev_pop(s) OVER w END)) / 2 AS score FROM p WINDOW w AS (PARTITION BY l_suppkey))
SELECT l_suppkey, l_partkey, round(score, 5) AS score FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY round(score, 9) DESC, l_partkey) AS rn FROM z) WHERE rn = 1""",
)
def zscore_composite(spark, d):
    per = t(spark, d, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("q"), F.avg("l_discount").alias("s"))
    scored = stats.zscore_mean(per, ["l_suppkey"], {"q": 1, "s": -1})
    return rel.keep_first(scored, ["l_suppkey"], [F.round("score", 9).desc(), "l_partkey"]).select("l_suppkey", "l_partkey", F.round("score", 5).alias("score"))


@query(
    "threshold_sweep_sr",
    """WITH k AS (SELECT range AS k FROM range(298))
SELECT round(0 + k * 2000.0, 6) AS threshold, (SELECT count(*) FROM orders WHERE o_totalprice <= k * 2000.0) AS n,
  round((SELECT sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) / count(*) FROM orders WHERE o_totalprice <= k * 2000.0), 6) AS rate FROM k""",
)
def threshold_sweep_sr(spark, d):
    return stats.threshold_sweep(t(spark, d, "orders"), "o_totalprice", F.col("o_orderstatus") == "F", 0.0, 2000.0, 298)


@query(
    "running_total_deleak",
    """WITH c AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY ALL), r AS (SELECT *, sum(n) OVER (ORDER BY n DESC, o_custkey ROWS UNBOUNDED PRECEDING) AS total FROM c)
SELECT o_custkey, n, CAST(total AS BIGINT) AS total FROM r WHERE total <= (SELECT count(*) * 0.2 FROM orders)""",
)
def running_total_deleak(spark, d):
    orders = t(spark, d, "orders")
    per = orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    limit = orders.agg((F.count("*") * 0.2).alias("limit"))
    return stats.running_total(per, [F.desc("n"), F.asc("o_custkey")], "n", "total").crossJoin(F.broadcast(limit)).where("total <= limit").drop("limit")  # one row


@query(
    "islands_gaps",
    """SELECT user_id, CAST(day AS INTEGER) AS start, CAST(nxt AS INTEGER) AS "end", CAST(nxt - day - 1 AS INTEGER) AS size FROM
(SELECT *, lead(day) OVER (PARTITION BY user_id ORDER BY day) AS nxt FROM (SELECT DISTINCT user_id, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS day FROM events)) WHERE nxt > day + 1""",
)
def islands_gaps(spark, d):
    from ..operators.structure import gaps

    days = t(spark, d, "events").select("user_id", F.unix_date(F.to_date("ts")).alias("day"))
    return gaps(days, ["user_id"], "day")


_POSES = "SELECT l_orderkey, l_linenumber, l_discount * 10 AS fnat, l_tax * 60 AS irms, l_quantity / 3 AS lrms FROM lineitem"


@query(
    "dockq_capri_expr",
    f"""SELECT l_orderkey, l_linenumber, round((fnat + 1 / (1 + (irms / 1.5) ** 2) + 1 / (1 + (lrms / 8.5) ** 2)) / 3, 6) AS dockq,
CASE WHEN fnat < 0.1 OR (lrms > 10 AND irms > 4) THEN 'Incorrect'
 WHEN (fnat >= 0.1 AND fnat < 0.3 AND (lrms <= 10 OR irms <= 4)) OR (fnat >= 0.3 AND lrms > 5 AND irms > 2) THEN 'Acceptable'
 WHEN (fnat >= 0.3 AND fnat < 0.5 AND (lrms <= 5 OR irms <= 2)) OR (fnat >= 0.5 AND lrms > 1 AND irms > 1) THEN 'Medium'
 WHEN fnat >= 0.5 AND (lrms <= 1 OR irms <= 1) THEN 'High' ELSE 'Undef' END AS capri FROM ({_POSES})""",
)
def dockq_capri_expr(spark, d):
    poses = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_discount") * 10).alias("fnat"), (F.col("l_tax") * 60).alias("irms"), (F.col("l_quantity") / 3).alias("lrms"))
    args = [F.col(c) for c in ("fnat", "irms", "lrms")]
    return poses.select("l_orderkey", "l_linenumber", F.round(dockq(*args), 6).alias("dockq"), capri(*args).alias("capri"))


@query("best_permutation", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS rn FROM lineitem) WHERE rn = 1")
def best_permutation(spark, d):
    return leaderboard.best_permutation(t(spark, d, "lineitem"), ["l_orderkey"], "l_extendedprice", ["l_linenumber"]).select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "sample_per_customer",
    None,
)
def sample_per_customer(spark, d):
    return stats.sample_per_group(t(spark, d, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], 3, "o_orderkey", seed=7)


@query("stratified_documents", None)
def stratified_documents(spark, d):
    return stats.stratified_sample(t(spark, d, "documents").select("doc_id", "n_chars"), ["n_chars"], 10, 100, "doc_id", seed=7)


@query(
    "deleaked_success_rate",
    """SELECT o_orderpriority, count(*) AS n, round(100 * sum(CASE WHEN o_totalprice >= 150000 THEN 1 ELSE 0 END) / count(*), 6) AS success_rate
FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) GROUP BY o_orderpriority""",
)
def deleaked_success_rate(spark, d):
    leaked = t(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return leaderboard.success_rate(t(spark, d, "orders"), ["o_orderpriority"], F.col("o_totalprice") >= 150000, leaked, "o_custkey")


@query("difficulty_shares", "SELECT l_returnflag, l_linestatus, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY l_returnflag), 6) AS percent FROM lineitem GROUP BY l_returnflag, l_linestatus")
def difficulty_shares(spark, d):
    per = t(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))
    total = F.sum("n").over(rel.Window.partitionBy("l_returnflag"))
    return per.withColumn("percent", F.round(100.0 * F.col("n") / total, 6))


@query(
    "two_level_spread",
    "SELECT l_suppkey, l_returnflag, round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS sd, count(*) AS n FROM lineitem GROUP BY ALL",
)
def two_level_spread(spark, d):
    return t(spark, d, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.round(F.avg("l_extendedprice"), 4).alias("mean"), F.round(F.stddev_samp("l_extendedprice"), 4).alias("sd"), F.count("*").alias("n"))
