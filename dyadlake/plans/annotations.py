"""Annotation and pairing operators on the star tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import annotate, pairing
from .catalog import query
from .rankings import t


@query("set_concat", "SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS o_orderpriority FROM orders GROUP BY o_custkey")
def set_concat(spark, d):
    return annotate.set_concat(t(spark, d, "orders"), ["o_custkey"], "o_orderpriority")


@query(
    "annotation_routes",
    """SELECT event_id, category FROM (SELECT event_id, unnest(CASE WHEN len(c) > 0 THEN c ELSE ['other'] END) AS category FROM (SELECT event_id,
list_filter([CASE WHEN event_type IN ('click', 'view') THEN 'web' END, CASE WHEN contains(event_type, 'c') THEN 'with_c' END], lambda x: x IS NOT NULL) AS c FROM events))""",
)
def annotation_routes(spark, d):
    return annotate.route_types(t(spark, d, "events"), "event_type", {"web": ["click", "view"]}, {"with_c": ["c"]}).select("event_id", "category")


@query(
    "cascade_match",
    """WITH l AS (SELECT n_nationkey, n_regionkey, CASE n_nationkey % 3 WHEN 0 THEN n_name WHEN 1 THEN lower(n_name) ELSE 'Zq' || n_name END AS chain FROM nation),
r AS (SELECT n_regionkey, n_name AS chain, n_nationkey AS hit FROM nation), w AS (SELECT n_regionkey, lower(chain) AS chain, arg_min(hit, chain) AS hit FROM r GROUP BY n_regionkey, lower(chain))
SELECT l.n_nationkey, coalesce(a.hit, b.hit, w.hit) AS hit, CASE WHEN a.hit IS NOT NULL THEN 0 WHEN b.hit IS NOT NULL THEN 1 WHEN w.hit IS NOT NULL THEN 2 END AS matched_by FROM l
LEFT JOIN r a ON a.n_regionkey = l.n_regionkey AND a.chain = l.chain LEFT JOIN r b ON b.n_regionkey = l.n_regionkey AND b.chain = left(l.chain, 1) LEFT JOIN w ON w.n_regionkey = l.n_regionkey AND w.chain = lower(l.chain)""",
)
def cascade_match(spark, d):
    n = t(spark, d, "nation")
    odd = F.when(F.col("n_nationkey") % 3 == 0, F.col("n_name")).when(F.col("n_nationkey") % 3 == 1, F.lower("n_name")).otherwise(F.concat(F.lit("Zq"), "n_name"))
    left = n.select("n_nationkey", "n_regionkey", odd.alias("chain"))
    right = n.select("n_regionkey", F.col("n_name").alias("chain"), F.col("n_nationkey").alias("hit"))
    return annotate.cascade_match(left, right, ["n_regionkey"], "chain", ["hit"]).select("n_nationkey", "hit", "matched_by")


@query(
    "domain_overlap",
    """WITH c AS (SELECT user_id, list_distinct(list(CAST(day(ts) AS INTEGER))) AS residues FROM events GROUP BY user_id), m AS (SELECT DISTINCT user_id, event_type AS name FROM events)
SELECT user_id, name, CAST(len(list_filter(residues, lambda r: r >= len(name) AND r <= len(name) + 6)) AS INTEGER) AS overlap FROM c JOIN m USING (user_id) WHERE len(list_filter(residues, lambda r: r >= len(name) AND r <= len(name) + 6)) >= 1""",
)
def domain_overlap(spark, d):
    events = t(spark, d, "events")
    chains = events.groupBy("user_id").agg(F.collect_set(F.dayofmonth("ts")).alias("residues"))
    domains = events.select("user_id", F.col("event_type").alias("name")).distinct().withColumns({"first": F.length("name"), "last": F.length("name") + 6})
    return annotate.domain_overlap(chains, domains, "user_id")


@query(
    "oligomer_state",
    """SELECT l_orderkey, count(*) AS n_chains, count(DISTINCT l_suppkey % 3) AS n_distinct, CASE WHEN count(*) = 1 THEN 'monomer' WHEN count(DISTINCT l_suppkey % 3) = 1 THEN 'homomer' ELSE 'heteromer' END AS state FROM lineitem GROUP BY l_orderkey""",
)
def oligomer_state(spark, d):
    return annotate.oligomer_state(t(spark, d, "lineitem").select("l_orderkey", (F.col("l_suppkey") % 3).alias("s")), "l_orderkey", "s")


@query(
    "most_frequent",
    "SELECT user_id, event_type FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS rn FROM events GROUP BY user_id, event_type) WHERE rn = 1",
)
def most_frequent(spark, d):
    return annotate.most_frequent(t(spark, d, "events"), ["user_id"], "event_type", "UNDEFINED")


@query(
    "neighbour_counts",
    """WITH n AS (SELECT l_suppkey AS k, count(*) AS c FROM lineitem GROUP BY l_suppkey)
SELECT l_orderkey, l_linenumber, coalesce(a.c, 0) AS seen_R, coalesce(b.c, 0) AS seen_L FROM lineitem LEFT JOIN n a ON l_partkey = a.k LEFT JOIN n b ON l_suppkey = b.k""",
)
def neighbour_counts(spark, d):
    lines = t(spark, d, "lineitem")
    seen = lines.select(F.col("l_suppkey").alias("k"))
    return annotate.neighbour_counts(lines, "l_partkey", "l_suppkey", seen, "k", "seen").select("l_orderkey", "l_linenumber", "seen_R", "seen_L")


@query(
    "present_flags",
    "SELECT o_orderkey, array_to_string(list_filter([CASE WHEN o_totalprice > 100000 THEN 'large' END, CASE WHEN o_orderstatus = 'F' THEN 'done' END, CASE WHEN o_custkey % 2 = 0 THEN 'even' END], lambda x: x IS NOT NULL), ';') AS flags FROM orders",
)
def present_flags(spark, d):
    flags = {"large": F.col("o_totalprice") > 100000, "done": F.col("o_orderstatus") == "F", "even": F.col("o_custkey") % 2 == 0}
    return t(spark, d, "orders").select("o_orderkey", F.array_join(annotate.present(flags), ";").alias("flags"))


_PAIRS = """SELECT c_custkey AS id, o_orderkey AS apo, o_totalprice FROM customer JOIN orders ON o_custkey = c_custkey"""


@query(
    "apo_canonical",
    f"""WITH p AS ({_PAIRS}), z AS (SELECT *, (o_totalprice - avg(o_totalprice) OVER w) / (CASE WHEN stddev_pop(o_totalprice) OVER w = 0 THEN 1 ELSE stddev_pop(o_totalprice) OVER w END) AS score FROM p WINDOW w AS (PARTITION BY id)),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(score, 9) DESC, apo) AS rn FROM z)
SELECT id, 'R' AS side, max(CASE WHEN rn = 1 THEN apo END) AS first, coalesce(string_agg(CAST(apo AS VARCHAR), ';' ORDER BY rn) FILTER (WHERE rn > 1), '') AS others FROM r GROUP BY id""",
)
def apo_canonical(spark, d):
    pairs = t(spark, d, "orders").select(F.col("o_custkey").alias("id"), F.lit("R").alias("side"), F.col("o_orderkey").alias("apo"), "o_totalprice")
    known = t(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    return pairing.canonical(pairing.scored(pairs.join(known, "id"), {"o_totalprice": 1}))


@query(
    "monomer_overlap",
    """WITH h AS (SELECT DISTINCT o_custkey AS cust, l_orderkey AS id, l_suppkey AS r FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
n AS (SELECT id, count(*) AS n FROM h GROUP BY id) SELECT h.id, a.id AS apo, count(*) AS shared, round(count(*) / max(n.n), 6) AS share FROM h JOIN h a ON h.cust = a.cust AND h.r = a.r AND h.id <> a.id JOIN n ON n.id = h.id GROUP BY h.id, a.id""",
)
def monomer_overlap(spark, d):
    lines = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_suppkey").alias("resi_uniprot"))
    orders = t(spark, d, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey")
    pairs = orders.join(orders.withColumnRenamed("id", "apo"), "o_custkey").where("id <> apo").select("id", "apo")
    return pairing.monomer_overlap(lines, lines, pairs).withColumn("share", F.round("share", 6))


@query("hourly_counts", "SELECT time_bucket(INTERVAL '1 hour', ts) AS start, time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS \"end\", event_type, count(*) AS n FROM events GROUP BY ALL")
def hourly_counts(spark, d):
    from ..streaming.incremental import windowed_counts

    out = windowed_counts(t(spark, d, "events"), "ts", ["event_type"])
    return out.withColumns({"start": F.col("start").cast("timestamp_ntz"), "end": F.col("end").cast("timestamp_ntz")})
