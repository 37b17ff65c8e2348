"""Joins, set algebra, annotation and text shapes on the star tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays, ids
from ..operators import leakage, rel, splits
from ..schema import coerce
from .catalog import query
from .rankings import t


@query(
    "role_join_nation",
    """SELECT l_orderkey, l_linenumber, cn.n_name AS n_name_c, sn.n_name AS n_name_s, cn.n_name = sn.n_name AS same FROM lineitem
JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey""",
)
def role_join_nation(spark, d):
    fact = (
        t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
        .join(t(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
        .join(t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
        .join(t(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey")
    )
    both = rel.role_join(fact, t(spark, d, "nation").select("n_nationkey", "n_name"), "n_nationkey", {"_c": "c_nationkey", "_s": "s_nationkey"})
    return both.select("l_orderkey", "l_linenumber", "n_name_c", "n_name_s", (F.col("n_name_c") == F.col("n_name_s")).alias("same"))


@query(
    "star_merge_inner",
    """SELECT r_name, n_name, c_mktsegment, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""",
)
def star_merge_inner(spark, d):
    joined = (
        t(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_totalprice")
        .join(t(spark, d, "customer"), "c_custkey")
        .join(t(spark, d, "nation").withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey")
        .join(t(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
    )
    return joined.groupBy("r_name", "n_name", "c_mktsegment").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query(
    "natural_left_chain",
    """SELECT p_partkey, p_brand, l_orderkey, l_linenumber, s_name FROM part LEFT JOIN lineitem ON p_partkey = l_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey""",
)
def natural_left_chain(spark, d):
    lines = t(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey"), "l_orderkey", "l_linenumber")
    parts = rel.natural_join(t(spark, d, "part").select("p_partkey", "p_brand"), lines, "left")
    return rel.natural_join(parts, t(spark, d, "supplier").select("s_suppkey", "s_name"), "left").drop("s_suppkey")


@query(
    "outer_fold",
    """SELECT coalesce(a.doc_id, b.doc_id, c.doc_id) AS doc_id, quality, n_chars, n_lines FROM labels a FULL JOIN (SELECT doc_id, n_chars FROM documents WHERE n_chars > 1000) b ON a.doc_id = b.doc_id
FULL JOIN (SELECT doc_id, len(string_split(text, chr(10))) AS n_lines FROM documents WHERE lang = 'en') c ON coalesce(a.doc_id, b.doc_id) = c.doc_id""",
)
def outer_fold(spark, d):
    docs = t(spark, d, "documents")
    frames = [t(spark, d, "labels").select("doc_id", "quality"), docs.where("n_chars > 1000").select("doc_id", "n_chars"), docs.where("lang = 'en'").select("doc_id", F.size(F.split("text", "\n")).cast("long").alias("n_lines"))]
    return rel.outer_fold("doc_id", frames)


@query(
    "two_pass_fallback_join",
    """SELECT s_suppkey, coalesce(a.n_name, b.n_name) AS n_name, CASE WHEN a.n_nationkey IS NOT NULL THEN 0 WHEN b.n_nationkey IS NOT NULL THEN 1 END AS matched_by
FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 12) a ON s_nationkey = a.n_nationkey LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 12) b ON s_nationkey - 12 = b.n_nationkey""",
)
def two_pass_fallback_join(spark, d):
    nations = t(spark, d, "nation").where("n_nationkey < 12")
    out = rel.fallback_join(t(spark, d, "supplier").select("s_suppkey", "s_nationkey"), nations, "n_nationkey", [F.col("s_nationkey"), F.col("s_nationkey") - 12], ["n_name"])
    return out.drop("s_nationkey")


@query("or_semi_join", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_partkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000) OR l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000)")
def or_semi_join(spark, d):
    lines = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return rel.or_semi_join(lines, ["l_partkey", "l_suppkey"], t(spark, d, "supplier").where("s_acctbal > 5000"), "s_suppkey")


@query("anti_pending", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_pending(spark, d):
    return rel.pending(t(spark, d, "documents").select("doc_id", "lang"), t(spark, d, "labels"), ["doc_id"])


@query(
    "completeness_penalty",
    """WITH a AS (SELECT user_id, event_type, max(value) AS value FROM events GROUP BY ALL), e AS (SELECT DISTINCT u.user_id, k.event_type FROM events u, (SELECT DISTINCT event_type FROM events) k)
SELECT e.user_id, e.event_type, coalesce(a.value, 0.0) AS value, a.user_id IS NULL AS penalised FROM e LEFT JOIN a USING (user_id, event_type)""",
)
def completeness_penalty(spark, d):
    events = t(spark, d, "events")
    actual = events.groupBy("user_id", "event_type").agg(F.max("value").alias("value"))
    kinds = events.select("event_type").distinct().agg(F.collect_set("event_type").alias("kinds"))
    expected = events.select("user_id").distinct().crossJoin(F.broadcast(kinds)).select("user_id", F.explode("kinds").alias("event_type"))  # one row
    return rel.complete(actual, expected, ["user_id", "event_type"], {"value": 0.0})


@query(
    "pair_key_dedup_best",
    """SELECT first, second, l_extendedprice FROM (SELECT least(l_partkey, l_suppkey) AS first, greatest(l_partkey, l_suppkey) AS second, l_extendedprice,
row_number() OVER (PARTITION BY least(l_partkey, l_suppkey), greatest(l_partkey, l_suppkey) ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rn FROM lineitem) WHERE rn = 1""",
)
def pair_key_dedup_best(spark, d):
    return rel.best_per_pair(t(spark, d, "lineitem"), "l_partkey", "l_suppkey", "l_extendedprice", ["l_orderkey", "l_linenumber"]).select("first", "second", "l_extendedprice")


@query(
    "ordered_concat_top",
    """WITH r AS (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey) AS rn, p_retailprice FROM part)
SELECT p_brand, max(CASE WHEN rn = 1 THEN p_partkey END) AS first, coalesce(string_agg(CAST(p_partkey AS VARCHAR), ';' ORDER BY rn) FILTER (WHERE rn > 1), '') AS others FROM r GROUP BY p_brand""",
)
def ordered_concat_top(spark, d):
    return rel.ordered_concat(t(spark, d, "part"), ["p_brand"], "p_partkey", ["p_retailprice", "p_partkey"])


@query(
    "pair_set_intersect",
    """WITH x AS (SELECT d.lang, d.source, l.quality FROM documents d JOIN labels l USING (doc_id)), p AS (SELECT least(lang, source) AS lo, greatest(lang, source) AS hi, quality FROM x)
SELECT DISTINCT lo, hi FROM p WHERE quality = 1 INTERSECT SELECT DISTINCT lo, hi FROM p WHERE quality = 0""",
)
def pair_set_intersect(spark, d):
    x = t(spark, d, "documents").join(t(spark, d, "labels"), "doc_id").select("lang", "source", "quality")
    return leakage.pair_intersection(x.where("quality = 1"), x.where("quality = 0"), "lang", "source")


@query(
    "pair_leak_report",
    """WITH x AS (SELECT least(d.lang, d.source) AS lo, greatest(d.lang, d.source) AS hi, l.quality FROM documents d JOIN labels l USING (doc_id)), k AS (SELECT lo, hi FROM x WHERE quality = 1 INTERSECT SELECT lo, hi FROM x WHERE quality = 0)
SELECT count(*) AS n_rows, count(k.lo) AS n_leaking, round(100.0 * count(k.lo) / count(*), 6) AS percent FROM (SELECT * FROM x WHERE quality = 0) y LEFT JOIN k ON y.lo = k.lo AND y.hi = k.hi""",
)
def pair_leak_report(spark, d):
    x = t(spark, d, "documents").join(t(spark, d, "labels"), "doc_id").select("lang", "source", "quality")
    return leakage.leak_report(x.where("quality = 0"), x.where("quality = 1"), "lang", "source")


@query(
    "unique_label_counts",
    """WITH k AS (SELECT DISTINCT l_partkey AS label FROM lineitem WHERE l_returnflag = 'A')
SELECT CAST((a.label IS NULL)::INT + (b.label IS NULL)::INT AS INTEGER) AS n_unique, count(*) AS n_rows FROM (SELECT * FROM lineitem WHERE l_returnflag = 'N') LEFT JOIN k a ON l_partkey = a.label LEFT JOIN k b ON l_suppkey = b.label GROUP BY ALL""",
)
def unique_label_counts(spark, d):
    lines = t(spark, d, "lineitem")
    return leakage.unique_label_counts(lines.where("l_returnflag = 'N'"), lines.where("l_returnflag = 'A'").select(F.col("l_partkey").alias("label")), "l_partkey", "l_suppkey")


@query(
    "diversity_ratio",
    """WITH x AS (SELECT o_orderpriority AS grp, c_nationkey, s_nationkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey),
y AS (SELECT grp, c_nationkey AS label FROM x UNION SELECT grp, s_nationkey FROM x)
SELECT grp, count(*) AS n_labels, (SELECT count(DISTINCT label) FROM y) AS n_all, round(100.0 * count(*) / (SELECT count(DISTINCT label) FROM y), 6) AS percent FROM y GROUP BY grp""",
)
def diversity_ratio(spark, d):
    x = (
        t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("s_suppkey"))
        .join(t(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_orderpriority"), "o_orderkey")
        .join(t(spark, d, "customer").select("c_custkey", "c_nationkey"), "c_custkey")
        .join(t(spark, d, "supplier").select("s_suppkey", "s_nationkey"), "s_suppkey")
    )
    return leakage.diversity(x, F.col("o_orderpriority"), ["c_nationkey", "s_nationkey"])


@query(
    "interval_coverage",
    """WITH x AS (SELECT user_id, list_distinct(list(CAST(day(ts) AS INTEGER))) AS days FROM events GROUP BY user_id)
SELECT user_id, round(len(list_filter(days, lambda v: v >= 5 AND v <= 15)) / len(days), 6) AS closed_share, round(len(list_filter(days, lambda v: v >= 5 AND v < 15)) / len(days), 6) AS open_share FROM x""",
)
def interval_coverage(spark, d):
    x = t(spark, d, "events").groupBy("user_id").agg(F.collect_set(F.dayofmonth("ts")).alias("days"))
    share = lambda closed: F.round(arrays.coverage(F.col("days"), F.lit(5), F.lit(15), closed), 6)
    return x.select("user_id", share(True).alias("closed_share"), share(False).alias("open_share"))


@query(
    "longest_overlap_label",
    """WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS rn FROM c)
SELECT user_id, CASE WHEN n >= 3 THEN event_type END AS label FROM r WHERE rn = 1""",
)
def longest_overlap_label(spark, d):
    counts = t(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    lists = counts.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_type", "n"))).alias("x"))
    return lists.select("user_id", arrays.longest_label(F.transform("x", lambda e: e["event_type"]), F.transform("x", lambda e: e["n"]), 3).alias("label"))


@query(
    "explode_zip_pad",
    """WITH x AS (SELECT doc_id, string_split(source || '|' || lang || '|NA', '|') AS a, string_split(lang || '|' || source, '|') AS b FROM documents)
SELECT doc_id, CAST(pos AS INTEGER) AS pos, nullif(a[pos + 1], 'NA') AS a, nullif(coalesce(b[pos + 1], b[1]), 'NA') AS b FROM x, (VALUES (0), (1), (2)) AS v(pos)""",
)
def explode_zip_pad(spark, d):
    x = t(spark, d, "documents").select("doc_id", F.concat_ws("|", "source", "lang", F.lit("NA")).alias("a"), F.concat_ws("|", "lang", "source").alias("b"))
    return rel.explode_padded(x, ["doc_id"], ["a", "b"], "|")


@query("unpivot_sides", "SELECT l_orderkey, l_linenumber, 'part' AS side, l_partkey AS key, l_quantity AS amount FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, 'supplier', l_suppkey, l_extendedprice FROM lineitem")
def unpivot_sides(spark, d):
    sides = {"part": {"key": "l_partkey", "amount": "l_quantity"}, "supplier": {"key": "l_suppkey", "amount": "l_extendedprice"}}
    return rel.unpivot_sides(t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], sides)


@query("json_flatten", "SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k FROM events")
def json_flatten(spark, d):
    from ..sources.tables import flatten

    parsed = t(spark, d, "events").select("event_id", "event_type", F.from_json("props", "k bigint").alias("props"))
    return flatten(parsed)


@query(
    "id_parse",
    """WITH x AS (SELECT l_orderkey, l_linenumber, lpad(CAST(l_linenumber AS VARCHAR), 4, 'e') || '__' || l_returnflag || l_linenumber || '_P' || l_partkey || CASE WHEN l_linenumber % 2 = 0 THEN '-R' ELSE '-L' END AS id FROM lineitem)
SELECT l_orderkey, l_linenumber, regexp_extract(id, '^(.*)__', 1) AS source, regexp_extract(id, '__([^_]*)_', 1) AS chain, regexp_extract(id, '_(P[0-9]+)-', 1) AS uniprot, right(id, 1) AS side,
regexp_replace(regexp_extract(id, '^(.*)__', 1) || '_' || regexp_extract(id, '__([^_]*)_', 1), '[0-9]+$', '') AS asym FROM x""",
)
def id_parse(spark, d):
    made = F.concat(F.lpad(F.col("l_linenumber").cast("string"), 4, "e"), F.lit("__"), "l_returnflag", "l_linenumber", F.lit("_P"), "l_partkey", F.when(F.col("l_linenumber") % 2 == 0, "-R").otherwise("-L"))
    x = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", made.alias("id")).withColumn("m", ids.parse_monomer("id"))
    return x.select("l_orderkey", "l_linenumber", "m.source", "m.chain", "m.uniprot", "m.side", ids.asym_key("id").alias("asym"))


@query("natural_sort_key", "SELECT c_custkey, 'customer#' || lpad(CAST(len(x) AS VARCHAR), 10, '0') || x AS sort_key FROM (SELECT c_custkey, CAST(CAST(regexp_extract(c_name, '([0-9]+)$', 1) AS BIGINT) AS VARCHAR) AS x FROM customer)")
def natural_sort_key(spark, d):
    return t(spark, d, "customer").select("c_custkey", ids.natural_key("c_name").alias("sort_key"))


@query("schema_coerce", "SELECT CAST(c_custkey AS INTEGER) AS c_custkey, coalesce(CASE WHEN c_acctbal > 0 THEN c_name END, '') AS c_name, coalesce(CASE WHEN c_acctbal > 1000 THEN c_acctbal END, 0.0) AS c_acctbal, false AS checked FROM customer")
def schema_coerce(spark, d):
    holes = t(spark, d, "customer").select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("c_name"), F.when(F.col("c_acctbal") > 1000, F.col("c_acctbal").cast("string")).otherwise(F.lit("n/a")).alias("balance"))
    return coerce(holes, {"c_custkey": "int", "c_name": "string", "c_acctbal": "double", "checked": "boolean"}, renames={"balance": "c_acctbal"})


@query(
    "split_representatives",
    """SELECT doc_id, source, n_chars, rn <= 1 AS representative FROM (SELECT doc_id, source, n_chars, row_number() OVER (PARTITION BY source ORDER BY quality DESC, toxic, n_chars DESC, doc_id) AS rn
FROM documents JOIN labels USING (doc_id)) WHERE rn <= 3""",
)
def split_representatives(spark, d):
    x = t(spark, d, "documents").select("doc_id", "source", "n_chars").join(t(spark, d, "labels"), "doc_id")
    order = ["-quality", "toxic", "-n_chars", "doc_id"]
    top = splits.top_per_cluster(x, "source", order, 3)
    first = splits.top_per_cluster(top, "source", order, 1).select("doc_id", F.lit(True).alias("representative"))
    return top.join(first, "doc_id", "left").select("doc_id", "source", "n_chars", F.coalesce("representative", F.lit(False)).alias("representative"))


_SPLIT = "CASE WHEN toxic = 1 THEN 'test' WHEN quality = 0 THEN 'val' ELSE 'train' END"


@query(
    "final_split_order",
    f"""WITH x AS (SELECT doc_id, source, {_SPLIT} AS split FROM documents JOIN labels USING (doc_id)), l AS (SELECT DISTINCT a.doc_id FROM x a JOIN x b ON a.source = b.source AND b.split = 'test' AND a.doc_id % 5 = b.doc_id % 5)
SELECT doc_id, source, CASE WHEN split = 'train' AND doc_id IN (SELECT doc_id FROM l) THEN 'invalid' ELSE split END AS split FROM x""",
)
def final_split_order(spark, d):
    x = t(spark, d, "documents").join(t(spark, d, "labels"), "doc_id").select("doc_id", "source", F.expr(_SPLIT).alias("split"))
    test = x.where("split = 'test'").select("source", (F.col("doc_id") % 5).alias("k")).distinct()
    leaks = x.withColumn("k", F.col("doc_id") % 5).join(test, ["source", "k"], "left_semi").select(F.col("doc_id").alias("leaked"))
    return splits.final_order(splits.deleak(x, leaks, "doc_id"), ["doc_id"])


@query(
    "cluster_names",
    "SELECT l_orderkey, l_linenumber, 'cluster_' || least(l_partkey % 7, l_suppkey % 7) || '_' || greatest(l_partkey % 7, l_suppkey % 7) AS cluster_id, CASE WHEN l_quantity >= 25 THEN CAST(l_partkey % 7 AS VARCHAR) ELSE 'p' END AS peptide FROM lineitem",
)
def cluster_names(spark, d):
    a, b = F.col("l_partkey") % 7, F.col("l_suppkey") % 7
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", splits.cluster_name(a, b).alias("cluster_id"), splits.peptide_cluster(a, F.col("l_quantity"), 25).alias("peptide"))


@query(
    "doc_benchmark_leak",
    r"""WITH w AS (SELECT doc_id AS k, 0 AS kind, regexp_extract_all(lower(text), '([^\s]+)') AS x FROM documents UNION ALL SELECT item_id, 1, regexp_extract_all(lower(text), '([^\s]+)') FROM benchmark),
g AS (SELECT DISTINCT k, kind, array_to_string(x[i:i+7], ' ') AS window FROM (SELECT k, kind, x, unnest(range(1, greatest(2, len(x) - 6))) AS i FROM w))
SELECT a.k AS doc_id, b.k AS item_id, count(*) AS n_shared FROM g a JOIN g b ON a.window = b.window AND a.kind = 0 AND b.kind = 1 GROUP BY ALL""",
)
def doc_benchmark_leak(spark, d):
    return leakage.shared_windows(t(spark, d, "documents").select("doc_id", "text"), t(spark, d, "benchmark").select("item_id", "text"), "doc_id", "item_id", "text", 8)


@query(
    "metadata_upsert",
    "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer",
)
def metadata_upsert(spark, d):
    base = t(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    patch = base.where("c_acctbal < 0").select("c_custkey", F.lit(0.0).alias("c_acctbal"))
    return rel.upsert(base, patch, "c_custkey", ["c_acctbal"])


@query("loader_free_text", "SELECT o_orderkey, o_totalprice FROM orders WHERE (o_totalprice > 100000 AND o_orderstatus = 'F') OR NOT (o_orderpriority IN ('1-URGENT', '2-HIGH')) AND o_orderstatus <> 'O'")
def loader_free_text(spark, d):
    from ..operators.loader import free_text

    rows = t(spark, d, "orders").where(free_text("(o_totalprice > 100000 & o_orderstatus == 'F') | ~(o_orderpriority in ['1-URGENT', \"2-HIGH\"]) & o_orderstatus != 'O'"))
    return rows.select("o_orderkey", "o_totalprice")
