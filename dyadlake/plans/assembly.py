"""Boards in full, split assembly, batches and catalogue entries on the star tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import batches, entries, leaderboard, transitive
from ..operators.tables import stored
from .catalog import query
from .graphs import _BOTH, _EDGES, edges
from .rankings import t

_METRICS = """m AS (SELECT l_returnflag, l_linestatus, l_suppkey, l_orderkey, l_linenumber, l_discount * 100 AS irms, l_tax * 100 AS lrms, l_quantity / 50 AS fnat, l_extendedprice / 100000 AS dockq,
  CASE WHEN l_quantity >= 45 THEN 3 WHEN l_quantity >= 30 THEN 2 WHEN l_quantity >= 15 THEN 1 ELSE 0 END AS capri_rank FROM lineitem)"""


def _metrics(spark, d):
    rank = F.when(F.col("l_quantity") >= 45, 3).when(F.col("l_quantity") >= 30, 2).when(F.col("l_quantity") >= 15, 1).otherwise(0)
    return t(spark, d, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_suppkey", "l_orderkey", "l_linenumber",
        (F.col("l_discount") * 100).alias("irms"), (F.col("l_tax") * 100).alias("lrms"), (F.col("l_quantity") / 50).alias("fnat"), (F.col("l_extendedprice") / 100000).alias("dockq"), rank.alias("capri_rank"),
    )


def _board_sql() -> str:
    masks = {"top1": "p <= 1", "top5": "p <= 5", "first25": "l_orderkey <= q25", "first50": "l_orderkey <= q50", "oracle": "true"}
    best = {"irms": "min", "lrms": "min", "fnat": "max", "dockq": "max", "capri_rank": "max"}
    hits = {"irms_2a": "irms_{} <= 2", "lrms_5a": "lrms_{} <= 5", "fnat_08": "fnat_{} >= 0.8", "acceptable": "capri_rank_{} >= 1", "medium": "capri_rank_{} >= 2", "high": "capri_rank_{} >= 3"}
    inner = ", ".join(f"{f}(CASE WHEN {mask} THEN {c} END) AS {c}_{n}" for n, mask in masks.items() for c, f in best.items())
    medians = ", ".join(f"round(median({c}_{n}), 6) AS {c}_median_{n}" for n in masks for c in best if c != "capri_rank")
    rates = ", ".join(f"round(avg(CASE WHEN {test.format(n)} THEN 100.0 ELSE 0.0 END), 6) AS {label}_{n}" for n in ("oracle", "top1", "top5") for label, test in hits.items())
    return f"""WITH {_METRICS}, r AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_linestatus, l_suppkey ORDER BY l_orderkey, l_linenumber, dockq) AS p,
  quantile_cont(l_orderkey, 0.25) OVER (PARTITION BY l_returnflag, l_linestatus, l_suppkey) AS q25, quantile_cont(l_orderkey, 0.5) OVER (PARTITION BY l_returnflag, l_linestatus, l_suppkey) AS q50 FROM m),
s AS (SELECT l_returnflag, l_linestatus, l_suppkey, {inner} FROM r GROUP BY ALL) SELECT l_returnflag, l_linestatus, count(*) AS n_systems, {medians}, {rates} FROM s GROUP BY ALL"""


@query("leaderboard_full", _board_sql())
def leaderboard_full(spark, d):
    return leaderboard.full_board(_metrics(spark, d), ["l_returnflag", "l_linestatus"], "l_suppkey", "l_orderkey", ["l_linenumber", "dockq"])


@query(
    "board_with_missing",
    f"""WITH {_METRICS}, g AS (SELECT l_returnflag, l_linestatus, count(DISTINCT CASE WHEN fnat < 0.05 THEN l_suppkey END) AS missing_systems FROM m GROUP BY ALL),
b AS (SELECT l_returnflag, l_linestatus, round(median(dockq), 6) AS dockq FROM m GROUP BY ALL) SELECT * FROM g LEFT JOIN b USING (l_returnflag, l_linestatus)""",
)
def board_with_missing(spark, d):
    metrics, method = _metrics(spark, d), ["l_returnflag", "l_linestatus"]
    board = metrics.groupBy(*method).agg(F.round(F.median("dockq"), 6).alias("dockq"))
    return leaderboard.with_missing(board, metrics, method, "l_suppkey", F.col("fnat") < 0.05)


@query("median_hit_share", f"WITH {_METRICS} SELECT round(median(s), 6) AS median_hit_share FROM (SELECT avg(CASE WHEN capri_rank > 0 THEN 1.0 ELSE 0.0 END) AS s FROM m GROUP BY l_returnflag, l_linestatus, l_suppkey)")
def median_hit_share(spark, d):
    return leaderboard.median_hit_share(_metrics(spark, d), ["l_returnflag", "l_linestatus", "l_suppkey"], F.col("capri_rank") > 0)


@query(
    "expected_counts",
    """WITH c AS (SELECT o_orderkey, unnest(list_filter([CASE WHEN o_totalprice > 100000 AND o_orderstatus = 'F' THEN 'large:done' END, CASE WHEN o_totalprice > 100000 AND o_orderpriority = '1-URGENT' THEN 'large:urgent' END,
CASE WHEN o_orderstatus = 'F' THEN 'any:done' END, CASE WHEN o_orderpriority = '1-URGENT' THEN 'any:urgent' END], lambda x: x IS NOT NULL)) AS x FROM orders)
SELECT split_part(x, ':', 1) AS subset, split_part(x, ':', 2) AS kind, count(DISTINCT o_orderkey) AS n FROM c GROUP BY ALL""",
)
def expected_counts(spark, d):
    done, urgent = F.col("o_orderstatus") == "F", F.col("o_orderpriority") == "1-URGENT"
    flags = t(spark, d, "orders").withColumns({"done_R": done, "done_L": done, "urgent_R": urgent, "urgent_L": urgent})
    return leaderboard.expected_counts(flags, {"large": F.col("o_totalprice") > 100000, "any": F.lit(True)}, ("done", "urgent"), "o_orderkey")


#: Vectors of label 0 to 4 are the pure split; a system is a node with the smallest of its neighbours.
_LEAKS = f"""{_EDGES}, {_BOTH}, y AS (SELECT src AS id, src AS r, min(dst) AS l FROM b GROUP BY src), z AS (SELECT y.*, label AS cluster_id, label < 5 AS pure FROM y JOIN embeddings ON vec_id = id),
n AS (SELECT vec_id AS source, vec_id AS node FROM embeddings UNION SELECT src, dst FROM b),
k AS (SELECT DISTINCT a.id, o.id AS leaked, false AS considered FROM z a JOIN n p ON p.source = a.r JOIN n q ON q.source = a.l JOIN z o ON (o.r = p.node AND o.l = q.node) OR (o.l = p.node AND o.r = q.node) WHERE a.pure)"""


def _systems(spark, d):
    links = stored(edges(spark, d), "sim-edges")
    both = links.select("src", "dst").unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    labels = t(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("cluster_id"))
    systems = both.groupBy(F.col("src").alias("id")).agg(F.min("dst").alias("l")).select("id", F.col("id").alias("r"), "l").join(labels, "id").withColumn("pure", F.col("cluster_id") < 5)
    return systems, links


@query("split_leakage", f"WITH {_LEAKS} SELECT id, leaked, considered FROM k")
def split_leakage(spark, d):
    systems, links = _systems(spark, d)
    return transitive.split_leakage(systems, links, 1, threshold=0.0)


@query(
    "transitive_hits",
    f"""WITH {_LEAKS}, w AS (SELECT id, leaked FROM k UNION SELECT a.id, o.id FROM z a JOIN z o ON a.cluster_id = o.cluster_id AND a.pure AND o.pure)
SELECT id, (SELECT CAST(count(DISTINCT leaked) AS DOUBLE) FROM k WHERE k.id = z.id) AS depth_hits, (SELECT CAST(count(DISTINCT leaked) AS DOUBLE) FROM w WHERE w.id = z.id) AS depth_hits_with_cluster FROM z WHERE pure""",
)
def transitive_hits(spark, d):
    systems, links = _systems(spark, d)
    leaks = transitive.split_leakage(systems, links, 1, threshold=0.0)
    return transitive.transitive_hits(systems, transitive.merged_leaks([leaks, leaks])).select("id", "depth_hits", "depth_hits_with_cluster")


@query(
    "proto_summary",
    """WITH x AS (SELECT o_orderstatus = 'F' AS test, o_orderpriority = '1-URGENT' AS af2, o_custkey AS apo, o_totalprice > 50000 AS pred, o_totalprice > 150000 AS hetero, o_totalprice AS hits FROM orders)
SELECT round(sum(CASE WHEN test THEN hits END), 2) AS removed, count_if(test) AS systems, count_if(test AND apo <> 0) AS apo, count_if(test AND pred) AS pred, count_if(test AND hetero) AS heterodimer, count_if(test AND NOT hetero) AS homodimer,
count_if(af2 AND apo <> 0) AS apo_af2, count_if(af2 AND pred) AS pred_af2, count_if(af2 AND hetero) AS heterodimer_af2, count_if(af2 AND NOT hetero) AS homodimer_af2 FROM x""",
)
def proto_summary(spark, d):
    table = t(spark, d, "orders").select(
        F.when(F.col("o_orderstatus") == "F", "proto-test").otherwise("proto-train").alias("split"),
        (F.col("o_orderpriority") == "1-URGENT").alias("af2_mm"),
        F.col("o_custkey").alias("min_both_putative_apo"),
        (F.col("o_totalprice") > 50000).cast("int").alias("min_both_pred"),
        (F.col("o_totalprice") > 150000).alias("heterodimer"),
        F.col("o_totalprice").alias("depth_2_hits_with_comm"),
    )
    return transitive.proto_summary(table).withColumn("removed", F.round("removed", 2))


@query("cluster_sample", "SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) = 1 AS sampled FROM customer")
def cluster_sample(spark, d):
    return transitive.cluster_sample(t(spark, d, "customer"), "c_nationkey", "c_custkey", "c_acctbal").select("c_nationkey", "c_custkey", "sampled")


@query("systems_of_pairs", "SELECT least(l_partkey, l_suppkey) AS first, greatest(l_partkey, l_suppkey) AS second, string_agg(DISTINCT CAST(l_orderkey AS VARCHAR), ',' ORDER BY CAST(l_orderkey AS VARCHAR)) AS ids FROM lineitem GROUP BY ALL")
def systems_of_pairs(spark, d):
    lines = t(spark, d, "lineitem").select("l_partkey", "l_suppkey", F.col("l_orderkey").cast("string").alias("id"))
    return entries.joined_lists(transitive.systems_of_pairs(lines, "l_partkey", "l_suppkey"))


@query(
    "merged_sets",
    "SELECT n AS n_nationkey, string_agg(DISTINCT v, ',' ORDER BY v) AS members FROM (SELECT c_nationkey AS n, c_mktsegment AS v FROM customer UNION ALL SELECT s_nationkey, s_name FROM supplier) GROUP BY n",
)
def merged_sets(spark, d):
    segments = t(spark, d, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.collect_set("c_mktsegment").alias("members"))
    names = t(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.collect_set("s_name").alias("members"))
    return entries.joined_lists(transitive.merged_sets([segments, names], "n_nationkey", "members"))


@query(
    "chain_novelty",
    """WITH c AS (SELECT x, count(*) AS n FROM (SELECT c_nationkey AS x FROM customer WHERE c_acctbal > 9000 UNION ALL SELECT c_custkey FROM customer WHERE c_acctbal > 9000) GROUP BY x)
SELECT s_suppkey AS id, coalesce(r.n, 0) AS R_match, coalesce(l.n, 0) AS L_match, CASE WHEN r.n IS NULL AND l.n IS NULL THEN 'Both' WHEN r.n IS NULL OR l.n IS NULL THEN 'Single' ELSE 'Neither' END AS novelty
FROM supplier LEFT JOIN c r ON s_nationkey = r.x LEFT JOIN c l ON s_suppkey = l.x""",
)
def chain_novelty(spark, d):
    test = t(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").cast("long").alias("r"), F.col("s_suppkey").alias("l"))
    # the known set is the customers of a high balance
    train = t(spark, d, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").cast("long").alias("r"), F.col("c_custkey").alias("l"))
    return transitive.chain_novelty(test, train, "r", "l")


@query(
    "component_counts",
    """WITH RECURSIVE p AS (SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z FROM embeddings),
e AS (SELECT a.vec_id AS src, b.vec_id AS dst FROM p a JOIN p b ON a.label = b.label WHERE sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) <= 0.05),
r(node, other) AS (SELECT vec_id, vec_id FROM p UNION SELECT r.node, e.dst FROM r JOIN e ON r.other = e.src)
SELECT label, count(DISTINCT c) AS n_components FROM (SELECT node, min(other) AS c FROM r GROUP BY node) JOIN p ON vec_id = node GROUP BY label""",
)
def component_counts(spark, d):
    at = lambda k: F.element_at("embedding", k).cast("double")
    points = t(spark, d, "embeddings").select("label", F.col("vec_id").alias("atom_idx"), at(1).alias("x"), at(2).alias("y"), at(3).alias("z"))
    return transitive.component_counts(points, ["label"], 0.05)


_PLACED = "p AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS place, count(*) OVER () AS n FROM orders)"


@query("batched_orders", f"WITH {_PLACED}, c AS (SELECT *, CAST(ceil(n / ceil(n / 1024)) AS BIGINT) AS size FROM p) SELECT o_orderkey, place // size AS batch FROM c")
def batched_orders(spark, d):
    return batches.batched(t(spark, d, "orders").select("o_orderkey", "o_orderdate"), [F.col("o_orderdate"), F.col("o_orderkey")], 1024).select("o_orderkey", "batch")


@query("even_parts", f"WITH {_PLACED} SELECT o_orderkey, CASE WHEN place < (n % 7) * (n // 7 + 1) THEN place // (n // 7 + 1) ELSE n % 7 + (place - (n % 7) * (n // 7 + 1)) // (n // 7) END AS part FROM p")
def even_parts(spark, d):
    return batches.even_parts(t(spark, d, "orders").select("o_orderkey", "o_orderdate"), [F.col("o_orderdate"), F.col("o_orderkey")], 7).select("o_orderkey", "part")


@query("batch_pairs", "SELECT CAST(a.r AS BIGINT) AS i, CAST(b.r AS BIGINT) AS j FROM (SELECT DISTINCT n_regionkey AS r FROM nation) a JOIN (SELECT DISTINCT n_regionkey AS r FROM nation) b ON a.r <= b.r")
def batch_pairs(spark, d):
    return batches.batch_pairs(t(spark, d, "nation").select(F.col("n_regionkey").cast("long").alias("batch")))


@query(
    "entry_paths",
    """WITH x AS (SELECT s_suppkey, '1abc__A' || s_suppkey || '_P' || s_nationkey AS r, '1abc__B' || s_suppkey || '_P' || (s_nationkey // 2) AS l, CASE WHEN s_acctbal > 5000 THEN 'test' ELSE 'train' END AS split, s_nationkey FROM supplier)
SELECT r || '--' || l AS id, s_nationkey = s_nationkey // 2 AS homodimer, split = 'test' AS test_system, 'pdbs/' || r || '--' || l || '.pdb' AS native, CASE split WHEN 'test' THEN 'test_set_pdbs/' ELSE 'pdbs/' END || r || '-R.pdb' AS holo_R,
CASE WHEN s_nationkey > 12 THEN 'pdbs/x' || s_suppkey || '.pdb' ELSE '' END AS apo_R, CASE WHEN s_nationkey > 12 THEN 'y.pdb' ELSE '' END AS apo_R_alt, 'mappings/' || r || '-R.parquet' AS mapping, '1abc_A' || s_suppkey || '_B' || s_suppkey AS chains FROM x""",
)
def entry_paths(spark, d):
    n = F.col("s_nationkey")
    half = F.floor(n / 2).cast("string")
    part = lambda chain, uniprot: entries.monomer_id(F.lit("1abc"), F.concat(F.lit(chain), F.col("s_suppkey").cast("string")), F.concat(F.lit("P"), uniprot), F.lit(None).cast("int"), F.lit(None).cast("int"))
    apo = F.when(n > 12, F.concat(F.lit("x"), F.col("s_suppkey").cast("string"), F.lit(".pdb"))).otherwise("")
    made = t(spark, d, "supplier").select(
        F.concat_ws("--", part("A", n.cast("string")), part("B", half)).alias("id"),
        F.when(F.col("s_acctbal") > 5000, "test").otherwise("train").alias("split"),
        n.cast("string").alias("uniprot_R"),
        half.alias("uniprot_L"),
        F.concat(part("A", n.cast("string")), F.lit("-R.pdb")).alias("holo_R_pdb"),
        F.concat(part("B", half), F.lit("-L.pdb")).alias("holo_L_pdb"),
        *[F.lit("").alias(f"predicted_{s}_pdb") for s in "RL"],
        apo.alias("apo_R_pdb"),
        F.lit("").alias("apo_L_pdb"),
        F.when(n > 12, F.concat_ws(";", apo, F.lit("y.pdb"))).otherwise("").alias("apo_R_pdbs"),
        F.lit("").alias("apo_L_pdbs"),
    )
    out = entries.described(made)
    return out.select(
        "id", "homodimer", "test_system",
        F.col("pdb_paths")["native"].alias("native"), F.col("pdb_paths")["holo_R"].alias("holo_R"), F.col("pdb_paths")["apo_R"].alias("apo_R"),
        F.array_join("apo_R_alt", ";").alias("apo_R_alt"), entries.mapping_path(F.col("holo_R_pdb")).alias("mapping"), entries.entry_chains(F.concat("id", F.lit(".pdb"))).alias("chains"),
    )
