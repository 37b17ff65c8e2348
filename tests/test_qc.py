from pyspark.sql import functions as F

from dyadlake.operators import qc
from dyadlake.plans import control


def test_interfaces_of_systems(spark):
    index = spark.createDataFrame([("1abc__A1_P1--1abc__B12_P2",), ("2abc__A1_P1--2abc__B1_P2",)], "id string")
    faces = spark.createDataFrame([("1abc__A1_P1-R", "1abc__B12_P2-L", [1, 2], [3])], "id1 string, id2 string, residues1 array<int>, residues2 array<int>")
    assert [tuple(r) for r in qc.interfaces_of(index, faces).collect()] == [("1abc__A1_P1--1abc__B12_P2", "1abc", "A", "B", [1, 2], [3])]


def test_scores_and_flags(spark):
    leaks = spark.createDataFrame([("a", "x", "train"), ("a", "y", "val"), ("b", "x", "train")], "id string, hit_id string, hit_split string")
    scores = spark.createDataFrame([("a", "x", 1e-12, 0.5), ("a", "y", 1e-2, 0.9)], "id string, hit_id string, p_value double, score double")
    scored = qc.scored_leaks(leaks, scores)
    assert {(r.id, r.hit_id): round(r.log_pvalue, 6) for r in scored.collect()} == {("a", "x"): -12.0, ("a", "y"): -2.0, ("b", "x"): 0.0}
    near = F.col("log_pvalue") < -9
    flags = {"train_similar": near & (F.col("hit_split") == "train"), "val_similar": near & (F.col("hit_split") == "val")}
    index = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    assert {(r.id, r.train_similar, r.val_similar) for r in qc.flagged(index, scored, flags).collect()} == {("a", True, False), ("b", False, False), ("c", False, False)}


def test_clans_and_displays(spark):
    index = spark.createDataFrame([("i", "1abc", "A1", "B2", "test", True, False), ("j", "1abc", "C1", "A3", "train", False, False), ("k", "2abc", "A1", "A2", "test", True, True)], "id string, pdb_id string, chain_R string, chain_L string, split string, xl boolean, s boolean")
    clans = spark.createDataFrame([("1abc", "A", "Z"), ("1abc", "B", "Q")], "pdb_id string, chain string, clan string")
    got = {r.id: (r.pfam_clan_R, r.pfam_clan_L, r.pfam_clan) for r in qc.with_clans(index, clans).collect()}
    assert got == {"i": ("Z", "Q", "Q : Z"), "j": ("no_clan", "Z", "Z"), "k": ("no_clan", "no_clan", "Not defined")}
    shown = qc.display_splits(index, {"xl": "XL", "s": "S"}, {"train": "Train", "val": "Val"})
    assert sorted((r.id, r.split) for r in shown.collect()) == [("i", "XL"), ("j", "Train"), ("k", "S"), ("k", "XL")]
    meta = spark.createDataFrame([("i", "1,2,3", "4", 50, 40)], "id string, chain_1_residues string, chain_2_residues string, length1 int, length2 int")
    row = qc.interface_metadata(index.withColumn("cluster_id", F.lit("c")), meta).first()
    assert (row.interface_lengths, row.min_chain_len) == (4, 40)
    test = spark.createDataFrame([("i", "proto-test", 5), ("k", "proto-test", 2), ("j", "proto-train", 1)], "id string, split string, depth_2_hits_with_comm int")
    assert [r.id for r in qc.proto_table(test, index, ["pdb_id", "chain_R"]).collect()] == ["k", "i"]


def test_dual_alignments_follow_the_entries(spark):
    """Chains with many hits meet where an entry has both, and rows before that follow the entries."""
    n = 3000
    hits = spark.range(2 * n).selectExpr("id % 2 AS chain", "id AS entry", "id AS hit", "1.0 AS score").unionByName(spark.createDataFrame([(0, -1, 7, 1.0), (1, -1, 8, 0.5), (1, -2, 7, 0.5)], "chain long, entry long, hit long, score double"))
    systems, known = spark.createDataFrame([("a", 0, 1), ("b", 0, 0)], "id string, r long, l long"), spark.createDataFrame([(8, 7)], "first long, second long")
    got = qc.dual_alignments(systems, hits, known)
    assert [tuple(r) for r in got.collect()] == [("a", -1, 7, 8, 1.0, 0.5)]
    assert sorted((r.r, r.l, r.entry) for r in qc.aligned_pairs(hits, known).collect()) == [(0, 1, -1), (1, 0, -1)]


def test_suppliers_named_twice_are_one_system(spark, tmp_path):
    spark.createDataFrame([(1, 5), (2, 5), (1, 5), (2, 6), (1, 6)], "s_suppkey long, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(9, 1, 30, "R"), (9, 2, 20, "R"), (8, 1, 20, "N"), (8, 2, 40, "N")], "l_orderkey long, l_suppkey long, l_partkey long, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    assert [tuple(r) for r in control.dual_alignments(spark, str(tmp_path)).collect()] == [("1-2", 9, 30, 20)]


def test_nested_entries_become_tables(spark):
    schema = (
        "pdb_id string, polymer_entities array<struct<identifiers:map<string,string>, pfams:array<struct<rcsb_pfam_accession:string,rcsb_pfam_description:string>>,"
        " features:array<struct<feature_id:string,type:string,description:string>>, instances:array<struct<identifiers:map<string,string>,annotations:array<struct<annotation_id:string,type:string>>,features:array<struct<feature_id:string,type:string>>>>>>"
    )
    one = ({"entity_id": "1"}, [("PF1", "fam one"), ("PF2", "fam two")], [("PF1", "Pfam", "d"), ("X", "other", "d")], [({"asym_id": "A"}, [("a1", "CATH")], [("f1", "SHEET"), ("f2", "HELIX")]), ({"asym_id": "B"}, None, [])])
    two = ({"entity_id": "2"}, None, None, None)
    got = qc.entry_annotations(spark.createDataFrame([("1abc", [one, two]), ("2abc", None)], schema))
    assert sorted((r.feature_id, r.description, r.type) for r in got["families"].collect()) == [("PF1", "fam one", "Pfam"), ("PF2", "fam two", None)]
    assert {k: v.count() for k, v in got.items()} == {"families": 2, "features": 2, "annotations": 1, "instance_features": 2}
    assert got["annotations"].first().identifiers == {"asym_id": "A"}
