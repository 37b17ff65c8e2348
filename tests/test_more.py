from pyspark.sql import functions as F

from dyadlake import cli
from dyadlake.operators import annotate, pairing
from dyadlake.streaming.incremental import process_new


def test_new_files_are_processed_once(spark, tmp_path):
    def put(k):
        spark.range(k, k + 3).write.mode("append").parquet(f"{tmp_path}/in")

    def go():
        process_new(spark, f"{tmp_path}/in", "id long", lambda df: df.withColumn("x", F.col("id") * 2), f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination(120)
        return sorted(r.x for r in spark.read.parquet(f"{tmp_path}/out").collect())

    put(0)
    assert go() == [0, 2, 4]
    put(10)
    assert go() == [0, 2, 4, 20, 22, 24]


def test_pairing_end_to_end(spark):
    dimers = spark.createDataFrame([("d1", "P1", "P2", "A", "B"), ("d2", "P3", "UNDEFINED", "A", "B")], "id string, uniprot_R string, uniprot_L string, chain_R string, chain_L string")
    monomers = spark.createDataFrame([("m1", "P1"), ("m2", "P1"), ("m3", "P2"), ("m4", "UNDEFINED")], "id string, uniprot string")
    pairs = pairing.candidates(dimers, monomers)
    assert sorted((r.id, r.side, r.apo) for r in pairs.collect()) == [("d1", "L", "m3"), ("d1", "R", "m1"), ("d1", "R", "m2")]
    good = F.when(F.col("apo") == "m1", 0.9).otherwise(0.8)
    measured = pairs.select("*", good.alias("identity"), F.lit(0.9).alias("covered"), F.lit(1.0).alias("rmsd"), F.lit(2.0).alias("resolution"), F.lit(0.5).alias("interface_share"), F.lit(90).alias("apo_length"), F.lit(100).alias("holo_length"))
    chosen = pairing.canonical(pairing.scored(pairing.select(measured)))
    row = pairing.on_index(dimers.select("id"), chosen).where("id = 'd1'").first()
    assert (row.apo_R_pdb, row.apo_R_pdbs, row.apo_L_pdbs, row.apo_R) == ("m1", "m1;m2", "m3", True)
    assert pairing.select(measured, pairing.Limits(min_identity=0.95)).count() == 0
    kinds = spark.createDataFrame([("a", ["apo", "holo"]), ("b", ["holo"]), ("c", [])], "id string, have array<string>")
    assert [r.kind for r in pairing.select_monomer(kinds, ["predicted", "apo", "holo"], "have").orderBy("id").collect()] == ["apo", "holo", None]


def test_annotation_tables(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", None), ("b", None)], "k string, v string")
    assert sorted((r.k, r.v) for r in annotate.most_frequent(rows, ["k"], "v", "UNDEFINED").collect()) == [("a", "x"), ("b", "UNDEFINED")]
    wide = annotate.widen_sides(spark.createDataFrame([("a",), ("b",)], "id string"), spark.createDataFrame([("a", "R", 1), ("a", "L", 2)], "id string, side string, n int"), "id", "side", ["n"])
    assert sorted((r.id, r.n_R, r.n_L) for r in wide.collect()) == [("a", 1, 2), ("b", None, None)]
    bonds = annotate.transient(spark.createDataFrame([(1,), (2,)], "id int"), spark.createDataFrame([(1, 1, 0)], "id int, intra int, inter int"), "id", "intra", "inter")
    assert sorted((r.id, r.no_bonds, r.intra_only, r.linked) for r in bonds.collect()) == [(1, False, True, False), (2, True, False, False)]


def test_command_line(spark, tmp_path):
    spark.createDataFrame([("m", "s1", f"model_{k}", k / 10) for k in range(1, 4)], "method string, system string, model_name string, DockQ double").write.parquet(f"{tmp_path}/metrics.parquet")
    args = cli.parser().parse_args(["--out", f"{tmp_path}/out", "leaderboard", f"{tmp_path}/metrics.parquet", "--k", "1", "3"])
    board = cli.run(spark, args).first()
    assert (board.hit_top1, board.hit_top3) == (0.0, 100.0)
