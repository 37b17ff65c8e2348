import math
import os

import numpy as np
from pyspark.sql import functions as F

from dyadlake.operators import atoms as at
from dyadlake.operators import batches, entries, leaderboard, transitive

SCHEMA = "id string, chain_id string, res_id int, atom_name string, element string, atom_idx int, x double, y double, z double"


def structure(spark, seed=1, n=12, ident="s", gap=True):
    rng = np.random.default_rng(seed)
    rows, k = [], 0
    for chain, shift in (("R", 0.0), ("L", 4.0)):
        for r in range(1, n + 1):
            if gap and chain == "R" and r == 5:
                continue
            for a in ("N", "CA", "C", "O", "H"):
                p = np.array([3.0 * r, shift, 0.0]) + rng.normal(scale=0.3, size=3)
                rows.append((ident, chain, r, a, "H" if a == "H" else a[0], k, *map(float, p)))
                k += 1
    return spark.createDataFrame(rows, SCHEMA)


def coords(df):
    return np.array([(r.x, r.y, r.z) for r in df.orderBy("atom_idx").collect()])


def test_selections_roles_and_order(spark):
    s = structure(spark)
    assert at.filter_atoms(s).where("element = 'H'").count() == 0 and at.filter_atoms(s, calpha=True).count() == 23
    assert at.select_atoms(("CA", "C"))(s).count() == 46
    assert {(r.chain_id, r.role) for r in at.chain_roles(s, ["id"]).collect()} == {("L", "receptor"), ("R", "ligand")}
    order = [r.chain_id for r in at.canonical_order(s, ["id"], ["L"], ["R"]).orderBy("atom_idx").collect()]
    assert order == ["L"] * 60 + ["R"] * 55
    twice = s.unionByName(s.withColumn("atom_idx", F.col("atom_idx") + 1000)).where("atom_name = 'CA'")
    assert at.unique_calpha(twice, ["id"]).agg(F.max("atom_idx")).first()[0] < 1000


def test_common_atoms_of_all_models(spark):
    s = structure(spark, gap=False)
    models = s.withColumn("m", F.lit(1)).unionByName(s.where("res_id <> 3").withColumn("m", F.lit(2))).unionByName(s.where("atom_name <> 'O'").withColumn("m", F.lit(3)))
    got = {(r.res_id, r.atom_name) for r in at.common_atoms(models, ["id"], "m").select("res_id", "atom_name").collect()}
    assert got == {(r, a) for r in range(1, 13) if r != 3 for a in ("N", "CA", "C", "H")}


def test_common_residues_mask_both_chains(spark):
    a = spark.createDataFrame([("s", 1, 11, "P"), ("s", 2, 12, "P"), ("s", 3, None, "P"), ("s", 4, 14, "Q")], "id string, resi int, resi_uniprot int, uniprot_acc string")
    b = spark.createDataFrame([("s", 101, 12, "P"), ("s", 102, 14, "P"), ("s", 103, 14, "Q")], "id string, resi int, resi_uniprot int, uniprot_acc string")
    both = at.common_residues(a, b, ["id"])
    assert {(r.resi_a, r.resi_b) for r in both.collect()} == {(2, 101), (4, 103)}
    s = structure(spark).unionByName(structure(spark, ident="other"))
    kept = at.masked(s, both, ["id"], "resi_a")
    assert {r.res_id for r in kept.where("id = 's'").collect()} == {2, 4} and kept.where("id = 'other'").count() == 115


def test_mismatches_of_aligned_sequences(spark):
    got = spark.createDataFrame([("AB-DX", "AC-DE"), ("AAA", "AAA")], "a string, b string").select(at.mismatches(F.col("a"), F.col("b")).alias("m")).collect()
    assert [tuple(r.m) for r in got] == [(2, 3), (0, 3)]


def test_random_ligand_is_rigid_and_seeded(spark):
    s = structure(spark)
    one, two, other = (coords(at.random_ligand(s, ["id"], 10.0, seed)) for seed in (3, 3, 4))
    before = coords(s)
    assert np.allclose(one, two) and not np.allclose(one, other) and np.allclose(one[:55], before[:55])
    gap = lambda x: np.linalg.norm(x[55:, None] - x[None, 55:], axis=-1)
    assert np.allclose(gap(one), gap(before)) and not np.allclose(one[55:], before[55:])


def test_superposition_and_orientation(spark):
    s = structure(spark)
    moved = at.random_ligand(s.withColumn("chain_id", F.lit("L")).withColumn("res_id", F.col("atom_idx") * 1), ["id"], 10.0, 5)
    ref = s.withColumn("chain_id", F.lit("L")).withColumn("res_id", F.col("atom_idx") * 1)
    assert np.allclose(coords(at.superposed(moved, ref, ["id"])), coords(s), atol=1e-6)
    assert np.allclose(coords(at.superposed(moved.limit(2), ref, ["id"])), coords(moved)[:2])
    turned = coords(at.oriented(s, ["id"]))
    spread = turned.var(axis=0)
    assert np.allclose(turned.mean(axis=0), 0) and spread[0] >= spread[1] >= spread[2]
    d = np.linalg.norm(coords(s)[:, None] - coords(s)[None], axis=-1)
    assert np.allclose(np.linalg.norm(turned[:, None] - turned[None], axis=-1), d)


def test_surfaces(spark):
    one = at.accessible(np.zeros((1, 3)), np.array([1.7]), 400)
    assert abs(one[0] - 4 * math.pi * 3.1**2) < 1e-9
    r, d = 3.1, 2.0
    two = at.accessible(np.array([[0.0, 0, 0], [d, 0, 0]]), np.array([1.7, 1.7]), 4000).sum()
    caps = 2 * (4 * math.pi * r**2 - 2 * math.pi * r * (r - d / 2))
    assert abs(two - caps) < 0.01 * caps
    got = at.buried_surface(structure(spark), ["id"]).collect()
    far = at.buried_surface(structure(spark).withColumn("y", F.when(F.col("chain_id") == "L", F.col("y") + 100).otherwise(F.col("y"))), ["id"]).collect()
    assert got[0].buried > 100 and far[0].buried == 0


def test_interfaces(spark):
    s = structure(spark)
    rows = at.interacting_chains(s, ["id"], 6.0).collect()
    assert len(rows) == 1 and (rows[0].chain1, rows[0].chain2) == ("L", "R") and rows[0].residues2.split(",")[:4] == ["1", "2", "3", "4"]
    assert rows[0].n_residues == len(rows[0].residues1.split(",")) + len(rows[0].residues2.split(","))
    found = at.interface_gaps(s, ["id"], 4.0).collect()
    p = {(r.chain_id, r.res_id, r.atom_name): np.array((r.x, r.y, r.z)) for r in s.collect()}
    heavy = {k: v for k, v in p.items() if k[2] != "H"}
    met = {(a[:2], b[:2]) for a in heavy for b in heavy if a[0] == "L" and b[0] == "R" and np.linalg.norm(heavy[a] - heavy[b]) <= 4.5}
    face = {x for pair in met for x in pair}
    ends = {("R", 4), ("R", 6)}
    near = {k for k in p if k[:2] in face and any(np.linalg.norm(p[k] - p[e]) <= 4.0 for e in p if e[:2] in ends)}
    assert [(r.atom_gaps, r.missing_residues) for r in found] == [(len(near), len({k[:2] for k in near} & ends))]
    assert at.interface_gaps(structure(spark, gap=False), ["id"], 4.0).count() == 0


def test_systems_as_rows_and_folders(spark, tmp_path):
    s = structure(spark).withColumn("kind", F.lit("holo")).unionByName(structure(spark, seed=2).withColumn("kind", F.lit("apo")))
    index = spark.createDataFrame([("s", "c1"), ("none", "c2")], "id string, cluster_id string")
    rows = {r.id: r.structures for r in at.gathered(index, s, "id", "kind").collect()}
    assert set(rows["s"]) == {"holo", "apo"} and len(rows["s"]["holo"]) == 115 and rows["none"] is None
    assert [a.atom_idx for a in rows["s"]["holo"]] == list(range(115))
    at.write_clustered(s, index, str(tmp_path / "w"))
    assert sorted(os.listdir(tmp_path / "w" / "cluster_id=c1" / "id=s")) == ["kind=apo", "kind=holo"]


def test_detached_chains_are_counted(spark):
    far = structure(spark, gap=False).withColumn("x", F.when((F.col("chain_id") == "L") & (F.col("res_id") > 6), F.col("x") + 100).otherwise(F.col("x")))
    counts = transitive.component_counts(far.where("atom_name = 'CA'"), ["id", "chain_id"], 15.0)
    assert {(r.chain_id, r.n_components) for r in counts.collect()} == {("R", 1), ("L", 2)}
    index = spark.createDataFrame([("s",), ("t",)], "id string")
    assert [r.id for r in transitive.attached(index, counts, "id").collect()] == ["t"]


def test_leaks_of_hubs_are_considered(spark):
    edges = spark.createDataFrame([("a", "b", 0.9), ("b", "c", 0.9), ("x", "y", 0.9), ("a", "z", 0.1)] + [("h", f"n{k}", 0.9) for k in range(5)], "src string, dst string, weight double")
    systems = spark.createDataFrame([("p", "a", "x", True), ("t1", "y", "c", False), ("t2", "b", "b", False), ("q", "h", "x", True), ("t3", "z", "y", False)], "id string, r string, l string, pure boolean")
    got = {(r.id, r.leaked, r.considered) for r in transitive.split_leakage(systems, edges, 2, 0.65, max_degree=4).collect()}
    assert got == {("p", "p", False), ("p", "t1", False), ("q", None, True)}
    leaks = transitive.split_leakage(systems, edges, 2, 0.65, max_degree=4)
    index = spark.createDataFrame([("p", 1, True), ("q", 1, True), ("w", 1, True), ("t1", 2, False)], "id string, cluster_id int, pure boolean")
    hits = {r.id: (r.depth_hits, r.depth_hits_with_cluster) for r in transitive.transitive_hits(index, transitive.merged_leaks([leaks, leaks])).collect()}
    assert hits == {"p": (2.0, 4.0), "q": (math.inf, math.inf), "w": (None, None)}


def test_batch_sizes(spark):
    assert [batches.packed_size(10, 3), batches.packed_size(10, None, 4), batches.packed_size(10, 2, 3), batches.packed_size(9, 4), batches.packed_size(0, 3)] == [3, 3, 4, 3, 1]
    ids = spark.createDataFrame([(f"i{k}", "m", "R") for k in range(7)], "id string, apo_monomer_id string, body string")
    done = spark.createDataFrame([(4,)], "output long")
    got = {}
    for r in batches.pairing_batches(ids, 3, done).collect():
        got.setdefault(r.output, []).append(r.pairing_id)
    assert {k: len(v) for k, v in got.items()} == {5: 3, 6: 3, 7: 1} and sorted(sum(got.values(), []))[0] == "i0:m:R"


def test_entries_and_flips(spark):
    rows = spark.createDataFrame([("a", "b", 0.5, 1, 5, 10, 2, 6, 20, 4)], "query string, target string, score double, qstart int, qend int, qlen int, tstart int, tend int, tlen int, alnlen int")
    assert tuple(entries.flipped_alignments(rows).first()) == ("b", "a", 0.5, 2, 6, 20, 1, 5, 10, 4)
    faces = entries.parsed_interfaces(spark.createDataFrame([("p\tq\t1,2,2\t7",)], "value string"))
    assert tuple(entries.flipped_interfaces(faces).first()) == ("q", "p", [7], [1, 2])
    nested = spark.createDataFrame([([(3, 9), (20, 30)],), (None,)], "feature_positions array<struct<beg_seq_id:int,end_seq_id:int>>")
    assert [(r.beg_seq_id, r.end_seq_id) for r in entries.feature_positions(nested).collect()] == [(3, 9), (None, None)]
    assert entries.json_columns(nested, ["feature_positions", "absent"]).first()[0] == '[{"beg_seq_id":3,"end_seq_id":9},{"beg_seq_id":20,"end_seq_id":30}]'
    wide = spark.createDataFrame([(1, 70000, 1 << 40), (2, 3, 4)], "a long, b long, c long")
    assert dict(entries.narrowed(wide).dtypes) == {"a": "smallint", "b": "int", "c": "bigint"}
    ids_ = spark.createDataFrame([("af", "A", "P1", 2, 9), ("af", None, "P1", None, None), ("1abc", "B2", "P1", None, None)], "s string, c string, u string, f int, l int")
    assert [r[0] for r in ids_.select(entries.monomer_id(*map(F.col, "scufl"))).collect()] == ["af__P1_2_9", "af__P1", "1abc__B2_P1"]


def test_kinds_and_subsets(spark):
    metrics = spark.createDataFrame([("m", "a", "x", 1.0), ("m", "b", "x", 2.0), ("o", "a", "holo", 3.0)], "method string, id string, kind string, v double")
    index = spark.createDataFrame([("a", True, True), ("b", True, False)], "id string, holo boolean, apo boolean")
    got = sorted(tuple(r) for r in leaderboard.spread_kinds(metrics, index, F.col("method") == "m", {"holo": F.col("holo"), "apo": F.col("apo")}).collect())
    assert got == [("m", "a", "apo", 1.0), ("m", "a", "holo", 1.0), ("m", "b", "holo", 2.0), ("o", "a", "holo", 3.0)]
    assert leaderboard.only_within(metrics, F.col("method") == "m", F.col("id") == "a").count() == 2
    marked = leaderboard.masked_and_raw(metrics.withColumn("mask", F.col("v") > 1.5), "mask", ("masked", "raw"), "method")
    assert sorted(r.method for r in marked.collect()) == ["masked", "masked", "raw"]
    sets = transitive.labelled_subsets(metrics, index, {"both": F.col("apo"), "all": F.lit(True)})
    assert sorted((r.id, r.subset, r.v) for r in sets.collect()) == [("a", "all", 1.0), ("a", "all", 3.0), ("a", "both", 1.0), ("a", "both", 3.0), ("b", "all", 2.0)]
