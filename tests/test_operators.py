import numpy as np
import pytest
from pyspark.sql import functions as F

from dyadlake.functions import arrays, ids, scoring
from dyadlake.operators import graph, leaderboard, leakage, loader, rel, splits, stats, structure


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_natural_join_needs_shared_columns_and_can_match_nulls(spark):
    a = spark.createDataFrame([(1, "x"), (None, "y")], "k int, a string")
    b = spark.createDataFrame([(1, "p"), (None, "q")], "k int, b string")
    assert rel.natural_join(a, b).count() == 1
    assert values(rel.natural_join(a, b, null_safe=True), "k", "a", "b") == [(1, "x", "p"), (None, "y", "q")]
    with pytest.raises(ValueError):
        rel.natural_join(a, b.select("b"))


def test_id_grammar(spark):
    df = spark.createDataFrame([("7nsg__A1_P43005--7nsg__B1_P43005",), ("1abc__A2_Q1-R--1abc__B12_UNDEFINED-L",)], "id string")
    got = df.select(ids.parse_dimer("id").alias("d"), ids.pair_keys("id").alias("k"), ids.chain_key(F.split("id", "--")[0]).alias("c")).collect()
    assert got[0].d.R.source == "7nsg" and got[0].d.L.chain == "B1" and got[0].k == ["7nsg_A", "7nsg_B"] and got[0].c == "7nsg_A1"
    assert got[1].d.R.side == "R" and got[1].d.L.side == "L" and got[1].d.R.uniprot == "Q1" and got[1].d.L.uniprot == "UNDEFINED"
    labels = spark.createDataFrame([("12.0",), ("101A",), (None,)], "x string").select(ids.residue_label("x").alias("r"))
    assert [r.r for r in labels.collect()] == ["12", "101A", ""]
    names = spark.createDataFrame([("b10",), ("B2",), ("a",)], "x string")
    assert [r.x for r in names.orderBy(ids.natural_key("x")).collect()] == ["a", "B2", "b10"]
    chains = spark.createDataFrame([("A1",), ("A7",), ("AB",)], "c string").where(ids.copy_number("c") == 1)
    assert values(chains, "c") == [("A1",), ("AB",)]


def test_scores_and_classes(spark):
    cases = [(0.05, 1.0, 1.0, "Incorrect"), (0.2, 3.0, 9.0, "Acceptable"), (0.4, 1.5, 4.0, "Medium"), (0.9, 0.5, 0.8, "High"), (0.9, 1.5, 1.5, "Medium"), (0.9, 3.0, 7.0, "Acceptable"), (0.2, 5.0, 11.0, "Incorrect")]
    df = spark.createDataFrame(cases, "f double, i double, l double, want string").withColumn("got", scoring.capri(F.col("f"), F.col("i"), F.col("l")))
    assert all(r.got == r.want for r in df.collect())
    one = df.limit(1).select(scoring.dockq(F.lit(1.0), F.lit(0.0), F.lit(0.0)), scoring.safe_divide(F.lit(1.0), F.lit(0.0), 7.0), scoring.difficulty(F.lit(1.0), F.lit(0.5))).first()
    assert tuple(one) == (1.0, 7.0, "Medium")


def test_array_algebra(spark):
    df = spark.createDataFrame([([1, 2, 3, 9], [2, 3, 4])], "a array<int>, b array<int>")
    got = df.select(
        arrays.coverage(F.col("a"), F.lit(2), F.lit(3)), arrays.coverage(F.col("a"), F.lit(2), F.lit(3), closed=False), arrays.span(F.lit(5), F.lit(3)),
        arrays.pair_product_size(F.col("a"), F.col("b")), F.size(arrays.pair_product(F.col("a"), F.col("b"))),
    ).first()
    assert tuple(got) == (0.5, 0.25, [], 11, 11)


def test_khop_in_blocks(spark, monkeypatch):
    """Any number of blocks gives each node once."""
    rng = np.random.default_rng(3)
    links = {(int(a), int(b)) for a, b in rng.integers(0, 40, (60, 2))}
    near = {n: {b for a, b in links if a == n} | {a for a, b in links if b == n} for n in range(45)}
    reach = {n: {n} for n in range(45)}
    for _ in range(3):
        reach = {n: seen.union(*(near[x] for x in seen)) for n, seen in reach.items()}
    want = sorted((str(n), str(x)) for n, seen in reach.items() for x in seen)
    edges = spark.createDataFrame([(str(a), str(b)) for a, b in links], "src string, dst string")
    for walks, held in ((graph.WALKS, graph.LINKS), (50, 20)):
        monkeypatch.setattr(graph, "WALKS", walks)
        monkeypatch.setattr(graph, "LINKS", held)
        got = graph.khop(edges, spark.createDataFrame([(str(n),) for n in range(45)], "node string"), 3)
        assert sorted((r.source, r.node) for r in got.collect()) == want


def test_khop_sends_few_copies_of_the_links(spark, monkeypatch):
    """Shuffled bytes of a hop dealt over many tasks: no list for each block, no pair found twice."""
    rng = np.random.default_rng(8)
    links = {(int(a), int(b)) for a, b in rng.integers(0, 2000, (30000, 2)) if a != b}
    near = np.eye(2000, dtype=bool)
    for a, b in links:
        near[a, b] = near[b, a] = True
    monkeypatch.setattr(graph, "WALKS", 50_000)
    monkeypatch.setattr(graph, "LINKS", 20_000)
    store = spark.sparkContext._jsc.sc().statusStore()
    sizes = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)
    stages = lambda: {s.stageId(): s.shuffleWriteBytes() for s in map(store.stageList(None, False, False, sizes, None).apply, range(store.stageList(None, False, False, sizes, None).size()))}
    got = graph.khop(spark.createDataFrame(sorted(links), "src long, dst long"), spark.range(2000).withColumnRenamed("id", "node"), 2)
    before = stages()
    pair = F.col("source") * 2000 + F.col("node")
    rows = got.agg(F.count("*"), F.sum(pair), F.sum(pair * pair % 1_000_003)).first()
    wrote = sum(v for k, v in stages().items() if k not in before)
    want = np.flatnonzero(near.astype(np.float32) @ near.astype(np.float32))
    assert tuple(rows) == (len(want), want.sum(), (want * want % 1_000_003).sum())
    assert wrote < 4_000_000


def test_graphs(spark):
    chain = spark.createDataFrame([(k, k + 1, 0.9) for k in range(1, 12)] + [(50, 51, 0.2), (51, 50, 0.4)], "src int, dst int, weight double")
    got = dict(values(graph.connected_components(chain), "node", "component"))
    assert got == {**{k: 1 for k in range(1, 13)}, 50: 50, 51: 50}
    assert values(graph.reciprocal(chain), "src", "dst", "weight") == [(50, 51, 0.4)]
    assert graph.undirected_max(chain).where("src = 50").first().weight == 0.4
    hops = graph.khop(chain, spark.createDataFrame([(5,), (50,)], "node int"), 2)
    assert values(hops.where("source = 5"), "node") == [(k,) for k in (3, 4, 5, 6, 7)]
    hub = spark.createDataFrame([(0, k, 1.0) for k in range(1, 9)], "src int, dst int, weight double")
    assert values(graph.khop(hub, spark.createDataFrame([(0,), (1,)], "node int"), 1, max_degree=5).where("source = 0"), "node", "hub") == [(0, True)]
    cliques = [(a, b, 1.0) for g in (0, 10) for a in range(g, g + 5) for b in range(a + 1, g + 5)] + [(4, 10, 0.1)]
    labels = dict(values(graph.label_propagation(spark.createDataFrame(cliques, "src int, dst int, weight double")), "node", "community"))
    assert len({labels[k] for k in range(5)}) == 1 and len({labels[k] for k in range(10, 15)}) == 1 and labels[0] != labels[10]
    assert graph.connected_components(chain.limit(0)).count() == 0


def test_label_propagation_ends_where_no_label_would_move(spark):
    rng = np.random.default_rng(6)
    pairs = [(100 + 2 * k, 101 + 2 * k, 0.4) for k in range(20)]
    path = [(200 + k, 201 + k, 1.0) for k in range(14)]
    star = [(300, 301 + k, 0.7) for k in range(9)]
    random = [(400 + int(a), 400 + int(b), float(w)) for a, b, w in zip(*rng.integers(0, 40, (2, 90)), rng.random(90) + 0.1) if a != b]
    edges = pairs + path + star + random
    got = dict(values(graph.label_propagation(spark.createDataFrame(edges, "src int, dst int, weight double")), "node", "community"))
    votes = {}
    for a, b, w in edges:
        for node, other in ((a, b), (b, a)):
            mine = votes.setdefault(node, {})
            mine[got[other]] = mine.get(got[other], 0) + w
    assert set(got) == set(votes)
    assert all(v.get(got[n], 0) >= max(v.values()) - 1e-6 for n, v in votes.items())
    assert all(got[a] == got[b] for a, b, _ in pairs + star)


def test_interface_coverage(spark):
    edges = spark.createDataFrame([("a", "b", 0, 10, 0.8), ("b", "a", 0, 10, 0.7), ("a", "c", 5, 6, 0.9), ("c", "a", 0, 9, 0.9)], 'src string, dst string, start int, end int, weight double')
    faces = spark.createDataFrame([("a", [1, 2, 20]), ("a", [3]), ("b", [4, 30]), ("c", [1])], "node string, residues array<int>")
    assert values(graph.interface_graph(edges, faces, 0.5), "src", "dst", "weight") == [("a", "b", 0.8)]


def test_pair_leaks_match_brute_force(spark):
    rng = np.random.default_rng(4)
    systems = [(i, int(a), int(b)) for i, (a, b) in enumerate(rng.integers(0, 12, (25, 2)))]
    reach = sorted({(int(a), int(b)) for a, b in rng.integers(0, 12, (50, 2))} | {(k, k) for k in range(12)})
    near = {k: {b for a, b in reach if a == k} for k in range(12)}
    want = {(i, j) for i, r, l in systems for j, r2, l2 in systems if i != j and ((r2 in near[r] and l2 in near[l]) or (l2 in near[r] and r2 in near[l]))}  # noqa: E741
    got = graph.pair_leaks(spark.createDataFrame(reach, "source int, node int"), spark.createDataFrame(systems, "id int, r int, l int"))
    assert set(values(got, "id", "leaked")) == want


def test_samples_and_bins(spark):
    df = spark.createDataFrame([(k, k % 4, float(k)) for k in range(100)], "id int, g int, x double")
    a, b = (values(stats.sample_per_group(df, ["g"], 5, "id", seed=1), "id") for _ in range(2))
    assert a == b and len(a) == 20
    assert stats.stratified_sample(df, ["x"], 5, 30, "id").count() == 30 and stats.stratified_sample(df, ["x"], 5, 500, "id").count() == 100
    for columns, bins in ((["x", "g", "id"], 5), (["x"], 1)):
        with pytest.raises(ValueError):
            stats.stratified_sample(df, columns, bins, 5, "id")
    running = dict(values(stats.running_total(df, [F.asc("id")], "x", "s", parts=7), "id", "s"))
    assert running == {k: k * (k + 1) / 2 for k in range(100)}
    flat = spark.createDataFrame([("a", 1.0), ("a", 1.0)], "g string, x double")
    assert values(stats.zscore_mean(flat, ["g"], {"x": 1}), "score") == [(0.0,), (0.0,)]


def test_splits(spark):
    index = spark.createDataFrame([("A", 1, 2), ("B", 3, 3), ("C", -1, 4), ("D", 5, 5)], "id string, cluster_id_R int, cluster_id_L int")
    got = splits.proto_labels(index, spark.createDataFrame([("A",), ("D",)], "id string"), "id")
    assert values(got, "id", "split") == [("A", "proto-test"), ("B", "proto-train"), ("D", "proto-test")]
    df = spark.createDataFrame([("train", "t1"), ("test", "t2"), ("invalid", "t3"), ("val", "t4"), ("train", "t0")], "split string, id string")
    assert [r.id for r in splits.final_order(df, ["id"]).collect()] == ["t2", "t4", "t0", "t1", "t3"]
    assert splits.promote(df, 1, "id").where("split = 'test'").count() == 2
    passed, late = splits.representatives(spark.createDataFrame([(1, 3.0, "2020-01-01"), (2, 3.0, "2022-01-01"), (3, 9.0, "2022-01-01")], "id int, res double, date string"), {"resolution": F.col("res") <= 3.5}, "date", "2021-10-01")
    assert (passed.count(), late.count()) == (2, 1)


def test_leaderboard_with_missing_systems(spark):
    rows = [("m", f"s{s}", f"model_{r}", float(s * r % 5)) for s in range(3) for r in range(1, 5)]
    metrics = leaderboard.ranked(spark.createDataFrame(rows, "method string, id string, model_name string, DockQ double"))
    expected = spark.createDataFrame([("m", f"s{s}") for s in range(4)], "method string, id string")
    full = leaderboard.with_penalties(metrics, expected, ["method", "id"], {"DockQ": 0.0, "rank": 1, "model_name": "none"})
    assert full.where("penalised").count() == 1
    board = leaderboard.leaderboard(full, ["method"], "id", "DockQ", 2.0, (1, 4), "rank", "model_name").first()
    assert (board.n_systems, board.median_top1, board.hit_top1, board.median_top4) == (4, 0.5, 25.0, 2.0)
    with pytest.raises(Exception, match="no rank"):
        leaderboard.ranked(spark.createDataFrame([("x",)], "model_name string")).collect()


def test_loader(spark, tmp_path):
    index = spark.createDataFrame([("a", "train", True, 1.0), ("b", "test", False, None), ("c", "train", True, float("nan"))], "id string, split string, small boolean, x double")
    assert values(loader.load(index, split="train", subset="small", ids=["a", "b"]), "id") == [("a",)]
    assert values(loader.where_fields(index, {"x": ("is", None)}), "id") == [("b",), ("c",)]
    assert values(loader.where_fields(index, {"x": (">=", 0.5), "split": ("", "train")}), "id") == [("a",)]
    for bad in (("~", 1), [1, 2], ("<", None)):
        with pytest.raises(ValueError):
            loader.condition("x", bad)
    nulled = loader.load(index, steps=[loader.null_where(["split"], F.col("id") == "a"), loader.keep_where(F.col("small"))])
    assert values(nulled, "id", "split") == [("a", "train"), ("c", None)]
    done, runs = f"{tmp_path}/out", []

    def work(df):
        runs.append(df.count())
        return df.select("id")

    for settings in ({"r": 1}, {"r": 1}, {"r": 2}):
        assert loader.run_stage(index, done, ["id"], work, settings).count() == 3
    assert runs == [3, 0, 3]


def test_contacts_and_gaps_match_brute_force(spark):
    rng = np.random.default_rng(5)
    atoms = [(("A", "B", "C")[int(c)], int(r), "CA", "C", *map(float, p)) for c, r, p in zip(rng.integers(0, 3, 120), rng.integers(1, 30, 120), rng.uniform(0, 20, (120, 3)))]
    want = {(a[0], b[0], a[1], b[1]) for a in atoms for b in atoms if a[0] < b[0] and np.linalg.norm(np.array(a[4:]) - np.array(b[4:])) <= 4.5}
    df = spark.createDataFrame(atoms, "chain_id string, res_id int, atom_name string, element string, x double, y double, z double")
    assert set(values(structure.contacts(df), "chain1", "chain2", "res1", "res2")) == want
    residues = spark.createDataFrame([("A", k) for k in (1, 2, 5, 6, 10)], "c string, r int")
    assert values(structure.gaps(residues, ["c"], "r"), "start", "end", "size") == [(2, 5, 2), (6, 10, 3)]


def test_superposition_and_planes(spark):
    rng = np.random.default_rng(6)
    a = rng.normal(size=(20, 3)) * 5
    turn, _ = np.linalg.qr(rng.normal(size=(3, 3)))
    turn *= np.sign(np.linalg.det(turn))
    b = a @ turn + 7
    moved, shift = structure.fit(a, b)
    assert np.allclose(a @ moved + shift, b)
    df = spark.createDataFrame([("s", *map(float, p), *map(float, q)) for p, q in zip(a, b)], "id string, x double, y double, z double, x2 double, y2 double, z2 double")
    assert abs(structure.superposed_rmsd(df, ["id"]).first().rmsd) < 1e-6
    flat = spark.createDataFrame([("p", float(x), float(y), 1.0) for x in range(4) for y in range(4)], "id string, x double, y double, z double")
    assert structure.planarity(flat, ["id"]).first().planarity < 1e-6 and abs(structure.largest_variance(flat, ["id"]).first().max_var - 0.5) < 1e-9


def test_docking_scores_of_a_native_pose(spark):
    rng = np.random.default_rng(7)
    rows = []
    for chain, dx in (("R", 0.0), ("L", 6.0)):
        for res in range(1, 16):
            for k, name in enumerate(("N", "CA", "C", "O")):
                rows.append(("s", chain, res, name, name[0], dx + 0.3 * k + float(rng.normal()) / 5, 3.8 * res, float(rng.normal())))
    schema = "system string, chain_id string, res_id int, atom_name string, element string, x double, y double, z double"
    native = spark.createDataFrame(rows, schema)
    decoys = native.withColumn("model", F.lit("same")).unionByName(native.withColumn("model", F.lit("far")).withColumn("x", F.when(F.col("chain_id") == "L", F.col("x") + 40).otherwise(F.col("x"))))
    got = {r.model: r for r in structure.docking_scores(decoys, native).collect()}
    assert got["same"].DockQ > 0.999 and got["same"].CAPRI == "High"
    assert got["far"].Fnat == 0 and got["far"].CAPRI == "Incorrect" and 35 < got["far"].LRMS < 45


def test_sequence_alignment(spark):
    assert structure.identity("MKTAYIAKQR", "MKTAYIAKQR") == 1.0 and structure.identity("AAAA", "") == 0.0
    score, pairs = structure.align("AAKTAYIAKQRGG", "KTAYIAKQR")
    assert score == 45 and pairs[0] == (2, 0) and len(pairs) == 9
    df = spark.createDataFrame([("ACDEFGHIK", "ACDEGHIK"), (None, "A")], "a string, b string")
    assert [round(r[0], 3) for r in df.select(structure.sequence_identity()("a", "b")).collect()] == [1.0, 0.0]


def test_leak_reports(spark):
    train = spark.createDataFrame([("P", "Q"), ("R", "S")], "a string, b string")
    other = spark.createDataFrame([("Q", "P"), ("R", "T"), ("UNDEFINED", "X")], "a string, b string")
    assert tuple(leakage.leak_report(other, train, "a", "b").first()) == (3, 1, 33.333333)
    assert values(leakage.rows_in_pairs(other, leakage.pair_intersection(train, other, "a", "b"), "a", "b"), "a", "b") == [("Q", "P")]
