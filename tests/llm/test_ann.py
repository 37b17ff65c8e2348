import numpy as np
from pyspark.sql import functions as F

from dyadlake.llm import ann

EVERY = "vec_id % 5 = 0"


def brute(rows, k):
    ok = {i: np.array(v, float) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)}
    out = {}
    for q, x in ok.items():
        if q % 5 == 0:
            scored = sorted((-float(x @ y), i) for i, y in ok.items() if i != q)
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_recall_and_exact_scores(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD", 60)
    monkeypatch.setattr(ann, "MOST", 70)
    monkeypatch.setattr(ann, "GROUP", 130)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 24))
    x = centres[rng.integers(0, 12, 1500)] + 0.4 * rng.normal(size=(1500, 24))
    x *= rng.uniform(0.2, 3, (1500, 1))  # lengths differ
    rows = [(k, v.astype(np.float32).tolist()) for k, v in enumerate(x)]
    got = found(ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), EVERY))
    want = brute(rows, 20)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (20 * len(want)) > 0.9  # over 22 shards and more
    table = dict(rows)
    for q, near in got.items():
        assert [(-s, i) for i, s in near] == sorted((-s, i) for i, s in near)
        for i, s in near:
            assert abs(s - np.dot(np.array(table[q], float), np.array(table[i], float))) < 1e-9


def test_same_vectors_and_awkward_rows(spark):
    rows = [(k, [1.0, 2.0]) for k in range(60)] + [(100, None), (105, [0.0, 0.0]), (110, [None, 1.0]), (115, [float("nan"), 1.0]), (120, [float("inf"), 0.0]), (125, []), (130, [2.0, 1.0]), (130, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1)).withColumn("shard", F.lit(2))
    got = found(ann.nearest(df, EVERY))
    ok = {k: v for k, v in rows if k < 60 or k == 130}
    assert got == brute(list(ok.items()), 20)
    assert got[0] == [(i, 5.0) for i in range(1, 21)]
    few = found(ann.nearest(df.where("vec_id in (0, 5, 130)"), EVERY))
    assert {q: [i for i, _ in v] for q, v in few.items()} == {0: [5, 130], 5: [0, 130], 130: [0, 5]}
    assert ann.nearest(df.limit(0), EVERY).collect() == []


def test_doubles_keep_their_digits_and_range(spark):
    rng = np.random.default_rng(8)
    rows = [(k, rng.normal(size=6).tolist()) for k in range(80)] + [(200, [1e200, 0.0, 1.0, 0.0, 0.0, 0.0]), (201, [1 / 3, 0.1, 1e-9, 0.7, 0.2, 0.3])]
    got = found(ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), EVERY))
    want = brute(rows, 20)
    assert got.keys() == want.keys() and got[200][0] == want[200][0]
    table = dict(rows)
    for q, near in got.items():
        for i, s in near:
            assert s == float(np.einsum("d,d->", np.array(table[q]), np.array(table[i]))) or abs(s - np.dot(table[q], table[i])) <= 1e-12 * abs(s)
    plain = [r for r in rows if r[0] < 200]
    got = found(ann.nearest(spark.createDataFrame(plain, "vec_id long, embedding array<double>"), EVERY))
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in brute(plain, 20).items()}


def test_the_query_recalls_the_whole_table(spark, monkeypatch):
    """Recall of the registered query, with shards small enough to have many."""
    import pyarrow.parquet as pq

    monkeypatch.setattr(ann, "SHARD", 90)
    monkeypatch.setattr(ann, "MOST", 90)
    rows = pq.read_table("/root/testdata/sf0.1/embeddings.parquet").to_pylist()
    x = np.array([r["embedding"] for r in rows], float)
    ids = np.array([r["vec_id"] for r in rows])
    got = found(ann.op2_nearest_neighbours(spark, "/root/testdata/sf0.1"))
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        sims = x @ x[q]
        sims[q] = -np.inf
        best = ids[np.lexsort((ids, -sims))[:20]]
        hits += len(set(best.tolist()) & {i for i, _ in got[int(ids[q])]})
        total += 20
    assert len(got) == (ids % 20 == 0).sum() and hits / total >= 0.9
