"""Cases at the edges of the operators: missing values, long runs, repeated keys, stored orders."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from dyadlake.functions import ids, scoring
from dyadlake.operators import annotate, leakage, loader, rel, stats, structure
from dyadlake.operators.tables import Scratch, shared_dir, stored
from dyadlake.sources.tables import read_delimited


def test_missing_values_differ_from_every_value(spark):
    df = spark.createDataFrame([(None,), (5.0,), (float("nan"),), (7.0,)], "x double")
    keep = lambda op, v: sorted(str(r.x) for r in loader.where_fields(df, {"x": (op, v)}).collect())
    assert keep("!=", 5.0) == ["7.0", "None", "nan"] and keep("is not", 5.0) == ["7.0", "None", "nan"]
    assert keep("==", 5.0) == ["5.0"] and keep(">", 1.0) == ["5.0", "7.0"] and keep("!=", None) == ["5.0", "7.0"]


def test_natural_order_of_long_digit_runs(spark):
    names = ["a1234567890124", "a1234567890123", "a2", "a002b", "A10", "a" + "9" * 40, "a1" + "0" * 40]
    got = [r.x for r in spark.createDataFrame([(n,) for n in names], "x string").orderBy(ids.natural_key("x"), "x").collect()]
    assert got == ["a2", "a002b", "A10", "a1234567890123", "a1234567890124", "a" + "9" * 40, "a1" + "0" * 40]


def test_models_and_entries_parse_by_their_own_rules(spark):
    names = ["af__Q9UKT9_12_345", "af__Q9UKT9", "1abc__A1_P12345-R", "af__P00533-2", "1abc__B2_P12345-2-L"]
    rows = spark.createDataFrame(list(enumerate(names)), "k int, x string").select("k", ids.parse_monomer("x").alias("m")).orderBy("k").select("m.*").collect()
    assert [tuple(r) for r in rows] == [
        ("af", "A", "Q9UKT9", 12, 345, None),
        ("af", None, "Q9UKT9", None, None, None),
        ("1abc", "A1", "P12345", None, None, "R"),
        ("af", None, "P00533-2", None, None, None),
        ("1abc", "B2", "P12345-2", None, None, "L"),
    ]


def test_the_word_none_is_text(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\nNone,NA\nnull,n/a\n")
    assert [tuple(r) for r in read_delimited(spark, str(tmp_path / "t.csv")).collect()] == [("None", "NA"), (None, None)]


def test_refined_fit_judges_squared_distances():
    rng = np.random.default_rng(4)
    a = rng.normal(size=(60, 3))
    b = a + rng.normal(scale=0.1, size=a.shape) * rng.choice([1, 1, 1, 2.2], 60)[:, None]
    mask = np.ones(60, bool)
    for _ in range(5):
        turn, shift = structure.fit(a[mask], b[mask])
        d = ((a @ turn + shift - b) ** 2).sum(1)
        q1, q3 = np.quantile(d[mask], [0.25, 0.75])
        kept = mask & (d <= q3 + 1.5 * (q3 - q1))
        if (kept == mask).all():
            break
        mask = kept
    assert (structure.refined_fit(a, b)[2] == mask).all() and not mask.all()


def test_difficulty_and_planes_of_too_little(spark):
    df = spark.createDataFrame([(None, 0.1), (1.0, 0.1), (1.0, 0.5), (2.0, 0.9), (3.0, 0.0)], "i double, f double")
    assert [r[0] for r in df.select(scoring.difficulty(F.col("i"), F.col("f"))).collect()] == ["Difficult", "Rigid-body", "Medium", "Medium", "Difficult"]
    points = spark.createDataFrame([("a", 0.0, 0.0, 0.0), ("a", 1.0, 0.0, 0.0), ("b", 0.0, 0.0, 0.0), ("b", 1.0, 0.0, 0.0), ("b", 0.0, 1.0, 0.0)], "g string, x double, y double, z double")
    got = {r.g: r.planarity for r in structure.planarity(points, ["g"]).collect()}
    assert got["a"] == -1.0 and abs(got["b"]) < 1e-9


def test_repeated_keys_never_multiply_rows(spark):
    left = spark.createDataFrame([(1, "A"), (2, "b"), (3, "Zq")], "k int, chain string")
    right = spark.createDataFrame([("A", 5), ("A", 3), ("B", 9), ("B", 8), (None, 1)], "chain string, hit int")
    got = rel.fallback_join(left, right, "chain", [F.col("chain"), F.upper("chain")], ["hit"]).orderBy("k").collect()
    assert [(r.k, r.hit, r.matched_by) for r in got] == [(1, 3, 0), (2, 8, 1), (3, None, None)]
    one = left.withColumn("g", F.lit(1))
    many = right.where("chain is not null").withColumn("g", F.lit(1))
    got = annotate.cascade_match(one, many, ["g"], "chain", ["hit"]).orderBy("k").collect()
    assert [(r.k, r.hit) for r in got] == [(1, 3), (2, 8), (3, None)]


def test_running_totals_are_those_of_one_order(spark):
    df = spark.range(5000).select(F.col("id"), F.pmod(F.xxhash64("id"), F.lit(97)).alias("v"))
    got = [r.total for r in stats.running_total(df, [F.col("v"), F.col("id")], "v", "total", 7).orderBy("v", "id").collect()]
    assert got == np.cumsum(sorted(r.v for r in df.collect())).tolist()


def test_ordered_concat_of_whole_groups(spark):
    df = spark.range(3000).select((F.col("id") % 2).alias("g"), "id")
    got = {r.g: (r["first"], r.others) for r in rel.ordered_concat(df, ["g"], "id", ["id"]).collect()}
    assert got[0] == (0, ";".join(str(k) for k in range(2, 3000, 2))) and got[1][0] == 1


def test_shared_windows_match_plain_sets(spark):
    docs = [(1, "a b c d e f g h i j"), (2, "x A B c d e f g h"), (3, None), (4, ""), (5, "a b")]
    items = [(10, "b c d e f g h i"), (11, "q r s"), (12, "a b")]
    cut = lambda t: {tuple(w[i : i + 8]) for w in [(t or "").lower().split()] for i in range(max(1, len(w) - 7))} if t is not None else set()
    want = {(d, i): len(cut(x) & cut(y)) for d, x in docs for i, y in items if cut(x) & cut(y)}
    got = leakage.shared_windows(spark.createDataFrame(docs, "doc int, text string"), spark.createDataFrame(items, "item int, text string"), "doc", "item", "text")
    assert {(r.doc, r.item): r.n_shared for r in got.collect()} == want


def test_scopes_delete_what_they_hold(spark):
    path = lambda t: t.inputFiles()[0].rsplit("/", 1)[0]
    exists = lambda p: __import__("os").path.exists(p.removeprefix("file://"))
    with Scratch() as s:
        gone, kept = s.store(spark.range(3), "t"), s.keep(s.store(spark.range(4), "t"))
        where = path(gone), path(kept)
        assert all(map(exists, where))
    assert not exists(where[0]) and exists(where[1]) and kept.count() == 4
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert stored(spark.range(5).groupBy().count(), "t").first()[0] == 5


def test_a_cluster_must_name_its_shared_folder():
    class Conf(dict):
        def get(self, key, default=None):
            return super().get(key, default)

    class Session:
        conf = Conf({"spark.master": "spark://host:7077"})

    with pytest.raises(ValueError):
        shared_dir(Session())
