import random
from itertools import combinations

from pyspark.sql import functions as F

from dyadlake.llm import line_dedup as ld
from dyadlake.llm.components import components
from dyadlake.llm.store import Scratch, materialize

from helpers import AWKWARD, DOCS, frame


def shingles(norm):
    return {norm[k : k + 5] for k in range(max(1, len(norm) - 4))}


def removed(rows):
    """{(id, text): line numbers that go} by comparing all lines with all lines."""
    lines = {}
    for d, text, *_ in rows:
        for k, line in enumerate((text or "").split("\n")):
            if line.strip(" \t\n\x0b\x0c\r"):
                lines[float("inf") if d is None else d, k, text] = line.strip(" ").lower()
    sets = {x: shingles(x) for x in set(lines.values())}
    label = {x: x for x in sets}
    for a, b in combinations(sets, 2):
        n = len(sets[a] & sets[b])
        if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n) and label[a] != label[b]:
            lo, hi = sorted((label[a], label[b]))
            label = {x: lo if c == hi else c for x, c in label.items()}
    first = {}
    for at in sorted(lines):
        first.setdefault(label[lines[at]], at)
    gone = {(d, text): [] for d, text, *_ in rows}
    for d, k, text in sorted(lines):
        if first[label[lines[d, k, text]]] != (d, k, text):
            gone[None if d == float("inf") else d, text].append(k)
    return gone


def brute(rows):
    gone = removed(rows)
    return {d: None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[d, t]) for d, t, *_ in rows}


def corpus(seed=2):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijké") for _ in range(rng.randrange(2, 8)))
    bases = [[word() for _ in range(rng.choice([1, 5, 12, 40]))] for _ in range(8)]
    bases += [["".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(60))], ["".join(rng.choice("qrstuvwx") for _ in range(47))]]
    rows = []
    for d in rng.sample(range(500), 90):
        lines = []
        for _ in range(rng.randrange(1, 6)):
            w = list(rng.choice(bases)) if rng.random() < 0.6 else [word() for _ in range(rng.randrange(1, 30))]
            for _ in range(rng.randrange(3) if len(w) > 10 else 0):
                w[rng.randrange(len(w))] = word()
            if len(w) == 1 and rng.random() < 0.4:
                w = [w[0][:-1] + rng.choice("yz")]
            lines.append(rng.choice(["", " "]) + " ".join(w) + rng.choice(["", ".", " "]))
        rows.append((d, "\n".join(lines), "en", "a", 0))
    return rows


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ld, "BLOCK", 5)
    rows = corpus()
    got = {r.doc_id: r.text for r in ld.drop_duplicate_lines(frame(spark, rows)).collect()}
    assert got == brute(rows)


def test_the_query_matches_brute_force(spark, tmp_path):
    rows = [*((d + 1000, *r) for d, *r in corpus(seed=4)), *AWKWARD, AWKWARD[5], (None, AWKWARD[5][1], None, None, None), (4, "another text of that id\nword", None, None, None)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_lines, r.n_removed, r.removed_lines) for r in ld.op8_line_dedup(spark, str(tmp_path)).collect())
    gone = removed(rows)
    want = sorted((d is None, d or 0, 0 if t is None else t.count("\n") + 1, len(gone[d, t]), gone[d, t]) for d, t, *_ in rows)
    assert got == want


def test_awkward_rows_pass_through(spark):
    df = frame(spark)
    got = ld.drop_duplicate_lines(df)
    assert got.columns == df.columns
    assert {r.doc_id: r.text for r in got.collect()} == brute(AWKWARD)
    assert ld.drop_duplicate_lines(df.limit(0)).collect() == []


def test_rows_repeated_in_full_stay_alike(spark):
    row = (3, "a line of some length that is here twice\nshort", None, None, None)
    got = ld.drop_duplicate_lines(frame(spark, [row, row, (None, row[1], None, None, None)])).collect()
    assert sorted(((r.doc_id or 0), r.text) for r in got) == [(0, ""), (3, row[1]), (3, row[1])]


def test_scripts_without_spaces(spark):
    a = "".join(chr(0x4E00 + 37 * k) for k in range(60))
    b = "abcdefghijklmnopqrstuvwxyzabcdefghijklmnopqrstu"
    rows = [(1, a), (2, a[:30] + "漢" + a[31:]), (3, b), (4, b[:-1] + "!"), (5, "ab"), (6, "AB "), (7, "x")]
    got = {r.doc_id: r.text for r in ld.drop_duplicate_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: a, 2: "" if 51 * 100 >= 85 * 61 else rows[1][1], 3: b, 4: "", 5: "ab", 6: "", 7: "x"}


def test_signatures_follow_the_sets(spark):
    """Bands depend on the set of shingles alone, and lines under the similarity seldom share one."""
    rows = [(1, "hello there, this is a line\nab" + "ab" * 300 + "\n" + "ab" * 200 + "\né")]
    got = {r.line_no: r["keys"] for r in ld.signatures(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(len(k) == ld.BANDS for k in got.values()) and got[1] == got[2] and not set(got[0]) & set(got[1])


def test_inner_members_meet_in_blocks(spark, monkeypatch):
    """Two families whose ends lie in neither: only the members between can connect them."""
    for block in (1024, 4):
        monkeypatch.setattr(ld, "BLOCK", block)
        rng = random.Random(5)
        line = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
        a, b = line(160), line(160)
        family = [a[:k] + "!" + a[k + 1 :] for k in (5, 25, 45, 65)] + [b[:k] + "?" + b[k + 1 :] for k in (5, 25, 45, 65)]
        texts = dict(enumerate(["x" * 50, *family, "y" * 50]))
        members = spark.createDataFrame([(7, n, 0, 9, 10) for n in texts], "key long, node long, low long, high long, n long")
        with Scratch() as s:
            known = [(n, t, len(shingles(t))) for n, t in texts.items()]
            links = ld.confirmed(members, spark.createDataFrame(known, "node long, norm string, n int"), 85, s)
            got = {r.node: r.root for r in components(links, "a", "b").collect()}
        assert got == {**dict.fromkeys(range(1, 5), 1), **dict.fromkeys(range(5, 9), 5)}


def test_texts_travel_for_near_pairs_only(spark, monkeypatch):
    """Lines that share a bucket and little else are told apart by size and sketch."""
    rng = random.Random(11)
    near = "".join(rng.choice("abcdefghijklmnop") for _ in range(300))
    other = ["".join(rng.choice("abcdefghijklmnop") for _ in range(300)) for _ in range(30)]
    texts = dict(enumerate([*other, near, near[:150] + "!" + near[151:], near[:-1]]))
    members = spark.createDataFrame([(7, n, 0, len(texts) - 1, len(texts)) for n in texts], "key long, node long, low long, high long, n long")
    asked, verified = [], ld._verified
    monkeypatch.setattr(ld, "_verified", lambda pairs, *rest: (asked.extend((r.a, r.b) for r in pairs.collect()), verified(pairs, *rest))[1])
    with Scratch() as s:
        links = ld.confirmed(members, spark.createDataFrame([(n, t, len(shingles(t))) for n, t in texts.items()], "node long, norm string, n int"), 85, s)
        assert {(r.a, r.b) for r in links.collect()} == {(30, 32), (31, 32)}
    assert set(asked) == {(30, 32), (31, 32)}  # all members with the ends 0 and 32: 63 pairs


def test_keys_are_shuffled_once(spark):
    signed = ld.signatures(spark.createDataFrame(corpus(seed=3), DOCS))
    buckets = ld._buckets(signed)
    buckets.collect()
    plan = buckets._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert len({x.split("plan_id=")[1] for x in plan.splitlines() if "Exchange hashpartitioning(key" in x and "Reused" not in x}) == 1


def test_rows_of_lone_keys_are_not_sorted(spark):
    buckets = ld._buckets(ld.signatures(spark.createDataFrame(corpus(seed=3), DOCS)))
    assert buckets.collect()
    plan = buckets._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_bands_are_the_distinct_hashes_after_a_point(spark):
    """Plain runs, runs with repeats, runs over other points and lines of few shingles, against the definition."""
    rng = random.Random(17)
    lines = ["".join(rng.choice("abcdefgh") for _ in range(n)) for n in (3, 5, 8, 11, 20, 40, 90, 300, 1500)]
    lines += [x[:40] * 6 for x in lines[5:]] + ["ab" * 300, "漢字" * 9 + lines[6]]
    docs = spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string")
    hashes = spark.createDataFrame(list(enumerate(lines)), "line_no int, norm string").select("line_no", ld._hashes(F.col("norm")).alias("h"))
    bands = []
    for r in hashes.collect():
        ring = sorted(set(r.h))
        for k, p in enumerate(ld._POINTS):
            after = [h for h in ring if h > p] + [h for h in ring if h < p]
            bands.append((r.line_no, k, after[: ld.ROWS]))
    want = spark.createDataFrame(bands, "line_no int, k int, band array<long>").select("line_no", "k", F.xxhash64("k", "band").alias("key"))
    got = {(r.line_no, k): x for r in ld.signatures(docs).collect() for k, x in enumerate(r["keys"])}
    assert got == {(r.line_no, r.k): r.key for r in want.collect()}


def test_shingles_are_runs_of_code_points(spark):
    lines = ["abcdefgh", "abc", "", "\U0001f600\U0001f600é漢字abcdefgh", "aaaaaaaaaaaa"]
    got = spark.createDataFrame([(x,) for x in lines], "norm string").select("norm", F.array_distinct(ld._hashes(F.col("norm"))).alias("h")).collect()
    assert [len(r.h) for r in got] == [len(shingles(x)) for x in lines]


def test_leaves_no_tables_behind(spark, tmp_path):
    spark.createDataFrame(corpus(seed=9), DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = materialize(ld.drop_duplicate_lines(docs), "t")
    assert kept.count() == docs.count()
