import random
from itertools import combinations

import numpy as np

from dyadlake.llm import near_dedup as nd
from dyadlake.llm.components import components
from dyadlake.llm.store import Scratch, materialize

from helpers import AWKWARD, DOCS, frame


def shingles(text):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    sets = {r[0]: shingles(r[1]) for r in rows}
    label = {d: d for d in sets}
    for a, b in combinations(sets, 2):
        n = len(sets[a] & sets[b])
        if n and 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((label[a], label[b]))
            label = {d: x if c == y else c for d, c in label.items()}
    return {d: (len(sets[d]), label[d], label[d] == d) for d in sets}


def corpus(seed=1, groups=12, singles=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    rows = []
    for g in range(groups):
        base = [word() for _ in range(rng.choice([4, 5, 30, 120, 300]))]
        for _ in range(rng.choice([2, 5, 25])):
            t = list(base)
            for _ in range(rng.randrange(0, 1 + len(t) // 25)):
                t[rng.randrange(len(t))] = word().upper()
            rows.append(" ".join(t))
    rows += [" ".join(word() for _ in range(rng.randrange(1, 200))) for _ in range(singles)]
    rng.shuffle(rows)
    return [(k + 1, t, "en", "a", len(t)) for k, t in enumerate(rows)]


def test_components_match_brute_force(spark):
    rows = corpus()
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in nd.near_dedup(frame(spark, rows)).collect()}
    assert got == brute(rows)


def test_awkward_rows_and_empty_table(spark):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in nd.near_dedup(frame(spark)).collect()}
    assert got == brute(AWKWARD)
    assert nd.near_dedup(frame(spark, AWKWARD[:1]).limit(0)).collect() == []
    twice = spark.createDataFrame([(None, "a b c d e f", None, None, None), (3, "a b c d e f", None, None, None), (3, "x y", None, None, None)], DOCS)
    assert sorted((r.n_shingles, r.component_id) for r in nd.near_dedup(twice).collect()) == [(1, 3), (2, 3), (2, 3)]


def test_every_pair_under_the_distance_meets(spark, monkeypatch):
    """The pigeonhole guarantee, with buckets dealt as pairs of small blocks: near pairs end in one cluster."""
    monkeypatch.setattr(nd, "BLOCK", 7)
    rng = np.random.default_rng(2)
    sigs = []
    for _ in range(4):
        base = rng.integers(0, 1 << 16, nd.SYMBOLS).astype("<u2")
        for _ in range(30):
            s = base.copy()
            at = rng.permutation(nd.SYMBOLS)[: rng.integers(0, 24)]
            s[at] = rng.integers(0, 1 << 16, len(at))
            sigs.append(s)
    df = spark.createDataFrame([(k, 100, bytearray(s.tobytes())) for k, s in enumerate(sigs)], "node long, n_shingles long, signature binary")
    links = materialize(nd.near_links(df, Scratch()), "t")
    near = {(r.a, r.b) for r in links.collect()}
    assert all((sigs[a] != sigs[b]).sum() <= nd.MAX_WRONG for a, b in near)
    root = {r.node: r.root for r in components(links, "a", "b").collect()}
    close = 0
    for a, b in combinations(range(len(sigs)), 2):
        if (sigs[a] != sigs[b]).sum() <= nd.MAX_WRONG:
            close += 1
            assert root[a] == root[b]
    assert close > 300


def test_clusters_dealt_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(nd, "CLUSTER", 6)
    monkeypatch.setattr(nd, "BLOCK", 9)
    rows = corpus(seed=7, groups=5, singles=10)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in nd.near_dedup(frame(spark, rows)).collect()}
    assert got == brute(rows)


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()}
    assert got == {**{k: 1 for k in range(1, 41)}, **{k: 100 for k in range(100, 140)}, 200: 200, 201: 200}


def test_signatures_under_the_threshold_share_a_key():
    """Worst cases of the pigeonhole: the errors dealt evenly over the chunks, one chunk spared an error."""
    rng = np.random.default_rng(4)
    for _ in range(300):
        one = rng.integers(0, 1 << 16, nd.SYMBOLS).astype("<u2")
        other = one.copy()
        spared = rng.integers(nd.CHUNKS)
        for c in range(nd.CHUNKS):
            for p in rng.permutation(nd.WIDTH)[: 1 if c == spared else 2]:
                other[c * nd.WIDTH + p] ^= 1 << rng.integers(16)
        assert (one != other).sum() == nd.MAX_WRONG
        x, y = nd.index_keys(np.array([one, other]))
        assert (x == y).any()


def test_rows_without_ids_are_no_single_key(spark):
    same = " ".join(f"word{k}" for k in range(60))
    rows = [(None, f"text number {k} {same}") for k in range(60)] + [(5, f"text number 3 {same}")]
    got = nd.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 61 and {r.component_id for r in got} == {5}
