import hashlib
import random
import re

import numpy as np

from dyadlake.llm import substring as ss

from helpers import AWKWARD, frame


def brute(rows, size=13):
    words = {r[0]: re.findall(r"[^\x20\x09-\x0D]+", r[1] or "") for r in rows}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - size + 1):
            first.setdefault(tuple(words[d][i : i + size]), d)
    out = {}
    for d, w in words.items():
        gone = set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < d:
                gone.update(range(i, i + size))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    return out


def test_matches_brute_force_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(ss, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(ss, "RANGE_BYTES", 9000)
    rng = random.Random(4)
    word = lambda: rng.choice("abcdefg") + rng.choice("xyzäö") * rng.randrange(3)
    passages = [[word() for _ in range(rng.choice([12, 13, 14, 60]))] for _ in range(8)]
    rows = []
    for d in rng.sample(range(1000), 150):
        text = []
        for _ in range(rng.randrange(5)):
            text += rng.choice(passages) if rng.random() < 0.4 else [word() + str(rng.randrange(10**6)) for _ in range(rng.randrange(60))]
        rows.append((d, rng.choice([" ", "\n", " \t"]).join(text), "en", "a", 1))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in ss.substring_dedup(frame(spark, rows)).collect()}
    assert got == brute(rows)


def test_awkward_rows_and_empty_table(spark):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in ss.substring_dedup(frame(spark)).collect()}
    assert got == brute(AWKWARD)
    assert ss.substring_dedup(frame(spark, AWKWARD[:1]).limit(0)).collect() == []
    long = " ".join(map(str, range(40)))
    same = [(5, long, None, None, None), (5, long, None, None, None), (None, long, None, None, None)]
    assert sorted(r.n_removed for r in ss.substring_dedup(frame(spark, same)).collect()) == [0, 0, 40]


def test_hot_and_missing_ids_are_dealt_in_parts(spark, monkeypatch):
    """An id and a missing one that each fill many blocks: no row of theirs dedups another, those of smaller ids dedup all."""
    monkeypatch.setattr(ss, "BLOCK_BYTES", 700)
    monkeypatch.setattr(ss, "RANGE_BYTES", 3000)
    rng = random.Random(9)
    line = lambda: " ".join(str(rng.randrange(10**6)) for _ in range(20))
    known, shared = line(), line()
    rows = [(k, line(), None, None, None) for k in range(40)] + [(3, known, None, None, None)]
    rows += [(50, t, None, None, None) for t in [shared] * 30 + [known] * 10] + [(60 + k, line(), None, None, None) for k in range(20)]
    rows += [(None, t, None, None, None) for t in [shared] * 30 + [line() for _ in range(30)]]
    edges, parts = ss._blocks([r.place for r in spark.createDataFrame([(r[0] if r[0] is not None else ss._LAST, len(r[1])) for r in rows], "place long, size long").coalesce(1).sortWithinPartitions("place").mapInArrow(ss._cuts(700), "place long").collect()])
    assert parts[np.searchsorted(edges, 50)] > 3 and parts[np.searchsorted(edges, ss._LAST)] > 3 and parts[0] == 1
    got = {}
    for r in ss.substring_dedup(frame(spark, rows)).collect():
        got.setdefault((r.doc_id, r.kept_text == ""), []).append(r.n_removed)
    assert got[50, True] == [20] * 10 and got[50, False] == [0] * 30  # copies of a smaller id's text; its own copies
    assert got[None, True] == [20] * 30 and got[None, False] == [0] * 30
    assert sum(map(len, got.values())) == len(rows) and all(v == [0] for (d, _), v in got.items() if d not in (3, 50, None))


def test_packed_hashes_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000):
        x = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        assert np.array_equal(ss.unpack_sorted(ss.pack_sorted(x)), x)
