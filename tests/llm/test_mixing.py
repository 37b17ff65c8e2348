import heapq
import random
import re

from dyadlake.llm import mixing as mx

from helpers import AWKWARD, DOCS, frame


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, capped, left = {}, set(), float(sum(sizes.values()))
    while True:
        free = [s for s in names if s not in capped]
        if not free:
            break
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 3 * sizes[s]]
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        for s in over:
            capped.add(s)
            target[s] = 3.0 * sizes[s]
            left -= target[s]
    return target


def rows_of(n=400, seed=3):
    rng = random.Random(seed)
    return [(k, "w " * rng.choice([0, 1, 5, 300, 2000]), "en", rng.choice(["b", "b", "b", "a", "é", "z", None]) if k else "tiny", 0) for k in range(n)]


def test_targets_and_taken(spark):
    rows = rows_of()
    got = mx.mix_sources(frame(spark, rows)).collect()
    sizes, source = {}, {}
    for d, text, _, s, _ in rows:
        source[d] = s
        sizes[s] = sizes.get(s, 0) + len(re.findall(mx.WORD, text))
    want = brute_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - want[s]) <= 1e-6 * max(1, want[s])
        assert 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    assert len(got) == len(rows)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= mx.BLOCK * (1 + sizes[s] // mx.SHARD + 1), s
    assert sorted(map(tuple, got)) and {(r.doc_id, r.taken) for r in mx.mix_sources(frame(spark, rows)).collect()} == {(r.doc_id, r.taken) for r in got}


def test_apportionment_is_by_highest_quotients(spark):
    rng = random.Random(8)
    rows = []
    for g in range(12):
        seats = rng.choice([0, 1, 3, 50, 1000])
        rows += [(g, p, float(rng.choice([0, 1, 7, 7, 1000, 12345])), seats) for p in range(rng.randrange(1, 12))]
    got = {(r.g, r.p): r.won for r in mx.apportion(spark.createDataFrame(rows, "g int, p int, v double, s long"), ["g"], "p", "v", "s", "won").collect()}
    for g in range(12):
        mine = [(p, v, s) for q, p, v, s in rows if q == g]
        heap = [(-v, p, 0) for p, v, _ in mine if v > 0]
        heapq.heapify(heap)
        won = {p: 0 for p, *_ in mine}
        for _ in range(mine[0][2] if heap else 0):
            q, p, k = heapq.heappop(heap)
            won[p] += 1
            v = next(v for x, v, _ in mine if x == p)
            heapq.heappush(heap, (-v / (2 * k + 3), p, k + 1))
        assert {p: got[g, p] for p, *_ in mine} == won


def test_awkward_rows_and_empty_table(spark):
    got = mx.mix_sources(frame(spark)).collect()
    assert sorted(r.doc_id for r in got) == [d for d, *_ in AWKWARD]
    assert mx.mix_sources(frame(spark, AWKWARD[:1]).limit(0)).collect() == []
    none = mx.mix_sources(spark.createDataFrame([(1, None, None, "a", None), (None, "", None, None, None)], DOCS)).collect()
    assert sorted((r.size, r.taken, r.target) for r in none) == [(0, 0, 0.0)] * 2


def test_mixed_documents_are_whole_but_one_a_shard(spark):
    rng = random.Random(4)
    text = lambda k, n: " ".join(f"w{k}.{i}" for i in range(n))
    rows = [(k, text(k, rng.choice([40, 300, 900])), "en", rng.choice("abc"), 0) for k in range(120)]
    # alike in id and size: same source or not, same text or not
    rows += [(500, text(500 + k // 2, 700), "en", s, 0) for s in ("a", "a", None) for k in range(4)]
    got = mx.mixed_documents(frame(spark, rows)).collect()
    whole = {(r[0], r[1], r[3]) for r in rows}
    cut = [r for r in got if (r.doc_id, r.text, r.source) not in whole]
    assert len({r.source for r in cut}) == len(cut)
    taken = mx.mix_sources(frame(spark, rows)).collect()
    assert sum(0 < r.taken < r.size for r in taken) <= 4 and any(r.taken == 0 for r in taken)
    assert sum(len(r.text.split()) for r in got) == sum(r.taken for r in taken)
    for s in ("a", "b", "c", None):
        sizes = {d: len(t.split()) for d, t, _, q, _ in rows if q == s and d != 500}
        out = sum(len(r.text.split()) for r in got if r.source == s and r.doc_id != 500)
        assert out == sum(r.taken for r in taken if r.doc_id in sizes)
