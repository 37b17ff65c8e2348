"""Registered queries over whole tables of the smallest scale, against plain recounts."""

import re
import zlib

import numpy as np
import pyarrow.parquet as pq

from dyadlake.llm import mixing, registry

from test_pii import whole
from test_quality import plain

DIR = "/root/testdata/sf0.001"


def documents():
    return pq.read_table(f"{DIR}/documents.parquet").to_pylist()


def rows(spark, name):
    return registry.queries()[name](spark, DIR).collect()


def test_personal_data(spark):
    docs, got = {d["doc_id"]: d["text"] for d in documents()}, rows(spark, "op3_pii")
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        counts, sha, base = whole((r.doc_id, docs[r.doc_id]))
        spans = [s for s in r.spans.split(",") if s]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts and r.base_sha256 == sha and base <= set(spans)
        assert r.n_spans == len(spans) == sum(counts) + r.n_added
        # every planted secret that an added span holds is one in the text
        for kind, start, end in (s.split(":") for s in spans):
            assert kind != "secret" or re.fullmatch(r"[A-Za-z0-9+/=_-]{16,}", docs[r.doc_id][int(start) : int(end)])


def test_mix(spark):
    docs = {d["doc_id"]: d for d in documents()}
    got = rows(spark, "op6_mixing")
    assert sorted(r.doc_id for r in got) == sorted(docs)
    size = {d: len(re.findall(mixing.WORD, x["text"] or "")) for d, x in docs.items()}
    sources = sorted({x["source"] for x in docs.values() if x["source"] is not None}) + [None] * any(x["source"] is None for x in docs.values())
    total = {s: sum(size[d] for d, x in docs.items() if x["source"] == s) for s in sources}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    target, open_, left = {}, set(sources), float(sum(total.values()))
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * total[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3 * total[s]
            left -= target[s]
        open_ -= over
    taken = dict.fromkeys(sources, 0)
    for r in got:
        s = docs[r.doc_id]["source"]
        assert r.size == size[r.doc_id] and r.source_size == total[s] and abs(r.target - target[s]) < 1e-6 * max(1, target[s]) and 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) <= 2 * mixing.BLOCK + 1 for s in sources)


def test_quality_scores(spark):
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table("/root/testdata/sf0.01/labels.parquet").to_pylist()}
    got = registry.queries()["op9_quality_classifier"](spark, "/root/testdata/sf0.01").collect()
    assert len(got) == pq.read_table("/root/testdata/sf0.01/documents.parquet").num_rows
    held = [r for r in got if r.doc_id in labels and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(r.held_out for r in held) and np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.95


def test_quality_rules(spark):
    docs = {d["doc_id"]: d["text"] for d in documents()}
    got = rows(spark, "op10_quality_rules")
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        want = plain(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and not (r.kept and r.base_failed)
    assert any(r.kept for r in got)
