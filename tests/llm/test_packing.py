import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from dyadlake.llm.packing import VOCABULARY, Encoder, Packer, op7_packing, pack

from helpers import AWKWARD, frame

PATH = public_tokenizers.path(VOCABULARY)


def check_round_trip(rows, ids_of):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r[0], []).append(r)
        by_seq.setdefault(r[5], []).append(r)
    assert set(by_doc) == set(ids_of)
    for doc_id, pieces in by_doc.items():
        at, raw = 0, np.array(ids_of[doc_id], "<u4").tobytes()
        for _, start, length, crc, total, *_ in sorted(pieces, key=lambda r: r[1]):
            assert start == at and length > 0 and total == len(ids_of[doc_id])
            assert crc == zlib.crc32(raw[4 * start : 4 * (start + length)])
            at += length
        assert at == len(ids_of[doc_id])
    padded = 0
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r[6]):
            assert r[6] == at
            at += r[2]
        capacity = pieces[0][7]
        assert at <= capacity and (at == capacity or capacity == 2048)
        padded += capacity - at
    return padded


def test_whole_texts_come_back(spark):
    whole = Tokenizer.from_file(PATH)
    rows = [tuple(r) for r in pack(frame(spark), PATH).collect()]
    padded = check_round_trip(rows, {d: [*whole.encode(t or "", add_special_tokens=False).ids, 1] for d, t, *_ in AWKWARD})
    assert padded <= 2048 * len({r[5] >> 36 for r in rows})


def test_windows_are_full_and_steps_balanced():
    rng = random.Random(3)
    ids = {d: [rng.randrange(50_000) for _ in range(rng.choice([1, 7, 200, 256, 900, 2048, 2049, 5000]))] for d in range(600)}
    packer = Packer(0, buffer=30_000)
    for d, x in ids.items():
        packer.take(d, np.array(x, "<u4").tobytes())
    packer.finish()
    assert check_round_trip(packer.rows, ids) < 2048
    steps = {}
    for r in packer.rows:
        steps.setdefault(r[8], {})[r[5]] = r[7]
    full = [sum(s.values()) for s in steps.values()]
    assert max(full) <= 64 * 2048 and min(full[:-1]) > 62 * 2048


def test_empty_table(spark):
    assert pack(frame(spark, AWKWARD[:1]).limit(0), PATH).collect() == []


def test_ids_are_the_librarys():
    whole, encode = Tokenizer.from_file(PATH), Encoder(PATH)
    rng = random.Random(9)
    parts = ["word", " ", "  ", "\n", "\t ", "don't", "'S", "été", "漢字", "12345", "½", "!?", "<|endoftext|>", "\x1c", "\u00a0", "\u3000", "\U0001f600", "\u0301", "_", "<|end", "\x85"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += ["a b " * 60_000, "x" * 150_000, " " * 120_000 + "y", "ab\n  " * 50_000]
    for text in texts:
        assert encode(text) == np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text[:80]


def test_no_sequence_of_many_short_partitions_is_padded(spark):
    whole = Tokenizer.from_file(PATH)
    rows = [tuple(r) for r in pack(frame(spark).repartition(7), PATH).collect()]
    assert check_round_trip(rows, {d: [*whole.encode(t or "", add_special_tokens=False).ids, 1] for d, t, *_ in AWKWARD}) == 0


def test_the_query_on_whole_documents(spark):
    import pyarrow.parquet as pq

    whole = Tokenizer.from_file(PATH)
    docs = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pylist()
    rows = [tuple(r) for r in op7_packing(spark, "/root/testdata/sf0.001").collect()]
    check_round_trip(rows, {d["doc_id"]: [*whole.encode(d["text"] or "", add_special_tokens=False).ids, 1] for d in docs})


def test_other_vocabulary_files_are_refused():
    with pytest.raises(ValueError):
        Encoder(public_tokenizers.path("word_bpe_49k.json"))
