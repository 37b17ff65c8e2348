import random
import time

import public_tokenizers
from tokenizers import Tokenizer

from dyadlake.llm.token_counts import VOCABULARY, PrefixCounter, op4_token_counts, token_counts

from helpers import AWKWARD, frame

PATH = public_tokenizers.path(VOCABULARY)


def test_counts_match_the_library(spark):
    whole = Tokenizer.from_file(PATH)
    got = {r.doc_id: r for r in token_counts(frame(spark), PATH).collect()}
    assert len(got) == len(AWKWARD)
    for doc_id, text, *_ in AWKWARD:
        n = len(whole.encode(text or "", add_special_tokens=False).ids)
        r = got[doc_id]
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len((text or "").encode()), n > 2048)
        assert len(whole.encode((text or "")[: r.cut_at], add_special_tokens=False).ids) <= 2048


def test_every_prefix_is_exact():
    whole, state = Tokenizer.from_file(PATH), PrefixCounter(PATH)
    for text in ("Thenerating internationalisation, don't re-encode 42 things!", "éclair naïve Straße", "aaaaaaaaab  \n xyzzy"):
        want = [len(whole.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        assert state.prefix_counts(text) == want


def test_a_full_memo_does_not_change_counts():
    a, b = PrefixCounter(PATH, memo=3), PrefixCounter(PATH)
    text = "one two three four five six one two three seven eight"
    assert a.prefix_table(text).tolist() == b.prefix_table(text).tolist()


def test_empty_table(spark):
    assert token_counts(frame(spark, AWKWARD[:1]).limit(0), PATH).collect() == []


def test_prefixes_of_any_script_are_exact():
    whole, state = Tokenizer.from_file(PATH), PrefixCounter(PATH)
    texts = ("漢字テストである。日本語", "\U0001f600\U0001f601x\U0001f600", "don't we'll they've 'tis I'rex !'s ''s a'l'll", "e\u0301a\u0300\u0323x \u1100\u1161\u11a8가", "İSTANBUL ΣΑΣ ½Ⅷ٣४", "x<|endoftext|>y!!<|endof <|startoftext|><|endoftext|>'s", "QmFzZTY0/+abc==;{}();", "ไทยภาษา हिन्दी")
    for text in texts:
        want = [len(whole.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        assert state.prefix_counts(text) == want, text


def test_one_more_code_point_would_exceed_the_budget(spark):
    whole = Tokenizer.from_file(PATH)
    size = lambda t: len(whole.encode(t, add_special_tokens=False).ids)
    texts = ["漢字テスト" * 900, "x" * 20000, "a b " * 3000, "QmFz/ZTY0+9=" * 800, "word  " + "don't!" * 1200, "é" * 9000]
    rows = [(k, t, None, None, None) for k, t in enumerate(texts)]
    for r in token_counts(frame(spark, rows), PATH).collect():
        text = texts[r.doc_id]
        assert r.over_limit and size(text[: r.cut_at]) <= 2048 < size(text[: r.cut_at + 1])


class Splitter:
    """A tokenizer that normalises and splits, and encodes nothing."""

    def __init__(self, whole):
        self.normalizer, self.pre_tokenizer = whole.normalizer, whole.pre_tokenizer


def test_tables_of_units_are_the_librarys():
    whole, state = Tokenizer.from_file(PATH), PrefixCounter(PATH)
    state.tokenizer = Splitter(state.tokenizer)
    rng = random.Random(4)
    pieces = [v.removesuffix("</w>") for v in state.vocab if v.removesuffix("</w>").isascii()]
    words = list({"".join(rng.choice(pieces) for _ in range(rng.randrange(1, 5)))[:60].lower() for _ in range(4000)} | {"é" * k for k in range(1, 40)} | {"漢字" * k for k in range(1, 100)})
    words = [w for w in words if w and "<|" not in w and not any(c.isspace() for c in w)]
    assert state.chunk_counts(words).tolist() == [len(e.ids) for e in whole.encode_batch(words, add_special_tokens=False)]
    units = [w.encode() for w in words if w.isalpha() and w.isascii()][:300]
    cells, sizes = state.units.tables(units, True)
    for u, row, n in zip(units, cells, sizes):
        assert row[1 : n + 1].tolist() == [len(whole.encode(u[:i].decode(), add_special_tokens=False).ids) for i in range(1, n + 1)]


def test_a_long_chunk_is_answered_without_encoding():
    whole, state = Tokenizer.from_file(PATH), PrefixCounter(PATH)
    state.tokenizer = Splitter(state.tokenizer)
    for text in ("漢字テスト" * 20000, "abcxyz" * 17000, "A1/b+" * 20000):
        began = time.time()
        table = state.prefix_table(text)
        cut = state.fits(text, table, 2048)
        assert time.time() - began < 30
        assert int(table[-1]) == len(whole.encode(text, add_special_tokens=False).ids)
        size = lambda n: len(whole.encode(text[:n], add_special_tokens=False).ids)  # noqa: B023, E731
        assert size(cut) <= 2048 < size(cut + 1)


def test_the_query_on_whole_documents(spark):
    import pyarrow.parquet as pq

    whole = Tokenizer.from_file(PATH)
    rows = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pylist()
    got = {r.doc_id: r for r in op4_token_counts(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(rows)
    for r in rows:
        n = len(whole.encode(r["text"] or "", add_special_tokens=False).ids)
        assert (got[r["doc_id"]].n_tokens, got[r["doc_id"]].n_bytes, got[r["doc_id"]].over_limit) == (n, len((r["text"] or "").encode()), n > 2048)
