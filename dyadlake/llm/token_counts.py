"""Token counts (operator 4): prefix dynamic programming.

A text's token count is stored at every prefix, so a truncation point or a
budget question is a lookup, never another encoding.  Two tables compose:

* units (words, digits, runs of signs, contractions) tokenise independently, so
  the count at a unit's end is the count at the one before plus the unit's;
  chunks between white space are what is remembered of them;
* inside a unit, a table has one cell a symbol (byte): the encoding of a prefix
  is that of a shorter prefix plus one last token, and that token is the only
  vocabulary entry that ends there and forms a stable pair with the shorter
  prefix's last token.  ``UnitTables`` fills the cells of many units side by
  side, ``_Prefix`` those of one that grows.

The vocabulary file is all that is used: nothing is encoded by the library, which
normalises and splits chunks beyond ASCII.  A truncation point goes by chunks to
the one that crosses the budget, and on by symbols inside it.

Null and empty texts count no tokens.  A repeated chunk or unit is looked up
while it stays in a bounded memo.  Extra columns of the input are not read.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import documents

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
#: Chunks whose counts a worker remembers; older ones are counted again when seen again.
MEMO = 1_000_000
#: Units of like lengths that are filled side by side.
SIDE = 8192
#: Symbols from which a unit is filled on its own.
LONG = 256

_CHUNK = re.compile(r"[^\s]+")
#: White space to ``str.split`` but not to the tokenizer.
_SEPARATORS = re.compile(r"[\x1c-\x1f]")
_ASCII_CHUNK = re.compile(r"[^\x20\x09-\x0d]+")
_ASCII_UNITS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^0-9a-z]+")
#: The split of the vocabulary file that ``_ASCII_UNITS`` is for lower-case ASCII.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Letters that form a unit with an apostrophe before them.
_CONTRACTIONS = frozenset(("s", "t", "re", "ve", "m", "ll", "d"))


def _joins(c: str) -> bool:
    """Whether normalisation may change this code point or those before it when they meet."""
    return unicodedata.category(c)[0] == "M" or "\u1160" <= c <= "\u11ff"


class _Lookup:
    """uint64 keys to ids by arrays; -1 where a key is absent."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray):
        self.shift = np.uint64(64 - max(4, int(len(keys)).bit_length() + 2))
        place = self._place(keys)
        order = np.argsort(place, kind="stable")
        place, keys, ids = place[order], keys[order], ids[order]
        rank = np.arange(len(place)) - np.searchsorted(place, place)
        size = 1 << (64 - int(self.shift))
        self.keys = np.zeros((int(rank.max()) + 1 if len(rank) else 1, size), np.uint64)
        self.ids = np.full(self.keys.shape, -1, np.int32)
        self.keys[rank, place], self.ids[rank, place] = keys, ids

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        place = self._place(keys)
        out = np.full(len(keys), -1, np.int32)
        for row, ids in zip(self.keys, self.ids):
            out = np.maximum(out, np.where(row[place] == keys, ids[place], -1))  # an empty slot's key is 0, its id -1
        return out


class UnitTables:
    """The prefix tables of many units (byte strings) at once, for a word-end BPE vocabulary."""

    _BASE = np.uint64(0x100000001B3)

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str):
        self.alphabet = byte_alphabet()
        to_byte = {c: b for b, c in self.alphabet.items()}
        n = max(vocab.values()) + 1
        self.left, self.right, self.rank = np.arange(n), np.arange(n), np.full(n, -1)
        keys, made = [], []
        for k, (x, y) in enumerate(merges):
            t = vocab[x + y]
            self.left[t], self.right[t], self.rank[t] = vocab[x], vocab[y], k
            keys.append(vocab[x] << 32 | vocab[y])
            made.append(t)
        self.pairs = _Lookup(np.array(keys, np.uint64), np.array(made, np.int32))
        # a token of the file is one of the encoding only if no earlier merge breaks it up
        sound = self._stable(self.left, self.right, self.rank) & (self.rank >= 0)
        self.sound = sound | (self.rank < 0)
        for t in np.argsort(self.rank, kind="stable").tolist():
            if self.rank[t] >= 0:
                self.sound[t] &= self.sound[self.left[t]] & self.sound[self.right[t]]
        tables: dict[bool, tuple[list[int], list[int]]] = {False: ([], []), True: ([], [])}
        self.longest = 1
        for token, t in vocab.items():
            closed = bool(end) and token.endswith(end) and token != end
            raw = [to_byte.get(c, -1) for c in (token[: -len(end)] if closed else token)]
            if min(raw) >= 0 and self.sound[t]:
                self.longest = max(self.longest, len(raw))
                tables[closed][0].append(self._hash(raw))
                tables[closed][1].append(t)
        self.open, self.closed = (_Lookup(np.array(k, np.uint64), np.array(v, np.int32)) for k, v in (tables[False], tables[True]))
        self.power = np.array([pow(int(self._BASE), k, 1 << 64) for k in range(self.longest + 1)], np.uint64)

    def _hash(self, raw: list[int]) -> int:
        out = 0
        for b in raw:
            out = (out * int(self._BASE) + b + 1) & 0xFFFFFFFFFFFFFFFF
        return out

    def _stable(self, one: np.ndarray, two: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge of a rank below ``limit`` joins the end of one token's symbols to the start of the other's.

        The tokens are taken apart in the reverse order of their merges; whatever
        stands on both sides of the border then must not be a pair that merges
        before the part that has just been undone.
        """
        one, two = one.astype(np.int64), two.astype(np.int64)
        limit = np.full(len(one), np.iinfo(np.int64).max) if limit is None else limit.astype(np.int64)
        # an equal rank undone on the left happened before, one on the right after
        limit = limit * 2 if len(limit) and limit.max() < 1 << 40 else limit
        out, at = np.ones(len(one), bool), np.arange(len(one))
        while len(at):
            made = self.pairs(one[at].astype(np.uint64) << np.uint64(32) | two[at].astype(np.uint64))
            breaks = (made >= 0) & (2 * self.rank[made] < limit[at])
            out[at[breaks]] = False
            at = at[~breaks]
            x, y = self.rank[one[at]], self.rank[two[at]]
            at = at[(x >= 0) | (y >= 0)]
            x, y = self.rank[one[at]], self.rank[two[at]]
            from_left = x > y
            l, r = at[from_left], at[~from_left]  # noqa: E741
            limit[l], one[l] = 2 * self.rank[one[l]], self.right[one[l]]
            limit[r], two[r] = 2 * self.rank[two[r]] + 1, self.left[two[r]]
        return out

    def _fits(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        ok = token >= 0
        check = np.flatnonzero(ok & (before >= 0))
        if len(check):
            ok[check] = self._stable(before[check], token[check])
        return ok

    def tables(self, units: list[bytes], every: bool) -> tuple[np.ndarray, np.ndarray]:
        """(counts, lengths): closed counts of each unit's prefixes by columns (``every``), else of the whole unit in the last one."""
        size = np.array([len(u) for u in units])
        order = np.argsort(-size, kind="stable")
        size = size[order]
        width = int(size[0])
        n = len(units)
        raw = np.frombuffer(b"".join(units[k].ljust(width, b"\0") for k in order), np.uint8).reshape(n, width)
        sums = np.zeros((n, width + 1), np.uint64)
        for i in range(width):
            sums[:, i + 1] = sums[:, i] * self._BASE + raw[:, i] + np.uint64(1)
        last = np.full((n, width + 1), -1, np.int32)
        count = np.zeros((n, width + 1), np.int32)
        closed = np.zeros((n, width + 1), np.int32)
        for i in range(1, width + 1):
            rows = int(np.searchsorted(-size, -i, "right"))
            ends = int(np.searchsorted(-size, -i, "left"))
            self._cells(np.arange(ends), i, sums, last, count, self.open, last, count)  # those that go on
            self._cells(np.arange(rows) if every else np.arange(ends, rows), i, sums, last, count, self.closed, None, closed)
        back = np.empty(n, np.int64)
        back[order] = np.arange(n)
        if every:
            return closed[back], size[back]
        return closed[np.arange(n), size][back], size[back]

    def _cells(self, rows, i, sums, last, count, lookup, last_out, count_out) -> None:
        for k in range(1, min(i, self.longest) + 1):
            if not len(rows):
                return
            token = lookup(sums[rows, i] - sums[rows, i - k] * self.power[k])
            ok = self._fits(last[rows, i - k], token)
            done = rows[ok]
            count_out[done, i] = count[done, i - k] + 1
            if last_out is not None:
                last_out[done, i] = token[ok]
            rows = rows[~ok]
        if len(rows):
            raise ValueError("no vocabulary entry ends a prefix")

    def counts(self, units: list[bytes]) -> np.ndarray:
        """Token counts of whole units, batches of like lengths side by side."""
        out = np.zeros(len(units), np.int64)
        order = sorted(range(len(units)), key=lambda k: len(units[k]))
        at = 0
        while at < len(order):
            shortest = len(units[order[at]])
            end = at
            while end < len(order) and end - at < SIDE and len(units[order[end]]) <= max(12, 2 * shortest) and (end - at) * len(units[order[end]]) < 1 << 20:
                end += 1
            end = max(end, at + 1)
            part = order[at:end]
            out[part] = self.tables([units[k] for k in part], False)[0]
            at = end
        return out


def byte_alphabet() -> dict[int, str]:
    """The code point that stands for each byte: itself where it prints, else the next free one from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + k) for k, b in enumerate(rest)}}


class PrefixCounter:
    """Exact token counts at every prefix, for a word-end BPE vocabulary."""

    def __init__(self, path: str, memo: int = MEMO):
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.load(open(path, encoding="utf-8"))
        self.vocab = spec["model"]["vocab"]
        self.end = spec["model"].get("end_of_word_suffix") or ""
        merges = [tuple(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
        self.ranks = {m: k for k, m in enumerate(merges)}
        steps = spec["pre_tokenizer"]["pretokenizers"]
        if steps[0]["pattern"] != {"Regex": _SPLIT} or [n["type"] for n in spec["normalizer"]["normalizers"]] != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"{path} splits or normalises in a way that is not known here")
        self.units = UnitTables(self.vocab, merges, self.end)
        self.to_bytes = {ord(c): b for b, c in self.units.alphabet.items()}
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.specials = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")
        self.kinds: dict[str, tuple[str, str]] = {}
        self.longest = max(len(t) for t in self.vocab)
        self.memo: dict[str, int] = {}
        self.unit_memo: dict[str, int] = {}
        self.bound = memo
        self.stable: dict[tuple[str, str], bool] = {}

    # chunks -----------------------------------------------------------------

    def chunks(self, text: str) -> list[str]:
        return _ASCII_CHUNK.findall(text) if _SEPARATORS.search(text) else text.split()

    def chunk_units(self, chunk: str) -> list[str]:
        """The units of a chunk as the vocabulary writes bytes; a special token is one of its own, with a tab in front."""
        if chunk.isascii() and "<|" not in chunk:
            return _ASCII_UNITS.findall(chunk.lower())
        out, at = [], 0
        for m in [*self.specials.finditer(chunk), None]:
            part = chunk[at : m.start() if m else len(chunk)]
            if part:
                out += [u for u, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(part))]
            if m:
                out.append("\t" + m.group())
                at = m.end()
        return out

    def long_unit_count(self, unit: str) -> int:
        state = _Prefix(self)
        for x in unit:
            state._symbol(x)
        return state._closed()

    def unit_counts(self, units: list[str]) -> dict[str, int]:
        memo = self.unit_memo
        missing = [u for u in set(units).difference(memo)]
        if len(memo) + len(missing) > self.bound:
            memo = self.unit_memo = {}
            missing = list(set(units))
        memo.update((u, self.long_unit_count(u)) for u in missing if len(u) > LONG and u[0] != "\t")
        plain = [u for u in missing if len(u) <= LONG and u[0] != "\t"]
        raw = [u.encode() if u.isascii() else bytes(map(self.to_bytes.__getitem__, map(ord, u))) for u in plain]
        memo.update(zip(plain, self.units.counts(raw).tolist()))
        memo.update((u, 1) for u in missing if u[0] == "\t")
        return memo

    def chunk_counts(self, chunks: list[str]) -> np.ndarray:
        memo = self.memo
        missing = list(set(chunks).difference(memo))
        if missing:
            if len(memo) + len(missing) > self.bound:
                memo = self.memo = {}
                missing = list(set(chunks))
            split = [self.chunk_units(c) for c in missing]
            counts = self.unit_counts([u for x in split for u in x])
            memo.update(zip(missing, (counts[x[0]] if len(x) == 1 else sum(map(counts.__getitem__, x)) for x in split)))
        return np.fromiter(map(memo.__getitem__, chunks), np.int64, len(chunks))

    def prefix_tables(self, texts: Iterable[str], together: int = 1 << 22) -> Iterator[tuple[str, np.ndarray]]:
        """(text, prefix table) of each text; the chunks of many are looked up together."""
        held: list[tuple[str, list[str]]] = []
        size = 0
        for text in (*texts, None):
            if text is not None:
                held.append((text, self.chunks(text)))
                size += len(text)
            if held and (text is None or size >= together):
                counts = self.chunk_counts([c for _, chunks in held for c in chunks])
                at = 0
                for whole, chunks in held:
                    table = np.zeros(len(chunks) + 1, np.int64)
                    np.cumsum(counts[at : at + len(chunks)], out=table[1:])
                    at += len(chunks)
                    yield whole, table
                held, size = [], 0

    def prefix_table(self, text: str) -> np.ndarray:
        """Counts after 0, 1, 2, ... chunks of the text."""
        return next(self.prefix_tables([text]))[1]

    # symbols ----------------------------------------------------------------

    def _merge(self, symbols: list[str]) -> list[str]:
        while len(symbols) > 1:
            best = min(range(len(symbols) - 1), key=lambda i: self.ranks.get((symbols[i], symbols[i + 1]), 1 << 60))
            if (symbols[best], symbols[best + 1]) not in self.ranks:
                break
            symbols[best : best + 2] = [symbols[best] + symbols[best + 1]]
        return symbols

    def _split(self, token: str) -> list[str]:
        cut = len(token) - len(self.end) if self.end and token.endswith(self.end) and token != self.end else len(token)
        symbols = list(token[:cut])
        if cut < len(token):
            symbols[-1] += self.end
        return symbols

    def _pair(self, left: str, right: str) -> bool:
        """Whether merging the symbols of both tokens gives just these two tokens."""
        key = (left, right)
        if key not in self.stable:
            if len(self.stable) > self.bound:
                self.stable.clear()
            want = [x for x in key if x]
            self.stable[key] = self._merge([s for x in want for s in self._split(x)]) == want
        return self.stable[key]

    def symbols(self, c: str) -> tuple[str, str]:
        """(kind, bytes as the vocabulary writes them) of a normalised code point; kinds are those of the tokenizer's split."""
        if c not in self.kinds:
            split = self.tokenizer.pre_tokenizer.pre_tokenize_str
            parts = split(c)
            kind = "" if not parts else "L" if len(split(c + "a")) == 1 else "O" if len(split(c + "!")) == 1 else "N"
            self.kinds[c] = kind, "".join(x for x, _ in parts)
        return self.kinds[c]

    def unit_prefix_counts(self, unit: str) -> list[int]:
        """Token counts of ``unit[:i]`` for every i, each prefix closed as a word of its own."""
        state = _Prefix(self)
        return [0, *(state.push(c) for c in unit)]

    def _plain_walk(self, plain: str) -> Iterator[tuple[int, _Prefix]]:
        """The same, one prefix after another, for text without special tokens, normalised as far as it goes."""
        normal = self.tokenizer.normalizer.normalize_str
        state, at = _Prefix(self), 0
        while at < len(plain):
            end = at + 1
            while end < len(plain) and _joins(plain[end]):
                end += 1
            for i in range(at + 1, end):
                part = state.copy()
                for c in normal(plain[at:i]):
                    part.push(c)
                yield part.count, state
            for c in normal(plain[at:end]):
                state.push(c)
            yield state.count, state
            at = end

    def chunk_walk(self, chunk: str) -> Iterator[tuple[int, int]]:
        """(count, floor) of ``chunk[:i]`` for i = 1, 2, ...: no longer prefix has fewer tokens than the floor.

        Special tokens are whole from their last code point on; before it, their start is plain text.
        """
        base, at = 0, 0
        for m in [*self.specials.finditer(chunk), None]:
            n = 0
            for n, state in self._plain_walk(chunk[at : m.end() - 1] if m else chunk[at:]):
                yield base + n, base + state.floor()
            if m:
                before = 0
                for before, _ in self._plain_walk(chunk[at : m.start()]):
                    pass
                base, at = base + before + 1, m.end()
                yield base, base

    def chunk_prefix_counts(self, chunk: str) -> list[int]:
        """Token counts of ``chunk[:i]`` for every i."""
        return [0, *(n for n, _ in self.chunk_walk(chunk))]

    # questions ---------------------------------------------------------------

    def prefix_counts(self, text: str) -> list[int]:
        """Token counts of ``text[:i]`` for every i."""
        table, out, at = self.prefix_table(text), [0], 0
        pattern = _ASCII_CHUNK if _SEPARATORS.search(text) else _CHUNK
        for k, m in enumerate(pattern.finditer(text)):
            out += [int(table[k])] * (m.start() - at)
            out += [int(table[k]) + c for c in self.chunk_prefix_counts(m.group())[1:]]
            at = m.end()
        return out + [int(table[-1])] * (len(text) - at)

    def fits(self, text: str, table: np.ndarray, budget: int) -> int:
        """Code points of the longest prefix within the budget."""
        if table[-1] <= budget:
            return len(text)
        k = int(np.searchsorted(table, budget, "right")) - 1
        pattern = _ASCII_CHUNK if _SEPARATORS.search(text) else _CHUNK
        m = next(islice(pattern.finditer(text), k, None))
        room, best = budget - int(table[k]), 0
        for i, (n, floor) in enumerate(self.chunk_walk(m.group()), 1):
            if n <= room:
                best = i
            elif floor > room:
                break
        return m.start() + best


class _Prefix:
    """Token count of a normalised text that grows by code points (``count``)."""

    def __init__(self, counter: PrefixCounter):
        self.counter, self.count, self.quote = counter, 0, None
        self._open("", 0)

    def _open(self, kind: str, base: int) -> None:
        self.kind, self.base, self.unit, self.written = kind, base, "", ""
        self.inner, self.last = [0], [""]

    def floor(self) -> int:
        """Fewer tokens than these no longer text has: whatever it ends in goes back to one of the last cells, a sign before a contraction aside."""
        return self.base + min(self.inner[-self.counter.longest :]) - 2

    def copy(self) -> _Prefix:
        twin = object.__new__(_Prefix)
        twin.__dict__.update(self.__dict__)
        twin.inner, twin.last = self.inner[:], self.last[:]
        return twin

    def push(self, c: str) -> int:
        kind, written = self.counter.symbols(c)
        if self.kind == "O" and self.unit == "'" and kind == "L":
            self.quote = self.base
            self._open("L", self.count)
        elif kind != self.kind or kind in ("", "N"):
            self.quote = None
            self._open(kind, self.count)
        self.unit = self.unit[:3] + c
        if self.quote is not None and self.unit in _CONTRACTIONS:
            base, unit = self.quote, self.unit
            self.quote = None
            self._open("C", base)
            written = "".join(self.counter.symbols(x)[1] for x in "'" + unit)
        elif len(self.unit) > 2:
            self.quote = None
        for x in written:
            self._symbol(x)
        if written:
            self.count = self.base + self._closed()
        return self.count

    def _symbol(self, x: str) -> None:
        self.written = self.written[-self.counter.longest :] + x
        i, size, vocab = len(self.inner), len(self.written), self.counter.vocab
        for n in range(1, min(i, self.counter.longest) + 1):
            token = self.written[size - n :]
            if token in vocab and self.counter._pair(self.last[i - n], token):
                self.inner.append(self.inner[i - n] + 1)
                self.last.append(token)
                return
        raise ValueError(f"no vocabulary entry ends {self.written!r}")

    def _closed(self) -> int:
        i, size = len(self.inner) - 1, len(self.written)
        for n in range(1, min(i, self.counter.longest) + 1):
            token = self.written[size - n :] + self.counter.end
            if token in self.counter.vocab and self.counter._pair(self.last[i - n], token):
                return self.inner[i - n] + 1
        raise ValueError(f"no vocabulary entry closes {self.written!r}")


_counters: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, cut_at long"


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT) -> DataFrame:
    """Exact counts per document and the code points of the longest prefix that fits the budget (``cut_at``).

    One map over the scan: no shuffle, state bounded by the memo.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = counter(tokenizer_path)
        for batch in batches:
            ids, sizes, tokens, cuts = batch.column("doc_id"), [], [], []
            for text, table in state.prefix_tables(t.as_py() or "" for t in batch.column("text")):
                sizes.append(len(text.encode("utf-8")))
                tokens.append(int(table[-1]))
                cuts.append(state.fits(text, table, limit))
            n = np.array(tokens, np.int64)
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(n), pa.array(n > limit), pa.array(cuts, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "cut_at"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, SCHEMA)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY))
