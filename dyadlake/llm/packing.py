"""Packing (operator 7): hierarchical multi-length packing.

Documents are routed to context-size tiers.  Every full window of the longest
tier is cut off at once; the rest of a document goes to the smallest tier that
holds it.  Each tier is packed from the longest down: a window opens with its
own tier's document, its gap takes the longest whole rests that fit from the
shorter tiers, and where none fits the longest rest is cut to size.  Windows
are therefore full at their tier's length, a power of two; what is left at the
end of a partition is cut by its binary digits, so that no sequence is padded.  Sequences are
dealt to step groups of equal token counts, longest first.

Packing is local to a partition of the scan: no shuffle, no state beyond one
buffer of ``BUFFER`` tokens, and a recomputed partition gives the same rows.
A null or empty text is its end id alone; repeated rows are packed like any
others.  Extra columns of the input are not read.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_right, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import documents

VOCABULARY = "byte_bpe_50k.json"
TIERS = (256, 512, 1024, 2048)
END_ID = 1
#: Tokens of document rests that a partition gathers before it packs them.
BUFFER = 1 << 20
#: Tokens of a step group; a multiple of the longest tier.
STEP_TOKENS = 64 * 2048
#: Code points that go to the splitter at once.
LONG = 100_000
_SPLITTER = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: White space with the word after it: no token of the vocabulary's splitter crosses such a boundary.
_CHUNK = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")


def _byte_symbols() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable ones for themselves, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Encoder:
    """Ids as little-endian bytes, the same as the vocabulary file's own library gives.

    The file's vocabulary and splitter run in a rank-merge core, about five
    times as fast; special strings are cut out before it, and runs too long for
    its splitter go to the file's library.
    """

    def __init__(self, path: str):
        import json

        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        spec = json.load(open(path, encoding="utf-8"))
        step = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or step.get("type") != "ByteLevel" or step.get("add_prefix_space") or not step.get("use_regex", True) or spec["model"].get("dropout"):
            raise ValueError(f"{path} splits or normalises in a way that is not known here")
        symbols = _byte_symbols()
        ranks = {bytes(map(symbols.__getitem__, token)): n for token, n in spec["model"]["vocab"].items()}
        self.special = {t["content"]: array("I", [t["id"]]).tobytes() for t in spec["added_tokens"]}
        for t in self.special:
            ranks.pop(t.encode(), None)
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split if self.special else lambda t: [t]
        self.core = tiktoken.Encoding("file", pat_str=_SPLITTER, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def _blocks(self, text: str) -> Iterator[bytes]:
        block, size = [], 0
        for chunk in _CHUNK.findall(text):
            if size + len(chunk) > LONG and block:
                yield array("I", self.core("".join(block))).tobytes()
                block, size = [], 0
            if len(chunk) > LONG:
                yield array("I", self.library.encode(chunk, add_special_tokens=False).ids).tobytes()
            else:
                block.append(chunk)
                size += len(chunk)
        yield array("I", self.core("".join(block))).tobytes()

    def __call__(self, text: str) -> bytes:
        parts = self.split(text) if any(s in text for s in self.special) else [text]
        return b"".join(self.special.get(p) or (b"".join(self._blocks(p)) if len(p) > LONG else array("I", self.core(p)).tobytes()) for p in parts)


class Packer:
    """Packs one partition; ``take`` may flush, ``finish`` empties the buffer."""

    def __init__(self, prefix: int, tiers: tuple[int, ...] = TIERS, buffer: int = BUFFER, step_tokens: int = STEP_TOKENS):
        self.tiers, self.top, self.buffer, self.step_tokens = sorted(tiers), max(tiers), buffer, step_tokens
        self.prefix, self.next, self.step, self.step_fill = prefix, 0, 0, 0
        self.rests: list[tuple[int, int]] = []  # (length, piece), by length
        self.pieces: dict[int, tuple] = {}  # piece -> (doc_id, start, ids, doc_tokens)
        self.made = self.held = 0
        self.rows: list[tuple] = []

    def _rest(self, doc_id, start: int, ids: bytes, total: int) -> None:
        self.pieces[self.made] = (doc_id, start, ids, total)
        insort(self.rests, (len(ids) // 4, self.made))
        self.made += 1

    def _emit(self, pieces: list[tuple], capacity: int) -> None:
        if self.step_fill + capacity > self.step_tokens:
            self.step, self.step_fill = self.step + 1, 0
        self.step_fill += capacity
        at, seq = 0, self.prefix + self.next
        self.next += 1
        for doc_id, start, ids, total in pieces:
            n = len(ids) // 4
            self.rows.append((doc_id, start, n, zlib.crc32(ids), total, seq, at, capacity, self.prefix + self.step))
            at += n

    def take(self, doc_id, ids: bytes) -> None:
        total, wide = len(ids) // 4, 4 * self.top
        full = total // self.top
        for k in range(full):
            self._emit([(doc_id, k * self.top, ids[k * wide : (k + 1) * wide], total)], self.top)
        if total % self.top:
            self._rest(doc_id, full * self.top, ids[full * wide :], total)
            self.held += total % self.top
        if self.held >= self.buffer:
            self._flush(last=False)

    def _fill(self, capacity: int) -> list[tuple]:
        """Takes rests out until the window is full or nothing is left."""
        window, gap = [], capacity
        while gap and self.rests:
            at = bisect_right(self.rests, (gap, self.made)) - 1
            n, key = self.rests.pop(at)  # at -1, none fits whole: the longest is cut
            doc_id, start, ids, total = self.pieces.pop(key)
            if n > gap:
                window.append((doc_id, start, ids[: 4 * gap], total))
                self._rest(doc_id, start + gap, ids[4 * gap :], total)
                n = gap
            else:
                window.append((doc_id, start, ids, total))
            gap -= n
        self.held -= capacity - gap
        return window

    def _flush(self, last: bool) -> None:
        windows = []
        while self.rests:
            longest = self.rests[-1][0]
            tier = next(t for t in self.tiers if t >= longest)
            if self.held < tier:
                break
            windows.append((tier, self._fill(tier)))
        while last and self.held:
            tier = min(self.top, 1 << self.held.bit_length() - 1)
            windows.append((tier, self._fill(tier)))
        for tier, window in sorted(windows, key=lambda w: -w[0]):
            self._emit(window, tier)

    def finish(self) -> None:
        self._flush(last=True)


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, capacity long, step_group long"
_ARROW = pa.schema([(c.split()[0], pa.int64()) for c in SCHEMA.split(", ")])
_encoders: dict[str, Encoder] = {}


def pack(docs: DataFrame, tokenizer_path: str, tiers: tuple[int, ...] = TIERS, buffer: int = BUFFER) -> DataFrame:
    """One row per piece of a document; ``capacity`` is its sequence's length with padding."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoders.setdefault(tokenizer_path, None) or Encoder(tokenizer_path)
        _encoders[tokenizer_path] = encode
        packer = Packer(TaskContext.get().partitionId() << 36, tiers, buffer)
        end = END_ID.to_bytes(4, "little")

        def out() -> pa.RecordBatch:
            rows, packer.rows = packer.rows, []
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=_ARROW)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                packer.take(doc_id.as_py(), encode(text.as_py() or "") + end)
                if len(packer.rows) >= 20_000:
                    yield out()
        packer.finish()
        if packer.rows:
            yield out()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY))
