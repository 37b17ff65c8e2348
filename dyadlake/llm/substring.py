"""Substring dedup (operator 5): Rabin-Karp hashes of every window of ``WINDOW`` words.

A word goes when a window over it also starts in a document with a smaller id.
Documents are dealt to blocks of consecutive ids, so the order of two documents
of different blocks is that of their blocks, and a window is sent to the count
once a block, as its hash alone:

1. each block sends its distinct window hashes, sorted and delta-coded, to the
   hash range that counts them (a window in a third of all documents costs one
   entry a block);
2. each range finds the hashes that an earlier block holds and answers the
   blocks that hold them too;
3. each block adds the repeats inside it, and merges the flagged windows into
   maximal removal intervals.

Texts are shuffled once: both uses of a block read the same exchange.  A first
pass over ids and sizes cuts the ids, in order, wherever ``BLOCK_BYTES`` of text
are full, so blocks and ranges are sized by bytes and a task's memory does not
grow, whatever the number of blocks.  An id whose rows fill more than a block, a
missing one as well, is a block of its own in several parts: rows of one id never
dedup each other, so its parts need not meet.

Hashes are 64 bits wide; two different windows of a corpus of n share one with
probability n**2 / 2**65.  Null and empty texts have no words.  Texts under
``WINDOW`` words keep all.  Rows with the same id never dedup each other; a null
id counts as the largest.  Extra columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textops as T
from .store import documents

WINDOW = 13
BLOCK_BYTES = 4 << 20
RANGE_BYTES = 24 << 20
#: The place of rows without an id.
_LAST = (1 << 63) - 1


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted hashes as fixed-width deltas, the width in the first byte."""
    if not len(values):
        return b"\x01"
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    width = max(1, (int(steps[1:].max()).bit_length() + 7) // 8) if len(steps) > 1 else 1
    return bytes([width]) + steps[:1].tobytes() + steps[1:].view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack_sorted(packed: bytes) -> np.ndarray:
    width = packed[0]
    if len(packed) == 1:
        return np.empty(0, np.uint64)
    rest = np.frombuffer(packed, np.uint8, offset=9).reshape(-1, width)
    steps = np.zeros((len(rest) + 1, 8), np.uint8)
    steps[0] = np.frombuffer(packed, np.uint8, 8, 1)
    steps[1:, :width] = rest
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def text_windows(raw: bytes, size: int) -> tuple[int, np.ndarray]:
    starts, ends = T.word_bounds(raw)
    return len(starts), T.window_hashes(T.word_hashes(raw, starts, ends), size) if len(starts) >= size else np.empty(0, np.uint64)


def _send(size: int, ranges: int):
    cuts = (np.arange(1, ranges, dtype=object) * (1 << 64) // ranges).astype(np.uint64) if ranges > 1 else np.empty(0, np.uint64)

    def rows_of(unit: tuple[int, int], parts: list[np.ndarray]) -> pa.RecordBatch:
        values = np.unique(np.concatenate(parts)) if parts else np.empty(0, np.uint64)
        at = np.concatenate(([0], np.searchsorted(values, cuts), [len(values)]))
        full = [k for k in range(ranges) if at[k] < at[k + 1]]
        return pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int32()), *(pa.array([u] * len(full), pa.int32()) for u in unit), pa.array([pack_sorted(values[at[k] : at[k + 1]]) for k in full], pa.binary())],
            names=["part", "block", "sub", "hashes"],
        )

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, parts = None, []
        for batch in batches:
            for now, text in zip(zip(batch.column("block").to_pylist(), batch.column("sub").to_pylist()), batch.column("text")):
                if now != unit and parts:
                    yield rows_of(unit, parts)
                    parts = []
                unit = now
                windows = text_windows(T.encode(text.as_py()), size)[1]
                if len(windows):
                    parts.append(windows)
        if parts:
            yield rows_of(unit, parts)

    return send


def _count(frame: pd.DataFrame) -> pd.DataFrame:
    """Answers every part of a block of one hash range with its hashes that an earlier block holds."""
    frame = frame.sort_values(["block", "sub"], kind="stable")
    blocks = frame["block"].to_numpy()
    lists = [unpack_sorted(h) for h in frame["hashes"]]
    sizes = [len(x) for x in lists]
    values = np.concatenate(lists)
    owner = np.repeat(np.arange(len(lists), dtype=np.int32), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    head = np.concatenate(([True], values[1:] != values[:-1]))
    first = blocks[owner[head]]  # owners are in order of their blocks
    again = blocks[owner] > first[np.cumsum(head) - 1]
    values, owner = values[again], owner[again]
    order = np.argsort(owner, kind="stable")
    values, owner = values[order], owner[order]
    at = np.searchsorted(owner, np.arange(len(lists) + 1))
    full = [k for k in range(len(lists)) if at[k] < at[k + 1]]
    return pd.DataFrame({"block": blocks[full].astype("int32"), "sub": frame["sub"].to_numpy()[full].astype("int32"), "seen": [pack_sorted(values[at[k] : at[k + 1]]) for k in full]})


def _remove(size: int, texts: bool):
    def remove(docs: pd.DataFrame, seen: pd.DataFrame) -> pd.DataFrame:
        place = docs["place"].to_numpy()
        rank = np.unique(place, return_inverse=True)[1]
        raws = [T.encode(t) for t in docs["text"]]
        found = [text_windows(raw, size) for raw in raws]
        sizes = np.array([len(w) for _, w in found], np.int64)
        flags = np.empty(0, bool)
        if sizes.sum():
            values = np.concatenate([w for _, w in found])
            owner = np.repeat(rank, sizes)
            order = np.argsort(values, kind="stable")
            ordered = values[order]
            head = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
            first = np.minimum.reduceat(owner[order], head)
            flags = np.empty(len(values), bool)
            flags[order] = owner[order] > np.repeat(first, np.diff(np.append(head, len(ordered))))
            known = np.concatenate([unpack_sorted(s) for s in seen["seen"]]) if len(seen) else np.empty(0, np.uint64)
            if len(known):
                known.sort()
                flags |= known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values
        ends = np.cumsum(sizes)
        out = {"doc_id": docs["place"].astype("Int64").where(place != _LAST), "n_words": [n for n, _ in found], "n_removed": [], "kept_sha256": [], "kept_text": []}
        for raw, (n, w), end in zip(raws, found, ends):
            gone = T.covered(flags[end - len(w) : end], size, n)
            words = raw.split()
            text = b" ".join(compress(words, ~gone) if gone.any() else words)
            out["n_removed"].append(int(gone.sum()))
            out["kept_sha256"].append(hashlib.sha256(text).hexdigest())
            out["kept_text"].append(text.decode("utf-8", "surrogatepass") if texts else None)
        return pd.DataFrame(out)

    return remove


def _cuts(block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted places at which another block's worth of bytes is full; a place that fills several comes as often."""
        held = 0
        for batch in batches:
            if batch.num_rows:
                full = np.concatenate(([held], held + np.cumsum(batch.column("size").to_numpy(zero_copy_only=False)))) // block_bytes
                held = int(held + batch.column("size").to_numpy(zero_copy_only=False).sum())
                yield pa.RecordBatch.from_arrays([batch.column("place").filter(pa.array(full[1:] > full[:-1]))], names=["place"])

    return run


def _blocks(cuts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(edges, parts): block k holds the places above edge k - 1 up to edge k, in so many parts."""
    places, times = np.unique(np.array(cuts, np.int64), return_counts=True)
    hot = places[times > 1]
    edges = np.unique(np.concatenate([places, hot - 1])) if len(hot) else places
    parts = np.ones(len(edges) + 1, np.int32)
    parts[np.searchsorted(edges, hot)] = times[times > 1] + 1
    return edges, parts


def substring_dedup(docs: DataFrame, window: int = WINDOW, texts: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept_text); ``texts=False`` leaves the last null."""
    source = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("place"), "text")
    cores = docs.sparkSession.sparkContext.defaultParallelism
    sized = source.select("place", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"))
    # one 8-byte id a block comes to the driver
    found = sized.repartitionByRange(cores, "place").sortWithinPartitions("place").mapInArrow(_cuts(BLOCK_BYTES), "place long").collect()
    edges, parts = _blocks([r.place for r in found])
    ranges = max(1, len(found) * BLOCK_BYTES // RANGE_BYTES)

    @F.pandas_udf("block int, parts int")
    def block_of(place: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(edges, place.to_numpy())
        return pd.DataFrame({"block": at.astype(np.int32), "parts": parts[at]})

    tasks = max(1, min(len(parts), max(ranges, cores)))
    placed = source.withColumn("b", block_of("place")).select("place", "text", F.col("b.block").alias("block"), F.pmod(F.xxhash64("text"), F.col("b.parts")).cast("int").alias("sub"))
    dealt = placed.repartition(tasks, "block", "sub")
    # all columns, so that both uses have the same exchange
    sent = dealt.sortWithinPartitions("block", "sub").mapInArrow(_send(window, ranges), "part int, block int, sub int, hashes binary")
    seen = sent.groupBy("part").applyInPandas(_count, "block int, sub int, seen binary")
    return (
        dealt.groupBy("block", "sub")
        .cogroup(seen.groupBy("block", "sub"))
        .applyInPandas(_remove(window, texts), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")
    )


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir), texts=False).drop("kept_text")
