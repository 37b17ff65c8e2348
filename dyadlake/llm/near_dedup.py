"""MinHash near-dedup (operator 1): a multi-index Hamming join.

1. One map over the texts gives each document's number of distinct shingles, a
   128-bit name of its shingle set and a signature of ``SYMBOLS`` minima, 16
   bits of each.  Documents of the same set are one class from here on, so
   copies cost nothing further and lose no link.
2. A signature is split into ``CHUNKS`` chunks of ``WIDTH`` symbols.  By
   pigeonhole two signatures that differ in at most ``MAX_WRONG`` symbols, fewer
   than two a chunk, share a chunk with at most one wrong symbol; each chunk is
   indexed once for every way to leave a symbol out, so every pair under the
   threshold meets in a bucket.  (At similarity 0.75 a pair is above the
   threshold with probability 2e-5, and less above.)
3. Inside a bucket, signatures are compared in vectorised rows, and the bucket
   passes on a spanning forest of its near pairs: those whose set sizes allow
   the similarity and whose signatures differ in at most ``MAX_WRONG`` symbols.  The union of the forests gives coarse clusters that hold every
   near pair, from a number of links linear in the bucket's rows.
4. Links are confirmed on full shingle sets inside each coarse cluster, closest
   pairs first, and only between members not yet connected.  What leaves a task
   is again a forest of confirmed links.  Buckets above ``BLOCK`` members and
   clusters above ``CLUSTER`` members or ``CLUSTER_SHINGLES`` shingles are dealt
   as pairs of blocks, so that no task holds one whole and none is capped.
5. Distributed union-find labels the components.

Null, empty and word-less texts have no set, link with nothing and stay.  Texts
under five words are one shingle.  Repeated rows and ids are told apart by a
row number.  Extra columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textops as T
from .components import components
from .store import Scratch, discard, documents

WORDS = 5
SIMILARITY = 75
CHUNKS, WIDTH = 16, 4
SYMBOLS = CHUNKS * WIDTH
#: Wrong symbols up to which a pair is confirmed on full sets: the most that leave a chunk with one error or none, and 4.3 standard deviations above 16, the mean at 0.75.
MAX_WRONG = 2 * CHUNKS - 1
BLOCK = 2048
CLUSTER = 512
CLUSTER_SHINGLES = 1_000_000

_FACTORS = np.random.default_rng(20240301).integers(1, 1 << 63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes; shorter texts are one shingle."""
    raw = T.encode(text)
    starts, ends = T.word_bounds(raw)
    if not len(starts):
        return np.empty(0, np.uint64)
    return np.unique(T.window_hashes(T.word_hashes(raw, starts, ends, lower=True), min(words, len(starts))))


def set_name(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signature(shingles: np.ndarray) -> np.ndarray:
    low = np.full(SYMBOLS, ~np.uint64(0))
    for at in range(0, len(shingles), 256):
        np.minimum(low, (shingles[at : at + 256, None] * _FACTORS).min(axis=0), out=low)
    return (T.mix(low) & np.uint64(0xFFFF)).astype("<u2")


def index_keys(signatures: np.ndarray) -> np.ndarray:
    """[n, SYMBOLS] bucket keys: chunk c with symbol p left out at column c * WIDTH + p."""
    out = np.empty((len(signatures), SYMBOLS), np.uint64)
    for c in range(CHUNKS):
        chunk = signatures[:, c * WIDTH : (c + 1) * WIDTH].astype(np.uint64)
        for p in range(WIDTH):
            left = np.delete(chunk, p, axis=1)
            # three symbols and the column, side by side: keys are equal only where all of them are
            out[:, c * WIDTH + p] = T.mix(left[:, 0] | left[:, 1] << np.uint64(16) | left[:, 2] << np.uint64(32) | np.uint64(c * WIDTH + p) << np.uint64(48))
    return out


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = TaskContext.get().partitionId() << 36
    for batch in batches:
        sizes, names, signatures, seen = [], [], [], {}
        for text in batch.column("text"):
            shingles = shingle_set(text.as_py())
            sizes.append(len(shingles))
            name = set_name(shingles) if len(shingles) else None
            names.append(name)
            if name is None:
                signatures.append(None)
            else:
                if name not in seen:
                    seen[name] = signature(shingles).tobytes()
                signatures.append(seen[name])
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(row, row + len(sizes)), pa.int64()), batch.column("doc_id"), batch.column("text_name"), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), pa.array(signatures, pa.binary())],
            names=["row", "doc_id", "text_name", "n_shingles", "name", "signature"],
        )
        row += len(sizes)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 2000):
            batch = whole.slice(at, 2000)
            signatures = np.frombuffer(b"".join(batch.column("signature").to_pylist()), "<u2").reshape(-1, SYMBOLS)
            keys = index_keys(signatures)
            nodes = np.repeat(batch.column("node").to_numpy(zero_copy_only=False), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(nodes)], names=["key", "node"])


def _near(sig: np.ndarray, size: np.ndarray, one: int, others: np.ndarray) -> np.ndarray:
    """Wrong symbols between a row and others, past the limit where the sizes rule the pair out."""
    wrong = np.count_nonzero(sig[others] != sig[one], axis=1)
    small, large = np.minimum(size[others], size[one]), np.maximum(size[others], size[one])
    return np.where(100 * small >= SIMILARITY * large, wrong, SYMBOLS + 1)


def _forest(sig: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Rows grouped by near pairs: (row, rows it reaches), every row reached once."""
    left = np.arange(len(sig))
    while len(left) > 1:
        wave, left = [left[0]], left[1:]
        while wave and len(left):
            one = wave.pop()
            hit = _near(sig, size, one, left) <= MAX_WRONG
            if hit.any():
                yield one, left[hit]
                wave += left[hit].tolist()
                left = left[~hit]


def _grouped(names: tuple[str, ...], act):
    """A map over batches sorted by ``names`` that hands whole groups to ``act(table, starts, ends)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([held, t]) if held is not None else t
            change = np.zeros(t.num_rows - 1, bool)
            for c in names:
                x = t.column(c).to_numpy()
                change |= x[1:] != x[:-1]
            starts = np.concatenate(([0], np.flatnonzero(change) + 1))
            held = t.slice(int(starts[-1])).combine_chunks()
            if len(starts) > 1:
                yield from act(t.slice(0, int(starts[-1])), starts[:-1], starts[1:])
        if held is not None:
            yield from act(held, np.array([0]), np.array([held.num_rows]))

    return run


def _signatures(t: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(t.column("signature").to_pylist()), "<u2").reshape(-1, SYMBOLS)


def _links(pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in zip(*pairs)) if pairs else (np.empty(0, np.int64),) * 2
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def _bucket_links(t: pa.Table, starts: np.ndarray, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
    node, size, sig, out = t.column("node").to_numpy(), t.column("n_shingles").to_numpy(), _signatures(t), []
    two = starts[ends - starts == 2]
    for at in range(0, len(two), 20_000):
        i = two[at : at + 20_000]
        ok = 100 * np.minimum(size[i], size[i + 1]) >= SIMILARITY * np.maximum(size[i], size[i + 1])
        i = i[ok]
        i = i[np.count_nonzero(sig[i] != sig[i + 1], axis=1) <= MAX_WRONG]
        out.append((node[i], node[i + 1]))
    for s, e in zip(starts, ends):
        if e - s > 2:
            for one, reached in _forest(sig[s:e], size[s:e]):
                out.append((np.full(len(reached), node[s + one]), node[s + reached]))
    yield _links(out)


def near_links(classes: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b): forests over the buckets that connect every near pair of (node, n_shingles, signature) rows."""
    keyed = classes.select("node", "signature").mapInArrow(_keys, "key long, node long")
    shared = keyed.groupBy("key").agg(F.count("*").alias("members"), F.min("node").alias("x"), F.max("node").alias("y")).where("x < y")
    met = scratch.store(keyed.join(shared.select("key", "members"), "key"), "near-buckets")
    return (
        _dealt(met, F.ceil(F.col("members") / BLOCK), "node", ["key"])
        .join(classes, "node")
        .repartition("key", "lo", "hi")
        .sortWithinPartitions("key", "lo", "hi", "node")
        .mapInArrow(_grouped(("key", "lo", "hi"), _bucket_links), "a long, b long")
        .distinct()
    )


def _dealt(rows: DataFrame, blocks, node: str, group: list[str]) -> DataFrame:
    """Each row once for every pair of its group's blocks that holds its own: (group, node, side, lo, hi)."""
    blocks = blocks.cast("int")
    return (
        rows.withColumn("side", F.pmod(F.xxhash64(node), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select(*group, node, "side", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"))
    )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, sets = [], []
        for node, name, text in zip(batch.column("node"), batch.column("name"), batch.column("text")):
            shingles = shingle_set(text.as_py())
            if len(shingles) and set_name(shingles) == name.as_py():
                nodes.append(node.as_py())
                sets.append(shingles.view(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])


def _alike(x: np.ndarray, y: np.ndarray, similarity: int) -> bool:
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    common = int(np.count_nonzero(y[at] == x))
    return 100 * common >= similarity * (len(x) + len(y) - common)


def _confirm(similarity: int):
    def act(t: pa.Table, starts: np.ndarray, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        node, size, sig, side = t.column("node").to_numpy(), t.column("n_shingles").to_numpy(), _signatures(t), t.column("side").to_numpy()
        lo, hi = t.column("lo").to_numpy(), t.column("hi").to_numpy()
        lists = t.column("shingles").combine_chunks()
        offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
        out = []
        for s, e in zip(starts.tolist(), ends.tolist()):
            tried = []
            for one in range(s, e - 1):
                others = np.arange(one + 1, e)
                if lo[s] != hi[s]:
                    others = others[side[others] != side[one]]
                wrong = _near(sig, size, one, others)
                ok = wrong <= MAX_WRONG
                tried.append((wrong[ok], np.full(int(ok.sum()), one), others[ok]))
            if not tried:
                continue
            wrong, left, right = map(np.concatenate, zip(*tried))
            root = list(range(e - s))

            def find(x: int) -> int:
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            for k in np.argsort(wrong, kind="stable"):
                i, j = int(left[k]), int(right[k])
                x, y = find(i - s), find(j - s)
                if x != y and _alike(values[offsets[i] : offsets[i + 1]], values[offsets[j] : offsets[j + 1]], similarity):
                    root[max(x, y)] = min(x, y)
                    out.append((node[i : i + 1], node[j : j + 1]))
        yield _links(out)

    return act


def near_dedup(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """(row, doc_id, n_shingles, component_id, kept); ``row`` tells rows of the same id apart.  Reads two stored tables."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_name"), "text")
    with Scratch() as s:
        described = s.store(source.mapInArrow(_describe, "row long, doc_id long, text_name long, n_shingles long, name binary, signature binary"), "near-described")
        classes = s.store(
            described.where(F.col("n_shingles") > 0)
            .groupBy("name")
            .agg(F.min(F.struct("row", "doc_id", "text_name")).alias("head"), F.min("doc_id").alias("low"), F.min("n_shingles").alias("n_shingles"), F.min("signature").alias("signature"))
            .select("name", F.col("head.row").alias("node"), F.col("head.doc_id").alias("head_id"), F.col("head.text_name").alias("text_name"), "low", "n_shingles", "signature"),
            "near-classes",
        )
        near = s.own(components(near_links(classes.select("node", "n_shingles", "signature"), s), "a", "b"))
        wanted = s.store(near.join(classes, "node"), "near-wanted")
        # by id and by what names the text, so that rows without an id are no single key
        heads = wanted.select("node", "name", F.col("head_id").alias("id"), F.col("text_name").alias("tn"))
        sets = (
            source.join(heads, (F.col("text_name") == F.col("tn")) & F.col("doc_id").eqNullSafe(F.col("id")))
            .select("node", "name", "text")
            .mapInArrow(_sets, "node long, shingles array<long>")
            .dropDuplicates(["node"])
        )
        clusters = wanted.groupBy("root").agg(F.count("*").alias("members"), F.sum("n_shingles").alias("shingles_in"))
        blocks = F.ceil(F.greatest(F.col("members") / CLUSTER, F.col("shingles_in") / CLUSTER_SHINGLES))
        links = (
            _dealt(wanted.select("node", "root").join(clusters, "root"), blocks, "node", ["root"])
            .join(wanted.select("node", "n_shingles", "signature"), "node")
            .join(sets, "node")
            .repartition("root", "lo", "hi")
            .sortWithinPartitions("root", "lo", "hi", "node")
            .mapInArrow(_grouped(("root", "lo", "hi"), _confirm(similarity)), "a long, b long")
        )
        roots = s.own(components(links, "a", "b"))
        labels = classes.select("name", "node", "low").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        # the smallest id of a class is not its head's when rows are not in id order
        lowest = labels.groupBy("root").agg(F.min("low").alias("component_id"))
        named = s.keep(s.store(labels.join(lowest, "root").select("name", "component_id"), "near-named"))
        slim = s.keep(s.store(described.select("row", "doc_id", "n_shingles", "name"), "near-rows"))
    firsts = slim.join(named, "name", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return firsts.select("row", "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """``docs`` with one document, the one of the smallest id, of each component; rows without an id always stay."""
    with Scratch() as s:
        found = near_dedup(docs, similarity)
        judged = s.store(found.select("doc_id", "kept"), "near-judged")
        discard(found)
        gone = s.keep(s.store(judged.where("not kept and doc_id is not null").select(F.col("doc_id").alias("__gone")).distinct(), "near-gone"))
        again = s.keep(s.store(judged.where("doc_id is not null").groupBy(F.col("doc_id").alias("__gone")).count().where("count > 1").select("__gone"), "near-again"))
    left = docs.join(gone, F.col("doc_id").cast("long") == F.col("__gone"), "left_anti")
    if again.isEmpty():
        return left
    same = F.col("doc_id").cast("long") == F.col("__gone")
    return left.join(again, same, "left_anti").unionByName(left.join(again, same, "left_semi").dropDuplicates(["doc_id"]))


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(documents(spark, sf_dir)).drop("row")
