"""Approximate nearest neighbours (operator 2): a robust-pruned directed graph per shard.

Rows with the same vector are one node; a node answers with its ``k + 1``
smallest ids, all that a result can hold.  Nodes are dealt to shards by a hash
of the vector; a shard holds about ``8 * sqrt(nodes)``, between ``SHARD`` and
``MOST``, so shards become larger as well as more.  In each shard a graph is
grown in batches: greedy beam searches over the graph so far propose a node's
neighbours, relaxed distance pruning (a neighbour goes if another kept one is
``ALPHA`` times closer to it) keeps diverse edges, and reverse edges are added
and pruned likewise.  Beam search answers every query in every shard; exact
double-precision scores of the original vectors rank what it finds.

The graphs are stored a row a node.  Queries travel to the graphs, which are
read once for every ``GROUP`` queries; a task holds one graph and a block of
``QUERY_BLOCK`` queries.

For inner products, vectors are lifted by one coordinate to the same length, so
that the nearest in the lifted space has the largest product.  Shards hold
vectors of one order of magnitude (``LEVEL`` binary digits), scaled by the
largest: so single precision is enough for the graph of any finite doubles, and
an outlier spoils no other shard.  Scores that exceed the range of doubles are
infinite.

Vectors that are null, empty, zero or hold null or non-finite components take
no part, nor do rows without an id.  Vectors of different lengths never meet.
Rows repeated in full count once.  Extra columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import Scratch

K = 20
QUERY_EVERY = 20
SHARD, MOST = 4096, 65_536
DEGREE, SLACK = 32, 48
BEAM, BUILD_BEAM = 64, 64
ALPHA = 1.2
EXPAND = 4
BATCH = 512
QUERY_BLOCK = 1024
GROUP = 65_536
LEVEL = 8


class Graph:
    """A directed neighbour graph over unit-comparable vectors; similarity is the inner product."""

    def __init__(self, x: np.ndarray, edges: np.ndarray | None = None, start: int = 0):
        self.x = np.ascontiguousarray(x, np.float32)
        self.edges = np.full((len(x), SLACK), -1, np.int32) if edges is None else edges
        self.start = start
        self.square = np.einsum("nd,nd->n", self.x, self.x)

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Best ``beam`` nodes of each query, nearest first; -1 where fewer were met."""
        ids, sims = np.full((len(q), beam), -1, np.int32), np.full((len(q), beam), -np.inf, np.float32)
        for at in range(0, len(q), 128):
            part = slice(at, at + 128)
            ids[part], sims[part] = self._search(np.ascontiguousarray(q[part], np.float32), beam)
        return ids, sims

    def _search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        n, row = len(q), np.arange(len(q))[:, None]
        seen = np.zeros((n, len(self.x) + 1), bool)
        seen[:, -1] = True  # where -1 points
        seen[:, self.start] = True
        ids = np.full((n, beam), -1, np.int32)
        sims = np.full((n, beam), -np.inf, np.float32)
        ids[:, 0], sims[:, 0] = self.start, q @ self.x[self.start]
        done = np.zeros((n, beam), bool)
        while True:
            rank = np.where(done | (ids < 0), -np.inf, sims)
            pick = np.argpartition(-rank, EXPAND, axis=1)[:, :EXPAND] if beam > EXPAND else np.arange(beam)[None].repeat(n, 0)
            open_ = np.take_along_axis(rank, pick, 1) > -np.inf
            if not open_.any():
                break
            np.put_along_axis(done, pick, True, 1)
            heads = np.where(open_, np.take_along_axis(ids, pick, 1), -1)
            near = np.where(heads[..., None] >= 0, self.edges[heads], -1).reshape(n, -1)
            near = np.where(seen[row, near], -1, near)
            near.sort(axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            live = np.flatnonzero((near >= 0).any(axis=0))
            if not len(live):
                continue
            near = near[:, live]
            seen[row, near] = True
            got = np.where(near >= 0, np.einsum("nd,nkd->nk", q, self.x[near], optimize=True), -np.inf)
            all_ids, all_sims = np.hstack([ids, near]), np.hstack([sims, got])
            keep = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            ids, sims = np.take_along_axis(all_ids, keep, 1), np.take_along_axis(all_sims, keep, 1)
            ids = np.where(np.isneginf(sims), -1, ids)
            done = np.take_along_axis(np.hstack([done, np.zeros(near.shape, bool)]), keep, 1)
        order = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)

    def prune(self, nodes: np.ndarray, offered: np.ndarray) -> np.ndarray:
        """Up to ``DEGREE`` diverse neighbours of each node from its offered ones (-1: none)."""
        own = offered == nodes[:, None]
        offered = np.where(own, -1, offered)
        offered = np.sort(offered, axis=1)
        offered[:, 1:][offered[:, 1:] == offered[:, :-1]] = -1
        v = self.x[offered]
        far = self.square[nodes][:, None] + self.square[offered] - 2 * np.einsum("nd,nkd->nk", self.x[nodes], v, optimize=True)
        far = np.where(offered >= 0, far, np.inf)
        between = self.square[offered][:, :, None] + self.square[offered][:, None, :] - 2 * v @ v.transpose(0, 2, 1)
        out = np.full((len(nodes), DEGREE), -1, np.int32)
        row = np.arange(len(nodes))
        for k in range(DEGREE):
            best = far.argmin(axis=1)
            found = np.isfinite(far[row, best])
            if not found.any():
                break
            out[found, k] = offered[row, best][found]
            gone = ALPHA * between[row, best] <= far
            far = np.where(gone & found[:, None], np.inf, far)
            far[row, best] = np.inf
        return out

    @classmethod
    def build(cls, x: np.ndarray) -> Graph:
        g = cls(x)
        g.start = int(np.argmax(g.x @ g.x.mean(axis=0))) if len(x) else 0
        order = np.random.default_rng(len(x)).permutation(len(x)).astype(np.int32)
        order = np.concatenate(([g.start], order[order != g.start])).astype(np.int32) if len(x) else order
        at = 1
        while at < len(order):
            batch = order[at : at + min(at, BATCH)]
            offered, _ = g.search(g.x[batch], BUILD_BEAM)
            if len(batch) > 1:  # nodes of one batch can be neighbours too
                sims = g.x[batch] @ g.x[batch].T
                np.fill_diagonal(sims, -np.inf)
                near = np.argsort(-sims, axis=1)[:, : min(8, len(batch) - 1)]
                offered = np.hstack([offered, batch[near]])
            chosen = g.prune(batch, offered)
            g.edges[batch, :DEGREE] = chosen
            g._reverse(batch, chosen)
            at += len(batch)
        return g

    def _reverse(self, batch: np.ndarray, chosen: np.ndarray) -> None:
        to, back = chosen.ravel(), np.repeat(batch, chosen.shape[1])
        to, back = to[to >= 0], back[to >= 0]
        order = np.argsort(to, kind="stable")
        to, back = to[order], back[order]
        nodes, first, count = np.unique(to, return_index=True, return_counts=True)
        have = (self.edges[nodes] >= 0).sum(axis=1)
        fits = have + count <= SLACK
        for k in np.flatnonzero(fits):
            self.edges[nodes[k], have[k] : have[k] + count[k]] = back[first[k] : first[k] + count[k]]
        full = np.flatnonzero(~fits)
        for at in range(0, len(full), 64):
            part = full[at : at + 64]
            wide = int(count[part].max())
            offered = np.full((len(part), SLACK + wide), -1, np.int32)
            offered[:, :SLACK] = self.edges[nodes[part]]
            for r, k in enumerate(part):
                offered[r, SLACK : SLACK + count[k]] = back[first[k] : first[k] + count[k]]
            self.edges[nodes[part]] = -1
            self.edges[nodes[part], :DEGREE] = self.prune(nodes[part], offered)


def lifted(x: np.ndarray, scale: float, longest: float) -> np.ndarray:
    """Single-precision vectors for the graph: scaled, and of the same length by one coordinate more."""
    small = x / scale
    lift = np.sqrt(np.maximum(longest**2 - np.einsum("nd,nd->n", small, small), 0))
    return np.hstack([small, lift[:, None]]).astype("<f4")


def asked_for(q: np.ndarray) -> np.ndarray:
    """Queries in the lifted space; their own length changes no order."""
    return np.hstack([q / np.abs(q).max(axis=1, keepdims=True), np.zeros((len(q), 1))]).astype("<f4")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _runs(batch: pa.RecordBatch, names: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Stretches of a sorted batch with equal values in ``names``."""
    keys = list(zip(*(batch.column(c).to_pylist() for c in names)))
    start = 0
    for k in range(1, len(keys) + 1):
        if k == len(keys) or keys[k] != keys[start]:
            yield keys[start], batch.slice(start, k - start)
            start = k


_NODE = "width int, level int, shard int, pos int, ids array<long>, vector array<double>, scale double, longest double, edges array<int>, start boolean"


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by (width, level, shard): the nodes of each shard with their edges."""

    def index(key: tuple, parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(parts).combine_chunks()
        scale, longest = t["scale"][0].as_py(), t["longest"][0].as_py()
        x = np.vstack([_matrix(p.column("vector"), key[0]) for p in parts])
        g = Graph.build(lifted(x, scale, longest))
        n = len(x)
        edges = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * SLACK), pa.array(g.edges.ravel().astype(np.int32)))
        whole = pa.RecordBatch.from_arrays(
            [*(pa.array(np.full(n, v, np.int32)) for v in key), pa.array(np.arange(n, dtype=np.int32)), *(t[c].combine_chunks() if t[c].num_chunks != 1 else t[c].chunk(0) for c in ("ids", "vector", "scale", "longest")), edges, pa.array(np.arange(n) == g.start)],
            names=["width", "level", "shard", "pos", "ids", "vector", "scale", "longest", "edges", "start"],
        )
        for at in range(0, n, 4096):
            yield whole.slice(at, 4096)

    now, parts = None, []
    for batch in batches:
        for key, part in _runs(batch, ["width", "level", "shard"]):
            if key != now and parts:
                yield from index(now, parts)
                parts = []
            now = key
            parts.append(part)
    if parts:
        yield from index(now, parts)


class _Shard:
    """A graph in a task's memory, with its nodes' original vectors and ids."""

    def __init__(self, width: int, parts: list[pa.RecordBatch]):
        self.x = np.vstack([_matrix(p.column("vector"), width) for p in parts])
        self.scale, self.longest = parts[0].column("scale")[0].as_py(), parts[0].column("longest")[0].as_py()
        edges = np.vstack([_matrix(p.column("edges"), SLACK) for p in parts])
        start = int(np.argmax(np.concatenate([p.column("start").to_numpy(zero_copy_only=False) for p in parts])))
        self.graph = Graph(lifted(self.x, self.scale, self.longest), edges, start)
        counts = np.concatenate([np.diff(p.column("ids").offsets.to_numpy()) for p in parts])
        self.ids, self.counts, self.ends = np.concatenate([p.column("ids").flatten().to_numpy() for p in parts]), counts, np.cumsum(counts)

    def answer(self, owners: list[int], q: np.ndarray, k: int) -> tuple[list[int], list[int], list[float]]:
        found, _ = self.graph.search(asked_for(q), BEAM)
        with np.errstate(over="ignore", invalid="ignore"):
            exact = np.einsum("nd,nkd->nk", q, self.x[found])
        out: tuple[list, list, list] = [], [], []
        for own, nodes, scores in zip(owners, found, exact):
            ok = nodes >= 0
            nodes, scores = nodes[ok], scores[ok]
            order = np.argsort(-scores, kind="stable")
            got: list[tuple[float, int]] = []
            for n, s in zip(nodes[order].tolist(), scores[order].tolist()):
                if len(got) >= k and -s > got[k - 1][0]:
                    break
                got += [(-s, i) for i in self.ids[self.ends[n] - self.counts[n] : self.ends[n]].tolist() if i != own]
                if len(got) > k:
                    got.sort()
            got = sorted(got)[:k]
            out[0].extend([own] * len(got))
            out[1].extend(i for _, i in got)
            out[2].extend(-s for s, _ in got)
        return out


def _answer(k: int):
    """Sorted by (width, level, shard, part, kind): a shard's nodes, then the queries that it answers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, shard = None, [], None
        for batch in batches:
            for (width, *number, kind), rows in _runs(batch, ["width", "level", "shard", "part", "kind"]):
                if (width, *number) != now:
                    now, parts, shard = (width, *number), [], None
                if kind == 0:
                    parts.append(rows)
                    continue
                if shard is None:
                    shard, parts = _Shard(width, parts), []
                for at in range(0, rows.num_rows, QUERY_BLOCK):
                    block = rows.slice(at, QUERY_BLOCK)
                    got = shard.answer(block.column("pos").to_pylist(), _matrix(block.column("vector"), width), k)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(got, (pa.int64(), pa.int64(), pa.float64()))], names=["query_id", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, is_query, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products found among the (vec_id, embedding) rows for those that ``is_query`` picks.  Reads one stored table."""
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
        .where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
        .where(finite & F.exists("embedding", lambda v: v != 0))
        .dropDuplicates(["vec_id", "embedding"])
    )
    with Scratch() as s:
        most = F.array_max(F.transform("embedding", lambda v: F.abs(v)))
        rows = s.store(rows.withColumn("width", F.size("embedding")).withColumn("most", most).withColumn("level", F.floor(F.log2("most") / LEVEL).cast("int")), "ann-rows")
        scales = rows.groupBy("width", "level").agg(F.max("most").alias("scale"), F.count("*").alias("rows"))
        square = F.aggregate("embedding", F.lit(0.0), lambda a, v: a + (v / F.col("top")) * (v / F.col("top")))
        longest = rows.join(scales.withColumnRenamed("scale", "top"), ["width", "level"]).groupBy("width", "level").agg(F.sqrt(F.max(square)).alias("longest"))
        size = F.greatest(F.lit(SHARD), F.least(F.lit(MOST), (8 * F.sqrt("rows")).cast("int")))
        asked = rows.where(is_query)
        parts = asked.groupBy("width").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("parts"))
        shape = scales.join(longest, ["width", "level"]).join(parts, "width").withColumn("shards", F.ceil(F.col("rows") / size).cast("int")).drop("rows")
        shape = s.store(shape, "ann-shape")
        unit = ["width", "level", "shard"]
        place = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
        nodes = (
            rows.withColumn("place", place)
            .where(F.col("place") <= k + 1)
            .groupBy("width", "level", "embedding")
            .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
            .join(shape, ["width", "level"])
            .withColumn("shard", F.pmod(F.xxhash64("embedding"), F.col("shards")).cast("int"))
            .select(*unit, F.col("embedding").alias("vector"), "ids", "scale", "longest")
        )
        index = s.store(nodes.repartition(*unit).sortWithinPartitions(*unit, F.element_at("ids", 1)).mapInArrow(_build, _NODE), "ann-index")
        every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
        graphs = index.join(shape.select("width", "level", "parts"), ["width", "level"]).withColumn("part", every("parts")).withColumn("kind", F.lit(0)).withColumn("pos", F.col("pos").cast("long"))
        queries = (
            asked.drop("level")
            .join(shape.select("width", "level", "shards", "parts"), "width")
            .withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
            .withColumn("shard", every("shards"))
            .select(*unit, "part", F.lit(1).alias("kind"), F.col("vec_id").alias("pos"), F.col("embedding").alias("vector"))
        )
        met = graphs.drop("parts").unionByName(queries, allowMissingColumns=True)
        dealt = met.repartition(*unit, "part").sortWithinPartitions(*unit, "part", "kind", "pos")
        found = dealt.select(*unit, "part", "kind", "pos", "ids", "vector", "scale", "longest", "edges", "start").mapInArrow(_answer(k), "query_id long, vec_id long, score double")
        best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
        # an id that has several vectors answers with its best one
        ranked = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        return s.keep(s.store(ranked.select("query_id", "rank", "vec_id", "score"), "ann-nearest"))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), f"vec_id % {QUERY_EVERY} = 0")
