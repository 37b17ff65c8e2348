"""Similarity graphs as edge tables: best parallel edges, components, communities, neighbourhoods.

Iterations write their state to the shared folder and stop when nothing has
changed.  Steps aggregate before they join, so a hub's links are combined
where they lie.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import discard, stored


def filtered_edges(alignments: DataFrame, score: str, low: float, high: float, min_length: int = 0) -> DataFrame:
    """No self hits, long enough, score within bounds."""
    keep = (F.col("query") != F.col("target")) & F.col(score).between(low, high)
    return alignments.where(keep & (F.col("alnlen") >= min_length) if min_length else keep)


def undirected_max(edges: DataFrame, weight: str = "weight") -> DataFrame:
    """One edge for each unordered pair, of the largest weight."""
    return edges.where("src <> dst").groupBy(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).agg(F.max(weight).alias(weight))


def reciprocal(edges: DataFrame, weight: str = "weight") -> DataFrame:
    """Pairs linked both ways, with the larger weight."""
    both = edges.where("src <> dst").groupBy(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
    sides = both.agg(F.max(weight).alias(weight), F.max(F.when(F.col("src") < F.col("dst"), 1).otherwise(0)).alias("out"), F.max(F.when(F.col("src") > F.col("dst"), 1).otherwise(0)).alias("back"))
    return sides.where("out = 1 and back = 1").select(F.col("a").alias("src"), F.col("b").alias("dst"), weight)


def covered_edges(edges: DataFrame, interfaces: DataFrame, coverage: float) -> DataFrame:
    """Edges whose aligned range [start, end) covers enough residues of any interface of ``src`` (columns node, residues)."""
    inside = F.size(F.filter("residues", lambda r: (r >= F.col("start")) & (r < F.col("end"))))
    hit = edges.join(interfaces, edges["src"] == interfaces["node"]).where(F.try_divide(inside.cast("double"), F.size("residues")) >= coverage)
    return hit.select(*edges.columns).distinct()


def interface_graph(edges: DataFrame, interfaces: DataFrame, coverage: float) -> DataFrame:
    used = interfaces.select(F.col("node").alias("n")).distinct()
    kept = covered_edges(edges, interfaces, coverage).join(used, F.col("dst") == F.col("n"), "left_semi")
    return reciprocal(kept)


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", component: str = "component") -> DataFrame:
    """(node, component) of every node that has an edge: the component's smallest node.

    Large-star and small-star contractions until nothing changes.  Every step is
    a grouped minimum joined back on the node, so a node with many links is
    pre-aggregated before the exchange and never gathered anywhere.
    """
    now = stored(edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).where("u <> v").distinct(), "stars")
    mark = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark or not seen[0]:
            break
        mark = seen
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stored(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "stars")
        discard(now)
        now = after
    member = now.select(F.col("u").alias("node"), F.col("v").alias(component))
    return member.unionByName(member.select(F.col(component).alias("node"), component).distinct())


def label_propagation(edges: DataFrame, weight: str = "weight", seed: int = 0) -> DataFrame:
    """(node, community): each node has a label of the largest summed weight among its neighbours'.

    A node moves only where another label weighs more than its own, to the
    smallest of the heaviest; of neighbours that would move, one does, by seeded
    draw.  So every move adds to the weight inside communities, and no cap is
    needed: the loop ends when no label would move.
    """
    both = edges.select("src", "dst", weight).unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), weight))
    # exact sums: equal weights compare equal in any order
    both = stored(both.where("src <> dst").select("src", "dst", F.round(weight, 9).cast("decimal(28,9)").alias("w")), "lpa-edges")
    labels = stored(both.select(F.col("src").alias("node"), F.col("src").alias("community")).distinct(), "lpa")
    turn = 0
    while True:
        votes = both.join(labels.withColumnRenamed("node", "dst"), "dst").groupBy(F.col("src").alias("node"), "community").agg(F.sum("w").alias("w"))
        held = votes.join(labels.withColumnRenamed("community", "own"), "node")
        best = held.groupBy("node").agg(F.min(F.struct((-F.col("w")).alias("w"), "community")).alias("best"), F.max(F.when(F.col("community") == F.col("own"), F.col("w"))).alias("own"))
        wish = best.where("-best.w > coalesce(own, 0)").select("node", F.col("best.community").alias("next"), F.struct(F.xxhash64(F.lit(seed + turn), "node"), "node").alias("draw"))
        wish = stored(wish, "lpa-wish")
        if wish.isEmpty():
            discard(wish)
            return labels
        rival = both.join(wish.select(F.col("node").alias("dst"), F.col("draw").alias("other")), "dst").groupBy(F.col("src").alias("node")).agg(F.max("other").alias("other"))
        moves = wish.join(rival, "node", "left").where("other is null or draw > other").select("node", "next")
        moved = stored(labels.join(moves, "node", "left").select("node", F.coalesce("next", "community").alias("community")), "lpa")
        discard(labels, wish)
        labels = moved
        turn += 1


#: Walks that one task makes, links that one task holds, and pairs that are packed together.
WALKS, LINKS, BUNDLE = 1 << 27, 1 << 22, 1 << 20


def _bundles(pairs: DataFrame) -> DataFrame:
    """(place, pairs) of ``pairs`` (place, a, b): sorted and compressed, many to a row, so that copies of them are small."""

    def pack(batches):
        import pyarrow as pa

        def bundle(held):
            table = pa.Table.from_batches(held)
            table = table.sort_by([(c, "ascending") for c in table.column_names])
            place = table.column("place").to_numpy()
            starts = np.flatnonzero(np.diff(place, prepend=-1))
            for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(place)]):
                sink = pa.BufferOutputStream()
                part = table.slice(s, e - s).drop_columns("place")
                with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_table(part)
                yield pa.RecordBatch.from_arrays([pa.array(place[s : s + 1], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["place", "pairs"])

        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= BUNDLE:
                yield from bundle(held)
                held, rows = [], 0
        if rows:
            yield from bundle(held)

    return pairs.mapInArrow(pack, "place int, pairs binary")


def _reached(near: DataFrame, both: DataFrame) -> DataFrame:
    """(source, node): what ``near`` (source, node) holds and all neighbours of it, each once.

    A grid of tasks: one block of sources by one part of the nodes that are
    reached.  So every pair is found in one task only, no walk is a row, and
    links are sent once a block, walked nodes once a part: with t tasks about
    the square root of t times, as compressed bundles.
    """
    kind = dict(near.dtypes)["node"]
    links = both.select(F.col("src").cast(kind).alias("a"), F.col("dst").cast(kind).alias("b"))
    middle = near.groupBy(F.col("node").alias("a")).agg(F.count("*").alias("times"))
    size = links.groupBy("a").agg(F.count("*").alias("links"))
    walks, held, sent = middle.join(size, "a", "full").agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in (F.col("times") * F.col("links"), "links", "times"))).first()
    tasks = max(1, -(-walks // WALKS))
    parts = max(-(-held // LINKS), math.isqrt(tasks - 1) + 1)
    blocks = max(1, -(-sent // LINKS), -(-tasks // parts))
    place = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int").alias("place")
    copies = lambda df, n, cell, side: df.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("copy"), "place", "pairs").select(cell.cast("int").alias("cell"), F.lit(side).alias("side"), "pairs")
    left = _bundles(near.select(place("source", blocks), F.col("source").alias("a"), F.col("node").alias("b")))
    # a node reaches itself
    right = _bundles(links.unionByName(middle.select("a", F.col("a").alias("b"))).select(place("b", parts), "a", "b"))
    dealt = copies(left, parts, F.col("place") * parts + F.col("copy"), 0).unionByName(copies(right, blocks, F.col("copy") * parts + F.col("place"), 1))

    def walk(sources, nodes, keys, reached):
        """Batches of the pairs of one cell: sources and their nodes, these nodes and what they reach."""
        import pyarrow as pa
        import pyarrow.compute as pc

        def numbered(column):
            codes = column.dictionary_encode(null_encoding="encode")
            return codes.indices.to_numpy(zero_copy_only=False), codes.dictionary

        def grouped(codes, n, values):
            return values[np.argsort(codes, kind="stable")], np.concatenate(([0], np.cumsum(np.bincount(codes, minlength=n))))

        code, names = numbered(reached)
        order = pc.sort_indices(names).to_numpy()
        rank = np.empty(len(names), np.int32)
        rank[order] = np.arange(len(names), dtype=np.int32)
        key, known = numbered(keys)
        near, at = grouped(key, len(known), rank[code])
        names, at = names.take(pa.array(order)), at.tolist()
        row = pc.fill_null(pc.index_in(nodes, value_set=known), -1).to_numpy(zero_copy_only=False)
        source, own = numbered(sources)
        row, start = grouped(source[row >= 0], len(own), row[row >= 0])
        found, rows = [], 0
        for k, (s, e) in enumerate(zip(start.tolist(), start[1:].tolist())):
            seen = np.zeros(len(names), bool)
            for i in range(s, e, 1024):
                seen[np.concatenate([near[at[r] : at[r + 1]] for r in row[i : min(e, i + 1024)].tolist()])] = True
            found.append((k, np.flatnonzero(seen)))
            rows += len(found[-1][1])
            if rows >= 1 << 19 or k == len(own) - 1:
                ends = np.repeat([f[0] for f in found], [len(f[1]) for f in found])
                yield pa.RecordBatch.from_arrays([own.take(pa.array(ends)), names.take(pa.array(np.concatenate([f[1] for f in found])))], ["source", "node"])
                found, rows = [], 0

    def merge(batches):
        import pyarrow as pa

        cells: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for cell, side, pairs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                cells.setdefault(cell, ([], []))[side].append(pairs.as_buffer())
        for held in cells.values():
            if all(held):
                yield from walk(*(t.column(c).combine_chunks() for t in (pa.concat_tables(pa.ipc.open_stream(b).read_all() for b in side) for side in held) for c in ("a", "b")))

    return dealt.repartitionById(blocks * parts, "cell").mapInArrow(merge, near.select("source", "node").schema)


def khop(edges: DataFrame, sources: DataFrame, hops: int, max_degree: int | None = None) -> DataFrame:
    """(source, node, hub): nodes within ``hops``, the source among them; sources above ``max_degree`` are marked as hubs and not walked."""
    both = edges.select(F.inline(F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"))))).where("src <> dst").distinct()
    both = stored(both, "khop-links")  # edges are made once
    start = sources.select(F.col("node").alias("source")).distinct()
    if max_degree is not None:
        degree = both.groupBy(F.col("src").alias("source")).count()
        start = start.join(degree, "source", "left").withColumn("hub", F.coalesce(F.col("count") > max_degree, F.lit(False))).drop("count")
    else:
        start = start.withColumn("hub", F.lit(False))
    start = stored(start, "khop-start")
    found = start.where("not hub").select("source", F.col("source").alias("node"))
    for hop in range(hops):
        # the first hop is the links themselves; only states between hops are written
        near = found.unionByName(found.join(both, F.col("node") == F.col("src")).select("source", F.col("dst").alias("node"))) if not hop else _reached(found, both)
        if hop < hops - 1:
            near = stored(near, "khop")
            if hop:
                discard(found)
        found = near
    hubs = start.where("hub").select("source", F.col("source").alias("node"), "hub")
    return found.withColumn("hub", F.lit(False)).unionByName(hubs)


def pair_leaks(reach: DataFrame, systems: DataFrame) -> DataFrame:
    """(id, leaked): systems both of whose chains are reached from both chains of another, in either orientation.

    ``reach`` is (source, node), ``systems`` (id, r, l).
    """
    hits = reach.select("source", "node").distinct()
    by = lambda side, key: systems.select("id", F.col(side).alias("source")).join(hits, "source").select("id", F.col("node").alias(key))
    r, l = by("r", "hr"), by("l", "hl")  # noqa: E741
    ends = systems.select(F.col("id").alias("leaked"), "r", "l")
    # through the systems' own chains: no product of the two hit lists
    straight = r.join(ends, r["hr"] == ends["r"]).select("id", "leaked", F.col("l").alias("hl")).join(l, ["id", "hl"], "left_semi")
    crossed = r.join(ends, r["hr"] == ends["l"]).select("id", "leaked", F.col("r").alias("hl")).join(l, ["id", "hl"], "left_semi")
    return straight.select("id", "leaked").unionByName(crossed.select("id", "leaked")).where("id <> leaked").distinct()


def node_to_cluster(clusters: DataFrame) -> DataFrame:
    """(node, cluster) from (cluster, members); a node of several takes the last cluster."""
    return clusters.select("cluster", F.explode("members").alias("node")).groupBy("node").agg(F.max("cluster").alias("cluster"))


def drop_nodes(edges: DataFrame, keep: DataFrame) -> DataFrame:
    ids = keep.select(F.col("node").alias("__n")).distinct()
    return edges.join(ids, F.col("src") == F.col("__n"), "left_semi").join(ids, F.col("dst") == F.col("__n"), "left_semi")


def cosine_edges(vectors: DataFrame, key: str, column: str, threshold: float, block: int = 8192) -> DataFrame:
    """(src, dst, weight) of pairs at or above a cosine: blocks of rows meet as matrices, only edges leave."""
    n = vectors.count()
    blocks = max(1, -(-n // block))
    dealt = vectors.select(F.col(key).cast("long").alias("id"), F.col(column).alias("x"), F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias("side"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select("id", "x", "side", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"))

    def match(key, rows):
        import pandas as pd

        lo, hi = key
        x = np.array(rows["x"].tolist(), float)
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        ids, side = rows["id"].to_numpy(), rows["side"].to_numpy()
        a, b = np.flatnonzero(side == lo), np.flatnonzero(side == hi)
        found = []
        for k in range(0, len(a), 1024):  # a strip of the product at a time
            sims = x[a[k : k + 1024]] @ x[b].T
            i, j = np.nonzero(sims >= threshold)
            found.append((ids[a[k + i]], ids[b[j]], sims[i, j]))
        src, dst, w = (np.concatenate(c) for c in zip(*found)) if found else (ids[:0], ids[:0], x[:0, 0])
        ok = src < dst if lo == hi else src != dst
        return pd.DataFrame({"src": np.minimum(src, dst)[ok], "dst": np.maximum(src, dst)[ok], "weight": w[ok]})

    return dealt.groupBy("lo", "hi").applyInPandas(match, "src long, dst long, weight double")

