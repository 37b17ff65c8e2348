"""Line dedup (operator 8, native): fuzzy lines by MinHash.

1. A line's normal form (lower case, no spaces at its ends) is a set of
   character shingles: every run of ``SHINGLE`` code points, at every position;
   a shorter line is one shingle.
2. Shingles are hashed onto a ring of 64 bits; band k of a signature is the
   ``ROWS`` distinct hashes that follow the k-th of ``BANDS`` fixed points
   (one-permutation MinHash in which no range is empty).
3. High-recall banding: lines that share a band are candidates.  At similarity
   0.85 a pair misses all bands with probability 9e-4.  Equal lines are one
   node, signed once.
4. Exact Jaccard verification on full shingle sets, in two steps.  Every member
   of a bucket meets its smallest and its largest node: links linear in the
   rows.  Their components leave few buckets with members of several; of those,
   the members that were no end meet one another inside a join whose condition
   is the similarity itself, so that only confirmed links are rows, and each
   pair is compared once.  Buckets above ``BLOCK`` members are dealt as pairs of
   blocks: no task holds one whole and no pair is skipped.  Full sets are
   compared where a pair shares half of its ``SKETCH`` smallest hashes, which a
   pair at similarity 0.85 misses with probability 5e-7 and smaller sets never do.
5. Distributed union-find; a component keeps its line of the smallest (doc_id,
   line number).

DataFrame operations only.  Blank lines always stay; every other line takes
part, however short.  Null texts have no lines to remove and stay null.  A null
id counts as the largest.  Rows that share an id and a text count as one
document and keep the same lines; rows that share an id alone are documents of
their own.  A line's shingles must fit in a task's memory.  Extra columns of the
input are not read, and pass through ``drop_duplicate_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .store import Scratch, documents

SIMILARITY = 85
SHINGLE = 5
BANDS, ROWS = 12, 5
BLOCK = 512
SKETCH = 32

_LAST = (1 << 63) - 1
#: Multiples of 2**60, which no hash is but with probability 2**-60.
_POINTS = [-(1 << 63) + (k << 60) for k in range(BANDS)]


def _norm(line: Column) -> Column:
    return F.lower(F.trim(line))


def _rows(docs: DataFrame) -> DataFrame:
    """(doc, name, text): documents by id and by a name of their text, for ids that repeat."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("name"), "text")


def _lines(docs: DataFrame) -> DataFrame:
    """(doc, name, line_no, n1, n2, norm) of every line that is not blank; two hashes name a normal form."""
    split = _rows(docs).select("doc", "name", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    filled = split.where(F.btrim("line", F.lit(" \t\n\x0b\x0c\r")) != "")
    named = filled.select("doc", "name", "line_no", _norm(F.col("line")).alias("norm"))
    return named.select("doc", "name", "line_no", F.xxhash64("norm").alias("n1"), F.xxhash64(F.lit(SHINGLE), "norm").alias("n2"), "norm")


def _hashes(norm: Column) -> Column:
    """Hashes of a line's shingles, one for every position: slices of 4 bytes a code point."""
    starts = lambda b: F.sequence(F.lit(1), F.greatest(F.octet_length(b) - 4 * (SHINGLE - 1), F.lit(1)), F.lit(4))
    every = lambda b: F.transform(starts(b), lambda k: F.xxhash64(F.substring(b, k, F.lit(4 * SHINGLE))))
    return F.flatten(F.transform(F.array(F.encode(norm, "UTF-32")), every))


def _around(ring: Column, at: Column, points: Column) -> Column:
    """The distinct hashes among those that follow a place on a sorted ring."""
    reach = ROWS + BANDS  # the rows after a point, with all points between
    return F.array_except(F.slice(F.concat(ring, F.slice(ring, 1, reach)), at + 1, reach), points)


def _key(k: int, points: Column) -> Column:
    """Band k of a ring whose points lie at (at0, at1, ...), from the least work that shows ``ROWS`` distinct hashes."""
    ring, at = F.col("ring"), F.col(f"at{k}")
    stop = F.col(f"at{k + 1}") - 1 if k + 1 < BANDS else F.size("ring")  # where the next point is
    band = lambda hashes: F.xxhash64(F.lit(k), F.slice(hashes, 1, ROWS))
    # no repeat and no point among the next hashes; a hash of columns is that of their array
    run = [F.get(ring, at + j) for j in range(ROWS)]
    plain = stop - at >= ROWS
    for x, y in zip(run, run[1:]):
        plain &= x < y
    arc = F.array_distinct(F.slice(ring, at + 1, F.least(F.lit(ROWS + BANDS), stop - at)))
    around = _around(ring, at, points)
    # repeats fill an arc in few lines: those take the ring of distinct hashes
    spread = F.transform(F.array(F.array_distinct(ring)), lambda d: band(_around(d, F.array_position(d, F.lit(_POINTS[k])).cast("int"), points)))[0]
    return F.when(plain, F.xxhash64(F.lit(k), *run)).when(F.size(arc) >= ROWS, band(arc)).when(F.size(around) >= ROWS, band(around)).otherwise(spread)


def signatures(docs: DataFrame) -> DataFrame:
    """(doc, name, line_no, n1, n2, keys) of every line that is not blank, in one map over the texts."""
    names = ["doc", "name", "line_no", "n1", "n2"]
    points = F.array(*map(F.lit, _POINTS))
    ring = _lines(docs).select(*names, F.sort_array(F.concat(_hashes(F.col("norm")), points)).alias("ring"))
    at = ring.select(*names, "ring", *[F.array_position("ring", F.lit(p)).cast("int").alias(f"at{k}") for k, p in enumerate(_POINTS)])
    # a band's number is in its key
    return at.select(*names, F.array(*[_key(k, points) for k in range(BANDS)]).alias("keys"))


def _buckets(signed: DataFrame) -> DataFrame:
    """(key, node, low, high, n): members of the keys that more than one node has, with the key's ends and size."""
    # single columns: aggregates of arrays are sorted; all of a node's rows have the same keys
    nodes = signed.groupBy(F.col("n1").alias("node")).agg(*[F.min(F.col("keys")[k]).alias(f"k{k}") for k in range(BANDS)])
    keyed = nodes.select("node", F.explode(F.array(*[f"k{k}" for k in range(BANDS)])).alias("key")).repartition("key")
    ends = keyed.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("n")).where("low < high")
    return keyed.join(ends.hint("shuffle_hash"), "key")  # both sides read one shuffle; the rows, mostly of keys that one node has, are not sorted


def _sized(x: Column, y: Column, similarity: int) -> Column:
    """Whether sets of these sizes can reach the similarity at all."""
    return 100 * F.least(x, y) >= similarity * F.greatest(x, y)


def _alike(x: Column, y: Column, n_x: Column, n_y: Column, similarity: int) -> Column:
    """common / (n_x + n_y - common) >= similarity of two sets, the intersection taken once; it drops repeats itself."""
    return (100 + similarity) * F.size(F.array_intersect(x, y)).cast("long") >= similarity * (n_x + n_y)


def line_texts(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, norm) of wanted nodes."""
    return lines.select(F.col("n1").alias("node"), "norm").join(wanted.hint("shuffle_hash"), "node", "left_semi").dropDuplicates(["node"])


def _sketches(texts: DataFrame) -> DataFrame:
    """(node, n, sketch): the size of a line's set and the upper halves of its smallest hashes."""
    sets = texts.select("node", F.sort_array(F.array_distinct(_hashes(F.col("norm")))).alias("x"))
    return sets.select("node", F.size("x").alias("n"), F.transform(F.slice("x", 1, SKETCH), lambda h: F.shiftright(h, 32).cast("int")).alias("sketch"))


def _near(similarity: int) -> Column:
    """Whether a pair's sizes and sketches (n_a, sketch_a, n_b, sketch_b) leave it a candidate.

    At the similarity itself the shared part is binomial; the bound is 5.5 deviations below.
    """
    p, n_a, n_b = similarity / 100, F.col("n_a"), F.col("n_b")
    share = max(0, int(100 * (p - 5.5 * (p * (1 - p) / SKETCH) ** 0.5)))
    return _sized(n_a, n_b, similarity) & (100 * F.size(F.array_intersect("sketch_a", "sketch_b")) >= share * F.least(F.lit(SKETCH), n_a, n_b))


def _verified(pairs: DataFrame, texts: DataFrame, similarity: int) -> DataFrame:
    """(a, b): the pairs (a, b, n_a, n_b) whose full sets reach the similarity."""
    side = lambda c: texts.select(F.col("node").alias(c), F.col("norm").alias(f"norm_{c}"))
    met = pairs.join(side("a"), "a").join(side("b"), "b")
    # a generated row binds both sets: a predicate on columns would evaluate them for each use
    sets = F.explode(F.array(F.struct(_hashes(F.col("norm_a")).alias("x"), _hashes(F.col("norm_b")).alias("y"))))
    bound = met.select("a", "b", "n_a", "n_b", sets.alias("p"))
    return bound.where(_alike(F.col("p.x"), F.col("p.y"), F.col("n_a"), F.col("n_b"), similarity)).select("a", "b")


def _ends_links(members: DataFrame, texts: DataFrame, sketches: DataFrame, similarity: int) -> DataFrame:
    """(a, b): confirmed links of every member with the ends of its bucket."""
    pair = lambda a, b: F.struct(F.col(a).alias("a"), F.col(b).alias("b"))
    links = members.select(F.explode(F.array(pair("low", "node"), pair("node", "high"))).alias("l")).select("l.*").where("a < b").distinct()
    side = lambda c: sketches.select(*[F.col(x).alias(y) for x, y in (("node", c), ("n", f"n_{c}"), ("sketch", f"sketch_{c}"))])
    met = links.join(side("a"), "a").join(side("b"), "b").where(_near(similarity))
    return _verified(met.select("a", "b", "n_a", "n_b"), texts, similarity)


def _inner_links(members: DataFrame, texts: DataFrame, sketches: DataFrame, roots: DataFrame, similarity: int, scratch: Scratch) -> DataFrame:
    """(a, b): confirmed links between the members that are no ends, where the ends have not connected them.

    A pair is compared under the smallest key that both have.  Where that key's
    bucket has one of them as an end, or one root, there is nothing left to do.
    """
    inner = members.where("n > 3 and node <> low and node <> high").select("key", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    inner = scratch.store(inner, "line-inner")
    open_ = inner.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("n")).where("x < y")
    dealt = inner.join(open_.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "key")
    dealt = dealt.withColumn("side", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: (k != F.col("side")) | (F.col("blocks") == 1))
    dealt = dealt.withColumn("other", F.explode(others)).select("key", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"), "side", "node", "root")
    unit = ["key", "lo", "hi"]
    keys = members.groupBy("node").agg(F.collect_set("key").alias("keys"))  # as many as a line has bands
    # texts travel, sets are made where they are compared
    known = texts.select("node", "norm").join(sketches, "node")
    rows = dealt.join(keys, "node").join(known, "node").select(*unit, "side", "node", "root", "keys", "norm", "n", "sketch").repartition(*unit)
    names = {"node": "{}", "root": "root_{}", "side": "side_{}", "keys": "keys_{}", "n": "n_{}", "sketch": "sketch_{}"}
    side = lambda c: rows.select(*unit, *[F.col(x).alias(y.format(c)) for x, y in names.items()], _hashes(F.col("norm")).alias(f"set_{c}"))
    apart = (F.col("a") < F.col("b")) & (F.col("root_a") != F.col("root_b"))
    # members of one block meet with the first other block alone
    once = (F.col("side_a") != F.col("side_b")) | (F.col("hi") == 0) | ((F.col("lo") == 0) & (F.col("hi") == F.greatest(F.col("side_a"), F.lit(1))))
    first = F.array_min(F.array_intersect("keys_a", "keys_b")) == F.col("key")
    alike = _alike(F.col("set_a"), F.col("set_b"), F.col("n_a"), F.col("n_b"), similarity)
    return side("a").join(side("b"), unit).where(apart & once & _near(similarity) & first & alike).select("a", "b").distinct()


def confirmed(members: DataFrame, texts: DataFrame, similarity: int, scratch: Scratch) -> DataFrame:
    """(a, b): links whose components are those of all pairs of a bucket that reach the similarity; a stored table."""
    sketches = scratch.store(_sketches(texts), "line-sketches")
    ends = scratch.store(_ends_links(members, texts, sketches, similarity), "line-links")
    roots = scratch.own(components(ends, "a", "b"))
    inner = scratch.store(_inner_links(members, texts, sketches, roots, similarity, scratch), "line-links")
    return ends.unionByName(inner)


def duplicate_lines(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """(doc, name, gone): the line numbers to remove from each document that has any; a stored table."""
    with Scratch() as s:
        signed = s.store(signatures(docs), "line-signatures")
        members = s.store(_buckets(signed), "line-buckets")
        wanted = members.select("node").distinct()
        texts = s.store(line_texts(_lines(docs), wanted), "line-texts")
        roots = s.own(components(confirmed(members, texts, similarity, s), "a", "b"))
        # a group is a component, or the copies of a line that is in none
        grouped = signed.select("doc", "name", "line_no", "n1", "n2").join(roots.hint("shuffle_hash"), signed["n1"] == roots["node"], "left")
        grouped = grouped.select(F.coalesce("root", "n1").alias("line"), F.when(F.col("root").isNull(), F.col("n2")).otherwise(0).alias("n2"), F.struct("doc", "line_no", "name").alias("at"))
        grouped = s.store(grouped, "line-groups")
        firsts = grouped.groupBy("line", "n2").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
        extra = grouped.join(firsts, ["line", "n2"]).where("at <> first")
        gone = extra.groupBy("at.doc", "at.name").agg(F.sort_array(F.collect_set("at.line_no")).alias("gone"))
        return s.keep(s.store(gone, "line-gone"))


def _with_gone(docs: DataFrame, similarity: int) -> DataFrame:
    gone = duplicate_lines(docs, similarity).select(F.col("doc").alias("__doc"), F.col("name").alias("__name"), F.col("gone").alias("__gone"))
    keyed = docs.withColumns({"__doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)), "__name": F.coalesce(F.xxhash64("text"), F.lit(0))})
    return keyed.join(gone, ["__doc", "__name"], "left")


def drop_duplicate_lines(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """``docs`` with the duplicate lines taken out of ``text``; every row stays."""
    kept = F.filter(F.split("text", "\n"), lambda line, k: ~F.array_contains("__gone", k))
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return _with_gone(docs, similarity).withColumn("text", text).select(*docs.columns)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_lines, n_removed, removed_lines) of every row; null texts have no lines."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    none = F.array().cast("array<int>")
    # counted before the join, so that no text goes through it
    rows = _with_gone(docs.withColumn("__lines", F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n")))), SIMILARITY)
    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("__lines").cast("long").alias("n_lines"),
        F.size(F.coalesce("__gone", none)).cast("long").alias("n_removed"),
        F.coalesce("__gone", none).alias("removed_lines"),
    )
