"""Mixing sources to target weights (operator 6, native): Sainte-Lague apportionment.

1. Sizes are word counts; sources in code-point order (null last) weigh
   5, 2, 1, repeating.  Targets are the water level of those weights under a
   ceiling of ``EPOCHS`` times each source's size: what resharing the excess
   until no source is above its ceiling arrives at.
2. The mix is cut into blocks of ``BLOCK`` words.  Blocks go to sources, and
   then each source's blocks to its shards, by highest quotients
   ``votes / (2 k + 1)``.  Seats that any order awards are counted in closed
   form from a divisor that cannot overshoot; only the last few, at most one or
   two a party, are ranked.
3. A shard's documents are laid in a line in seeded order.  Whole passes take
   every document; the rest is the line's start: whole documents of a seeded
   draw, and of the one at the end its first words, for the target is in words.

A source is dealt to shards of about ``SHARD`` words by id and text, so a source
or an id that holds a third of all rows is no larger a task than any other.  DataFrame operations
only.  Null and empty texts have size 0 and are never taken; repeated rows and
ids are rows of their own; the result depends on ids, sources and texts alone,
so reruns agree.  Extra columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import Scratch, documents

WEIGHTS = (5, 2, 1)
EPOCHS = 3
BLOCK = 256
SHARD = 500_000
SEED = 20240601
_LAST = (1 << 63) - 1
WORD = r"[^\x20\x09-\x0D]+"


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """Adds src (place), weight and target to (source, source_size); one row a source."""
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", "src")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    return (
        sources.withColumn("src", F.row_number().over(place))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("src") - 1, F.lit(len(weights))) + 1).cast("int")).cast("double"))
        .withColumn("ceiling", epochs * F.col("source_size").cast("double"))
        .withColumn("ratio", F.col("ceiling") / F.col("weight"))
        # the level if this source and all with larger ratios are below their ceilings
        .withColumn("level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("ceiling").over(before), F.lit(0.0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(everything)["level"])
        .withColumn("target", F.least(F.col("ceiling"), F.col("level") * F.col("weight")))
        .select("source", "source_size", "src", "weight", "target")
    )


def apportion(parties: DataFrame, group: list[str], party: str, votes: str, seats: str, out: str) -> DataFrame:
    """Adds ``out``: each party's seats of its group's ``seats`` by highest quotients votes / (2 k + 1), ties to the smaller party."""
    whole = Window.partitionBy(*group) if group else Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    v = F.col(votes).cast("double")
    total, n = F.sum(v).over(whole), F.count("*").over(whole)
    share = lambda k: F.when(total > 0, v * k / total).otherwise(0.0)
    # at this divisor rounding awards no more seats than there are, at the other no fewer
    sure = F.greatest(F.lit(0.0), F.floor(share(F.greatest(F.col(seats) - n / 2, F.lit(0.0))) + 0.5 - 1e-9)).cast("long")
    most = F.floor(share(F.col(seats) + n / 2) + 0.5 + 1e-9).cast("long")
    base = parties.withColumns({"_sure": sure, "_most": most})
    base = base.withColumn("_left", F.col(seats) - F.sum("_sure").over(whole))
    ranked = (
        base.where("_most > _sure")
        .select(*group, party, "_left", F.col(votes).alias("_v"), F.explode(F.sequence(F.col("_sure"), F.col("_most") - 1)).alias("_k"))
        .withColumn("_rank", F.row_number().over((Window.partitionBy(*group) if group else Window).orderBy((F.col("_v") / (2 * F.col("_k") + 1)).desc(), party, "_k")))
        .where("_rank <= _left")
        .groupBy(*group, party)
        .agg(F.count("*").alias("_more"))
    )
    return base.join(ranked, [*group, party], "left").withColumn(out, F.col("_sure") + F.coalesce("_more", F.lit(0))).drop("_sure", "_most", "_left", "_more")


def _mix(docs: DataFrame, weights: tuple[int, ...], epochs: int, block: int, seed: int) -> DataFrame:
    """(row, doc_id, source, size, source_size, target, taken) of every document; a stored table."""
    with Scratch() as s:
        return s.keep(_mixed(docs, weights, epochs, block, seed, s))


def _mixed(docs: DataFrame, weights: tuple[int, ...], epochs: int, block: int, seed: int, s: Scratch) -> DataFrame:
    size: Column = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "source", size.alias("size"), F.xxhash64("text").alias("name"))
    sized = s.store(numbered, "mix-sized")
    table = s.store(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, epochs), "mix-targets")
    seats = table.withColumn("_blocks", F.round(F.sum("source_size").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) / block).cast("long"))
    quotas = s.store(apportion(seats, [], "src", "target", "_blocks", "quota").drop("_blocks"), "mix-quotas")

    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / SHARD)).cast("long")
    placed = sized.join(quotas, sized["source"].eqNullSafe(quotas["source"])).drop(quotas["source"]).withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "name"), shards))
    sizes = placed.groupBy("src", "shard").agg(F.sum("size").alias("shard_size"), F.max("quota").alias("quota"))
    taken = (
        apportion(sizes, ["src"], "shard", "shard_size", "quota", "blocks")
        .withColumn("words", F.least(F.col("blocks") * block, epochs * F.col("shard_size")))
        .withColumn("passes", F.when(F.col("shard_size") > 0, F.floor(F.col("words") / F.col("shard_size"))).otherwise(0))
        .withColumn("rest", F.col("words") - F.col("passes") * F.col("shard_size"))
        .select("src", "shard", "shard_size", "passes", "rest")
    )
    shares = s.store(taken, "mix-shards")
    line = Window.partitionBy("src", "shard").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id", "name"), "doc_id", "size", "row")
    laid = placed.where("size > 0").withColumn("at", F.sum("size").over(line) - F.col("size"))
    drawn = (
        laid.join(shares.where("rest > 0").select("src", "shard", "rest"), ["src", "shard"])
        .where("at < rest")
        .select("row", F.least(F.col("size"), F.col("rest") - F.col("at")).alias("extra"))
    )
    every = (
        placed.join(shares.select("src", "shard", "passes"), ["src", "shard"])
        .join(drawn, "row", "left")
        .select("row", "doc_id", "source", "size", "source_size", "target", (F.col("passes") * F.col("size") + F.coalesce("extra", F.lit(0))).cast("long").alias("taken"))
    )
    return s.store(every, "mix-taken")


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(row, doc_id, size, source_size, target, taken) of every document."""
    return _mix(docs, weights, epochs, block, seed).drop("source")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """``docs`` as the mix takes them: a row for every whole pass over a document or draw of it, and at most one a shard cut behind its last taken word.

    Rows alike in id, source and size are told apart by their texts; documents of which it takes nothing go.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    key = ["__id", "__size", "__source"]
    alike = Window.partitionBy(*key)
    source = F.struct("source")  # equal to itself where it is null
    shares = (
        _mix(docs, weights, epochs, block, seed)
        .where("size > 0")
        .select(F.coalesce("doc_id", F.lit(_LAST)).alias("__id"), F.col("size").alias("__size"), source.alias("__source"), F.col("taken").alias("__taken"))
        .withColumn("__nth", F.row_number().over(alike.orderBy(F.desc("__taken"))))
        .where("__taken > 0")
    )
    keyed = docs.withColumn("__id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))).withColumns({"__size": size, "__source": source}).where("__size > 0")
    keyed = keyed.withColumn("__nth", F.row_number().over(alike.orderBy(F.xxhash64("text"))))
    copies = keyed.join(shares, [*key, "__nth"]).withColumn("__pass", F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col("__taken") / F.col("__size")))))
    left = F.least(F.col("__size"), F.col("__taken") - (F.col("__pass") - 1) * F.col("__size")).cast("int")
    cut = F.array_join(F.slice(F.split("text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"), F.lit(1), left), "")
    text = F.when(left < F.col("__size"), cut).otherwise(F.col("text"))
    return copies.withColumn("text", text).select(*docs.columns)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir)).drop("row")
