"""Work batches: even chunks of a table, pairs of chunks, and batches that continue those already done."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import stats


def packed_size(items: int, batch_size: int | None = None, batches: int | None = None) -> int:
    """Items of a chunk under a largest size, a largest number of chunks or both; the number wins where both cannot hold."""
    if batch_size is None and batches is None:
        raise ValueError("a batch size or a number of batches is needed")
    if not items:
        return 1
    most = batch_size if batch_size is not None else -(-items // batches)
    chunks = batches if batches is not None else -(-items // batch_size)
    size = max(most, -(-items // chunks))
    # a full-sized last chunk is not needed: as many chunks, evenly filled
    return -(-items // -(-items // size)) if size == most else size


def numbered(df: DataFrame, order: list[Column], out: str = "place") -> DataFrame:
    """Rows numbered from 0 in order, without gathering them in one task."""
    return stats.running_total(df.withColumn("__one", F.lit(1)), order, "__one", out).withColumn(out, (F.col(out) - 1).cast("long")).drop("__one")


def batched(df: DataFrame, order: list[Column], batch_size: int | None = None, batches: int | None = None, out: str = "batch") -> DataFrame:
    """Consecutive rows in chunks of ``packed_size``."""
    size = packed_size(df.count(), batch_size, batches)
    return numbered(df, order, "__place").withColumn(out, F.floor(F.col("__place") / size).cast("long")).drop("__place")


def even_parts(df: DataFrame, order: list[Column], parts: int, out: str = "part") -> DataFrame:
    """Exactly ``parts`` runs whose sizes differ by one at most, the longer ones first."""
    items = df.count()
    short, longer = divmod(items, parts)
    place = F.col("__place")
    later = longer + F.floor((place - longer * (short + 1)) / max(short, 1))
    part = F.when(place < longer * (short + 1), F.floor(place / (short + 1))).otherwise(later)
    return numbered(df, order, "__place").withColumn(out, part.cast("long")).drop("__place")


def batch_pairs(df: DataFrame, batch: str = "batch") -> DataFrame:
    """(i, j), i <= j: what has to meet for all items to meet; one row a pair of batches."""
    ids = df.select(F.col(batch).alias("j")).distinct()
    most = ids.agg(F.max("j").alias("last"))
    return ids.crossJoin(F.broadcast(most)).select(F.explode(F.sequence(F.lit(0).cast("long"), F.col("j"))).alias("i"), "j")  # one row


def pairing_batches(pairs: DataFrame, batch_size: int, done: DataFrame | None = None) -> DataFrame:
    """(pairing_id, output): ids of (id, apo_monomer_id, body) in batches numbered after the last one of ``done`` (column output)."""
    last = None if done is None else done.agg(F.max("output")).first()[0]
    ids = pairs.select(F.concat_ws(":", "id", "apo_monomer_id", "body").alias("pairing_id"))
    first = 0 if last is None else last + 1
    return batched(ids, [F.col("pairing_id")], batch_size, out="output").withColumn("output", F.col("output") + first)
