"""Aggregates, bins and samples with exact quantiles and seeded draws."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored


def hit_rates(df: DataFrame, by: list[str], tests: dict[str, Column], digits: int = 6) -> DataFrame:
    """Percentage of a group's rows that pass each test."""
    return df.groupBy(*by).agg(*[F.round(F.avg(F.when(t, 100.0).otherwise(0.0)), digits).alias(n) for n, t in tests.items()])


def extremes(df: DataFrame, by: list[str], high: list[str], low: list[str]) -> DataFrame:
    """The oracle of a group: maxima of some measures, minima of others."""
    return df.groupBy(*by).agg(*[F.max(c).alias(c) for c in high], *[F.min(c).alias(c) for c in low])


def medians(df: DataFrame, by: list[str], columns: list[str], digits: int = 6) -> DataFrame:
    return df.groupBy(*by).agg(*[F.round(F.median(c), digits).alias(c) for c in columns])


def within_quantile(df: DataFrame, by: list[str], column: str, q: float) -> DataFrame:
    """Rows at or under their group's linearly interpolated quantile."""
    cut = df.groupBy(*by).agg(F.percentile(column, q).alias("__cut"))
    return df.join(cut, by).where(F.col(column) <= F.col("__cut")).drop("__cut")


def tercile_label(df: DataFrame, column: str, labels=("low", "medium", "high")) -> DataFrame:
    """Equal-count bins at the exact terciles, right-closed."""
    cuts = df.agg(F.percentile(column, [1 / 3, 2 / 3]).alias("__q"))
    binned = df.crossJoin(F.broadcast(cuts))  # one row
    label = F.when(F.col(column) <= F.col("__q")[0], labels[0]).when(F.col(column) <= F.col("__q")[1], labels[1]).otherwise(labels[2])
    return binned.withColumn("bin", F.when(F.col(column).isNotNull(), label)).drop("__q")


def equal_width_bin(df: DataFrame, column: str, bins: int, out: str = "bin") -> DataFrame:
    """Right-closed bins of equal width between minimum and maximum; the first holds the minimum."""
    ends = df.agg(F.min(column).alias("__lo"), F.max(column).alias("__hi"))
    x = F.try_divide((F.col(column) - F.col("__lo")) * bins, F.col("__hi") - F.col("__lo"))
    index = F.when(F.col(column).isNotNull(), F.greatest(F.lit(1), F.least(F.lit(bins), F.ceil(F.coalesce(x, F.lit(0.0))).cast("int"))))
    return df.crossJoin(F.broadcast(ends)).withColumn(out, index).drop("__lo", "__hi")


def zscore_mean(df: DataFrame, by: list[str], columns: dict[str, int], out: str = "score") -> DataFrame:
    """Mean of group-wise z-scores (population deviation, 0 counts as 1); sign -1 where lower is better."""
    w = Window.partitionBy(*by)
    parts = []
    for c, sign in columns.items():
        sd = F.stddev_pop(c).over(w)
        parts.append(sign * (F.col(c) - F.avg(c).over(w)) / F.when(sd == 0, 1.0).otherwise(sd))
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return df.withColumn(out, total / len(parts))


def sample_per_group(df: DataFrame, by: list[str], n: int, key: str, seed: int = 0) -> DataFrame:
    """``n`` rows of each group in seeded order of ``key``: reruns agree."""
    w = Window.partitionBy(*by).orderBy(F.xxhash64(F.lit(seed), key), key)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def stratified_sample(df: DataFrame, columns: list[str], bins: int, n: int, key: str, seed: int = 0) -> DataFrame:
    """Weighted sample without replacement, weights the relative frequency of a row's bin (one or two columns)."""
    if not 1 <= len(columns) <= 2:
        raise ValueError("one or two columns")
    if bins < 2:
        raise ValueError("two bins at least")
    for k, c in enumerate(columns):
        df = equal_width_bin(df, c, bins, f"__b{k}")
    keys = [f"__b{k}" for k in range(len(columns))]
    sized = df.join(df.groupBy(*keys).count(), keys)
    # exponential races: the n smallest are a weighted sample without replacement
    unit = (F.pmod(F.xxhash64(F.lit(seed), key), F.lit((1 << 53) - 1)).cast("double") + 1) / float(1 << 53)
    return sized.withColumn("__race", -F.log(unit) / F.col("count")).orderBy("__race", key).limit(n).drop("__race", "count", *keys)


def threshold_sweep(df: DataFrame, column: str, hit: Column, start: float, step: float, steps: int) -> DataFrame:
    """(threshold, n, rate) over the rows at or under each threshold: one pass of counts, then running sums over the steps."""
    at = F.greatest(F.lit(0), F.ceil(F.round((F.col(column) - start) / step, 9))).cast("int")
    per = df.where(F.col(column).isNotNull()).select(at.alias("k"), F.when(hit, 1).otherwise(0).alias("h")).where(F.col("k") < steps).groupBy("k").agg(F.count("*").alias("c"), F.sum("h").alias("h"))
    every = df.sparkSession.range(steps).select(F.col("id").cast("int").alias("k"))
    w = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)  # as many rows as steps
    summed = every.join(per, "k", "left").select("k", F.sum(F.coalesce("c", F.lit(0))).over(w).alias("n"), F.sum(F.coalesce("h", F.lit(0))).over(w).alias("hits"))
    return summed.select(F.round(start + F.col("k") * step, 6).alias("threshold"), F.col("n").cast("long").alias("n"), F.round(F.try_divide("hits", "n"), 6).alias("rate"))


def running_total(df: DataFrame, order: list[Column], value: str, out: str, parts: int = 64) -> DataFrame:
    """Running sum over the whole table in two levels: range-partitioned sums, then sums within each part.

    The dealt rows are stored once: range bounds are sampled, so another reading could deal them otherwise.
    """
    dealt = stored(df.repartitionByRange(parts, *order).withColumn("__p", F.spark_partition_id()), "running-total")
    offsets = dealt.groupBy("__p").agg(F.sum(value).alias("__s"))
    w = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    offsets = offsets.select("__p", F.coalesce(F.sum("__s").over(w), F.lit(0)).alias("__o"))
    inside = Window.partitionBy("__p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return dealt.withColumn(out, F.sum(value).over(inside)).join(offsets, "__p").withColumn(out, F.col(out) + F.col("__o")).drop("__p", "__o")
