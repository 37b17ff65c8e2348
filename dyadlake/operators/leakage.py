"""Reports on what two sets share: labels, unordered label pairs, diversity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pair_intersection(train: DataFrame, other: DataFrame, a: str, b: str) -> DataFrame:
    """Unordered label pairs in both sets."""
    pairs = lambda df: df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
    return pairs(train).intersect(pairs(other))


def rows_in_pairs(df: DataFrame, pairs: DataFrame, a: str, b: str) -> DataFrame:
    keyed = df.withColumns({"lo": F.least(a, b), "hi": F.greatest(a, b)})
    return keyed.join(pairs, ["lo", "hi"], "left_semi").drop("lo", "hi")


def leak_report(df: DataFrame, train: DataFrame, a: str, b: str, unknown: str = "UNDEFINED") -> DataFrame:
    """One row: rows, leaking rows, percentage; rows of an unknown label count as no leak."""
    pairs = pair_intersection(train, df, a, b).where((F.col("lo") != unknown) & (F.col("hi") != unknown))
    marked = df.withColumns({"lo": F.least(a, b), "hi": F.greatest(a, b)}).join(pairs.withColumn("__in", F.lit(1)), ["lo", "hi"], "left")
    return marked.agg(F.count("*").alias("n_rows"), F.count("__in").alias("n_leaking")).withColumn("percent", F.round(100 * F.try_divide("n_leaking", "n_rows"), 6))


def unique_label_counts(df: DataFrame, known: DataFrame, a: str, b: str) -> DataFrame:
    """How many rows have 0, 1 or 2 labels that the known set lacks."""
    k = known.select(F.col("label").alias("__k")).distinct()
    ka, kb = k.select(F.col("__k").alias("__a")), k.select(F.col("__k").alias("__b"))
    new = df.join(ka, F.col(a) == F.col("__a"), "left").join(kb, F.col(b) == F.col("__b"), "left")
    n = F.when(F.col("__a").isNull(), 1).otherwise(0) + F.when(F.col("__b").isNull(), 1).otherwise(0)
    return new.groupBy(n.alias("n_unique")).agg(F.count("*").alias("n_rows"))


def diversity(df: DataFrame, group: Column, labels: list[str]) -> DataFrame:
    """Distinct labels over both sides of each group, and their share of all distinct labels."""
    long = df.select(group.alias("grp"), F.explode(F.array(*labels)).alias("label")).where("label is not null").distinct()
    total = long.agg(F.count_distinct("label").alias("n_all"))
    return long.groupBy("grp").agg(F.count("*").alias("n_labels")).crossJoin(F.broadcast(total)).withColumn("percent", F.round(100 * F.try_divide("n_labels", "n_all"), 6))  # one row


def shared_windows(docs: DataFrame, items: DataFrame, doc: str, item: str, text: str, words: int = 8) -> DataFrame:
    """(doc, item, n_shared): word windows of the items' texts that occur in a document.

    Words are split and hashed once a text, in a column of their own; windows are
    compared by two 64-bit hashes, so no window's text is built or shuffled.
    """

    def windows(df: DataFrame, key: str) -> DataFrame:
        split = df.select(key, F.regexp_extract_all(F.lower(text), F.lit(r"(\S+)"), F.lit(1)).alias("__w"))
        hashed = split.select(key, F.transform("__w", lambda w: F.xxhash64(w)).alias("__a"), F.transform("__w", lambda w: F.xxhash64(F.lit(words), w)).alias("__b"))
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("__a") - words + 1))
        spans = F.transform(starts, lambda i: F.struct(F.xxhash64(F.slice("__a", i, words)).alias("h1"), F.xxhash64(F.slice("__b", i, words)).alias("h2")))
        return hashed.where(F.col("__a").isNotNull()).select(key, F.explode(spans).alias("__s")).select(key, "__s.h1", "__s.h2")

    return windows(docs, doc).join(windows(items, item).distinct(), ["h1", "h2"]).groupBy(doc, item).agg(F.count_distinct("h1", "h2").alias("n_shared"))
