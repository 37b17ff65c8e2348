"""Dataset splits: representatives, proto-labels, running de-leak, masks and the final order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import rel

SPLITS = ("test", "val", "train", "invalid")


def representatives(metadata: DataFrame, limits: dict[str, Column], date: str, cutoff: str) -> tuple[DataFrame, DataFrame]:
    """(rows that pass every quality term, those of them after the cut-off date)."""
    passed = metadata
    for term in limits.values():
        passed = passed.where(term)
    return passed, passed.where(F.to_date(date) > F.lit(cutoff).cast("date"))


def proto_labels(index: DataFrame, chosen: DataFrame, key: str, clusters: tuple[str, str] = ("cluster_id_R", "cluster_id_L")) -> DataFrame:
    """Unclustered rows go; the chosen are proto-test, the rest proto-train."""
    kept = index.where((F.col(clusters[0]) != -1) & (F.col(clusters[1]) != -1))
    mark = chosen.select(key).distinct().withColumn("__test", F.lit(True))
    return kept.join(mark, key, "left").withColumn("split", F.when(F.col("__test"), "proto-test").otherwise("proto-train")).drop("__test")


def cluster_name(r: Column, l: Column) -> Column:  # noqa: E741
    """Order-free name of a pair of clusters; an unknown one is -1."""
    a, b = F.coalesce(r, F.lit(-1)), F.coalesce(l, F.lit(-1))
    return F.concat_ws("_", F.lit("cluster"), F.least(a, b), F.greatest(a, b))


def peptide_cluster(cluster: Column, length: Column, shortest: int) -> Column:
    return F.when(length >= shortest, cluster.cast("string")).otherwise("p")


def top_per_cluster(df: DataFrame, cluster: str, order: list, n: int = 1) -> DataFrame:
    return rel.top_k(df, [cluster], order, n)


def deleak(index: DataFrame, leaks: DataFrame, key: str) -> DataFrame:
    """Training rows that reach a test row, by (id, leaked), become invalid."""
    bad = leaks.select(F.col("leaked").alias(key)).distinct().withColumn("__leak", F.lit(True))
    marked = index.join(bad, key, "left")
    return marked.withColumn("split", F.when(F.col("__leak") & (F.col("split") == "train"), "invalid").otherwise(F.col("split"))).drop("__leak")


def final_order(df: DataFrame, keys: list[str]) -> DataFrame:
    """test, val, train, invalid, then keys."""
    return df.orderBy(F.array_position(F.array(*map(F.lit, SPLITS)), F.col("split")), *keys)


def promote(df: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    """Seeded promotion of ``n`` validation rows to test."""
    w = Window.partitionBy("split").orderBy(F.xxhash64(F.lit(seed), key), key)
    chosen = df.where("split = 'val'").withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).select(key).withColumn("__up", F.lit(True))
    return df.join(chosen, key, "left").withColumn("split", F.when(F.col("__up"), "test").otherwise(F.col("split"))).drop("__up")
