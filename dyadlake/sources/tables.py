"""Tolerant table scans and their sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import ALIGNMENT, struct

#: Null tokens of delimited files; the chain id NA and the word None are not among them.
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NULL", "NaN", "n/a", "nan", "null")


def read_delimited(spark: SparkSession, paths: str | list[str], sep: str = ",", types: dict[str, str] | None = None) -> DataFrame:
    """All columns as strings with null tokens removed (never 'NA'), then cast where asked; malformed rows do not fail the scan."""
    raw = spark.read.options(header=True, sep=sep, mode="PERMISSIVE", nullValue="\u0000", emptyValue="", ignoreCorruptFiles="true").csv(paths)
    clean = raw.select(*[F.when(~F.col(f"`{c}`").isin(*NULL_TOKENS), F.col(f"`{c}`")).alias(c) for c in raw.columns])
    return clean.select(*[F.col(f"`{c}`").try_cast((types or {})[c]).alias(c) if c in (types or {}) else F.col(f"`{c}`") for c in clean.columns])


def read_alignments(spark: SparkSession, paths: str | list[str], score_default: float = 0.5) -> DataFrame:
    """Header-less alignment records; a score that is missing or not a number takes the default."""
    df = spark.read.options(sep="\t", nanValue="nan").schema(struct(ALIGNMENT)).csv(paths)
    return df.withColumn("score", F.coalesce(F.nanvl("score", F.lit(score_default)), F.lit(score_default)))


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """Parquet, JSON lines or delimited text by suffix."""
    name = path.removesuffix(".gz")
    if name.endswith(".json"):
        return spark.read.option("mode", "PERMISSIVE").json(path)
    if name.endswith((".csv", ".tsv", ".txt")):
        return read_delimited(spark, path, "\t" if name.endswith((".tsv", ".txt")) else ",")
    return spark.read.option("mergeSchema", True).parquet(path)


def read_records(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(records, rows of the lines that do not parse) of JSON contact or annotation files."""
    df = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").schema(schema + ", _corrupt string").json(path)
    return df.where("_corrupt is null").drop("_corrupt"), df.where("_corrupt is not null")


def flatten(df: DataFrame, sep: str = "_", depth: int = 3) -> DataFrame:
    """Nested structs as wide columns a_b_c."""
    for _ in range(depth):
        nested = [f for f in df.schema.fields if f.dataType.typeName() == "struct"]
        if not nested:
            break
        df = df.select(*[F.col(f"`{f.name}`") if f not in nested else F.col(f"`{f.name}`.`{g.name}`").alias(f"{f.name}{sep}{g.name}") for f in df.schema.fields for g in (f.dataType.fields if f in nested else [None])])
    return df


def with_sentinels(entries: DataFrame, found: DataFrame, key: str, sentinels: dict[str, object]) -> DataFrame:
    """Every entry, those without a row with sentinel values."""
    joined = entries.select(key).distinct().join(found, key, "left")
    return joined.fillna(sentinels)


def write_table(df: DataFrame, path: str, by: list[str] | None = None, mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").options(header=True, sep=sep, compression="gzip").csv(path)


def write_alignments(df: DataFrame, path: str, keep) -> None:
    """All records and those that pass the filter, from one scan each."""
    df.write.mode("overwrite").parquet(f"{path}/alignment.parquet")
    df.sparkSession.read.parquet(f"{path}/alignment.parquet").where(keep).write.mode("overwrite").parquet(f"{path}/filtered_alignment.parquet")
