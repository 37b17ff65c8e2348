"""Tables in the shared folder; lineage is cut with Parquet that every executor can read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dyadlake.operators.tables import Scratch, discard, shared_dir
from dyadlake.operators.tables import stored as materialize

__all__ = ["Scratch", "discard", "documents", "materialize", "shared_dir"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
