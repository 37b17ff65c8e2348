"""All queries of the library outside the training-data subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import annotations, assembly, control, graphs, joins, rankings  # noqa: F401  (their queries register themselves)
from .catalog import ORACLES, QUERIES


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaderboard: best of the first k per system, medians and hit rates per method."""
    return QUERIES["leaderboard_topk_median"](spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
