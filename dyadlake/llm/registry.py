"""The queries of this subpackage and the SQL that checks those which SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import oracles
from .ann import op2_nearest_neighbours
from .line_dedup import op8_line_dedup
from .mixing import op6_mixing
from .near_dedup import op1_near_dedup
from .packing import op7_packing
from .pii import op3_pii
from .quality_model import op9_quality_classifier
from .quality_rules import op10_quality_rules
from .substring import op5_substring_dedup
from .token_counts import op4_token_counts


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_near_dedup": op1_near_dedup,
        "op2_nearest_neighbours": op2_nearest_neighbours,
        "op3_pii": op3_pii,
        "op4_token_counts": op4_token_counts,
        "op5_substring_dedup": op5_substring_dedup,
        "op6_mixing": op6_mixing,
        "op7_packing": op7_packing,
        "op8_line_dedup": op8_line_dedup,
        "op9_quality_classifier": op9_quality_classifier,
        "op10_quality_rules": op10_quality_rules,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_near_dedup": oracles.NEAR_DEDUP,
        "op5_substring_dedup": oracles.SUBSTRING_DEDUP,
    }
