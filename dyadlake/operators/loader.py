"""The loader: declared and free-text filters over catalogue and metadata, extension points, incremental stages."""

from __future__ import annotations

import hashlib
import json
import math
import operator
import re
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rel

Step = Callable[[DataFrame], DataFrame]
_COMPARE = {"==": operator.eq, "": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}


def condition(name: str, test: tuple[str, object]) -> Column:
    """One (operator, value) test as a column; null and not-a-number are the same value."""
    if not isinstance(test, tuple) or len(test) != 2:
        raise ValueError(f"{name}: a test is (operator, value)")
    op, value = test
    column = F.col(name)
    absent = value is None or (isinstance(value, float) and math.isnan(value))
    empty = column.isNull() | F.coalesce(F.isnan(column.try_cast("double")), F.lit(False))
    if absent:
        if op in ("is", "==", ""):
            return empty
        if op in ("is not", "!="):
            return ~empty
        raise ValueError(f"{name}: {op} has no meaning for a missing value")
    if op in ("is", "is not"):
        op = "==" if op == "is" else "!="
    if op not in _COMPARE:
        raise ValueError(f"{name}: unknown operator {op}")
    # a missing value differs from every value and is in no order with any
    return F.when(empty, F.lit(op == "!=")).otherwise(_COMPARE[op](column, F.lit(value)))


def where_fields(df: DataFrame, tests: dict[str, tuple[str, object]]) -> DataFrame:
    """All tests, joined by AND."""
    return df.where(reduce(lambda a, b: a & b, (condition(c, t) for c, t in tests.items()), F.lit(True)))


def free_text(query: str) -> Column:
    """A query in data-frame notation (&, |, ~, ==, in [..]) as a SQL expression; nothing is evaluated in Python."""
    parts = re.split(r"('(?:[^']*)'|\"(?:[^\"]*)\")", query)
    out = []
    for k, part in enumerate(parts):
        if k % 2:
            out.append("'" + part[1:-1].replace("'", "\\'") + "'")
            continue
        part = re.sub(r"\bnot in\s*\[", " NOT IN (", part)
        part = re.sub(r"\bin\s*\[", " IN (", part).replace("]", ")")
        part = part.replace("==", "=").replace("&", " AND ").replace("|", " OR ").replace("~", " NOT ")
        out.append(re.sub(r"\b(True|False|None)\b", lambda m: {"True": "TRUE", "False": "FALSE", "None": "NULL"}[m[0]], part))
    return F.expr("".join(out))


def load(index: DataFrame, metadata: DataFrame | None = None, split: str | None = None, subset: str | None = None, ids: Iterable[str] | None = None, index_query: str | None = None, metadata_query: str | None = None, steps: Iterable[Step] = ()) -> DataFrame:
    """Catalogue rows that pass every given selection; the steps (filters and transforms) follow in order."""
    out = index
    if split is not None:
        out = out.where(F.col("split") == split)
    if subset is not None:
        out = out.where(F.col(subset))
    if ids is not None:
        out = out.join(index.sparkSession.createDataFrame([(i,) for i in ids], "id string"), "id", "left_semi")
    if index_query:
        out = out.where(free_text(index_query))
    if metadata is not None:
        chosen = metadata.where(free_text(metadata_query)) if metadata_query else metadata
        out = out.join(chosen.select("id").distinct(), "id", "left_semi")
    for step in steps:
        out = out.transform(step)
    return out


def null_where(columns: list[str], keep: Column) -> Step:
    """A step that empties columns of rows that fail, without dropping the rows."""
    return lambda df: df.withColumns({c: F.when(keep, F.col(c)) for c in columns})


def keep_where(keep: Column) -> Step:
    return lambda df: df.where(keep)


def atom_counts(atoms: DataFrame, by: list[str]) -> DataFrame:
    """What structure filters ask: residues, atom types and backbone completeness of each structure."""
    polymer = ~F.col("hetero")
    backbone = F.count(F.when(polymer & F.col("atom_name").isin("N", "CA", "C"), 1))
    alpha = F.count(F.when(polymer & (F.col("atom_name") == "CA"), 1))
    return atoms.groupBy(*by).agg(
        F.count_distinct(F.when(polymer, F.struct("chain_id", "res_id", "ins_code"))).alias("n_residues"),
        F.count_distinct("atom_name").alias("n_atom_types"),
        alias_ratio(backbone, 3 * alpha),
    )


def alias_ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0)).alias("backbone_share")


def config_hash(config: dict) -> str:
    """Key of a stage's settings, whatever the order they are given in."""
    return hashlib.md5(json.dumps(config, sort_keys=True, default=str).encode()).hexdigest()


def run_stage(inputs: DataFrame, done_path: str, keys: list[str], work: Step, config: dict) -> DataFrame:
    """Process what has no output under these settings yet, and append it: a failed run starts where it stopped."""
    spark = inputs.sparkSession
    mark = config_hash(config)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(done_path)
    exists = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    todo = rel.pending(inputs, spark.read.parquet(done_path).where(F.col("config_hash") == mark), keys) if exists else inputs
    work(todo).withColumn("config_hash", F.lit(mark)).write.mode("append").parquet(done_path)
    return spark.read.parquet(done_path).where(F.col("config_hash") == mark)
