"""Relational helpers: natural, role-playing, fallback and membership joins, keep-first, top-k, pair keys.

All are plans of built-in expressions; nothing is collected and no side is
broadcast by hand, so the optimizer picks each join's strategy by size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _last(order) -> list[Column]:
    """Order columns with nulls last in both directions; '-' in front means descending."""
    out = []
    for c in order:
        if isinstance(c, Column):
            out.append(c)
        else:
            out.append(F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_last())
    return out


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner", null_safe: bool = False) -> DataFrame:
    """Join on every shared column name; raises when there is none."""
    keys = [c for c in left.columns if c in right.columns]
    if not keys:
        raise ValueError("no shared columns to join on")
    if not null_safe:
        return left.join(right, keys, how)
    renamed = right.select([F.col(c).alias(f"__{c}") if c in keys else F.col(c) for c in right.columns])
    on = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in keys))
    joined = left.join(renamed, on, how)
    merged = [F.coalesce(F.col(c), F.col(f"__{c}")).alias(c) if c in keys else F.col(c) for c in left.columns]
    return joined.select(*merged, *[c for c in right.columns if c not in keys])


def role_join(fact: DataFrame, dim: DataFrame, key: str, roles: dict[str, str], how: str = "left") -> DataFrame:
    """Join one dimension once per role: ``roles`` maps a suffix to the fact's key column; attributes get the suffix."""
    for suffix, column in roles.items():
        side = dim.select(*[F.col(c).alias(column if c == key else f"{c}{suffix}") for c in dim.columns])
        fact = fact.join(side, column, how)
    return fact


def outer_fold(key: str, frames: list[DataFrame]) -> DataFrame:
    """Full outer joins of all frames on ``key``."""
    return reduce(lambda a, b: a.join(b, key, "full"), frames)


def fallback_join(left: DataFrame, right: DataFrame, right_key: str, left_keys: list[Column], take: list[str]) -> DataFrame:
    """Match on the first of several keys that finds a row: one equi-join a key, first non-null wins.

    Of several rows with a key, the one of the smallest ``take`` values matches: rows of ``left`` never multiply.
    """
    out = left
    right = right.where(F.col(right_key).isNotNull()).groupBy(right_key).agg(F.min(F.struct(*take)).alias("__first")).select(right_key, "__first.*")
    for k, key in enumerate(left_keys):
        side = right.select(F.col(right_key).alias(f"__k{k}"), *[F.col(c).alias(f"__{c}{k}") for c in take])
        out = out.withColumn(f"__l{k}", key).join(side, F.col(f"__l{k}") == F.col(f"__k{k}"), "left")
    matched = F.coalesce(*[F.when(F.col(f"__k{k}").isNotNull(), F.lit(k)) for k in range(len(left_keys))])
    values = [F.coalesce(*[F.when(F.col(f"__k{k}").isNotNull(), F.col(f"__{c}{k}")) for k in range(len(left_keys))]).alias(c) for c in take]
    return out.select(*left.columns, *values, matched.alias("matched_by"))


def or_semi_join(rows: DataFrame, columns: list[str], members: DataFrame, key: str) -> DataFrame:
    """Rows of which any of ``columns`` is a member; one semi-join a column instead of an OR condition."""
    ids = members.select(F.col(key).alias("__m")).distinct()
    tagged = rows
    for k, c in enumerate(columns):
        side = ids.select(F.col("__m").alias(f"__m{k}"))
        tagged = tagged.join(side, F.col(c) == F.col(f"__m{k}"), "left")
    return tagged.where(F.coalesce(*[F.col(f"__m{k}") for k in range(len(columns))]).isNotNull()).select(*rows.columns)


def pending(inputs: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Inputs without a finished output."""
    return inputs.join(done.select(*keys).distinct(), keys, "left_anti")


def top_k(df: DataFrame, by: list[str], order: list, k: int) -> DataFrame:
    """First ``k`` rows of every group; the group limit runs before the shuffle as well."""
    w = Window.partitionBy(*by).orderBy(*_last(order))
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= k).drop("__rn")


def keep_first(df: DataFrame, by: list[str], order: list) -> DataFrame:
    return top_k(df, by, order, 1)


def unordered_pair(a: str, b: str, sep: str = "--") -> Column:
    return F.concat_ws(sep, F.least(F.col(a).cast("string"), F.col(b).cast("string")), F.greatest(F.col(a).cast("string"), F.col(b).cast("string")))


def best_per_pair(df: DataFrame, a: str, b: str, score: str, tie: list[str]) -> DataFrame:
    """One row for each unordered pair: that of the best score."""
    pair = df.withColumns({"first": F.least(a, b), "second": F.greatest(a, b)})
    return keep_first(pair, ["first", "second"], [f"-{score}", *tie])


def ordered_concat(df: DataFrame, by: list[str], value: str, order: list[str], sep: str = ";") -> DataFrame:
    """(by, first, others): a group's values in order, the first on its own."""
    items = F.array_sort(F.collect_list(F.struct(*[F.col(c).alias(f"o{k}") for k, c in enumerate(order)], F.col(value).alias("v"))))
    return df.groupBy(*by).agg(items.alias("__i")).select(*by, F.element_at("__i", 1)["v"].alias("first"), F.array_join(F.transform(F.slice("__i", F.lit(2), F.greatest(F.size("__i") - 1, F.lit(0))), lambda x: x["v"].cast("string")), sep).alias("others"))


def complete(actual: DataFrame, expected: DataFrame, keys: list[str], penalty: dict[str, object]) -> DataFrame:
    """Adds a penalty row for each expected key that has no actual row."""
    missing = expected.select(*keys).distinct().join(actual.select(*keys).distinct(), keys, "left_anti")
    rows = missing.withColumns({c: F.lit(v) for c, v in penalty.items()}).withColumn("penalised", F.lit(True))
    return actual.withColumn("penalised", F.lit(False)).unionByName(rows, allowMissingColumns=True)


def unpivot_sides(df: DataFrame, keys: list[str], sides: dict[str, dict[str, str]]) -> DataFrame:
    """One row a side: ``sides`` maps a label to {output column: input column}."""
    structs = [F.struct(F.lit(label).alias("side"), *[F.col(c).alias(out) for out, c in columns.items()]) for label, columns in sides.items()]
    return df.select(*keys, F.explode(F.array(*structs)).alias("__s")).select(*keys, "__s.*")


def explode_padded(df: DataFrame, keep: list[str], lists: list[str], sep: str, nulls: tuple[str, ...] = ("NA",)) -> DataFrame:
    """Explode parallel separated lists; short ones repeat their first value, null tokens become null."""
    split = df.select(*keep, *[F.split(c, F.lit("\\" + sep)).alias(c) for c in lists])
    size = F.greatest(*[F.size(c) for c in lists]) if len(lists) > 1 else F.size(lists[0])
    rows = split.select(*keep, *lists, F.explode(F.sequence(F.lit(0), size - 1)).alias("pos"))
    pick = lambda c: F.coalesce(F.get(c, F.col("pos")), F.get(c, F.lit(0)))
    return rows.select(*keep, "pos", *[F.when(~pick(c).isin(*nulls), pick(c)).alias(c) for c in lists])


def upsert(base: DataFrame, patch: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``base`` with ``columns`` taken from ``patch`` where it has the key."""
    side = patch.select(key, *[F.col(c).alias(f"__{c}") for c in columns])
    joined = base.join(side, key, "left")
    return joined.select(*[F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in base.columns])
