"""Annotations of chains and pairs: routed types, exploded lists, domain overlap, cascading matches, entity attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rel


def set_concat(df: DataFrame, by: list[str], value: str, sep: str = ",", out: str | None = None) -> DataFrame:
    """Distinct values of a group in one string, in order of value; null keys have no group."""
    keyed = df.where(F.col(value).isNotNull())
    for c in by:
        keyed = keyed.where(F.col(c).isNotNull())
    return keyed.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_set(F.col(value).cast("string"))), sep).alias(out or value))


def route_types(df: DataFrame, column: str, exact: dict[str, list[str]], contains: dict[str, list[str]], fallback: str = "other") -> DataFrame:
    """One row for each category whose names or fragments a row's type matches; the fallback where none does."""
    tests = {k: F.col(column).isin(*v) for k, v in exact.items()}
    for k, parts in contains.items():
        for part in parts:
            hit = F.col(column).contains(part)
            tests[k] = tests[k] | hit if k in tests else hit
    found = F.filter(F.array(*[F.when(t, F.lit(k)) for k, t in tests.items()]), lambda x: x.isNotNull())
    return df.withColumn("category", F.explode(F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(fallback)))))


def cascade_match(left: DataFrame, right: DataFrame, keys: list[str], chain: str, take: list[str]) -> DataFrame:
    """Match on the exact chain name, else on its first letter, else without case; ``matched_by`` says which.

    Of several rows with a name, the one of the smallest ``take`` values matches: rows of ``left`` never multiply.
    """
    joined = F.concat_ws("\x1f", *keys, chain)
    forms = [joined, F.concat_ws("\x1f", *keys, F.substring(chain, 1, 1)), F.lower(joined)]
    side = rel.keep_first(right.withColumn("__key", joined), ["__key"], take)
    lower = side.withColumn("__key", F.lower("__key"))
    lower = rel.keep_first(lower, ["__key"], [chain])
    both = side.select("__key", *take, F.lit(0).alias("__kind")).unionByName(lower.select("__key", *take, F.lit(1).alias("__kind")))
    out = left
    for k, form in enumerate(forms):
        kind = 1 if k == 2 else 0
        part = both.where(F.col("__kind") == kind).select(F.col("__key").alias(f"__r{k}"), *[F.col(c).alias(f"__{c}{k}") for c in take])
        out = out.withColumn(f"__l{k}", form).join(part, F.col(f"__l{k}") == F.col(f"__r{k}"), "left")
    which = F.coalesce(*[F.when(F.col(f"__r{k}").isNotNull(), F.lit(k)) for k in range(3)])
    return out.select(*left.columns, *[F.coalesce(*[F.when(F.col(f"__r{k}").isNotNull(), F.col(f"__{c}{k}")) for k in range(3)]).alias(c) for c in take], which.alias("matched_by"))


def domain_overlap(chains: DataFrame, domains: DataFrame, key: str, least: int = 1) -> DataFrame:
    """(key, name, overlap): interface residues (array ``residues``) inside each domain's closed range [first, last]."""
    inside = F.size(F.filter(F.array_distinct("residues"), lambda r: (r >= F.col("first")) & (r <= F.col("last"))))
    return chains.join(domains, key).select(key, "name", inside.alias("overlap")).where(F.col("overlap") >= least)


def widen_sides(fact: DataFrame, long: DataFrame, key: str, side: str, values: list[str], sides: tuple[str, str] = ("R", "L")) -> DataFrame:
    """Left joins that put each side's values beside the fact as value_R and value_L."""
    for s in sides:
        part = long.where(F.col(side) == s).select(key, *[F.col(v).alias(f"{v}_{s}") for v in values])
        fact = fact.join(part, key, "left")
    return fact


def oligomer_state(chains: DataFrame, entry: str, sequence: str) -> DataFrame:
    """(entry, n_chains, n_distinct, state) from how many chains have distinct sequences."""
    n = chains.groupBy(entry).agg(F.count("*").alias("n_chains"), F.count_distinct(sequence).alias("n_distinct"))
    state = F.when(F.col("n_chains") == 1, "monomer").when(F.col("n_distinct") == 1, "homomer").otherwise("heteromer")
    return n.withColumn("state", state)


def most_frequent(df: DataFrame, by: list[str], value: str, default: str) -> DataFrame:
    """The value with most rows in each group, the smaller of equals; the default for groups of nulls."""
    counts = df.groupBy(*by, value).agg(F.count(value).alias("n"))
    best = counts.groupBy(*by).agg(F.min(F.struct((-F.col("n")).alias("n"), F.coalesce(F.col(value).cast("string"), F.lit("\U0010ffff")).alias("v"))).alias("b"))
    return best.select(*by, F.when(F.col("b.n") < 0, F.col("b.v")).otherwise(default).alias(value))


def transient(pairs: DataFrame, bonds: DataFrame, key: str, intra: str, inter: str) -> DataFrame:
    """Flags of pairs by their bonds: none at all, only within chains, between chains."""
    b = pairs.join(bonds, key, "left").fillna(0, [intra, inter])
    return b.withColumns({"no_bonds": (F.col(intra) == 0) & (F.col(inter) == 0), "intra_only": (F.col(intra) > 0) & (F.col(inter) == 0), "linked": F.col(inter) > 0})


def neighbour_counts(df: DataFrame, key_r: str, key_l: str, observed: DataFrame, key: str, out: str) -> DataFrame:
    """Number of observed rows for each side's key, 0 where none."""
    n = observed.groupBy(key).agg(F.count("*").alias("__n"))
    for c, s in ((key_r, "R"), (key_l, "L")):
        df = df.join(n.select(F.col(key).alias(c), F.col("__n").alias(f"{out}_{s}")), c, "left").fillna(0, [f"{out}_{s}"])
    return df


def present(flags: dict[str, Column]) -> Column:
    """Names of the flags that hold, in the order given."""
    return F.filter(F.array(*[F.when(t, F.lit(k)) for k, t in flags.items()]), lambda x: x.isNotNull())
