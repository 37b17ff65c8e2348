"""Docking leaderboards: top-k per system, best of them, medians, hit rates, penalties for missing systems."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import last_number
from . import rel, stats


def ranked(metrics: DataFrame, name: str = "model_name") -> DataFrame:
    """Rank from the last number of a model's name; a name without one is an error."""
    rank = last_number(name)
    return metrics.withColumn("rank", F.when(F.isnull(rank), F.raise_error(F.concat(F.lit("no rank in "), F.col(name))).cast("int")).otherwise(rank))


def top_k_oracle(metrics: DataFrame, by: list[str], k: int, score: str, rank: str = "rank", tie: str = "model_name") -> DataFrame:
    """Best score of the k first ranked rows of each group."""
    return rel.top_k(metrics, by, [rank, tie], k).groupBy(*by).agg(F.max(score).alias(score))


def median_oracle(metrics: DataFrame, system: list[str], method: list[str], score: str) -> DataFrame:
    """Best per system, then the median per method."""
    return stats.medians(metrics.groupBy(*system).agg(F.max(score).alias(score)), method, [score])


def leaderboard(metrics: DataFrame, method: list[str], system: str, score: str, hit: Column, ks: tuple[int, ...], rank: str, tie: str) -> DataFrame:
    """One row a method: systems, medians and hit rates at each k and over all poses.

    All ks come from one ranking: the best score among the first k is a conditional maximum.
    """
    widest = rel.top_k(metrics, [*method, system], [rank, tie], max(ks)) if ks else metrics
    place = F.row_number().over(Window.partitionBy(*method, system).orderBy(F.col(rank).asc_nulls_last(), tie))
    numbered = widest.withColumn("__p", place)
    best = numbered.groupBy(*method, system).agg(*[F.max(F.when(F.col("__p") <= k, F.col(score))).alias(f"top{k}") for k in ks])
    columns = []
    for k in ks:
        columns += [F.round(F.median(f"top{k}"), 6).alias(f"median_top{k}"), F.round(F.avg(F.when(F.col(f"top{k}").isNotNull() & hit_of(hit, score, f"top{k}"), 100.0).otherwise(0.0)), 6).alias(f"hit_top{k}")]
    return best.groupBy(*method).agg(F.count("*").alias("n_systems"), *columns)


def hit_of(threshold, score: str, column: str) -> Column:
    """The hit test on another column: thresholds are numbers, other tests functions of a column."""
    return threshold(F.col(column)) if callable(threshold) else F.col(column) >= threshold


def with_penalties(metrics: DataFrame, expected: DataFrame, keys: list[str], worst: dict[str, object]) -> DataFrame:
    return rel.complete(metrics, expected, keys, worst)


def success_rate(df: DataFrame, by: list[str], hit: Column, leaked: DataFrame | None = None, key: str = "id") -> DataFrame:
    """Percentage of hits, without leaked systems where given."""
    if leaked is not None:
        df = df.join(leaked.select(key).distinct(), key, "left_anti")
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.round(100 * F.try_divide(F.sum(F.when(hit, 1).otherwise(0)), F.count("*")), 6).alias("success_rate"))


def best_permutation(metrics: DataFrame, by: list[str], score: str, tie: list[str]) -> DataFrame:
    return rel.keep_first(metrics, by, [f"-{score}", *tie])


def summary(metrics: DataFrame, by: list[str], score: str, hit: Column) -> DataFrame:
    """Median of best scores per group beside one hit rate over all rows."""
    overall = metrics.agg(F.round(F.avg(F.when(hit, 100.0).otherwise(0.0)), 6).alias("hit_rate"))
    return stats.medians(metrics, by, [score]).crossJoin(F.broadcast(overall))  # one row


#: The best value of each measure: low deviations, high shares.
BEST = {"irms": F.min, "lrms": F.min, "fnat": F.max, "dockq": F.max, "capri_rank": F.max}
#: Hit tests on a system's best values.
HITS = {
    "irms_2a": lambda c: c("irms") <= 2,
    "lrms_5a": lambda c: c("lrms") <= 5,
    "fnat_08": lambda c: c("fnat") >= 0.8,
    "acceptable": lambda c: c("capri_rank") >= 1,
    "medium": lambda c: c("capri_rank") >= 2,
    "high": lambda c: c("capri_rank") >= 3,
}


def full_board(metrics: DataFrame, method: list[str], system: str, rank: str, tie: list[str], tops: tuple[int, ...] = (1, 5), shares: tuple[float, ...] = (0.25, 0.5), digits: int = 6) -> DataFrame:
    """One row a method: medians of every pose set's best values, and hit rates of the whole and the top sets.

    Pose sets are the first k of a ranking, those up to a quantile of the ranks,
    and all.  All of them are masks over one partitioning by system: one window,
    one aggregate a system, one a method, and no join.
    """
    group = Window.partitionBy(*method, system)
    numbered = metrics.withColumn("__p", F.row_number().over(group.orderBy(F.col(rank).asc_nulls_last(), *tie)))
    numbered = numbered.withColumns({f"__q{k}": F.percentile(rank, q).over(group) for k, q in enumerate(shares)})
    sets = {f"top{k}": F.col("__p") <= k for k in tops}
    sets |= {f"first{round(100 * q)}": F.col(rank) <= F.col(f"__q{k}") for k, q in enumerate(shares)}
    sets["oracle"] = F.lit(True)
    best = numbered.groupBy(*method, system).agg(*[f(F.when(mask, F.col(c))).alias(f"{c}_{name}") for name, mask in sets.items() for c, f in BEST.items()])
    medians = [F.round(F.median(f"{c}_{name}"), digits).alias(f"{c}_median_{name}") for name in sets for c in BEST if c != "capri_rank"]
    hits = [
        F.round(F.avg(F.when(test(lambda c: F.col(f"{c}_{name}")), 100.0).otherwise(0.0)), digits).alias(f"{label}_{name}")  # noqa: B023
        for name in ("oracle", *(f"top{k}" for k in tops))
        for label, test in HITS.items()
    ]
    return best.groupBy(*method).agg(F.count("*").alias("n_systems"), *medians, *hits)


def with_missing(board: DataFrame, metrics: DataFrame, method: list[str], system: str, missing: Column) -> DataFrame:
    """The board with the number of systems that a method has only a penalty for."""
    gaps = metrics.groupBy(*method).agg(F.count_distinct(F.when(missing, F.col(system))).alias("missing_systems"))
    return gaps.join(board, method, "left")


def median_hit_share(metrics: DataFrame, by: list[str], hit: Column) -> DataFrame:
    """One row: the median over groups of the share of their rows that hit."""
    return metrics.groupBy(*by).agg(F.avg(F.when(hit, 1.0).otherwise(0.0)).alias("__share")).agg(F.round(F.median("__share"), 6).alias("median_hit_share"))


def expected_counts(index: DataFrame, subsets: dict[str, Column], kinds: tuple[str, ...] = ("holo", "apo", "predicted"), key: str = "id") -> DataFrame:
    """(subset, kind, n): systems of a subset that have both chains of a kind, from one pass."""
    cells = F.array(*[F.when(c & F.col(f"{kind}_R") & F.col(f"{kind}_L"), F.struct(F.lit(label).alias("subset"), F.lit(kind).alias("kind"))) for label, c in subsets.items() for kind in kinds])
    return index.select(key, F.explode(F.filter(cells, lambda x: x.isNotNull())).alias("c")).groupBy("c.subset", "c.kind").agg(F.count_distinct(key).alias("n"))


def spread_kinds(metrics: DataFrame, index: DataFrame, method: Column, eligible: dict[str, Column], out: str = "kind", key: str = "id") -> DataFrame:
    """A method's rows once for every kind their system is eligible for; other methods as they are."""
    kinds = F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in eligible.items()]), lambda x: x.isNotNull())
    spread = metrics.where(method).drop(out).join(index.select(key, F.explode(kinds).alias(out)), key)
    return spread.select(*metrics.columns).unionByName(metrics.where(~method))


def only_within(metrics: DataFrame, method: Column, inside: Column) -> DataFrame:
    """Rows of some methods count only inside a subset."""
    return metrics.where(~method | inside)


def masked_and_raw(metrics: DataFrame, mask: str, names: tuple[str, str], out: str = "method_name") -> DataFrame:
    """Both halves of a table under names of their own: (masked, raw)."""
    return metrics.withColumn(out, F.when(F.col(mask), names[0]).otherwise(names[1]))
