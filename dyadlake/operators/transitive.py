"""Split assembly: transitive leaks between systems, hit tables, proto-split summaries, cluster samples, detached chains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import graph, rel
from .structure import range_join
from .tables import Scratch, stored


def split_leakage(systems: DataFrame, edges: DataFrame, hops: int, threshold: float = 0.65, max_degree: int = 1000) -> DataFrame:
    """(id, leaked, considered): for each pure system those whose chains both lie in its chains' neighbourhoods.

    ``systems`` is (id, r, l, pure); pure and other systems leak alike.  A pure
    system with a chain above ``max_degree`` has one row, ``considered`` and
    without a leaked id.  Neighbourhoods are walked from the pure chains only,
    and pairs are met through the systems' own chains: no product of the lists.
    """
    with Scratch() as s:
        links = s.store(edges.where(F.col("weight") >= threshold).select("src", "dst"), "leak-links")
        pure = systems.where("pure").select("id", "r", "l")
        chains = pure.select(F.explode(F.array("r", "l")).alias("node")).distinct()
        reach = s.store(graph.khop(links, chains, hops, max_degree), "leak-reach")
        hubs = reach.where("hub").select(F.col("source").alias("__hub")).distinct()
        marked = pure.join(hubs, F.col("r") == F.col("__hub"), "left_semi").unionByName(pure.join(hubs, F.col("l") == F.col("__hub"), "left_semi")).select("id").distinct()
        walked = pure.join(marked, "id", "left_anti")
        hits = reach.where("not hub").select("source", "node")
        by = lambda side, key: walked.select("id", F.col(side).alias("source")).join(hits, "source").select("id", F.col("node").alias(key))
        ends = systems.select(F.col("id").alias("leaked"), F.col("r").alias("er"), F.col("l").alias("el"))
        first, second = s.store(by("r", "hr").distinct(), "leak-r"), s.store(by("l", "hl").distinct(), "leak-l")
        straight = first.join(ends, F.col("hr") == F.col("er")).select("id", "leaked", F.col("el").alias("hl")).join(second, ["id", "hl"], "left_semi")
        crossed = first.join(ends, F.col("hr") == F.col("el")).select("id", "leaked", F.col("er").alias("hl")).join(second, ["id", "hl"], "left_semi")
        found = straight.select("id", "leaked").unionByName(crossed.select("id", "leaked")).distinct().withColumn("considered", F.lit(False))
        return s.keep(s.store(found.unionByName(marked.select("id", F.lit(None).cast(dict(systems.dtypes)["id"]).alias("leaked"), F.lit(True).alias("considered"))), "leak-pairs"))


def merged_leaks(leaks: list[DataFrame]) -> DataFrame:
    """The union of several leak tables, a pair once."""
    out = leaks[0]
    for more in leaks[1:]:
        out = out.unionByName(more)
    return out.distinct()


def transitive_hits(index: DataFrame, leaks: DataFrame) -> DataFrame:
    """Pure rows of (id, cluster_id, pure, ...) with the number of leaking systems, and with their own cluster's added.

    Infinite where a chain is a hub, null where a system has no entry in ``leaks``.
    """
    pure = index.where("pure")
    size = F.when(F.max("considered"), F.lit(float("inf")))
    alone = leaks.groupBy("id").agg(size.otherwise(F.count_distinct("leaked")).alias("depth_hits"))
    mates = pure.select("id", "cluster_id").join(pure.select("cluster_id", F.col("id").alias("leaked")), "cluster_id").select("id", "leaked", F.lit(False).alias("considered"))
    known = mates.join(leaks.select("id").distinct(), "id", "left_semi")
    wide = leaks.unionByName(known).groupBy("id").agg(size.otherwise(F.count_distinct("leaked")).alias("depth_hits_with_cluster"))
    return pure.join(alone, "id", "left").join(wide, "id", "left")


def proto_summary(table: DataFrame) -> DataFrame:
    """One row of counts over a proto-test table: removed, systems, and those with unbound or predicted pairs, same or different chains."""
    test, af2 = F.col("split") == "proto-test", F.col("af2_mm")
    tests = {"apo": F.col("min_both_putative_apo") != 0, "pred": F.col("min_both_pred") != 0, "heterodimer": F.col("heterodimer"), "homodimer": ~F.col("heterodimer")}
    count = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    columns = [F.sum(F.when(test, F.col("depth_2_hits_with_comm"))).alias("removed"), count(test).alias("systems")]
    columns += [count(test & c).alias(n) for n, c in tests.items()] + [count(af2 & c).alias(f"{n}_af2") for n, c in tests.items()]
    return table.agg(*columns)


def cluster_sample(members: DataFrame, cluster: str, key: str, length: str | None = None) -> DataFrame:
    """Adds ``sampled``: the longest member of each cluster, else its first by key."""
    first = rel.keep_first(members, [cluster], [f"-{length}", key] if length else [key]).select(cluster, key, F.lit(True).alias("sampled"))
    return members.join(first, [cluster, key], "left").fillna(False, ["sampled"])


def chosen_clusters(index: DataFrame, prefix: str) -> DataFrame:
    """One clustering's three columns as the final ones."""
    return index.withColumns({f"cluster_id{side}": F.col(f"{prefix}_id{side}") for side in ("_R", "_L", "")})


def systems_of_pairs(systems: DataFrame, a: str, b: str, key: str = "id") -> DataFrame:
    """(first, second, ids) of each unordered pair of chains."""
    return systems.groupBy(F.least(a, b).alias("first"), F.greatest(a, b).alias("second")).agg(F.array_sort(F.collect_set(key)).alias("ids"))


def systems_of_clusters(index: DataFrame, cluster: str = "cluster_id", key: str = "id") -> DataFrame:
    return index.groupBy(cluster).agg(F.array_sort(F.collect_set(key)).alias("ids"))


def merged_sets(frames: list[DataFrame], key: str, values: str) -> DataFrame:
    """Set union by key over tables of (key, array)."""
    out = frames[0].select(key, values)
    for more in frames[1:]:
        out = out.unionByName(more.select(key, values))
    return out.select(key, F.explode_outer(values).alias("__v")).groupBy(key).agg(F.array_sort(F.collect_set("__v")).alias(values))


def chain_novelty(test: DataFrame, train: DataFrame, r: str = "cluster_id_R", l: str = "cluster_id_L", key: str = "id") -> DataFrame:  # noqa: E741
    """(id, R_match, L_match, novelty): chains of the training set in either chain's cluster; which of both chains is new."""
    sizes = train.select(F.explode(F.array(r, l)).alias("__c")).where("__c is not null").groupBy("__c").agg(F.count("*").alias("__n"))
    side = lambda c, n: sizes.select(F.col("__c").alias(c), F.col("__n").alias(n))
    met = test.select(key, r, l).join(side(r, "R_match"), r, "left").join(side(l, "L_match"), l, "left").fillna(0, ["R_match", "L_match"])
    new = lambda c: (F.col(c) == 0).cast("int")
    label = F.element_at(F.array(*map(F.lit, ("Neither", "Single", "Both"))), new("R_match") + new("L_match") + 1)
    return met.select(key, "R_match", "L_match", label.alias("novelty"))


def component_counts(points: DataFrame, by: list[str], radius: float, key: str = "atom_idx") -> DataFrame:
    """(by, n_components): connected parts of each group's points under a distance; 1 for a compact chain."""
    named = stored(points.select(*by, F.concat_ws("\x1f", *[F.col(c).cast("string") for c in (*by, key)]).alias("node"), "x", "y", "z"), "radius-points")
    near = range_join(named.withColumnRenamed("node", "src"), named.withColumnRenamed("node", "dst"), radius, by).where("src < dst").select("src", "dst")
    roots = graph.connected_components(near)
    return named.join(roots, "node", "left").groupBy(*by).agg(F.count_distinct(F.coalesce("component", "node")).alias("n_components"))


def attached(index: DataFrame, counts: DataFrame, key: str, most: int = 1) -> DataFrame:
    """Rows none of whose chains has more than ``most`` parts; counts hold (key, n_components), one row a chain."""
    loose = counts.where(F.col("n_components") > most).select(key).distinct()
    return index.join(loose, key, "left_anti")


def labelled_subsets(rows: DataFrame, index: DataFrame, subsets: dict[str, Column], key: str = "id", out: str = "subset") -> DataFrame:
    """Rows once for every subset their system is in, with its label."""
    found = F.filter(F.array(*[F.when(c, F.lit(label)) for label, c in subsets.items()]), lambda x: x.isNotNull())
    return rows.join(index.select(key, F.explode(found).alias(out)), key)
