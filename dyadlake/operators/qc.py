"""Quality control of splits: alignment leaks, systems aligned by both chains, family and subset labels, entry annotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rel

NO_CLAN = "no_clan"


def interfaces_of(index: DataFrame, interfaces: DataFrame) -> DataFrame:
    """(id, ref_pdb_id, ref_chain_R, ref_chain_L, residues) of systems that have interface records.

    Interfaces hold id1 and id2, the system's chains with their side, and residues1, residues2.
    """
    parts = F.split("id", "--")
    keyed = index.select("id", F.concat(parts[0], F.lit("-R")).alias("id1"), F.concat(parts[1], F.lit("-L")).alias("id2"))
    chain = lambda c: F.regexp_replace(F.element_at(F.split(F.regexp_replace(c, "-[RL]$", ""), "_"), -2), "[0-9]+$", "")
    met = keyed.join(interfaces, ["id1", "id2"])
    return met.select("id", F.split_part("id1", F.lit("__"), F.lit(1)).alias("ref_pdb_id"), chain("id1").alias("ref_chain_R"), chain("id2").alias("ref_chain_L"), F.col("residues1").alias("ref_R_interface"), F.col("residues2").alias("ref_L_interface"))


def potential_leaks(hits: DataFrame, keys: list[str], score: str, subsets: dict[str, tuple[Column, Column]], out: str = "subset") -> DataFrame:
    """The best hit of each key, once for every subset whose (member, rule) it meets."""
    order = [f"-{score}", *[c for c in hits.columns if c not in keys and c != score]]
    best = rel.keep_first(hits, keys, order)
    labels = F.filter(F.array(*[F.when(member & rule, F.lit(label)) for label, (member, rule) in subsets.items()]), lambda x: x.isNotNull())
    return best.withColumn(out, F.explode(labels))


def scored_leaks(leaks: DataFrame, scores: DataFrame, p_value: str = "p_value") -> DataFrame:
    """Pair scores beside the leaks; the logarithm of a missing p-value is 0."""
    return leaks.join(scores, ["id", "hit_id"], "left").withColumn("log_pvalue", F.coalesce(F.log10(p_value), F.lit(0.0)))


def flagged(index: DataFrame, leaks: DataFrame, flags: dict[str, Column], key: str = "id") -> DataFrame:
    """A boolean column a flag: whether any of a system's leaks meets it.  One aggregate, one join."""
    seen = leaks.groupBy(key).agg(*[F.max(F.coalesce(c, F.lit(False))).alias(n) for n, c in flags.items()])
    return index.join(seen, key, "left").fillna(False, list(flags))


def aligned_pairs(hits: DataFrame, known: DataFrame, within: tuple[str, ...] = ("entry",)) -> DataFrame:
    """(*within, r, l, hit_r, hit_l, score_r, score_l): chains whose hits share ``within`` and are a known pair.

    ``hits`` is (chain, hit, score) and the columns of ``within``, ``known``
    (first, second), chains in either order.  Hits meet on ``within`` alone, so
    rows follow the hits of an entry, however many hits a chain has.
    """
    on = list(within)
    side = lambda c: hits.select(*on, F.col("chain").alias(c), F.col("hit").alias(f"hit_{c}"), F.col("score").alias(f"score_{c}"))
    met = side("r").join(side("l"), on).withColumns({"lo": F.least("hit_r", "hit_l"), "hi": F.greatest("hit_r", "hit_l")})
    pairs = known.select(F.least("first", "second").alias("lo"), F.greatest("first", "second").alias("hi")).distinct()
    return met.join(pairs, ["lo", "hi"], "left_semi").drop("lo", "hi")


def dual_alignments(systems: DataFrame, hits: DataFrame, known: DataFrame) -> DataFrame:
    """(id, entry, hit_r, hit_l, score_r, score_l): known systems both of whose chains align with a system's.

    ``systems`` is (id, r, l), ``hits`` (chain, entry, hit, score), ``known``
    (first, second), chains in either order.
    """
    return aligned_pairs(hits, known).join(systems, ["r", "l"]).select("id", "entry", "hit_r", "hit_l", "score_r", "score_l")


def proto_table(test: DataFrame, index: DataFrame, columns: list[str]) -> DataFrame:
    """Proto-test rows with catalogue columns, fewest removed neighbours first."""
    return test.where("split = 'proto-test'").join(index.select("id", *columns), "id").orderBy(F.col("depth_2_hits_with_comm").asc_nulls_last(), "id")


def with_clans(index: DataFrame, clans: DataFrame) -> DataFrame:
    """Adds pfam_clan_R, pfam_clan_L and pfam_clan; ``clans`` is (pdb_id, chain, clan), the last of several counts."""
    one = clans.groupBy("pdb_id", "chain").agg(F.max("clan").alias("clan"))
    out = index
    for side in "RL":
        found = one.select("pdb_id", F.col("chain").alias("__chain"), F.col("clan").alias(f"pfam_clan_{side}"))
        out = out.withColumn("__chain", F.regexp_replace(f"chain_{side}", "[0-9]+$", "")).join(found, ["pdb_id", "__chain"], "left").drop("__chain")
    out = out.fillna(NO_CLAN, ["pfam_clan_R", "pfam_clan_L"])
    return out.withColumn("pfam_clan", pair_label(F.col("pfam_clan_R"), F.col("pfam_clan_L"), NO_CLAN, repeat=True))


def pair_label(a: Column, b: Column, absent: str = "", sep: str = " : ", repeat: bool = False) -> Column:
    """Both labels in order with a separator; one where the other is absent (or, without ``repeat``, the same), 'Not defined' where both are."""
    both = F.filter(F.array(a, b), lambda x: x.isNotNull() & (x != absent))
    both = F.array_sort(both if repeat else F.array_distinct(both))
    return F.when(F.size(both) == 0, "Not defined").otherwise(F.array_join(both, sep))


def label_distribution(df: DataFrame, columns: list[str], absent: str, k: int) -> DataFrame:
    """(label, n): the ``k`` most frequent labels over several columns."""
    long = df.select(F.explode(F.array(*columns)).alias("label")).where((F.col("label") != absent) & F.col("label").isNotNull())
    return long.groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label").limit(k)


def interface_metadata(index: DataFrame, metadata: DataFrame) -> DataFrame:
    """Metadata of catalogue systems with their interfaces' residues counted and the shorter chain's length."""
    size = lambda c: F.size(F.split(c, ","))
    joined = index.select("id", "cluster_id", "split").join(metadata, "id")
    return joined.withColumns({"interface_lengths": size("chain_1_residues") + size("chain_2_residues"), "min_chain_len": F.least("length1", "length2")})


def display_splits(index: DataFrame, subsets: dict[str, str], names: dict[str, str]) -> DataFrame:
    """Rows under display names: test rows once for every subset flag that is set, others under their split's name."""
    labels = F.when(F.col("split") == "test", F.filter(F.array(*[F.when(F.col(flag), F.lit(label)) for flag, label in subsets.items()]), lambda x: x.isNotNull()))
    other = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), F.col("split")), F.col("split"))
    return index.withColumn("split", F.explode(labels.otherwise(F.array(other))))


def entry_annotations(entries: DataFrame) -> dict[str, DataFrame]:
    """Families, features, instance annotations and instance features of nested entry records, each a flat table.

    ``entries`` is (pdb_id, polymer_entities): arrays of structs with identifiers
    (map), pfams, features and instances, an instance with identifiers (map),
    annotations and features.  Records without one of them give no row there.
    """
    text = lambda c: F.transform_values(c, lambda _, v: v.cast("string"))
    entity = entries.select("pdb_id", F.explode("polymer_entities").alias("e")).select("pdb_id", text("e.identifiers").alias("identifiers"), "e.pfams", "e.features", "e.instances")
    features = entity.select("pdb_id", "identifiers", F.explode("features").alias("f")).select("pdb_id", "identifiers", "f.*")
    family = entity.select("pdb_id", F.col("identifiers"), F.explode("pfams").alias("p")).select("pdb_id", "identifiers", F.col("p.rcsb_pfam_accession").alias("feature_id"), F.col("p.rcsb_pfam_description").alias("description"))
    extra = [c for c in features.columns if c not in ("pdb_id", "identifiers", "feature_id", "description")]
    # the features' own columns count; only the family's name comes from the family record
    right = features.select("pdb_id", F.map_entries("identifiers").alias("__i"), "feature_id", *extra)
    families = family.withColumn("__i", F.map_entries("identifiers")).join(right, ["pdb_id", "__i", "feature_id"], "left").drop("__i")
    instance = entity.select("pdb_id", F.explode("instances").alias("i")).select("pdb_id", text("i.identifiers").alias("identifiers"), "i.annotations", "i.features")
    return {
        "families": families,
        "features": features,
        "annotations": instance.select("pdb_id", "identifiers", F.explode("annotations").alias("a")).select("pdb_id", "identifiers", "a.*"),
        "instance_features": instance.select("pdb_id", "identifiers", F.explode("features").alias("f")).select("pdb_id", "identifiers", "f.*"),
    }
