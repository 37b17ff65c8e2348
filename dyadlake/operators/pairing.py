"""Pairing bound complexes with unbound chains of the same protein."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import rel, stats


@dataclass(frozen=True)
class Limits:
    """Bounds that a candidate has to meet; fixed values, relaxed ones for noisy training pairs."""

    min_identity: float = 0.7
    min_covered: float = 0.5
    min_length_ratio: float = 0.3
    max_rmsd: float = 15.0
    min_residues: int = 5


METRICS = {"identity": 1, "covered": 1, "rmsd": -1, "resolution": -1, "interface_share": 1}


def candidates(dimers: DataFrame, monomers: DataFrame) -> DataFrame:
    """(id, side, apo) of every monomer that shares a side's protein: two equi-joins; frequent proteins are split by skew handling."""
    out = None
    for side in ("R", "L"):
        part = dimers.select("id", F.lit(side).alias("side"), F.col(f"uniprot_{side}").alias("uniprot"), F.col(f"chain_{side}").alias("chain")).join(monomers.select("uniprot", F.col("id").alias("apo")), "uniprot")
        out = part if out is None else out.unionByName(part)
    return out.where("uniprot <> 'UNDEFINED'").distinct()


def select(pairs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Candidates within every bound; a missing measure fails."""
    ratio = F.least(F.try_divide("apo_length", "holo_length"), F.try_divide("holo_length", "apo_length"))
    kept = pairs.withColumn("length_ratio", ratio)
    return kept.where(
        (F.col("identity") >= limits.min_identity) & (F.col("covered") >= limits.min_covered) & (F.col("length_ratio") >= limits.min_length_ratio)
        & (F.col("rmsd") <= limits.max_rmsd) & (F.col("apo_length") >= limits.min_residues)
    )


def scored(pairs: DataFrame, metrics: dict[str, int] = METRICS) -> DataFrame:
    """Mean of z-scores within each (id, side)."""
    return stats.zscore_mean(pairs, ["id", "side"], metrics)


def canonical(pairs: DataFrame) -> DataFrame:
    """(id, side, first, others): the best candidate and the rest, best first."""
    ranked = pairs.withColumn("worse", -F.round("score", 9))
    return rel.ordered_concat(ranked, ["id", "side"], "apo", ["worse", "apo"])


def on_index(index: DataFrame, chosen: DataFrame) -> DataFrame:
    """Catalogue rows with apo_R/L_pdb, apo_R/L_pdbs and flags."""
    for side in ("R", "L"):
        part = chosen.where(F.col("side") == side).select("id", F.col("first").alias(f"apo_{side}_pdb"), F.concat_ws(";", "first", F.nullif("others", F.lit(""))).alias(f"apo_{side}_pdbs"))
        index = index.drop(f"apo_{side}_pdb", f"apo_{side}_pdbs", f"apo_{side}").join(part, "id", "left").fillna("", [f"apo_{side}_pdb", f"apo_{side}_pdbs"])
        index = index.withColumn(f"apo_{side}", F.col(f"apo_{side}_pdb") != "")
    return index


def monomer_overlap(holo: DataFrame, apo: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, apo, shared, share): residues of the protein that both chains resolve; tables hold id, resi_uniprot."""
    h = holo.select(F.col("id"), "resi_uniprot").where("resi_uniprot is not null").distinct()
    a = apo.select(F.col("id").alias("apo"), "resi_uniprot").where("resi_uniprot is not null").distinct()
    shared = pairs.select("id", "apo").distinct().join(h, "id").join(a, ["apo", "resi_uniprot"]).groupBy("id", "apo").agg(F.count("*").alias("shared"))
    total = h.groupBy("id").agg(F.count("*").alias("n"))
    return shared.join(total, "id").select("id", "apo", "shared", F.try_divide("shared", "n").alias("share"))


def select_monomer(df: DataFrame, priority: list[str], available: str, out: str = "kind", seed: int | None = None, key: str = "id") -> DataFrame:
    """The first available kind in order of priority, or with a seed a reproducible draw among them; null where none is."""
    usable = F.array_intersect(F.array(*map(F.lit, priority)), F.col(available))
    at = F.lit(1) if seed is None else (F.pmod(F.xxhash64(F.lit(seed), key), F.greatest(F.lit(1), F.size(usable))) + 1).cast("int")
    return df.withColumn(out, F.when(F.size(usable) > 0, F.element_at(usable, at)))
