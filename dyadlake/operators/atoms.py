"""Operators on atom tables: selections, chain roles, common atoms, transforms, orientation, surfaces, interfaces.

Tables hold the columns of ``by`` (one structure each) and chain_id, res_id,
atom_name, element, x, y, z; atom_idx where order matters.  Per-structure
algebra runs in grouped Arrow functions; a structure fits in a task.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import rel
from .structure import contacts, gaps, range_join, refined_fit

BACKBONE = ("N", "CA", "C", "O")
#: Van der Waals radii of single elements, others as carbon; the water probe.
RADII = {"H": 1.2, "C": 1.7, "N": 1.55, "O": 1.52, "F": 1.47, "P": 1.8, "S": 1.8}
PROBE = 1.4


def filter_atoms(atoms: DataFrame, calpha: bool = False, backbone: bool = False, heavy: bool = True) -> DataFrame:
    keep = F.lit(True)
    if calpha:
        keep = keep & (F.col("atom_name") == "CA")
    if backbone:
        keep = keep & F.col("atom_name").isin(*BACKBONE)
    return atoms.where(keep & (F.col("element") != "H") if heavy else keep)


def select_atoms(types: tuple[str, ...] = ("CA",)):
    """A loader step that keeps atoms of the given names."""
    return lambda atoms: atoms.where(F.col("atom_name").isin(*types))


def chain_roles(atoms: DataFrame, by: list[str]) -> DataFrame:
    """(by, chain_id, role): the smallest chain of a structure is the ligand, all others are receptor."""
    sizes = atoms.groupBy(*by, "chain_id").agg(F.count("*").alias("__n"))
    last = F.row_number().over(Window.partitionBy(*by).orderBy(F.col("__n"), F.col("chain_id").desc()))
    return sizes.withColumn("role", F.when(last == 1, "ligand").otherwise("receptor")).select(*by, "chain_id", "role")


def canonical_order(atoms: DataFrame, by: list[str], receptor: list[str], ligand: list[str]) -> DataFrame:
    """Atoms of the named chains, renumbered with the receptor's first."""
    side = F.when(F.col("chain_id").isin(*receptor), 0).when(F.col("chain_id").isin(*ligand), 1)
    w = Window.partitionBy(*by).orderBy("__side", "atom_idx")
    return atoms.withColumn("__side", side).where("__side is not null").withColumn("atom_idx", F.row_number().over(w) - 1).drop("__side")


def unique_calpha(atoms: DataFrame, by: list[str]) -> DataFrame:
    """The first atom of each residue: what is left of doubled alpha carbons."""
    return rel.keep_first(atoms, [*by, "chain_id", "res_id"], ["atom_idx"])


def common_atoms(atoms: DataFrame, by: list[str], model: str, key: tuple[str, ...] = ("chain_id", "res_id", "atom_name")) -> DataFrame:
    """Atoms that every model of a structure has: counted, not intersected pair by pair."""
    models = atoms.groupBy(*by).agg(F.count_distinct(model).alias("__all"))
    shared = atoms.groupBy(*by, *key).agg(F.count_distinct(model).alias("__n")).join(models, by).where("__n = __all").select(*by, *key)
    return atoms.join(shared, [*by, *key], "left_semi")


def common_residues(first: DataFrame, second: DataFrame, by: list[str]) -> DataFrame:
    """(by, resi_a, resi_b): residues of two chains at the same place of the same protein.

    Tables hold by, resi, resi_uniprot, uniprot_acc.  A model in the protein's own numbering has both numbers alike.
    """
    place = ["resi_uniprot", "uniprot_acc"]
    side = lambda df, n: df.where("resi_uniprot is not null").select(*by, *place, F.col("resi").alias(n)).distinct()
    return side(first, "resi_a").join(side(second, "resi_b"), [*by, *place]).select(*by, "resi_a", "resi_b").distinct()


def masked(atoms: DataFrame, residues: DataFrame, by: list[str], column: str) -> DataFrame:
    """Atoms whose residue is among the masked ones; structures without any keep all."""
    mask = residues.select(*by, F.col(column).alias("res_id")).distinct()
    none = atoms.join(mask.select(*by).distinct(), by, "left_anti")
    return atoms.join(mask, [*by, "res_id"], "left_semi").unionByName(none)


def mismatches(a: Column, b: Column) -> Column:
    """struct(mismatches, matches) of two aligned sequences of the same length; gaps and X match nothing."""
    pairs = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: ((x != "-") & (y != "-") & (x != "X") & (y != "X")).cast("int"))
    met = F.aggregate(pairs, F.lit(0), lambda s, v: s + v)
    return F.struct((F.size(pairs) - met).alias("mismatches"), met.alias("matches"))


def _uniform(seed: int, by: list[str], k: int) -> Column:
    return (F.pmod(F.xxhash64(F.lit(seed), F.lit(k), *by), F.lit((1 << 53) - 1)).cast("double") + 1) / float(1 << 53)


def random_ligand(atoms: DataFrame, by: list[str], max_translation: float = 10.0, seed: int = 0, ligand: str = "L") -> DataFrame:
    """Each structure's ligand turned by a uniform random rotation and shifted by a normal draw, both seeded by the structure's id."""
    u = [_uniform(seed, by, k) for k in range(7)]
    a, b = F.sqrt(1 - u[0]), F.sqrt(u[0])
    turn = 2 * math.pi
    q = F.struct((a * F.sin(turn * u[1])).alias("x"), (a * F.cos(turn * u[1])).alias("y"), (b * F.sin(turn * u[2])).alias("z"), (b * F.cos(turn * u[2])).alias("w"))
    normal = lambda k, m, wave: F.sqrt(-2 * F.log(u[k])) * wave(turn * u[m])
    shift = [normal(3, 4, F.cos), normal(3, 4, F.sin), normal(5, 6, F.cos)]
    df = atoms.withColumn("__q", q)
    x, y, z, w = (F.col(f"__q.{c}") for c in "xyzw")
    rows = (
        (1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)),
        (2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)),
        (2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)),
    )
    moved = [sum((r * F.col(c) for r, c in zip(row, "xyz")), F.lit(0.0)) + max_translation * s for row, s in zip(rows, shift)]
    on = F.col("chain_id") == ligand
    return df.withColumns({c: F.when(on, m).otherwise(F.col(c)) for c, m in zip("xyz", moved)}).drop("__q")


def superposed(mobile: DataFrame, reference: DataFrame, by: list[str], least: int = 3) -> DataFrame:
    """Mobile structures laid on their reference by the alpha carbons of equal residues, outliers left out.

    Structures with fewer than ``least`` anchors, or without a reference, come back as they are.
    """
    there = reference.where("atom_name = 'CA'").select(*by, "chain_id", "res_id", *[F.col(c).alias(f"{c}2") for c in "xyz"])
    anchors = mobile.where("atom_name = 'CA'").join(there, [*by, "chain_id", "res_id"])
    nine = ", ".join(f"r{i}{j} double" for i in range(3) for j in range(3))
    schema = ", ".join(f"{c} {dict(mobile.dtypes)[c]}" for c in by) + f", {nine}, t0 double, t1 double, t2 double"

    def fitted(key, rows: pd.DataFrame) -> pd.DataFrame:
        if len(rows) < least:
            turn, shift = np.eye(3), np.zeros(3)
        else:
            turn, shift, _ = refined_fit(rows[["x", "y", "z"]].to_numpy(float), rows[["x2", "y2", "z2"]].to_numpy(float))
        return pd.DataFrame([(*key, *turn.ravel().tolist(), *shift.tolist())])

    moves = anchors.select(*by, *"xyz", "x2", "y2", "z2").groupBy(*by).applyInPandas(fitted, schema)
    laid = mobile.join(moves, by, "left")
    new = {c: F.coalesce(sum((F.col(a) * F.col(f"r{i}{j}") for i, a in enumerate("xyz")), F.lit(0.0)) + F.col(f"t{j}"), F.col(c)) for j, c in enumerate("xyz")}
    return laid.withColumns(new).select(*mobile.columns)


def oriented(atoms: DataFrame, by: list[str]) -> DataFrame:
    """Structures centred and turned so that x has the largest variance and z the smallest; covariances are native aggregates."""
    pairs = [(a, b) for k, a in enumerate("xyz") for b in "xyz"[k:]]
    cov = atoms.groupBy(*by).agg(*[F.avg(c).alias(f"m{c}") for c in "xyz"], *[F.covar_pop(a, b).alias(a + b) for a, b in pairs])

    @F.pandas_udf("array<double>")
    def axes(xx: pd.Series, xy: pd.Series, xz: pd.Series, yy: pd.Series, yz: pd.Series, zz: pd.Series) -> pd.Series:
        m = np.nan_to_num(np.stack([xx, xy, xz, xy, yy, yz, xz, yz, zz], axis=1).reshape(-1, 3, 3))
        v = np.linalg.eigh(m)[1][:, :, ::-1]
        v = v * np.where(np.linalg.det(v) < 0, -1, 1)[:, None, None]
        return pd.Series(list(v.reshape(-1, 9)))

    turned = atoms.join(cov.withColumn("__v", axes(*[a + b for a, b in pairs])).select(*by, "mx", "my", "mz", "__v"), by)
    new = {c: sum(((F.col(a) - F.col(f"m{a}")) * F.element_at("__v", 3 * i + j + 1) for i, a in enumerate("xyz")), F.lit(0.0)) for j, c in enumerate("xyz")}
    return turned.withColumns(new).select(*atoms.columns)


def sphere(points: int) -> np.ndarray:
    """Points spread evenly over the unit sphere by the golden angle."""
    k = np.arange(points) + 0.5
    up, around = 1 - 2 * k / points, math.pi * (1 + 5**0.5) * k
    flat = np.sqrt(1 - up**2)
    return np.stack([flat * np.cos(around), flat * np.sin(around), up], axis=1)


def accessible(xyz: np.ndarray, radius: np.ndarray, points: int = 200) -> np.ndarray:
    """Solvent-accessible surface of each atom: the share of its sphere's points outside all others."""
    dots, out = sphere(points), np.zeros(len(xyz))
    wide = radius + PROBE
    for k in range(len(xyz)):
        gap = np.linalg.norm(xyz - xyz[k], axis=1)
        near = np.flatnonzero((gap < wide + wide[k]) & (np.arange(len(xyz)) != k))
        shell = xyz[k] + wide[k] * dots
        free = np.ones(points, bool)
        for at in range(0, len(near), 64):
            part = near[at : at + 64]
            free &= ((shell[:, None] - xyz[part]) ** 2).sum(-1).__ge__(wide[part] ** 2).all(axis=1)
        out[k] = 4 * math.pi * wide[k] ** 2 * free.mean()
    return out


def buried_surface(atoms: DataFrame, by: list[str], one: str = "R", two: str = "L", points: int = 200, radii: dict[str, float] | None = None) -> DataFrame:
    """(by, buried): surface that two chains hide from each other, rounded; hydrogens and hetero atoms aside."""
    known = radii or RADII
    used = atoms.where((F.col("element") != "H") & F.col("chain_id").isin(one, two))
    used = used.where(~F.col("hetero")) if "hetero" in atoms.columns else used

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        xyz = rows[["x", "y", "z"]].to_numpy(float)
        radius = rows["element"].map(lambda e: known.get(str(e).capitalize(), known["C"])).to_numpy(float)
        on = (rows["chain_id"] == one).to_numpy()
        area = accessible(xyz[on], radius[on], points).sum() + accessible(xyz[~on], radius[~on], points).sum() - accessible(xyz, radius, points).sum()
        return pd.DataFrame([(*key, int(round(area)))])

    schema = ", ".join(f"{c} {dict(atoms.dtypes)[c]}" for c in by) + ", buried long"
    return used.select(*by, "chain_id", "element", *"xyz").groupBy(*by).applyInPandas(run, schema)


def interacting_chains(atoms: DataFrame, by: list[str], radius: float = 10.0) -> DataFrame:
    """(by, chain1, chain2, n_residue_pairs, n_residues, residues1, residues2) of chains whose backbones come near."""
    met = contacts(atoms, radius, by, heavy=False, backbone=True)
    text = lambda c: F.array_join(F.transform(F.array_sort(F.collect_set(c)), lambda r: r.cast("string")), ",")
    n = F.count_distinct("res1") + F.count_distinct("res2")
    return met.groupBy(*by, "chain1", "chain2").agg(F.count("*").alias("n_residue_pairs"), n.alias("n_residues"), text("res1").alias("residues1"), text("res2").alias("residues2"))


def interface_gaps(atoms: DataFrame, by: list[str], radius: float) -> DataFrame:
    """(by, chain1, chain2, atom_gaps, missing_residues): interface atoms near the ends of chain breaks, and breaks' ends among their residues.

    Chain pairs in contact with a break on either side have a row, with zeros where no interface atom is near.
    """
    met = contacts(atoms, 4.5, by)
    pair = [*by, "chain1", "chain2"]
    ends = gaps(atoms, [*by, "chain_id"], "res_id").select(*by, "chain_id", F.explode(F.array("start", "end")).alias("res_id")).distinct()
    own = lambda n: met.select(*pair, F.col(f"chain{n}").alias("chain_id"), F.col(f"res{n}").alias("res_id"))
    face = own(1).unionByName(own(2)).distinct()
    chains = face.select(*pair, "chain_id").distinct()
    breaks = chains.join(ends, [*by, "chain_id"])
    at = atoms.select(*by, "chain_id", "res_id", "atom_name", "x", "y", "z")
    left = face.join(at, [*by, "chain_id", "res_id"]).withColumnsRenamed({"chain_id": "c1", "res_id": "r1", "atom_name": "a1"})
    right = breaks.join(at, [*by, "chain_id", "res_id"]).select(*pair, "x", "y", "z")
    near = range_join(left, right, radius, pair).select(*pair, "c1", "r1", "a1").distinct()
    marked = near.join(ends.select(*by, F.col("chain_id").alias("c1"), F.col("res_id").alias("r1"), F.lit(1).alias("__end")), [*by, "c1", "r1"], "left")
    found = marked.groupBy(*pair).agg(F.count("*").alias("atom_gaps"), F.count_distinct(F.when(F.col("__end") == 1, F.struct("c1", "r1"))).alias("missing_residues"))
    return breaks.select(*pair).distinct().join(found, pair, "left").fillna(0, ["atom_gaps", "missing_residues"])


def gathered(index: DataFrame, atoms: DataFrame, key: str, kind: str) -> DataFrame:
    """One row a system: its catalogue columns and a map from the kind of structure to its atoms in order."""
    columns = [c for c in atoms.columns if c not in (key, kind)]
    first = ["atom_idx"] if "atom_idx" in columns else []
    rows = F.array_sort(F.collect_list(F.struct(*first, *[c for c in columns if c not in first])))
    per = atoms.groupBy(key, kind).agg(rows.alias("__rows")).groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(kind, "__rows"))).alias("structures"))
    return index.join(per, key, "left")


def write_clustered(atoms: DataFrame, index: DataFrame, path: str, key: str = "id", cluster: str = "cluster_id", kind: str = "kind") -> None:
    """Structures below cluster, system and kind folders, as the catalogue groups them."""
    atoms.join(index.select(key, cluster), key).write.mode("overwrite").partitionBy(cluster, key, kind).parquet(path)
