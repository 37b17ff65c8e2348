"""Spatial and sequence kernels: grid range joins in SQL, small dense algebra in grouped Arrow functions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scoring import capri, dockq


def _cells(df: DataFrame, radius: float) -> DataFrame:
    return df.withColumns({f"c{a}": F.floor(F.col(a) / radius) for a in "xyz"})


def range_join(left: DataFrame, right: DataFrame, radius: float, by: list[str] = []) -> DataFrame:  # noqa: B006
    """Point pairs within ``radius``: an equi-join on grid cells, then the exact distance.

    ``left`` and ``right`` hold x, y, z, the columns of ``by`` and others, whose names must differ.
    Only the right side is spread to its 27 neighbouring cells.
    """
    near = F.explode(F.expr("flatten(flatten(transform(array(-1,0,1), a -> transform(array(-1,0,1), b -> transform(array(-1,0,1), c -> struct(a, b, c))))))"))
    a = _cells(left, radius)
    b = _cells(right.withColumnsRenamed({c: f"{c}2" for c in "xyz"}).withColumns({c: F.col(f"{c}2") for c in "xyz"}), radius).drop("x", "y", "z").withColumn("__n", near)
    b = b.select(*[c for c in b.columns if c not in ("cx", "cy", "cz", "__n")], *[(F.col(f"c{x}") + F.col(f"__n.{v}")).alias(f"c{x}") for x, v in zip("xyz", "abc")])
    square = sum((F.pow(F.col(c) - F.col(f"{c}2"), F.lit(2)) for c in "xyz"), F.lit(0.0))
    joined = a.join(b, [*by, "cx", "cy", "cz"]).withColumn("distance", F.sqrt(square))
    return joined.where(F.col("distance") <= radius).drop("cx", "cy", "cz")


def contacts(atoms: DataFrame, radius: float = 4.5, by: list[str] = [], heavy: bool = True, backbone: bool = False) -> DataFrame:  # noqa: B006
    """(by, chain1, chain2, res1, res2): residue contacts of every two chains, chain1 < chain2."""
    if heavy:
        atoms = atoms.where(F.col("element") != "H")
    if backbone:
        atoms = atoms.where(F.col("atom_name").isin("N", "CA", "C", "O"))
    side = lambda n: atoms.select(*by, F.col("chain_id").alias(f"chain{n}"), F.col("res_id").alias(f"res{n}"), "x", "y", "z")
    return range_join(side(1), side(2), radius, by).where("chain1 < chain2").select(*by, "chain1", "chain2", "res1", "res2").distinct()


def clashes(atoms: DataFrame, radius: float = 1.2, by: list[str] = []) -> DataFrame:  # noqa: B006
    """(by, n_clashes, min_distance) between different chains."""
    heavy = atoms.where(F.col("element") != "H")
    side = lambda n: heavy.select(*by, F.col("chain_id").alias(f"chain{n}"), "x", "y", "z")
    return range_join(side(1), side(2), radius, by).where("chain1 < chain2").groupBy(*by).agg(F.count("*").alias("n_clashes"), F.min("distance").alias("min_distance"))


def gaps(residues: DataFrame, by: list[str], position: str) -> DataFrame:
    """Breaks between consecutive numbers: (by, start, end, size)."""
    after = F.lead(position).over(Window.partitionBy(*by).orderBy(position))
    return residues.select(*by, position).distinct().withColumn("end", after).where(F.col("end") > F.col(position) + 1).select(*by, F.col(position).alias("start"), "end", (F.col("end") - F.col(position) - 1).alias("size"))


def renumbered(atoms: DataFrame, by: list[str]) -> DataFrame:
    """Continuous residue numbers: up by one whenever the residue changes in atom order."""
    w = Window.partitionBy(*by).orderBy("atom_idx")
    new = F.coalesce((F.lag("res_id").over(w) != F.col("res_id")) | (F.lag("ins_code").over(w) != F.col("ins_code")), F.lit(False))
    return atoms.withColumn("__new", F.when(new, 1).otherwise(0)).withColumn("res_no", F.sum("__new").over(w) + 1).drop("__new")


def largest_variance(atoms: DataFrame, by: list[str]) -> DataFrame:
    """(by, max_var): the first principal axis's share of coordinate variance; covariances by native aggregates."""
    pairs = [(a, b) for k, a in enumerate("xyz") for b in "xyz"[k:]]
    cov = atoms.groupBy(*by).agg(*[F.covar_pop(a, b).alias(a + b) for a, b in pairs])

    @F.pandas_udf("double")
    def share(xx: pd.Series, xy: pd.Series, xz: pd.Series, yy: pd.Series, yz: pd.Series, zz: pd.Series) -> pd.Series:
        m = np.stack([xx, xy, xz, xy, yy, yz, xz, yz, zz], axis=1).reshape(-1, 3, 3)
        values = np.linalg.eigvalsh(np.nan_to_num(m))
        return pd.Series(values[:, 2] / np.maximum(values.sum(axis=1), 1e-300))

    return cov.select(*by, share(*[a + b for a, b in pairs]).alias("max_var"))


def planarity(points: DataFrame, by: list[str]) -> DataFrame:
    """(by, planarity): root mean square distance to the best plane, from the smallest eigenvalue; -1 below three points."""
    pairs = [(a, b) for k, a in enumerate("xyz") for b in "xyz"[k:]]
    cov = points.groupBy(*by).agg(F.count("*").alias("__n"), *[F.covar_pop(a, b).alias(a + b) for a, b in pairs])

    @F.pandas_udf("double")
    def root(xx: pd.Series, xy: pd.Series, xz: pd.Series, yy: pd.Series, yz: pd.Series, zz: pd.Series) -> pd.Series:
        m = np.stack([xx, xy, xz, xy, yy, yz, xz, yz, zz], axis=1).reshape(-1, 3, 3)
        return pd.Series(np.sqrt(np.maximum(np.linalg.eigvalsh(np.nan_to_num(m))[:, 0], 0)))

    return cov.withColumn("planarity", root(*[a + b for a, b in pairs])).select(*by, F.when(F.col("__n") < 3, -1.0).otherwise(F.col("planarity")).alias("planarity"))


def fit(moving: np.ndarray, fixed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rotation and translation of the least-squares superposition of moving on fixed."""
    a, b = moving.mean(0), fixed.mean(0)
    u, _, vt = np.linalg.svd((moving - a).T @ (fixed - b))
    turn = u @ np.diag([1, 1, np.sign(np.linalg.det(u @ vt))]) @ vt
    return turn, b - a @ turn


def refined_fit(moving: np.ndarray, fixed: np.ndarray, rounds: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``fit`` without the points whose squared distance lies far above the quartiles; (turn, shift, mask)."""
    mask = np.ones(len(moving), bool)
    for _ in range(rounds):
        turn, shift = fit(moving[mask], fixed[mask])
        square = ((moving @ turn + shift - fixed) ** 2).sum(axis=1)
        low, high = np.quantile(square[mask], [0.25, 0.75])
        kept = mask & (square <= high + 1.5 * (high - low))
        if kept.sum() < 3 or (kept == mask).all():
            break
        mask = kept
    return *fit(moving[mask], fixed[mask]), mask


def rmsd(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.sqrt(((a - b) ** 2).sum(1).mean())) if len(a) else float("nan")


def superposed_rmsd(pairs: DataFrame, by: list[str]) -> DataFrame:
    """(by, rmsd, refined) of matched points x, y, z on x2, y2, z2."""

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        a, b = rows[["x", "y", "z"]].to_numpy(float), rows[["x2", "y2", "z2"]].to_numpy(float)
        if len(a) < 3:
            return pd.DataFrame([(*key, None, None)])
        turn, shift = fit(a, b)
        fine, move, mask = refined_fit(a, b)
        return pd.DataFrame([(*key, rmsd(a @ turn + shift, b), rmsd((a @ fine + move)[mask], b[mask]))])

    schema = ", ".join(f"{c} {dict(pairs.dtypes)[c]}" for c in by) + ", rmsd double, refined double"
    return pairs.groupBy(*by).applyInPandas(run, schema)


def docking_scores(decoys: DataFrame, natives: DataFrame) -> DataFrame:
    """(system, model, iRMS, LRMS, Fnat, DockQ, CAPRI) of decoy poses against their native.

    Both tables hold system, chain_id ('R' or 'L'), res_id, atom_name, element, x, y, z; decoys a model as well.
    Contacts and interfaces are range joins; superpositions run per pose.
    """
    native_contacts = contacts(natives, 5.0, ["system"])
    decoy_contacts = contacts(decoys, 5.0, ["system", "model"])
    found = decoy_contacts.join(native_contacts, ["system", "chain1", "chain2", "res1", "res2"]).groupBy("system", "model").agg(F.count("*").alias("shared"))
    total = native_contacts.groupBy("system").agg(F.count("*").alias("native_contacts"))
    wide = contacts(natives, 10.0, ["system"])
    face = wide.select("system", F.col("chain1").alias("chain_id"), F.col("res1").alias("res_id")).unionByName(wide.select("system", F.col("chain2").alias("chain_id"), F.col("res2").alias("res_id"))).distinct().withColumn("face", F.lit(True))
    backbone = ("N", "CA", "C", "O")
    keys = ["system", "chain_id", "res_id", "atom_name"]
    there = natives.where(F.col("atom_name").isin(*backbone)).select(*keys, F.col("x").alias("x2"), F.col("y").alias("y2"), F.col("z").alias("z2"))
    pairs = decoys.where(F.col("atom_name").isin(*backbone)).select("model", *keys, "x", "y", "z").join(there, keys).join(face, ["system", "chain_id", "res_id"], "left")

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        a, b = rows[["x", "y", "z"]].to_numpy(float), rows[["x2", "y2", "z2"]].to_numpy(float)
        on, r = rows["face"].fillna(False).to_numpy(bool), (rows["chain_id"] == "R").to_numpy()
        i = ligand = None
        if on.sum() >= 3:
            turn, shift = fit(a[on], b[on])
            i = rmsd(a[on] @ turn + shift, b[on])
        if r.sum() >= 3 and (~r).any():
            turn, shift = fit(a[r], b[r])
            ligand = rmsd(a[~r] @ turn + shift, b[~r])
        return pd.DataFrame([(*key, i, ligand)])

    moved = pairs.groupBy("system", "model").applyInPandas(run, "system string, model string, iRMS double, LRMS double")
    fnat = F.coalesce(F.try_divide(F.coalesce("shared", F.lit(0)), F.col("native_contacts")), F.lit(0.0)).cast("double")
    scored = moved.join(found, ["system", "model"], "left").join(total, "system", "left").withColumn("Fnat", fnat)
    return scored.withColumn("DockQ", dockq(F.col("Fnat"), F.col("iRMS"), F.col("LRMS"))).withColumn("CAPRI", capri(F.col("Fnat"), F.col("iRMS"), F.col("LRMS"))).drop("shared", "native_contacts")


def disulfides(atoms: DataFrame, by: list[str], distance: float = 2.05, slack: float = 0.05) -> DataFrame:
    """Sulphur pairs at bonding distance, unordered."""
    sulphur = atoms.where((F.col("atom_name") == "SG") & (F.col("res_name") == "CYS"))
    side = lambda n: sulphur.select(*by, F.concat_ws(":", "chain_id", "res_id").alias(f"res{n}"), "x", "y", "z")
    return range_join(side(1), side(2), distance + slack, by).where((F.col("res1") < F.col("res2")) & (F.col("distance") >= distance - slack)).select(*by, "res1", "res2", "distance").distinct()


# fixed values: match, mismatch, opening and extending a gap of the plain sequence score
MATCH, MISMATCH, OPEN, EXTEND = 5.0, -2.0, -10.0, -1.0


def align(a: str, b: str) -> tuple[float, list[tuple[int, int]]]:
    """Global alignment with affine gaps, free at the ends: (score, matched position pairs)."""
    n, m = len(a), len(b)
    if not n or not m:
        return 0.0, []
    s = np.where(np.frombuffer(a.encode("utf-32-le"), np.uint32)[:, None] == np.frombuffer(b.encode("utf-32-le"), np.uint32)[None], MATCH, MISMATCH)
    low = -1e18
    h, e, f = np.zeros((n + 1, m + 1)), np.full((n + 1, m + 1), low), np.full((n + 1, m + 1), low)
    for i in range(1, n + 1):
        e[i] = np.maximum(h[i - 1] + OPEN, e[i - 1] + EXTEND)
        row, best = h[i], np.maximum(h[i - 1, :-1] + s[i - 1], e[i, 1:])
        gap = low
        for j in range(1, m + 1):
            gap = max(row[j - 1] + OPEN, gap + EXTEND)
            f[i, j] = gap
            row[j] = max(best[j - 1], gap)
    i, j = (n, int(h[n].argmax())) if h[n].max() >= h[:, m].max() else (int(h[:, m].argmax()), m)
    score, pairs, state = float(h[i, j]), [], "h"
    while i and j:
        if state == "h":
            if h[i, j] == h[i - 1, j - 1] + s[i - 1, j - 1]:
                i, j = i - 1, j - 1
                pairs.append((i, j))
                continue
            state = "e" if h[i, j] == e[i, j] else "f"
        elif state == "e":
            state = "h" if e[i, j] == h[i - 1, j] + OPEN else "e"
            i -= 1
        else:
            state = "h" if f[i, j] == h[i, j - 1] + OPEN else "f"
            j -= 1
    return score, pairs[::-1]


def identity(a: str, b: str) -> float:
    """Share of the shorter sequence that is identical in the alignment."""
    if not a or not b:
        return 0.0
    return sum(a[i] == b[j] for i, j in align(a, b)[1]) / min(len(a), len(b))


def sequence_identity() -> Column:
    """Arrow function (sequence, sequence) -> identity; equal pairs of a batch are aligned once."""

    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        memo: dict = {}
        return pd.Series([memo[k] if k in memo else memo.setdefault(k, identity(*k)) for k in zip(a.fillna(""), b.fillna(""))])

    return run


def residue_mapping() -> Column:
    """Arrow function (sequence, sequence) -> map of 1-based positions matched by alignment."""

    @F.pandas_udf("array<struct<a:int,b:int>>")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([[{"a": i + 1, "b": j + 1} for i, j in align(x, y)[1]] for x, y in zip(a.fillna(""), b.fillna(""))])

    return run
