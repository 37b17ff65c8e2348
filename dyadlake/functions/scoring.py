"""Docking scores and classes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dockq(fnat: Column, irms: Column, lrms: Column) -> Column:
    return (fnat + 1 / (1 + F.pow(irms / 1.5, F.lit(2))) + 1 / (1 + F.pow(lrms / 8.5, F.lit(2)))) / 3


#: Fixed values: (class, contact share from, below, deviations up to (ligand, interface), deviations above which more contacts still count here).
RUNGS = {
    False: (("Acceptable", 0.1, 0.3, (10.0, 4.0), (5.0, 2.0)), ("Medium", 0.3, 0.5, (5.0, 2.0), (1.0, 1.0)), ("High", 0.5, None, (1.0, 1.0), None)),
    True: (("Acceptable", 0.2, 0.5, (5.0, 2.0), (2.0, 1.0)), ("Medium", 0.5, 0.8, (2.0, 1.0), (1.0, 0.5)), ("High", 0.8, None, (1.0, 0.5), None)),
}


def capri(fnat: Column, irms: Column, lrms: Column, peptide: bool = False) -> Column:
    """Docking class from the rungs in order; 'Incorrect' below the first, 'Undef' where none holds."""
    _, least, _, (far_l, far_i), _ = RUNGS[peptide][0]
    out = F.when((fnat < least) | ((lrms > far_l) & (irms > far_i)), "Incorrect")
    for name, low, high, (max_l, max_i), over in RUNGS[peptide]:
        near = (lrms <= max_l) | (irms <= max_i)
        holds = (fnat >= low) & near if high is None else (fnat >= low) & (fnat < high) & near
        if over:
            holds = holds | ((fnat >= high) & (lrms > over[0]) & (irms > over[1]))
        out = out.when(holds, name)
    return out.otherwise("Undef")


def capri_rank(label: Column) -> Column:
    """3 for High down to 0."""
    return F.greatest(F.lit(0), F.array_position(F.array(*map(F.lit, ("Acceptable", "Medium", "High"))), label).cast("int"))


def difficulty(irms: Column, fnonnat: Column) -> Column:
    """Benchmark class of an unbound pair: fixed bounds 1.5 and 2.2 of the interface deviation, 0.4 of new contacts; a missing deviation is difficult."""
    rigid = (irms <= 1.5) & (fnonnat <= 0.4)
    medium = ((irms > 1.5) & (irms <= 2.2)) | ((irms <= 1.5) & (fnonnat > 0.4))
    return F.when(rigid, "Rigid-body").when(medium, "Medium").otherwise("Difficult")


def contact_summary(bound: Column, unbound: Column) -> Column:
    """Shares and counts of kept, lost and new contacts of two sets of struct(c1, c2, r1, r2)."""
    kept = F.size(F.array_intersect(bound, unbound)).cast("double")
    new = F.size(F.array_except(unbound, bound)).cast("double")
    return F.struct(
        safe_divide(kept, F.size(bound).cast("double")).alias("fnat"),
        safe_divide(new, F.size(unbound).cast("double")).alias("fnonnat"),
        kept.cast("long").alias("native_kept"),
        new.cast("long").alias("non_native"),
    )


def safe_divide(a: Column, b: Column, default: float = 0.0) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(default))


def safe_percentage(n: Column, d: Column) -> Column:
    return 100 * F.try_divide(n, d)
