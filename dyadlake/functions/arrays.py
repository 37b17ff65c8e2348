"""Set, interval and map algebra on arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def span(start: Column, end: Column, closed: bool = True) -> Column:
    """The integers from start to end; empty, never descending, when end lies before start."""
    last = end if closed else end - 1
    return F.when(start <= last, F.sequence(start, last)).otherwise(F.array().cast("array<int>"))


def coverage(values: Column, start: Column, end: Column, closed: bool = True) -> Column:
    """Share of the distinct values inside the interval; null for no values."""
    last = end if closed else end - 1
    distinct = F.array_distinct(values)
    return F.try_divide(F.size(F.filter(distinct, lambda v: (v >= start) & (v <= last))).cast("double"), F.size(distinct).cast("double"))


def jaccard(a: Column, b: Column) -> Column:
    return F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(F.array_union(a, b)).cast("double"))


def map_values_of(values: Column, mapping: Column) -> Column:
    """Values sent through a map; unmapped ones go."""
    return F.filter(F.transform(values, lambda v: F.try_element_at(mapping, v)), lambda v: v.isNotNull())


def invert(mapping: Column) -> Column:
    return F.map_from_entries(F.transform(F.map_entries(mapping), lambda e: F.struct(e["value"].alias("key"), e["key"].alias("value"))))


def longest_label(labels: Column, overlaps: Column, least: int = 1) -> Column:
    """The label of the largest overlap (the first of equals), where it is large enough."""
    top = F.array_max(overlaps)
    return F.when(top >= least, F.element_at(labels, F.array_position(overlaps, top).cast("int")))


def pair_product_size(a: Column, b: Column) -> Column:
    """Number of unordered pairs of one element from each set."""
    n, m, i = F.size(F.array_distinct(a)), F.size(F.array_distinct(b)), F.size(F.array_intersect(a, b))
    return (n * m - (i * i - i) / 2).cast("long")


def pair_product(a: Column, b: Column) -> Column:
    pairs = F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: F.struct(F.least(x, y).alias("lo"), F.greatest(x, y).alias("hi")))))
    return F.array_sort(F.array_distinct(pairs))
