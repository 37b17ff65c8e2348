"""Identifier grammar: ``source__chain_accession[-R|-L]`` monomers and ``monomer--monomer`` dimers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_side(c: str | Column) -> Column:
    return F.regexp_replace(c, "-[RL]$", "")


def strip_file_suffix(c: str | Column) -> Column:
    return F.regexp_replace(c, "\\.pdb$", "")


def parse_monomer(c: str | Column) -> Column:
    """struct(source, chain, uniprot, first, last, side).

    Sources of four characters are entries: ``source__chain_accession``.  Others
    are models: ``source__accession`` without a chain, or
    ``source__accession_first_last``, whose chain is A.
    """
    full = strip_file_suffix(c)
    side = F.nullif(F.regexp_extract(full, "-([RL])$", 1), F.lit(""))
    body = strip_side(full)
    source = F.split_part(body, F.lit("__"), F.lit(1))
    parts = F.split(F.split_part(body, F.lit("__"), F.lit(2)), "_")
    entry, ranged = F.char_length(source) == 4, F.size(parts) == 3
    chain = F.when(entry, F.get(parts, F.lit(0))).when(ranged, "A")
    uniprot = F.when(entry, F.element_at(parts, -1)).otherwise(F.get(parts, F.lit(0)))
    bound = lambda k: F.when(~entry & ranged, F.get(parts, F.lit(k)).try_cast("int"))
    return F.struct(source.alias("source"), chain.alias("chain"), uniprot.alias("uniprot"), bound(1).alias("first"), bound(2).alias("last"), side.alias("side"))


def parse_dimer(c: str | Column) -> Column:
    full = strip_file_suffix(c)
    return F.struct(parse_monomer(F.split_part(full, F.lit("--"), F.lit(1))).alias("R"), parse_monomer(F.split_part(full, F.lit("--"), F.lit(2))).alias("L"))


def chain_key(c: str | Column) -> Column:
    """pdb_chain of a monomer id."""
    return F.concat_ws("_", F.split_part(c, F.lit("__"), F.lit(1)), F.split_part(F.split_part(c, F.lit("__"), F.lit(2)), F.lit("_"), F.lit(1)))


def asym_key(c: str | Column) -> Column:
    """``chain_key`` without the copy number."""
    return F.regexp_replace(chain_key(c), "[0-9]+$", "")


def pair_keys(c: str | Column) -> Column:
    return F.transform(F.split(c, "--"), asym_key)


def copy_number(chain: str | Column) -> Column:
    return F.coalesce(F.regexp_extract(chain, "(\\d+)", 1).try_cast("int"), F.lit(1))


def residue_label(c: str | Column) -> Column:
    """'12.0' becomes '12', '101A' stays, null becomes ''."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.try_cast("double").try_cast("int").cast("string"), c, F.lit(""))


def natural_key(c: str | Column) -> Column:
    """Sort key in which digit runs order as numbers, of any length, and letters without case: each run has its length in front."""
    runs = F.regexp_extract_all(F.lower(c), F.lit("(\\d+|\\D+)"), F.lit(1))
    bare = lambda r: F.regexp_replace(r, "^0+(?=\\d)", "")
    return F.array_join(F.transform(runs, lambda r: F.when(r.rlike("^\\d"), F.concat(F.format_string("%010d", F.char_length(bare(r))), bare(r))).otherwise(r)), "")


def last_number(c: str | Column) -> Column:
    return F.regexp_extract(c, "(\\d+)\\D*$", 1).try_cast("int")
