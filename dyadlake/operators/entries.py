"""What a catalogue row implies: file paths, alternatives, composition; and identifiers written from their parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids


def monomer_id(source: Column, chain: Column, uniprot: Column, first: Column, last: Column) -> Column:
    """The identifier of a chain: an entry's, a model's, or a model's with its range."""
    ranged = F.concat(source, F.lit("__"), uniprot, F.lit("_"), first.cast("string"), F.lit("_"), last.cast("string"))
    entry = F.concat(source, F.lit("__"), chain, F.lit("_"), uniprot)
    return F.when(F.char_length(source) == 4, entry).otherwise(F.coalesce(ranged, F.concat(source, F.lit("__"), uniprot)))


def entry_chains(path: str | Column) -> Column:
    """entry_chainR_chainL of a dimer's file name."""
    both = ids.parse_dimer(path)
    return F.concat_ws("_", F.split_part(path, F.lit("_"), F.lit(1)), both["R"]["chain"], both["L"]["chain"])


def structure_path(name: Column, split: Column) -> Column:
    """Folder and name of a structure file; single chains of test systems have a folder of their own."""
    own = (split == "test") & name.rlike(r"-[RL]\.pdb$")
    return F.when(name == "", "").when(own, F.concat(F.lit("test_set_pdbs/"), name)).otherwise(F.concat(F.lit("pdbs/"), name))


def mapping_path(name: Column) -> Column:
    return F.when(name == "", "").otherwise(F.concat(F.lit("mappings/"), F.replace(name, F.lit(".pdb"), F.lit(".parquet"))))


def alternatives(every: Column, chosen: Column) -> Column:
    """Files of a ';' list other than the chosen one."""
    return F.filter(F.split(every, ";"), lambda f: f != chosen)


def described(index: DataFrame) -> DataFrame:
    """Adds homodimer, test_system, apo_R_alt, apo_L_alt, and the maps pdb_paths and alternative_paths."""
    split = F.col("split")
    kinds = [f"{kind}_{side}" for kind in ("holo", "predicted", "apo") for side in "RL"]
    native = structure_path(F.concat("id", F.lit(".pdb")), split)
    single = [x for kind in kinds for x in (F.lit(kind), structure_path(F.col(f"{kind}_pdb"), split))]
    alt = {side: alternatives(F.col(f"apo_{side}_pdbs"), F.col(f"apo_{side}_pdb")) for side in "RL"}
    paths = [x for side in "RL" for x in (F.lit(f"apo_{side}_alt"), F.transform(alt[side], lambda f: structure_path(f, split)))]
    return index.withColumns(
        {
            "homodimer": F.col("uniprot_R") == F.col("uniprot_L"),
            "test_system": split == "test",
            **{f"apo_{side}_alt": a for side, a in alt.items()},
            "pdb_paths": F.create_map(F.lit("native"), native, *single),
            "alternative_paths": F.create_map(*paths),
        }
    )


def flipped_alignments(df: DataFrame) -> DataFrame:
    """Query and target of alignment records exchanged."""
    swap = {"query": "target", "qstart": "tstart", "qend": "tend", "qlen": "tlen"}
    both = swap | {b: a for a, b in swap.items()}
    return df.select(*[F.col(both.get(c, c)).alias(c) for c in df.columns])


def parsed_interfaces(lines: DataFrame, column: str = "value") -> DataFrame:
    """(id1, id2, residues1, residues2) of tab-separated lines with comma lists."""
    parts = F.split(column, "\t")
    numbers = lambda k: F.array_distinct(F.transform(F.split(parts[k], ","), lambda x: x.cast("int")))
    return lines.select(parts[0].alias("id1"), parts[1].alias("id2"), numbers(2).alias("residues1"), numbers(3).alias("residues2"))


def flipped_interfaces(df: DataFrame) -> DataFrame:
    return df.select(F.col("id2").alias("id1"), F.col("id1").alias("id2"), F.col("residues2").alias("residues1"), F.col("residues1").alias("residues2"))


def joined_lists(df: DataFrame, sep: str = ",") -> DataFrame:
    """Array columns as separated text, others as they are."""
    arrays = {f.name for f in df.schema.fields if f.dataType.typeName() == "array"}
    return df.select(*[F.array_join(F.transform(c, lambda x: x.cast("string")), sep).alias(c) if c in arrays else F.col(c) for c in df.columns])


def json_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nested columns as JSON text, where the table has them."""
    return df.withColumns({c: F.to_json(c) for c in columns if c in df.columns})


def feature_positions(df: DataFrame, column: str = "feature_positions") -> DataFrame:
    """Start and end of a feature's first position, and all of them as JSON; tables without the column pass."""
    if column not in df.columns:
        return df
    first = F.get(column, F.lit(0))
    return df.withColumns({"beg_seq_id": first["beg_seq_id"], "end_seq_id": first["end_seq_id"], column: F.to_json(column)})


def narrowed(df: DataFrame) -> DataFrame:
    """Integers in the narrowest type that holds their range, from one pass of minima and maxima."""
    kinds = {"tinyint": "tinyint", "smallint": "smallint", "int": "int", "bigint": "bigint"}
    columns = [c for c, k in df.dtypes if k in kinds]
    if not columns:
        return df
    seen = df.agg(*[F.min(c).alias(f"lo_{c}") for c in columns], *[F.max(c).alias(f"hi_{c}") for c in columns]).first()

    def kind(c: str) -> str:
        lo, hi = seen[f"lo_{c}"], seen[f"hi_{c}"]
        if lo is None:
            return dict(df.dtypes)[c]
        return next(k for k, bits in (("smallint", 15), ("int", 31), ("bigint", 63)) if -(1 << bits) < lo and hi < (1 << bits) - 1 or bits == 63)

    return df.withColumns({c: F.col(c).cast(kind(c)) for c in columns})
