"""Table schemas and coercion: fixed columns with defaults, open tails kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DEFAULTS = {"string": "", "int": 0, "bigint": 0, "double": 0.0, "boolean": False}


#: Column names and types of the files, in the files' order.  The catalogue's flags of test subsets stand between its two parts.
INDEX_HEAD = {
    "split": "string",
    "id": "string",
    "pdb_id": "string",
    "cluster_id": "string",
    "cluster_id_R": "string",
    "cluster_id_L": "string",
}
INDEX_TAIL = {
    "uniprot_R": "string",
    "uniprot_L": "string",
    "holo_R_pdb": "string",
    "holo_L_pdb": "string",
    "predicted_R_pdb": "string",
    "predicted_L_pdb": "string",
    "apo_R_pdb": "string",
    "apo_L_pdb": "string",
    "apo_R_pdbs": "string",
    "apo_L_pdbs": "string",
    "holo_R": "boolean",
    "holo_L": "boolean",
    "predicted_R": "boolean",
    "predicted_L": "boolean",
    "apo_R": "boolean",
    "apo_L": "boolean",
    "apo_R_quality": "string",
    "apo_L_quality": "string",
    "chain1_neff": "double",
    "chain2_neff": "double",
    "chain_R": "string",
    "chain_L": "string",
    "contains_antibody": "boolean",
    "contains_antigen": "boolean",
    "contains_enzyme": "boolean",
}
ALIGNMENT = {
    "query": "string",
    "target": "string",
    "score": "double",
    "qstart": "int",
    "qend": "int",
    "qlen": "int",
    "tstart": "int",
    "tend": "int",
    "tlen": "int",
    "alnlen": "int",
}
RESIDUE_MAPPING = {
    "entry_id": "string",
    "entity_id": "int",
    "asym_id": "string",
    "pdb_strand_id": "string",
    "resi": "int",
    "resi_pdb": "int",
    "resi_auth": "string",
    "resn": "string",
    "one_letter_code_can": "string",
    "resolved": "int",
    "one_letter_code_uniprot": "string",
    "resi_uniprot": "int",
    "uniprot_acc": "string",
    "chain": "string",
}
ATOMS = {
    "chain_id": "string",
    "res_name": "string",
    "res_code": "string",
    "res_id": "int",
    "atom_name": "string",
    "b_factor": "double",
    "ins_code": "string",
    "hetero": "boolean",
    "element": "string",
    "x": "double",
    "y": "double",
    "z": "double",
}


def index_columns(subsets: tuple[str, ...]) -> dict[str, str]:
    """The catalogue's columns, with one boolean a test subset as the caller's files name them."""
    return INDEX_HEAD | dict.fromkeys(subsets, "boolean") | INDEX_TAIL


def struct(columns: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField(c, T._parse_datatype_string(k), True) for c, k in columns.items()])


def coerce(df: DataFrame, columns: dict[str, str], nullable: tuple[str, ...] = (), renames: dict[str, str] | None = None, drop: tuple[str, ...] = (), keep_rest: bool = False) -> DataFrame:
    """Cast to the declared types; nulls and values that do not parse take the type's default, missing columns are added."""
    for old, new in (renames or {}).items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    out = []
    for c, kind in columns.items():
        value = F.col(c).try_cast(kind) if c in df.columns else F.lit(None).cast(kind)
        out.append((value if c in nullable else F.coalesce(value, F.lit(_DEFAULTS[kind]))).alias(c))
    rest = [c for c in df.columns if c not in columns and c not in drop] if keep_rest else []
    return df.select(*out, *rest)


def resolution(c: str):
    """A missing or '.' resolution counts as 0.0, which passes upper bounds."""
    return F.coalesce(F.col(c).try_cast("double"), F.lit(0.0))
