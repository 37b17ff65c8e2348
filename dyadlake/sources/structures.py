"""Coordinate and sequence files as tables: fixed-width PDB lines, mmCIF loops, FASTA records."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: One-letter codes of the standard residues.
ONE_LETTER = {
    "ALA": "A", "ARG": "R", "ASN": "N", "ASP": "D", "CYS": "C", "GLN": "Q", "GLU": "E", "GLY": "G", "HIS": "H", "ILE": "I",
    "LEU": "L", "LYS": "K", "MET": "M", "PHE": "F", "PRO": "P", "SER": "S", "THR": "T", "TRP": "W", "TYR": "Y", "VAL": "V",
}


def one_letter(c) -> F.Column:
    table = F.create_map(*[F.lit(x) for kv in ONE_LETTER.items() for x in kv])
    return F.coalesce(F.try_element_at(table, F.upper(c)), F.lit("X"))


def read_pdb(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The atom table of fixed-width coordinate files, by native substrings: (path, model, atom_idx, chain_id, ..., x, y, z)."""
    lines = spark.read.text(paths).select(F.input_file_name().alias("path"), F.monotonically_increasing_id().alias("atom_idx"), "value")
    cut = lambda start, n: F.trim(F.substring("value", start, n))
    atoms = lines.where(F.col("value").startswith("ATOM  ") | F.col("value").startswith("HETATM"))
    name = cut(18, 3)
    element = F.when(cut(77, 2) != "", cut(77, 2)).otherwise(F.regexp_extract(cut(13, 4), "([A-Z])", 1))
    return atoms.select(
        "path", "atom_idx", cut(22, 1).alias("chain_id"), name.alias("res_name"), one_letter(name).alias("res_code"),
        cut(23, 4).try_cast("int").alias("res_id"), cut(13, 4).alias("atom_name"), cut(61, 6).try_cast("double").alias("b_factor"),
        cut(27, 1).alias("ins_code"), F.col("value").startswith("HETATM").alias("hetero"), element.alias("element"),
        *[cut(31 + 8 * k, 8).try_cast("double").alias(c) for k, c in enumerate("xyz")],
    )


def pdb_line() -> F.Column:
    """A row of the atom table as a fixed-width line."""
    return F.format_string(
        "%-6s%5d %-4s %3s %1s%4d%1s   %8.3f%8.3f%8.3f  1.00%6.2f          %2s",
        F.when(F.col("hetero"), "HETATM").otherwise("ATOM"), F.pmod("atom_idx", F.lit(100000)).cast("int"),
        F.when(F.length("atom_name") < 4, F.concat(F.lit(" "), F.col("atom_name"))).otherwise(F.col("atom_name")),
        "res_name", "chain_id", "res_id", F.when(F.col("ins_code") == "", " ").otherwise(F.col("ins_code")), "x", "y", "z", "b_factor", "element",
    )


def write_pdb(atoms: DataFrame, path: str, by: str = "id") -> None:
    """One folder of lines for each value of ``by``, in atom order."""
    atoms.repartition(by).sortWithinPartitions(by, "atom_idx").select(by, pdb_line().alias("value")).write.mode("overwrite").partitionBy(by).text(path)


def read_fasta(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(id, sequence) of every record."""
    records = spark.read.option("lineSep", ">").text(paths).where(F.length(F.trim("value")) > 0)
    head = F.split("value", "\n", 2)
    return records.select(F.split_part(F.trim(head[0]), F.lit(" "), F.lit(1)).alias("id"), F.regexp_replace(F.coalesce(F.get(head, F.lit(1)), F.lit("")), "\\s", "").alias("sequence"))


def sequences(atoms: DataFrame, by: list[str]) -> DataFrame:
    """One-letter sequence of each chain from its residues in order."""
    residues = atoms.where(~F.col("hetero")).groupBy(*by, "res_id", "ins_code").agg(F.min("atom_idx").alias("at"), F.first("res_code").alias("code"))
    return residues.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "code"))), lambda r: r["code"]), "").alias("sequence"))


def _tokens(lines: list[str]) -> Iterator[str]:
    """Words of an mmCIF file; quoted and semicolon-delimited values are one word."""
    text: list[str] | None = None
    for line in lines:
        if line.startswith(";"):
            if text is None:
                text = [line[1:]]
            else:
                yield "\n".join(text)
                text = None
            continue
        if text is not None:
            text.append(line)
            continue
        at, n = 0, len(line)
        while at < n:
            c = line[at]
            if c.isspace():
                at += 1
            elif c == "#":
                break
            elif c in "'\"":
                end = at + 1
                while end < n and not (line[end] == c and (end + 1 == n or line[end + 1].isspace())):
                    end += 1
                yield line[at + 1 : end]
                at = end + 1
            else:
                end = at
                while end < n and not line[end].isspace():
                    end += 1
                yield line[at:end]
                at = end


def category(text: str, name: str) -> list[dict[str, str]]:
    """Rows of one category, whether a loop or single items."""
    words, prefix, rows, single = list(_tokens(text.splitlines())), name + ".", [], {}
    at = 0
    while at < len(words):
        if words[at].lower() == "loop_":
            at += 1
            fields = []
            while at < len(words) and words[at].startswith("_"):
                fields.append(words[at])
                at += 1
            start = at
            while at < len(words) and not (words[at].startswith(("_", "data_")) or words[at].lower() == "loop_"):
                at += 1
            if fields and fields[0].startswith(prefix):
                values = words[start:at]
                rows += [dict(zip((f[len(prefix) :] for f in fields), values[i : i + len(fields)])) for i in range(0, len(values) - len(fields) + 1, len(fields))]
        elif words[at].startswith(prefix) and at + 1 < len(words):
            single[words[at][len(prefix) :]] = words[at + 1]
            at += 2
        else:
            at += 1
    return rows + ([single] if single else [])


def read_mmcif(spark: SparkSession, paths: str | list[str], name: str) -> DataFrame:
    """(path, row) of a category, a row being a map of its items; gzipped files are read as they are, '?' and '.' are null."""
    files = spark.read.format("binaryFile").load(paths).select("path", "content")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gzip

        for batch in batches:
            out: tuple[list, list] = ([], [])
            for path, raw in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                text = (gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw).decode("utf-8", "replace")
                for row in category(text, name):
                    out[0].append(path)
                    out[1].append([(k, None if v in "?." else v) for k, v in row.items()])
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.map_(pa.string(), pa.string()))], names=["path", "row"])

    return files.mapInArrow(parse, "path string, row map<string,string>")
