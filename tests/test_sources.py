import gzip

from pyspark.sql import functions as F

from dyadlake.schema import ALIGNMENT, coerce, index_columns
from dyadlake.sources import structures, tables

PDB = """ATOM      1  N   ALA A   1      11.104   6.134  -6.504  1.00 10.50           N
ATOM      2  CA  ALA A   1      11.639   6.071  -5.147  1.00 11.00           C
ATOM      3  CA  GLY A   2A     13.104   6.134  -4.504  1.00 12.00           C
HETATM    4  O   HOH B 101       1.000   2.000   3.000  1.00  0.00           O
END
"""


def test_pdb_round_trip(spark, tmp_path):
    (tmp_path / "a.pdb").write_text(PDB)
    atoms = structures.read_pdb(spark, str(tmp_path / "a.pdb"))
    rows = atoms.orderBy("atom_idx").collect()
    assert [(r.chain_id, r.res_name, r.res_code, r.res_id, r.atom_name, r.ins_code, r.hetero, r.element) for r in rows[1:]] == [
        ("A", "ALA", "A", 1, "CA", "", False, "C"), ("A", "GLY", "G", 2, "CA", "A", False, "C"), ("B", "HOH", "X", 101, "O", "", True, "O"),
    ]
    assert (rows[0].x, rows[0].z, rows[0].b_factor) == (11.104, -6.504, 10.5)
    structures.write_pdb(atoms.withColumn("id", F.lit("one")), str(tmp_path / "out"))
    again = structures.read_pdb(spark, str(tmp_path / "out" / "id=one"))
    keep = [c for c in atoms.columns if c not in ("path", "atom_idx")]
    assert sorted(map(tuple, again.select(*keep).collect())) == sorted(map(tuple, atoms.select(*keep).collect()))
    assert [tuple(r) for r in structures.sequences(atoms, ["chain_id"]).collect()] == [("A", "AG")]


def test_mmcif_loops_and_items(spark, tmp_path):
    text = """data_X
_entry.id X
loop_
_atom_site.id
_atom_site.label
_atom_site.note
1 CA 'it is'
2 "C B" ?
3 N
;long
text
;
loop_
_other.a
9
"""
    (tmp_path / "x.cif.gz").write_bytes(gzip.compress(text.encode()))
    got = structures.read_mmcif(spark, str(tmp_path / "x.cif.gz"), "_atom_site").select("row").collect()
    assert [r.row for r in got] == [{"id": "1", "label": "CA", "note": "it is"}, {"id": "2", "label": "C B", "note": None}, {"id": "3", "label": "N", "note": "long\ntext"}]
    assert [r.row for r in structures.read_mmcif(spark, str(tmp_path), "_entry").collect()] == [{"id": "X"}]


def test_fasta(spark, tmp_path):
    (tmp_path / "a.fasta").write_text(">one first\nMKT\nAYI\n>two\nGG\n")
    assert sorted(map(tuple, structures.read_fasta(spark, str(tmp_path / "a.fasta")).collect())) == [("one", "MKTAYI"), ("two", "GG")]


def test_delimited_text_keeps_the_chain_named_na(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("pdb_id\tchain\tn\n0123\tNA\t5\n4abc\tnan\tx\n")
    got = tables.read_delimited(spark, str(tmp_path / "a.tsv"), "\t", {"n": "int"}).collect()
    assert [tuple(r) for r in got] == [("0123", "NA", 5), ("4abc", None, None)]


def test_alignments_and_index_coercion(spark, tmp_path):
    (tmp_path / "a.txt").write_text("q1\tt1\t0.9\t1\t5\t10\t2\t6\t12\t5\nq2\tt2\tnan\t1\t5\t10\t2\t6\t12\t5\n")
    got = tables.read_alignments(spark, str(tmp_path / "a.txt"))
    assert got.columns == list(ALIGNMENT) and sorted(r.score for r in got.collect()) == [0.5, 0.9]
    index = index_columns(("small", "large", "modelled"))
    fixed = coerce(spark.createDataFrame([("a", "x", "7")], "id string, chain1_neff string, extra string"), index)
    assert fixed.columns == list(index) and len(index) == 34
    assert fixed.first().chain1_neff == 0.0 and fixed.first().holo_R is False and fixed.first().split == ""


def test_records_and_flattening(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": "x", "c": {"d": {"e": 1}}}\nbroken\n')
    good, bad = tables.read_records(spark, str(tmp_path / "a.json"), "id string, c struct<d:struct<e:int>>")
    assert tables.flatten(good).first().asDict() == {"id": "x", "c_d_e": 1} and [r._corrupt for r in bad.collect()] == ["broken"]
    entries = spark.createDataFrame([("x",), ("y",)], "id string")
    got = tables.with_sentinels(entries, good.select("id", F.lit("ok").alias("status")), "id", {"status": "missing"})
    assert sorted(map(tuple, got.collect())) == [("x", "ok"), ("y", "missing")]
