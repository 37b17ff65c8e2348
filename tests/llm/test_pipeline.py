import re

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from dyadlake.llm import mixing
from dyadlake.llm.store import materialize

from helpers import AWKWARD, DOCS, frame
from test_line_dedup import brute as brute_lines
from test_line_dedup import corpus as line_corpus
from test_near_dedup import brute as brute_near
from test_near_dedup import corpus as near_corpus
from test_packing import check_round_trip


def rows_of(df):
    return [tuple(r)[:5] for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_stages_on_their_own_input(spark, tmp_path):
    rows = near_corpus(seed=5, groups=6, singles=30)
    rows += [(d + 5000, t, lang, "b" if d % 2 else None, n) for d, t, lang, _, n in line_corpus(seed=8)]
    bad = [(9000 + k, " ".join(f"junk{k}{i}$$$ ###" for i in range(60)), "en", "b", 0) for k in range(40)]
    docs = spark.createDataFrame(rows + bad, DOCS)
    labels = spark.createDataFrame([(r[0], int(r[0] < 9000), 0) for r in rows + bad], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    run = {name: f for name, f in corpus_pipeline.STAGES}

    good = materialize(run["quality"](spark, docs, str(tmp_path)), "t")
    assert good.columns == docs.columns
    ids = {r[0] for r in rows_of(good)}
    assert not ids & {r[0] for r in bad} and len(ids) >= 0.97 * len(rows)

    lined = materialize(run["lines"](spark, good, str(tmp_path)), "t")
    assert {r[0]: r[1] for r in rows_of(lined)} == brute_lines(rows_of(good))
    assert all(r[4] == len(r[1]) for r in rows_of(lined)) and lined.columns == docs.columns

    single = materialize(run["near_duplicates"](spark, good, str(tmp_path)), "t")
    assert sorted(r[0] for r in rows_of(single)) == sorted(d for d, (_, _, kept) in brute_near(rows_of(good)).items() if kept)

    mixed = materialize(run["mix"](spark, single, str(tmp_path)), "t")
    taken = {r.doc_id: r.taken for r in mixing.mix_sources(single).collect()}
    words = {}
    texts = {r[0]: r[1] for r in rows_of(single)}
    for d, text, *_ in rows_of(mixed):
        words[d] = words.get(d, 0) + len(re.findall(mixing.WORD, text))
        assert texts[d].startswith(text)
    assert words == {d: n for d, n in taken.items() if n}

    packed = run["pack"](spark, single, str(tmp_path)).collect()
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    check_round_trip([tuple(r) for r in packed], {d: [*whole.encode(t or "", add_special_tokens=False).ids, 1] for d, t in texts.items()})


def test_awkward_rows_run_through(spark, tmp_path):
    labels = spark.createDataFrame([(d, 1, 0) for d, *_ in AWKWARD], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    rows = [*AWKWARD, AWKWARD[5], (None, AWKWARD[5][1], None, None, None)]
    for docs in (frame(spark, rows), frame(spark, rows).limit(0)):
        n = docs.count()
        for _, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, str(tmp_path)), "t")
        assert (docs.count() > 0) == (n > 0)


def test_repeated_rows_leave_one(spark):
    got = corpus_pipeline.near_duplicates(spark, frame(spark, [*AWKWARD, AWKWARD[5], AWKWARD[5]]), "")
    ids = sorted(r.doc_id for r in got.collect())
    assert ids == [1, 2, 3, 4, 5, 6, 7, 9, 10]
