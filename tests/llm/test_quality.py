import random
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
from pyspark.sql import functions as F

from dyadlake.llm import quality_model as qm
from dyadlake.llm import quality_rules as qr
from dyadlake.llm.textstats import LINE_FEATURES, document_lines

from helpers import AWKWARD, DOCS, frame


def plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    again = {j for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines, dups = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(again)


def test_base_statistics_match_the_plain_rules():
    rng = random.Random(6)
    for _ in range(300):
        vocabulary = ["a", "bb", "é#", "|", "$x"][: rng.randrange(1, 6)]
        text = "".join(rng.choice(vocabulary) + rng.choice([" ", "\n", "\t \n", "\x0b", " "]) for _ in range(rng.randrange(60)))
        assert qr.base_statistics(text) == plain(text)
    for _, text, *_ in AWKWARD:
        assert qr.base_statistics(text) == plain(text)


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(1)
    field = qr.LineField(rng.normal(size=(2, LINE_FEATURES)), rng.normal(size=(2, 2)))
    for n in range(1, 9):
        x = rng.integers(0, 2, (n, LINE_FEATURES)).astype(float)
        value = lambda p: sum(x[k] @ field.emit[s] for k, s in enumerate(p)) + sum(field.move[a, b] for a, b in zip(p, p[1:]))
        best = max(product((0, 1), repeat=n), key=value)
        assert tuple(field.decode(x)) == best


def corpus(spark, n=300):
    rng = random.Random(12)
    rows, labels = [], []
    for d in range(n):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(30, 200))]
        bad = d % 4 == 0
        text = "\n".join(" ".join((w + "$$$" if bad else w) for w in words[i : i + 15]) + ("" if bad else ".") for i in range(0, len(words), 15))
        rows.append((d, text, "en", "a", 0))
        labels.append((d, int(not bad), 0))
    return frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_rules_separate_planted_junk(spark):
    docs, labels = corpus(spark)
    field = qr.fit_field(docs, labels)
    got = qr.quality_rules(docs, field).collect()
    assert all(r.kept == (r.doc_id % 4 != 0) for r in got if not r.base_failed) and len(got) == 300
    # a few odd lines do not cost a document its place
    x = document_lines("plain words in a line of content.\n### $$$ %%%\nmore plain words in a line of content.")[0]
    assert field.decode(x)[0] == field.decode(x)[2] == 1


def test_lines_of_both_kinds_in_one_document(spark):
    """A document of content with a block of boilerplate in it is labelled in part, and the field switches inside it."""
    docs, labels = corpus(spark)
    field = qr.fit_field(docs, labels)
    good = "plain words in a line of content that goes on and ends."
    bad = "### $$$ %%% *** &&& ||| $$$ ### %%% $$$ ### $$$"
    text = "\n".join([good] + [good.replace("plain", f"other{k}") for k in range(5)] + [bad.replace("$$$", f"$${k}") for k in range(5)] + [good.replace("words", f"things{k}") for k in range(5)])
    x = document_lines(text)[0]
    assert field.decode(x).tolist() == [1] * 6 + [0] * 5 + [1] * 5
    # and fitted on documents that mix both, the moves are those of the sequences
    mixed = [np.vstack([x, x])] * 20 + [x[6:11]] * 20
    weak = qr.weak_labels(mixed, [1] * 20 + [0] * 20)
    assert all(0 < w.sum() < len(w) for w in weak[:20]) and not any(w.any() for w in weak[20:])
    again = qr.LineField.fit(mixed, weak)
    assert again.decode(x).tolist() == field.decode(x).tolist()


def test_two_labels_and_repeated_ids_train_alike(spark):
    docs, labels = corpus(spark, 60)
    more = labels.unionByName(labels.selectExpr("doc_id", "0 as quality", "toxic"))
    one, two = qr.fit_field(docs, labels), qr.fit_field(docs.unionByName(docs), more.orderBy(F.rand(3)))
    assert np.allclose(one.emit, two.emit) and np.allclose(one.move, two.move)
    x = np.random.default_rng(0).random((5, qm.DOC_FEATURES))
    assert np.allclose(qm.train(docs, labels).score(x), qm.train(docs.unionByName(docs), more).score(x))


def test_ridge_is_that_of_all_rows_at_once(spark):
    """Partition-summed normal equations against one dense solve over the same features."""
    docs, labels = corpus(spark, 120)
    model = qm.train(docs.repartition(5), labels)
    marks = {r.doc_id: r.quality for r in labels.collect()}
    rows = [(qm.doc_features(r.text), marks[r.doc_id]) for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 5]
    x, y = np.array([r for r, _ in rows]), np.array([float(q) for _, q in rows])
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.scale, x.std(0) + 1e-3)
    p, w = model.project(x), np.where(y > 0, 0.5 * len(y) / y.sum(), 0.5 * len(y) / (len(y) - y.sum()))[:, None]
    want = np.linalg.solve((p * w).T @ p + qm.RIDGE * len(y) / qm.COMPONENTS * np.eye(p.shape[1]), (p * w).T @ y)
    assert np.allclose(model.raw(x), p @ want, atol=1e-6)
    # the features' inner products are the Gaussian kernel's, up to the sampling of directions
    z = np.clip((x - model.mean) / model.scale, -8, 8)
    kernel = np.exp(-0.5 * qm.WIDTH**2 * ((z[:, None] - z[None]) ** 2).sum(-1))
    assert np.abs(p[:, :-1] @ p[:, :-1].T - kernel).mean() < 0.1


def test_rules_on_awkward_rows(spark):
    docs, labels = corpus(spark, 40)
    for field in (None, qr.fit_field(docs, labels)):
        got = {r.doc_id: r for r in qr.quality_rules(frame(spark), field).collect()}
        for d, text, *_ in AWKWARD:
            r, want = got[d], plain(text)
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
            assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and not (r.base_failed and r.kept)
    assert qr.fit_field(docs, labels.limit(0)) is None
    assert qr.quality_rules(frame(spark, AWKWARD[:1]).limit(0), None).collect() == []


def test_classifier_held_out(spark):
    docs, labels = corpus(spark)
    got = qm.score_quality(docs, qm.train(docs, labels)).collect()
    assert len(got) == 300
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == (r.doc_id % 4 != 0) for r in held]) > 0.95


def test_classifier_awkward_rows(spark):
    docs, labels = corpus(spark, 60)
    rows = [*AWKWARD, (None, "no id", None, None, None), AWKWARD[3]]
    for model in (qm.train(docs, labels), qm.train(docs, labels.limit(0)), qm.train(docs.limit(0), labels), qm.train(docs, labels.where("quality = 1"))):
        got = qm.score_quality(spark.createDataFrame(rows, DOCS), model).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert qm.score_quality(docs.limit(0), model).collect() == []


def test_pooling_is_isotonic():
    x, y = qm.pool(np.arange(6.0), np.array([0, 1, 0, 0.5, 0.4, 1]), np.array([1.0, 2, 2, 1, 1, 3]))
    # 1, 0, 0.5 and 0.4 pool to 2.9 / 6 by weight
    assert (np.diff(x) > 0).all() and np.allclose(y, [0.02 / 1.04, 2.92 / 6.04, 3.02 / 3.04])


def test_held_out_is_the_checksum(spark):
    rows = spark.range(50).select("id", qm.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def test_capitals_are_counted_over_the_whole_line():
    late, early = "low " * 400 + "HIGH " * 500, "HIGH " * 400 + "low " * 500
    flags = [document_lines(t)[0][0][3] for t in (late, early, "HIGH " * 900, "low " * 900)]
    assert flags == [1, 0, 1, 0]
