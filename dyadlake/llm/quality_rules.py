"""Quality rules (operator 10): line sequence labelling.

Base rules count words, symbols, repeated lines and repeated windows over whole
texts.  The verdict is a linear-chain conditional random field's: Viterbi
decoding marks every line as content or boilerplate, and the share of code
points in content lines decides.

The field is trained here.  Lines get weak labels of their own: a line has its
document's quality label unless its features, by their frequencies in lines of
both classes, speak against it; so good documents have boilerplate lines, poor
ones content, and the transitions are learned from sequences that switch.

The fit takes at most ``TRAIN_DOCS`` labelled documents of each class (the first
by hashed id; an id that repeats trains with one of its rows, two labels of an
id count as the larger), and at most ``TRAIN_LINES`` lines of each, a bound on
training alone.  Without labels of both classes a document's base rules decide.

Null and empty texts have no words and fail the base rules.  Repeated rows are
judged alike.  Extra columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textops as T
from .store import documents
from .textstats import LINE_FEATURES, document_lines

MIN_WORDS = 20
MAX_REPEATED = 30
WINDOW = 8
SHARE = 0.5
TRAIN_DOCS = 600
TRAIN_LINES = 60
STEPS = 150
#: Log odds against its document's label from which a line has the other one.
AGAINST = 1.0

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


def base_statistics(text: str | None) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    raw = T.encode(text)
    starts, ends = T.word_bounds(raw)
    n = len(starts)
    if not n:
        return 0, 0, 0, 0, 0
    data = np.frombuffer(raw, np.uint8)
    spaces = len(raw) - int((ends - starts).sum())
    symbols = int(np.count_nonzero(_SYMBOLS[data]))
    seen, dups = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            dups += line in seen
            seen.add(line)
    repeated = 0
    windows = T.window_hashes(T.word_hashes(raw, starts, ends), WINDOW)
    if len(windows):
        order = np.sort(windows)
        twice = order[1:][order[1:] == order[:-1]]
        if len(twice):
            repeated = int(T.covered(np.isin(windows, twice), WINDOW, n).sum())
    return n, len(text) - spaces, symbols, dups, repeated


class LineField:
    """A linear-chain conditional random field of two states; state 1 is content."""

    def __init__(self, emit: np.ndarray, move: np.ndarray):
        self.emit, self.move = emit, move

    @classmethod
    def fit(cls, texts: list[np.ndarray], labels: list[np.ndarray], steps: int = STEPS) -> LineField:
        """Gradient ascent on the penalised conditional likelihood of the lines' labels, all sequences side by side."""
        longest = max(map(len, texts))
        x = np.zeros((len(texts), longest, LINE_FEATURES), np.float32)
        on = np.zeros((len(texts), longest), bool)
        for k, t in enumerate(texts):
            x[k, : len(t)] = t
            on[k, : len(t)] = True
        y = np.zeros((len(texts), longest), int)
        for k, t in enumerate(labels):
            y[k, : len(t)] = t
        gold = np.eye(2, dtype=np.float32)[y] * on[..., None]
        pairs = on[:, 1:] & on[:, :-1]
        gold_move = np.zeros((2, 2))
        np.add.at(gold_move, (y[:, :-1][pairs], y[:, 1:][pairs]), 1)
        gold_emit = np.einsum("nlf,nls->sf", x, gold)
        emit, move = np.zeros((2, LINE_FEATURES)), np.zeros((2, 2))
        memory = [np.zeros_like(emit), np.zeros_like(move)]
        total = on.sum()
        for _ in range(steps):
            score = x @ emit.T.astype(np.float32)
            alpha, beta = np.zeros(score.shape), np.zeros(score.shape)
            alpha[:, 0] = score[:, 0]
            for k in range(1, longest):
                step = np.logaddexp.reduce(alpha[:, k - 1, :, None] + move, axis=1) + score[:, k]
                alpha[:, k] = np.where(on[:, k, None], step, alpha[:, k - 1])
            for k in range(longest - 2, -1, -1):
                step = np.logaddexp.reduce(move + (score[:, k + 1] + beta[:, k + 1])[:, None, :], axis=2)
                beta[:, k] = np.where(on[:, k + 1, None], step, 0)
            z = np.logaddexp.reduce(alpha[:, -1], axis=1)
            state = np.exp(alpha + beta - z[:, None, None]) * on[..., None]
            both = np.exp(alpha[:, :-1, :, None] + move + (score[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None]) * pairs[..., None, None]
            for part, grad, kept in ((emit, gold_emit - np.einsum("nlf,nls->sf", x, state), memory[0]), (move, gold_move - both.sum(axis=(0, 1)), memory[1])):
                grad = grad / total - 1e-4 * part
                kept += grad * grad
                part += 0.3 * grad / (np.sqrt(kept) + 1e-8)
        return cls(emit, move)

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The best sequence of states, by Viterbi."""
        score = x @ self.emit.T
        back = np.zeros((len(x), 2), np.int8)
        s0, s1 = score[0]
        (m00, m01), (m10, m11) = self.move.tolist()
        for k in range(1, len(x)):
            a0, b0, a1, b1 = s0 + m00, s1 + m10, s0 + m01, s1 + m11
            back[k] = b0 > a0, b1 > a1
            s0, s1 = max(a0, b0) + score[k, 0], max(a1, b1) + score[k, 1]
        path = np.zeros(len(x), np.int8)
        path[-1] = s1 >= s0
        for k in range(len(x) - 1, 0, -1):
            path[k - 1] = back[k, path[k]]
        return path


def weak_labels(texts: list[np.ndarray], labels: list[int], against: float = AGAINST) -> list[np.ndarray]:
    """A label for every line, from its document's and its own features; blank lines go with the line before."""
    seen = np.zeros((2, LINE_FEATURES))
    lines = np.zeros(2)
    for x, y in zip(texts, labels):
        full = x[:, 1:].any(axis=1)
        # a document counts once, however long
        seen[y] += x[full].sum(axis=0) / max(1, full.sum())
        lines[y] += full.any()
    share = (seen + 0.5) / (lines[:, None] + 1)
    on, off = np.log(share[1] / share[0]), np.log((1 - np.minimum(share[1], 0.999)) / (1 - np.minimum(share[0], 0.999)))
    out = []
    for x, y in zip(texts, labels):
        odds = (x[:, 1:] * on[1:] + (1 - x[:, 1:]) * off[1:]).sum(axis=1)
        own = np.where(odds > against, 1, np.where(odds < -against, 0, y))
        blank = ~x[:, 1:].any(axis=1)
        for k in np.flatnonzero(blank):
            own[k] = own[k - 1] if k else y
        out.append(own)
    return out


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [document_lines(t.as_py() or "")[0][:TRAIN_LINES].astype("<f4").tobytes() for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality").cast(pa.int64()), pa.array(rows, pa.binary())], names=["doc_id", "quality", "lines"])


def fit_field(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> LineField | None:
    """Collects the bounded training sample only: ``train_docs`` documents of each class."""
    marked = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"))
    place = F.xxhash64(F.lit(10), "doc_id")
    chosen = [marked.where(F.col("quality") == q).orderBy(place, "doc_id").limit(train_docs) for q in (0, 1)]
    sample = chosen[0].unionByName(chosen[1])
    got = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(F.broadcast(sample), "doc_id")
        .select("doc_id", "quality", "text")
        .mapInArrow(_features, "doc_id long, quality long, lines binary")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.min("lines").alias("lines"))
        .toPandas()
    )
    if got["quality"].nunique() < 2:
        return None
    got = got.sort_values(["quality", "lines"])
    texts = [np.frombuffer(x, "<f4").reshape(-1, LINE_FEATURES) for x in got["lines"]]
    return LineField.fit(texts, weak_labels(texts, got["quality"].tolist()))


SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double"


def quality_rules(docs: DataFrame, field: LineField | None, share: float = SHARE) -> DataFrame:
    """Base statistics and verdicts, in one map over the texts."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                text = text.as_py() or ""
                n, chars, symbols, dups, repeated = base_statistics(text)
                failed = n < MIN_WORDS or 100 * repeated > MAX_REPEATED * n
                content = 1.0
                if field is not None and n:
                    features, sizes = document_lines(text)
                    content = float(sizes[field.decode(features) == 1].sum() / max(1, sizes.sum()))
                rows.append((n, chars, symbols, dups, repeated, failed, not failed and content >= share, content))
            columns = list(zip(*rows)) if rows else [()] * 8
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()]
            names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, columns, kinds)], names=["doc_id", *names])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(judge, SCHEMA)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality_rules(docs, fit_field(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
