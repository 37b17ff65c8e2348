"""Quality classifier (operator 9): random Fourier features, ridge scores, isotonic calibration.

Document statistics are standardised and sent through random Fourier features,
which approximate a Gaussian kernel between documents.  Every partition sums
its own normal equations; the sums meet by feature row, so no task or driver
holds more than the fixed-size system.  Ridge scores are calibrated by pooling
adjacent violators over score bins of the training rows.

Training rows are those of ``labels.quality`` whose id's checksum is not 0
modulo 5, at most ``TRAIN_ROWS`` of them (the first by hashed id; an id that
repeats trains with one of its rows, two labels of an id count as the larger).
Only the text enters a score.  Null and empty texts have all-zero statistics and get the
score of such a text; labels without both classes give everyone their mean.
Repeated rows are scored alike.  Extra columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import discard, documents, materialize
from .textstats import DOC_FEATURES, doc_features

COMPONENTS = 300
WIDTH = 0.12
RIDGE = 1e-3
TRAIN_ROWS = 40_000
FOLDS, THRESHOLD = 5, 0.3
BINS = 200
SEED = 20240905


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


class QualityModel:
    """score(statistics): standardise, project, weigh, calibrate."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, components: int = COMPONENTS, width: float = WIDTH):
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = mean, scale
        self.directions = rng.normal(0, width, (len(mean), components))
        self.phases = rng.uniform(0, 2 * np.pi, components)
        self.weights = np.zeros(components + 1)
        self.steps = (np.array([0.0]), np.array([0.5]))

    def project(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack([np.sqrt(2 / len(self.phases)) * np.cos(z @ self.directions + self.phases), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.project(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Linear between the pooled steps, so that order within a step is kept."""
        return np.interp(self.raw(x), *self.steps)


def pool(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression by pooling adjacent violators; (centres, values), both increasing."""
    blocks: list[list[float]] = []
    for a, b, c in zip(x, y, w):
        blocks.append([a * c, b * c, c])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            top = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], top)]
    centre = np.array([a / c for a, _, c in blocks])
    return centre, np.array([(b + 0.02) / (c + 0.04) for _, b, c in blocks])


def _statistics(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [doc_features(t.as_py()).astype("<f8").tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(rows, pa.binary())], names=[*names, "statistics"])

    return run


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, DOC_FEATURES)


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> QualityModel:
    marked = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("quality").cast("double")).alias("quality"))
    marked = marked.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64(F.lit(9), "doc_id"), "doc_id").limit(train_rows)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # the sample is bounded by ``train_rows`` ids, 16 bytes each
    described = source.join(F.broadcast(marked), "doc_id").select("doc_id", "quality", "text").mapInArrow(_statistics(["doc_id", "quality"]), "doc_id long, quality double, statistics binary")
    rows = materialize(described.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("statistics").alias("statistics")).drop("doc_id"), "quality-rows")

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, one, two, y = 0, np.zeros(DOC_FEATURES), np.zeros(DOC_FEATURES), 0.0
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("statistics"))
                n, one, two, y = n + len(x), one + x.sum(0), two + (x * x).sum(0), y + float(np.sum(batch.column("quality").to_numpy(zero_copy_only=False)))
        yield pa.RecordBatch.from_pydict({"n": [float(n)], "y": [y], "one": [one.tolist()], "two": [two.tolist()]})

    sums = rows.mapInArrow(moments, "n double, y double, one array<double>, two array<double>")
    at = lambda c: [F.sum(F.element_at(c, k + 1)).alias(f"{c}{k}") for k in range(DOC_FEATURES)]
    got = sums.agg(F.sum("n").alias("n"), F.sum("y").alias("y"), *at("one"), *at("two")).first()
    n = got["n"] or 0.0
    mean = np.array([got[f"one{k}"] or 0.0 for k in range(DOC_FEATURES)]) / max(n, 1)
    scale = np.sqrt(np.maximum(np.array([got[f"two{k}"] or 0.0 for k in range(DOC_FEATURES)]) / max(n, 1) - mean**2, 0)) + 1e-3
    model = QualityModel(mean, scale)
    positive = got["y"] or 0.0
    if not 0 < positive < n:
        discard(rows)
        model.steps = (np.array([0.0]), np.array([positive / n if n else 0.5]))
        return model
    balance = (0.5 * n / (n - positive), 0.5 * n / positive)

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = np.zeros((COMPONENTS + 1, COMPONENTS + 2))
        for batch in batches:
            if batch.num_rows:
                y = batch.column("quality").to_numpy(zero_copy_only=False)
                p = model.project(_matrix(batch.column("statistics")))
                w = np.where(y > 0, balance[1], balance[0])[:, None]
                a += (p * w).T @ np.hstack([p, y[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array(range(COMPONENTS + 1), pa.int32()), pa.array(list(map(np.ndarray.tobytes, a)), pa.binary())], names=["i", "line"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, line in zip(batch.column("i").to_pylist(), batch.column("line").to_pylist()):
                total[i] = total.get(i, 0) + np.frombuffer(line)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["i", "line"])

    system = rows.mapInArrow(equations, "i int, line binary").repartition("i").mapInArrow(added, "i int, line binary").collect()
    a = np.vstack([np.frombuffer(r.line) for r in sorted(system, key=lambda r: r.i)])
    model.weights = np.linalg.solve(a[:, :-1] + RIDGE * n / COMPONENTS * np.eye(len(a)), a[:, -1])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.clip(model.raw(_matrix(batch.column("statistics"))), -0.5, 1.5) if batch.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([pa.array(((s + 0.5) * BINS / 2).astype(np.int32)), pa.array(s), batch.column("quality")], names=["bin", "s", "y"])

    bins = rows.mapInArrow(scored, "bin int, s double, y double").groupBy("bin").agg(F.avg("s").alias("s"), F.avg("y").alias("y"), F.count("*").alias("n")).toPandas().sort_values("s")
    discard(rows)
    model.steps = pool(bins["s"].to_numpy(), bins["y"].to_numpy(), bins["n"].to_numpy())
    return model


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, held_out, score, predicted), in one map over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([doc_features(t.as_py()) for t in batch.column("text")]).reshape(-1, DOC_FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], names=["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The rows of ``docs``, with all columns, that the classifier does not reject."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([doc_features(t.as_py()) for t in batch.column("text")]).reshape(-1, DOC_FEATURES)
            yield batch.filter(pa.array(model.score(x) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score_quality(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
