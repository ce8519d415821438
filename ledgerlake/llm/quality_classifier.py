"""Quality classifier: random Fourier features and isotonic calibration (operator 7).

``sqrt(2 / D) * cos(x W + b)`` with Gaussian ``W`` approximates a Gaussian kernel over the
standardised document statistics. Every partition sums its part of the normal equations over
all labelled documents; the sums are added by Spark and the ridge weights solved on the driver
from ``(D + 1)(D + 2) / 2`` numbers, whatever the corpus. Scores are calibrated by isotonic
regression (pool adjacent violators) over at most ``BINS`` score bins of a labelled fold that
the ridge fit has not seen.

Labels come from ids whose crc32 fold (of 5) is not 0: folds 1 to 3 fit the weights, fold 4
the calibration. Null and empty texts have zero statistics and get a score like any other.
Labels given several times for an id are averaged; without labels all scores are 0.5. Null ids
count as not held out. Repeated rows each give a row; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import common
from ledgerlake.llm.doc_stats import FEATURES, batch_stats
from ledgerlake.llm.quality_rules import label_means

FOLDS, CALIBRATION_FOLD = 5, 4
DIMENSION, WIDTH, RIDGE, BINS, SEED = 192, 2.5, 1.0, 1024, 7
CUT = 0.3


@dataclass(frozen=True)
class Kernel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    phase: np.ndarray

    @staticmethod
    def draw(mean: np.ndarray, scale: np.ndarray) -> Kernel:
        rng = np.random.default_rng(SEED)
        weights = rng.normal(size=(len(mean), DIMENSION)) / WIDTH
        return Kernel(mean, scale, weights, rng.uniform(0, 2 * np.pi, DIMENSION))

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        z = np.sqrt(2 / DIMENSION) * np.cos(z @ self.weights + self.phase)
        return np.hstack([z, np.ones((len(x), 1))])


@dataclass(frozen=True)
class Model:
    kernel: Kernel
    ridge: np.ndarray
    knots: tuple[np.ndarray, np.ndarray]

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.kernel.features(x) @ self.ridge

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated, and within a calibrated step still ordered by the raw score."""
        raw = self.raw(x)
        step = np.interp(raw, *self.knots)
        return np.clip(0.999 * step + 0.001 / (1 + np.exp(-4 * (raw - 0.5))), 0, 1)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(-1, len(FEATURES))


@common.worker("quality")
def _measure(batches):
    for batch in batches:
        _, x = batch_stats(batch)
        flat = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), flat], ["doc_id", "x"])


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id, x``: the features of every document, written once (a few numbers a document)."""
    common.prepare_workers(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return common.saved(docs.select("doc_id", "text").mapInArrow(_measure, f"doc_id {kind}, x array<double>"), "stats")


def _normal_equations(kernel: Kernel):
    upper = np.triu_indices(DIMENSION + 2)

    @common.worker("quality")
    def run(batches):
        total = np.zeros((DIMENSION + 2, DIMENSION + 2))
        for batch in batches:
            z = np.hstack([kernel.features(_matrix(batch)), batch.column("y").to_numpy()[:, None]])
            total += z.T @ z
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(upper[0]))), pa.array(total[upper])], ["k", "v"])

    return run


def _binned(model: Model):
    @common.worker("quality")
    def run(batches):
        for batch in batches:
            at = np.clip(np.floor((model.raw(_matrix(batch)) + 0.5) / 2 * BINS), 0, BINS - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("y")], ["bin", "y"])

    return run


def pool_adjacent(means: list[float], weights: list[float]) -> list[float]:
    """The non-decreasing sequence nearest to ``means`` in weighted squares."""
    blocks: list[list[float]] = []
    for m, w in zip(means, weights):
        blocks.append([m, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m2, w2, n2 = blocks.pop()
            m1, w1, n1 = blocks.pop()
            blocks.append([(m1 * w1 + m2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return [m for m, _, n in blocks for _ in range(int(n))]


def fit(stats: DataFrame, labels: DataFrame) -> Model | None:
    """Fit on ``measured()`` rows and ``labels`` (``doc_id, quality``)."""
    known = label_means(labels, "quality").withColumn("fold", common.fold(F.col("doc_id"), FOLDS)).where("fold <> 0")
    rows = common.saved(stats.join(known, "doc_id").select("x", "y", "fold"), "labelled")
    train, calibrate = (rows.where(F.col("fold") != CALIBRATION_FOLD), rows.where(F.col("fold") == CALIBRATION_FOLD))
    cols = [F.col("x")[i] for i in range(len(FEATURES))]
    m = train.agg(*(F.avg(c) for c in cols), *(F.stddev_pop(c) for c in cols)).first()
    if m[0] is None:
        return None
    moments = np.array(m, float).reshape(2, -1)
    kernel = Kernel.draw(moments[0], np.maximum(moments[1], 1e-6))
    sums = train.mapInArrow(_normal_equations(kernel), "k long, v double").groupBy("k").agg(F.sum("v").alias("v"))
    square = np.zeros((DIMENSION + 2, DIMENSION + 2))
    i, j = np.triu_indices(DIMENSION + 2)
    for k, v in sums.collect():  # (D + 2)(D + 3) / 2 rows
        square[i[k], j[k]] = square[j[k], i[k]] = v
    gram = square[:-1, :-1] + RIDGE * np.diag([1.0] * DIMENSION + [1e-6])
    model = Model(kernel, np.linalg.solve(gram, square[:-1, -1]), (np.array([0.0, 1.0]), np.array([0.0, 1.0])))
    bins = calibrate.mapInArrow(_binned(model), "bin long, y double").groupBy("bin")
    got = sorted(bins.agg(F.avg("y"), F.count("y")).collect())  # at most BINS rows
    if not got:
        return model
    centres = np.array([(b + 0.5) / BINS * 2 - 0.5 for b, _, _ in got])
    steps = np.array(pool_adjacent([m for _, m, _ in got], [float(c) for _, _, c in got]))
    return Model(kernel, model.ridge, (centres, steps))


def _scored(model: Model | None):
    @common.worker("quality")
    def run(batches):
        for batch in batches:
            x = _matrix(batch)
            score = model.score(x) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    return run


def score(stats: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for ``measured()`` rows."""
    kind = stats.schema["doc_id"].dataType.simpleString()
    got = stats.mapInArrow(_scored(model), f"doc_id {kind}, score double")
    held = F.coalesce(common.fold(F.col("doc_id"), FOLDS) == 0, F.lit(False))
    return got.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs`` (all columns) that the classifier predicts as class 1."""
    common.prepare_workers(docs.sparkSession)

    @common.worker("quality")
    def run(batches):
        for batch in batches:
            _, x = batch_stats(batch)
            yield batch.filter(pa.array(model.score(x) >= CUT if model else np.ones(len(x), bool)))

    return docs.mapInArrow(run, docs.schema)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = measured(common.load(spark, sf_dir, "documents"))
    return score(stats, fit(stats, common.load(spark, sf_dir, "labels")))
