"""Quality rules: gradient-boosted trees over document statistics (operator 4).

The trees are grown in numpy on a sample of labelled documents bounded by ``SAMPLE`` rows (the
ones first in the order of the id's hash, so the sample does not depend on partitioning), with
monotonic constraints on the features in ``FALLING``: more symbols, repetition, capitals or
exclamation marks never raise a score. The forest is flattened into node arrays; every
document is scored against them a batch at a time, all trees at once.

A document is kept if it passes the base rules (50 words at least; at most half of its words
in repeated 3-word windows) and its score is ``KEEP`` or more. Without labels of both classes
there is no forest and the base rules alone decide. Null and empty texts have no words and fail.
Labels given several times for an id are averaged; null ids and labels are ignored. Repeated
rows each give a row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import common
from ledgerlake.llm.doc_stats import BASE, FEATURES, batch_stats

SAMPLE, KEEP = 20_000, 0.5
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
FALLING = ("symbol_share", "dup_line_share", "repeat_share", "upper_share", "exclaim_share", "bar_share", "echo_share")
TREES, DEPTH, RATE, BINS, L2, MIN_ROWS = 60, 4, 0.2, 64, 1.0, 5


@dataclass(frozen=True)
class Forest:
    """All trees' nodes in common arrays. A leaf points to itself."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of the class 1 for every row of ``x``."""
        node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            low = x[rows, self.feature[node]] <= self.threshold[node]
            node = np.where(low, self.left[node], self.right[node])
        return 1 / (1 + np.exp(-(self.base + self.value[node].sum(axis=1))))


def _best_split(hist: np.ndarray, sign: np.ndarray, low: float, high: float):
    """The split (feature, bin, left and right weight) of the largest gain that keeps to ``sign``; None if no gain."""
    below = hist.cumsum(axis=1)[:, :-1]
    total = hist.sum(axis=1)[:, None]
    above = total - below
    weight = [np.clip(-s[..., 0] / (s[..., 1] + L2), low, high) for s in (below, above)]
    gain = sum(-(s[..., 0] * w + 0.5 * (s[..., 1] + L2) * w * w) for s, w in zip((below, above), weight))
    g, h = total[0, 0, 0], total[0, 0, 1]
    own = np.clip(-g / (h + L2), low, high)
    gain = gain + (g * own + 0.5 * (h + L2) * own * own)
    ok = (below[..., 2] >= MIN_ROWS) & (above[..., 2] >= MIN_ROWS) & (sign[:, None] * (weight[1] - weight[0]) >= 0)
    gain = np.where(ok, gain, -1.0)
    f, b = np.unravel_index(int(gain.argmax()), gain.shape)
    return (int(f), int(b), float(weight[0][f, b]), float(weight[1][f, b])) if gain[f, b] > 1e-6 else None


def grow(x: np.ndarray, y: np.ndarray, sign: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Forest | None:
    """Boosted trees for the logistic loss on histograms; ``sign`` is -1, 0 or 1 for each feature."""
    if not len(y) or y.min() >= 0.5 or y.max() < 0.5:
        return None
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], axis=1)  # bin b: c <= edges[b]
    p = y.mean()
    base = float(np.log(p / (1 - p)))
    margin = np.full(len(y), base)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    flat = binned + np.arange(x.shape[1]) * BINS

    def node() -> int:
        at = len(feature)
        for a, v in ((feature, 0), (threshold, 0.0), (left, at), (right, at), (value, 0.0)):
            a.append(v)
        return at

    for _ in range(trees):
        prob = 1 / (1 + np.exp(-margin))
        grads = np.stack([prob - y, prob * (1 - prob), np.ones(len(y))], axis=1)
        roots.append(node())
        todo = [(roots[-1], np.arange(len(y)), 0, -np.inf, np.inf)]
        while todo:
            at, rows, level, low, high = todo.pop()
            g, h, _ = grads[rows].sum(axis=0)
            own = float(np.clip(-g / (h + L2), low, high))
            split = None
            if level < depth and len(rows) >= 2 * MIN_ROWS:
                where = flat[rows].ravel()
                hist = np.stack(
                    [np.bincount(where, np.repeat(grads[rows, k], x.shape[1]), x.shape[1] * BINS) for k in range(3)],
                    axis=1,
                ).reshape(x.shape[1], BINS, 3)
                split = _best_split(hist, sign, low, high)
            if split is None or split[1] >= len(edges[split[0]]):
                value[at] = RATE * own
                margin[rows] += value[at]
                continue
            f, b, wl, wr = split
            feature[at], threshold[at] = f, float(edges[f][b])
            left[at], right[at] = node(), node()
            down = binned[rows, f] <= b
            mid = (wl + wr) / 2
            (ll, lh), (rl, rh) = (low, high), (low, high)
            if sign[f] > 0:
                lh, rl = mid, mid
            elif sign[f] < 0:
                ll, rh = mid, mid
            todo += [(left[at], rows[down], level + 1, ll, lh), (right[at], rows[~down], level + 1, rl, rh)]
    ints = [np.array(a, np.int32) for a in (roots, feature, left, right)]
    return Forest(ints[0], ints[1], np.array(threshold), ints[2], ints[3], np.array(value), base, depth)


def label_means(labels: DataFrame, target: str) -> DataFrame:
    """One row ``doc_id, y`` for each labelled id."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull())
    return known.groupBy("doc_id").agg(F.avg(target).alias("y"))


@common.worker("quality")
def _features(batches):
    for batch in batches:
        _, x = batch_stats(batch)
        flat = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column("y"), batch.column("h"), flat], ["y", "h", "x"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Forest | None:
    """Grow the forest on at most ``sample`` labelled documents."""
    common.prepare_workers(docs.sparkSession)
    ids = label_means(labels, "quality").withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("y", "h", "text")  # sample ids
    got = rows.mapInArrow(_features, "y double, h long, x array<double>").orderBy("h", "x").limit(sample).collect()
    x = np.array([r["x"] for r in got]).reshape(-1, len(FEATURES))
    sign = np.array([-1 if f in FALLING else 0 for f in FEATURES])
    return grow(x, np.array([r["y"] for r in got]), sign)


def verdicts(forest: Forest | None, base: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``base_failed``, ``score`` and ``kept`` for each row."""
    words, repeated = base[:, 0], base[:, 4]
    failed = (words < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * words)
    score = forest.score(x) if forest else np.ones(len(x))
    return failed, score, ~failed & (score >= KEEP)


def _judge(forest: Forest | None):
    @common.worker("quality")
    def run(batches):
        for batch in batches:
            base, x = batch_stats(batch)
            failed, score, kept = verdicts(forest, base, x)
            cols = [batch.column("doc_id"), *(pa.array(c) for c in base.T.copy())]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(failed), pa.array(kept), pa.array(score)],
                ["doc_id", *BASE, "base_failed", "kept", "score"],
            )

    return run


def judge(docs: DataFrame, forest: Forest | None) -> DataFrame:
    """The base numbers, ``base_failed``, ``kept`` and ``score`` of every document; a narrow pass."""
    common.prepare_workers(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    longs = ", ".join(f"{c} long" for c in BASE)
    schema = f"doc_id {kind}, {longs}, base_failed boolean, kept boolean, score double"
    return docs.select("doc_id", "text").mapInArrow(_judge(forest), schema)


def keep_good(docs: DataFrame, forest: Forest | None) -> DataFrame:
    """The rows of ``docs`` (all columns) that are kept."""
    common.prepare_workers(docs.sparkSession)

    @common.worker("quality")
    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(verdicts(forest, *batch_stats(batch))[2]))

    return docs.mapInArrow(run, docs.schema)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.load(spark, sf_dir, "documents")
    return judge(docs, train(docs, common.load(spark, sf_dir, "labels")))
