"""Quality classifier: regularised quadratic discriminant over document statistics.

Each whole text gives a vector of transformed statistics (logarithms of sizes, square roots
of shares). Per class, counts, sums and products over the training rows give mean and
covariance; the covariance is shrunk towards the pooled diagonal by ``SHRINKAGE``. A
document's score is the posterior of label 1: the difference of Mahalanobis log densities,
from Cholesky factors computed once, plus the log ratio of the class sizes.

Training rows are all labelled rows (no sample), except those held out.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.shared import store

SHRINKAGE = 0.05
# Added to every variance of the scaled statistics, so a constant one cannot divide by zero.
FLOOR = 1e-3

_UPPER = re.compile(r"[^\W\d_a-zß-öø-ÿ]")
_DIGIT = re.compile(r"[0-9]+")
_LETTER = re.compile(r"[^\W\d_]+")
_ODD = re.compile(r"[^\w\s.,;:'\"()?-]+")
_PLAIN_WORD = re.compile(r"[(\"']?[^\W\d_]+(?:['-][^\W\d_]+)*[.,;:?!)\"']*\Z")
STATISTICS = 16


def statistics(text: str | None) -> list[float]:
    """``STATISTICS`` numbers that describe a text; all zero for an empty one."""
    text = text or ""
    words = text.split()
    if not words:
        return [0.0] * STATISTICS
    n, chars = len(words), sum(map(len, words))
    length = lambda pattern: sum(map(len, pattern.findall(text)))
    letters, counted = length(_LETTER), Counter(words)
    pairs = Counter(zip(words, words[1:]))
    lines = [x for x in text.split("\n") if x.strip()]
    shares = [
        length(_UPPER) / max(letters, 1),
        letters / chars,
        length(_DIGIT) / chars,
        length(_ODD) / chars,
        len(counted) / n,
        max(counted.values()) / n,
        len(pairs) / max(n - 1, 1),
        sum(a == b for a, b in zip(words, words[1:])) / n,
        1 - sum(map(bool, map(_PLAIN_WORD.match, words))) / n,
        sum(len(w) <= 3 for w in words) / n,
        1 - len(set(lines)) / len(lines),
        text.count("|") / chars,
        sum(w[-1] in ".!?" for w in words) / n,
    ]
    return [np.log1p(n), np.log(chars / n), np.log1p(chars / len(lines)), *np.sqrt(shares)]


def with_statistics(rows: DataFrame) -> DataFrame:
    """``doc_id`` and ``x``, the statistics of ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([list(map(float, statistics(x.as_py()))) for x in batch.column(1)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["doc_id", "x"])

    rows = rows.select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {rows.dtypes[0][1]}, x array<double>")


@dataclass
class Model:
    """Scaling, class means, inverse Cholesky factors and constants of the log densities."""

    center: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.center) / self.scale
        logs = [c - 0.5 * np.square((z - m) @ f.T).sum(axis=1) for m, f, c in zip(self.means, self.factors, self.constants)]
        return 1.0 / (1.0 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def moments(rows: DataFrame) -> dict[int, np.ndarray]:
    """Per class of ``y``: the sum of (1, x) times its transpose. One bounded table comes back."""
    size = STATISTICS + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            x = np.array(batch.column(1).to_pylist(), float).reshape(-1, STATISTICS)
            full = np.hstack([np.ones((len(x), 1)), x])
            for k in (0, 1):
                own = full[y == k]
                table = (own.T @ own).ravel()
                yield pa.RecordBatch.from_arrays([pa.array([k] * len(table), pa.int32()), pa.array(range(len(table)), pa.int32()), pa.array(table)], names=["y", "k", "v"])

    sums = rows.select("y", "x").mapInArrow(run, "y int, k int, v double").groupBy("y", "k").agg(F.sum("v").alias("v")).collect()
    found = {0: np.zeros(size * size), 1: np.zeros(size * size)}
    for r in sums:
        found[r["y"]][r["k"]] = r["v"]
    return {k: v.reshape(size, size) for k, v in found.items()}


def fitted(sums: dict[int, np.ndarray], shrinkage: float = SHRINKAGE) -> Model | float:
    """The model, or a constant score if a class has under two training rows."""
    counts = np.array([sums[0][0, 0], sums[1][0, 0]])
    if counts.min() < 2:
        return float((counts[1] + 1) / (counts.sum() + 2))
    both = sums[0] + sums[1]
    center = both[0, 1:] / both[0, 0]
    variance = np.diag(both)[1:] / both[0, 0] - center**2
    scale = np.sqrt(np.maximum(variance, 0)) + 1e-6
    means, spreads = [], []
    for k in (0, 1):
        mean = sums[k][0, 1:] / counts[k]
        spreads.append((sums[k][1:, 1:] / counts[k] - np.outer(mean, mean)) / np.outer(scale, scale))
        means.append((mean - center) / scale)
    pooled = np.diag(np.diag((counts[0] * spreads[0] + counts[1] * spreads[1]) / counts.sum()))
    factors, constants = [], []
    for k in (0, 1):
        lower = np.linalg.cholesky((1 - shrinkage) * spreads[k] + shrinkage * pooled + FLOOR * np.eye(STATISTICS))
        factors.append(np.linalg.inv(lower))
        constants.append(np.log(counts[k] / counts.sum()) - np.log(np.diag(lower)).sum())
    return Model(center, scale, np.array(means), np.array(factors), np.array(constants))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are never trained on; false without an id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(statistics: DataFrame, labels: DataFrame) -> DataFrame:
    """``y`` and ``x`` of labelled rows not held out; contradictory labels do not count."""
    sure = labels.where(~held_out()).groupBy("doc_id").agg(F.min("quality").alias("y"), F.max("quality").alias("other"))
    sure = sure.where("y = other AND y IN (0, 1)").select("doc_id", F.col("y").cast("int").alias("y"))
    return statistics.join(sure, "doc_id").select("y", "x")


def scored(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``score`` and ``predicted``.

    A null text counts as empty; repeated rows and null ids are scored each; other columns
    are ignored. Without training rows of both classes every score is the share of label 1.
    """
    rows = store(with_statistics(documents), "statistics")
    model = fitted(moments(training_rows(rows, labels)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(2).to_pylist(), float).reshape(-1, STATISTICS)
            score = np.full(len(x), model) if isinstance(model, float) else model.scores(x)
            arrays = [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.5).astype("int32"))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "held_out", "score", "predicted"])

    wide = rows.select("doc_id", held_out().alias("held_out"), "x")
    return wide.mapInArrow(run, f"doc_id {wide.dtypes[0][1]}, held_out boolean, score double, predicted int")


# Workers then need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
