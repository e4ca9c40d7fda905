"""Quality classifier: a regularised quadratic discriminant over transformed document statistics.

Spark adds up count, sums and outer products of each class over all labelled rows outside the held-out fold. The driver
turns these few numbers into class means and covariances, shrinks each covariance towards a scaled identity by the
oracle-approximating weight, and keeps the Cholesky factors. A score is the sigmoid of the difference of the two
Mahalanobis log-densities (with priors), divided by the number of features so that it doesn't saturate.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, record, stored
from .textstats import FEATURES, features, statistics

_ROWS = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float64()))])


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, bounds in chunks(batches):
        yield record(_ROWS)(rows.column("doc_id"), features(statistics(data, bounds)).tolist())


def document_features(docs: DataFrame) -> DataFrame:
    """doc_id and x, the statistics of each whole text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_featurise, "doc_id long, x array<double>")


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


@dataclass
class Model:
    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    factors: np.ndarray  # Cholesky factors of the shrunk covariances, by class
    bias: np.ndarray  # log prior minus half the log determinant, by class

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.centre) / self.scale
        logs = []
        for mean, factor, bias in zip(self.means, self.factors, self.bias):
            y = np.linalg.solve(factor, (z - mean).T)
            logs.append(bias - 0.5 * (y * y).sum(axis=0))
        return 1 / (1 + np.exp(np.clip((logs[0] - logs[1]) / z.shape[1], -500, 500)))


def shrunk(cov: np.ndarray, n: float) -> np.ndarray:
    """Oracle-approximating shrinkage towards mean variance times identity."""
    p = len(cov)
    trace, square = np.trace(cov), (cov * cov).sum()
    denominator = (n + 1 - 2 / p) * (square - trace**2 / p)
    rho = 1.0 if denominator <= 0 else min(1.0, ((1 - 2 / p) * square + trace**2) / denominator)
    return (1 - rho) * cov + (rho * trace / p + 1e-6) * np.eye(p)


def fit(feats: DataFrame, labels: DataFrame, label: str = "quality") -> Model | None:
    """Fits on every labelled row (doc_id, label of 0 or 1; null labels and ids don't count) outside the held-out fold.

    None if a class has fewer than two rows: no covariance can be told from these.
    """
    d = len(FEATURES)
    rows = feats.join(labels.where(F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("y")), "doc_id").where(~held_out())

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + d + d * d))
        for b in batches:
            if b.num_rows:
                x = np.asarray(b.column("x").to_pylist())
                y = b.column("y").to_numpy()
                for k in (0, 1):
                    own = x[y == k]
                    total[k] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        yield pa.RecordBatch.from_pydict({"y": pa.array(np.repeat([0, 1], total.shape[1]), pa.int32()), "i": pa.array(np.tile(np.arange(total.shape[1]), 2), pa.int32()), "v": pa.array(total.ravel())})

    # 2 x (1 + d + d * d) rows, whatever the input.
    sums = rows.select("x", "y").mapInArrow(moments, "y int, i int, v double").groupBy("y", "i").agg(F.sum("v").alias("v")).collect()
    total = np.zeros((2, 1 + d + d * d))
    for r in sums:
        total[r["y"], r["i"]] = r["v"]
    n, first, second = total[:, 0], total[:, 1 : 1 + d], total[:, 1 + d :].reshape(2, d, d)
    if n.min() < 2:
        return None
    centre = first.sum(axis=0) / n.sum()
    scale = np.sqrt(np.maximum(np.diagonal(second.sum(axis=0)) / n.sum() - centre**2, 1e-8))
    means, factors, bias = [], [], []
    for k in (0, 1):
        mean = first[k] / n[k]
        cov = (second[k] / n[k] - np.outer(mean, mean)) * (n[k] / (n[k] - 1)) / np.outer(scale, scale)
        factor = np.linalg.cholesky(shrunk(cov, n[k]))
        means.append((mean - centre) / scale)
        factors.append(factor)
        bias.append(np.log(n[k] / n.sum()) - np.log(np.diagonal(factor)).sum())
    return Model(centre, scale, np.array(means), np.array(factors), np.array(bias))


def score(feats: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of each row."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield record(schema)(b.column("doc_id"), model.score(np.asarray(b.column("x").to_pylist())))

    return feats.mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per row of docs (doc_id, text; other columns are ignored): doc_id, held_out, score, predicted.

    Null and empty texts are scored by their (empty) statistics; rows with a null doc_id are scored and not held out;
    repeated rows get equal scores; an empty docs gives no rows. Without two labelled rows of each class outside the
    held-out fold (an empty labels table too) nothing is known: every score is 0.5, and nothing is rejected.
    """
    feats = stored(document_features(docs), "quality-features")
    model = fit(feats, labels)
    scored = feats.select("doc_id", F.lit(0.5).alias("score")) if model is None else score(feats, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rows that the model rejects; columns stay, rows with a null doc_id are kept."""
    bad = classify(docs, labels).where("predicted = 0 and doc_id is not null").select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(docs.columns)
