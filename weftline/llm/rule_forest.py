"""Quality rules: fixed base rules, and an isolation forest over the rule statistics.

The forest is grown on a bounded sample of labelled good rows (sample_rows), over the box that all labelled rows span,
so unlike documents are isolated by few random splits. The cut on the anomaly score comes from all labelled rows: a histogram of scores per
label gives the smallest cut at which at most lost of the good rows that pass the base rules would go.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, record, stored
from .textstats import FEATURES, features, statistics

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_ROWS = pa.schema([("doc_id", pa.int64()), *((k, pa.int64()) for k in BASE), ("x", pa.list_(pa.float64()))])
_SQL = "doc_id long, " + ", ".join(f"{k} long" for k in BASE) + ", x array<double>"
BINS = 2000
#: The statistics that rules are commonly stated on; the forest splits these alone.
SPLIT = [FEATURES.index(k) for k in ("upper", "digit", "symbol", "loud", "distinct", "repeat", "dup_lines", "word_len", "end_symbol", "end_loud")]


def _rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, bounds in chunks(batches):
        s = statistics(data, bounds)
        yield record(_ROWS)(rows.column("doc_id"), *(s[k].astype(np.int64) for k in BASE), features(s)[:, SPLIT].tolist())


def rule_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, and x, the statistics that the forest splits."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(_rules, _SQL).withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


class Forest:
    """Isolation trees as flat arrays: feature, split, left, right; leaves hold their depth with the usual correction."""

    def __init__(self, sample: np.ndarray, low: np.ndarray, high: np.ndarray, trees: int, leaf_rows: int, seed: int = 7):
        """Splits are drawn over the box that a node covers of [low, high], so that a region without sample rows is cut off early."""
        rng = np.random.default_rng(seed)
        limit = int(np.ceil(np.log2(max(leaf_rows, 2)))) + 4
        self.unit = self.expected(min(leaf_rows, len(sample)))
        self.trees = []
        for _ in range(trees):
            nodes: list[list[float]] = []
            self._grow(sample[rng.choice(len(sample), min(leaf_rows, len(sample)), replace=False)], low, high, 0, limit, nodes, rng)
            self.trees.append(np.array(nodes))

    @staticmethod
    def expected(n: float) -> float:
        """Mean path length of an unsuccessful search among n."""
        return 0.0 if n < 2 else 1.0 if n < 3 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n

    def _grow(self, x: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int, limit: int, nodes: list, rng) -> int:
        at = len(nodes)
        nodes.append([-1, depth + self.expected(len(x)), 0, 0])
        wide = np.flatnonzero(high > low) if len(x) > 1 and depth < limit else ()
        if len(wide):
            f = int(rng.choice(wide))
            split = rng.uniform(low[f], high[f])
            under = x[:, f] <= split
            below, above = high.copy(), low.copy()
            below[f] = above[f] = split
            nodes[at] = [f, split, self._grow(x[under], low, below, depth + 1, limit, nodes, rng), self._grow(x[~under], above, high, depth + 1, limit, nodes, rng)]
        return at

    def anomaly(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path length / expected one): near 1 for rows that few splits isolate."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for tree in self.trees:
            at = np.zeros(len(x), np.int64)
            while True:
                f = tree[at, 0].astype(np.int64)
                inner = f >= 0
                if not inner.any():
                    break
                low = x[rows, np.maximum(f, 0)] <= tree[at, 1]
                at = np.where(inner, np.where(low, tree[at, 2], tree[at, 3]).astype(np.int64), at)
            total += tree[at, 1]
        return 2.0 ** (-total / len(self.trees) / max(self.unit, 1e-9))


def grow(stats: DataFrame, labels: DataFrame, trees: int = 150, leaf_rows: int = 128, sample_rows: int = 12_800) -> Forest | None:
    """A forest on at most sample_rows labelled good rows, those with the least hash of doc_id; None without such rows.

    As many labelled rows of either kind span the box that is split.
    """
    marked = stats.where("not base_failed").join(labels.where("quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality")), "doc_id").select("doc_id", "quality", "x")
    rows = {r["quality"]: r["count"] for r in marked.groupBy("quality").count().collect()}  # 2 at most

    def take(quality: int) -> list:
        # An ordered limit alone lets every task send sample_rows rows: rows that cannot be among the least hashes go first.
        share = min(1.0, 1.25 * sample_rows / max(rows.get(quality, 0), 1))
        near = marked.where((F.col("quality") == quality) & (F.xxhash64("doc_id") <= F.lit(min(int((2 * share - 1) * 2**63), 2**63 - 1))))
        return [r["x"] for r in near.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows).collect()]

    good = np.array(take(1))
    if not len(good):
        return None
    every = np.concatenate([good, np.array(take(0)).reshape(-1, good.shape[1])])
    return Forest(good, every.min(axis=0), every.max(axis=0), trees, leaf_rows)


def _scored(stats: DataFrame, forest: Forest) -> DataFrame:
    names = ["doc_id", *BASE, "base_failed"]
    schema = pa.schema([*_ROWS][:-1] + [pa.field("base_failed", pa.bool_()), pa.field("anomaly", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield record(schema)(*(b.column(k) for k in names), forest.anomaly(np.asarray(b.column("x").to_pylist())))

    return stats.select(*names, "x").mapInArrow(run, ", ".join(["doc_id long", *(f"{k} long" for k in BASE), "base_failed boolean", "anomaly double"]))


def calibrate(scored: DataFrame, labels: DataFrame, lost: float = 0.005) -> float:
    """The least cut above which at most lost of the labelled good rows lie, and no larger than needed to part the labels; infinite where there is none."""
    seen = scored.where("not base_failed").join(labels.where("quality in (0, 1)").select("doc_id", "quality"), "doc_id")
    rows = seen.groupBy("quality", F.floor(F.col("anomaly") * BINS).cast("int").alias("bin")).count().collect()  # 2 x BINS at most
    good, bad = np.zeros(BINS + 1), np.zeros(BINS + 1)
    for r in rows:
        (good if r["quality"] == 1 else bad)[r["bin"]] += r["count"]
    if not good.sum():
        return float("inf")
    above_good, above_bad = np.cumsum(good[::-1])[::-1], np.cumsum(bad[::-1])[::-1]
    ok = np.flatnonzero(above_good <= lost * good.sum())
    if not len(ok):
        return float("inf")  # so few good rows that even the greatest score of all cuts off too many
    # Among the cuts that lose few good rows, the middle of the widest that catch the most bad ones.
    best = ok[above_bad[ok] == above_bad[ok].max()]
    return float(best[len(best) // 2] / BINS)


def apply_rules(docs: DataFrame, labels: DataFrame, lost: float = 0.005) -> DataFrame:
    """A row per row of docs (doc_id, text; other columns are ignored): doc_id, the base counts, base_failed, kept, anomaly.

    kept is false where the base rules fail, else whether the anomaly is below the calibrated cut (all, without labelled
    good rows). Null and empty texts have no words and fail; null ids are judged like any other; an empty table gives no rows.
    """
    stats = stored(rule_statistics(docs), "rule-stats")
    forest = grow(stats, labels)
    if forest is None:
        return stats.select("doc_id", *BASE, "base_failed", (~F.col("base_failed")).alias("kept"), F.lit(0.0).alias("anomaly"))
    scored = stored(_scored(stats, forest), "rule-scores")
    cut = calibrate(scored, labels, lost)
    return scored.select("doc_id", *BASE, "base_failed", (~F.col("base_failed") & (F.col("anomaly") < cut)).alias("kept"), "anomaly")
