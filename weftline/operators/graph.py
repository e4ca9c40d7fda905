"""Graph operators on edge tables: connected components and neighbourhood closure."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.plans.storage import discard, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Links each node's larger neighbours to its least neighbour (or itself). Edges have a > b.

    The join has all edges of a node on one side and one row of it on the other: Spark splits it where a node's edges are
    more than a task should hold (adaptive skew joins). Salts of our own would double the stages of every round.
    """
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return edges.join(least.withColumnRenamed("a", "b"), "b").select("a", F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links each node and its smaller neighbours to the least of them. Edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    out = joined.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.union(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    """Count and checksum of an edge table."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


#: So many edges are finished in one task, whatever the input; more go through rounds over all tasks until no more are left.
FEW_EDGES = 1_000_000


def least_roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of n nodes the least node that the edges a, b reach. Each round joins every root beside a smaller one to it."""
    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(above := root[root], root):
            root = above


def _rooted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row (a, b) per node that isn't the least of its component, b being the least."""
    held = [x for x in batches if x.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    both = pa.chunked_array([*table.column("a").chunks, *table.column("b").chunks])
    nodes = both.unique()
    nodes = nodes.take(pc.sort_indices(nodes))
    at = pc.index_in(both, nodes).to_numpy()
    root = least_roots(at[: table.num_rows], at[table.num_rows :], len(nodes))
    below = np.flatnonzero(root != np.arange(len(root)))
    for i in range(0, len(below), 100_000):
        own = below[i : i + 100_000]
        yield pa.RecordBatch.from_arrays([nodes.take(pa.array(own)), nodes.take(pa.array(root[own]))], names=["a", "b"])


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """node, component (least node reachable) for every node of an edge.

    edges: columns a, b of one orderable type; null ends and loops are dropped. Rounds are written to the shared folder; a
    checksum of all edges tells when nothing changes. Each round that changes something lowers a node's link, so it ends,
    in about log2 of the longest path rounds. Rounds end early where FEW_EDGES are left: one task links these, as rounds of
    small jobs cost the driver more than the edges.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = stored(now, name)
    seen = _mark(now)
    while seen[0]:
        last = now
        if seen[0] <= FEW_EDGES:
            now = stored(now.coalesce(1).mapInArrow(_rooted, now.schema), name)
            discard(last)
            break
        now = stored(_small_star(_large_star(now)), name)
        discard(last)
        mark = _mark(now)
        if mark == seen:
            break
        seen = mark
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()


def closure(edges: DataFrame, seeds: DataFrame, blocked: DataFrame | None = None) -> DataFrame:
    """node, round: nodes reached from seeds (node) over undirected edges (a, b), and the round they were first reached in.

    Blocked nodes are never entered. A breadth-first search whose frontier is an equi-join per round; it ends when a round
    reaches nothing new.
    """
    both = stored(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "closure-edges")
    seen = seeds.select("node").distinct()
    if blocked is not None:
        seen = seen.join(blocked.select("node"), "node", "left_anti")
    frontier = stored(seen.withColumn("round", F.lit(0)), "closure")
    seen = frontier
    for k in count(1):
        reached = frontier.join(both, F.col("node") == F.col("a")).select(F.col("b").alias("node")).distinct().join(seen.select("node"), "node", "left_anti")
        if blocked is not None:
            reached = reached.join(blocked.select("node"), "node", "left_anti")
        frontier = stored(reached.withColumn("round", F.lit(k)), "closure")
        if frontier.isEmpty():
            return seen
        seen = seen.union(frontier)
