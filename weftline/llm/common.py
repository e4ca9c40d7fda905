"""Helpers that the operators of this subpackage share.

Texts are handled as UTF-8 bytes in Arrow batches. A batch is cut into chunks of whole rows of a few MB, and each chunk
is tokenised and hashed by numpy over all its rows at once, so memory is bounded by the longest single text.
Null texts count as empty everywhere.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.parts import distinct, mix  # noqa: F401  for the operators
from weftline.plans.storage import shared_dir, stored  # noqa: F401  for the operators

CHUNK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
_powers: dict[int, np.ndarray] = {}


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2**64; kept between calls."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        size = max(CHUNK + 8, 1 << int(n).bit_length())
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = _powers[int(base)] = np.multiply.accumulate(have)
    return have[:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Prefix sums of the polynomial hash: entry i covers data[:i]."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data)), out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end], equal for equal bytes wherever they stand."""
    return (prefix[end] - prefix[start]) * powers(len(prefix), _INV)[start]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and the rows' bounds in them; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None and bounds[-1] > bounds[0] else np.zeros(0, np.uint8)
    return raw, bounds - bounds[0]


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of whole rows with about limit bytes of text (one row at least), as (rows, bytes, bounds)."""
    for batch in batches:
        data, bounds = text_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at), data[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at]
            at = to


class Words:
    """Words ([^\\x20\\x09-\\x0D]+, A-Z lower-cased for the hash) of a chunk: start, end, hash, and first[i], the index of row i's first word."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, hashed: bool = True):
        solid = ~SPACE[data]
        begins, ends = solid.copy(), solid.copy()
        begins[1:] &= ~solid[:-1]
        ends[:-1] &= ~solid[1:]
        inner = bounds[(bounds > 0) & (bounds < len(data))]
        begins[inner] = solid[inner]
        ends[inner - 1] = solid[inner - 1]
        self.solid = solid
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, bounds)
        if hashed:
            self.hash = mix(span_hashes(prefix_hashes(LOWER[data]), self.start, self.end))


def shingle_sets(data: np.ndarray, bounds: np.ndarray, width: int) -> list[np.ndarray]:
    """For each row its sorted distinct shingle hashes of width words; with fewer words the whole sequence is one; none without words."""
    w = Words(data, bounds)
    h, first = w.hash, w.first
    out: list[np.ndarray] = []
    if len(h) >= width:
        rolled = h[: len(h) - width + 1].copy()
        for k in range(1, width):
            rolled = mix(rolled * np.uint64(0xD6E8FEB86659FD93) + h[k : len(h) - width + 1 + k])
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= width:
            out.append(distinct(rolled[a : b - width + 1]))
        elif b > a:
            one = np.array([b - a], np.uint64)
            for x in h[a:b]:
                one = mix(one * np.uint64(0xA0761D6478BD642F) + x)
            out.append(one)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def as_long(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of rows with equal keys from batches sorted by key, one table each."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if held and keys[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = keys[a]
    if held:
        yield pa.Table.from_batches(held)


def dealt(df: DataFrame, bucket: str, n: int) -> DataFrame:
    """Rows of bucket b go to partition b of n."""
    return df.repartitionById(n, F.col(bucket).cast("int"))


def record(schema: pa.Schema) -> Callable[..., pa.RecordBatch]:
    return lambda *columns: pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
