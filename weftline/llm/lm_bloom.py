"""Language-model scoring with a log-frequency Bloom filter.

Counting: every task adds up its unigrams and bigrams as sorted arrays of hashes and counts, cut into buckets by hash, so
a key reaches its bucket once per task however frequent it is. A bucket adds these up exactly. For each n-gram of count c
the entries 1 .. 1 + floor(log2 c) go into the bucket's segment of the filter, whose size follows its number of entries.

Scoring: the segments are broadcast, max_filter_bytes of them at once: a filter beyond that is probed in several passes,
which hand on the levels found for each token, so the scores don't depend on it. A count is read by probing entry after entry until one is missing; bigram and
unigram counts read this way give an interpolated probability. The exact base score takes the most frequent words from a
broadcast table of at most head_words rows, and joins all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, chunks, dealt, mix, partitions, record, stored

END = np.uint64(0x5851F42D4C957F2D)
_PAIR, _LEVEL = np.uint64(0xD1B54A32D192ED03), np.uint64(0x8CB92BA72F3D8DD7)
_COUNTS = pa.schema([("bucket", pa.int32()), ("order", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
_MADE = pa.schema([("kind", pa.string()), ("bucket", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("n", pa.int64()), ("total", pa.int64())])
_MADE_SQL = "kind string, bucket int, a binary, b binary, n long, total long"


def tokens(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all rows, each row followed by END, and the rows' bounds. The token before a row's first is END too."""
    w = Words(data, bounds)
    rows = len(bounds) - 1
    first = w.first + np.arange(rows + 1)
    out = np.empty(len(w.hash) + rows, np.uint64)
    ends = np.zeros(len(out), bool)
    ends[first[1:] - 1] = True
    out[ends], out[~ends] = END, w.hash
    return out, first


def bigrams(tok: np.ndarray) -> np.ndarray:
    return mix(np.concatenate([[END], tok[:-1]]) * _PAIR + tok)


def add_up(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts (1 each by default)."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.diff(np.append(first, len(keys))) if counts is None else np.add.reduceat(counts, first)


def _count(n: int, held_most: int = 3_000_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = record(_COUNTS)
        held: dict[int, list] = {1: [], 2: []}
        fresh: dict[int, list] = {1: [], 2: []}

        def merge():
            for order in (1, 2):
                if fresh[order]:
                    new = add_up(np.concatenate(fresh[order]))
                    held[order] = [add_up(*map(np.concatenate, zip(*held[order], new)))] if held[order] else [new]
                    fresh[order] = []

        def flush():
            for order in (1, 2):
                for keys, counts in held[order]:
                    cuts = np.searchsorted(keys >> np.uint64(32), (np.arange(n + 1, dtype=np.uint64) << np.uint64(32)) // np.uint64(n))
                    cuts[-1] = len(keys)
                    for b in range(n):
                        if cuts[b + 1] > cuts[b]:
                            yield make([b], [order], [keys[cuts[b] : cuts[b + 1]].tobytes()], [counts[cuts[b] : cuts[b + 1]].astype(np.uint32).tobytes()])
                held[order] = []

        waiting = 0
        for _, data, bounds in chunks(batches):
            tok, _ = tokens(data, bounds)
            fresh[1].append(tok)
            fresh[2].append(bigrams(tok))
            waiting += len(tok)
            if waiting > 1_500_000:
                merge()
                waiting = 0
                if len(held[2][0][0]) > held_most:
                    yield from flush()
        merge()
        yield from flush()

    return run


def levels(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log2 count)."""
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)


def _word_mask(h: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word number in a segment of so many 64-bit words, and the four bits of it, for entry hashes."""
    at = ((h >> np.uint64(32)) * words) >> np.uint64(32)
    one = np.uint64(1)
    mask = (one << (h & np.uint64(63))) | (one << ((h >> np.uint64(6)) & np.uint64(63))) | (one << ((h >> np.uint64(12)) & np.uint64(63))) | (one << ((h >> np.uint64(18)) & np.uint64(63)))
    return at, mask


def entry_hash(keys: np.ndarray, order: int, level) -> np.ndarray:
    return mix(keys + np.uint64(order) * _PAIR + np.asarray(level, np.uint64) * _LEVEL)


def _reduce(bits: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = record(_MADE)
        got: dict[tuple[int, int], list] = {}
        for batch in batches:
            for b, order, keys, counts in zip(batch.column("bucket").to_pylist(), batch.column("order").to_pylist(), batch.column("keys"), batch.column("counts")):
                got.setdefault((b, order), []).append((np.frombuffer(keys.as_buffer(), np.uint64), np.frombuffer(counts.as_buffer(), np.uint32).astype(np.int64)))
        for b in sorted({b for b, _ in got}):
            entries = []
            for order in (1, 2):
                parts = got.pop((b, order), None)
                if parts is None:
                    continue
                keys, counts = add_up(*map(np.concatenate, zip(*parts)))
                if order == 1:
                    yield make(["words"], [b], [keys.tobytes()], [counts.tobytes()], [len(keys)], [int(counts.sum())])
                top = levels(counts)
                for level in range(1, int(top.max()) + 1):
                    entries.append(entry_hash(keys[top >= level], order, level))
            size = sum(map(len, entries))
            segment = np.zeros(int(max(1, size * bits // 64)), np.uint64)
            for h in entries:
                at, mask = _word_mask(h, np.uint64(len(segment)))
                np.bitwise_or.at(segment, at.astype(np.int64), mask)
            yield make(["filter"], [b], [segment.tobytes()], [b""], [size], [len(segment)])

    return run


class Filter:
    """Quantised n-gram counts, read by probing; n-grams of buckets without a segment have level 0."""

    def __init__(self, segments: dict[int, bytes], n: int):
        self.n = n
        size = np.array([len(segments.get(b, b"")) // 8 for b in range(n)], np.int64)
        self.words = np.maximum(size, 1).astype(np.uint64)
        self.offset = np.concatenate([[0], np.cumsum(np.maximum(size, 1))[:-1]])
        self.data = np.frombuffer(b"".join(segments.get(b) or bytes(8) for b in range(n)), np.uint64)

    def level(self, keys: np.ndarray, order: int) -> np.ndarray:
        """The last entry found before one is missing; 0 if the first is."""
        bucket = (((keys >> np.uint64(32)) * np.uint64(self.n)) >> np.uint64(32)).astype(np.int64)
        level, here = np.zeros(len(keys), np.int64), np.arange(len(keys))
        for step in range(1, 64):
            at, mask = _word_mask(entry_hash(keys[here], order, step), self.words[bucket[here]])
            here = here[(self.data[self.offset[bucket[here]] + at.astype(np.int64)] & mask) == mask]
            if not len(here):
                break
            level[here] = step
        return level

    def count(self, keys: np.ndarray, order: int) -> np.ndarray:
        return middle(self.level(keys, order))


def middle(level: np.ndarray) -> np.ndarray:
    """The middle of the count range that a level stands for."""
    return np.where(level <= 1, level, 0.75 * 2.0**level)


_LEVELS = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("uni", pa.binary()), ("pair", pa.binary())])
_LEVELS_SQL = "doc_id long, text string, uni binary, pair binary"


def _levels(filt: Filter, rows: pa.RecordBatch, tok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Levels of all tokens and of the bigrams they end: those of filt and of the passes before, of which one at most is not 0."""
    words, which = np.unique(tok, return_inverse=True)
    out = [filt.level(words, 1)[which], filt.level(bigrams(tok), 2)]
    if "uni" in rows.schema.names:
        out = [x + np.frombuffer(b"".join(rows.column(c).to_pylist()), np.uint8) for x, c in zip(out, ("uni", "pair"))]
    return out[0], out[1]


def _pass(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filt: Filter = block.value
        for rows, data, bounds in chunks(batches):
            tok, first = tokens(data, bounds)
            found = [x.astype(np.uint8) for x in _levels(filt, rows, tok)]
            yield record(_LEVELS)(rows.column("doc_id"), rows.column("text"), *([x[a:b].tobytes() for a, b in zip(first[:-1], first[1:])] for x in found))

    return run


_SCORES = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_head", pa.int64()), ("head_sum", pa.float64()), ("score", pa.float64()), ("rare", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])


def _score(model, total: int, distinct: int, kappa: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = record(_SCORES)
        filt, head, head_count = model.value
        uid = TaskContext.get().partitionId() << 38
        floor = total + 0.5 * (distinct + 1)
        for rows, data, bounds in chunks(batches):
            tok, first = tokens(data, bounds)
            words, which = np.unique(tok, return_inverse=True)
            unigram, pair = map(middle, _levels(filt, rows, tok))
            before = np.concatenate([unigram[first[1] - 1 : first[1]], unigram[:-1]])
            pair = np.minimum(pair, np.minimum(before, unigram))
            weight = before / (before + kappa)
            p = weight * pair / np.maximum(before, 1) + (1 - weight) * (unigram + 0.5) / floor
            at = np.searchsorted(head, words) if len(head) else np.zeros(len(words), np.int64)
            at[at == len(head)] = 0
            known = (head[at] == words) if len(head) else np.zeros(len(words), bool)
            exact = np.where(known, np.log10((head_count[at] if len(head) else 0) + 0.5), 0.0)
            sums = lambda x: np.add.reduceat(x, first[:-1])  # noqa: E731  every row has a token
            rare, times = [], []
            other = ~known[which]
            for a, b in zip(first[:-1], first[1:]):
                k, c = add_up(tok[a:b][other[a:b]])
                rare.append(k.view(np.int64))
                times.append(c)
            yield make(np.arange(uid, uid + rows.num_rows), rows.column("doc_id"), np.diff(first), sums(known[which].astype(np.int64)), sums(exact[which]), sums(np.log10(p)), rare, times)
            uid += rows.num_rows

    return run


def lm_scores(docs: DataFrame, bits: float = 10, max_filter_bytes: int = 1 << 28, head_words: int = 1 << 18, kappa: float = 4.0) -> DataFrame:
    """A row per row of docs (doc_id, text; other columns are ignored): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows whose crc32(doc_id as text) mod 5 is not 1 (null ids included). base_score sums
    log10((c + 0.5) / (N + 0.5 (V + 1))) over a text's tokens by exact training counts; score sums the model's log10
    probabilities. Null and empty texts have the end token alone. Words are told apart by 64-bit hashes. An empty table
    gives no rows; without training rows all counts are 0. max_filter_bytes is what is held of the filter at once (a bucket's
    segment at least), not its size.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    counted = dealt(plain.where(~out).select("text").mapInArrow(_count(n), "bucket int, order int, keys binary, counts binary"), "bucket", n)
    made = stored(counted.mapInArrow(_reduce(bits), _MADE_SQL), "lm-counts")
    totals = made.where("kind = 'words'").agg(F.sum("total"), F.sum("n")).first()
    total, distinct = int(totals[0] or 0), int(totals[1] or 0)
    schema = pa.schema([("h", pa.int64()), ("c", pa.int64())])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch.column("a"), batch.column("b")):
                keys, counts = np.frombuffer(a.as_buffer(), np.int64), np.frombuffer(b.as_buffer(), np.int64)
                for at in range(0, len(keys), 50_000):
                    yield record(schema)(keys[at : at + 50_000], counts[at : at + 50_000])

    words = made.where("kind = 'words'").select("a", "b").mapInArrow(unpack, "h long, c long")
    # Sizes of the classes of equal rounded log count: a bounded table that gives the least count of the head.
    sizes = {r["k"]: r["count"] for r in words.groupBy(F.floor(F.log2("c") * 8).cast("int").alias("k")).count().collect()}
    least, room = max(sizes, default=0) + 1, head_words
    while sizes and least - 1 >= min(sizes) and sizes.get(least - 1, 0) <= room:
        least -= 1
        room -= sizes.get(least, 0)
    in_head = F.floor(F.log2("c") * 8).cast("int") >= least
    head = words.where(in_head).toArrow()
    order = np.argsort(head.column("h").to_numpy().view(np.uint64))
    keys, counts = head.column("h").to_numpy()[order], head.column("c").to_numpy()[order]
    blocks: list[list[int]] = [[]]
    held = 0
    for r in made.where("kind = 'filter'").select("bucket", "total").collect():  # a row per bucket
        if blocks[-1] and held + 8 * r["total"] > max_filter_bytes:
            blocks.append([])
            held = 0
        blocks[-1].append(r["bucket"])
        held += 8 * r["total"]
    block = lambda buckets: Filter({r["bucket"]: bytes(r["a"]) for r in made.where("kind = 'filter'").where(F.col("bucket").isin(buckets)).select("bucket", "a").toLocalIterator()}, n)
    rows = plain
    for buckets in blocks[:-1]:
        part = spark.sparkContext.broadcast(block(buckets))
        rows = stored(rows.mapInArrow(_pass(part), _LEVELS_SQL), "lm-levels")
        part.destroy()
    model = spark.sparkContext.broadcast((block(blocks[-1]), keys.view(np.uint64), counts))
    scored = stored(rows.mapInArrow(_score(model, total, distinct, kappa), "uid long, doc_id long, n_tokens long, n_head long, head_sum double, score double, rare array<long>, times array<long>"), "lm-scores")
    model.destroy()
    rare = scored.select("uid", F.explode(F.arrays_zip("rare", "times")).alias("z")).select("uid", F.col("z.rare").alias("h"), F.col("z.times").alias("times"))
    found = rare.join(words.where(~in_head), "h").groupBy("uid").agg(F.sum("times").alias("known"), F.sum(F.col("times") * (F.log10(F.col("c") + 0.5) - F.log10(F.lit(0.5)))).alias("more"))
    joined = scored.drop("rare", "times").join(found, "uid", "left")
    floor = float(np.log10(total + 0.5 * (distinct + 1)))
    base = F.col("head_sum") + (F.col("n_tokens") - F.col("n_head")) * float(np.log10(0.5)) + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * floor
    return joined.select("doc_id", out.alias("held_out"), "n_tokens", (F.col("n_head") + F.coalesce("known", F.lit(0))).cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
