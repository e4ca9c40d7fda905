"""Benchmark decontamination by latent semantic retrieval.

1. The words of the benchmark items are the terms. One pass over all documents tokenises them and keeps, per document, the
   places and numbers of its terms; all later passes read this table. The passages (64 words) each term occurs in are counted.
2. A randomised range finder over the TF-IDF passages: tasks multiply their passages with a random matrix and back, the
   products are added up by blocks of terms, the items are weighed in as passages, and the driver orthonormalises the
   result (terms x rank, bounded by the benchmark). Weights are smoothed and positive, so no term is lost however common.
3. Every window of every document (32 words at every 16th, 64 at every 32nd) is projected and compared with all items;
   a cosine of least_cosine or more makes a candidate. Pairs of a window and an item whose surroundings have too few of the
   item's rarer words for a common subsequence of least_lcs are passed over first: no pair that 4 would take is lost by this.
4. A candidate holds if the longest common subsequence of words covers enough of the item and the region also has enough
   of its answer (the answer column's words if there is one, else the rarer half of the item's different words).
The benchmark is a stated query set: it is broadcast in blocks of block_items, each with its own passes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.plans.storage import discard

from .common import Words, chunks, dealt, distinct, partitions, record, stored, text_bytes

PASSAGE, STEP, PIECE = 64, 16, 48
WINDOWS = ((2, 1), (4, 2))  # blocks of STEP words, and at every how many of them one starts
_FOUND = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("cosine", pa.float64()), ("lcs", pa.float64()), ("answer", pa.float64())])
_FOUND_SQL = "doc_id long, item_id long, cosine double, lcs double, answer double"
_HITS = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("pos", pa.binary()), ("col", pa.binary())])
_HITS_SQL = "doc_id long, n int, pos binary, col binary"


@dataclass
class Terms:
    hashes: np.ndarray  # sorted

    def __post_init__(self):
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(self.hashes & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def hits(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in h that are terms, and which."""
        at = np.flatnonzero(self.sieve[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
        col = np.searchsorted(self.hashes, h[at])
        col[col == len(self.hashes)] = 0
        ok = self.hashes[col] == h[at]
        return at[ok], col[ok]


def words_of(texts: list[str | None]) -> list[np.ndarray]:
    data, bounds = text_bytes(pa.array(texts, pa.string()))
    w = Words(data, bounds)
    return [w.hash[a:b] for a, b in zip(w.first[:-1], w.first[1:])]


def _locate(terms: Terms):
    """Places and numbers of each text's terms; texts without words are left out, as they hold nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = record(_HITS)
        for rows, data, bounds in chunks(batches):
            w = Words(data, bounds)
            at, col = terms.hits(w.hash)
            cut = np.searchsorted(at, w.first)
            pos, col = (at - np.repeat(w.first[:-1], np.diff(cut))).astype(np.int32), col.astype(np.int32)
            n = np.diff(w.first)
            some = np.flatnonzero(n)
            yield make(rows.column("doc_id").take(pa.array(some)), n[some], *([x[cut[r] : cut[r + 1]].tobytes() for r in some] for x in (pos, col)))

    return run


@dataclass
class Slice:
    """Some documents of the hit table: words per document, and the terms' documents, places and numbers in order."""

    rows: pa.RecordBatch
    n: np.ndarray
    row: np.ndarray
    pos: np.ndarray
    col: np.ndarray

    def parts(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Number of each term's part (parts of size words that documents don't share), and the documents' first parts."""
        begin = np.concatenate([[0], np.cumsum(-(-self.n // size))])
        return begin[self.row] + self.pos // size, begin


def _slices(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[Slice]:
    """Whole documents with about most terms together, one document at least."""
    for batch in batches:
        columns = []
        for name in ("pos", "col"):
            raw = batch.column(name).cast(pa.large_binary())
            _, offsets, data = raw.buffers()
            bounds = np.frombuffer(offsets, np.int64)[raw.offset : raw.offset + len(raw) + 1]
            columns.append(np.frombuffer(data, np.int32, (bounds[-1] - bounds[0]) // 4, bounds[0]) if bounds[-1] > bounds[0] else np.zeros(0, np.int32))
            ends = (bounds - bounds[0]) // 4
        n, at = batch.column("n").to_numpy().astype(np.int64), 0
        while at < len(n):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
            own = slice(ends[at], ends[to])
            yield Slice(batch.slice(at, to - at), n[at:to], np.repeat(np.arange(to - at), np.diff(ends[at : to + 1])), columns[0][own].astype(np.int64), columns[1][own].astype(np.int64))
            at = to


def weighted(part: np.ndarray, col: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit TF-IDF rows in coordinate form, sorted by part."""
    key, tf = np.unique(part.astype(np.int64) * len(idf) + col, return_counts=True)
    part, col = key // len(idf), key % len(idf)
    value = (1 + np.log(tf)) * idf[col]
    if len(part):
        value = value / np.sqrt(np.bincount(part, value * value))[part]
    return part, col, value


def _spread(size: int):
    schema = pa.schema([("term", pa.int32()), ("df", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, passages = np.zeros(size, np.int64), 0
        for s in _slices(batches, 1 << 20):
            part, begin = s.parts(PASSAGE)
            passages += int(begin[-1])
            df += np.bincount(distinct(part * size + s.col) % size, minlength=size)
        yield record(schema)(np.append(np.flatnonzero(df), -1), np.append(df[df > 0], passages))

    return run


def _runs(x: np.ndarray) -> np.ndarray:
    """Where runs of equal entries start."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)


def _back(part, col, value, omega, z, head) -> None:
    """Adds A'(A omega) to z for a sparse A sorted by part. The terms head, which fill most of A, are taken as a dense matrix."""
    number = np.cumsum(np.isin(np.arange(len(part)), _runs(part))) - 1
    place = head[col]
    often = place >= 0
    dense = np.zeros((int(number[-1]) + 1, int(head.max()) + 1), np.float32)
    dense[number[often], place[often]] = value[often]
    names = np.flatnonzero(head >= 0)
    names = names[np.argsort(head[names])]
    y = dense @ omega[names]
    p, c, v = number[~often], col[~often], value[~often, None]
    if len(p):
        first = _runs(p)
        y[p[first]] += np.add.reduceat(omega[c] * v, first)
        order = np.argsort(c, kind="stable")
        first = _runs(c[order])
        z[c[order][first]] += np.add.reduceat(y[p[order]] * v[order], first)
    z[names] += dense.T @ y


def _omega(size: int, rank: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((size, rank), np.float32)


def _head(df: np.ndarray, most: int = 256) -> np.ndarray:
    """Place of each of the most frequent terms, -1 for the others."""
    out = np.full(len(df), -1)
    top = np.argsort(-df, kind="stable")[:most]
    out[top] = np.arange(len(top))
    return out


def _sketch(idf: np.ndarray, head: np.ndarray, rank: int, seed: int, block: int):
    schema = pa.schema([("block", pa.int32()), ("z", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        omega, z, some = _omega(len(idf), rank, seed), np.zeros((len(idf), rank), np.float32), False
        for s in _slices(batches, 1 << 15):
            part, col, value = weighted(s.parts(PASSAGE)[0], s.col, idf)
            if len(part):
                _back(part, col, value.astype(np.float32), omega, z, head)
                some = True
        for b in range(0, len(idf), block) if some else ():
            yield record(schema)([b // block], [z[b : b + block].tobytes()])

    return run


def _add_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for b, z in zip(batch.column("block").to_pylist(), batch.column("z")):
            got = np.frombuffer(z.as_buffer(), np.float32).astype(np.float64)
            total[b] = total[b] + got if b in total else got
    for b, z in total.items():
        yield record(pa.schema([("block", pa.int32()), ("z", pa.binary())]))([b], [z.tobytes()])


def item_masks(item) -> dict[int, int]:
    """For each word, a bit for each of its places in the item."""
    masks: dict[int, int] = {}
    for i, x in enumerate(item.tolist()):
        masks[x] = masks.get(x, 0) | 1 << i
    return masks


def lcs(masks: dict[int, int], n: int, region: list[int]) -> int:
    """Length of the longest common subsequence of an item of n words and a region, bit-parallel over the item."""
    full = (1 << n) - 1
    v = full
    for x in region:
        m = masks.get(x)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


@dataclass
class Index:
    """What the search needs of one block of the benchmark."""

    scaled: np.ndarray  # terms x rank: basis rows times idf
    vectors: np.ndarray  # unit latent vectors of the items' pieces
    owner: np.ndarray  # item number of each piece
    ids: list[int]
    sizes: list[int]  # words of each item
    masks: list[dict[int, int]]
    answers: list[set[int]]
    rare: np.ndarray  # sorted term * items + item, where the term is one of the item's rarest words
    least: np.ndarray  # how many of these words a region must have, by item
    least_cosine: float
    least_lcs: float
    least_answer: float


def signatures(items: list[np.ndarray], df: np.ndarray, least_lcs: float) -> tuple[np.ndarray, np.ndarray]:
    """rare and least of an index.

    A common subsequence of need words leaves out at most n - need of an item's n words, so of its rarest n - need + t
    words, whatever t, t at least are met. Rare words are in few items, so few pairs of windows and items have that many.
    """
    pairs, least = [], []
    for k, x in enumerate(items):
        need = math.ceil(least_lcs * len(x) - 1e-9)
        least.append(max(1, need // 2))
        rare = distinct(x[np.lexsort((x, df[x]))][: len(x) - need + least[-1]])
        pairs.append(rare * len(items) + k)
    return np.sort(np.concatenate(pairs)), np.array(least)


def _reach(n, width: int):
    """A window of width blocks may hold any part of an item of n words: how far to look on both sides, in words."""
    return np.maximum(STEP, n - width * STEP + STEP)


def _spread_out(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[i], start[i] + 1, ... (count[i] of them) for all i, end to end."""
    return np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum())


def _near(index: Index, s: Slice, part: np.ndarray, begin: np.ndarray, row: np.ndarray, own: slice, some: tuple[int, int], width: int, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """(first block, item) of the windows whose surroundings have enough rare words of the item, among the terms own and some items."""
    terms = np.arange(len(index.scaled)) * len(index.sizes)
    from_, to = (np.searchsorted(index.rare, terms + k)[s.col[own]] for k in some)
    count = to - from_
    item = index.rare[_spread_out(from_, count)] % len(index.sizes)
    key = np.sort(item * len(row) + np.repeat(part[own], count))
    item, block = key // len(row), key % len(row)
    last = np.arange(len(key)) + index.least[item] - 1
    i = np.flatnonzero(last < len(key))
    j = last[i]
    far = -(-_reach(np.array(index.sizes)[item[i]], width) // STEP)
    ok = (item[i] == item[j]) & (row[block[i]] == row[block[j]]) & (block[j] - block[i] < width + 2 * far)
    i, j, far = i[ok], j[ok], far[ok]
    r = row[block[i]]
    low, high = np.maximum(block[j] - width - far + 1, begin[r]), np.minimum(block[i] + far, begin[r + 1] - 1)
    count = np.maximum(high - low + 1, 0)
    start, item = _spread_out(low, count), np.repeat(item[i], count)
    ok = (start - begin[row[start]]) % stride == 0
    key = distinct(start[ok] * len(index.sizes) + item[ok])
    return key // len(index.sizes), key % len(index.sizes)


def _windows(index: Index, s: Slice, windows: int = 1024, most: int = 4_000_000) -> Iterator[tuple[int, int, int, int, int, float]]:
    """(document, first word, end word, words to look at on both sides, piece, cosine) of each candidate."""
    part, begin = s.parts(STEP)
    n = int(begin[-1])
    row = np.repeat(np.arange(len(s.n)), np.diff(begin))
    if not len(part):
        return
    first_hit = np.searchsorted(part, np.arange(n + 1))
    pieces = np.searchsorted(index.owner, np.arange(len(index.sizes) + 1))
    # Documents are taken together while the (term, item) pairs to look at are few enough to hold; a long one, a part of the items at a time.
    ends = first_hit[begin]
    held = np.diff(np.searchsorted(index.rare, np.arange(len(index.scaled) + 1) * len(index.sizes)))
    total = np.concatenate([[0], np.cumsum(held[s.col])])[ends]
    at = 0
    while at < len(s.n):
        to = max(at + 1, int(np.searchsorted(total, total[at] + most, "right")) - 1)
        own = slice(ends[at], ends[to])
        cuts = np.linspace(0, len(index.sizes), 1 + max(1, min(len(index.sizes), -(-int(total[to] - total[at]) // most)))).astype(int).tolist()
        for (width, stride), some in product(WINDOWS, pairwise(cuts)):
            start, item = _near(index, s, part, begin, row, own, some, width, stride)
            count = pieces[item + 1] - pieces[item]
            start, piece = np.repeat(start, count), _spread_out(pieces[item], count)
            mine = start[_runs(start)]
            for a in range(0, len(mine), windows):
                b = mine[a : a + windows]
                e = np.minimum(b + width, begin[row[b] + 1])
                need = distinct(np.concatenate([np.minimum(b + k, e - 1) for k in range(width)]))
                count = first_hit[need + 1] - first_hit[need]
                hits = _spread_out(first_hit[need], count)
                blocks = np.zeros((len(need) + 1, index.scaled.shape[1]), np.float32)  # the last one stays zero
                full = np.flatnonzero(count)
                if len(full):
                    blocks[full] = np.add.reduceat(index.scaled[s.col[hits]], np.cumsum(count[full]) - count[full])
                v = sum(blocks[np.where(b + k < e, np.searchsorted(need, np.minimum(b + k, e - 1)), len(need))] for k in range(width))
                v /= np.maximum(np.sqrt((v * v).sum(axis=1)), 1e-12)[:, None]
                low, high = np.searchsorted(start, (b[0], b[-1] + 1))
                for c in range(low, high, 1 << 14):
                    which, of = np.searchsorted(b, start[c : min(c + (1 << 14), high)]), piece[c : min(c + (1 << 14), high)]
                    cosine = (v[which] * index.vectors[of]).sum(axis=1)
                    for i in np.flatnonzero(cosine >= index.least_cosine):
                        r, p = int(row[b[which[i]]]), int(of[i])
                        first = int(b[which[i]] - begin[r]) * STEP
                        yield r, first, min(int(s.n[r]), first + width * STEP), int(_reach(index.sizes[index.owner[p]], width)), p, float(cosine[i])
        at = to


def _search(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        for s in _slices(batches, 1 << 18):
            best: dict[tuple[int, int], tuple[float, float, float]] = {}
            tried: set[tuple[int, int, int, int]] = set()
            first = np.searchsorted(s.row, np.arange(len(s.n) + 1))
            for r, low, high, reach, piece, cosine in _windows(index, s):
                k = int(index.owner[piece])
                n, have = index.sizes[k], best.get((r, k))
                if have and have[1] == 1.0:
                    continue
                a, b = (int(first[r] + x) for x in np.searchsorted(s.pos[first[r] : first[r + 1]], (low - reach, high + reach)))
                if (r, k, a, b) in tried:
                    continue
                tried.add((r, k, a, b))
                region, masks, answers = s.col[a:b].tolist(), index.masks[k], index.answers[k]
                if sum(x in masks for x in region) < index.least_lcs * n - 1e-9:
                    continue
                answer = len(answers.intersection(region)) / len(answers) if answers else 1.0
                if answer < index.least_answer:
                    continue
                share = lcs(masks, n, region) / n
                if share >= index.least_lcs and (have is None or share > have[1]):
                    best[r, k] = (cosine, share, answer)
            if best:
                ids = s.rows.column("doc_id").to_pylist()
                yield record(_FOUND)([ids[r] for r, _ in best], [index.ids[k] for _, k in best], *map(list, zip(*best.values())))

    return run


def _fit(hits: DataFrame, terms: Terms, ids: list, words: list[np.ndarray], answers: list[np.ndarray], rank: int, limits: tuple[float, float, float], seed: int) -> Index | None:
    """The index of items (term numbers), from the terms' places in all documents."""
    n, size = partitions(hits.sparkSession), len(terms.hashes)
    df = np.zeros(size, np.int64)
    passages = 0
    for r in hits.mapInArrow(_spread(size), "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():  # a row per term
        if r["term"] < 0:
            passages = r["df"]
        else:
            df[r["term"]] = r["df"]
    if not passages:
        return None
    idf, head = 1 + np.log((1 + passages) / (1 + df)), _head(df)
    rank = max(1, min(rank, size, len(words) + 32))
    # As many blocks as partitions, so that the sums of all tasks' products are dealt over all of them.
    block = max(1, -(-size // n))
    sketch = hits.mapInArrow(_sketch(idf, head, rank, seed, block), "block int, z binary")
    z = np.zeros((size, rank))
    for r in dealt(sketch, "block", n).mapInArrow(_add_blocks, "block int, z binary").toLocalIterator():  # terms x rank in all
        rows = np.frombuffer(bytes(r["z"])).reshape(-1, rank)
        z[r["block"] * block : r["block"] * block + len(rows)] += rows
    pieces = [(k, x[a : a + PIECE] if len(x) > PASSAGE else x) for k, x in enumerate(words) for a in (range(0, len(x), PIECE) if len(x) > PASSAGE else (0,))]
    part, col = np.concatenate([np.full(len(p), i) for i, (_, p) in enumerate(pieces)]), np.concatenate([p for _, p in pieces])
    own_part, own_col, value = weighted(part, col, idf)
    own = np.zeros((size, rank), np.float32)
    _back(own_part, own_col, value.astype(np.float32), _omega(size, rank, seed), own, head)
    basis, _ = np.linalg.qr(z / passages + own / len(pieces))
    # Linear term counts make the vector of a window the sum of its blocks' vectors.
    scaled = (basis * idf[:, None]).astype(np.float32)
    vectors = np.add.reduceat(scaled[col], _runs(part))
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1), 1e-12)[:, None]
    halves = [distinct(x) for x in words]
    halves = [x[np.lexsort((x, df[x]))][: -(-len(x) // 2)] for x in halves]
    told = [set((a if len(a) else h).tolist()) for a, h in zip(answers, halves)]
    owner = np.array([k for k, _ in pieces])
    return Index(scaled, vectors, owner, ids, [len(x) for x in words], [item_masks(x) for x in words], told, *signatures(words, df, limits[1]), *limits)


def find_leaks(docs: DataFrame, benchmark: DataFrame, rank: int = 128, least_cosine: float = 0.4, least_lcs: float = 0.6, least_answer: float = 0.5, block_items: int = 4096, seed: int = 11) -> DataFrame:
    """Pairs of documents and benchmark items they hold: doc_id, item_id, cosine, lcs, answer (shares of the item).

    docs: doc_id, text; benchmark: item_id, text and maybe answer; other columns are ignored. Null and empty texts hold
    nothing and items without words are held by nothing; repeated rows give one row per pair; a null doc_id or item_id is
    returned as null; with an empty table there are no pairs.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    wanted = [F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")] + [F.col(c).cast("string") for c in benchmark.columns if c == "answer"]
    asked = benchmark.select(wanted).distinct()
    blocks = max(1, -(-asked.count() // block_items))
    out = []
    for b in range(blocks):
        items = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()  # block_items or so
        words = words_of([r["text"] for r in items])
        answers = words_of([r["answer"] for r in items]) if "answer" in asked.columns else [np.zeros(0, np.uint64)] * len(items)
        full = [i for i, x in enumerate(words) if len(x)]
        if not full:
            continue
        terms = Terms(distinct(np.concatenate([x[i] for x in (words, answers) for i in full])))
        number = lambda lists: [np.searchsorted(terms.hashes, lists[i]) for i in full]
        hits = stored(plain.mapInArrow(_locate(terms), _HITS_SQL), "leak-terms")
        index = _fit(hits, terms, [items[i]["item_id"] for i in full], number(words), number(answers), rank, (least_cosine, least_lcs, least_answer), seed)
        if index is not None:
            shared = spark.sparkContext.broadcast(index)
            out.append(stored(hits.mapInArrow(_search(shared), _FOUND_SQL), "leaks"))
            shared.destroy()
        discard(hits)
    if not out:
        return spark.createDataFrame([], _FOUND_SQL)
    found = out[0]
    for more in out[1:]:
        found = found.union(more)
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("lcs", "cosine", "answer")).alias("m"))
    return best.select("doc_id", "item_id", F.col("m.cosine").alias("cosine"), F.col("m.lcs").alias("lcs"), F.col("m.answer").alias("answer"))


def drop_leaked(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """docs without the rows that hold a benchmark item; columns stay, rows with a null doc_id are kept."""
    bad = find_leaks(docs, benchmark, **options).where("doc_id is not null").select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(docs.columns)
