"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

Texts are tokenised once; a text longer than a sequence is cut so that only its first piece is short. Full pieces are
sequences of their own. The other pieces are dealt by hash to shards of bounded size. Each shard is evolved on several
islands (groups of their own, dealt over all tasks, with their own seeds); between epochs every island also gets its
neighbour's elite. Crossover injects whole well-filled bins of the mate, removes the bins that hold the same pieces, and
puts the displaced pieces back by swaps that fill a bin better and by best fit. Best-fit decreasing is where every island
starts, so the result is never worse. Bins that stay loose are packed once more across shards.
"""

from __future__ import annotations

import random
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.plans.storage import discard

from .common import chunks, dealt, grouped, mix, partitions, prefix_hashes, record, span_hashes, stored

END = 2
SPECIAL = b"<|endoftext|>"
_SPACES = np.zeros(256, bool)
_SPACES[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True


def odd_rows(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows that can't be encoded word by word: a space beside other white space, where a token can span the cut, white
    space beyond ASCII, or a special token's string. A few others may be among them."""
    hits = []
    if len(data) > 1:
        white, space = _SPACES[data], data == 0x20
        beside = np.flatnonzero((space[:-1] & white[1:]) | (white[:-1] & space[1:]))
        hits += [beside, beside + 1]
        one, two = data[:-2].astype(np.int32), data[1:-1].astype(np.int32)
        three = one << 16 | two << 8 | data[2:]
        wide = (three == 0xE19A80) | (three >= 0xE28080) & (three <= 0xE2808A) | np.isin(three, (0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080))
        hits += [np.flatnonzero(wide), np.flatnonzero((data[:-1] == 0xC2) & ((data[1:] == 0x85) | (data[1:] == 0xA0)))]
    raw, at = data.tobytes(), -1
    while (at := raw.find(SPECIAL, at + 1)) >= 0:
        hits.append(np.array([at]))
    return np.unique(np.searchsorted(bounds, np.concatenate(hits), "right") - 1) if hits else np.zeros(0, np.int64)


class Encoder:
    """Token ids of texts, with the ids of each different word (led by its space) kept.

    Outside runs of white space, byte-level BPE never joins what a space parts, so the words of a chunk are hashed, each
    different one that isn't known is encoded, and the ids are gathered. Odd rows go through the tokenizer whole.
    """

    def __init__(self, most: int = 1_000_000):
        import base64

        import public_tokenizers as files
        import tiktoken

        with open(files.path("byte_bpe_50k.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.core = tiktoken.Encoding("bytes50k", pat_str=files.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.path, self.full, self.most = files.path("byte_bpe_50k.json"), None, most
        self.forget()

    def forget(self) -> None:
        self.hashes, self.first, self.size, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def whole(self, text: str) -> np.ndarray:
        if SPECIAL.decode() not in text:
            return np.array(self.core.encode_ordinary(text), np.uint32)
        if self.full is None:
            from tokenizers import Tokenizer

            self.full = Tokenizer.from_file(self.path)
        return np.array(self.full.encode(text, add_special_tokens=False).ids, np.uint32)

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        """Adds words (sorted hashes) that aren't known."""
        got = [self.core.encode_ordinary(w.decode()) for w in words]
        size = np.array([len(x) for x in got], np.int64)
        first = len(self.ids) + np.cumsum(size) - size
        at = np.searchsorted(self.hashes, hashes)
        self.hashes, self.first, self.size = (np.insert(x, at, y) for x, y in ((self.hashes, hashes), (self.first, first), (self.size, size)))
        self.ids = np.concatenate([self.ids, np.array([i for x in got for i in x], np.uint32)])

    def __call__(self, data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
        """The ids of each row."""
        spaces = np.flatnonzero(data == 0x20)
        start = np.sort(np.concatenate([bounds[:-1], spaces]))
        end = np.append(start[1:], len(data))
        first = np.arange(len(bounds)) + np.searchsorted(spaces, bounds)  # of each row's words
        h = mix(span_hashes(prefix_hashes(data), start, end) + (end - start).astype(np.uint64))
        order = np.argsort(h)
        new = np.concatenate([[True], h[order[1:]] != h[order[:-1]]])
        which = np.empty(len(h), np.int64)
        which[order] = np.cumsum(new) - 1
        one = order[new]  # a place of each different word
        known = h[one]

        at = np.searchsorted(self.hashes, known)
        some = np.flatnonzero((at == len(self.hashes)) | (np.append(self.hashes, np.uint64(0))[at] != known))
        if len(self.hashes) + len(some) > self.most:  # a full table starts anew with the words at hand
            self.forget()
            some = np.arange(len(known))
        if len(some):
            self._learn(known[some], [data[start[i] : end[i]].tobytes() for i in one[some].tolist()])
        at = np.searchsorted(self.hashes, known)
        count = self.size[at][which]
        ends = np.concatenate([[0], np.cumsum(count)])
        ids = self.ids[np.repeat(self.first[at][which] - ends[:-1], count) + np.arange(ends[-1])]
        out = np.split(ids, ends[first[1:-1]])
        for r in odd_rows(data, bounds).tolist():
            out[r] = self.whole(data[bounds[r] : bounds[r + 1]].tobytes().decode())
        return out


@lru_cache(1)
def encoder() -> Encoder:
    """One per Python worker, so that the words that one task encoded are known to the next."""
    return Encoder()


_PIECES = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def _pieces(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, end_token = record(_PIECES), struct.pack("<I", END)
        uid = TaskContext.get().partitionId() << 38
        for batch, data, bounds in chunks(batches):
            rows: list[tuple] = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encoder()(data, bounds)):
                n = len(ids) + 1
                first = n % size or size
                for k, end in enumerate(range(first, n + 1, size)):
                    start = 0 if k == 0 else end - size
                    crc = zlib.crc32(ids[start:end].astype("<u4", copy=False))
                    rows.append((uid, doc, k, start, end - start, zlib.crc32(end_token, crc) if end == n else crc))
                    uid += 1
            yield make(*map(list, zip(*rows)))

    return run


class Packer:
    """Evolves packings of one shard. A packing is a list of bins, each a list of item numbers."""

    def __init__(self, lengths: list[int], size: int, seed: int):
        self.length, self.size, self.random = lengths, size, random.Random(seed)
        self.least = max(-(-sum(lengths) // size), sum(2 * x > size for x in lengths))

    def fit(self, items: list[int], bins: list[list[int]]) -> list[list[int]]:
        """Puts items, in their order, each into the fullest bin that has room, or a new one."""
        length, size = self.length, self.size
        room: dict[int, list[int]] = {}
        mask = 0
        for b, members in enumerate(bins):
            r = size - sum(length[i] for i in members)
            room.setdefault(r, []).append(b)
            mask |= 1 << r
        for i in items:
            n = length[i]
            above = mask >> n
            if above:
                r = n + (above & -above).bit_length() - 1
                b = room[r].pop()
                if not room[r]:
                    mask ^= 1 << r
                bins[b].append(i)
                r -= n
            else:
                b, r = len(bins), size - n
                bins.append([i])
            room.setdefault(r, []).append(b)
            mask |= 1 << r
        return bins

    def fill(self, members: list[int]) -> int:
        return sum(self.length[i] for i in members)

    def worth(self, bins: list[list[int]]) -> tuple[int, int]:
        """Fewer bins first, then fuller ones (sum of squared fills)."""
        return -len(bins), sum(self.fill(b) ** 2 for b in bins)

    def first(self, noise: float) -> list[list[int]]:
        order = sorted(range(len(self.length)), key=lambda i: (-self.length[i] * (1 - noise * self.random.random()), i))
        return self.fit(order, [])

    def settle(self, loose: list[int], bins: list[list[int]]) -> list[list[int]]:
        """Puts displaced pieces back: first a piece takes the place of one or two smaller ones where it fills a bin better,
        which displaces these instead; the pieces left in the end go in by best fit."""
        length, size = self.length, self.size
        free: dict[int, list[int]] = {}
        mask = 0
        for i in loose:
            free.setdefault(length[i], []).append(i)
            mask |= 1 << length[i]
        for members in bins:
            room = size - sum(length[i] for i in members)
            if not room:
                continue
            gain, out = 0, ()
            for p, i in enumerate(members):
                for q in range(-1, p):
                    held = length[i] + (length[members[q]] if q >= 0 else 0)
                    better = ((mask >> (held + 1)) & ((1 << room) - 1)).bit_length()
                    if better > gain:
                        gain, out, put = better, (p, q) if q >= 0 else (p,), held + better
            if gain:
                taken = free[put].pop()
                if not free[put]:
                    mask ^= 1 << put
                    del free[put]
                for p in out:
                    free.setdefault(length[members[p]], []).append(members[p])
                    mask |= 1 << length[members[p]]
                members[:] = [i for p, i in enumerate(members) if p not in out] + [taken]
        return self.fit(sorted((i for v in free.values() for i in v), key=lambda i: -length[i]), bins)

    def cross(self, one: list[list[int]], mate: list[list[int]]) -> list[list[int]]:
        full = [b for b in mate if self.fill(b) >= 0.98 * self.size] or sorted(mate, key=self.fill)[-1:]
        taken = self.random.sample(full, max(1, len(full) // 2))
        held = {i for b in taken for i in b}
        kept, loose = [list(b) for b in taken], []
        for b in one:
            if held.isdisjoint(b):
                kept.append(list(b))
            else:
                loose += [i for i in b if i not in held]
        return self.settle(loose, kept)

    def shake(self, bins: list[list[int]]) -> list[list[int]]:
        """Takes the loosest bins and as many others apart."""
        some = max(1, len(bins) // self.random.choice((10, 20, 40)))
        order = sorted(range(len(bins)), key=lambda b: self.fill(bins[b]))
        out = set(order[:some]) | set(self.random.sample(order, some))
        return self.settle([i for b in out for i in bins[b]], [list(b) for k, b in enumerate(bins) if k not in out])

    def evolve(self, elites: list[list[list[int]]], people: int, generations: int) -> list[list[int]]:
        """The best of the elites (without: best-fit decreasing) and their offspring of so many generations."""
        crowd = [(self.worth(b), b) for b in elites or [self.first(0.0)]]
        best = lambda c: c[0]
        for _ in range(generations):
            if -max(crowd, key=best)[0][0] <= self.least:
                break
            while len(crowd) < people:
                bins = self.shake(max(crowd, key=best)[1]) if len(crowd) % 2 else self.first(0.1)
                crowd.append((self.worth(bins), bins))
            for _ in range(max(1, people // 2)):
                (_, one), (_, mate) = sorted(self.random.sample(crowd, 2), key=best, reverse=True)
                child = self.shake(one) if self.random.random() < 0.6 else self.cross(one, mate)
                crowd.append((self.worth(child), child))
            crowd = sorted(crowd, key=best, reverse=True)[:people]
        return max(crowd, key=best)[1]


_ISLES = pa.schema([("shard", pa.int64()), ("island", pa.int32()), ("uids", pa.binary()), ("lengths", pa.binary()), ("bins", pa.binary()), ("n_bins", pa.int32()), ("worth", pa.int64())])
_ISLES_SQL = "shard long, island int, uids binary, lengths binary, bins binary, n_bins int, worth long"


def _elite(items: np.ndarray, bins: bytes) -> list[list[int]]:
    out: dict[int, list[int]] = {}
    for i, b in enumerate(np.frombuffer(bins, np.int32).tolist()):
        out.setdefault(b, []).append(i)
    return list(out.values())


def _evolve(size: int, people: int, generations: int, epoch: int):
    """Epoch 0 gets pieces (place, shard, island, uid, length), the others islands' elites under the place that they go to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = record(_ISLES)
        for group in grouped(batches, "place"):
            if epoch == 0:
                shard, island = (group.column(c)[0].as_py() for c in ("shard", "island"))
                uids, lengths = group.column("uid").to_numpy(), group.column("length").to_numpy().astype(np.int32)
                order = np.argsort(uids)
                uids, lengths, elites = uids[order], lengths[order], []
            else:
                rows = sorted(group.to_pylist(), key=lambda r: r["island"])
                shard, island = rows[0]["shard"], rows[0]["target"]
                uids, lengths = np.frombuffer(rows[0]["uids"], np.int64), np.frombuffer(rows[0]["lengths"], np.int32)
                elites = [_elite(uids, r["bins"]) for r in rows]
            packer = Packer(lengths.tolist(), size, hash((shard, island, epoch)))
            best = packer.evolve(elites, people, generations)
            at = np.zeros(len(uids), np.int32)
            for b, members in enumerate(best):
                at[members] = b
            yield make([shard], [island], [uids.tobytes()], [lengths.tobytes()], [at.tobytes()], [len(best)], [packer.worth(best)[1]])

    return run


_PLACED = pa.schema([("uid", pa.int64()), ("length", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("fill", pa.int64())])


def _place(level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = record(_PLACED)
        for batch in batches:
            for r in batch.to_pylist():
                uids, lengths, at = (np.frombuffer(r[k], t) for k, t in (("uids", np.int64), ("lengths", np.int32), ("bins", np.int32)))
                order = np.argsort(at, kind="stable")
                length, b = lengths[order].astype(np.int64), at[order]
                ends = np.cumsum(length)
                first = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]]))
                begin = np.repeat(ends[first] - length[first], np.diff(np.append(first, len(b))))
                fill = np.repeat(np.add.reduceat(length, first), np.diff(np.append(first, len(b))))
                yield make(uids[order], length, ((((level << 30) + r["shard"]) << 20) + b.astype(np.int64)) * 2, ends - length - begin, fill)

    return run


def _pack(pieces: DataFrame, level: int, size: int, shard_pieces: int, islands: int, people: int, generations: int, epochs: int) -> DataFrame:
    """uid, length, sequence_id, offset, fill of each piece (uid, length)."""
    n = partitions(pieces.sparkSession)
    shards = max(1, -(-pieces.count() // shard_pieces))
    # A place is an island of a shard; it is a group of its own from the first epoch on.
    place = lambda island: (F.col("shard") * islands + island).alias("place")
    run = lambda df, epoch: dealt(df.withColumn("to", F.col("place") % n), "to", n).drop("to").sortWithinPartitions("place").mapInArrow(_evolve(size, people, generations, epoch), _ISLES_SQL)
    spread = pieces.select("uid", F.col("length").cast("int").alias("length"), F.pmod(F.xxhash64("uid"), F.lit(shards)).alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"))
    isles = stored(run(spread.withColumn("place", place(F.col("island"))), 0), "isles")
    for epoch in range(1, epochs):
        # Elites stay, and also go to the next island of the ring.
        both = isles.withColumn("target", F.explode(F.array(F.col("island"), (F.col("island") + 1) % islands)))
        last, isles = isles, stored(run(both.withColumn("place", place(F.col("target"))), epoch), "isles")
        discard(last)
    best = Window.partitionBy("shard").orderBy("n_bins", F.desc("worth"), "island")
    return isles.withColumn("rank", F.row_number().over(best)).where("rank = 1").drop("rank").mapInArrow(_place(level), "uid long, length long, sequence_id long, offset long, fill long")


def pack(docs: DataFrame, size: int = 1024, shard_pieces: int = 4096, islands: int = 2, people: int = 4, generations: int = 6, epochs: int = 3) -> DataFrame:
    """Packs the whole texts of docs (doc_id, text; other columns are ignored) into sequences of at most size tokens.

    Returns a row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Null and empty texts are one
    piece with the end token alone; repeated rows and null ids are packed like any other; an empty table gives no rows.
    shard_pieces is the mean number of pieces that one task packs together; every piece is packed.
    """
    pieces = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_pieces(size), "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"), "pieces")
    options = (size, shard_pieces, islands, people, generations, epochs)
    first = stored(_pack(pieces.where(F.col("length") < size), 0, *options), "packed")
    loose = first.where(F.col("fill") < 0.97 * size)
    second = _pack(loose.select("uid", "length"), 1, *options)
    placed = first.where(F.col("fill") >= 0.97 * size).union(second).select("uid", "sequence_id", "offset")
    full = pieces.where(F.col("length") == size).select(*pieces.columns, (F.col("uid") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return pieces.join(placed, "uid").select(full.columns).union(full).drop("uid")
