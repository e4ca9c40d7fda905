"""Exact removal of long repeated strings by a hash-compared suffix sort over anchored segments.

A string of `length` bytes is repeated if it also starts anywhere else. Equal strings have equal anchors (their leftmost
least hash of `gram` bytes) at equal offsets, so:

1. Each text is cut into runs of starts that share an anchor. Anchors go to buckets by hash; those seen at one place only
   can't be in a repeated string and end here. Equal texts count once, and are all repeated.
2. The surviving runs' segments are cut out of their texts. Equal segments (by cryptographic digest) are all repeated; each
   task sends one copy of each on.
3. A bucket sorts the different segments of an anchor as suffixes that start at the anchor: a mergesort that compares two
   suffixes by binary search for their common extension on prefix polynomial hashes. The common extensions of neighbours
   tell which segments can hold a repeated string at all; the strings of these are met by hash and verified on the bytes.
   Anchors of too many segments for one task have their strings dealt over all tasks by two hashes instead.
4. Starts are put together per text, and the covered bytes removed.

A passage that a third of all texts hold is sent on once per task, and what is known of it comes back by salted joins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.relational import looked_up

from .common import as_long, chunks, dealt, distinct, mix, partitions, powers, prefix_hashes, record, span_hashes, stored

_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64))
_SECOND = np.uint64(0xD6E8FEB86659FD93 | 1)
_SECOND_INVERSE = np.uint64(pow(int(_SECOND), -1, 1 << 64))


def anchors(data: np.ndarray, bounds: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Every string of length bytes has an anchor: the leftmost least hash of its strings of gram bytes.

    Returns (row, first start, last start, anchor, hash) of each maximal run of starts with one anchor; positions count
    from the row's start.
    """
    n = len(data)
    wide = length - gram + 1
    if n < length:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    p = prefix_hashes(data)
    h = (p[gram:] - p[:-gram]) * powers(n, _INVERSE)[: n - gram + 1]
    h = mix(h)
    # Least entry of each window, by doubling; ranks carry the position so that the leftmost least one is found.
    low = h.copy()
    at = np.arange(len(h), dtype=np.int32)
    span = 1
    while span < wide:
        step = min(span, wide - span)
        take = low[step:] < low[:-step]
        at = np.where(take, at[step:], at[:-step])
        low = np.where(take, low[step:], low[:-step])
        span += step
    # at[i] is the anchor of the string that starts at i; starts that reach past their row are dropped.
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: len(at)]
    ok = np.arange(len(at)) + length <= bounds[row + 1]
    start = np.flatnonzero(ok)
    if not len(start):
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    a = at[start].astype(np.int64)
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (start[1:] != start[:-1] + 1) | (row[start[1:]] != row[start[:-1]])])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    r = row[start[first]]
    return r, start[first] - bounds[r], start[last] - bounds[r], a[first] - bounds[r], h[a[first]]


_BLOBS = pa.schema([("bucket", pa.int32()), ("h", pa.binary()), ("text", pa.binary()), ("span", pa.binary())])
_RUNS = pa.schema([("text_key", pa.int64()), ("h", pa.int64()), ("a", pa.int32()), ("b", pa.int32()), ("m", pa.int32())])
_RUNS_SQL = "text_key long, h long, a int, b int, m int"
_SEGMENTS = pa.schema([("text_key", pa.int64()), ("h", pa.int64()), ("digest", pa.binary()), ("a", pa.int32()), ("starts", pa.int32()), ("left", pa.int32()), ("bytes", pa.binary())])
_SEGMENTS_SQL = "text_key long, h long, digest binary, a int, starts int, left int, bytes binary"
_HITS = pa.schema([("digest", pa.binary()), ("lo", pa.int32()), ("hi", pa.int32())])
_KEPT = pa.schema([("text_key", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.int64()))])


def _anchor_blobs(length: int, gram: int, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, seen, held, size = record(_BLOBS), set(), [], 0

        def flush():
            h, key, span = (np.concatenate(x) for x in zip(*held))
            # Anchors are least hashes, so nearly all are small: scrambled anew, they spread over the buckets.
            bucket = ((mix(h) >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
            order = np.argsort(bucket, kind="stable")
            h, key, span = h[order], key[order], span[order]
            cuts = np.searchsorted(bucket[order], np.arange(n + 1, dtype=np.uint64))
            for b in np.flatnonzero(cuts[1:] > cuts[:-1]):
                own = slice(cuts[b], cuts[b + 1])
                yield make([b], [h[own].tobytes()], [key[own].tobytes()], [span[own].tobytes()])

        for rows, data, bounds in chunks(batches):
            r, a, b, m, h = anchors(data, bounds, length, gram)
            keys = rows.column("text_key").to_numpy()
            fresh = np.array([k not in seen and not seen.add(k) for k in keys.tolist()])
            ok = fresh[r]
            if ok.any():
                held.append((h[ok], keys[r[ok]], np.column_stack([a, b, m])[ok].astype(np.int32)))
                size += int(ok.sum())
            if size > 500_000:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    return run


def _repeated_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs whose anchor stands at two places or more."""
    hs, keys, spans = [], [], []
    for batch in batches:
        for h, k, s in zip(batch.column("h"), batch.column("text"), batch.column("span")):
            hs.append(np.frombuffer(h.as_buffer(), np.uint64))
            keys.append(np.frombuffer(k.as_buffer(), np.int64))
            spans.append(np.frombuffer(s.as_buffer(), np.int32).reshape(-1, 3))
    if not hs:
        return
    h, key, span = map(np.concatenate, (hs, keys, spans))
    del hs, keys, spans
    s = np.sort(h)
    twice = distinct(s[1:][s[1:] == s[:-1]])
    at = np.searchsorted(twice, h)
    at[at == len(twice)] = 0
    some = np.flatnonzero(twice[at] == h) if len(twice) else np.zeros(0, np.int64)
    h, key, span = h[some], key[some], span[some]
    order = np.lexsort((span[:, 0], span[:, 2], key, h))
    h, key, span = h[order], key[order], span[order]
    # A text that came from several tasks is one text: repeated rows go, then anchors left at one place.
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (key[1:] != key[:-1]) | (span[1:] != span[:-1]).any(axis=1)]) if len(h) else np.zeros(0, bool)
    h, key, span = h[new], key[new], span[new]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(h)))
    ok = np.repeat(size > 1, size)
    h, key, span = h[ok], key[ok], span[ok]
    for i in range(0, len(h), 50_000):
        own = slice(i, i + 50_000)
        yield record(_RUNS)(key[own], as_long(h[own]), *(np.ascontiguousarray(span[own, c]) for c in range(3)))


def _segments(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, sent, rows, size = record(_SEGMENTS), set(), [], 0
        for batch in batches:
            for key, text, runs in zip(batch.column("text_key").to_pylist(), batch.column("text"), batch.column("runs")):
                raw = text.as_buffer().to_pybytes()
                v = runs.values
                for h, a, b, m in zip(v.field("h").to_pylist(), v.field("a").to_pylist(), v.field("b").to_pylist(), v.field("m").to_pylist()):
                    piece = raw[a : b + length]
                    digest = hashlib.blake2b(piece, digest_size=16, salt=(m - a).to_bytes(8, "little")).digest()
                    new = digest not in sent
                    sent.add(digest)
                    rows.append((key, h, digest, a, b - a, m - a, piece if new else None))
                    size += len(piece) if new else 0
                    if len(rows) >= 10_000 or size > 4 << 20:
                        yield make(*map(list, zip(*rows)))
                        rows, size = [], 0
        if rows:
            yield make(*map(list, zip(*rows)))

    return run


class Suffixes:
    """Segments of one or more groups (equal anchors), laid end to end, with their prefix polynomial hashes."""

    def __init__(self, pieces: list[bytes], left: np.ndarray, group: np.ndarray):
        self.data = np.frombuffer(b"".join(pieces), np.uint8)
        size = np.array([len(p) for p in pieces], np.int64)
        begin = np.concatenate([[0], np.cumsum(size)[:-1]])
        self.at, self.left, self.right, self.group = begin + left, left.astype(np.int64), size - left, group
        self.prefix = prefix_hashes(self.data)

    def common(self, i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
        """Length of the common extension to the right (or left) of the anchors of i and j, by binary search."""
        room = self.left if back else self.right
        low, high = np.zeros(len(i), np.int64), np.minimum(room[i], room[j])
        x, y = self.at[i], self.at[j]
        while (open_ := low < high).any():
            k = np.where(open_, (low + high + 1) // 2, low)
            same = span_hashes(self.prefix, x - k, x) == span_hashes(self.prefix, y - k, y) if back else span_hashes(self.prefix, x, x + k) == span_hashes(self.prefix, y, y + k)
            low, high = np.where(same, k, low), np.where(same, high, k - 1)
        return low

    def less(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the suffix at i's anchor sorts before that at j's; at their segments' ends the shorter one is first."""
        k = self.common(i, j)
        over = (k == self.right[i]) | (k == self.right[j])
        last = len(self.data) - 1
        return np.where(over, self.right[i] < self.right[j], self.data[np.minimum(self.at[i] + k, last)] < self.data[np.minimum(self.at[j] + k, last)])

    def sorted(self) -> np.ndarray:
        """Segment numbers, groups (which come contiguous) kept apart, by a bottom-up mergesort of all groups at once."""
        n = len(self.at)
        order = np.arange(n)
        first = np.flatnonzero(np.concatenate([[True], self.group[1:] != self.group[:-1]]))
        count = np.diff(np.append(first, n))
        base, total = np.repeat(first, count), np.repeat(count, count)
        width = 1
        while width < count.max(initial=0):
            some = np.flatnonzero(total > width)
            q = some - base[some]
            run = q // width
            start = (run ^ 1) * width
            size = np.clip(total[some] - start, 0, width)
            # Rank of each suffix among its sibling run's: those of the left run go first where equal.
            low, high = np.zeros(len(some), np.int64), size.copy()
            mine, right = order[some], (run & 1) == 1
            while len(go := np.flatnonzero(low < high)):
                mid = (low[go] + high[go]) // 2
                other = order[base[some[go]] + start[go] + mid]
                before = np.where(right[go], ~self.less(mine[go], other), self.less(other, mine[go]))
                low[go] = np.where(before, mid + 1, low[go])
                high[go] = np.where(before, high[go], mid)
            moved = order.copy()
            moved[base[some] + (run & ~1) * width + (q - run * width) + low] = mine
            order = moved
            width *= 2
        return order

    def _strings(self, who: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
        """(segment, lo, hi): starts of the segments who whose strings another of them has at the same offset from the anchor.

        The strings are sorted by hash, group and offset. Matching starts that follow each other in both segments are
        verified as one stretch of bytes.
        """
        seg, rel = _starts(who, (self.left + self.right)[who], length)
        start = self.at[seg] - self.left[seg] + rel
        key = mix(span_hashes(self.prefix, start, start + length) * np.uint64(0xC2B2AE3D27D4EB4F) + (self.left[seg] - rel).astype(np.uint64))
        key = mix(key + self.group[seg].astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
        order = np.argsort(key, kind="stable")
        k = key[order]
        new = np.concatenate([[True], k[1:] != k[:-1]])
        run = np.flatnonzero(new)
        head = order[np.repeat(run, np.diff(np.append(run, len(k))))]
        first = np.empty(len(k), np.int64)
        first[order] = head  # by string, the first one with its hash
        other = np.flatnonzero(first != np.arange(len(k)))
        hit = np.zeros(len(k), bool)
        mine, theirs = start[other], start[first[other]]
        cut = np.flatnonzero(np.concatenate([[True], (mine[1:] != mine[:-1] + 1) | (theirs[1:] != theirs[:-1] + 1) | (seg[other[1:]] != seg[other[:-1]])])) if len(other) else ()
        for i, j in zip(cut, [*cut[1:], len(other)]):
            x, y, n = int(mine[i]), int(theirs[i]), int(j - i) + length - 1
            if self.data[x : x + n].tobytes() == self.data[y : y + n].tobytes():
                hit[other[i:j]] = hit[first[other[i:j]]] = True
            else:
                for q in range(i, j):
                    x, y = int(mine[q]), int(theirs[q])
                    if self.data[x : x + length].tobytes() == self.data[y : y + length].tobytes():
                        hit[other[q]] = hit[first[other[q]]] = True
        return _intervals(seg[hit], rel[hit])

    def repeated(self, length: int, most_strings: int = 300_000) -> tuple[np.ndarray, ...]:
        """(segment, lo, hi): starts lo .. hi of the segment begin strings that another segment of its group has too."""
        order = self.sorted()
        if len(order) < 2:
            return (np.zeros(0, np.int64),) * 3
        same = self.group[order[1:]] == self.group[order[:-1]]
        near = np.zeros(len(order) - 1, np.int64)
        near[same] = self.common(order[1:][same], order[:-1][same])
        most = np.zeros(len(order), np.int64)
        np.maximum.at(most, order[1:], near)
        np.maximum.at(most, order[:-1], near)
        who = np.flatnonzero(most + self.left >= length)
        if not len(who):
            return (np.zeros(0, np.int64),) * 3
        # Groups come one after the other: as many are taken together as have most_strings strings.
        upto = np.cumsum((self.left + self.right)[who] - length + 1)
        last = np.flatnonzero(np.append(self.group[who[1:]] != self.group[who[:-1]], True))
        out, at = [], 0
        while at < len(who):
            begun = upto[at - 1] if at else 0
            enough = last[min(np.searchsorted(upto[last], begun + most_strings), len(last) - 1)]
            end = int(max(enough, last[np.searchsorted(last, at)])) + 1
            out.append(self._strings(who[at:end], length))
            at = end
        return tuple(map(np.concatenate, zip(*out)))


def _starts(who: np.ndarray, size: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(segment, start) of every string of length in the segments who of these sizes."""
    count = size - length + 1
    return np.repeat(who, count), np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)


def _intervals(seg: np.ndarray, rel: np.ndarray) -> tuple[np.ndarray, ...]:
    """(segment, lo, hi) of runs of starts, which are in order within each segment."""
    if not len(seg):
        return (np.zeros(0, np.int64),) * 3
    cut = np.flatnonzero(np.concatenate([[True], (seg[1:] != seg[:-1]) | (rel[1:] != rel[:-1] + 1)]))
    return seg[cut], rel[cut], rel[np.append(cut[1:], len(seg)) - 1]


def _resolve(length: int, most_bytes: int = 24 << 20):
    """Repeated starts between different segments of equal anchors; rows come sorted by h."""

    def solve(groups: list[tuple[list[bytes], list[bytes], list[int]]]) -> Iterator[pa.RecordBatch]:
        digests = [d for g in groups for d in g[0]]
        s = Suffixes([p for g in groups for p in g[1]], np.array([x for g in groups for x in g[2]], np.int64), np.repeat(np.arange(len(groups)), [len(g[0]) for g in groups]))
        seg, lo, hi = s.repeated(length)
        for i in range(0, len(seg), 20_000):
            own = slice(i, i + 20_000)
            yield record(_HITS)([digests[k] for k in seg[own]], lo[own].astype(np.int32), hi[own].astype(np.int32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, size, last, now = [], 0, None, {}

        def close():
            if len(now) > 1:
                groups.append((list(now), *map(list, zip(*now.values()))))
                return sum(len(p) for p, _ in now.values())
            return 0

        for batch in batches:
            for h, digest, left, piece in zip(batch.column("h").to_pylist(), batch.column("digest").to_pylist(), batch.column("left").to_pylist(), batch.column("bytes").to_pylist()):
                if h != last:
                    size += close()
                    now, last = {}, h
                    if size > most_bytes // 8:
                        yield from solve(groups)
                        groups, size = [], 0
                now[digest] = (piece, left)
        close()
        if groups:
            yield from solve(groups)

    return run


_KEYS = pa.schema([("bucket", pa.int32()), ("digest", pa.binary()), ("lo", pa.int32()), ("hi", pa.int32()), ("keys", pa.binary())])
_KEYS_SQL = "bucket int, digest binary, lo int, hi int, keys binary"
#: A string of a segment: two hashes, the segment's digest, the start, and whether its task holds it in two segments.
_STRING = np.dtype([("x", "<u8"), ("y", "<u8"), ("d", "<u8"), ("e", "<u8"), ("rel", "<i4"), ("twice", "<i4")])


def _shared(strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For strings sorted by both hashes: where runs of equal ones start, and which runs are in two segments."""
    first = np.flatnonzero(np.concatenate([[True], (strings["x"][1:] != strings["x"][:-1]) | (strings["y"][1:] != strings["y"][:-1])])) if len(strings) else np.zeros(0, np.int64)
    head = np.repeat(first, np.diff(np.append(first, len(strings))))
    differs = (strings["d"] != strings["d"][head]) | (strings["e"] != strings["e"][head]) | (strings["twice"] > 0)
    return first, np.logical_or.reduceat(differs, first) if len(first) else np.zeros(0, bool)


def _found(strings: np.ndarray):
    """(digest, lo, hi) of the runs of starts of each segment."""
    strings = strings[np.lexsort((strings["rel"], strings["e"], strings["d"]))]
    names = np.column_stack([strings["d"], strings["e"]])
    seg = np.cumsum(np.concatenate([[False], (names[1:] != names[:-1]).any(axis=1)])) if len(names) else np.zeros(0, np.int64)
    one = np.flatnonzero(np.concatenate([[True], (seg[1:] != seg[:-1]) | (strings["rel"][1:] != strings["rel"][:-1])])) if len(seg) else np.zeros(0, np.int64)
    which, lo, hi = _intervals(seg[one], strings["rel"][one].astype(np.int64))
    at = np.searchsorted(seg, which)
    return [names[i].tobytes() for i in at], lo.astype(np.int32), hi.astype(np.int32)


def _spread_strings(length: int, n: int, most_bytes: int = 1 << 20):
    """The strings of segments of hot anchors, dealt over buckets by hash, and what a task finds repeated by itself.

    A string that a task holds in two segments is found at once and sent on once, however many segments hold it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, held, size = record(_KEYS), {}, 0

        def flush():
            pieces = [p for p, _, _ in held.values()]
            data = np.frombuffer(b"".join(pieces), np.uint8)
            sizes = np.array([len(p) for p in pieces], np.int64)
            seg, rel = _starts(np.arange(len(pieces)), sizes, length)
            start = (np.cumsum(sizes) - sizes)[seg] + rel
            left, anchor = (np.array([x[i] for x in held.values()], np.int64)[seg] for i in (1, 2))
            salt = mix(anchor.astype(np.uint64) + (left - rel).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
            strings = np.zeros(len(seg), _STRING)
            strings["x"] = mix(span_hashes(prefix_hashes(data), start, start + length) + salt)
            second = np.zeros(len(data) + 1, np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data), _SECOND), out=second[1:])
            strings["y"] = mix((second[start + length] - second[start]) * powers(len(second), _SECOND_INVERSE)[start] + salt)
            names = np.frombuffer(b"".join(held), "<u8").reshape(-1, 2)
            strings["d"], strings["e"], strings["rel"] = names[seg, 0], names[seg, 1], rel
            strings = strings[np.lexsort((strings["y"], strings["x"]))]
            first, shared = _shared(strings)
            again = np.repeat(shared, np.diff(np.append(first, len(strings))))
            for digest, lo, hi in zip(*_found(strings[again])):
                yield (-1, digest, lo, hi, None)
            sent = strings[first]
            sent["twice"] = shared
            bucket = ((sent["x"] >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
            cuts = np.searchsorted(bucket, np.arange(n + 1, dtype=np.uint64))
            for b in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
                yield (b, None, None, None, sent[cuts[b] : cuts[b + 1]].tobytes())

        def batched():
            rows = list(flush())
            for i in range(0, len(rows), 5000):
                yield make(*map(list, zip(*rows[i : i + 5000])))

        for batch in batches:
            for h, digest, left, piece in zip(batch.column("h").to_pylist(), batch.column("digest").to_pylist(), batch.column("left").to_pylist(), batch.column("bytes").to_pylist()):
                if digest not in held:
                    held[digest] = (piece, left, h)
                    size += len(piece)
                    if size >= most_bytes:
                        yield from batched()
                        held, size = {}, 0
        if held:
            yield from batched()

    return run


def _meet_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The strings of a bucket that two segments hold."""
    held = [np.frombuffer(k.as_buffer(), _STRING) for batch in batches for k in batch.column("keys")]
    if held:
        strings = np.concatenate(held)
        strings = strings[np.lexsort((strings["y"], strings["x"]))]
        first, shared = _shared(strings)
        digest, lo, hi = _found(strings[np.repeat(shared, np.diff(np.append(first, len(strings))))])
        for i in range(0, len(digest), 20_000):
            yield record(_HITS)(digest[i : i + 20_000], lo[i : i + 20_000], hi[i : i + 20_000])


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, rows = record(_KEPT), []
        for batch in batches:
            for key, text, hits in zip(batch.column("text_key").to_pylist(), batch.column("text"), batch.column("hits")):
                raw = text.as_buffer().to_pybytes()
                v = hits.values
                spans: list[list[int]] = []
                for a, b in sorted(zip(v.field("lo").to_pylist(), v.field("hi").to_pylist())):
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], b + length)
                    else:
                        spans.append([a, b + length])
                kept, at = hashlib.sha256(), 0
                for a, b in spans:
                    kept.update(raw[at:a])
                    at = b
                kept.update(raw[at:])
                rows.append((key, sum(b - a for a, b in spans), len(spans), kept.hexdigest(), [x for s in spans for x in s]))
                if len(rows) >= 5000:
                    yield make(*map(list, zip(*rows)))
                    rows = []
        if rows:
            yield make(*map(list, zip(*rows)))

    return run


def remove_repeats(docs: DataFrame, length: int = 400, gram: int = 64, group_segments: int = 2048) -> DataFrame:
    """Bytes covered by strings of length bytes that also start elsewhere, in any text or the same one.

    A row per row of docs (doc_id, text; other columns are ignored): doc_id, n_bytes, n_removed, n_spans (maximal removed
    runs), kept_sha256 (of the bytes left), spans (removed runs as start, end, start, end, ...). Strings are judged on the
    input and don't cross texts. Null text is empty; shorter texts lose nothing; repeated rows are copies of each other
    (all removed if long enough); null ids are treated like any other; an empty table gives no rows. A task sorts at most
    group_segments segments of one anchor together; those of anchors with more are compared string by string over all tasks.
    """
    if not 8 <= gram <= length:
        raise ValueError("8 <= gram <= length")
    spark = docs.sparkSession
    n = partitions(spark)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = F.octet_length("text").cast("long")
    facts = stored(plain.select("doc_id", F.xxhash64("text").alias("text_key"), size.alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("sha")), "texts")
    long_ = plain.where(size >= length).withColumn("text_key", F.xxhash64("text"))
    blobs = long_.select("text", "text_key").mapInArrow(_anchor_blobs(length, gram, n), "bucket int, h binary, text binary, span binary")
    runs = stored(dealt(blobs, "bucket", n).mapInArrow(_repeated_runs, _RUNS_SQL), "runs")
    per_text = runs.groupBy("text_key").agg(F.collect_list(F.struct("h", "a", "b", "m")).alias("runs"))
    copies = facts.groupBy("sha", "n_bytes").agg(F.count("*").alias("copies"), F.min("doc_id").alias("holder"), F.first("text_key").alias("text_key"))
    wanted = per_text.join(copies.select("text_key", "holder"), "text_key")
    # By text and holder: the copies of a text don't meet.
    held = stored(long_.join(wanted.withColumnRenamed("text_key", "key"), (F.col("text_key") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("holder"))).select("text_key", "text", "runs"), "held")
    segments = stored(held.select("text_key", F.col("text").cast("binary").alias("text"), "runs").mapInArrow(_segments(length), _SEGMENTS_SQL), "segments")
    sent = segments.where("bytes is not null").select("h", "digest", "left", "bytes")
    many = sent.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > group_segments).select("h")
    many = stored(many, "hot-anchors")
    hits = sent.join(many, "h", "left_anti").repartition(n, "h").sortWithinPartitions("h").mapInArrow(_resolve(length), "digest binary, lo int, hi int")
    spread = stored(sent.join(many, "h", "left_semi").mapInArrow(_spread_strings(length, n), _KEYS_SQL), "hot-strings")
    met = dealt(spread.where("bucket >= 0").select("bucket", "keys"), "bucket", n).mapInArrow(_meet_strings, "digest binary, lo int, hi int")
    hits = stored(hits.union(spread.where("bucket < 0").select("digest", "lo", "hi")).union(met), "hits")
    # A segment may stand in a third of all texts: its places get salts, and what is known of it comes back to each salt.
    places = segments.select("digest", "text_key", "a", "starts", F.pmod(F.xxhash64("text_key"), F.lit(n)).alias("salt"))
    salted = stored(places.groupBy("digest", "salt").agg(F.count("*").alias("n")), "places")
    whole = salted.groupBy("digest").agg(F.sum("n").alias("all")).where("all > 1").select("digest")
    full = places.join(salted.join(whole, "digest").select("digest", "salt"), ["digest", "salt"]).select("text_key", F.col("a").alias("lo"), (F.col("a") + F.col("starts")).alias("hi"))
    part = places.join(salted.select("digest", "salt").join(hits, "digest"), ["digest", "salt"]).select("text_key", (F.col("a") + F.col("lo")).alias("lo"), (F.col("a") + F.col("hi")).alias("hi"))
    spans = full.union(part).groupBy("text_key").agg(F.collect_set(F.struct("lo", "hi")).alias("hits"))
    single = copies.where("copies = 1").select("text_key")
    cut = held.select("text_key", F.col("text").cast("binary").alias("text")).join(spans, "text_key").join(single, "text_key", "left_semi").select("text_key", "text", "hits")
    kept = cut.mapInArrow(_cut(length), "text_key long, n_removed long, n_spans long, kept_sha256 string, spans array<long>").withColumn("single", F.lit(True))
    marked = looked_up(facts, copies.select("sha", "n_bytes", "copies"), ["sha", "n_bytes"], ["doc_id"])
    out = marked.join(kept, (marked["text_key"] == kept["text_key"]) & (F.col("copies") == 1), "left").drop(kept["text_key"])
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    pick = lambda all_, some, none, name: F.when(gone, all_).when(F.col("single"), some).otherwise(none).alias(name)
    zero = F.lit(0).cast("long")
    return out.select(
        "doc_id",
        "n_bytes",
        pick(F.col("n_bytes"), F.col("n_removed"), zero, "n_removed"),
        pick(F.lit(1).cast("long"), F.col("n_spans"), zero, "n_spans"),
        pick(F.lit(hashlib.sha256(b"").hexdigest()), F.col("kept_sha256"), F.col("sha"), "kept_sha256"),
        pick(F.array(zero, F.col("n_bytes")), F.col("spans"), F.array().cast("array<long>"), "spans"),
    )
