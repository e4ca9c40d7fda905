"""Repeated strings against brute force over all positions."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from weftline.llm.suffix_dedup import Suffixes, _anchor_blobs, remove_repeats


def brute(rows, length):
    raws = [(t or "").encode() for _, t, *_ in rows]
    count = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for (doc, *_), r in zip(rows, raws):
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - length + 1):
            if count[r[i : i + length]] > 1:
                gone[i : i + length] = True
        gone = gone[:-1]
        kept = bytes(x for x, g in zip(r, gone) if not g)
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((doc, len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def make(seed):
    rng = random.Random(seed)
    noise = lambda n: "".join(rng.choices("abcdé 日\n", k=n))
    shared = [noise(rng.randrange(20, 200)) for _ in range(5)]
    rows = []
    for i in range(110):
        t = noise(rng.randrange(120))
        for _ in range(rng.randrange(3)):
            s = rng.choice(shared)
            a = rng.randrange(len(s))
            t += s[a : a + rng.randrange(len(s))] + noise(rng.randrange(30))
        if rng.random() < 0.9:
            t += shared[0][:60]  # a passage that most texts hold, in different surroundings
        rows.append((i, t, "x", 2))
    return rows + [(200, rows[3][1], "y", 1), (None, rows[4][1] + "z", "y", 1), (201, None, None, None), (202, "", "", 0), (203, "ab" * 200, "p", 1), (204, "a" * 300, "p", 1), (7, rows[7][1], "x", 2)]


def test_matches_brute_force(spark):
    for seed, length, gram, most in ((1, 40, 16, 4096), (2, 48, 8, 4), (3, 40, 16, 1)):
        rows = make(seed)
        docs = spark.createDataFrame(rows, "doc_id long, text string, text_key string, n_bytes long")
        out = remove_repeats(docs, length, gram, most).collect()
        assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out), key=str) == brute(rows, length)
        assert all(sum(r.spans[1::2]) - sum(r.spans[::2]) == r.n_removed for r in out)
    assert remove_repeats(docs.limit(0)).collect() == []


def test_mergesort_orders_suffixes():
    rng = random.Random(4)
    pieces = [bytes(rng.choices(b"ab", k=rng.randrange(3, 30))) for _ in range(300)]
    left = np.array([rng.randrange(len(p)) for p in pieces])
    group = np.sort(np.array([rng.randrange(20) for _ in pieces]))
    got = Suffixes(pieces, left, group).sorted().tolist()
    assert [(group[i], pieces[i][left[i] :]) for i in got] == sorted((group[i], pieces[i][left[i] :]) for i in range(300))


def test_repeated_starts_of_groups_in_blocks_of_any_size():
    rng = random.Random(5)
    for _ in range(20):
        shared = [bytes(rng.choices(b"ab", k=60)) for _ in range(6)]
        pieces, left, group = [], [], []
        for g in range(12):
            for _ in range(rng.randrange(1, 9)):
                before = bytes(rng.choices(b"ab", k=rng.randrange(0, 9)))
                pieces.append(before + rng.choice(shared) + bytes(rng.choices(b"ab", k=5)))
                left.append(len(before) + 10)
                group.append(g)
        seen = {}
        for i, p in enumerate(pieces):
            for s in range(len(p) - 39):
                seen.setdefault((group[i], s - left[i], p[s : s + 40]), set()).add(i)
        want = {(i, offset + left[i]) for (_, offset, _), who in seen.items() if len(who) > 1 for i in who}
        for most in (1, 50, 300_000):
            got = {(i, s) for i, lo, hi in zip(*(v.tolist() for v in Suffixes(pieces, np.array(left), np.array(group)).repeated(40, most))) for s in range(lo, hi + 1)}
            assert got == want


def test_anchors_spread_over_buckets():
    rng = np.random.default_rng(6)
    texts = ["".join(map(chr, rng.integers(97, 123, 4000))) for _ in range(100)]
    rows = pa.RecordBatch.from_pydict({"text": texts, "text_key": range(100)})
    sizes = np.zeros(20, np.int64)
    for blob in _anchor_blobs(400, 64, 20)(iter([rows])):
        for b, h in zip(blob.column("bucket").to_pylist(), blob.column("h").to_pylist()):
            sizes[b] += len(h) // 8
    assert sizes.sum() > 2000
    assert sizes.max() < 2 * sizes.mean()


def test_planted_passages_of_over_50_words(spark):
    """Passages in two texts each, of 60 words: those of 400 bytes are removed, those of 399 are not."""
    rng = random.Random(7)
    word = lambda k: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=k))
    prose = lambda: " ".join(word(rng.randrange(2, 9)) for _ in range(150))
    rows, want = [], {}
    for i in range(20):
        passage = " ".join([*(word(5) for _ in range(59)), word(46 - i % 2)])
        for doc in (2 * i, 2 * i + 1):
            edge = "!?"[doc % 2]  # what stands before and after differs, so the passage alone repeats
            rows.append((doc, f"{prose()}{edge}{passage}{edge}{prose()}"))
            want[doc] = 0 if i % 2 else 400
    rows += [(doc, prose()) for doc in range(40, 60)]
    out = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_removed for r in out} == want | dict.fromkeys(range(40, 60), 0)
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out), key=str) == brute(rows, 400)
