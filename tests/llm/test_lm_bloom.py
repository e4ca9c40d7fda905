"""Base scores against brute force, and the filter's counts against exact ones."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from weftline.llm.lm_bloom import Filter, levels, lm_scores


def words(text):
    return [x.translate({c: c + 32 for c in range(65, 91)}) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")] + [None]


def test_scores(spark):
    rng = random.Random(3)
    vocab = ["w%d" % i for i in range(300)]
    rows = [(i, " ".join(rng.choices(vocab, [1 / (k + 1) for k in range(300)], k=rng.randrange(40))).title(), "x") for i in range(300)]
    rows += [(300, None, None), (301, "", ""), (None, "w1 w2 unseen", "c"), (7, "again W1", "d")]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    count = Counter(w for i, t, _ in rows if not held(i) for w in words(t))
    n, v = sum(count.values()), len(count)
    want = sorted(((i, held(i), len(w), sum(count[x] > 0 for x in w), n, round(sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 6)) for i, t, _ in rows for w in [words(t)]), key=str)
    for head in (1 << 18, 20, 0):
        out = lm_scores(spark.createDataFrame(rows, "doc_id long, text string, score string"), head_words=head).collect()
        assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out), key=str) == want
        assert all(r.score < 0 for r in out)
    # The bigram model predicts natural order of a repeated text better than the unigram base.
    rows = [(i, "alpha beta gamma delta epsilon zeta " * 5, "x") for i in range(20)]
    out = lm_scores(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert all(r.score > r.base_score for r in out)
    assert lm_scores(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_filter_keeps_levels():
    from weftline.llm.lm_bloom import _word_mask, entry_hash

    rng = np.random.default_rng(1)
    keys, counts = rng.integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2), rng.geometric(0.2, 5000)
    n, top = 1, levels(counts)
    seg = np.zeros(5000 * 4 * 10 // 64, np.uint64)
    for level in range(1, top.max() + 1):
        at, mask = _word_mask(entry_hash(keys[top >= level], 1, level), np.uint64(len(seg)))
        np.bitwise_or.at(seg, at.astype(np.int64), mask)
    got = Filter({0: seg.tobytes()}, n).count(keys, 1)
    assert (got >= np.where(top <= 1, top, 0.75 * 2.0**top)).all()
    assert np.mean(got == np.where(top <= 1, top, 0.75 * 2.0**top)) > 0.9


def test_scores_do_not_depend_on_the_filter_held_at_once(spark):
    rng = random.Random(5)
    rows = [(i, " ".join("v%d" % rng.randrange(3000) for _ in range(rng.randrange(60)))) for i in range(400)] + [(None, None), (400, "")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = [sorted(((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in lm_scores(d, max_filter_bytes=b).collect()), key=str) for b in (1 << 30, 1, 12000)]
    assert len(got[0]) == len(rows) and got[1] == got[0] and got[2] == got[0]
