"""Jaccard join against brute force, with small tiles so that components span several."""

import random
import re

from weftline.llm import jaccard_join as module
from weftline.llm.jaccard_join import jaccard_join, keep_representatives

SCHEMA = "doc_id long, text string, class string, n long"


def shingles(text, width):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())


def brute(rows, width, num, den):
    sets = [shingles(t, width) for _, t, *_ in rows]
    comp, links = list(range(len(rows))), [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                a, b = comp[i], comp[j]
                comp = [b if c == a else c for c in comp]
    least = {}
    for c, r in zip(comp, rows):
        if r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    return sorted(((r[0], len(s), least.get(c) if s else r[0], n) for r, s, c, n in zip(rows, sets, comp, links)), key=str)


def make(seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(6):
        base = [rng.choice(vocab) for _ in range(rng.choice([2, 12, 40, 90, 200]))]
        for _ in range(rng.choice([1, 5, 40])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2])):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((len(rows) * 7 % 1009, " ".join(w).upper() if rng.random() < 0.2 else "\t".join(w), "x", 1))
    return rows + [(5000, None, None, None), (5001, "", "", 0), (5002, " \n ", "", 0), (None, "lone words here", "c", 1), (5003, "LONE words here", "c", 1), (5003, "lone words here", "c", 1), (5004, "İ ß one", "c", 1)]


def test_matches_brute_force(spark):
    for seed, width, num, tile in ((2, 3, 90, 8), (3, 5, 80, 256)):
        rows = make(seed)
        got = jaccard_join(spark.createDataFrame(rows, SCHEMA), width, num, 100, tile, 3000)
        assert sorted(map(tuple, got.collect()), key=str) == brute(rows, width, num, 100)


def test_empty_table_and_representatives(spark):
    assert jaccard_join(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = make(4)
    kept = {r.doc_id for r in keep_representatives(spark.createDataFrame(rows, SCHEMA), width=3, num=90, den=100).collect()}
    assert kept == {i for i, _, c, _ in brute(rows, 3, 90, 100) if i is None or c == i or c is None}


def test_common_passages_make_no_large_tiles(spark):
    """Different texts that share a passage: no more texts come to the tiles than the near copies among them."""
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join([f"w{rng.randrange(10**9)}" for _ in range(40)] + passage), "x", 1) for i in range(300)]
    rows += [(1000 + i, t + " end", c, n) for i, t, c, n in rows[:20]]
    sizes = {}
    keep = module.stored
    module.stored = lambda df, name: (out := keep(df, name), sizes.update({name: out.count()}))[0]
    try:
        got = jaccard_join(spark.createDataFrame(rows, SCHEMA), 5, 80, 100, 16, 3000)
        assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 5, 80, 100)
    finally:
        module.stored = keep
    assert sizes["links"] == 40
