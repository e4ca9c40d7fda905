"""Planted exact, edited and partial passages."""

import math
import random
from collections import Counter

import pytest

from weftline.llm.decontam import drop_leaked, find_leaks, item_masks, lcs, words_of


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_lcs():
    rng = random.Random(1)
    for _ in range(200):
        a, b = (words_of([" ".join(rng.choices("abcdef", k=rng.randrange(1, 80)))])[0] for _ in "ab")
        assert lcs(item_masks(a), len(a), b.tolist()) == slow_lcs(a.tolist(), b.tolist())


def test_planted(spark):
    rng = random.Random(2)
    common = ["the", "of", "and", "to", "in"]
    word = lambda: rng.choice(common) if rng.random() < 0.4 else "".join(rng.choices("etaoinshrdlu", k=rng.randrange(3, 9)))
    prose = lambda n: [word() for _ in range(n)]
    items = [prose(rng.choice([16, 25, 40, 59, 150])) for _ in range(30)]
    docs, want = [], set()
    for i in range(300):
        text = prose(rng.randrange(20, 600))
        if i % 5 == 0:
            k = rng.randrange(30)
            leak = list(items[k])
            if i % 10 == 0:  # a paraphrase: every seventh word replaced or dropped
                leak = [w if j % 7 else rng.choice(["", word()]) for j, w in enumerate(leak)]
            at = rng.randrange(len(text))
            text[at:at] = leak
            want.add((i, k))
        elif i % 5 == 1:  # a fragment is no leak
            text[5:5] = items[i % 30][: len(items[i % 30]) // 3]
        docs.append((i, " ".join(text).replace("the", "THE"), 1.0))
    docs += [(900, None, None), (901, "", 0.0), (3, docs[3][1], 0.0)]
    bench = [(k, " ".join(x), "x") for k, x in enumerate(items)] + [(99, None, None), (98, "", "")]
    d = spark.createDataFrame(docs, "doc_id long, text string, cosine double")
    b = spark.createDataFrame(bench, "item_id long, text string, cosine string")
    for block in (4096, 12):
        assert {(r.doc_id, r.item_id) for r in find_leaks(d, b, block_items=block).collect()} == want
    kept = drop_leaked(d, b)
    assert kept.columns == d.columns and kept.count() == len(docs) - len({i for i, _ in want})
    assert find_leaks(d.limit(0), b).count() == 0 and find_leaks(d, b.limit(0)).count() == 0


def test_items_of_common_words(spark):
    """Items whose copies are so many that all their words are common: in every item, and beside items of rare words."""
    rng = random.Random(4)
    new = lambda n: ["".join(rng.choices("etaoinshrdlu", k=9)) for _ in range(n)]
    hot, rare = new(20), new(30)
    edited = [w if j % 5 else "other" for j, w in enumerate(hot)]
    docs, want = [], {}
    for i in range(120):
        text = new(30)
        if i % 3 == 0:
            text[9:9] = edited if i % 2 else hot
            want[i, 0] = 0.8 if i % 2 else 1.0
        elif i % 3 == 1:  # all its words, in no order
            text[9:9] = rng.sample(hot, 20)
        if i == 7:
            text[40:40] = rare
        if i == 6:  # beside rare words of another item
            text[9:9], text[29:29] = rare[:8], rare[8:15]
        docs.append((i, " ".join(text)))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    found = lambda *items: {(r.doc_id, r.item_id): round(r.lcs, 6) for r in find_leaks(d, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert found((0, " ".join(hot))) == want
    assert found((0, " ".join(hot)), (1, " ".join(rare))) == want | {(7, 1): 1.0}
    kept = drop_leaked(d, spark.createDataFrame([(0, " ".join(hot))], "item_id long, text string"))
    assert kept.count() == 120 - len(want)


@pytest.mark.parametrize("rows, copies", [(40, 20), (1, 1), (3, 3)])
def test_copies_that_most_documents_hold(spark, rows, copies):
    rng = random.Random(rows)
    new = lambda n: ["".join(rng.choices("etaoinshrdlu", k=7)) for _ in range(n)]
    item = " ".join(new(30))
    docs = [(i, item if i < copies else " ".join(new(60))) for i in range(rows)]
    got = find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(5, item)], "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id, r.lcs) for r in got) == [(i, 5, 1.0) for i in range(copies)]


def test_paraphrases_against_exhaustive_search(spark):
    """Every stretch of item length / 0.6 words is tried; 0.9 of the pairs so found must be found, and nothing that no stretch shows."""
    rng = random.Random(12)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randrange(3, 8))) for _ in range(3000)]
    weights = [1 / (i + 3) for i in range(len(words))]  # few words are a good part of all
    word = lambda: rng.choices(words, weights)[0]
    prose = lambda n: [word() for _ in range(n)]
    items = [prose(rng.randrange(14, 60)) for _ in range(25)]
    docs = []
    for i in range(250):
        text = prose(rng.randrange(100, 900))
        for k in rng.sample(range(25), 2):
            share = rng.choice([0.0, 0.1, 0.2, 0.3, 0.38, 0.5])
            leak = [w if rng.random() >= share else rng.choice(["", word()]) for w in items[k]]
            at = rng.randrange(len(text))
            text[at:at] = leak
        docs.append((i, " ".join(text)))
    got = {(r.doc_id, r.item_id): r for r in find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")).collect()}
    coded, best, df = [x.tolist() for x in words_of([t for _, t in docs])], {}, Counter()
    for text in coded:
        for a in range(0, len(text), 64):
            df.update(set(text[a : a + 64]))
    for k, item in enumerate(words_of([" ".join(x) for x in items])):
        masks, n = item_masks(item), len(item)
        span = math.ceil(n / 0.6)
        rarer = set(sorted(masks, key=lambda w: (df[w], w))[: -(-len(masks) // 2)])
        for i, text in enumerate(coded):
            hits = [(p, w) for p, w in enumerate(text) if w in masks]
            for a, (p, _) in enumerate(hits):
                region = [w for q, w in hits[a : a + span] if q < p + span]
                if len(region) >= 0.6 * n and len(rarer.intersection(region)) >= 0.5 * len(rarer):
                    best[i, k] = max(best.get((i, k), 0), lcs(masks, n, region) / n)
    want = {key for key, share in best.items() if share >= 0.6}
    assert len(want) > 250 and len(want & set(got)) >= 0.9 * len(want)
    for i, k in set(got) - want:  # found in a wider region than the stretches
        assert slow_lcs(words_of([" ".join(items[k])])[0].tolist(), coded[i]) >= 0.6 * len(items[k])
    print("recall", len(want & set(got)) / len(want), "beyond", len(set(got) - want))
