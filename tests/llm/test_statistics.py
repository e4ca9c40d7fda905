"""Document statistics, the quality model and the rule forest."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from weftline.llm.common import chunks
from weftline.llm.quality_model import classify, keep_good
from weftline.llm.rule_forest import BASE, apply_rules
from weftline.llm.textstats import statistics


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = {i + k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def test_base_counts_match_brute_force():
    rng = random.Random(5)
    texts = [None, "", "\n", " \n\n x\nx\n", "é à\nb é à b\n", "a b c d e a b c d e", "A b c d e a b c d e", "a b c d e x A b c d e a b c d e"]
    texts += ["".join(rng.choice(["ab", "Ab", "c", "é", " ", " ", "\n", "#", "<", "\t", "日本"]) for _ in range(rng.randrange(300))) for _ in range(200)]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts)})
    for limit in (64, 1 << 20):
        got = [row for _, d, b in chunks([batch], limit=limit) for row in zip(*(statistics(d, b)[k].tolist() for k in BASE))]
        assert got == [brute(t) for t in texts]


def corpus(n=400):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        words = ["".join(rng.choice("etaoinshr") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(30, 200))]
        text = " ".join(words) + "." if good else " ".join(w.upper() + "!!" for w in words)
        rows.append((i, text, "en", 0.5))
        if i % 2 == 0 or i % 3 == 0:
            labels.append((i, int(good), 0))
    return rows + [(n, None, None, None), (n + 1, "", "", 0.0), (None, "some words are here", "x", 1.0)], labels + [(None, 1, 0), (5, None, None)]


def test_quality_and_rules(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, x double")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in classify(docs, marks).collect()}
    assert len(out) == len(rows)
    held = [r for i, r in out.items() if i is not None and i < 400 and r.held_out]
    assert held and np.mean([r.predicted == int(r.doc_id % 4 != 0) for r in held]) > 0.97
    kept = {r.doc_id for r in keep_good(docs, marks).collect()}
    assert {i for i, r in out.items() if i is not None and r.predicted == 1} <= kept
    rules = {r.doc_id: r for r in apply_rules(docs, marks).collect()}
    clean = [i for i in range(400) if i % 4]
    assert sum(rules[i].kept for i in clean) >= 0.97 * len(clean)
    assert sum(rules[i].kept for i in range(0, 400, 4)) <= 20
    assert rules[400].base_failed and not rules[400].kept
    none = spark.createDataFrame([], docs.schema)
    assert classify(none, marks).count() == 0 and apply_rules(none, marks).count() == 0
    # Labels that tell nothing: nothing is rejected.
    for few in (marks.limit(0), marks.where("quality = 1"), marks.where("doc_id = 0")):
        assert {(r.score, r.predicted) for r in classify(docs, few).collect()} == {(0.5, 1)}
        assert keep_good(docs, few).count() == len(rows)
    assert apply_rules(docs, marks.limit(0)).where("kept and base_failed or not kept and not base_failed").count() == 0
    assert keep_good(none, marks).count() == 0
