"""Secret scan against plain Python: base spans, p-values of the battery, planted random strings, redaction."""

import hashlib
import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from weftline.llm import secrets

PATTERNS = (
    ("assign", re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII), 2, 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile("[0-9a-f]+"), 0, 24),
)
SCHEMA = "doc_id long, text string, spans int, _weft int"
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def base(text):
    found = []
    for rank, (kind, pattern, group, least) in enumerate(PATTERNS):
        found += [(m.start(), rank, m.end(), kind) for m in pattern.finditer(text or "") if len(m.group(group)) >= least]
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted(found)]


def messy(rng):
    pieces = ["password", "PassWd", "secret", "ToKen", "api_key", "APIKEY", '"', "'", " ", "  ", ":", "=", "==", "\n", "\t", "é", "😀", "ſecret", "toKen", "AKIA", "AKIAAKIA", "hunter2", "x", "a-b_c.d/e", "AKIA" + "Z9" * 9, "0f" * 12, "0f" * 11 + "a", "deadBEEF" * 5, "f" * 23 + "g", "A" * 19]
    return "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 60)))


def test_base_spans_match_plain_regular_expressions(spark):
    rng = random.Random(5)
    rows = [(i, messy(rng), 1, 1) for i in range(400)]
    rows += [(400, None, None, None), (401, "", 0, 0), (None, "token=abcdef", 0, 0), (402, "token=abcdef", 0, 0), (402, "token=abcdef", 0, 0), (403, "password : 'abcde' password=abcdefg", 0, 0), (404, "é😀" * 50_000 + "api_key=" + "0a" * 15, 0, 0)]
    got = secrets.secret_report(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    want = sorted(((i, hashlib.sha256(",".join(base(t)).encode()).hexdigest(), *(sum(x.startswith(k) for x in base(t)) for k in ("assign", "access", "hex"))) for i, t, *_ in rows), key=str)
    assert sorted(((r.doc_id, r.base_sha256, r.n_assign, r.n_access, r.n_hex) for r in got), key=str) == want
    texts = {i: t for i, t, *_ in rows}
    for r in got:
        spans = r.spans.split(",") if r.spans else []
        assert [x for x in spans if not x.startswith("random")] == base(texts[r.doc_id])
        assert len(spans) == r.n_assign + r.n_access + r.n_hex + r.n_random


def tail(z):
    return math.erfc(z / math.sqrt(2)) / 2


def p_value(text, symbols):
    v = [symbols.index(c) for c in text]
    n, k = len(v), len(symbols)
    chi = sum((v.count(s) - n / k) ** 2 for s in range(k)) * k / n
    df = k - 1
    p = [tail(((max(chi, 1e-9) / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))]
    upper = [2 * x >= k for x in v]
    runs, one = sum(a != b for a, b in zip(upper, upper[1:])) + 1, sum(upper)
    mean = 2 * one * (n - one) / n + 1
    p.append(2 * tail(abs(runs - mean) / math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-9))))
    m = sum(v) / n
    var = sum((x - m) ** 2 for x in v)
    corr = sum((x - m) * (y - m) for x, y in zip(v, v[1:] + v[:1])) / var if var else 1.0
    p.append(2 * tail(abs((corr + 1 / (n - 1)) / math.sqrt(n * (n - 3) / ((n + 1) * (n - 1) ** 2)))))
    x = -sum(math.log(min(max(q, 1e-12), 1.0)) for q in p)
    return math.exp(-x) * (1 + x + x * x / 2)


def test_battery_matches_plain_loops(spark):
    rng = random.Random(6)
    cases = []
    for name, _, k, least in secrets.ENCODINGS:
        for n in (least, least + 9, 90, 400):
            cases.append((name, "".join(rng.choices(secrets.SYMBOLS[name], k=n))))
        cases.append((name, (secrets.SYMBOLS[name] * 40)[: 3 * k]))
    texts = [t for _, t in cases]
    found = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = secrets.annotate(found).select("doc_id", F.explode("_weft_tested").alias("c")).collect()
    seen = set()
    for r in rows:
        t, e = texts[r.doc_id], r.c.e
        t = t.translate(str.maketrans("+/", "-_")) if e == "base64" else t.lower() if e in ("hex", "letters26", "base36") else t
        assert r.c.p == pytest.approx(p_value(t, secrets.SYMBOLS[e]), abs=2e-3)
        seen.add(e)
    assert seen == {name for name, *_ in secrets.ENCODINGS}


def planted():
    """Prose with long identifiers of words and digits, and in every fifth text a random key."""
    rng = random.Random(7)
    rows, keys = [], {}
    words = ["".join(rng.choices(LETTERS[:12], k=rng.randrange(3, 8))) for _ in range(60)]
    for i in range(300):
        w = [rng.choice(words) for _ in range(40)]
        w.insert(9, "_".join(rng.choices(words, k=5)) + f"_{i % 10}")
        if i % 5 == 0:
            keys[i] = "".join(rng.choices(secrets.SYMBOLS["base64"][:62], k=43)) + "7"
            w.insert(25, keys[i])
        rows.append((i, " ".join(w)))
    return rows, keys


def test_random_keys_are_found_and_prose_is_left(spark):
    rows, keys = planted()
    hits, wrong = 0, 0
    for r in secrets.secret_report(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        text = rows[r.doc_id][1]
        for x in filter(None, r.spans.split(",")):
            _, s, e = x.split(":")
            good = text[int(s) : int(e)] == keys.get(r.doc_id)
            hits, wrong = hits + good, wrong + (not good)
    assert hits >= 0.85 * len(keys) and wrong <= 0.05 * len(rows)


def test_redaction_replaces_spans_and_keeps_the_rest(spark):
    rows = [(1, "a token=abcdefgh b", 7, None), (2, None, None, 2), (3, "", 0, 0), (4, "plain é😀 text", 1, 1), (5, "é😀 secret=" + "0a" * 15 + " end", 1, 1)]
    out = secrets.redact(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "text", "spans", "_weft"]
    assert {tuple(r) for r in out.collect()} == {(1, "a [SECRET] b", 7, None), rows[1], rows[2], rows[3], (5, "é😀 [SECRET] end", 1, 1)}


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert secrets.secret_report(none).collect() == [] and secrets.redact(none).collect() == []


def test_many_matches_and_long_candidates(spark):
    """Thousands of spans in a text and a candidate of a million characters, in seconds and as plain Python has them."""
    rng = random.Random(8)
    many = " ".join(rng.choice(["token=abcdefgh", "é x", "AKIA" + "Q7" * 9, "api_key: password=" + "0b" * 13]) for _ in range(6000))
    long_ = "".join(rng.choices(secrets.SYMBOLS["base64"], k=1_000_000))
    rows = [(1, many), (2, f"data:{long_} end"), (3, "x" * 300_000)]
    began = time.time()
    got = {r.doc_id: r for r in secrets.secret_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert time.time() - began < 60
    assert got[1].spans.split(",") == base(many)
    assert got[2].spans == f"random:5:{5 + len(long_)}" and got[3].spans == ""
    out = {r.doc_id: r.text for r in secrets.redact(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want, at = [], 0
    for _, s, e in (x.split(":") for x in base(many)):
        if int(s) >= at:
            want += [many[at : int(s)], "[SECRET]"]
        at = max(at, int(e))
    assert out[1] == "".join(want) + many[at:]
    assert out[2] == "data:[SECRET] end" and out[3] == rows[2][1]


def test_recall_by_encoding(spark):
    """Random strings of each encoding among words; no stratum is so small that its keys are lost."""
    rng = random.Random(9)
    rows, keys = [], {}
    for name, _, _, least in secrets.ENCODINGS:
        for i in range(12):
            key = "".join(rng.choices(secrets.SYMBOLS[name], k=least + 3 * i))
            keys[len(rows)] = (name, key)
            rows.append((len(rows), f"some words before {key} and after"))
    rows += [(len(rows) + i, " ".join("".join(rng.choices(LETTERS[:9], k=6)) for _ in range(9)) + " a/long/path/of/plain/words and-words-that-are-joined-by-signs") for i in range(200)]
    found = dict.fromkeys((name for name, *_ in secrets.ENCODINGS), 0)
    wrong = 0
    for r in secrets.secret_report(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        for x in filter(None, r.spans.split(",")):
            kind, s, e = x.split(":")
            good = r.doc_id in keys and rows[r.doc_id][1][int(s) : int(e)] == keys[r.doc_id][1]
            wrong += not good
            if good:
                found[keys[r.doc_id][0]] += 1
    print(found, wrong)
    assert min(found.values()) >= 9 and wrong <= 10
