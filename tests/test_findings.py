"""Queries beside their SQL on small tables that hold what a reviewer's larger ones did."""

import hashlib
import itertools
import os
import random

import duckdb
import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
from weftline.functions.parts import deletion_hashes
from weftline.operators import metrics, ngrams, similarity


def beside_sql(spark, folder, name, **tables):
    """Rows of a query and of its SQL on the tables given as frames."""
    con = duckdb.connect()
    for table, df in tables.items():
        path = os.path.join(folder, f"{table}.parquet")
        df.coalesce(1).write.parquet(path)
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}/*.parquet')")
    out = entry.queries()[name](spark, str(folder))
    want = con.execute(f"SELECT {', '.join(out.columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    return sorted(map(tuple, out.collect())), sorted(want)


# Letters beyond ASCII beside codes and words, and morphemes side by side.
MARKED = ("TEÄPF!! ÜHEIT, ÉÉAUX. POSSÉ and NOM", "ÉNOM and ÈACC", "x a-b:c-d: y", "élan the root is NOM", "éfree translation: x", "d’une a-b: and ac-cu:", "Éactor focus", "agent focusé", "_NOM ACC_ 9SG")


def _documents(spark):
    rows = [(26 * 31 * k + i, x, "en", "s", len(x)) for k, x in enumerate(MARKED) for i in (13, 24, 25, 16)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_gloss_marks_and_letters_beyond_ascii(spark, tmp_path):
    got, want = beside_sql(spark, tmp_path, "gloss_marks", documents=_documents(spark))
    assert got == want and len({r[3] for r in got}) == 2


def test_pair_quality_and_letters_beyond_ascii(spark, tmp_path):
    got, want = beside_sql(spark, tmp_path, "pair_quality", documents=_documents(spark))
    assert got == want and any(r[2] == "target_linguistic_analysis" for r in got)


def _pieces(text, orders=(3, 4, 5)):
    return {text} if len(text) < 3 else {text[i : i + n] for n in orders for i in range(len(text) - n + 1)}


def _near_texts():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdeé漢😀", k=rng.randrange(1, 7))) for _ in range(60)]
    base = [" ".join(rng.choices(words, k=n)) for n in (1, 2, 5, 9, 20, 60, 90)]
    # Copies, texts with an end or an end and a start more, and texts of equal sets.
    texts = base * 3 + [x + " zq" for x in base] + ["qz " + x + " zq" for x in base] + ["a" * 9, "a" * 12, "", "ab", "ab", "abc"]
    return [(i, "x" if i % 5 else "y", x, "train" if i % 3 else "test") for i, x in enumerate(texts)]


def test_ngram_links_of_copies_and_near_texts(spark):
    rows = _near_texts()
    d = spark.createDataFrame(rows, "i long, s string, text string, split string")
    for t in (0.5, 0.82, 0.9, 0.95, 1.0):
        want = {}
        for (a, s, x, p), (b, r, y, q) in itertools.combinations(rows, 2):
            u, v = _pieces(x), _pieces(y)
            if x and y and s == r and len(u & v) / len(u | v) >= t:
                want[a, b] = (len(u & v) / len(u | v), p != q)
        assert {(r.a, r.b): r.jaccard for r in similarity.ngram_pairs(d, None, "i", F.col("text"), ["s"], t).collect()} == {k: v[0] for k, v in want.items()}
        assert similarity.ngram_crossings(d, "split", F.col("text"), ["s"], t).first().n == sum(v[1] for v in want.values())
        tied = [(r.a, r.b) for r in similarity.ngram_ties(d, "i", F.col("text"), ["s"], t).collect()]
        assert _groups(tied) == _groups(want)


def _groups(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[find(a)] = find(b)
    out = {}
    for x in list(root):
        out.setdefault(find(x), set()).add(x)
    return sorted(map(sorted, out.values()))


def test_ngram_links_make_no_rows_of_grams_or_copies(spark):
    """600 copies of a text and 40 long texts: what is written stays near the size of the rows."""
    rng = random.Random(6)
    rows = [(i, "x", "a copy that many rows hold", "train") for i in range(600)] + [(1000 + i, "x", "".join(rng.choices("abcdefgh ", k=2000)), "test") for i in range(40)]
    d = spark.createDataFrame(rows, "i long, s string, text string, split string")
    sizes = []
    for module in (similarity, ngrams):
        module.stored, keep = (lambda df, name, keep=module.stored: (out := keep(df, name), sizes.append(out.count()))[0]), module.stored
        module._keep = keep
    try:
        assert similarity.near_conflicts(d, "i", ["text"], ["s"], 0.95, 60).count() == 600
        assert similarity.ngram_ties(d, "i", F.col("text"), ["s"], 0.95).count() == 599
        assert similarity.ngram_crossings(d, "split", F.col("text"), ["s"], 0.95).first().n == 0
    finally:
        for module in (similarity, ngrams):
            module.stored = module._keep
            del module._keep
    assert max(sizes) <= len(rows)


def test_deletion_hashes_stand_for_the_texts():
    rng = random.Random(7)
    texts = ["", "a", "b", "ab", "ba", "aa", "abc", "bcd", "é漢😀", "é漢"] + ["".join(rng.choices("ab", k=rng.randrange(1, 9))) for _ in range(60)]
    keys = {x: {x} | {x[:i] + x[i + 1 :] for i in range(len(x))} for x in texts}
    hashes = {x: set(zip(*(h.tolist() for h in deletion_hashes(x)))) for x in texts}
    assert all(len(keys[x]) == len(hashes[x]) for x in texts)
    assert all(len(keys[x] & keys[y]) == len(hashes[x] & hashes[y]) for x in texts for y in texts)
    assert sum(h.nbytes for h in deletion_hashes("x y" * 10_000)) <= 16 * 30_001  # the texts take 900 MB


def test_near_conflicts_of_copies_beside_sql(spark, tmp_path):
    rng = random.Random(8)
    some = [" ".join(rng.choices(["lo", "hi", "mid", "far", "été"], k=n)) for n in (1, 2, 3, 12, 40, 90)]
    turns = [(c, k, "user" if k % 2 == 0 else "assistant", rng.choice(some) + ("" if rng.random() < 0.5 else f" {c}")) for c in range(40) for k in (0, 1)]
    d = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string")
    got, want = beside_sql(spark, tmp_path, "near_conflicts", conversations=d)
    assert got == want and len(got) > 40


def test_signatures_and_deletions_take_twelve_bytes(spark):
    """Texts that are like no other: what is dealt out stays near 12 bytes a key, and no deletion is spread out in full."""
    rng = random.Random(10)
    k, v = (np.array([rng.getrandbits(64) for _ in range(5000)], np.uint64).view(t) for t in (np.uint64, np.int64))
    blobs = list(ngrams.dealt_keys(k, v, 60))
    assert sum(len(x) for b in blobs for c in ("keys", "nodes") for x in b.column(c).to_pylist()) == 12 * 5000
    half, nodes = ngrams.keys_of(blobs + blobs)
    assert sorted(zip(half.tolist(), nodes.tolist())) == sorted(zip((k & np.uint64(0xFFFFFFFF)).tolist(), v.tolist()))
    met = np.array([4, 1 << 60 | 4, 6], np.uint64)
    assert ngrams.with_halves_told(met, 60).tolist() == met.tolist() and ngrams.with_halves_told(met, 1).tolist() == [*met.tolist(), 5, 1 << 60 | 5]
    rows = [(i, "x", "".join(rng.choices("abcdefghij", k=40))) for i in range(200)] + [(200, "x", "so far"), (201, "x", "so car"), (202, "y", "so bar"), (203, "x", "twice"), (204, "x", "twice")]
    d = spark.createDataFrame(rows, "i long, s string, text string")
    sizes, keep = {}, similarity.stored
    similarity.stored = lambda df, name: (out := keep(df, name), sizes.update({name: out.count()}))[0]
    try:
        assert {r.i for r in similarity.edit_conflicts(d, d, "text", ["s"], "i").collect()} == {200, 201, 203, 204}
    finally:
        similarity.stored = keep
    assert sizes["edit-texts"] == 3


def test_edits_go_on_from_the_words_that_stay():
    rng = random.Random(9)
    for _ in range(200):
        h, r = (rng.choices("abcd", k=rng.randrange(1, 12)) for _ in "hr")
        places = metrics._word_places(r)
        states = metrics._edit_states(h, places, len(r))
        at = rng.randrange(len(h) + 1)
        assert metrics._edit_states(h[at:], places, len(r), states[at]) == states[at:] and states[-1][2] == metrics.word_edits(h, r)


def test_deletions_of_many_texts_are_those_of_each():
    from weftline.functions.parts import deletion_hashes, deletion_hashes_of

    texts = ["", "a", "aa", "abba", "book keeper", "漢字漢字", "x" * 50, "the quick brown fox"]
    first, second, counts = deletion_hashes_of(texts)
    at = 0
    for x, n in zip(texts, counts.tolist()):
        assert sorted(zip(first[at : at + n].tolist(), second[at : at + n].tolist())) == sorted(zip(*(h.tolist() for h in deletion_hashes(x))))
        at += n
    assert at == len(first) and len(deletion_hashes_of([])[0]) == 0


def test_frequent_grams_make_no_candidates(spark, monkeypatch):
    """Texts that begin alike, as rows of one brand do: few of the pairs of strangers are counted out, and no link is lost."""
    from weftline.operators import ngrams, similarity

    word = lambda *k: hashlib.md5(repr(k).encode()).hexdigest()
    text = lambda i: f"large ring LARGE Brand#{i % 3} {i} {word(i)}"
    rows = [(i, text(i) if i % 10 else text(i + 1) + " x") for i in range(600)]
    d = spark.createDataFrame(rows, "i long, x string")
    counted, kept = [], ngrams.stored
    monkeypatch.setattr(ngrams, "stored", lambda df, name: (out := kept(df, name), counted.append((name, out.count())))[0])
    links = lambda: {(r.a, r.b) for r in similarity.ngram_pairs(d, None, "i", F.col("x"), [], 0.82).collect()}
    plain = links()
    monkeypatch.setattr(ngrams, "LEAST", 0)
    assert links() == plain == {(i, i + 1) for i in range(0, 600, 10)}
    before, after = (n for name, n in counted if name == "gram-candidates")
    assert before >= 5 * after >= 5 * 60


def test_lone_rows_make_no_edges(spark, monkeypatch):
    """Only rows that share a key with another one go into the components; the groups are those of all keys and rows."""
    from weftline.operators import graph, split

    word = lambda *k: hashlib.md5(repr(k).encode()).hexdigest()
    rows = [(i, "x", word("s", i), word("t", i + (i % 20 == 0)) if i % 30 else "") for i in range(400)]
    rows += [(400, "x", word("s", 3)[1:], ""), (401, "x", "", ""), (402, "y", word("s", 3), ""), (403, "x", "", word("t", 7))]
    d = spark.createDataFrame(rows, "row_id long, lang string, a string, b string")
    edges, kept = [], graph.components
    monkeypatch.setattr(split, "components", lambda e, name: (edges.append(e.count()), kept(e, name))[1])
    got = {r.row_id: r.group_id for r in split.leakage_groups(d, "lang", ["a", "b"]).collect()}
    assert edges[0] < 120 and len(got) == 404
    for i, j in [(20, 21), (3, 400), (7, 403)]:
        assert got[i] == got[j]
    assert len(set(got.values())) == 404 - sum(i % 20 == 0 and i % 30 != 0 and (i + 1) % 30 != 0 for i in range(400)) - 2
