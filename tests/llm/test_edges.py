"""Every operator on nulls, empty and very long texts, ties, repeated rows, clashing column names, and the empty table."""

import random

import pytest

from weftline.llm import decontam, jaccard_join, lm_bloom, packing, quality_model, rule_forest, secrets, suffix_dedup, url_trust, warc

EXTRA = ("score", "n_bytes", "h", "text_key", "class", "component", "bucket", "uid", "shard", "place", "spans", "copies", "quality", "n", "pos", "host", "salt", "kind", "digest")
SCHEMA = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in EXTRA)


def rows():
    rng = random.Random(11)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randrange(2, 9))) for _ in range(4000)]
    long_ = " ".join(rng.choice(words) for _ in range(60_000))
    line = "x" * 200_000
    texts = [(1, None), (2, ""), (3, " \n\t"), (4, long_), (5, "a short text of nine words that is here"), (6, "a short text of nine words that is here"), (6, "a short text of nine words that is here"), (None, "no id but some words are here, eleven of them or so"), (None, None), (7, long_ + " end"), (8, line), (9, "\U0001f600é " * 500)]
    return [(i, t, *("z" for _ in EXTRA)) for i, t in texts]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0) for i in (2, 3, 4, 5, 6, 7, 8, 9)] + [(None, 1, 0), (5, None, None), (5, 1, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "a short text of nine words that is here", "h"), (1, "a short text of nine words that is here", "h"), (2, None, None), (3, "", ""), (None, "nothing holds this item at all, not one of its words", "x")], "item_id long, text string, score string")


def by_row(docs, labels):
    return {
        "suffix": suffix_dedup.remove_repeats(docs), "secrets": secrets.secret_report(docs), "quality": quality_model.classify(docs, labels), "jaccard": jaccard_join.jaccard_join(docs),
        "lm": lm_bloom.lm_scores(docs), "rules": rule_forest.apply_rules(docs, labels),
    }


def test_a_row_per_row(docs, labels):
    ids = sorted((r[0] for r in rows()), key=str)
    for name, out in by_row(docs, labels).items():
        got = out.collect()
        assert sorted((r.doc_id for r in got), key=str) == ids, name
        again = [tuple(x for k, x in r.asDict().items()) for r in got if r.doc_id == 6]
        assert len(again) == 2 and again[0] == again[1], name  # repeated rows, equal results


def test_suffix_and_jaccard_values(docs):
    removed = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs).collect() if r.doc_id}
    assert removed[4].n_removed == removed[4].n_bytes and removed[7].n_removed == removed[4].n_bytes and removed[8].n_removed == 200_000 and removed[5].n_removed == 0
    links = {r.doc_id: r for r in jaccard_join.jaccard_join(docs).collect() if r.doc_id}
    assert (links[7].component_id, links[6].component_id, links[6].n_links, links[5].n_links) == (4, 5, 2, 2)
    assert (links[1].n_shingles, links[1].component_id, links[2].n_links, links[8].n_shingles) == (0, 1, 0, 1)


def test_leaks_and_sequences(docs, benchmark):
    assert sorted((r.doc_id, r.item_id, r.lcs) for r in decontam.find_leaks(docs, benchmark).collect()) == [(5, 1, 1.0), (6, 1, 1.0)]
    kept = decontam.drop_leaked(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 3
    pieces = packing.pack(docs).collect()
    fill = {}
    for r in pieces:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= 1024 and sum(r.piece == 0 for r in pieces) == docs.count()


def test_filters_keep_columns(docs, labels):
    for out in (quality_model.keep_good(docs, labels), jaccard_join.keep_representatives(docs), secrets.redact(docs)):
        assert out.columns == docs.columns and 0 < out.count() <= docs.count()


def test_pages(spark, docs):
    pages = docs.selectExpr("doc_id as page_id", "concat('http://h', doc_id, '.net/') as url", "text as html", "host", "salt", "kind", "digest")
    assert warc.round_trip(pages).count() == url_trust.judge(pages).count() == docs.count()


def test_empty_tables(spark, docs, labels, benchmark):
    none = spark.createDataFrame([], SCHEMA)
    for name, out in by_row(none, labels).items():
        assert out.collect() == [], name
    assert decontam.find_leaks(none, benchmark).collect() == [] and decontam.find_leaks(docs, benchmark.limit(0)).collect() == []
    for out in (packing.pack(none), quality_model.keep_good(none, labels), jaccard_join.keep_representatives(none), secrets.redact(none)):
        assert out.collect() == []
    assert by_row(docs, labels.limit(0))["quality"].where("predicted = 0").count() == 0
