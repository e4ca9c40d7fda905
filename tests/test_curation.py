"""Snapshots, files, policies, gates and preparation on small fixtures."""

import random

import pytest
from pyspark.sql import functions as F

from weftline.functions import paths as P
from weftline.functions.registry import usable_text
from weftline.operators import preparation as prep
from weftline.operators import relational as R
from weftline.operators import reports
from weftline.operators import snapshots as S
from weftline.sources import tables


def test_totals_of_hot_and_null_keys(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([None, "hot", "hot", "hot", f"k{i % 9}"]), rng.randrange(50)) for i in range(400)]
    d = spark.createDataFrame(rows, "i long, k string, v long")
    out = R.with_totals(d, ["k"], "i", low=("min", F.col("v")), total=("sum", F.col("v"))).collect()
    assert len(out) == 400
    for r in out:
        own = [v for _, k, v in rows if k == r.k]
        assert (r.low, r.total) == (min(own), sum(own))
    kept = R.keep_first(d, ["k"], [-F.col("v"), F.col("i")], "i").collect()
    for r in kept:
        best = min((-v, i) for i, k, v in rows if k == r.k)
        assert r.canonical_id == best[1] and r._kept == (r.i == best[1]) and r.group_size == sum(k == r.k for _, k, _ in rows)


def test_duplicate_ids_pass_over_taken_numbers(spark):
    rows = [("f", "a"), ("f", "a"), ("f", "a__dup2"), ("f", "a"), ("f", "a__dup2"), ("g", "a"), ("g", "a"), ("g", None), ("g", "")]
    d = spark.createDataFrame([(i, f, x) for i, (f, x) in enumerate(rows)], "i long, f string, x string")
    got = {r.i: r.final_id for r in S.distinct_ids(d, "f", "x", [F.col("i")]).collect()}
    assert got == {0: "a", 1: "a__dup2", 2: "a__dup2__dup2", 3: "a__dup3", 4: "a__dup2__dup3", 5: "a", 6: "a__dup2"}


def test_audit_names_rules_and_what_is_left(spark):
    steps = [("spaces", lambda c: F.regexp_replace(c, " +", " ")), ("marks", lambda c: F.regexp_replace(c, "!+", "!"))]
    a = spark.createDataFrame([(1, "a  b!!"), (2, "same"), (3, "gone"), (4, "x!!"), (5, None)], "i long, t string")
    b = spark.createDataFrame([(1, "a b!"), (2, "same"), (4, "y"), (5, None), (6, "new")], "i long, t string")
    got = {r.i: (r.state, r.rules, r.unclassified) for r in S.audit_changes(a, b, ["i"], "t", steps).collect()}
    assert got == {1: ("modified", ["spaces", "marks"], False), 2: ("kept", [], False), 3: ("removed", [], False), 4: ("modified", ["marks"], True), 5: ("kept", [], False), 6: ("added", [], False)}
    assert [(r.i, r.repair) for r in S.repairs(a, ["i"], "t", steps).orderBy("i", "repair").collect()] == [(1, "marks"), (1, "spaces"), (4, "marks")]


def test_budget_passes_over_what_is_too_large(spark):
    d = spark.createDataFrame([("a", 1, 5), ("a", 2, 9), ("a", 3, 4), ("a", 4, 2), ("b", 1, 11)], "k string, i long, n long")
    assert {(r.k, r.i) for r in S.within_budget(d, "k", "i", F.col("n"), 10).where("taken").collect()} == {("a", 1), ("a", 3)}


def test_cache_states(spark):
    d = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("b", 2), ("c", 3)], "x string, v long").withColumn("key", F.when(F.col("x") == "c", F.lit("wrong")).otherwise(F.sha2(F.col("x").cast("binary"), 256)))
    got = sorted((r.x, r.v, r.state) for r in S.checked_cache(d, "key", [F.col("x")], "v").collect())
    assert got == [("a", 1, "good"), ("a", 1, "good"), ("b", 1, "conflict"), ("b", 2, "conflict"), ("c", 3, "corrupt")]


def test_files_come_back_and_changes_are_noticed(spark, tmp_path):
    odd = [(1, 'a "quoted", text'), (2, "two\nlines\r\nand a \\ backslash"), (3, ""), (4, None), (5, " é😀 ")]
    d = spark.createDataFrame(odd, "i long, t string")
    tables.write_csv(d.select(F.col("i").cast("string").alias("i"), "t"), str(tmp_path / "csv"))
    assert sorted((int(r.i), r.t) for r in tables.read_csv(spark, str(tmp_path / "csv"), ["i", "t"]).collect()) == [(i, t or "") for i, t in odd]
    with pytest.raises(ValueError, match="blank_t"):
        tables.checked_csv(spark, str(tmp_path / "csv"), ["t"], "i", ["1", "2", "3", "4", "5"])
    tables.write_inventory(d, str(tmp_path / "inv"), "abc", ["i"])
    read = lambda digest: tables.read_inventory(spark, str(tmp_path / "inv"), "i long, t string", digest)
    assert sorted(map(tuple, read("abc").collect())) == sorted(odd)
    with pytest.raises(ValueError, match="stale"):
        read("other")
    d.limit(1).select(*sorted(d.columns)).write.mode("append").json(str(tmp_path / "inv" / "data"))
    with pytest.raises(ValueError, match="changed"):
        read("abc")


def test_a_pinned_table_is_made_once(spark, tmp_path):
    made = []
    make = lambda: made.append(1) or spark.createDataFrame([(1, "a")], "i long, t string")
    for _ in range(2):
        assert tables.pinned(spark, str(tmp_path / "p"), {"x": [1]}, make).count() == 1
    assert made == [1]
    with pytest.raises(ValueError):
        tables.pinned(spark, str(tmp_path / "p"), {"x": [2]}, make)


def test_policy_rejects_what_contradicts_itself():
    assert tables.SplitPolicy.from_json('{"seed": 7}').seed == 7
    for body in ('{"test_ratio": 0.2}', '{"least_tokens": 500}', '{"similarity": 0}', '{"other": 1}', '{"source_tolerance": 1.0}'):
        with pytest.raises(ValueError):
            tables.SplitPolicy.from_json(body)


def test_reports_are_published_without_local_paths():
    value = {"a": ["/home/x/run/1.json", 3], "b": {"c": "see /home/x/run and /home/x"}, "n": 2.5, "ok": True}
    clean = tables.without_paths(value, {"/home/x/run": "<run>", "/home/x": "<home>"})
    assert clean == {"a": ["<run>/1.json", 3], "b": {"c": "see <run> and <home>"}, "n": 2.5, "ok": True}
    assert tables.metric_rows({"en": {"bleu": 1, "by": {"short": {"bleu": 2.0}}}, "n": 3}) == [("en", "bleu", 1.0), ("en/by/short", "bleu", 2.0), ("", "n", 3.0)]


def test_inference_text():
    assert usable_text("ka-na") == "kana"
    with pytest.raises(ValueError, match="quarantine"):
        usable_text("see http://x/y")


def test_paths(spark):
    rows = ["Corpora/a/XML/b.xml", "Corpora/XML/b.XML", "XML/b.xml", "Corpora/a/b.xml", "x/Corpora/XML/b.xml", "", None]
    d = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, x string")
    got = {r.i: (r.a, r.b, r.c) for r in d.select("i", P.public_xml(F.col("x")).alias("a"), P.private_xml(F.col("x")).alias("b"), P.corpus_root(F.col("x")).alias("c")).collect()}
    assert got == {0: (True, False, "a"), 1: (True, False, "XML"), 2: (False, True, None), 3: (False, False, "a"), 4: (False, False, None), 5: (False, False, None), 6: (False, False, None)}
    assert P.pattern_list("A, b", "b,,C ") == ["a", "b", "c"]


def test_numbers_and_sums_in_order(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice("ab"), rng.randrange(5), rng.randrange(9)) for i in range(300)]
    d = spark.createDataFrame(rows, "i long, g string, o long, v long")
    placed = {r.i: r.number for r in prep.dense_numbers(d, ["o", "i"], ["g"]).collect()}
    sums = {r.i: r.upto for r in prep.running_sum(d, "v", ["o", "i"], ["g"]).collect()}
    for g in "ab":
        order = sorted((o, i, v) for i, h, o, v in rows if h == g)
        assert [placed[i] for _, i, _ in order] == list(range(len(order)))
        assert [sums[i] for _, i, _ in order] == [sum(v for *_, v in order[: k + 1]) for k in range(len(order))]


def test_gates_count_planted_violations(spark):
    schema = "row_id long, lang string, source string, src string, tgt string, split string, row_type string, origin string, usable boolean, confidence string, flags array<string>"
    text = lambda i: " ".join(format(hash((i, k)) & 0xFFFFFF, "06x") for k in range(8))
    good = [(i, "x", "s", f"source {text(i)}", f"target {text(-i)}", "train" if i < 20 else "test", "sentence", "original", True, "safe", []) for i in range(1, 30)]
    rows = lambda more: spark.createDataFrame(good + more, schema)
    gates = lambda df: {r.gate: r.violations for r in reports.failed_gates(reports.split_gates(df, F.lit(True))).collect()}
    assert gates(rows([])) == {}
    bad = [(100, "x", "s", good[0][3], "another " + text(100), "test", "lexeme", "synthetic", False, "ambiguous", ["english_language_uncertain"]), (101, "x", "s", good[24][3] + " q", "and " + text(101), "train", "sentence", "original", True, "safe", [])]
    got = gates(rows(bad))
    assert {k: got.get(k) for k in ("synthetic_eval", "ineligible_eval", "ambiguous_eval", "lexical_eval", "non_sentence_eval", "uncertain_language_eval", "train_src_key", "train_src_skeleton")} == dict.fromkeys(("synthetic_eval", "ineligible_eval", "ambiguous_eval", "lexical_eval", "non_sentence_eval", "uncertain_language_eval", "train_src_key", "train_src_skeleton"), 1)
    assert got["one_edit_src"] >= 1 and "ngram_src" in got and "train_tgt_key" not in got


def test_prompts_name_the_source_language(spark):
    from weftline.operators import rules

    d = spark.createDataFrame([("Elvish: a", "a b c d"), ("native: a", "a b c d")], "tgt string, src string")
    reason = lambda **o: [r.reason for r in rules.judge_pairs(d, **o).collect()]
    assert reason()[1] == "target_prompt_scaffolding" != reason()[0]
    assert reason(source_name="Elvish")[0] == "target_prompt_scaffolding" != reason(source_name="Elvish")[1]
