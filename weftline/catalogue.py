"""The registered queries of the library itself, each beside the DuckDB SQL that says the same (where SQL can)."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.functions import text as X
from weftline.operators import metrics, relational as R, rules, similarity, split
from weftline.operators.graph import closure, components
from weftline.plans.storage import stored
from weftline.streaming import events as stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Lazily opened tables of a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.folder, f"{name}.parquet"))


def query(sql: str | None = None):
    def add(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return QUERIES["quality_reason_counts"](spark, folder)


# ---- SQL fragments ----

ALNUM = r"[\p{L}\p{N}\p{M}]"
HAN = r"[\x{3400}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{2B81F}]"


def _ws(x: str) -> str:
    return rf"trim(regexp_replace(coalesce({x}, ''), '[ \t\n\r]+', ' ', 'g'))"


def _key(x: str) -> str:
    return f"lower({_ws(x)})"


def _skel(x: str) -> str:
    return rf"regexp_replace({_key(x)}, '[^\p{{L}}\p{{N}}\p{{M}}]', '', 'g')"


def _tokens(x: str) -> str:
    return f"len(list_filter(string_split({_ws(x)}, ' '), lambda q: regexp_matches(q, '{ALNUM}')))"


def _hits(x: str, p: str) -> str:
    return f"len(regexp_extract_all(coalesce({x}, ''), '{p}'))"


def _terminal(x: str) -> str:
    return rf"""regexp_matches(coalesce({x}, ''), '[.!?。！？]\s*["''”’)\]}}》」』]*\s*$')"""


def _count(x: str, mark: str) -> str:
    return f"(length({x}) - length(replace({x}, '{mark}', '')))"


def _unbalanced(x: str) -> str:
    x = f"coalesce({x}, '')"
    parts = [f"""{_count(x, '"')} % 2 = 1""", f"{_count(x, '“')} <> {_count(x, '”')}", *(f"{_count(x, a)} <> {_count(x, b)}" for a, b in X.DELIMITER_PAIRS)]
    return "(" + " OR ".join(parts) + ")"


def _numbered(x: str) -> str:
    v = rf"list_transform(regexp_extract_all(coalesce({x}, ''), '(?:^|\s)\(?([1-9]\d?)\)?[.)、:：]\s*', 1), lambda q: CAST(q AS INT))"
    return f"coalesce(list_bool_or(list_transform(range(1, len({v})), lambda i: {v}[i + 1] = {v}[i] + 1)), false)"


PAIRS = """SELECT u.conv_id * 1000 + u.turn AS row_id, u.text AS src, a.text AS tgt FROM conversations u JOIN conversations a
  ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant'"""


def pairs(t: Tables) -> DataFrame:
    c = t.conversations
    a = c.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("tgt"))
    return c.where("role = 'user'").join(a, ["conv_id", "turn"]).select((F.col("conv_id") * 1000 + F.col("turn")).alias("row_id"), F.col("text").alias("src"), "tgt")


# ---- scalar library ----


@query(f"SELECT doc_id, CAST(length({_key('text')}) AS BIGINT) AS key_length, sha256({_key('text')}) AS key_sha, sha256({_skel('text')}) AS skeleton_sha FROM documents")
def text_keys(t):
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    x = F.col("text")
    return t.documents.select("doc_id", F.length(X.key(x)).cast("long").alias("key_length"), sha(X.key(x)).alias("key_sha"), sha(X.skeleton(x)).alias("skeleton_sha"))


@query(f"SELECT 'd' AS kind, doc_id AS id, {_tokens('text')} AS tokens, {_hits('text', HAN)} AS han FROM documents UNION ALL SELECT 'p', page_id, {_tokens('html')}, {_hits('html', HAN)} FROM pages")
def token_and_han_counts(t):
    one = lambda df, kind, i, c: df.select(F.lit(kind).alias("kind"), F.col(i).alias("id"), X.token_count(F.col(c)).alias("tokens"), X.han_count(F.col(c)).alias("han"))
    return one(t.documents, "d", "doc_id", "text").union(one(t.pages, "p", "page_id", "html"))


@query(f"SELECT doc_id, {_terminal('text')} AS terminal FROM documents")
def terminal_punctuation(t):
    return t.documents.select("doc_id", X.terminal(F.col("text")).alias("terminal"))


@query(f"SELECT doc_id, {_unbalanced('text')} AS unbalanced FROM documents")
def delimiter_balance(t):
    return t.documents.select("doc_id", X.unbalanced(F.col("text")).alias("unbalanced"))


@query(rf"SELECT doc_id, {_hits('text', HAN)} AS han, {_hits('text', X.KANA_HANGUL)} AS kana_hangul, {_hits('text', X.LATIN)} AS latin FROM documents")
def script_counts(t):
    x = F.col("text")
    return t.documents.select("doc_id", X.script_count(x, X.HAN).alias("han"), X.script_count(x, X.KANA_HANGUL).alias("kana_hangul"), X.script_count(x, X.LATIN).alias("latin"))


@query(f"SELECT doc_id, {_numbered('text')} AS numbered FROM documents")
def numbered_sequence(t):
    return t.documents.select("doc_id", X.numbered_sequence(F.col("text")).alias("numbered"))


@query("SELECT page_id, regexp_matches(coalesce(html, ''), '<[A-Za-z/!][^>]*>') AS markup FROM pages")
def html_markup_rule(t):
    return t.pages.select("page_id", F.coalesce("html", F.lit("")).rlike(X.MARKUP).alias("markup"))


@query("SELECT page_id, regexp_matches(coalesce(url, ''), '(?i)(?:https?://|www[.])') AS url_found, regexp_matches(coalesce(html, ''), '(?i)(?:https?://|www[.])') AS html_found FROM pages")
def url_rule(t):
    return t.pages.select("page_id", F.coalesce("url", F.lit("")).rlike(X.URL).alias("url_found"), F.coalesce("html", F.lit("")).rlike(X.URL).alias("html_found"))


_SECRET_SQL = " UNION ALL ".join("SELECT doc_id, '{}' AS finding, len(regexp_extract_all(coalesce(text, ''), '{}')) AS hits FROM documents".format(n, p.replace("'", "''")) for n, p in rules.SECRETS)


@query(f"SELECT * FROM ({_SECRET_SQL}) WHERE hits > 0")
def secret_scan(t):
    return rules.scan_secrets(t.documents, "doc_id", "text")


@query("SELECT doc_id, substr(sha256(concat_ws('␟', CASE WHEN CAST(doc_id AS VARCHAR) = '0' THEN '' ELSE CAST(doc_id AS VARCHAR) END, trim(lang), trim(source))), 1, 24) AS row_id FROM documents")
def content_row_id(t):
    return t.documents.select("doc_id", X.row_id(F.col("doc_id"), F.col("lang"), F.col("source")).alias("row_id"))


_PATH = "regexp_replace(url, '^[a-zA-Z]+://', '')"
_BUCKET = "CASE " + " ".join(f"WHEN regexp_matches(lower({_PATH}), '{p}') THEN '{n}'" for n, p in X.BUCKETS) + " ELSE 'unknown' END"


@query(f"SELECT page_id, {_BUCKET} AS bucket FROM pages")
def source_bucket(t):
    return t.pages.select("page_id", X.source_bucket(F.regexp_replace("url", "^[a-zA-Z]+://", "")).alias("bucket"))


@query("SELECT page_id, split_part(regexp_replace(url, '^[a-zA-Z]+://', ''), '/', 1) AS corpus FROM pages")
def source_corpus(t):
    path = F.concat(F.lit("Data/Corpora/"), F.regexp_replace("url", "^[a-zA-Z]+://", ""))
    return t.pages.select("page_id", X.source_corpus(path).alias("corpus"))


@query("SELECT doc_id, CASE WHEN n <= 5 THEN '<=5' WHEN n <= 10 THEN '6-10' WHEN n <= 20 THEN '11-20' WHEN n <= 40 THEN '21-40' ELSE '>40' END AS bin FROM (SELECT doc_id, " + _tokens("text") + " AS n FROM documents)")
def length_bins(t):
    return t.documents.select("doc_id", X.length_bin(X.token_count(F.col("text"))).alias("bin"))


@query(r"SELECT p_partkey, CASE WHEN v = '' THEN 'default' ELSE v END AS tag FROM (SELECT p_partkey, trim(substr(trim(regexp_replace(" + _key("p_name || '/' || p_brand || '#' || p_type") + r", '[^a-z0-9]+', '_', 'g'), '_'), 1, 12), '_') AS v FROM part)")
def safe_tags(t):
    return t.part.select("p_partkey", X.safe_tag(F.concat_ws("#", F.concat_ws("/", "p_name", "p_brand"), "p_type"), most=12).alias("tag"))


# ---- rule engine, dedup and ledger ----

_RULES = [
    ("empty_or_punctuation_only", "rejected", f"NOT regexp_matches(coalesce(text, ''), '{ALNUM}')"),
    ("model_length_overflow", "quarantine", f"{_tokens('text')} > 2000"),
    ("url", "quarantine", "regexp_matches(coalesce(text, ''), '(?i)(?:https?://|www[.])')"),
    ("markup", "quarantine", "regexp_matches(coalesce(text, ''), '<[A-Za-z/!][^>]*>')"),
    ("repeated_symbol_noise", "quarantine", r"regexp_matches(coalesce(text, ''), '#{8,}|\*{8,}|!{8,}|\.{8,}')"),
    ("malformed_escaping", "quarantine", r"""regexp_matches(coalesce(text, ''), '["”]{2,}\s*$')"""),
]
_CASE = lambda i, last: "CASE " + " ".join(f"WHEN {r[2]} THEN '{r[i]}'" for r in _RULES) + f" ELSE '{last}' END"
_FLAGS = [("unbalanced_delimiters", _unbalanced("text")), ("no_terminal_mark", f"NOT {_terminal('text')}"), ("numbered_sequence", _numbered("text")), ("short", f"{_tokens('text')} < 50")]
_FLAG_SQL = "list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in _FLAGS) + "], lambda q: q IS NOT NULL)"
DECIDED = f"SELECT doc_id, text, lang, {_CASE(1, 'accepted')} AS disposition, {_CASE(0, '')} AS reason, array_to_string({_FLAG_SQL}, '|') AS flags FROM documents"
_LEDGER = f"""SELECT doc_id, CASE WHEN disposition = 'accepted' AND n > 1 THEN 'duplicate' ELSE disposition END AS disposition, reason, flags, CASE WHEN disposition = 'accepted' THEN first ELSE doc_id END AS canonical_id, CASE WHEN disposition = 'accepted' THEN size ELSE 1 END AS group_size
FROM (SELECT *, row_number() OVER w AS n, first_value(doc_id) OVER w AS first, count(*) OVER (PARTITION BY disposition = 'accepted', lang, {_key('text')}) AS size FROM ({DECIDED}) WINDOW w AS (PARTITION BY disposition = 'accepted', lang, {_key('text')} ORDER BY doc_id))"""


def decided(t: Tables) -> DataFrame:
    """doc_id, lang, disposition, reason, flags and _key of every document; white space and tokens are looked at once."""
    n = F.col("_n")
    every = rules.document_rules(tokens=n)
    d = t.documents.select("doc_id", "lang", "text", X.ws(F.col("text")).alias("_ws")).withColumn("_n", X.token_count(F.col("_ws"), spaced=True))
    d = d.withColumn("_rule", rules.decide(every))
    return d.select("doc_id", "lang", *rules.named(every, F.col("_rule")), F.array_join(rules.gather(rules.document_flags(tokens=n)), "|").alias("flags"), F.sha2(F.lower("_ws").cast("binary"), 256).alias("_key"))


def ledger_rows(t: Tables) -> DataFrame:
    # The key is hashed, so that texts aren't shuffled; rules run once, then only the small rows are read.
    rows = stored(decided(t), "decided")
    return R.ledger(rows, ["lang", "_key"], [F.col("doc_id")], "doc_id").select("doc_id", "disposition", "reason", "flags", "canonical_id", "group_size")


@query(f"SELECT doc_id, disposition, reason, flags FROM ({DECIDED})")
def quality_disposition(t):
    return decided(t).drop("lang", "_key")


@query(f"SELECT disposition || ':' || reason AS reason, count(*) AS n FROM ({_LEDGER}) GROUP BY 1")
def quality_reason_counts(t):
    return ledger_rows(t).groupBy(F.concat_ws(":", "disposition", "reason").alias("reason")).agg(F.count("*").alias("n"))


@query(f"SELECT flag, count(*) AS n FROM (SELECT unnest(string_split(flags, '|')) AS flag FROM ({DECIDED})) WHERE flag <> '' GROUP BY 1")
def quality_flag_counts(t):
    return decided(t).select(F.explode_outer(F.split("flags", "\\|")).alias("flag")).where("flag <> ''").groupBy("flag").agg(F.count("*").alias("n"))


@query(f"SELECT *, input_rows = accepted + rejected + quarantine + duplicates AS conserved FROM (SELECT count(*) AS input_rows, count(*) FILTER (disposition = 'accepted') AS accepted, count(*) FILTER (disposition = 'rejected') AS rejected, count(*) FILTER (disposition = 'quarantine') AS quarantine, count(*) FILTER (disposition = 'duplicate') AS duplicates FROM ({_LEDGER}))")
def row_conservation(t):
    return R.conservation(ledger_rows(t))


@query(_LEDGER)
def dedup_ledger(t):
    return ledger_rows(t)


@query(f"SELECT doc_id, size AS group_size FROM (SELECT doc_id, row_number() OVER (PARTITION BY {_key('text')} ORDER BY doc_id) AS n, count(*) OVER (PARTITION BY {_key('text')}) AS size FROM documents) WHERE n = 1")
def dedup_keep_first(t):
    d = stored(t.documents.select("doc_id", F.sha2(X.key(F.col("text")).cast("binary"), 256).alias("k")), "keys")
    return R.keep_first(d, ["k"], [F.col("doc_id")], "doc_id").where("_kept").select("doc_id", "group_size")


@query(f"SELECT doc_id, first_value(doc_id) OVER (PARTITION BY k ORDER BY p, doc_id) AS canonical_id FROM (SELECT d.doc_id, {_key('text')} AS k, CASE WHEN l.doc_id IS NULL THEN 1 ELSE 0 END AS p FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = d.doc_id)")
def dedup_priority(t):
    known = t.labels.select("doc_id").distinct().withColumn("known", F.lit(0))
    d = stored(t.documents.select("doc_id", F.sha2(X.key(F.col("text")).cast("binary"), 256).alias("k")).join(known, "doc_id", "left"), "keys")
    return R.keep_first(d, ["k"], [F.coalesce("known", F.lit(1)), F.col("doc_id")], "doc_id").select("doc_id", "canonical_id")


# ---- pairs ----


@query(PAIRS)
def parallel_pairs(t):
    return pairs(t)


@query(f"SELECT row_id, su, tu, CASE WHEN su = 0 OR tu = 0 THEN 'empty_units' WHEN tu / su < 0.15 OR tu / su > 12 THEN 'extreme_fertility' ELSE '' END AS reason FROM (SELECT row_id, {_tokens('src')} AS su, {_tokens('tgt')} AS tu FROM ({PAIRS}))")
def fertility_band(t):
    p = pairs(t).select("row_id", X.token_count(F.col("src")).alias("su"), X.token_count(F.col("tgt")).alias("tu"))
    ratio = F.try_divide("tu", F.col("su"))
    return p.withColumn("reason", F.when((F.col("su") == 0) | (F.col("tu") == 0), "empty_units").when((ratio < 0.15) | (ratio > 12), "extreme_fertility").otherwise(""))


@query(f"""SELECT row_id, (su >= 10 AND tu <= 2) OR (su >= 12 AND tu <= 3) OR (su >= 18 AND tu <= 5) AS mismatch, su >= 4 AND tu <= 3 AND NOT {_terminal('tgt')} AS target_fragment, su <= 3 AND tu >= 12 AS length_asymmetry, {_unbalanced('tgt')} AS unbalanced
FROM (SELECT row_id, tgt, {_tokens('src')} AS su, {_tokens('tgt')} AS tu FROM ({PAIRS}))""")
def alignment_flags(t):
    p = pairs(t).withColumns({"su": X.token_count(F.col("src")), "tu": X.token_count(F.col("tgt"))})
    return p.selectExpr("row_id", "tgt", "su", "tu", "(su >= 10 and tu <= 2) or (su >= 12 and tu <= 3) or (su >= 18 and tu <= 5) as mismatch", "su <= 3 and tu >= 12 as length_asymmetry").select("row_id", "mismatch", ((F.col("su") >= 4) & (F.col("tu") <= 3) & ~X.terminal(F.col("tgt"))).alias("target_fragment"), "length_asymmetry", X.unbalanced(F.col("tgt")).alias("unbalanced"))


@query(f"SELECT row_id, NOT (su <= 2 AND tu <= 3) AND su BETWEEN 2 AND 384 AND tu BETWEEN 2 AND 384 AND (su + tu >= 6 OR (su + tu >= 5 AND {_terminal('src')} AND {_terminal('tgt')})) AS eligible FROM (SELECT row_id, src, tgt, {_tokens('src')} AS su, {_tokens('tgt')} AS tu FROM ({PAIRS}))")
def eval_eligibility(t):
    return pairs(t).select("row_id", rules.eligible(pairs(t)).alias("eligible"))


@query(f"SELECT CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS id, doc_id, '<to_' || lang || '> <src_' || source || '>' AS prefix FROM documents")
def release_projection(t):
    # A dense id without one global window: counts per range partition are added up, then rows are numbered inside them.
    d = t.documents.select("doc_id", R.control_prefix(to=F.col("lang"), src=F.col("source")).alias("prefix"))
    d = stored(d.repartitionByRange("doc_id").withColumn("part", F.spark_partition_id()), "release")
    size = d.groupBy("part").agg(F.count("*").alias("n"))
    before = size.alias("a").join(size.alias("b"), F.expr("b.part < a.part"), "left").groupBy(F.col("a.part").alias("part")).agg(F.coalesce(F.sum("b.n"), F.lit(0)).alias("offset"))
    inner = F.row_number().over(Window.partitionBy("part").orderBy("doc_id"))
    return d.withColumn("n", inner).join(F.broadcast(before), "part").select((F.col("offset") + F.col("n") - 1).cast("long").alias("id"), "doc_id", "prefix")


@query("SELECT d.doc_id, l.quality FROM documents d LEFT JOIN (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id) l ON l.doc_id = d.doc_id")
def left_first_match(t):
    return R.first_match(t.documents.select("doc_id"), t.labels, ["doc_id"], [F.col("quality")], "quality")


# ---- caches, reconciliation, registries ----


@query("SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events WHERE NOT EXISTS (SELECT 1 FROM events c WHERE c.user_id = events.user_id AND CAST(c.ts AS DATE) = CAST(events.ts AS DATE) AND c.event_type = 'purchase')")
def cache_anti_join(t):
    wanted = t.events.select("user_id", F.to_date("ts").alias("day"), "event_type")
    return R.missing_keys(wanted, wanted.where("event_type = 'purchase'"), ["user_id", "day"])


@query("SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def cache_layer_latest(t):
    return R.layered(t.events.select("user_id", "event_type", "event_id", "value", "ts"), ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).drop("ts")


@query("SELECT user_id, event_type, count(*) AS changes FROM (SELECT user_id, event_type, value, lag(value) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS b FROM events) WHERE b IS NOT NULL AND b <> value GROUP BY ALL")
def cache_conflicts(t):
    return R.conflicts(t.events, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")], "value")


@query(f"SELECT row_id FROM ({PAIRS}) p WHERE NOT EXISTS (SELECT 1 FROM ({PAIRS}) q WHERE {_key('q.tgt')} = {_key('p.src')})")
def target_overlap_anti(t):
    p = pairs(t).select("row_id", X.key(F.col("src")).alias("k"))
    return p.join(pairs(t).select(X.key(F.col("tgt")).alias("k")), "k", "left_anti").select("row_id")


@query("SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN d.doc_id IS NULL THEN 'unexpected' ELSE 'missing' END AS side FROM (SELECT DISTINCT doc_id FROM documents) d FULL JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = d.doc_id WHERE d.doc_id IS NULL OR l.doc_id IS NULL")
def inventory_reconcile(t):
    return R.reconcile(t.documents, t.labels, "doc_id")


_REGISTERED = "CASE WHEN doc_id % 20 < 17 THEN 'train' WHEN doc_id % 20 = 17 THEN 'validate' ELSE 'test' END"


@query(f"SELECT key, rows, n_splits FROM (SELECT md5({_key('text')}) AS key, count(*) AS rows, count(DISTINCT {_REGISTERED}) AS n_splits FROM documents WHERE doc_id % 5 <> 4 GROUP BY 1) WHERE n_splits > 1")
def registry_join_conflicts(t):
    """Groups of equal texts whose registered rows are in two splits."""
    registry = t.documents.where("doc_id % 5 <> 4").select("doc_id", F.expr(_REGISTERED).alias("split"))
    d = t.documents.select("doc_id", F.md5(X.key(F.col("text")).cast("binary")).alias("key")).join(registry, "doc_id")
    return d.groupBy("key").agg(F.count("*").alias("rows"), F.countDistinct("split").alias("n_splits")).where("n_splits > 1")


@query(f"SELECT count(DISTINCT d.k) AS documents_unique, (SELECT count(DISTINCT {_key('text')}) FROM benchmark) AS benchmark_unique, count(DISTINCT b.k) AS overlap_unique FROM (SELECT {_key('text')} AS k FROM documents) d LEFT JOIN (SELECT {_key('text')} AS k FROM benchmark) b ON b.k = d.k")
def split_overlap_summary(t):
    keys = lambda df, side: df.select(F.sha2(X.key(F.col("text")).cast("binary"), 256).alias("k")).distinct().withColumn(side, F.lit(1))
    both = keys(t.documents, "a").join(keys(t.benchmark, "b"), "k", "full_outer")
    return both.agg(F.count("a").alias("documents_unique"), F.count("b").alias("benchmark_unique"), F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("overlap_unique"))


@query(f"""WITH w AS (SELECT doc_id, doc_id % 10 = 0 AS eval, unnest(string_split({_key('text')}, ' ')) AS w FROM documents),
v AS (SELECT DISTINCT w FROM w WHERE NOT eval) SELECT doc_id, count(*) AS tokens, count(*) FILTER (v.w IS NULL) AS unknown FROM w LEFT JOIN v ON v.w = w.w WHERE eval AND w.w <> '' GROUP BY doc_id""")
def vocab_oov_rate(t):
    w = t.documents.select("doc_id", (F.col("doc_id") % 10 == 0).alias("eval"), F.explode_outer(F.split(X.key(F.col("text")), " ")).alias("w")).where("w <> ''")
    known = w.where("not eval").select("w").distinct().withColumn("known", F.lit(1))
    seen = w.where("eval").groupBy("doc_id", "w").agg(F.count("*").alias("n")).join(known, "w", "left")
    return seen.groupBy("doc_id").agg(F.sum("n").alias("tokens"), F.sum(F.when(F.col("known").isNull(), F.col("n")).otherwise(0)).alias("unknown"))


# ---- similarity and graph ----

_DEL = "list_distinct(list_append(list_transform(range(1, length(x) + 1), lambda i: substr(x, 1, CAST(i - 1 AS INT)) || substr(x, CAST(i + 1 AS INT))), x))"
_NAMES = f"SELECT x, unnest({_DEL}) AS k FROM (SELECT DISTINCT lower(p_name) AS x FROM part)"


@query(f"WITH k AS (SELECT x, unnest({_DEL}) AS k FROM (SELECT DISTINCT lower(p_name) AS x, p_size <= 5 AS eval FROM part WHERE p_size <= 5)), h AS (SELECT x, unnest({_DEL}) AS k FROM (SELECT DISTINCT lower(p_name) AS x FROM part WHERE p_size > 5)) SELECT p_partkey FROM part WHERE p_size <= 5 AND lower(p_name) IN (SELECT k.x FROM k WHERE k.k IN (SELECT k FROM h))")
def edit_neighbourhood_join(t):
    p = t.part.select("p_partkey", F.lower("p_name").alias("x"), "p_size", F.lit("all").alias("scope"))
    return similarity.edit_conflicts(p.where("p_size <= 5"), p.where("p_size > 5"), "x", ["scope"]).select("p_partkey")


_NUMBERED = "CASE WHEN p_partkey % 6 = 5 THEN substr(md5(CAST(p_partkey - 1 AS VARCHAR)), 2, 11) ELSE substr(md5(CAST(p_partkey % 1800 AS VARCHAR)), 1, 12) END"


@query(f"WITH p AS (SELECT p_partkey, {_NUMBERED} AS x FROM part), n AS (SELECT x, c, unnest({_DEL}) AS k FROM (SELECT x, count(*) AS c FROM p GROUP BY 1)), s AS (SELECT k FROM n GROUP BY k HAVING sum(c) > 1) SELECT p_partkey FROM p WHERE x IN (SELECT x FROM n WHERE k IN (SELECT k FROM s))")
def edit_self_conflicts(t):
    """Rows whose value equals another's, or lacks its first character (every sixth row's does); the others are far from all."""
    p = t.part.select("p_partkey", F.expr(_NUMBERED.replace("VARCHAR", "STRING")).alias("x"), F.lit("all").alias("scope"))
    return similarity.edit_conflicts(p, p, "x", ["scope"], "p_partkey").select("p_partkey")


_GRAMS = "list_distinct(CASE WHEN len(c) = 0 THEN [] WHEN len(c) < 3 THEN [array_to_string(c, '')] ELSE flatten([list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i + 1] || c[i + 2]), list_transform(range(1, greatest(len(c) - 2, 1)), lambda i: c[i] || c[i + 1] || c[i + 2] || c[i + 3]), list_transform(range(1, greatest(len(c) - 3, 1)), lambda i: c[i] || c[i + 1] || c[i + 2] || c[i + 3] || c[i + 4])]) END)"


def _gram_pairs(rows: str, t: float) -> str:
    return f"""WITH g AS (SELECT i, s, {_GRAMS} AS g FROM (SELECT i, s, CASE WHEN x = '' THEN [] ELSE string_split(x, '') END AS c FROM ({rows}))), e AS (SELECT i, s, len(g) AS n, unnest(g) AS x FROM g),
c AS (SELECT a.i AS a, b.i AS b, a.n AS na, b.n AS nb, count(*) AS k FROM e a JOIN e b ON a.x = b.x AND a.s = b.s AND a.i < b.i GROUP BY ALL)
SELECT a, b, k / (na + nb - k) AS jaccard FROM c WHERE k / (na + nb - k) >= {t}"""


# Turns, and an edited copy of every seventh conversation's turns under a number below zero, so that there are near copies.
_TURNS = f"SELECT conv_id * 1000 + turn AS i, role AS s, {_key('text')} AS x FROM conversations UNION ALL SELECT -1 - (conv_id * 1000 + turn), role, {_key("text || ' ' || role")} FROM conversations WHERE conv_id % 7 = 0"


def turns(t: Tables) -> DataFrame:
    c = t.conversations.select((F.col("conv_id") * 1000 + F.col("turn")).alias("i"), F.col("role").alias("s"), "text", "conv_id")
    return c.drop("conv_id").union(c.where("conv_id % 7 = 0").select(-1 - F.col("i"), "s", F.concat_ws(" ", "text", "s")))


@query(_gram_pairs(_TURNS, 0.9))
def ngram_jaccard_join(t):
    return similarity.ngram_pairs(turns(t), None, "i", X.key(F.col("text")), ["s"], 0.9)


# Four legs: near copies and edit neighbours, of the side's own text (src) and of the text it answers (tgt).
_NEAR_ROWS = "SELECT row_id, src, tgt FROM ({p}) UNION ALL SELECT -1 - row_id, src || ' ' || substr(src, 1, 9), tgt FROM ({p}) WHERE row_id % 11 = 0 UNION ALL SELECT -500000000 - row_id, 'x', substr(tgt, 2) FROM ({p}) WHERE row_id % 13 = 0".format(p=PAIRS)


def _near_leg(c: str, t: float) -> str:
    keyed = f"SELECT row_id AS i, 'x' AS s, {_key(c)} AS x FROM ({_NEAR_ROWS})"
    near = f"SELECT unnest([a, b]) AS i FROM ({_gram_pairs(keyed, t)})"
    return near + f" UNION SELECT i FROM (SELECT i, x, unnest({_DEL}) AS k FROM ({keyed}) WHERE length(x) <= 60 AND x <> '') JOIN (SELECT k FROM (SELECT i, unnest({_DEL}) AS k FROM ({keyed}) WHERE length(x) <= 60 AND x <> '') GROUP BY k HAVING count(*) > 1) USING (k)"


def near_rows(t: Tables) -> DataFrame:
    p = pairs(t)
    edited = p.where("row_id % 11 = 0").select(-1 - F.col("row_id"), F.concat_ws(" ", "src", F.substring("src", 1, 9)), "tgt")
    cut = p.where("row_id % 13 = 0").select(-500000000 - F.col("row_id"), F.lit("x"), F.expr("substring(tgt, 2)"))
    return p.union(edited).union(cut)


@query(f"{_near_leg('src', 0.95)} UNION {_near_leg('tgt', 0.95)}")
def near_conflicts(t):
    rows = near_rows(t).select(F.col("row_id").alias("i"), F.lit("x").alias("s"), X.key(F.col("src")).alias("src"), X.key(F.col("tgt")).alias("tgt"))
    return similarity.near_conflicts(stored(rows, "near-rows"), "i", ["src", "tgt"], ["s"], 0.95, most_edit=60).select("i")


def _chars(x: str) -> str:
    return f"CASE WHEN {x} = '' THEN [] ELSE string_split({x}, '') END"


_KNN = f"""WITH q AS (SELECT i, len(g) AS n, unnest(g) AS x FROM (SELECT item_id AS i, {_GRAMS} AS g FROM (SELECT item_id, {_chars(_key('text'))} AS c FROM benchmark))),
d AS (SELECT i, len(g) AS n, unnest(g) AS x FROM (SELECT doc_id AS i, {_GRAMS} AS g FROM (SELECT doc_id, {_chars(_key('text'))} AS c FROM documents))),
c AS (SELECT q.i AS query, d.i AS neighbour, q.n AS na, d.n AS nb, count(*) AS shared FROM q JOIN d ON q.x = d.x GROUP BY ALL)
SELECT query, neighbour, shared, shared / (na + nb - shared) AS jaccard, row_number() OVER (PARTITION BY query ORDER BY shared / (na + nb - shared) DESC, neighbour) AS rank FROM c"""


@query(f"SELECT * FROM ({_KNN}) WHERE rank <= 3")
def knn_exposure_topk(t):
    """The nearest documents of each benchmark item."""
    return similarity.nearest(t.benchmark.withColumn("i", F.col("item_id")), t.documents.withColumn("i", F.col("doc_id")), "i", X.key(F.col("text")), 3)


@query(f"SELECT count(*) AS items, avg(jaccard) AS mean_nearest, avg(CAST(jaccard >= 0.1 AS INT)) AS over_10, avg(CAST(jaccard >= 0.7 AS INT)) AS over_70, avg(CAST(jaccard >= 0.85 AS INT)) AS over_85, avg(CAST(jaccard >= 0.95 AS INT)) AS over_95 FROM ({_KNN}) WHERE rank = 1")
def exposure_thresholds(t):
    top = knn_exposure_topk(t).where("rank = 1")
    return top.agg(F.count("*").alias("items"), F.avg("jaccard").alias("mean_nearest"), *(F.avg((F.col("jaccard") >= q / 100).cast("int")).alias(f"over_{q}") for q in (10, 70, 85, 95)))


_EDGES = f"SELECT DISTINCT a.x AS a, b.x AS b FROM ({_NAMES}) a JOIN ({_NAMES}) b ON a.k = b.k AND a.x <> b.x"


@query(f"WITH RECURSIVE e AS MATERIALIZED ({_EDGES}), r(x, y) AS (SELECT DISTINCT lower(p_name), lower(p_name) FROM part UNION SELECT r.x, e.b FROM r JOIN e ON e.a = r.y) SELECT p_partkey, m AS root FROM part JOIN (SELECT x, min(y) AS m FROM r GROUP BY x) ON x = lower(p_name)")
def leakage_groups(t):
    p = t.part.select("p_partkey", F.lower("p_name").alias("x"))
    names = p.select("x").distinct()
    node = names.select("x", F.xxhash64(F.lit("all"), "x").alias("node"))
    found = components(similarity.deletion_edges(names.withColumn("scope", F.lit("all")), "x", ["scope"]), "groups")
    of = node.join(found, "node", "left").select("x", F.coalesce("component", "node").alias("c"))
    root = of.join(of.groupBy("c").agg(F.min("x").alias("root")), "c").select("x", "root")
    return p.join(root, "x").select("p_partkey", "root")


@query(f"WITH RECURSIVE e AS MATERIALIZED ({_EDGES}), r(node, round) AS (SELECT DISTINCT lower(p_name), 0 FROM part WHERE p_size = 50 UNION SELECT e.b, r.round + 1 FROM r JOIN e ON e.a = r.node WHERE r.round < 70) SELECT node, min(round) AS round FROM r GROUP BY node")
def neighbourhood_closure(t):
    p = t.part.select("p_size", F.lower("p_name").alias("x"))
    names = p.select("x").distinct().select("x", F.xxhash64(F.lit("all"), "x").alias("node"))
    edges = similarity.deletion_edges(names.withColumn("scope", F.lit("all")), "x", ["scope"])
    seeds = p.where("p_size = 50").select(F.xxhash64(F.lit("all"), "x").alias("node"))
    return closure(edges, seeds).join(names, "node").select(F.col("x").alias("node"), "round")


@query(f"SELECT doc_id, bool_and(n_chars >= 500) OVER w AND count(DISTINCT source) OVER w = 1 AS safe FROM (SELECT doc_id, n_chars, source, {_key('text')} AS k FROM documents) WINDOW w AS (PARTITION BY k)")
def group_safe_mask(t):
    d = t.documents.select("doc_id", "n_chars", "source", F.sha2(X.key(F.col("text")).cast("binary"), 256).alias("k"))
    w = Window.partitionBy("k")
    return d.select("doc_id", (F.every(F.col("n_chars") >= 500).over(w) & (F.min("source").over(w) == F.max("source").over(w))).alias("safe"))


# ---- splits ----


@query("""WITH s AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL), q AS (SELECT *, ceil(sum(n) OVER (PARTITION BY lang) * 0.10::DOUBLE) AS target, sum(n) OVER (PARTITION BY lang) AS total FROM s),
i AS (SELECT *, target * n / total::DOUBLE AS ideal FROM q), r AS (SELECT *, target - sum(floor(ideal)) OVER (PARTITION BY lang) AS spare, row_number() OVER (PARTITION BY lang ORDER BY round(ideal - floor(ideal), 9) DESC, n DESC, source) AS k FROM i)
SELECT lang, source, CAST(floor(ideal) + CASE WHEN k <= spare THEN 1 ELSE 0 END AS BIGINT) AS quota FROM r""")
def stratum_quota_one_round(t):
    s = t.documents.groupBy("lang", "source").agg(F.count("*").alias("n"))
    w = Window.partitionBy("lang")
    s = s.withColumn("total", F.sum("n").over(w)).withColumn("target", F.ceil(F.col("total") * F.lit(0.10))).withColumn("ideal", F.col("target") * F.col("n") / F.col("total").cast("double"))
    s = s.withColumns({"spare": F.col("target") - F.sum(F.floor("ideal")).over(w), "k": F.row_number().over(w.orderBy(F.desc(F.round(F.col("ideal") - F.floor("ideal"), 9)), F.desc("n"), "source"))})
    return s.select("lang", "source", (F.floor("ideal") + F.when(F.col("k") <= F.col("spare"), 1).otherwise(0)).cast("long").alias("quota"))


@query("SELECT doc_id, lang, source FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY md5('42' || doc_id), doc_id) AS n, count(*) OVER (PARTITION BY lang, source) AS size FROM documents) WHERE n <= least(3, size - 1)")
def stratified_holdout_topn(t):
    d = t.documents.select("doc_id", "lang", "source")
    return R.top_per_stratum(d, ["lang", "source"], [R.spread_order("doc_id", "42"), F.col("doc_id")], 3, 1)


def _split_rows(t: Tables) -> DataFrame:
    # Parts have no translation: every 20th target equals the next row's, and every 20th is nearly the next row's.
    k = F.col("p_partkey")
    tgt = F.concat(F.md5(F.concat(F.lit("t"), F.when((k % 20).isin(0, 7), k + 1).otherwise(k).cast("string")).cast("binary")), F.when(k % 20 == 7, " yz").otherwise(""))
    return t.part.select(F.col("p_partkey").alias("row_id"), F.lit("x").alias("lang"), F.col("p_brand").alias("source"), F.concat_ws(" ", "p_name", "p_type", "p_brand", F.col("p_partkey").cast("string"), F.md5(F.col("p_partkey").cast("string").cast("binary"))).alias("src"), tgt.alias("tgt"), (F.col("p_size") > 5).alias("eligible"))


@query()
def hard_split(t):
    return split.hard_split(_split_rows(t), t=0.82)


@query("SELECT unnest(['unknown_split', 'ineligible_held_out', 'exact_overlap', 'group_overlap', 'ngram_overlap', 'target_overlap', 'pair_overlap', 'target_ngram_overlap']) AS gate, 0 AS n")
def hard_split_invariants(t):
    rows = _split_rows(t)
    return split.split_report(split.hard_split(rows, t=0.82), rows, 0.82)


# ---- reports ----


_SPLIT = "CASE WHEN doc_id % 20 < 17 THEN 'train' WHEN doc_id % 20 = 17 THEN 'validate' ELSE 'test' END"


@query(f"SELECT lang, count(*) FILTER (s = 'train') AS train, count(*) FILTER (s = 'validate') AS validate, count(*) FILTER (s = 'test') AS test FROM (SELECT lang, {_SPLIT} AS s FROM documents) GROUP BY lang")
def crosstab_lang_split(t):
    return t.documents.withColumn("s", F.expr(_SPLIT)).groupBy("lang").pivot("s", ["train", "validate", "test"]).agg(F.count(F.lit(1))).na.fill(0)


@query("SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source")
def crosstab_lang_source(t):
    return t.documents.groupBy("lang", "source").agg(F.count("*").alias("n"))


_REPORT = f"SELECT *, {_tokens('text')} AS tk, {_terminal('text')} AS term, {_unbalanced('text')} AS unb, {_numbered('text')} AS num, {_SPLIT} AS sp FROM documents"


@query(f"""SELECT lang, count(*) AS rows, count(*) FILTER (tk < 50) AS short, count(*) FILTER (tk > 1000) AS long, count(*) FILTER (term) / count(*) AS terminal_share, count(DISTINCT source) AS sources, CAST(sum(tk) AS BIGINT) AS tokens, avg(tk) AS mean_tokens, CAST(max(tk) AS BIGINT) AS most_tokens, CAST(sum(n_chars) AS BIGINT) AS characters,
count(*) FILTER (unb) AS unbalanced, count(*) FILTER (num) AS numbered, count(*) FILTER (sp = 'train') AS train, count(*) FILTER (sp = 'validate') AS validate, count(*) FILTER (sp = 'test') AS test, count(*) FILTER (sp = 'test') / count(*) AS test_share, count(*) FILTER (sp = 'validate') / count(*) AS validate_share,
CAST(ceil(count(*) * 0.1::DOUBLE) AS BIGINT) AS target_test, CAST(ceil(count(*) * 0.05::DOUBLE) AS BIGINT) AS target_validate, count(*) FILTER (tk >= 2 AND tk <= 384) AS eligible FROM ({_REPORT}) GROUP BY lang""")
def language_report(t):
    x, n, one = F.col("text"), F.col("tk"), lambda s: F.count_if(F.col("sp") == s)
    d = t.documents.select("lang", "source", "n_chars", X.token_count(x).alias("tk"), X.terminal(x).alias("term"), X.unbalanced(x).alias("unb"), X.numbered_sequence(x).alias("num"), F.expr(_SPLIT).alias("sp"))
    rows = F.count("*")
    return d.groupBy("lang").agg(
        rows.alias("rows"), F.count_if(n < 50).alias("short"), F.count_if(n > 1000).alias("long"), (F.count_if("term") / rows).alias("terminal_share"), F.countDistinct("source").alias("sources"), F.sum(n).alias("tokens"), F.avg(n).alias("mean_tokens"), F.max(n).alias("most_tokens"), F.sum("n_chars").alias("characters"), F.count_if("unb").alias("unbalanced"), F.count_if("num").alias("numbered"),
        one("train").alias("train"), one("validate").alias("validate"), one("test").alias("test"), (one("test") / rows).alias("test_share"), (one("validate") / rows).alias("validate_share"), F.ceil(rows * F.lit(0.1)).cast("long").alias("target_test"), F.ceil(rows * F.lit(0.05)).cast("long").alias("target_validate"), F.count_if(n.between(2, 384)).alias("eligible"),
    )


@query(f"""WITH s AS (SELECT lang, source, count(*) AS rows, count(*) FILTER (sp = 'test') AS test, count(*) FILTER (sp = 'validate') AS validate, count(*) FILTER (sp <> 'train') AS held FROM (SELECT *, {_SPLIT} AS sp FROM documents) GROUP BY ALL), l AS (SELECT lang, sum(rows) AS all_rows, sum(held) AS all_held FROM s GROUP BY lang)
SELECT s.lang, s.source, s.rows, s.test, s.validate, s.rows / l.all_rows::DOUBLE AS share, coalesce(s.held / nullif(l.all_held, 0)::DOUBLE, 0) AS held_share, 0.5 * sum(abs(s.rows / l.all_rows::DOUBLE - coalesce(s.held / nullif(l.all_held, 0)::DOUBLE, 0))) OVER (PARTITION BY s.lang) AS tvd FROM s JOIN l USING (lang)""")
def strata_report(t):
    """Each stratum's share of its language's rows and of its held-out rows, and the distance between the two distributions."""
    s = t.documents.withColumn("sp", F.expr(_SPLIT)).groupBy("lang", "source").agg(F.count("*").alias("rows"), F.count_if(F.col("sp") == "test").alias("test"), F.count_if(F.col("sp") == "validate").alias("validate"), F.count_if(F.col("sp") != "train").alias("held"))
    w = Window.partitionBy("lang")
    s = s.withColumns({"share": F.col("rows") / F.sum("rows").over(w), "held_share": F.coalesce(F.try_divide(F.col("held"), F.sum("held").over(w)), F.lit(0.0))})
    return s.withColumn("tvd", 0.5 * F.sum(F.abs(F.col("share") - F.col("held_share"))).over(w)).drop("held")


@query("""WITH c AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL), l AS (SELECT lang, sum(n) AS s FROM c GROUP BY 1), a AS (SELECT source, sum(n) AS n FROM c GROUP BY 1), t AS (SELECT sum(n) AS t FROM a)
SELECT l.lang, 0.5 * sum(abs(coalesce(c.n, 0) / l.s::DOUBLE - a.n / t.t::DOUBLE)) AS tvd FROM l CROSS JOIN a CROSS JOIN t LEFT JOIN c ON c.lang = l.lang AND c.source = a.source GROUP BY l.lang""")
def source_tvd(t):
    return metrics.total_variation(t.documents, "lang", "source")


@query("SELECT event_type, bucket, count(*) AS n, count(DISTINCT user_id) AS users FROM (SELECT event_type, user_id, CAST(user_id % 5 AS BIGINT) AS bucket FROM events) GROUP BY ROLLUP (event_type, bucket)")
def findings_rollup(t):
    e = t.events.withColumn("bucket", F.col("user_id") % 5)
    return e.rollup("event_type", "bucket").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"))


@query("SELECT lang, quantile_cont(n_chars, 0.5) AS p50, quantile_cont(n_chars, 0.95) AS p95, quantile_cont(n_chars, 0.99) AS p99 FROM documents GROUP BY lang")
def quantiles_by_lang(t):
    return t.documents.groupBy("lang").agg(*(F.percentile("n_chars", F.lit(q)).alias(f"p{round(q * 100)}") for q in (0.5, 0.95, 0.99)))


@query(f"SELECT lang, count(*) AS rows, CAST(sum(n) AS BIGINT) AS tokens, sum(n_chars) / sum(n)::DOUBLE AS chars_per_token, quantile_cont(n, 0.5) AS p50, max(n) AS longest, 100.0 * count(*) FILTER (n > 1000) / count(*) AS pct_over FROM (SELECT lang, n_chars, {_tokens('text')} AS n FROM documents) GROUP BY lang")
def text_audit_by_lang(t):
    d = t.documents.select("lang", "n_chars", X.token_count(F.col("text")).alias("n"))
    return d.groupBy("lang").agg(F.count("*").alias("rows"), F.sum("n").alias("tokens"), (F.sum("n_chars") / F.sum("n")).alias("chars_per_token"), F.percentile("n", F.lit(0.5)).alias("p50"), F.max("n").alias("longest"), (100.0 * F.count_if(F.col("n") > 1000) / F.count("*")).cast("double").alias("pct_over"))


_DIAG = f"count(*) AS rows, avg(CAST({_ws('src')} = {_ws('tgt')} AS INT)) AS exact_match, avg(CAST({_ws('src')} = '' AS INT)) AS empty_rate, sum(length(src)) / greatest(sum(length(tgt)), 1)::DOUBLE AS length_ratio, avg(CAST({_key('src')} = {_key('tgt')} AS INT)) AS source_copy"


@query(f"SELECT CAST(row_id % 3 AS BIGINT) AS slice, {_DIAG} FROM ({PAIRS}) GROUP BY 1")
def mt_diagnostics(t):
    p = pairs(t).withColumn("slice", F.col("row_id") % 3)
    return metrics.diagnostics(p, ["slice"], "src", "tgt", "tgt")


@query("SELECT lang, source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY GROUPING SETS ((lang), (source), ())")
def sliced_metrics(t):
    return t.documents.groupingSets([["lang"], ["source"], []], "lang", "source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("SELECT lang, pow(greatest(n, 1), 0.7) / sum(pow(greatest(n, 1), 0.7)) OVER () AS p FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang)")
def sampling_probs(t):
    n = t.documents.groupBy("lang").agg(F.pow(F.count("*").cast("double"), F.lit(0.7)).alias("w"))
    return n.join(F.broadcast(n.agg(F.sum("w").alias("all"))), F.lit(True)).select("lang", (F.col("w") / F.col("all")).alias("p"))


@query("SELECT event_id, CAST(floor(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) * 1000 + 0.2503) AS BIGINT) AS moving_milli FROM events")
def moving_average(t):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-99, 0)
    return t.events.select("event_id", F.floor(F.avg("value").over(w) * 1000 + 0.2503).cast("long").alias("moving_milli"))


@query("SELECT CAST(doc_id AS VARCHAR) AS id, source, '' AS url FROM documents UNION ALL SELECT CAST(page_id AS VARCHAR), '', url FROM pages")
def union_heterogeneous(t):
    return R.union_all(t.documents.select(F.col("doc_id").cast("string").alias("id"), "source"), t.pages.select(F.col("page_id").cast("string").alias("id"), "url"))


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, sum(value) AS total FROM events GROUP BY ALL")
def windowed_events(t):
    return stream.windowed(t.events)
