"""More registered queries of the library: snapshots and joins, preparation of rows, paths, reports and gates, each beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.catalogue import ALNUM, PAIRS, Tables, _key, _skel, _terminal, _tokens, _unbalanced, _ws, pairs, query
from weftline.functions import paths as P
from weftline.functions import text as X
from weftline.operators import preparation as prep
from weftline.operators import relational as R
from weftline.operators import reports, rules
from weftline.operators import snapshots as S
from weftline.plans.storage import stored

# Pairs with the columns that curation works on, made from their numbers: the tables have no such pairs.
_RICH = """row_id, src, tgt, 'l' || CAST(row_id // 1000 % 4 AS VARCHAR) AS lang, 'c' || CAST(row_id // 4000 % 5 AS VARCHAR) AS source,
CASE WHEN row_id // 1000 % 20 < 15 THEN 'train' WHEN row_id // 1000 % 20 < 17 THEN 'validate' WHEN row_id // 1000 % 20 < 19 THEN 'test' ELSE 'held' END AS split,
CASE row_id // 1000 % 6 WHEN 0 THEN 'lexeme' WHEN 1 THEN '' ELSE 'Sentence' END AS row_type, CASE WHEN row_id // 1000 % 9 = 0 THEN 'synthetic' ELSE 'original' END AS origin,
row_id // 1000 % 7 <> 0 AS usable, CASE WHEN row_id // 1000 % 8 = 0 THEN 'ambiguous' ELSE 'safe' END AS confidence,
CASE WHEN row_id // 1000 % 10 = 3 THEN 'Corpora/a/XML/Dictionary/x.xml' ELSE 'Corpora/b/XML/Stories/y.xml' END AS path, CAST(row_id // 1000 AS BIGINT) AS document"""
RICH = f"SELECT {_RICH}, CASE WHEN row_id // 1000 % 5 = 0 THEN ['english_language_uncertain'] ELSE [] END AS flags FROM ({PAIRS})"


def rich(t: Tables) -> DataFrame:
    spark_sql = _RICH.replace("//", "div").replace("VARCHAR", "STRING")
    return pairs(t).selectExpr(*_columns(spark_sql)).withColumn("flags", F.expr("case when row_id div 1000 % 5 = 0 then array('english_language_uncertain') else cast(array() as array<string>) end"))


def _columns(sql: str) -> list[str]:
    """The items of a select list."""
    out, depth, word = [], 0, ""
    for c in sql:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(word)
            word = ""
        else:
            word += c
    return [*out, word]


# ---- snapshots, statuses, joins with records ----


@query("""SELECT doc_id, wanted, CASE WHEN trim(coalesce(text, '')) = '' THEN 'parse_error' WHEN source = 'src3' THEN 'excluded_path_pattern' WHEN lang <> wanted THEN 'source_language_mismatch' WHEN n_chars < 300 THEN 'dialect_mismatch' ELSE 'kept' END AS status
FROM documents, (SELECT unnest(['en', 'fr', 'de']) AS wanted)""")
def route_statuses(t):
    blank = F.trim(F.coalesce("text", F.lit(""))) == ""
    rules_ = [("parse_error", blank), ("excluded_path_pattern", F.col("source") == "src3"), ("source_language_mismatch", F.col("lang") != F.col("wanted")), ("dialect_mismatch", F.col("n_chars") < 300)]
    return S.route(t.documents, ["en", "fr", "de"], rules_).select("doc_id", "wanted", "status")


_LOC = "l_orderkey, l_partkey, l_suppkey, l_linenumber"


@query(f"""WITH q AS (SELECT {_LOC}, count(*) AS n, min(l_returnflag) AS flag FROM lineitem WHERE l_quantity <= 45 GROUP BY ALL)
SELECT u.l_shipdate AS day, count(*) AS units, count(*) FILTER (q.n IS NULL) AS missing, count(*) FILTER (q.n > 1) AS duplicated, count(*) FILTER (q.flag = 'R') AS r FROM lineitem u LEFT JOIN q USING ({_LOC}) GROUP BY 1""")
def unit_record_join(t):
    units = t.lineitem.select(*_LOC.split(", "), F.col("l_shipdate").alias("day"))
    records = t.lineitem.where("l_quantity <= 45").select(*_LOC.split(", "), F.col("l_returnflag").alias("flag"))
    out = S.locate(units, records, _LOC.split(", "), ["flag"])
    return out.groupBy("day").agg(F.count("*").alias("units"), F.count_if("missing").alias("missing"), F.count_if("duplicated").alias("duplicated"), F.count_if(F.col("flag") == "R").alias("r"))


@query("SELECT doc_id, CASE WHEN doc_id % 37 = 0 THEN 'missing' WHEN doc_id % 50 = 1 THEN 'hash_mismatch' ELSE 'verified' END AS status FROM documents")
def unit_hash_join(t):
    d = t.documents
    text = F.when(F.col("doc_id") % 50 == 1, F.concat("text", F.lit("!"))).otherwise(F.coalesce("text", F.lit("")))
    return S.verified(d, d.where("doc_id % 37 <> 0").select("doc_id", F.sha2(text.cast("binary"), 256).alias("digest")), ["doc_id"], "text", "digest")


_CACHE = f"SELECT sha256(lang || '␟' || {_ws('text')}) AS key, min('t' || doc_id) AS translation FROM documents WHERE doc_id % 3 <> 0 GROUP BY 1"


def _jobs(t: Tables) -> tuple[DataFrame, DataFrame]:
    d = stored(t.documents.select("doc_id", "lang", F.sha2(F.concat_ws("␟", "lang", X.ws(F.col("text"))).cast("binary"), 256).alias("key")), "jobs")
    return d, d.where("doc_id % 3 <> 0").groupBy("key").agg(F.min(F.concat(F.lit("t"), F.col("doc_id").cast("string"))).alias("translation"))


@query(f"SELECT d.doc_id, c.translation, c.key IS NULL AS missing FROM (SELECT doc_id, sha256(lang || '␟' || {_ws('text')}) AS key FROM documents) d LEFT JOIN ({_CACHE}) c USING (key)")
def cache_join_misses(t):
    rows, cache = _jobs(t)
    return S.cached(rows, cache, "key", "translation").select("doc_id", "translation", "missing")


@query("""SELECT state, count(*) AS n FROM (SELECT CASE WHEN user_id % 11 = 0 THEN 'corrupt' WHEN min(value) FILTER (user_id % 11 <> 0) OVER w < max(value) FILTER (user_id % 11 <> 0) OVER w THEN 'conflict' ELSE 'good' END AS state
FROM events WINDOW w AS (PARTITION BY user_id, event_type)) GROUP BY 1""")
def cache_scan(t):
    parts = [F.col("user_id").cast("string"), F.col("event_type")]
    key = F.when(F.col("user_id") % 11 == 0, F.lit("x")).otherwise(F.sha2(F.concat_ws("␟", *parts).cast("binary"), 256))
    c = t.events.select("user_id", "event_type", "event_id", "value", key.alias("key"))
    return S.checked_cache(c, "key", parts, "value").groupBy("state").agg(F.count("*").alias("n"))


@query("""SELECT s, CASE WHEN user_id IS NULL THEN NULL ELSE n END AS n FROM (SELECT state AS s, count(*) AS n, 1 AS user_id FROM (
SELECT CASE WHEN a.doc_id IS NULL THEN 'added' WHEN b.doc_id IS NULL THEN 'removed' WHEN a.x = b.x THEN 'kept' ELSE 'modified' END AS state FROM (SELECT doc_id, text AS x FROM documents WHERE doc_id % 41 <> 0) a
FULL JOIN (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN text || ' changed' ELSE regexp_replace(regexp_replace(text, '  +', ' ', 'g'), '([!?])[!?]+', '\\1', 'g') END AS x FROM documents WHERE doc_id % 43 <> 0) b ON a.doc_id = b.doc_id) GROUP BY 1)""")
def change_audit_states(t):
    return _audit(t).groupBy(F.col("state").alias("s")).agg(F.count("*").alias("n"))


_STEPS = [("collapse_spaces", lambda c: F.regexp_replace(c, "  +", " ")), ("trim_repeated_marks", lambda c: F.regexp_replace(c, "([!?])[!?]+", "$1"))]


def _audit(t: Tables) -> DataFrame:
    d = t.documents
    after = F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit(" changed"))).otherwise(S.cleaned(F.col("text"), _STEPS))
    return S.audit_changes(d.where("doc_id % 41 <> 0").select("doc_id", "text"), d.where("doc_id % 43 <> 0").select("doc_id", after.alias("text")), ["doc_id"], "text", _STEPS)


@query(r"""WITH s AS (SELECT doc_id, text AS a, regexp_replace(text, '  +', ' ', 'g') AS b FROM documents WHERE doc_id % 41 <> 0 AND doc_id % 43 <> 0), w AS (SELECT *, regexp_replace(b, '([!?])[!?]+', '\1', 'g') AS c FROM s),
m AS (SELECT *, CASE WHEN doc_id % 5 = 0 THEN a || ' changed' ELSE c END AS found FROM w) SELECT doc_id, array_to_string(list_filter([CASE WHEN a <> b THEN 'collapse_spaces' END, CASE WHEN b <> c THEN 'trim_repeated_marks' END], lambda x: x IS NOT NULL), '|') AS rules, c <> found AS unclassified FROM m WHERE a <> found""")
def change_audit_rules(t):
    return _audit(t).where("state = 'modified'").select("doc_id", F.array_join("rules", "|").alias("rules"), "unclassified")


@query(r"""WITH w AS (SELECT doc_id, coalesce(text, '') AS a, replace(coalesce(text, ''), chr(8203), '') AS b FROM documents), x AS (SELECT *, regexp_replace(b, '^[ \t\n\r]+|[ \t\n\r]+$', '', 'g') AS c FROM w), y AS (SELECT *, replace(c, chr(10), ' ') AS d FROM x)
SELECT doc_id, 'trim_boundary_whitespace' AS repair, sha256(b) AS before_sha256, sha256(c) AS after_sha256 FROM y WHERE b <> c UNION ALL SELECT doc_id, 'remove_zero_width', sha256(a), sha256(b) FROM y WHERE a <> b UNION ALL SELECT doc_id, 'join_lines', sha256(c), sha256(d) FROM y WHERE c <> d""")
def text_repairs(t):
    steps = [("remove_zero_width", lambda c: F.regexp_replace(c, "[​]", "")), ("trim_boundary_whitespace", lambda c: F.regexp_replace(c, "^[ \t\n\r]+|[ \t\n\r]+$", "")), ("join_lines", lambda c: F.replace(c, F.lit("\n"), F.lit(" ")))]
    return S.repairs(t.documents, ["doc_id"], "text", steps)


@query("SELECT page_id, CASE WHEN page_id % 6 = 0 THEN NULL ELSE page_id // 2 END AS final_index, page_id AS index, CASE WHEN page_id % 6 = 0 THEN 'removed' ELSE 'retained' END AS status FROM pages")
def transform_inventory(t):
    p = t.pages.select("page_id", F.col("page_id").alias("index"))
    return S.inventory(p, p.where("page_id % 6 <> 0").select("page_id", F.expr("page_id div 2").alias("index")), "page_id", "index")


_TIERS = "SELECT row_id, CASE WHEN row_id // 1000 % 3 = 0 THEN src ELSE ' ' END AS standard, CASE WHEN row_id // 1000 % 2 = 0 THEN tgt END AS original, CASE WHEN row_id // 1000 % 5 <> 1 THEN src ELSE '' END AS untyped FROM ({})"


def _tier_rows(t: Tables) -> DataFrame:
    return pairs(t).selectExpr("row_id", "case when row_id div 1000 % 3 = 0 then src else ' ' end as standard", "case when row_id div 1000 % 2 = 0 then tgt end as original", "case when row_id div 1000 % 5 <> 1 then src else '' end as untyped")


_TIER = "CASE WHEN trim(standard) <> '' THEN 'standard' WHEN trim(coalesce(original, '')) <> '' THEN 'original' WHEN trim(untyped) <> '' THEN 'untyped' ELSE 'missing' END"


@query(f"SELECT row_id, {_TIER} AS tier, md5(CASE {_TIER} WHEN 'standard' THEN standard WHEN 'original' THEN original WHEN 'untyped' THEN untyped ELSE '' END) AS digest, true AS preserved FROM ({_TIERS.format(PAIRS)})")
def tier_completion(t):
    out = S.completed(_tier_rows(t), "standard", ["original", "untyped"])
    return out.select("row_id", "tier", F.md5(F.col("completed").cast("binary")).alias("digest"), "preserved")


@query(f"SELECT tier, count(*) AS units, count(*) FILTER (untyped <> '') AS with_untyped FROM (SELECT *, {_TIER} AS tier FROM ({_TIERS.format(PAIRS)})) GROUP BY tier")
def tier_counters(t):
    out = S.completed(_tier_rows(t), "standard", ["original", "untyped"])
    return out.groupBy("tier").agg(F.count("*").alias("units"), F.count_if(F.col("untyped") != "").alias("with_untyped"))


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate, o_orderkey) > 1 AS alternate FROM orders")
def alternate_translations(t):
    return S.alternates(t.orders, ["o_custkey"], "o_orderpriority", [F.col("o_orderdate"), F.col("o_orderkey")]).select("o_orderkey", "alternate")


@query("SELECT event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) - 1 AS occurrence FROM events")
def field_occurrences(t):
    return S.numbered_within(t.events, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).select("event_id", "occurrence")


@query("SELECT p_partkey, CASE WHEN n = 1 THEN p_name ELSE p_name || '__dup' || n END AS final_id FROM (SELECT p_partkey, p_name, row_number() OVER (PARTITION BY p_brand, p_name ORDER BY p_partkey) AS n FROM part)")
def duplicate_id_suffixes(t):
    return S.distinct_ids(t.part, "p_brand", "p_name", [F.col("p_partkey")]).select("p_partkey", "final_id")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE lower(trim(o_orderstatus)) IN ('f', 'o')")
def known_status_filter(t):
    return t.orders.where(F.lower(F.trim("o_orderstatus")).isin("f", "o")).select("o_orderkey", "o_orderstatus")


@query("SELECT count(*) AS files, count(*) FILTER (html IS NULL OR NOT contains(html, '</html>')) AS malformed, count(*) FILTER (regexp_extract(html, '<html lang=\"([a-z]+)\"', 1) <> split_part(split_part(regexp_replace(url, '^[a-zA-Z]+://', ''), '/', 2), '?', 1)) AS language_mismatch FROM pages")
def input_validation(t):
    inner = F.split_part(F.split_part(F.regexp_replace("url", "^[a-zA-Z]+://", ""), F.lit("/"), F.lit(2)), F.lit("?"), F.lit(1))
    return t.pages.agg(F.count("*").alias("files"), F.count_if(F.col("html").isNull() | ~F.contains("html", F.lit("</html>"))).alias("malformed"), F.count_if(F.regexp_extract("html", '<html lang="([a-z]+)"', 1) != inner).alias("language_mismatch"))


# ---- folds in order ----

_JOB_SIZE = "octet_length(encode(coalesce(text, '')))"


@query(f"""WITH RECURSIVE j AS (SELECT lang || '-' || (doc_id // 5000) AS k, doc_id, {_JOB_SIZE} AS n, row_number() OVER (PARTITION BY lang, doc_id // 5000 ORDER BY doc_id) AS i FROM documents),
r AS (SELECT k, doc_id, i, n <= 60000 AS taken, CASE WHEN n <= 60000 THEN 60000 - n ELSE 60000 END AS rest FROM j WHERE i = 1 UNION ALL SELECT j.k, j.doc_id, j.i, j.n <= r.rest, CASE WHEN j.n <= r.rest THEN r.rest - j.n ELSE r.rest END FROM r JOIN j ON j.k = r.k AND j.i = r.i + 1)
SELECT k, doc_id, taken FROM r""")
def character_budget(t):
    d = t.documents.withColumn("k", F.concat_ws("-", "lang", F.expr("doc_id div 5000").cast("string")))
    return S.within_budget(d, "k", "doc_id", F.octet_length(F.coalesce("text", F.lit(""))), 60_000)


@query(f"""WITH RECURSIVE j AS (SELECT lang || '-' || (doc_id // 5000) AS bucket, doc_id, {_JOB_SIZE} AS n, row_number() OVER (PARTITION BY lang, doc_id // 5000 ORDER BY doc_id) AS i FROM documents),
r AS (SELECT bucket, doc_id, i, 0::BIGINT AS batch, 1 AS items, n AS held FROM j WHERE i = 1
UNION ALL SELECT j.bucket, j.doc_id, j.i, r.batch + CASE WHEN r.items >= 50 OR r.held + j.n > 122880 THEN 1 ELSE 0 END, CASE WHEN r.items >= 50 OR r.held + j.n > 122880 THEN 1 ELSE r.items + 1 END, CASE WHEN r.items >= 50 OR r.held + j.n > 122880 THEN j.n ELSE r.held + j.n END FROM r JOIN j ON j.bucket = r.bucket AND j.i = r.i + 1)
SELECT bucket, doc_id, batch FROM r""")
def budgeted_batches(t):
    # A bucket is 5,000 numbers of a language at most, however many documents there are.
    d = t.documents.withColumn("bucket", F.concat_ws("-", "lang", F.expr("doc_id div 5000").cast("string")))
    return R.budgeted_batches(d, "bucket", "doc_id", F.octet_length(F.coalesce("text", F.lit(""))))


@query("""WITH RECURSIVE e AS (SELECT user_id, event_id AS s, value AS v, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
r AS (SELECT user_id, i, v AS best, s AS best_step, 0 AS bad, NULL::BIGINT AS stop_step FROM e WHERE i = 1 UNION ALL
SELECT e.user_id, e.i, CASE WHEN e.v > r.best + 0.5 THEN e.v ELSE r.best END, CASE WHEN e.v > r.best + 0.5 THEN e.s ELSE r.best_step END, CASE WHEN e.v > r.best + 0.5 THEN 0 ELSE r.bad + 1 END, CASE WHEN e.v <= r.best + 0.5 AND r.bad + 1 >= 12 THEN e.s END FROM r JOIN e ON e.user_id = r.user_id AND e.i = r.i + 1 WHERE r.stop_step IS NULL)
SELECT user_id, max(best) AS best, max(best_step) AS best_step, max(stop_step) AS stop_step FROM r GROUP BY user_id""")
def early_stopping(t):
    return reports.early_stops(t.events, "user_id", "event_id", "value", 12, 0.5)


# ---- preparation ----


@query("SELECT doc_id, CASE WHEN trim(source) = '' OR source IS NULL THEN 'unknown' ELSE source END AS source, CASE WHEN trim(lang) = '' OR lang IS NULL THEN 'und' ELSE lang END AS lang, 'sentence' AS row_type FROM documents")
def metadata_defaults(t):
    return prep.with_defaults(t.documents.select("doc_id", "source", "lang"), {"source": "unknown", "lang": "und", "row_type": "sentence"})


@query("SELECT lang, doc_id, source, n_chars, md5(text) AS target FROM documents")
def canonical_columns(t):
    d = t.documents.select("doc_id", F.md5(F.col("text").cast("binary")).alias("english"), "source", "n_chars", "lang", F.lit(1).alias("_internal"))
    return prep.in_order(prep.renamed_target(d, ["english", "chinese"]), ["lang", "doc_id"])


@query(f"SELECT row_id, md5('Translate this from ' || lang || ' to English:' || chr(10) || CASE WHEN source = 'c1' THEN '' ELSE '<src_' || source || '>' || chr(10) END || lang || ': ' || src || chr(10) || 'English:') AS prompt FROM ({RICH})")
def prompt_format(t):
    p = rich(t)
    made = prep.prompt(F.col("src"), F.col("lang"), F.lit("English"), F.when(F.col("source") == "c1", "").otherwise(R.control_prefix(src=F.col("source"))))
    return p.select("row_id", F.md5(made.cast("binary")).alias("prompt"))


@query(f"SELECT row_id, CASE WHEN row_id % 2 = 0 THEN src ELSE tgt END AS source_text, CASE WHEN row_id % 2 = 0 THEN tgt ELSE src END AS reference FROM ({PAIRS})")
def direction_swap(t):
    return prep.directed(pairs(t), "src", "tgt", F.when(F.col("row_id") % 2 == 0, "forward").otherwise("backward")).select("row_id", "source_text", "reference")


_DOMAIN = "CASE row_id // 1000 % 5 WHEN 0 THEN 'Media' WHEN 1 THEN '' WHEN 2 THEN 'no such' WHEN 3 THEN 'education' ELSE 'narrative' END"


def _control_rows(t: Tables) -> DataFrame:
    return rich(t).select("row_id", F.expr(_DOMAIN.replace("//", "div")).alias("domain"), F.col("lang").alias("dialect"))


@query(f"SELECT row_id, CASE WHEN d IN ('media', 'education', 'narrative') THEN d ELSE 'unknown' END AS domain, CASE WHEN lang IN ('l0', 'l2') THEN lang ELSE 'default' END AS dialect, d NOT IN ('media', 'education', 'narrative') AS domain_fallback, lang NOT IN ('l0', 'l2') AS dialect_fallback FROM (SELECT row_id, lang, lower({_DOMAIN}) AS d FROM ({RICH}))")
def control_modes_oracle(t):
    return prep.control_metadata(_control_rows(t), "domain", "dialect", ["l0", "l2"], "oracle")


@query(f"SELECT 'default' AS mode, count(*) AS rows, count(*) AS domain_fallbacks, count(*) AS dialect_fallbacks FROM ({RICH}) UNION ALL SELECT 'oracle', count(*), count(*) FILTER (lower({_DOMAIN}) NOT IN ('media', 'education', 'narrative')), count(*) FILTER (lang NOT IN ('l0', 'l2')) FROM ({RICH})")
def control_mode_counts(t):
    one = lambda mode: prep.control_metadata(_control_rows(t), "domain", "dialect", ["l0", "l2"], mode).agg(F.lit(mode).alias("mode"), F.count("*").alias("rows"), F.count_if("domain_fallback").alias("domain_fallbacks"), F.count_if("dialect_fallback").alias("dialect_fallbacks"))
    return one("default").union(one("oracle"))


def _share(salt: str, ident: str) -> str:
    return f"CAST('0x' || substr(md5('{salt}' || {ident}), 1, 8) AS BIGINT) / 4294967296.0"


@query(f"SELECT doc_id, CASE WHEN {_share('0:source:', 'doc_id')} < 0.3 THEN 'unknown' ELSE source END AS source, CASE WHEN {_share('0:lang:', 'doc_id')} < 0.1 THEN 'default' ELSE lang END AS lang FROM documents")
def metadata_dropout(t):
    return prep.dropped_out(t.documents.select("doc_id", "source", "lang"), "doc_id", {"source": (0.3, "unknown"), "lang": (0.1, "default")})


@query(f"""WITH n AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang), w AS (SELECT lang, n, sum(pow(n, 0.7)) OVER (ORDER BY lang) - pow(n, 0.7) AS low, sum(pow(n, 0.7)) OVER () AS total FROM n),
d AS (SELECT range AS draw, {_share('0:language:', 'range')} AS u, {_share('0:row:', 'range')} AS v FROM range(2000)), p AS (SELECT draw, v, max(low) AS low FROM d JOIN w ON d.u >= w.low / w.total GROUP BY ALL),
r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i FROM documents) SELECT p.draw, w.lang, r.doc_id FROM p JOIN w ON w.low = p.low JOIN r ON r.lang = w.lang AND r.i = CAST(floor(p.v * w.n) AS BIGINT)""")
def weighted_sampling(t):
    return prep.weighted_draws(t.documents, "doc_id", "lang", 2000)


@query("SELECT doc_id, CAST(row_number() OVER (ORDER BY -n_chars, doc_id) - 1 AS BIGINT) AS place FROM documents")
def length_order(t):
    d = t.documents.select("doc_id", (-F.col("n_chars")).alias("shorter"))
    return prep.dense_numbers(d, ["shorter", "doc_id"], name="place").select("doc_id", "place")


@query("SELECT doc_id, CAST(row_number() OVER (PARTITION BY lang ORDER BY source, doc_id) - 1 AS BIGINT) AS place, CAST(sum(n_chars) OVER (PARTITION BY lang ORDER BY source, doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto FROM documents")
def canonical_order(t):
    d = prep.dense_numbers(t.documents.select("doc_id", "lang", "source", "n_chars"), ["source", "doc_id"], ["lang"], "place")
    return prep.running_sum(d, "n_chars", ["source", "doc_id"], ["lang"]).select("doc_id", "place", "upto")


@query("SELECT doc_id, lang FROM documents WHERE trim(coalesce(text, '')) <> '' AND lang IN ('en', 'fr')")
def nonempty_whitelist(t):
    return prep.complete_rows(t.documents, ["text"], "lang", ["en", "fr"]).select("doc_id", "lang")


_TYPE = "lower(trim(row_type))"
_LEX = "contains(lower(path), 'dictionary')"
_PIVOT = f"""CASE WHEN {_TYPE} <> 'sentence' THEN 'non_sentence' WHEN {_LEX} THEN 'lexical_source' WHEN NOT usable THEN 'ineligible' WHEN confidence = 'ambiguous' THEN 'ambiguous_standardization'
WHEN {_tokens('src')} < 8 THEN 'short_source' WHEN {_tokens('tgt')} < 8 THEN 'short_pivot' ELSE '' END"""


def _pivot_rules() -> list[rules.Rule]:
    return prep.pivot_rules(F.col("row_type"), F.col("path"), F.col("usable"), F.col("confidence"), F.col("src"), F.col("tgt"), 8, 8)


def _pivoted(t: Tables) -> DataFrame:
    return rich(t).withColumn("_rule", rules.decide(_pivot_rules())).withColumn("reason", rules.named(_pivot_rules(), F.col("_rule"))[1])


@query(f"SELECT row_id, {_PIVOT} AS reason FROM ({RICH})")
def pivot_candidates(t):
    return _pivoted(t).select("row_id", "reason")


@query(f"""SELECT lang, count(*) AS source_rows, count(*) FILTER (origin = 'original') AS original_rows, count(*) FILTER (reason = '') AS candidate_rows, count(*) FILTER (reason IN ('ineligible', 'ambiguous_standardization')) AS ineligible_rows, count(*) FILTER (trim(src) = '') AS empty_rows,
count(DISTINCT {_key('src')}) AS unique_sources, CAST(coalesce(sum(length(tgt)) FILTER (reason = ''), 0) AS BIGINT) AS characters FROM (SELECT *, {_PIVOT} AS reason FROM ({RICH})) GROUP BY lang""")
def pivot_counters(t):
    p = _pivoted(t)
    return p.groupBy("lang").agg(F.count("*").alias("source_rows"), F.count_if(F.col("origin") == "original").alias("original_rows"), F.count_if(F.col("reason") == "").alias("candidate_rows"), F.count_if(F.col("reason").isin("ineligible", "ambiguous_standardization")).alias("ineligible_rows"), F.count_if(F.trim("src") == "").alias("empty_rows"), F.countDistinct(X.key(F.col("src"))).alias("unique_sources"), F.coalesce(F.sum(F.when(F.col("reason") == "", F.length("tgt"))), F.lit(0)).cast("long").alias("characters"))


@query(f"""SELECT row_id, CASE WHEN d NOT IN ('', 'EN') THEN 'detected_language_mismatch' WHEN {_ws('tgt')} = '' THEN 'empty_translation' ELSE '' END AS reason, md5({_ws('tgt')}) AS target_md5, 'synthetic' AS origin, 'train' AS split, 'synthetic' AS flags,
substr(sha256(concat_ws('␟', CASE WHEN row_id = 0 THEN '' ELSE CAST(row_id AS VARCHAR) END, 'en_zh', sha256(src))), 1, 24) AS synthetic_id FROM (SELECT row_id, src, tgt, split_part(upper(CASE row_id // 1000 % 4 WHEN 0 THEN 'en-US' WHEN 1 THEN '' WHEN 2 THEN 'fr' ELSE 'EN' END), '-', 1) AS d FROM ({PAIRS}))""")
def synthetic_rows(t):
    p = pairs(t).withColumns({"detected": F.expr("case row_id div 1000 % 4 when 0 then 'en-US' when 1 then '' when 2 then 'fr' else 'EN' end"), "expected": F.lit("en-GB"), "key": F.sha2(F.col("src").cast("binary"), 256)})
    out = prep.synthetic_rows(p, "row_id", "key", "tgt", "detected", "expected", "en_zh")
    return out.select("row_id", "reason", F.md5(F.col("target_text").cast("binary")).alias("target_md5"), "origin", "split", "flags", "synthetic_id")


@query("SELECT page_id, d, d <> '' AND split_part(upper(d), '-', 1) <> upper(e) AS differs FROM (SELECT page_id, regexp_extract(html, 'lang=\"([a-zA-Z-]+)\"', 1) AS d, split_part(regexp_replace(url, '^[a-zA-Z]+://', ''), '/', 2) AS e FROM pages)")
def detected_language(t):
    p = t.pages.select("page_id", F.regexp_extract("html", 'lang="([a-zA-Z-]+)"', 1).alias("d"), F.split_part(F.regexp_replace("url", "^[a-zA-Z]+://", ""), F.lit("/"), F.lit(2)).alias("e"))
    return p.select("page_id", "d", prep.language_differs(F.col("d"), F.col("e")).alias("differs"))


@query(f"SELECT row_id, origin = 'synthetic' AS synthetic, e AND origin <> 'synthetic' AS human_candidate, e AS candidate FROM (SELECT row_id, origin, NOT (su <= 2 AND tu <= 3) AND su BETWEEN 2 AND 384 AND tu BETWEEN 2 AND 384 AND (su + tu >= 6 OR (su + tu >= 5 AND {_terminal('src')} AND {_terminal('tgt')})) AND {_TYPE} = 'sentence' AND usable AND confidence <> 'ambiguous' AS e FROM (SELECT *, {_tokens('src')} AS su, {_tokens('tgt')} AS tu FROM ({RICH})))")
def evaluation_masks(t):
    p = rich(t)
    p = p.withColumn("candidate", rules.eligible(p, row_type="row_type", usable="usable", confidence="confidence"))
    human = F.col("origin") != "synthetic"
    return p.select("row_id", (~human).alias("synthetic"), (F.col("candidate") & human).alias("human_candidate"), "candidate")


@query(f"""SELECT lang, count(*) AS rows, CAST(sum({_tokens('src')}) AS BIGINT) AS tokens, count(*) FILTER ({_share('0:source:', 'row_id')} < 0.5) AS without_source FROM ({RICH}) WHERE split = 'train' AND trim(src) <> '' AND trim(tgt) <> '' AND usable GROUP BY lang""")
def training_rows(t):
    p = prep.complete_rows(rich(t).where("split = 'train' and usable"), ["src", "tgt"], "lang", ["l0", "l1", "l2", "l3"])
    p = prep.dropped_out(p, "row_id", {"source": (0.5, "unknown")})
    return p.groupBy("lang").agg(F.count("*").alias("rows"), F.sum(X.token_count(F.col("src"))).alias("tokens"), F.count_if(F.col("source") == "unknown").alias("without_source"))


@query(f"SELECT tag, count(*) AS rows FROM (SELECT unnest(['<to_' || lang || '>', '<src_' || source || '>']) AS tag FROM ({RICH})) WHERE tag NOT IN ('<to_l0>', '<to_l1>', '<src_c0>', '<src_c1>', '<src_c2>') GROUP BY tag")
def tag_coverage(t):
    p = rich(t)
    tags = p.select(F.explode(F.array(R.control_prefix(to=F.col("lang")), R.control_prefix(src=F.col("source")))).alias("tag"))
    known = t.spark.createDataFrame([(x,) for x in ("<to_l0>", "<to_l1>", "<src_c0>", "<src_c1>", "<src_c2>")], "tag string")
    return tags.join(known, "tag", "left_anti").groupBy("tag").agg(F.count("*").alias("rows"))


# ---- paths, scalars ----

_PAGE_PATH = "CASE page_id % 4 WHEN 0 THEN 'Corpora/' ELSE CASE page_id % 4 WHEN 1 THEN 'Final_XML/' ELSE 'x/' END END || split_part(regexp_replace(url, '^[a-zA-Z]+://', ''), '/', 1) || '/XML/' || split_part(regexp_replace(url, '^[a-zA-Z]+://', ''), '/', 2) || '/a b' || page_id || CASE WHEN page_id % 3 = 0 THEN '.XML' ELSE '.txt' END"


def _page_paths(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.expr(_PAGE_PATH).alias("path"))


@query(f"""SELECT page_id, x AND p[1] = 'Corpora' AND len(p) >= 3 AND list_contains(p[1:len(p) - 1], 'XML') AS public, x AND p[1] IN ('Final_XML', 'XML') AND len(p) >= 2 AS private, CASE WHEN len(p) >= 3 AND p[1] = 'Corpora' THEN p[2] END AS root, regexp_matches(lower(path), 'example.com|/de/') AS excluded,
CASE WHEN list_position(p, 'XML') > 0 THEN coalesce(p[list_position(p, 'XML') + 1], '') ELSE '' END AS repository, list_has_any(string_split(lower(path), '/'), ['fr', 'de']) AS component, replace(path, ' ', '%20') AS encoded FROM (SELECT *, string_split(path, '/') AS p, lower(path) LIKE '%.xml' AS x FROM (SELECT page_id, {_PAGE_PATH} AS path FROM pages))""")
def path_predicates(t):
    x = F.col("path")
    return _page_paths(t).select("page_id", P.public_xml(x).alias("public"), P.private_xml(x).alias("private"), P.corpus_root(x).alias("root"), P.contains_any(x, P.pattern_list("Example.com, /de/")).alias("excluded"), P.repository(x, "XML").alias("repository"), P.has_component(x, {"fr", "de"}).alias("component"), P.percent_encoded(x).alias("encoded"))


@query(f"SELECT page_id, CASE WHEN contains(path, '/fr/') THEN 'fra' WHEN contains(path, '/de/') THEN 'deu' ELSE '' END AS hints, contains(path, '/fr/') OR NOT contains(path, '/de/') AS may_be_french FROM (SELECT page_id, {_PAGE_PATH} AS path FROM pages)")
def path_language_hints(t):
    hints = {"fr": "fra", "de": "deu"}
    x = F.col("path")
    return _page_paths(t).select("page_id", F.array_join(P.language_hints(x, hints), ",").alias("hints"), P.may_match_language(x, F.lit("FRA "), hints).alias("may_be_french"))


@query("SELECT s_suppkey, lower(replace(s_name, '#', '-')) AS name FROM supplier")
def repository_names(t):
    x = F.concat(F.lit("https://github.com/some/"), F.replace("s_name", F.lit("#"), F.lit("-")), F.lit(".git/"))
    return t.supplier.select("s_suppkey", P.repository_name(x).alias("name"))


@query(r"SELECT doc_id, n, regexp_matches(line, '^[\s\p{P}\p{S}]*$') AS marks_only FROM (SELECT doc_id, n, ls[n] AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS n FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)))")
def punctuation_only_lines(t):
    d = t.documents.select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("i", "line"))
    return d.select("doc_id", (F.col("i") + 1).cast("long").alias("n"), X.marks_only(F.col("line")).alias("marks_only"))


@query("SELECT doc_id, translate(coalesce(text, ''), '，。！？：；（）', ',.!?:;()') AS text FROM documents")
def mapped_characters(t):
    return t.documents.select("doc_id", X.mapped(F.col("text"), X.FULL_WIDTH).alias("text"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS utc, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS seconds, ts >= TIMESTAMP '2024-01-02 00:00:00' AS recent FROM events")
def utc_times(t):
    utc = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    http = F.to_timestamp(F.lit("02 Jan 2024 00:00:00"), "dd MMM yyyy HH:mm:ss")
    return t.events.select("event_id", utc.alias("utc"), F.unix_timestamp("ts").alias("seconds"), (F.col("ts") >= http).alias("recent"))


@query("SELECT event_id, '{\"k\":' || CAST(json_extract(props, '$.k') AS VARCHAR) || ',\"t\":\"' || event_type || '\"}' AS canonical, sha256('{\"k\":' || CAST(json_extract(props, '$.k') AS VARCHAR) || ',\"t\":\"' || event_type || '\"}') AS digest FROM events")
def canonical_json(t):
    body = F.to_json(F.struct(F.from_json("props", "k long")["k"].alias("k"), F.col("event_type").alias("t")))
    return t.events.select("event_id", body.alias("canonical"), F.sha2(body.cast("binary"), 256).alias("digest"))


@query("SELECT user_id, k AS event_type, CAST(n AS BIGINT) AS n, CAST(coalesce(n, 0) + 10 AS BIGINT) AS with_default FROM (SELECT user_id, event_type AS k, count(*) AS n FROM events GROUP BY ALL)")
def counter_maps(t):
    per = t.events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    maps = per.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    plus = F.map_zip_with("m", F.transform_values("m", lambda k, v: F.lit(10)), lambda k, a, b: a + b)
    return maps.select("user_id", "m", plus.alias("p")).select("user_id", F.explode("m").alias("event_type", "n"), "p").select("user_id", "event_type", "n", F.try_element_at("p", F.col("event_type")).cast("long").alias("with_default"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, lower(trim(l_returnflag)) IN ('r', 'a') AS strict, lower(trim(l_linestatus)) = 'o' AS loose FROM lineitem WHERE l_quantity > 40")
def boolean_dialects(t):
    strict = X.bool_parse(F.col("l_returnflag"), ("r", "a"), ("n",))
    return t.lineitem.where("l_quantity > 40").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", strict.alias("strict"), X.bool_parse(F.col("l_linestatus"), ("o",), (), strict=False).alias("loose"))


@query("SELECT path, regexp_extract(path, '^([a-z]+)_to_([a-z]+)[.]csv$', 1) AS lang, regexp_extract(path, '^([a-z]+)_to_([a-z]+)[.]csv$', 2) AS target FROM (SELECT DISTINCT lang || '_to_' || CASE WHEN doc_id % 2 = 0 THEN 'en' ELSE 'zh' END || CASE WHEN doc_id % 3 = 0 THEN '.csv' ELSE '_quarantine.csv' END AS path FROM documents) WHERE path NOT LIKE '%quarantine%'")
def input_discovery(t):
    from weftline.sources.tables import discovered

    name = F.concat("lang", F.lit("_to_"), F.when(F.col("doc_id") % 2 == 0, "en").otherwise("zh"), F.when(F.col("doc_id") % 3 == 0, ".csv").otherwise("_quarantine.csv"))
    return discovered(t.documents.select(name.alias("path")).distinct())


# ---- reports ----


@query("""SELECT source, rule, CAST(sum(n) AS BIGINT) AS total, count(*) AS rows FROM (SELECT source, unnest(['digits', 'lines', 'upper']) AS rule, unnest([len(regexp_extract_all(coalesce(text, ''), '[0-9]')), len(regexp_extract_all(coalesce(text, ''), chr(10))), len(regexp_extract_all(coalesce(text, ''), '[A-Z]'))]) AS n FROM documents) WHERE n > 0 GROUP BY ALL""")
def rule_totals(t):
    count = lambda p: F.regexp_count(F.coalesce("text", F.lit("")), F.lit(p))
    return reports.rule_totals(t.documents, ["source"], {"digits": count("[0-9]"), "lines": count("\n"), "upper": count("[A-Z]")})


@query("SELECT rule, CAST(sum(n) AS BIGINT) AS total, count(*) AS rows FROM (SELECT unnest(['clicks', 'errors']) AS rule, unnest([count(*) FILTER (event_type = 'click'), count(*) FILTER (event_type = 'error')]) AS n FROM events GROUP BY user_id) WHERE n > 0 GROUP BY rule")
def multi_counter(t):
    per = t.events.groupBy("user_id").agg(F.count_if(F.col("event_type") == "click").alias("c"), F.count_if(F.col("event_type") == "error").alias("e"))
    return reports.rule_totals(per, [], {"clicks": F.col("c"), "errors": F.col("e")})


@query("SELECT lang, source, count(*) AS size, avg(n_chars) AS mean_size FROM documents GROUP BY ALL")
def group_profile(t):
    return reports.group_profile(t.documents, ["lang", "source"], F.col("n_chars"))


@query("SELECT lang, source, CAST(sum(n) AS BIGINT) AS rows, max(n) AS largest, greatest(2, CAST(ceil(sum(n) * 0.02::DOUBLE) AS BIGINT), max(n) - 1) AS tolerance FROM (SELECT lang, source, md5(coalesce(text, '')) AS g, count(*) AS n FROM documents GROUP BY ALL) GROUP BY lang, source")
def group_tolerance(t):
    return reports.tolerance(t.documents.select("lang", "source", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("g")), ["lang", "source"], "g")


@query(f"SELECT count(*) AS rows, count(*) - count(DISTINCT {_key('text')}) AS duplicate_pairs, 0 AS duplicate_ids FROM documents")
def duplicate_counts(t):
    return reports.duplicate_counts(t.documents.select("doc_id", F.sha2(X.key(F.col("text")).cast("binary"), 256).alias("k")), "doc_id", ["k"])


@query("SELECT avg(chars) AS chars, avg(share) AS share, count(*) AS groups FROM (SELECT lang, avg(n_chars) AS chars, avg(CAST(n_chars > 1000 AS INT)) AS share FROM documents GROUP BY lang)")
def macro_average(t):
    return reports.macro_average(t.documents, "lang", {"chars": F.col("n_chars"), "share": (F.col("n_chars") > 1000).cast("int")})


@query("SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand HAVING count(*) >= 50 ORDER BY n DESC, p_brand LIMIT 20")
def frequent_tags(t):
    return reports.frequent(t.part, "p_brand", 50, 20)


@query(f"""WITH n AS (SELECT lang, count(*) AS rows, count(*) FILTER (split = 'test') AS test, count(*) FILTER (split = 'validate') AS validate FROM ({RICH}) GROUP BY lang)
SELECT lang, rows, 'test' AS split, CAST(ceil(rows * 0.1::DOUBLE) AS BIGINT) AS required, test AS observed, test + 0.02 * rows >= ceil(rows * 0.1::DOUBLE) AS ok FROM n UNION ALL SELECT lang, rows, 'validate', CAST(ceil(rows * 0.05::DOUBLE) AS BIGINT), validate, validate + 0.02 * rows >= ceil(rows * 0.05::DOUBLE) FROM n""")
def ratio_audit(t):
    return reports.ratio_audit(rich(t), "lang", "split", {"test": 0.1, "validate": 0.05}, 0.02)


@query("SELECT q.lang, q.source, q.quota, coalesce(a.n, 0) AS actual, greatest(q.quota - coalesce(a.n, 0), 0) AS missing FROM (SELECT lang, source, CAST(ceil(count(*) * 0.1::DOUBLE) AS BIGINT) AS quota FROM documents GROUP BY ALL) q LEFT JOIN (SELECT lang, source, count(*) AS n FROM documents WHERE doc_id % 12 = 0 GROUP BY ALL) a ON a.lang = q.lang AND a.source = q.source")
def quota_actual(t):
    d = t.documents
    quotas = d.groupBy("lang", "source").agg(F.ceil(F.count("*") * F.lit(0.1)).cast("long").alias("quota"))
    return reports.quota_actual(quotas, d.where("doc_id % 12 = 0"), ["lang", "source"])


_PIECES = "list_transform(list_filter(string_split({w}, ' '), lambda q: q <> ''), lambda q: CAST(ceil(length(q) / 4.0) AS BIGINT))"
_AUDIT = f"""SELECT lang, length(coalesce(src, '')) AS chars, len(w) AS words, coalesce(list_sum(w), 0) AS s, coalesce(list_sum(v), 0) AS t, len(list_filter(w, lambda n: n >= 5)) AS long, len(list_filter(list_filter(string_split({_ws('src')}, ' '), lambda q: q <> ''), lambda q: regexp_matches(q, '[0-9]'))) AS unk
FROM (SELECT *, {_PIECES.format(w=_ws('src'))} AS w, {_PIECES.format(w=_ws('tgt'))} AS v FROM ({RICH}))"""


@query(f"""SELECT lang, count(*) AS sentences, CAST(sum(words) AS BIGINT) AS words, CAST(sum(chars) AS BIGINT) AS chars, CAST(sum(s) AS BIGINT) AS pieces, sum(s) / greatest(sum(words), 1)::DOUBLE AS pieces_per_word, sum(s) / count(*)::DOUBLE AS pieces_per_sentence, sum(s) / greatest(sum(chars), 1)::DOUBLE AS pieces_per_character,
quantile_cont(s, 0.5) AS pieces_median, quantile_cont(s, 0.95) AS pieces_p95, CAST(max(s) AS BIGINT) AS pieces_max, sum(s) / greatest(sum(t), 1)::DOUBLE AS source_target_ratio, 100.0 * sum(long) / greatest(sum(words), 1)::DOUBLE AS pct_words_5_pieces, CAST(sum(unk) AS BIGINT) AS unk_pieces,
100.0 * count(*) FILTER (unk > 0) / count(*)::DOUBLE AS pct_sentences_unk, 10000.0 * sum(unk) / greatest(sum(words), 1)::DOUBLE AS unk_per_10k_words, quantile_cont(greatest(s, t), 0.5) AS sequence_median, quantile_cont(greatest(s, t), 0.95) AS sequence_p95, CAST(max(greatest(s, t)) AS BIGINT) AS sequence_max,
count(*) FILTER (greatest(s, t) > 100) AS over_length, 100.0 * count(*) FILTER (greatest(s, t) > 100) / count(*)::DOUBLE AS pct_over_length FROM ({_AUDIT}) GROUP BY lang""")
def tokenizer_audit(t):
    """With pieces of four characters; any tokenizer's pieces can stand in."""
    pieces = lambda w: F.sequence(F.lit(1), F.ceil(F.length(w) / 4.0).cast("int"))
    return reports.tokenizer_audit(rich(t), "lang", "src", "tgt", pieces, lambda w: w.rlike("[0-9]"), 100)


@query("SELECT reason, place, doc_id FROM (SELECT CASE WHEN n_chars < 400 THEN 'short' WHEN n_chars > 5000 THEN 'long' ELSE 'usual' END AS reason, doc_id, row_number() OVER (PARTITION BY CASE WHEN n_chars < 400 THEN 'short' WHEN n_chars > 5000 THEN 'long' ELSE 'usual' END ORDER BY doc_id) AS place FROM documents) WHERE place <= 5")
def evidence_samples(t):
    d = t.documents.withColumn("reason", F.when(F.col("n_chars") < 400, "short").when(F.col("n_chars") > 5000, "long").otherwise("usual"))
    return reports.samples(d, "reason", "doc_id", 5)


@query(f"SELECT reason, place, row_id FROM (SELECT *, row_number() OVER (PARTITION BY reason ORDER BY row_id) AS place FROM (SELECT row_id, {_PIVOT} AS reason FROM ({RICH}))) WHERE place <= 5 AND reason <> ''")
def clean_pair_evidence(t):
    return reports.samples(_pivoted(t).where("reason <> ''"), "reason", "row_id", 5)


@query("SELECT place, doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS place FROM documents) WHERE place <= 20")
def top_twenty(t):
    return reports.top_and_worst(t.documents.select("doc_id", "n_chars"), "doc_id", [F.desc("n_chars"), F.col("doc_id")], 20)


@query("SELECT lang, count(DISTINCT source) AS sources, count(DISTINCT lang) = 1 AS one_lang, count(DISTINCT source) = 1 AS one_source FROM documents GROUP BY lang")
def single_value_check(t):
    return t.documents.groupBy("lang").agg(F.countDistinct("source").alias("sources"), (F.countDistinct("lang") == 1).alias("one_lang"), (F.min("source") == F.max("source")).alias("one_source"))


@query(f"SELECT lang, count(*) FILTER ({_tokens('text')} > 384) AS over, max({_tokens('text')}) AS longest FROM documents GROUP BY lang")
def length_guard(t):
    d = t.documents.select("lang", X.token_count(F.col("text")).alias("n"))
    return d.groupBy("lang").agg(F.count_if(F.col("n") > 384).alias("over"), F.max("n").alias("longest"))


@query("SELECT event_type, sum(value * user_id) / sum(user_id)::DOUBLE AS loss, exp(sum(value * user_id) / sum(user_id)::DOUBLE) AS perplexity FROM (SELECT event_type, value / 100 AS value, user_id FROM events) GROUP BY event_type")
def perplexity_by_type(t):
    return reports.perplexity(t.events.withColumn("value", F.col("value") / 100), ["event_type"], F.col("value"), F.col("user_id"))


@query("SELECT split, bucket, count(*) AS n FROM (SELECT CASE WHEN doc_id % 20 < 17 THEN 'train' WHEN doc_id % 20 = 17 THEN 'validate' ELSE 'test' END AS split, CASE WHEN n_chars <= 1000 THEN 'short' ELSE 'long' END AS bucket FROM documents) GROUP BY ALL")
def split_bucket_counts(t):
    d = t.documents.select(F.expr("case when doc_id % 20 < 17 then 'train' when doc_id % 20 = 17 then 'validate' else 'test' end").alias("split"), F.when(F.col("n_chars") <= 1000, "short").otherwise("long").alias("bucket"))
    return d.groupBy("split", "bucket").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS rows, CAST(sum(CAST('0x' || substr(md5(concat_ws('␟', doc_id, lang, source, coalesce(text, ''))), 1, 8) AS BIGINT)) AS BIGINT) AS digest FROM documents")
def table_digest(t):
    return reports.table_digest(t.documents, ["doc_id", "lang", "source", "text"])


@query(f"""SELECT family, key, train_unique, eval_unique, overlap FROM (WITH r AS (SELECT split = 'train' AS tr, lang, {_key('src')} AS s, {_key('tgt')} AS t FROM ({RICH})), k AS (SELECT tr, 'plain' AS family, unnest(['src', 'tgt', 'pair']) AS key, unnest([s, t, s || '␟' || t]) AS v FROM r UNION ALL SELECT tr, 'task', unnest(['src', 'tgt', 'pair']), unnest([lang || '␟' || s, lang || '␟' || t, lang || '␟' || s || '␟' || t]) FROM r),
u AS (SELECT family, key, v, bool_or(tr) AS a, bool_or(NOT tr) AS b FROM k GROUP BY ALL) SELECT family, key, count(*) FILTER (a) AS train_unique, count(*) FILTER (b) AS eval_unique, count(*) FILTER (a AND b) AS overlap FROM u GROUP BY ALL)""")
def overlap_families(t):
    s, g, sep = X.key(F.col("src")), X.key(F.col("tgt")), F.lit(X.SEPARATOR)
    r = rich(t).select((F.col("split") == "train").alias("tr"), "lang", s.alias("s"), g.alias("t"))
    plain = {"src": F.col("s"), "tgt": F.col("t"), "pair": F.concat("s", sep, "t")}
    kinds = [F.struct(F.lit(f).alias("family"), F.lit(k).alias("key"), (F.concat("lang", sep, v) if f == "task" else v).alias("v")) for f in ("plain", "task") for k, v in plain.items()]
    u = r.select("tr", F.explode(F.array(*kinds)).alias("k")).groupBy("k.family", "k.key", "k.v").agg(F.bool_or("tr").alias("a"), F.bool_or(~F.col("tr")).alias("b"))
    return u.groupBy("family", "key").agg(F.count_if("a").alias("train_unique"), F.count_if("b").alias("eval_unique"), F.count_if(F.col("a") & F.col("b")).alias("overlap"))


def _crossing(keys: str, name: str) -> str:
    cond = " AND ".join(f"{k} <> ''" for k in keys.split(", "))
    return f"""(SELECT count(*) FROM (SELECT lang, {keys} FROM k WHERE {cond} GROUP BY ALL HAVING bool_or(split = 'train') AND bool_or(split IN ('validate', 'test')))) AS train_{name}, (SELECT count(*) FROM (SELECT lang, {keys} FROM k WHERE {cond} GROUP BY ALL HAVING bool_or(split = 'validate') AND bool_or(split = 'test'))) AS eval_{name}"""


_HELD = "split IN ('test', 'validate')"
_ESC = r"""regexp_matches({}, '["”]{{2,}}\s*$')"""
_ELIGIBLE = f"(NOT (su <= 2 AND tu <= 3) AND su BETWEEN 2 AND 384 AND tu BETWEEN 2 AND 384 AND (su + tu >= 6 OR (su + tu >= 5 AND {_terminal('src')} AND {_terminal('tgt')})) AND {_TYPE} = 'sentence' AND usable AND confidence <> 'ambiguous')"
_GATE_ROWS = f"SELECT * FROM ({RICH}) UNION ALL SELECT -1 - row_id, src, tgt || ' x', lang, source, CASE split WHEN 'train' THEN 'test' ELSE 'train' END, row_type, origin, usable, confidence, path, document + 100000000, flags FROM ({RICH}) WHERE document % 6 = 2"


@query(f"""WITH k AS MATERIALIZED (SELECT *, {_key('src')} AS src_key, {_key('tgt')} AS tgt_key, {_skel('src')} AS src_skeleton, {_skel('tgt')} AS tgt_skeleton, {_tokens('src')} AS su, {_tokens('tgt')} AS tu FROM ({_GATE_ROWS}))
SELECT count(*) FILTER (split NOT IN ('train', 'test', 'validate')) AS unknown_split, count(*) FILTER ({_HELD} AND origin = 'synthetic') AS synthetic_eval, count(*) FILTER ({_HELD} AND NOT usable) AS ineligible_eval, count(*) FILTER ({_HELD} AND confidence = 'ambiguous') AS ambiguous_eval,
count(*) FILTER ({_HELD} AND lower(row_type) IN ('lexeme', 'morpheme')) AS lexical_eval, count(*) FILTER ({_HELD} AND lower(row_type) <> 'sentence') AS non_sentence_eval, count(*) FILTER ({_HELD} AND NOT {_ELIGIBLE}) AS lexical_like_eval, count(*) FILTER (su > 384 OR tu > 384) AS length_overflow,
count(*) FILTER ({_ESC.format('src')}) + count(*) FILTER ({_ESC.format('tgt')}) AS malformed_escaping, count(*) FILTER ({_HELD} AND len(flags) > 0) AS uncertain_language_eval, count(*) FILTER ({_HELD} AND {_unbalanced('tgt')}) AS unbalanced_eval, count(*) - count(DISTINCT (lang, src_key, tgt_key)) AS duplicate_pairs,
{', '.join(_crossing(', '.join(f'{s}_{kind}' for s in sides), f'{name}_{kind}') for kind in ('key', 'skeleton') for sides, name in ((['src'], 'src'), (['tgt'], 'tgt'), (['src', 'tgt'], 'pair')))},
(SELECT count(*) FROM (SELECT document FROM k GROUP BY document HAVING bool_or(split = 'train') AND bool_or({_HELD}))) AS document_overlap FROM k""")
def validation_gates(t):
    p = rich(t)
    copy = p.where("document % 6 = 2").withColumns({"row_id": -1 - F.col("row_id"), "tgt": F.concat("tgt", F.lit(" x")), "split": F.when(F.col("split") == "train", "test").otherwise("train"), "document": F.col("document") + 100000000})
    rows = stored(p.unionByName(copy), "gate-rows")
    wide = reports.split_gates(rows, rules.eligible(rows, row_type="row_type", usable="usable", confidence="confidence"), document="document", near=False)
    return wide


@query()
def validation_gates_near(t):
    """The same with the near-duplicate gates, as the list of gates that fail."""
    p = rich(t)
    return reports.failed_gates(reports.split_gates(p, rules.eligible(p, row_type="row_type", usable="usable", confidence="confidence"), document="document"))


@query("SELECT slice, name, rows, chars FROM (SELECT 'lang' AS slice, lang AS name, count(*) AS rows, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY lang UNION ALL SELECT 'source', source, count(*), CAST(sum(n_chars) AS BIGINT) FROM documents GROUP BY source UNION ALL SELECT 'length', CASE WHEN n_chars <= 1000 THEN 'short' ELSE 'long' END, count(*), CAST(sum(n_chars) AS BIGINT) FROM documents GROUP BY ALL UNION ALL SELECT 'lang_length', lang || '/' || CASE WHEN n_chars <= 1000 THEN 'short' ELSE 'long' END, count(*), CAST(sum(n_chars) AS BIGINT) FROM documents GROUP BY ALL UNION ALL SELECT 'labelled', CAST(l.doc_id IS NOT NULL AS VARCHAR), count(*), CAST(sum(n_chars) AS BIGINT) FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY ALL UNION ALL SELECT 'all', 'all', count(*), CAST(sum(n_chars) AS BIGINT) FROM documents)")
def six_slices(t):
    """Six slices in one pass: every row is counted once per slice."""
    d = t.documents.join(t.labels.select("doc_id", F.lit(True).alias("known")), "doc_id", "left")
    size = F.when(F.col("n_chars") <= 1000, "short").otherwise("long")
    slices = {"lang": F.col("lang"), "source": F.col("source"), "length": size, "lang_length": F.concat_ws("/", "lang", size), "labelled": F.coalesce(F.col("known"), F.lit(False)).cast("string"), "all": F.lit("all")}
    flat = d.select("n_chars", F.explode(F.array(*(F.struct(F.lit(k).alias("slice"), v.alias("name")) for k, v in slices.items()))).alias("s"))
    return flat.groupBy("s.slice", "s.name").agg(F.count("*").alias("rows"), F.sum("n_chars").alias("chars"))
