"""The registered queries of this subpackage: thin calls of the operators on whole tables, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontam, jaccard_join, lm_bloom, packing, quality_model, rule_forest, secrets, suffix_dedup, url_trust, warc
from .common import table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"), width=3, num=90, den=100)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_lm_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_bloom.lm_scores(table(spark, sf_dir, "documents"))


def op9_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_trust.judge(table(spark, sf_dir, "pages"))


def op10_rule_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_forest.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("anomaly")


QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_secret_scan, op3_quality, op4_ngram_jaccard, op5_warc, op6_packing, op7_decontamination, op8_lm_bloom, op9_url_trust, op10_rule_forest)}

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"[^\x20\x09-\x0D]+"

_JACCARD = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWERED}, '{_WORDS}') AS w FROM documents),
s AS (SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g FROM d),
n AS (SELECT rid, doc_id, len(g) AS n FROM s),
e AS (SELECT rid, unnest(g) AS x FROM s),
p AS (SELECT a.rid AS x, b.rid AS y, count(*) AS i FROM e a JOIN e b ON a.x = b.x AND a.rid <> b.rid GROUP BY ALL),
l AS (SELECT p.x, p.y FROM p JOIN n a ON a.rid = p.x JOIN n b ON b.rid = p.y WHERE 100 * i >= 90 * (a.n + b.n - i)),
r(x, y) AS (SELECT rid, rid FROM n UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT r.x, min(n.doc_id) AS component_id FROM r JOIN n ON n.rid = r.y GROUP BY r.x),
k AS (SELECT x, count(*) AS n_links FROM l GROUP BY x)
SELECT n.doc_id, n.n AS n_shingles, c.component_id, coalesce(k.n_links, 0) AS n_links
FROM n JOIN c ON c.x = n.rid LEFT JOIN k ON k.x = n.rid"""

_WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS x FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY x) AS head FROM d)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(x, CAST(5 * (i // 4) + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS INT) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> head THEN head END AS refers_to
FROM m"""


def _url_sql(rounds: int = 58, damping: float = 0.85) -> str:
    rules = sorted(url_trust.RULES, key=lambda r: -len(r[1]))

    def fits(rule: str) -> str:
        h, _, p = rule.partition("/")
        return f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '/{p}')"

    rule = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r}'" for _, r in rules) + " END"
    listed = {v: ", ".join(f"'{r}'" for w, r in rules if w == v) for v in ("allow", "block")}
    lower = lambda x: f"translate({x}, '{url_trust.UPPER}', '{url_trust.LOWER}')"
    link = url_trust._LINK.replace("'", "''")
    steps = [f"r{i + 1} AS MATERIALIZED (SELECT way, host, sum(r) AS r FROM (SELECT e.way, e.b AS host, r.r * e.w AS r FROM r{i} r JOIN edges e ON e.way = r.way AND e.a = r.host UNION ALL SELECT * FROM r0) GROUP BY way, host)" for i in range(rounds)]
    return f"""
WITH u AS (SELECT page_id, html, {lower(f"regexp_extract(coalesce(url, ''), '{url_trust._URL}', 1)")} AS host, regexp_extract(coalesce(url, ''), '{url_trust._URL}', 2) AS path FROM pages),
p AS MATERIALIZED (SELECT *, {rule} AS rule FROM u),
seeds AS (SELECT host, sum(CASE WHEN rule IN ({listed["allow"]}) THEN 1 ELSE 0 END) / count(*) AS t, sum(CASE WHEN rule IN ({listed["block"]}) THEN 1 ELSE 0 END) / count(*) AS b FROM p WHERE host <> '' GROUP BY host),
found AS (SELECT host, unnest(list_distinct(list_transform(regexp_extract_all(coalesce(html, ''), '{link}', 1), lambda h: {lower("h")}))) AS target FROM p WHERE host <> ''),
links AS (SELECT host, target, count(*)::DOUBLE AS w FROM found WHERE host <> target GROUP BY ALL),
ways AS (SELECT 't' AS way, host AS a, target AS b, w FROM links UNION ALL SELECT 'b', target, host, w FROM links),
edges AS MATERIALIZED (SELECT way, a, b, {damping} * w / sum(w) OVER (PARTITION BY way, a) AS w FROM ways),
start AS (SELECT 't' AS way, host, t AS r FROM seeds WHERE t > 0 UNION ALL SELECT 'b', host, b FROM seeds WHERE b > 0),
r0 AS MATERIALIZED (SELECT way, host, {1 - damping} * r / sum(r) OVER (PARTITION BY way) AS r FROM start),
{", ".join(steps)},
bad AS (SELECT host FROM r{rounds} GROUP BY host HAVING sum(CASE WHEN way = 'b' THEN r ELSE 0 END) > sum(CASE WHEN way = 't' THEN r ELSE 0 END))
SELECT page_id, p.host, path, rule, CASE WHEN rule IN ({listed["allow"]}) THEN 'allow' WHEN rule IN ({listed["block"]}) THEN 'block' WHEN bad.host IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM p LEFT JOIN bad ON bad.host = p.host"""


ORACLES = {"op4_ngram_jaccard": _JACCARD, "op5_warc": _WARC, "op9_url_trust": _url_sql()}
