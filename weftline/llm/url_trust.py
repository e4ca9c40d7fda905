"""URL filter: host and path rules, and trust that spreads over the link graph of hosts.

Hosts that a rule allows are the restart set of a personalised PageRank along links; hosts that a rule blocks are the
restart set of one against the links, so that whoever links to blocked hosts is distrusted. A page that no rule fits is
blocked if its host's distrust exceeds its trust by a factor. Links between hosts are added up before each join, and the
state is one row per host and direction. Hub hosts' links and pages are dealt over SALTS tasks, to each of which the hub's
one row is sent.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.plans.storage import discard

from .common import stored

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
SALTS = 16
_LINK = r"""(?s)(?i:href)\s*=\s*["']?[A-Za-z][A-Za-z0-9+.-]*://([^/?#"'\s>]+)"""


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, or null."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: len(r[1])):
        h, _, p = rule.partition("/")
        out = F.when(((host == h) | host.endswith(f".{h}")) & path.startswith(f"/{p}"), F.lit(rule)).otherwise(out)
    return out


def _salt(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SALTS)).alias("salt")


def _to_all_salts(df: DataFrame) -> DataFrame:
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))


def host_scores(pages: DataFrame, rules=RULES, damping: float = 0.85, tolerance: float = 1e-4) -> DataFrame:
    """host, trust, distrust of every host of pages (host, rule, html) or linked from them.

    Power iterations from the seeds go on until the summed change of both is at most tolerance. Each one shrinks the
    change by damping, from 1 at most, so there are log(tolerance) / log(damping) of them at most, however long link chains are.
    """
    allowed = [r for v, r in rules if v == "allow"]
    blocked = [r for v, r in rules if v == "block"]
    share = lambda names: F.sum(F.when(F.col("rule").isin(names), 1).otherwise(0)) / F.count("*")
    seeds = pages.where("host <> ''").groupBy("host").agg(share(allowed).alias("t"), share(blocked).alias("b"))
    links = pages.where("host <> ''").select("host", F.explode_outer(F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1)), lambda h: F.translate(h, UPPER, LOWER)))).alias("to"))
    links = stored(links.where("host <> to").groupBy("host", "to").agg(F.count("*").cast("double").alias("w")), "host-links")
    forward = links.select(F.col("host").alias("a"), F.col("to").alias("b"), "w", F.lit("t").alias("way"))
    both = forward.union(links.select(F.col("to").alias("a"), F.col("host").alias("b"), "w", F.lit("b").alias("way")))
    out = both.groupBy("a", "way").agg(F.sum("w").alias("all"))
    edges = stored(both.join(out, ["a", "way"]).select("way", "a", "b", (damping * F.col("w") / F.col("all")).alias("w"), _salt("b")), "host-edges")
    start = seeds.select("host", F.expr("stack(2, 't', t, 'b', b) as (way, r)")).where("r > 0")
    start = stored(start.select("way", "host", F.col("r").alias("r")), "host-seeds")
    sums = {r["way"]: r["s"] for r in start.groupBy("way").agg(F.sum("r").alias("s")).collect()}  # two rows
    norm = F.when(F.col("way") == "t", F.lit(float(sums.get("t") or 1))).otherwise(F.lit(float(sums.get("b") or 1)))
    base = start.select("way", "host", ((1 - damping) * F.col("r") / norm).alias("r"))
    now = stored(base.withColumn("change", F.col("r")), "host-ranks")
    for _ in range(math.ceil(math.log(tolerance) / math.log(damping)) + 1):
        held = _to_all_salts(now.select("way", F.col("host").alias("a"), "r"))
        moved = held.join(edges, ["way", "a", "salt"]).select("way", F.col("b").alias("host"), (F.col("r") * F.col("w")).alias("r"), F.lit(0.0).alias("before"))
        before = now.select("way", "host", F.lit(0.0).alias("r"), F.col("r").alias("before"))
        added = moved.union(base.withColumn("before", F.lit(0.0))).union(before).groupBy("way", "host").agg(F.sum("r").alias("r"), F.sum("before").alias("before"))
        last, now = now, stored(added.select("way", "host", "r", F.abs(F.col("r") - F.col("before")).alias("change")), "host-ranks")
        discard(last)
        if (now.agg(F.sum("change")).first()[0] or 0.0) <= tolerance:
            break
    discard(edges, start, links)
    total = lambda way: F.sum(F.when(F.col("way") == way, F.col("r")).otherwise(0.0))
    return now.groupBy("host").agg(total("t").alias("trust"), total("b").alias("distrust"))


def judge(pages: DataFrame, rules=RULES, factor: float = 1.0) -> DataFrame:
    """A row per row of pages (page_id, url, html; other columns are ignored): page_id, host, path, rule, verdict.

    The rule's verdict holds where one fits; else block if distrust > factor * trust of the host, else allow. Null urls
    and urls without :// have an empty host and path and are allowed; null html has no links; repeated rows count as
    pages; an empty table gives no rows.
    """
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    own = own.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url"))).withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    bad = host_scores(own.select("host", "rule", "html"), rules).where(F.col("distrust") > factor * F.col("trust")).select("host", F.lit(True).alias("bad"))
    verdict = F.when(F.col("bad"), "block").otherwise("allow")
    for v in ("allow", "block"):
        verdict = F.when(F.col("rule").isin([r for w, r in rules if w == v]), v).otherwise(verdict)
    return own.drop("url", "html").withColumn("salt", _salt("page_id", "path")).join(_to_all_salts(bad), ["host", "salt"], "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"))
