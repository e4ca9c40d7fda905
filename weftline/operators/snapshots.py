"""Joins of units with the records of earlier steps, status routing, and comparison of snapshots."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators.relational import with_totals


def route(rows: DataFrame, languages: list[str], statuses: list[tuple[str, Column]], kept: str = "kept") -> DataFrame:
    """Each row once per language, with the first status whose condition holds (they may use the column wanted), else kept. No row is dropped."""
    spread = rows.withColumn("wanted", F.explode(F.array(*map(F.lit, languages))))
    return spread.withColumn("status", F.coalesce(*(F.when(c, F.lit(name)) for name, c in statuses), F.lit(kept)))


def locate(units: DataFrame, records: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """units with the values of their record by the locator keys, and missing. A locator that several records have is an error of the records:
    duplicated counts them, and their least values are taken."""
    one = records.groupBy(*keys).agg(F.count("*").alias("duplicated"), F.min(F.struct(*values)).alias("_v"))
    out = units.join(one, keys, "left")
    return out.select(*units.columns, *(F.col(f"_v.{v}").alias(v) for v in values), F.col("duplicated").isNull().alias("missing"), (F.coalesce("duplicated", F.lit(1)) > 1).alias("duplicated"))


def verified(units: DataFrame, records: DataFrame, keys: list[str], text: str, digest: str) -> DataFrame:
    """keys and status of each unit against its record: missing, hash_mismatch (record's digest isn't the SHA-256 of text) or verified."""
    joined = units.select(*keys, F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256).alias("_sha")).join(records.select(*keys, F.col(digest).alias("_digest")), keys, "left")
    return joined.select(*keys, F.when(F.col("_digest").isNull(), "missing").when(F.col("_digest") != F.col("_sha"), "hash_mismatch").otherwise("verified").alias("status"))


def numbered_within(rows: DataFrame, keys: list[str], order: list[Column], name: str = "occurrence") -> DataFrame:
    """rows with their number from 0 within keys (a file and field, a file and id: small groups)."""
    return rows.withColumn(name, (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).cast("long"))


def distinct_ids(rows: DataFrame, file: str, ident: str, order: list[Column], mark: str = "__dup") -> DataFrame:
    """rows with final_id: later rows of an id of a file get `mark` and a number from 2 that no id of the file has yet.

    A number is passed over if the file has that id already, so files with ids that hold the mark are gone through in order.
    """
    again = numbered_within(rows.where(F.coalesce(F.col(ident), F.lit("")) != ""), [file, ident], order, "_n")
    risky = again.where(F.contains(F.col(ident), F.lit(mark))).select(F.col(file).alias("_f")).distinct()
    plain = again.join(risky, F.col(file) == F.col("_f"), "left_anti").withColumn("final_id", F.when(F.col("_n") == 0, F.col(ident)).otherwise(F.concat(F.col(ident), F.lit(mark), (F.col("_n") + 1).cast("string"))))
    hard = again.join(risky, F.col(file) == F.col("_f"), "left_semi").withColumn("_o", F.struct(*(c.alias(f"o{i}") for i, c in enumerate(order))))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in hard.drop("_o").schema.fields) + ", final_id string"

    def probe(pdf):
        seen, out, times = set(), [], {}
        for i in pdf.sort_values("_place")[ident]:
            times[i] = k = times.get(i, 0) + 1
            new = i
            while new in seen:
                k = max(k, 2)
                new = f"{i}{mark}{k}"
                k += 1
            seen.add(new)
            out.append(new)
        return pdf.sort_values("_place").assign(final_id=out).drop(columns=["_place"])

    placed = hard.withColumn("_place", F.row_number().over(Window.partitionBy(file).orderBy("_o"))).drop("_o")
    return plain.unionByName(placed.groupBy(file).applyInPandas(probe, schema)).drop("_n")


Steps = list[tuple[str, Callable[[Column], Column]]]


def cleaned(text: Column, steps: Steps) -> Column:
    for _, step in steps:
        text = step(text)
    return text


def audit_changes(before: DataFrame, after: DataFrame, keys: list[str], text: str, steps: Steps) -> DataFrame:
    """A row per field that either snapshot has: keys, state (kept, modified, removed, added), rules, unclassified.

    A modified field is put through the steps in order; each one that changes it is a rule, and it is unclassified if the
    outcome isn't the text found after.
    """
    both = before.select(*keys, F.col(text).alias("_a"), F.lit(1).alias("_in")).join(after.select(*keys, F.col(text).alias("_b"), F.lit(1).alias("_out")), keys, "full_outer")
    work = both.withColumn("_w0", F.col("_a"))
    for i, (_, step) in enumerate(steps):
        work = work.withColumn(f"_w{i + 1}", step(F.col(f"_w{i}")))
    state = F.when(F.col("_in").isNull(), "added").when(F.col("_out").isNull(), "removed").when(F.col("_a").eqNullSafe(F.col("_b")), "kept").otherwise("modified")
    rules = F.filter(F.array(*(F.when(~F.col(f"_w{i}").eqNullSafe(F.col(f"_w{i + 1}")), F.lit(name)) for i, (name, _) in enumerate(steps))), lambda x: x.isNotNull())
    return work.select(*keys, state.alias("state"), F.when(state == "modified", rules).otherwise(F.array().cast("array<string>")).alias("rules"), ((state == "modified") & ~F.col(f"_w{len(steps)}").eqNullSafe(F.col("_b"))).alias("unclassified"))


def repairs(rows: DataFrame, keys: list[str], text: str, steps: Steps) -> DataFrame:
    """A row per step that changes a text, in order: keys, repair, before_sha256, after_sha256."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    work = rows.select(*keys, F.coalesce(F.col(text), F.lit("")).alias("_w0"))
    for i, (_, step) in enumerate(steps):
        work = work.withColumn(f"_w{i + 1}", step(F.col(f"_w{i}")))
    every = F.array(*(F.when(F.col(f"_w{i}") != F.col(f"_w{i + 1}"), F.struct(F.lit(name).alias("repair"), sha(F.col(f"_w{i}")).alias("before_sha256"), sha(F.col(f"_w{i + 1}")).alias("after_sha256"))) for i, (name, _) in enumerate(steps)))
    return work.select(*keys, F.explode_outer(F.filter(every, lambda x: x.isNotNull())).alias("r")).where("r is not null").select(*keys, "r.repair", "r.before_sha256", "r.after_sha256")


def inventory(before: DataFrame, after: DataFrame, ident: str, index: str) -> DataFrame:
    """Each unit of before with its final index: ident, index, final_index, status (retained or removed)."""
    return before.select(ident, index).join(after.select(ident, F.col(index).alias("final_index")), ident, "left").withColumn("status", F.when(F.col("final_index").isNull(), "removed").otherwise("retained"))


def completed(units: DataFrame, standard: str, fallbacks: list[str]) -> DataFrame:
    """units with completed (standard, else the first fallback that isn't empty), tier (its name, or missing) and preserved:
    a standard that was there has the same digest before and after."""
    tiers = [standard, *fallbacks]
    full = lambda c: F.when(F.trim(F.coalesce(F.col(c), F.lit(""))) != "", F.col(c))
    out = units.withColumn("completed", F.coalesce(*map(full, tiers), F.lit("")))
    tier = F.coalesce(*(F.when(full(c).isNotNull(), F.lit(c)) for c in tiers), F.lit("missing"))
    return out.withColumn("tier", tier).withColumn("preserved", full(standard).isNull() | (F.md5(F.col(standard).cast("binary")) == F.md5(F.col("completed").cast("binary"))))


def alternates(rows: DataFrame, unit: list[str], language: str, order: list[Column]) -> DataFrame:
    """rows with alternate: not the first translation of its unit in its language."""
    return numbered_within(rows, [*unit, language], order, "_n").withColumn("alternate", F.col("_n") > 0).drop("_n")


def cached(rows: DataFrame, cache: DataFrame, key: str, value: str) -> DataFrame:
    """rows with the cache's value of their key and missing. Keys of the cache are distinct."""
    return rows.join(cache.select(key, value, F.lit(False).alias("_m")), key, "left").withColumn("missing", F.coalesce("_m", F.lit(True))).drop("_m")


def checked_cache(cache: DataFrame, key: str, parts: list[Column], value: str) -> DataFrame:
    """cache with state: corrupt (the key isn't the SHA-256 of its parts), conflict (its key has several values) or good."""
    own = F.sha2(F.concat_ws("␟", *parts).cast("binary"), 256)
    marked = cache.withColumn("_own", own == F.col(key))
    good = F.when(F.col("_own"), F.col(value))
    seen = with_totals(marked.withColumn("_id", F.concat_ws("␟", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cache.columns))), [key], "_id", _low=("min", good), _high=("max", good))
    return seen.withColumn("state", F.when(~F.col("_own"), "corrupt").when(F.col("_low") != F.col("_high"), "conflict").otherwise("good")).drop("_own", "_low", "_high", "_id")


def group_fold(rows: DataFrame, key: str, order: str, size: Column, take: Callable[[int, int], tuple[bool, int]], start: int) -> DataFrame:
    """key, order, taken of rows in order within key: take(state, size) says whether a row is taken, and the state after.

    A fold has no other way than in order; keys should be parts of the work, not whole corpora.
    """
    import pandas as pd

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, state, out = pdf.sort_values("i"), start, []
        for n in pdf["n"]:
            ok, state = take(state, int(n))
            out.append(ok)
        return pd.DataFrame({"k": pdf["k"], "i": pdf["i"], "taken": out})

    plain = rows.select(F.col(key).cast("string").alias("k"), F.col(order).cast("long").alias("i"), size.cast("long").alias("n"))
    return plain.groupBy("k").applyInPandas(fold, "k string, i long, taken boolean").select(F.col("k").alias(key), F.col("i").alias(order), "taken")


def within_budget(rows: DataFrame, key: str, order: str, size: Column, budget: int) -> DataFrame:
    """Rows that a budget per key allows, in order; one that is too large is passed over, and later smaller ones may fit."""
    return group_fold(rows, key, order, size, lambda left, n: (n <= left, left - n if n <= left else left), budget)
