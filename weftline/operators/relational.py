"""Relational operators of corpus curation: priority dedup, first-match joins, layered caches, reconciliation, holdouts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_totals(df: DataFrame, keys: list[str], ident: str, **totals: tuple[str, Column]) -> DataFrame:
    """df with columns of totals over all rows of a key; each is the name of an aggregate (min, max, sum) and its input.

    No window: totals are added up per key and one of n salts first, then per key, and come back per key and salt, so that
    no task meets all rows of a key that a third of the table may have. Null keys are a key of their own.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = {f"_k{i}": F.col(k) for i, k in enumerate(keys)}
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(ident), F.lit(n)))
    add = lambda df, inputs: [getattr(F, kind)(inputs(name, column)).alias(name) for name, (kind, column) in totals.items()]
    parts = salted.groupBy(*[c.alias(k) for k, c in named.items()], "_salt").agg(*add(df, lambda name, column: column))
    whole = parts.groupBy(*named).agg(*add(parts, lambda name, column: F.col(name)))
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    back = parts.drop(*totals).alias("p").join(whole.alias("w"), reduce(lambda x, y: x & y, (same(f"p.{k}", f"w.{k}") for k in named))).select(*(F.col(f"p.{k}") for k in named), F.col("_salt").alias("_at"), *(F.col(f"w.{t}") for t in totals))
    on = reduce(lambda x, y: x & y, (same(k, f"_k{i}") for i, k in enumerate(keys))) & (F.col("_salt") == F.col("_at"))
    return salted.join(back, on).drop(*named, "_salt", "_at")


def looked_up(df: DataFrame, table: DataFrame, keys: list[str], ident: list[str], how: str = "left") -> DataFrame:
    """df joined with table, which has one row per key. Rows of a key are dealt over n salts by ident, and the key's row is sent
    to the salts that it has rows in: no task meets all rows of a key that a third of the table may have. Null keys match nothing."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*ident), F.lit(n)))
    spread = salted.select(*keys, "_salt").distinct().join(table, keys)
    return salted.join(spread, [*keys, "_salt"], how).drop("_salt")


def keep_first(df: DataFrame, keys: list[str], order: list[Column], ident: str) -> DataFrame:
    """df with _kept (the first of its key by the given order, which ends with the unique ident), group_size and canonical_id."""
    first = F.struct(*(c.alias(f"_o{i}") for i, c in enumerate(order)), F.col(ident).alias("_id"))
    out = with_totals(df.withColumns({"_first": first, "_one": F.lit(1).cast("long")}), keys, ident, _least=("min", F.col("_first")), group_size=("sum", F.col("_one")))
    return out.withColumn("canonical_id", F.col("_least._id")).withColumn("_kept", F.col("canonical_id").eqNullSafe(F.col(ident))).drop("_first", "_one", "_least")


def ledger(df: DataFrame, keys: list[str], order: list[Column], ident: str) -> DataFrame:
    """Every row with its disposition: accepted, duplicate (of canonical_id), or what it had before.

    Rows that aren't accepted are keys of their own, so the input is read as one table.
    """
    own = F.when(F.col("disposition") != "accepted", F.col(ident).cast("string"))
    out = keep_first(df.withColumn("_own", own), [*keys, "_own"], order, ident)
    return out.withColumn("disposition", F.when((F.col("disposition") == "accepted") & ~F.col("_kept"), "duplicate").otherwise(F.col("disposition"))).drop("_kept", "_own")


def conservation(df: DataFrame) -> DataFrame:
    """One row: input rows, rows per disposition and whether they add up."""
    n = lambda d: F.count_if(F.col("disposition") == d)
    sums = df.agg(F.count("*").alias("input_rows"), n("accepted").alias("accepted"), n("rejected").alias("rejected"), n("quarantine").alias("quarantine"), n("duplicate").alias("duplicates"))
    return sums.withColumn("conserved", F.col("input_rows") == F.col("accepted") + F.col("rejected") + F.col("quarantine") + F.col("duplicates"))


def first_match(left: DataFrame, right: DataFrame, keys: list[str], order: list[Column], value: str) -> DataFrame:
    """Left join with the first non-empty value of each key on the right."""
    one = right.where(F.coalesce(F.col(value).cast("string"), F.lit("")) != "").withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").select(*keys, value)
    return left.join(one, keys, "left")


def missing_keys(wanted: DataFrame, cached: DataFrame, keys: list[str]) -> DataFrame:
    return wanted.select(*keys).distinct().join(cached.select(*keys), keys, "left_anti")


def layered(cache: DataFrame, keys: list[str], layer: list[Column]) -> DataFrame:
    """The row of the last layer per key."""
    return cache.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*layer))).where("_n = 1").drop("_n")


def conflicts(cache: DataFrame, keys: list[str], layer: list[Column], value: str) -> DataFrame:
    """Keys with the number of times that a layer changed the value."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(*layer))
    return cache.withColumn("_changed", before.isNotNull() & (before != F.col(value))).groupBy(*keys).agg(F.count_if("_changed").alias("changes")).where("changes > 0")


def reconcile(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Keys on one side only: key, side (missing or unexpected)."""
    a, b = expected.select(key).distinct().withColumn("_a", F.lit(1)), found.select(key).distinct().withColumn("_b", F.lit(1))
    return a.join(b, key, "full_outer").where("_a is null or _b is null").select(key, F.when(F.col("_a").isNull(), "unexpected").otherwise("missing").alias("side"))


def union_all(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; absent columns are empty."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.na.fill("")


def top_per_stratum(df: DataFrame, strata: list[str], order: list[Column], most: int | Column, reserve: int = 0) -> DataFrame:
    """The first rows of each stratum, leaving reserve rows of it."""
    w = Window.partitionBy(*strata)
    limit = F.least(most if isinstance(most, Column) else F.lit(most), F.count("*").over(w) - reserve)
    return df.withColumns({"_n": F.row_number().over(w.orderBy(*order)), "_most": limit}).where("_n <= _most").drop("_n", "_most")


def spread_order(ident: str, seed: str) -> Column:
    """A deterministic random order of rows."""
    return F.md5(F.concat(F.lit(seed), F.col(ident).cast("string")).cast("binary"))


def control_prefix(**tags: Column) -> Column:
    """<to_x> <src_y> ... of the given tags."""
    return F.concat_ws(" ", *(F.concat(F.lit(f"<{k}_"), v, F.lit(">")) for k, v in tags.items()))


def budgeted_batches(df: DataFrame, key: str, ident: str, size: Column, most_items: int = 50, most_bytes: int = 120 << 10) -> DataFrame:
    """ident, batch: consecutive items of each key in batches within both budgets; a larger item is alone.

    The greedy scan needs its key's rows in order, so it runs per key; keys should be partitions of the work (files, languages
    with a bucket), not whole corpora.
    """
    import pandas as pd

    def scan(pdf: pd.DataFrame) -> pd.DataFrame:
        batch, items, held, out = 0, 0, 0, []
        pdf = pdf.sort_values("i")
        for n in pdf["n"]:
            if items and (items >= most_items or held + n > most_bytes):
                batch, items, held = batch + 1, 0, 0
            out.append(batch)
            items, held = items + 1, held + n
        return pd.DataFrame({"k": pdf["k"], "i": pdf["i"], "batch": out})

    rows = df.select(F.col(key).cast("string").alias("k"), F.col(ident).cast("long").alias("i"), size.cast("long").alias("n"))
    return rows.groupBy("k").applyInPandas(scan, "k string, i long, batch long").select(F.col("k").alias(key), F.col("i").alias(ident), "batch")
