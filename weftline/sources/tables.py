"""Table sources and sinks: strict CSV, JSON lines, hash-bound Parquet companions, and manifests."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """All columns as text; nothing is read as missing but absent cells, which become empty. columns must be there."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=False, nullValue="\u0000", emptyValue="")
    if columns and (absent := [c for c in columns if c not in df.columns]):
        raise ValueError(f"{path}: missing columns {absent}")
    return df.na.fill("")


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines; a malformed line is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """`before -> after : n` lines: before, after, n."""
    p = "^(.*?)\\s*(?:->|→)\\s*(.*?)\\s*:\\s*(\\d+)\\s*$"
    return spark.read.text(path).where(F.col("value").rlike(p)).select(*(F.regexp_extract("value", p, i).alias(c) for i, c in ((1, "before"), (2, "after"))), F.regexp_extract("value", p, 3).cast("long").alias("n"))


def contract(df: DataFrame, **violations) -> DataFrame:
    """One row of counts of rows that break each named condition (a Column that is true for a violation)."""
    return df.agg(*(F.count_if(v).alias(k) for k, v in violations.items()))


def content_digest(df: DataFrame) -> str:
    """A digest of a table's rows that doesn't depend on their order: count and the sum of row hashes."""
    r = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")), F.lit(0)).alias("s")).first()
    return f"{r['n']}-{int(r['s']) % (1 << 128):032x}"


def write_with_manifest(df: DataFrame, path: str, source_digest: str) -> None:
    """Parquet (zstd) beside a manifest that binds it to the digest of what it was made from."""
    df.write.option("compression", "zstd").mode("errorifexists").parquet(f"{path}/data")
    body = json.dumps({"complete": True, "source": source_digest, "rows": df.count()}, sort_keys=True)
    df.sparkSession.createDataFrame([(body,)], "value string").coalesce(1).write.text(f"{path}/manifest")


def read_with_manifest(spark: SparkSession, path: str, source_digest: str) -> DataFrame:
    """The companion; raises if it is incomplete or was made from something else."""
    body = json.loads(spark.read.text(f"{path}/manifest").first()["value"])
    if not body.get("complete") or body["source"] != source_digest:
        raise ValueError(f"{path} is stale or incomplete")
    return spark.read.parquet(f"{path}/data")


def write_ledger(df: DataFrame, path: str) -> None:
    """Rows partitioned by disposition."""
    df.write.partitionBy("disposition").parquet(path)


def discovered(files: DataFrame, pattern: str = "^([a-z]+)_to_([a-z]+)[.]csv$", excluded: str = "quarantine") -> DataFrame:
    """path, lang, target of the files (path) whose name says both; excluded ones are left out."""
    name = F.element_at(F.split("path", "/"), -1)
    found = files.where(name.rlike(pattern) & ~F.lower(name).rlike(excluded))
    return found.select("path", F.regexp_extract(name, pattern, 1).alias("lang"), F.regexp_extract(name, pattern, 2).alias("target"))


def checked_csv(spark: SparkSession, path: str, texts: list[str], language: str, allowed: list[str]) -> DataFrame:
    """A CSV of sentence pairs whose texts must not be blank and whose languages must be allowed; raises with what is wrong."""
    df = read_csv(spark, path, [*texts, language])
    blank = lambda c: F.trim(F.col(c)) == ""
    found = contract(df, **{f"blank_{c}": blank(c) for c in texts}, unknown_language=~F.col(language).isin(*allowed)).first().asDict()
    if any(found.values()):
        raise ValueError(f"{path}: {({k: n for k, n in found.items() if n})}")
    return df


def write_csv(df: DataFrame, path: str) -> None:
    """Quoted so that any text comes back as it was. Spark's committer leaves nothing readable of a write that fails."""
    df.write.mode("errorifexists").csv(path, header=True, escape='"', quoteAll=True, nullValue="", emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_jsonl(df: DataFrame, path: str, order: list[str]) -> None:
    """JSON lines in order, columns by name."""
    df.select(*sorted(df.columns)).repartitionByRange(*order).sortWithinPartitions(*order).write.mode("errorifexists").json(path, ignoreNullFields=False)


def write_inventory(df: DataFrame, path: str, source_digest: str, order: list[str]) -> None:
    """JSON lines beside a manifest that binds them to what they were made from, and to their own rows."""
    write_jsonl(df, f"{path}/data", order)
    body = json.dumps({"complete": True, "source": source_digest, "digest": content_digest(df.select(*sorted(df.columns)))}, sort_keys=True)
    df.sparkSession.createDataFrame([(body,)], "value string").coalesce(1).write.text(f"{path}/manifest")


def read_inventory(spark: SparkSession, path: str, schema: str, source_digest: str) -> DataFrame:
    """The rows; raises if the inventory is incomplete, made from something else, or not as it was written."""
    body = json.loads(spark.read.text(f"{path}/manifest").first()["value"])
    if not body.get("complete") or body["source"] != source_digest:
        raise ValueError(f"{path} is stale or incomplete")
    out = read_jsonl(spark, f"{path}/data", schema)
    if content_digest(out.select(*sorted(out.columns))) != body["digest"]:
        raise ValueError(f"{path} has changed")
    return out


def write_splits(df: DataFrame, path: str, split: str = "split") -> None:
    """A folder per split."""
    df.write.mode("errorifexists").partitionBy(split).parquet(path)


def blob_digest(content: Column) -> Column:
    """The content's address: SHA-1 of "blob", its length, a zero byte, and the bytes."""
    raw = content.cast("binary")
    head = F.concat(F.lit("blob ").cast("binary"), F.octet_length(raw).cast("string").cast("binary"), F.unhex(F.lit("00")))
    return F.sha1(F.concat(head, raw))


def landed(files: DataFrame, listing: DataFrame) -> DataFrame:
    """path and status of each listed blob (path, sha) among landed files (path, content): download_error, checksum_error or kept."""
    found = files.select("path", blob_digest(F.col("content")).alias("_found"))
    out = listing.join(found, "path", "left")
    return out.select("path", F.when(F.col("_found").isNull(), "download_error").when(F.col("_found") != F.col("sha"), "checksum_error").otherwise("kept").alias("status"))


@dataclass(frozen=True)
class SplitPolicy:
    """Ratios, limits and thresholds of a split, with the invariants that hold between them; from_json also rejects unknown keys."""

    train_ratio: float = 0.85
    validate_ratio: float = 0.05
    test_ratio: float = 0.10
    seed: int = 42
    least_tokens: int = 2
    most_units: int = 384
    similarity: float = 0.95
    source_tolerance: float = 0.02

    def __post_init__(self):
        ratios = (self.train_ratio, self.validate_ratio, self.test_ratio)
        wrong = [name for name, ok in (
            ("ratios must add up to one", math.isclose(sum(ratios), 1.0)), ("ratios must be between 0 and 1", all(0 < r < 1 for r in ratios)),
            ("least_tokens must be positive and below most_units", 0 < self.least_tokens < self.most_units), ("similarity must be above 0, at most 1", 0 < self.similarity <= 1), ("source_tolerance must be in [0, 1)", 0 <= self.source_tolerance < 1),
        ) if not ok]
        if wrong:
            raise ValueError("; ".join(wrong))

    @classmethod
    def from_json(cls, body: str) -> SplitPolicy:
        got = json.loads(body)
        if unknown := sorted(set(got) - set(cls.__dataclass_fields__)):
            raise ValueError(f"unknown keys {unknown}")
        return cls(**got)


def without_paths(value, roots: Mapping[str, str]):
    """A nested JSON value whose strings have local roots replaced by names, so that no machine's folders are published."""
    if isinstance(value, dict):
        return {k: without_paths(v, roots) for k, v in value.items()}
    if isinstance(value, list):
        return [without_paths(v, roots) for v in value]
    if isinstance(value, str):
        for root in sorted(roots, key=len, reverse=True):
            value = value.replace(root, roots[root])
    return value


def metric_rows(report: Mapping) -> list[tuple[str, str, float]]:
    """(slice, metric, value) of every number of a nested report, slices joined by slashes."""
    out: list[tuple[str, str, float]] = []

    def walk(node: Mapping, above: tuple[str, ...]) -> None:
        for k in sorted(node):
            if isinstance(node[k], Mapping):
                walk(node[k], (*above, k))
            elif isinstance(node[k], (int, float)) and not isinstance(node[k], bool):
                out.append(("/".join(above), k, float(node[k])))

    walk(report, ())
    return out


def pinned(spark: SparkSession, path: str, selection: Mapping, make) -> DataFrame:
    """The table that make() gave when path was first asked for with this selection; raises if it was made for another one."""
    body = json.dumps(dict(selection), sort_keys=True)
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest")
    if not at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(at):
        write_with_manifest(make(), path, body)
    return read_with_manifest(spark, path, body)


def provenance(tables: Mapping[str, DataFrame]) -> DataFrame:
    """name, rows and digest of each table of a release, in one table."""
    from weftline.operators.reports import table_digest

    out = None
    for name, df in tables.items():
        one = table_digest(df, df.columns).select(F.lit(name).alias("name"), "rows", "digest")
        out = one if out is None else out.union(one)
    return out
