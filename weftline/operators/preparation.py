"""What training and evaluation rows need: metadata columns, tags, prompts, directions, synthetic rows, sampling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions import text as X
from weftline.operators.rules import Rule
from weftline.plans.storage import stored

#: The domains a row may name.
DOMAINS = ("classroom", "culture", "dictionary", "education", "linguistic", "media", "narrative", "religious")


def with_defaults(df: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    """df with each named column: added where absent, filled where null or blank."""
    blank = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == ""
    return df.withColumns({c: F.when(blank(c), F.lit(v)).otherwise(F.col(c).cast("string")) if c in df.columns else F.lit(v) for c, v in defaults.items()})


def in_order(df: DataFrame, first: Sequence[str], internal: str = "_") -> DataFrame:
    """The named columns that are there, then the others in their order; internal ones (by prefix) are dropped."""
    rest = [c for c in df.columns if c not in first and not c.startswith(internal)]
    return df.select(*(c for c in first if c in df.columns), *rest)


def renamed_target(df: DataFrame, known: Sequence[str], name: str = "target") -> DataFrame:
    """df with its one target column among known renamed; raises unless exactly one is there."""
    found = [c for c in known if c in df.columns]
    if len(found) != 1:
        raise ValueError(f"one target column of {list(known)} is needed, found {found}")
    return df.withColumnRenamed(found[0], name)


def complete_rows(df: DataFrame, texts: Sequence[str], language: str, allowed: Sequence[str]) -> DataFrame:
    """Rows whose texts aren't blank and whose language is allowed."""
    out = F.col(language).isin(*allowed)
    for c in texts:
        out = out & (F.trim(F.coalesce(F.col(c), F.lit(""))) != "")
    return df.where(out)


def prompt(source: Column, source_language: Column, target_language: Column, tags: Column | None = None) -> Column:
    """An instruction of several lines around the source text; a tag line is left out where it is empty."""
    lines = [F.concat(F.lit("Translate this from "), source_language, F.lit(" to "), target_language, F.lit(":"))]
    if tags is not None:
        lines.append(F.when(tags != "", tags))
    return F.concat_ws("\n", *lines, F.concat(source_language, F.lit(": "), source), F.concat(target_language, F.lit(":")))


def directed(df: DataFrame, src: str, tgt: str, direction: Column, forward: str = "forward") -> DataFrame:
    """df with source_text and reference, swapped where the direction isn't forward."""
    ahead = direction == forward
    return df.withColumns({"source_text": F.when(ahead, F.col(src)).otherwise(F.col(tgt)), "reference": F.when(ahead, F.col(tgt)).otherwise(F.col(src))})


def control_metadata(df: DataFrame, domain: str, dialect: str, known_dialects: Sequence[str], mode: str = "oracle", known_domains: Sequence[str] = DOMAINS) -> DataFrame:
    """df with the two columns replaced by what a model has tags for, and domain_fallback and dialect_fallback.

    default: the defaults everywhere. oracle: the row's own value where it has a tag, else the default.
    """
    if mode not in ("default", "oracle"):
        raise ValueError(f"unknown mode {mode}")
    if mode == "default":
        return df.withColumns({domain: F.lit("unknown"), dialect: F.lit("default"), "domain_fallback": F.lit(True), "dialect_fallback": F.lit(True)})
    own = lambda c, none: F.when(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == "", F.lit(none)).otherwise(F.col(c).cast("string"))
    bucket, place = X.safe_tag(own(domain, "unknown"), "unknown"), own(dialect, "default")
    no_bucket = ~bucket.isin(*known_domains)
    no_place = ~X.safe_tag(place).isin(*known_dialects)
    return df.withColumns({domain: F.when(no_bucket, "unknown").otherwise(bucket), dialect: F.when(no_place, "default").otherwise(place), "domain_fallback": no_bucket, "dialect_fallback": no_place})


def share(ident: Column, salt: str) -> Column:
    """A number in [0, 1) that only depends on the row and the salt."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(salt), ident.cast("string")).cast("binary")), 1, 8), 16, 10).cast("double") / float(1 << 32)


def dropped_out(df: DataFrame, ident: str, chances: Mapping[str, tuple[float, str]], salt: str = "0") -> DataFrame:
    """df with each named column set to its default with its chance, independent of the others and repeatable."""
    return df.withColumns({c: F.when(share(F.col(ident), f"{salt}:{c}:") < p, F.lit(default)).otherwise(F.col(c)) for c, (p, default) in chances.items()})


def pivot_rules(row_type: Column, path: Column, usable: Column, confidence: Column, src: Column, tgt: Column, least_src: int = 3, least_tgt: int = 3, allowed=("sentence",), source_name: str | None = None) -> list[Rule]:
    """Why a row isn't sent to translation: own reasons first, then gloss and metadata reasons of the text."""
    from weftline.operators import rules as of

    lexical = X.row_type(F.lit(""), path) == "lexeme"
    return [
        Rule("non_sentence", "skipped", ~F.lower(F.trim(F.coalesce(row_type, F.lit("")))).isin(*allowed)),
        Rule("lexical_source", "skipped", lexical),
        Rule("ineligible", "skipped", ~F.coalesce(usable, F.lit(False))),
        Rule("ambiguous_standardization", "skipped", F.lower(F.trim(F.coalesce(confidence, F.lit("")))) == "ambiguous"),
        Rule("short_source", "skipped", X.token_count(src) < least_src),
        Rule("short_pivot", "skipped", X.token_count(tgt) < least_tgt),
        Rule("target_prompt_scaffolding", "skipped", tgt.rlike(of.prompt_pattern(source_name))),
        Rule("target_annotation_gloss", "skipped", of.gloss_structure(tgt)),
        Rule("target_linguistic_analysis", "skipped", of.linguistic_analysis(tgt, "english")),
        Rule("embedded_missing_translation_marker", "skipped", tgt.rlike(of.EMBEDDED_MISSING)),
        Rule("target_provenance_note", "skipped", F.trim(tgt).rlike(of.PROVENANCE)),
        Rule("target_translation_commentary", "skipped", tgt.rlike(of.ascii_edges(of.COMMENTARY))),
    ]


def language_differs(detected: Column, expected: Column) -> Column:
    """A detected language (en-US) that isn't the expected one; nothing detected is no difference."""
    main = lambda c: F.split_part(F.upper(F.trim(F.coalesce(c, F.lit("")))), F.lit("-"), F.lit(1))
    return (main(detected) != "") & (main(detected) != main(expected))


def synthetic_rows(rows: DataFrame, ident: str, key: str, translation: str, detected: str, expected: str, direction: str) -> DataFrame:
    """rows with a translation from the cache as training rows: their own text, origin, split, flags and ids; reason says why one is none."""
    x = X.ws(F.col(translation))
    reason = F.when(language_differs(F.col(detected), F.col(expected)), "detected_language_mismatch").when(x == "", "empty_translation").otherwise("")
    out = rows.withColumns({"reason": reason, "target_text": x, "target_raw": F.coalesce(F.col(translation), F.lit("")), "origin": F.lit("synthetic"), "split": F.lit("train"), "direction": F.lit(direction), "flags": F.lit("synthetic"), "duplicate_group_size": F.lit(1).cast("long")})
    return out.withColumn("synthetic_id", X.row_id(F.col(ident), F.lit(direction), F.col(key)))


def dense_numbers(df: DataFrame, order: list[str], by: list[str] | None = None, name: str = "number") -> DataFrame:
    """df with a number from 0 in order (unique last), within by. No global window: rows are dealt to ranges, counted per range,
    and numbered inside them."""
    by = by or []
    placed = stored(df.repartitionByRange(*by, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    size = placed.groupBy("_part", *by).agg(F.count("*").alias("_size"))
    before = size.withColumn("_offset", F.coalesce(F.sum("_size").over(Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_size")
    inner = F.row_number().over(Window.partitionBy("_part", *by).orderBy(*order))
    return placed.withColumn("_n", inner).join(before, ["_part", *by]).withColumn(name, (F.col("_offset") + F.col("_n") - 1).cast("long")).drop("_part", "_n", "_offset")


def running_sum(df: DataFrame, value: str, order: list[str], by: list[str], name: str = "upto") -> DataFrame:
    """df with the sum of value up to each row, in order within by, in the same way as dense_numbers."""
    placed = stored(df.repartitionByRange(*by, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    size = placed.groupBy("_part", *by).agg(F.sum(value).alias("_size"))
    before = size.withColumn("_offset", F.coalesce(F.sum("_size").over(Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_size")
    inner = F.sum(value).over(Window.partitionBy("_part", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return placed.withColumn("_n", inner).join(before, ["_part", *by]).withColumn(name, F.col("_offset") + F.col("_n")).drop("_part", "_n", "_offset")


def weighted_draws(df: DataFrame, ident: str, language: str, draws: int, alpha: float = 0.7, salt: str = "0") -> DataFrame:
    """draw, language, ident: draws rows with replacement, a language by its count to the power of alpha, then a row of it evenly."""
    rows = dense_numbers(df.select(ident, language), [ident], [language])
    sizes = {r[language]: r["n"] for r in df.groupBy(language).agg(F.count("*").alias("n")).orderBy(language).collect()}  # a row per language
    total, at = sum(n**alpha for n in sizes.values()), 0.0
    u, v = share(F.col("draw"), f"{salt}:language:"), share(F.col("draw"), f"{salt}:row:")
    pick, count = F.lit(None).cast("string"), F.lit(None).cast("long")
    spans = []
    for name, n in sizes.items():
        spans.append((at, name, n))
        at += n**alpha / total
    for low, name, n in spans:
        pick, count = F.when(u >= low, F.lit(name)).otherwise(pick), F.when(u >= low, F.lit(n)).otherwise(count)
    drawn = df.sparkSession.range(draws).withColumnRenamed("id", "draw").select("draw", pick.alias(language), count.alias("_n")).withColumn("number", F.floor(v * F.col("_n")).cast("long"))
    return drawn.join(rows, [language, "number"]).select("draw", language, ident)
