"""Reports and gates: counters, audits, ratios, and the wide row of violations of a split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions import text as X
from weftline.operators.similarity import edit_conflicts, ngram_crossings


def rule_totals(rows: DataFrame, by: list[str], counts: dict[str, Column]) -> DataFrame:
    """by, rule, total, rows: sums of per-row counters named by rule, and the rows that have any."""
    every = F.array(*(F.struct(F.lit(k).alias("rule"), c.cast("long").alias("n")) for k, c in counts.items()))
    flat = rows.select(*by, F.explode_outer(F.filter(every, lambda x: x["n"] > 0)).alias("c")).where("c is not null")
    return flat.groupBy(*by, F.col("c.rule").alias("rule")).agg(F.sum("c.n").alias("total"), F.count("*").alias("rows"))


def group_profile(rows: DataFrame, group: list[str], size: Column) -> DataFrame:
    return rows.groupBy(*group).agg(F.count("*").alias("size"), F.avg(size).alias("mean_size"))


def tolerance(rows: DataFrame, stratum: list[str], group: str, share: float = 0.02) -> DataFrame:
    """How far a stratum may miss its quota: 2, or its share of rows rounded up, or its largest group less one."""
    groups = rows.groupBy(*stratum, group).agg(F.count("*").alias("n"))
    return groups.groupBy(*stratum).agg(F.sum("n").alias("rows"), F.max("n").alias("largest")).withColumn("tolerance", F.greatest(F.lit(2).cast("long"), F.ceil(F.col("rows") * F.lit(share)).cast("long"), F.col("largest") - 1))


def duplicate_counts(rows: DataFrame, ident: str, keys: list[str]) -> DataFrame:
    """One row: rows, rows beyond the first of their key, ids that stand twice."""
    n = rows.agg(F.count("*").alias("rows"), F.countDistinct(*keys).alias("_k"))
    twice = rows.groupBy(ident).agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("duplicate_ids"))
    return n.crossJoin(F.broadcast(twice)).select("rows", (F.col("rows") - F.col("_k")).alias("duplicate_pairs"), "duplicate_ids")  # one row each


def macro_average(rows: DataFrame, group: str, values: dict[str, Column]) -> DataFrame:
    """Means of the groups' means."""
    per = rows.groupBy(group).agg(*(F.avg(c).alias(k) for k, c in values.items()))
    return per.agg(*(F.avg(k).alias(k) for k in values), F.count("*").alias("groups"))


def frequent(rows: DataFrame, value: str, least: int, most: int) -> DataFrame:
    """The most frequent values that occur least times or more, with counts; most of them."""
    return rows.groupBy(value).agg(F.count("*").alias("n")).where(F.col("n") >= least).orderBy(F.desc("n"), value).limit(most)


def ratio_audit(rows: DataFrame, group: str, split: str, required: dict[str, float], slack: float = 0.0) -> DataFrame:
    """group, split, rows, required (share of all rows rounded up), observed, ok (within slack of all rows below it)."""
    total = rows.groupBy(group).agg(F.count("*").alias("rows"), *(F.count_if(F.col(split) == s).alias(s) for s in required))
    every = F.explode(F.array(*(F.struct(F.lit(s).alias("split"), F.ceil(F.col("rows") * F.lit(q)).cast("long").alias("required"), F.col(s).alias("observed")) for s, q in required.items()))).alias("r")
    return total.select(group, "rows", every).select(group, "rows", "r.split", "r.required", "r.observed", (F.col("r.observed") + slack * F.col("rows") >= F.col("r.required")).alias("ok"))


def quota_actual(quotas: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Each quota beside the rows found for it, and the difference."""
    found = rows.groupBy(*keys).agg(F.count("*").alias("actual"))
    return quotas.join(found, keys, "left").withColumn("actual", F.coalesce("actual", F.lit(0).cast("long"))).withColumn("missing", F.greatest(F.col("quota") - F.col("actual"), F.lit(0).cast("long")))


def tokenizer_audit(rows: DataFrame, by: str, src: str, tgt: str, pieces, unknown, most: int) -> DataFrame:
    """Twenty metrics of a tokenizer per group. pieces(text) and unknown(word) are array<string> and boolean Columns: any tokenizer's."""
    words = lambda c: F.filter(F.split(X.ws(F.col(c)), " "), lambda w: w != "")
    per_word = F.transform(words(src), lambda w: F.struct(F.size(pieces(w)).alias("n"), unknown(w).alias("u")))
    base = rows.select(by, F.length(F.coalesce(F.col(src), F.lit(""))).alias("chars"), per_word.alias("w"), F.aggregate(words(tgt), F.lit(0), lambda a, w: a + F.size(pieces(w))).alias("t"))
    base = base.select(by, "chars", F.size("w").alias("words"), F.aggregate("w", F.lit(0), lambda a, x: a + x["n"]).alias("s"), "t", F.size(F.filter("w", lambda x: x["n"] >= 5)).alias("long"), F.size(F.filter("w", lambda x: x["u"])).alias("unk"))
    base = base.withColumn("q", F.greatest("s", "t"))
    n = lambda c: F.greatest(F.sum(c), F.lit(1)).cast("double")
    rows_ = F.count("*").cast("double")
    q = lambda c, p: F.percentile(c, F.lit(p))
    total = lambda c: F.sum(c).cast("long")
    return base.groupBy(by).agg(
        F.count("*").alias("sentences"), total("words").alias("words"), total("chars").alias("chars"), total("s").alias("pieces"),
        (F.sum("s") / n("words")).alias("pieces_per_word"), (F.sum("s") / rows_).alias("pieces_per_sentence"), (F.sum("s") / n("chars")).alias("pieces_per_character"),
        q("s", 0.5).alias("pieces_median"), q("s", 0.95).alias("pieces_p95"), F.max("s").cast("long").alias("pieces_max"), (F.sum("s") / n("t")).alias("source_target_ratio"),
        (100.0 * F.sum("long") / n("words")).alias("pct_words_5_pieces"), total("unk").alias("unk_pieces"), (100.0 * F.count_if(F.col("unk") > 0) / rows_).alias("pct_sentences_unk"), (10000.0 * F.sum("unk") / n("words")).alias("unk_per_10k_words"),
        q("q", 0.5).alias("sequence_median"), q("q", 0.95).alias("sequence_p95"), F.max("q").cast("long").alias("sequence_max"), F.count_if(F.col("q") > most).alias("over_length"), (100.0 * F.count_if(F.col("q") > most) / rows_).alias("pct_over_length"),
    )


def top_and_worst(rows: DataFrame, value: str, order: list[Column], n: int) -> DataFrame:
    """The first n rows in an order, numbered: an ordered limit, not a window over everything."""
    first = rows.orderBy(*order).limit(n)
    return first.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)).cast("long")).select("place", value)


def samples(rows: DataFrame, by: str, order: str, n: int) -> DataFrame:
    """by, place, order of the n rows of each kind that are first in order; each task sends n rows of a kind at most."""
    w = Window.partitionBy(by).orderBy(order)
    return rows.select(by, order).withColumn("place", F.row_number().over(w).cast("long")).where(F.col("place") <= n)


def improved(value: Column, best: Column, least_delta: float, higher: bool = True) -> Column:
    """Whether a metric beats the best so far by least_delta (anything beats none)."""
    return best.isNull() | ((value > best + least_delta) if higher else (value < best - least_delta))


def early_stops(runs: DataFrame, run: str, step: str, value: str, patience: int, least_delta: float = 0.0, first_step: int = 0, higher: bool = True) -> DataFrame:
    """run, best_step, best, stop_step (null if it was not stopped). A fold in order over each run's log, which is bounded by its steps."""
    log = F.transform(F.array_sort(F.collect_list(F.struct(F.col(step).cast("long").alias("s"), F.col(value).cast("double").alias("v")))), lambda x: x)
    none = F.lit(None)
    zero = F.struct(none.cast("double").alias("best"), none.cast("long").alias("at"), F.lit(0).alias("bad"), none.cast("long").alias("stop"))

    def next_(a: Column, x: Column) -> Column:
        better = improved(x["v"], a["best"], least_delta, higher)
        bad = F.when(better, 0).when(x["s"] < first_step, a["bad"]).otherwise(a["bad"] + 1)
        step_ = F.struct(F.when(better, x["v"]).otherwise(a["best"]).alias("best"), F.when(better, x["s"]).otherwise(a["at"]).alias("at"), bad.alias("bad"), F.when(bad >= patience, x["s"]).alias("stop"))
        return F.when(a["stop"].isNotNull(), a).otherwise(step_)

    return runs.groupBy(run).agg(F.aggregate(log, zero, next_).alias("a")).select(run, F.col("a.at").alias("best_step"), F.col("a.best").alias("best"), F.col("a.stop").alias("stop_step"))


def perplexity(rows: DataFrame, by: list[str], loss: Column, tokens: Column) -> DataFrame:
    """Token-weighted mean loss and its exponential."""
    mean = F.sum(loss * tokens) / F.greatest(F.sum(tokens), F.lit(1))
    return rows.groupBy(*by).agg(mean.alias("loss"), F.exp(mean).alias("perplexity"))


def exposure(nearest: DataFrame, by: list[str], score: str, exact: Column, cuts=(0.7, 0.85, 0.95)) -> DataFrame:
    """Per slice: rows, mean score, exact matches and the share at or above each cut."""
    return nearest.groupBy(*by).agg(F.count("*").alias("rows"), F.avg(score).alias("mean_score"), F.count_if(exact).alias("exact"), *(F.avg((F.col(score) >= c).cast("int")).alias(f"over_{round(100 * c)}") for c in cuts))


def table_digest(df: DataFrame, columns: list[str]) -> DataFrame:
    """rows and digest of a table, whatever the rows' order: the sum of 32 bits of each row's MD5."""
    row = F.md5(F.concat_ws("␟", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)).cast("binary"))
    return df.agg(F.count("*").alias("rows"), F.sum(F.conv(F.substring(row, 1, 8), 16, 10).cast("long")).alias("digest"))


def split_gates(rows: DataFrame, eligible: Column, t: float = 0.95, document: str | None = None, most_units: int = 384, near: bool = True) -> DataFrame:
    """One wide row of violations of a split, counted independently of how it was made; all zero for a good one.

    rows: row_id, lang, source, src, tgt, split, row_type, origin, usable, confidence, flags (array). eligible is the
    evaluation mask over these columns; near adds the one-edit and n-gram gates.
    """
    held = F.col("split").isin("test", "validate")
    kind = F.lower(F.coalesce(F.col("row_type"), F.lit("")))
    bad_escape = "[\"”]{2,}\\s*$"
    keyed = rows.withColumns({"src_key": X.key(F.col("src")), "tgt_key": X.key(F.col("tgt")), "src_skeleton": X.skeleton(F.col("src")), "tgt_skeleton": X.skeleton(F.col("tgt"))})
    one = keyed.agg(
        F.count_if(~F.col("split").isin("train", "test", "validate")).alias("unknown_split"),
        F.count_if(held & (F.col("origin") == "synthetic")).alias("synthetic_eval"),
        F.count_if(held & ~F.col("usable")).alias("ineligible_eval"),
        F.count_if(held & (F.col("confidence") == "ambiguous")).alias("ambiguous_eval"),
        F.count_if(held & kind.isin("lexeme", "morpheme")).alias("lexical_eval"),
        F.count_if(held & (kind != "sentence")).alias("non_sentence_eval"),
        F.count_if(held & ~eligible).alias("lexical_like_eval"),
        F.count_if((X.token_count(F.col("src")) > most_units) | (X.token_count(F.col("tgt")) > most_units)).alias("length_overflow"),
        (F.count_if(F.col("src").rlike(bad_escape)) + F.count_if(F.col("tgt").rlike(bad_escape))).alias("malformed_escaping"),
        F.count_if(held & F.arrays_overlap("flags", F.array(F.lit("english_language_uncertain")))).alias("uncertain_language_eval"),
        F.count_if(held & X.unbalanced(F.col("tgt"))).alias("unbalanced_eval"),
        (F.count("*") - F.countDistinct("lang", "src_key", "tgt_key")).alias("duplicate_pairs"),
    )
    out = [one]

    def crossing(keys: list[str], name: str) -> None:
        per = keyed.where(" and ".join(f"{k} <> ''" for k in keys)).groupBy("lang", *keys).agg(F.max((F.col("split") == "train").cast("int")).alias("t"), F.max((F.col("split") == "validate").cast("int")).alias("v"), F.max((F.col("split") == "test").cast("int")).alias("e"))
        out.append(per.agg(F.count_if((F.col("t") == 1) & ((F.col("v") == 1) | (F.col("e") == 1))).alias(f"train_{name}"), F.count_if((F.col("v") == 1) & (F.col("e") == 1)).alias(f"eval_{name}")))

    for kind_ in ("key", "skeleton"):
        for sides, name in ((["src"], "src"), (["tgt"], "tgt"), (["src", "tgt"], "pair")):
            crossing([f"{s}_{kind_}" for s in sides], f"{name}_{kind_}")
    if document:
        docs = keyed.groupBy(document).agg(F.max((F.col("split") == "train").cast("int")).alias("t"), F.max(held.cast("int")).alias("h"))
        out.append(docs.agg(F.count_if((F.col("t") == 1) & (F.col("h") == 1)).alias("document_overlap")))
    for side in ("src", "tgt") if near else ():
        out.append(ngram_crossings(keyed, "split", F.col(f"{side}_key"), ["lang"], t).select(F.col("n").alias(f"ngram_{side}")))
        train, eval_ = keyed.where("split = 'train'"), keyed.where(held)
        out.append(edit_conflicts(eval_, train, f"{side}_skeleton", ["lang"]).where(F.col(f"{side}_skeleton") != "").agg(F.count("*").alias(f"one_edit_{side}")))
    wide = out[0]
    for more in out[1:]:
        wide = wide.crossJoin(F.broadcast(more))  # one row each
    return wide


def failed_gates(gates: DataFrame) -> DataFrame:
    """gate, violations of the gates of a wide row that aren't zero."""
    every = F.array(*(F.struct(F.lit(c).alias("gate"), F.col(c).cast("long").alias("violations")) for c in gates.columns))
    return gates.select(F.explode(F.filter(every, lambda x: x["violations"] > 0)).alias("g")).select("g.gate", "g.violations")
