"""Secret scan with native expressions only: fixed patterns, and a randomness test battery for everything else.

Candidates are runs of encoded characters, with digits or without. Each gets an inferred encoding (an alphabet), and three tests of "drawn
uniformly from that alphabet": chi-squared uniformity of the symbols, the runs test about the middle symbol, and the
lag-one serial correlation. Fisher's method joins the three p-values. Text fails the tests and random strings don't, so
false discoveries are texts among the candidates that pass. Their share is controlled per encoding and length band: the
share of random candidates is estimated from the upper half of the p-values, where they are uniform, and the smallest
cut is taken at which the estimated share of texts above it is at most q. Only a histogram of fixed size is collected.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
#: A run of encoded characters; ENCODINGS has the smallest length at which each encoding is tested.
CANDIDATE = "(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
KINDS = ("assign", "access", "hex", "random")
#: name, test of the string, alphabet size, least length at which the tests can tell text from random strings.
ENCODINGS = (("decimal", "^[0-9]+$", 10, 32), ("hex", "^([0-9a-f]+|[0-9A-F]+)$", 16, 24), ("letters26", "^([a-z]+|[A-Z]+)$", 26, 24), ("letters52", "^[A-Za-z]+$", 52, 24), ("base32", "^[A-Z2-7]+$", 32, 24), ("base36", "^([0-9a-z]+|[0-9A-Z]+)$", 36, 24), ("base64", "^[A-Za-z0-9+/_-]+$", 64, 20))
SYMBOLS = {"decimal": "0123456789", "hex": "0123456789abcdef", "letters26": "abcdefghijklmnopqrstuvwxyz", "letters52": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "base36": "0123456789abcdefghijklmnopqrstuvwxyz", "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"}
BINS, BANDS = 50, (28, 40, 64, 1 << 30)
_SPANS = "array<struct<s:int,r:int,e:int,k:string>>"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _scan(items: str, following: str, given: str, kind: str, chunk: str = "null") -> str:
    """SQL for what given (an array of kind) gives for each x of the array items, joined, with a.p handed from x to x (following).

    Growing an array copies it, so the items are taken in about as many chunks as a chunk has items: the work is the
    item count to the power of 1.5. chunk is worked out once per chunk c from its a.p and is a.t in given.
    """
    width = "cast(ceil(sqrt(greatest(size(every), 1))) as int)"
    return f"""transform(array({items}), every -> flatten(aggregate(
        transform(sequence(0, {width} - 1), i -> slice(every, i * {width} + 1, {width})),
        named_struct('p', 0, 'o', cast(array() as array<{kind}>)),
        (outer, c) -> transform(array(aggregate(c, transform(array(outer.p), p -> named_struct('p', p, 'from', p, 't', transform(array(named_struct('p', p)), a -> {chunk})[0], 'o', cast(array() as {kind})))[0],
            (a, x) -> named_struct('p', {following}, 'from', a.from, 't', a.t, 'o', concat(a.o, {given})))), r -> named_struct('p', r.p, 'o', concat(outer.o, array(r.o))))[0],
        outer -> outer.o)))[0]"""


def _located(text: str, pattern: str, value: str, empty: str) -> str:
    """Array of value (an expression of p, the start, and x.m, the match) for the matches of pattern in text.

    Matches don't overlap, so each start is the length of what the pattern parts and of the matches before it.
    """
    p = _quoted(pattern)
    found = f"zip_with(slice(split({text}, {p}, -1), 1, regexp_count({text}, {p})), regexp_extract_all({text}, {p}, 0), (g, m) -> named_struct('g', length(g), 'm', m))"
    return f"if(regexp_like({text}, {p}), {_scan(found, 'a.p + x.g + length(x.m)', f'transform(array(a.p + x.g), p -> {value})', empty)}, cast(array() as {empty}))"


def base_spans(text: str) -> str:
    """SQL for the spans of the three fixed kinds in text (a column's name), sorted by start, then kind."""
    found = []
    for rank, (kind, pattern) in enumerate(zip(KINDS, (ASSIGN, ACCESS, HEX))):
        keep = f"length(regexp_extract(x.m, {_quoted(pattern)}, 2)) >= 6" if kind == "assign" else "true"
        value = f"named_struct('s', p, 'r', if({keep}, {rank}, -1), 'e', p + length(x.m), 'k', '{kind}')"
        found.append(f"filter({_located(text, pattern, value, _SPANS)}, v -> v.r >= 0)")
    return f"array_sort(concat({', '.join(found)}))"


def candidates(text: str) -> str:
    """SQL for the runs of encoded characters of text: start and string."""
    return _located(text, CANDIDATE, "named_struct('s', p, 't', x.m)", "array<struct<s:int,t:string>>")


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution, to about 1e-4."""
    return 1 / (1 + F.exp(F.least(F.greatest(1.5976 * z + 0.070565992 * z * z * z, F.lit(-700.0)), F.lit(700.0))))


def _battery(t: Column) -> Column:
    """struct(e: encoding, n: length, p: combined p-value of randomness; null if the string is too short for its encoding)."""
    n = F.length(t).cast("double")
    encoding, least, size, order = F.lit(None).cast("string"), F.lit(1 << 30), F.lit(1), F.lit("")
    for name, test, k, shortest in reversed(ENCODINGS):
        hit = t.rlike(test)
        encoding, least, size, order = (F.when(hit, F.lit(x)).otherwise(y) for x, y in ((name, encoding), (shortest, least), (k, size), (SYMBOLS[name], order)))
    folded = F.when(encoding.isin("hex", "letters26", "base36"), F.lower(t)).otherwise(F.translate(t, "+/", "-_"))
    return F.struct(encoding.alias("e"), n.alias("n"), least.alias("least"), size.cast("double").alias("k"), folded.alias("t"), order.alias("o"))


def _p_value(b: Column) -> Column:
    """Fisher's combination of the three tests for a struct of _battery."""
    n, k = b["n"], b["k"]
    values = F.transform(F.split(b["t"], ""), lambda c: F.instr(b["o"], c).cast("double") - 1)
    # By symbol of the alphabet, not by character: linear in the length.
    squares = F.aggregate(F.split(b["o"], ""), F.lit(0.0), lambda a, c: a + F.pow(n - F.length(F.replace(b["t"], c, F.lit(""))), F.lit(2.0)))
    chi = k * squares / n - n
    df = k - 1
    p_chi = _tail((F.pow(F.greatest(chi, F.lit(1e-9)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df)))
    moments = F.aggregate(
        values,
        F.struct(*(F.lit(x).alias(y) for x, y in ((-1.0, "last"), (0.0, "ones"), (1.0, "runs"), (0.0, "sum"), (0.0, "sq"), (0.0, "lag")))),
        lambda a, v: F.struct(
            v.alias("last"),
            (a["ones"] + F.when(2 * v >= k, 1.0).otherwise(0.0)).alias("ones"),
            (a["runs"] + F.when((a["last"] >= 0) & ((2 * v >= k) != (2 * a["last"] >= k)), 1.0).otherwise(0.0)).alias("runs"),
            (a["sum"] + v).alias("sum"),
            (a["sq"] + v * v).alias("sq"),
            (a["lag"] + F.when(a["last"] >= 0, a["last"] * v).otherwise(0.0)).alias("lag"),
        ),
        lambda a: F.struct(a["ones"].alias("ones"), a["runs"].alias("runs"), a["sum"].alias("sum"), a["sq"].alias("sq"), (a["lag"] + a["last"] * F.element_at(values, 1)).alias("lag")),
    )
    return F.transform(
        F.array(F.struct(moments.alias("m"), p_chi.alias("c"))),
        lambda x: _joined(x["m"], x["c"], n),
    )[0]


def _joined(m: Column, p_chi: Column, n: Column) -> Column:
    one, zero = m["ones"], n - m["ones"]
    mean = 2 * one * zero / n + 1
    spread = F.sqrt(F.greatest((mean - 1) * (mean - 2) / (n - 1), F.lit(1e-9)))
    p_runs = 2 * _tail(F.abs(m["runs"] - mean) / spread)
    var = n * m["sq"] - m["sum"] * m["sum"]
    corr = F.when(var > 0, (n * m["lag"] - m["sum"] * m["sum"]) / F.greatest(var, F.lit(1e-9))).otherwise(1.0)
    p_serial = 2 * _tail(F.abs((corr + 1 / (n - 1)) / F.sqrt(n * (n - 3) / ((n + 1) * (n - 1) * (n - 1)))))
    x = -(F.log(F.greatest(p_chi, F.lit(1e-12))) + F.log(F.least(F.greatest(p_runs, F.lit(1e-12)), F.lit(1.0))) + F.log(F.least(F.greatest(p_serial, F.lit(1e-12)), F.lit(1.0))))
    return F.exp(-x) * (1 + x + x * x / 2)  # upper tail of chi-squared with six degrees of freedom at 2x


def _tested(c: Column) -> Column:
    b = _battery(c["t"])
    return F.transform(F.array(b), lambda b: F.struct(c["s"].cast("int").alias("s"), (c["s"] + F.length(c["t"])).cast("int").alias("end"), b["e"].alias("e"), b["n"].alias("n"), F.when(b["n"] >= b["least"], _p_value(b)).alias("p")))[0]


def annotate(docs: DataFrame, text: str = "text", spans: str = "_weft_base", tested: str = "_weft_tested") -> DataFrame:
    """docs with the base spans and the tested candidates of each text (null: empty)."""
    plain = docs.withColumn("_weft_text", F.coalesce(F.col(text).cast("string"), F.lit("")))
    found = plain.withColumn(spans, F.expr(base_spans("_weft_text"))).withColumn("_weft_runs", F.expr(candidates("_weft_text")))
    return found.withColumn(tested, F.filter(F.transform("_weft_runs", _tested), lambda c: c["p"].isNotNull())).drop("_weft_text", "_weft_runs")


def _band(n: Column) -> Column:
    out = F.lit(len(BANDS) - 1)
    for i in reversed(range(len(BANDS) - 1)):
        out = F.when(n < BANDS[i], i).otherwise(out)
    return out


def thresholds(annotated: DataFrame, tested: str = "_weft_tested", q: float = 0.05, half: float = 0.5) -> dict[tuple[str, int], float]:
    """For each encoding and length band the smallest p-value at which the estimated share of texts is at most q.

    The estimate of the random strings' number gets a standard error of its own (of the count and four more, as a count of
    none is no proof of none), so that noise in small strata doesn't cut off their random strings; the error vanishes beside
    the estimate as a stratum grows. One aggregation into a histogram of at most encodings x bands x BINS rows.
    """
    # Not explode: Spark would put a filter of empty arrays before it, and so run the whole scan again for it.
    rows = annotated.select(F.explode_outer(tested).alias("c")).where("c is not null").groupBy(F.col("c.e").alias("e"), _band(F.col("c.n")).alias("band"), F.least(F.floor(F.col("c.p") * BINS), F.lit(BINS - 1)).alias("bin")).count().collect()
    strata: dict[tuple[str, int], list[int]] = {}
    for r in rows:
        strata.setdefault((r["e"], r["band"]), [0] * BINS)[int(r["bin"])] += r["count"]
    out = {}
    for key, counts in strata.items():
        total, upper = sum(counts), sum(counts[int(half * BINS) :])
        random = min(total, (upper + math.sqrt(upper + 4)) / (1 - half))
        cut = 1.0
        for b in range(BINS):
            above = sum(counts[b:])
            if above and 1 - random * (1 - b / BINS) / above <= q:
                cut = b / BINS
                break
        out[key] = max(cut, 0.001)
    return out


def random_spans(cuts: dict[tuple[str, int], float], base: str = "_weft_base", tested: str = "_weft_tested") -> Column:
    """Spans of the candidates that pass their stratum's cut and overlap no base span."""

    def passes(c: Column) -> Column:
        ok = F.lit(False)
        for (e, band), cut in sorted(cuts.items()):
            ok = ok | ((c["e"] == e) & (_band(c["n"]) == band) & (c["p"] >= cut))
        return ok & ~F.exists(F.col(base), lambda b: (b["s"] < c["end"]) & (b["e"] > c["s"]))

    return F.transform(F.filter(tested, passes), lambda c: F.struct(c["s"].alias("s"), F.lit(3).alias("r"), c["end"].alias("e"), F.lit("random").alias("k")))


def _listed(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda v: F.concat_ws(":", v["k"], v["s"].cast("string"), v["e"].cast("string"))))


def secret_report(docs: DataFrame, q: float = 0.05) -> DataFrame:
    """A row per row of docs (doc_id, text; other columns are ignored): doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random.

    Spans are kind:start:end in code points, end exclusive, by start and then kind. Null and empty texts have none; the
    whole text is scanned; repeated rows give repeated results; an empty table gives none.
    """
    seen = stored(annotate(docs.select("doc_id", "text")).select("doc_id", "_weft_base", "_weft_tested"), "secrets")
    every = F.array_sort(F.concat("_weft_base", random_spans(thresholds(seen, q=q))))
    count = lambda k: F.size(F.filter("_weft_all", lambda v: v["k"] == k)).cast("long").alias(f"n_{k}")
    return seen.withColumn("_weft_all", every).select("doc_id", *(count(k) for k in KINDS[:3]), F.sha2(_listed(F.col("_weft_base")).cast("binary"), 256).alias("base_sha256"), _listed(F.col("_weft_all")).alias("spans"), count("random"))


def redact(docs: DataFrame, mark: str = "[SECRET]", q: float = 0.05) -> DataFrame:
    """docs with every found span of text replaced by mark (overlapping spans by one); all rows and columns stay. Null text stays null."""
    cuts = thresholds(annotate(docs.select("text")).select("_weft_tested"), q=q)
    found = annotate(docs).withColumn("_weft_all", F.array_sort(F.concat("_weft_base", random_spans(cuts))))
    # A chunk's own stretch of the text is cut out once, so that cutting at a span doesn't walk through the whole text.
    pieces = _scan("_weft_all", "greatest(a.p, x.e)", f"if(x.s < a.p, cast(array() as array<string>), array(substring(a.t, a.p - a.from + 1, x.s - a.p), {_quoted(mark)}))", "array<string>", "substring(text, a.p + 1, try_element_at(c, -1).s - a.p)")
    cut = F.expr(f"concat(array_join({pieces}, ''), substring(text, array_max(transform(_weft_all, v -> v.e)) + 1))")
    return found.withColumn("text", F.when(F.col("text").isNull() | (F.size("_weft_all") == 0), F.col("text")).otherwise(cut)).select(docs.columns)
