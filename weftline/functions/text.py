"""Column builders for text: keys, counts, marks and predicates. Everything here stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
SEPARATOR = "␟"
TERMINAL = ".!?。！？"
CLOSERS = "\"'”’)]}》」』"
DELIMITER_PAIRS = (("(", ")"), ("[", "]"), ("{", "}"), ("（", "）"), ("【", "】"))
LEXICAL_PATHS = ("dictionary", "dict/", "dict-", "dicts", "lexicon", "wordlist", "vocab", "詞表", "學習詞表", "learning_vocabulary")
HAN = "[\\x{3400}-\\x{9FFF}\\x{F900}-\\x{FAFF}\\x{20000}-\\x{2B81F}]"
HAN_NARROW = "[\\x{3400}-\\x{4DBF}\\x{4E00}-\\x{9FFF}\\x{F900}-\\x{FAFF}]"
KANA_HANGUL = "[\\x{3040}-\\x{30FF}\\x{AC00}-\\x{D7AF}]"
LATIN = "[A-Za-z\\x{00C0}-\\x{024F}]"
FULL_WIDTH = ("，。！？：；（）", ",.!?:;()")
URL = "(?i)(?:https?://|www\\.)"
MARKUP = "<[A-Za-z/!][^>]*>"
NUMBERED = "(?:^|\\s)\\(?([1-9]\\d?)\\)?[.)、:：]\\s*"
ALNUM = "[\\p{L}\\p{N}\\p{M}]"
BUCKETS = (
    ("dictionary", "dict(?:ionary|ionaries)?|lexic(?:on|ons|al)?|glossar|glosbe|word.?list|vocab"),
    ("classroom", "contextual|classroom|qing_jing|conversation|dialogue"),
    ("religious", "bible|hymn|church|religio"),
    ("media", "youtube|video|audio|wilang.yutas"),
    ("culture", "cultur|custom|apolog|president|ceremon|ritual"),
    ("narrative", "story|stories|(?:^|[/_.-])texts?(?:[/_.-]|$)|picture.?book|myth|blog|narrat|tale|legend|folklore|literary|ode.to|raodong|wakelin|montgomery"),
    ("education", "learning|epark|gitbook|essay|reading|writing|nine.level|教材|material|textbook|course|tousvusvutu"),
    ("linguistic", "grammar|grammatical|syntax|linguist|seals|zheng|acl|elicitat|construction|sentence|word.order|negation|relative|causative|voice|phonolog|corpus|dissertation|thesis|descriptive.study|dialect|relationship|classification|topic.focus|complement|comparative|demonstrative|affix|time.reference|social.structure|conjunction"),
)


def ws(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), "[ \t\n\r]+", " "))


def key(x: Column) -> Column:
    """Lower-cased, with single spaces: the native form of the comparison key."""
    return F.lower(ws(x))


def skeleton(x: Column) -> Column:
    return F.regexp_replace(key(x), "[^\\p{L}\\p{N}\\p{M}]", "")


def joined(*parts: Column) -> Column:
    return F.concat_ws(SEPARATOR, *parts)


def row_id(*parts: Column) -> Column:
    """First 24 hex digits of the SHA-256 of the joined parts; zero and null count as empty."""
    return F.substring(F.sha2(joined(*(F.when(p.cast("string") == "0", "").otherwise(F.coalesce(F.trim(p.cast("string")), F.lit(""))) for p in parts)).cast("binary"), 256), 1, 24)


def tokens(x: Column, spaced: bool = False) -> Column:
    """White-space tokens with a letter, number or mark; spaced says that x has single spaces already (ws)."""
    return F.filter(F.split(x if spaced else ws(x), " "), lambda t: t.rlike(ALNUM))


def token_count(x: Column, spaced: bool = False) -> Column:
    return F.size(tokens(x, spaced)).cast("long")


def han_count(x: Column, narrow: bool = False) -> Column:
    return F.regexp_count(F.coalesce(x, F.lit("")), F.lit(HAN_NARROW if narrow else HAN)).cast("long")


def target_units(x: Column, language: str, narrow: bool = False) -> Column:
    """Han characters count one each in Chinese; everything else by tokens."""
    if language != "chinese":
        return token_count(x)
    return han_count(x, narrow) + token_count(F.regexp_replace(x, HAN_NARROW if narrow else HAN, " "))


def terminal(x: Column) -> Column:
    """Ends in a terminal mark, closers and white space aside (closers with spaces between them don't count)."""
    # From the end: the search stops where it starts, however long the text is.
    return F.reverse(F.coalesce(x, F.lit(""))).rlike("^\\s*[\"'”’)\\]}》」』]*\\s*[.!?。！？]")


def only_symbols(x: Column) -> Column:
    return ~F.coalesce(x, F.lit("")).rlike(ALNUM)


def marks_only(x: Column) -> Column:
    """Nothing but white space, punctuation and symbols (nothing at all counts too)."""
    return F.coalesce(x, F.lit("")).rlike("^[\\s\\p{P}\\p{S}]*$")


def mapped(x: Column, table: tuple[str, str]) -> Column:
    """Each character of the first string replaced by the one at its place in the second."""
    return F.translate(F.coalesce(x, F.lit("")), *table)


def script_count(x: Column, pattern: str) -> Column:
    return F.regexp_count(F.coalesce(x, F.lit("")), F.lit(pattern)).cast("long")


def occurrences(x: Column, mark: str) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(mark), F.lit("")))


def unbalanced(x: Column) -> Column:
    """Marks that should come in pairs and don't. All other characters go first, so that the counts run over little."""
    marks = "".join(a + b for a, b in DELIMITER_PAIRS) + "\"“”"
    kept = F.regexp_replace(F.coalesce(x, F.lit("")), "[^" + "".join(f"\\{c}" if c in "()[]{}" else c for c in marks) + "]+", "")
    return F.transform(F.array(kept), _unpaired)[0]


def _unpaired(x: Column) -> Column:
    out = (occurrences(x, '"') % 2 == 1) | (occurrences(x, "“") != occurrences(x, "”"))
    for a, b in DELIMITER_PAIRS:
        out = out | (occurrences(x, a) != occurrences(x, b))
    return out


def numbered_sequence(x: Column) -> Column:
    """Two consecutive list numbers n, n + 1."""
    found = F.transform(F.regexp_extract_all(F.coalesce(x, F.lit("")), F.lit(NUMBERED), F.lit(1)), lambda v: v.cast("int"))
    return F.aggregate(found, F.struct(F.lit(-9).alias("last"), F.lit(False).alias("hit")), lambda a, v: F.struct(v.alias("last"), (a["hit"] | (v == a["last"] + 1)).alias("hit")))["hit"]


def source_bucket(path: Column) -> Column:
    """Domain of a path: the first pattern that is found, else unknown."""
    low = F.lower(F.coalesce(path, F.lit("")))
    out = F.lit("unknown")
    for name, pattern in reversed(BUCKETS):
        out = F.when(low.rlike(pattern), name).otherwise(out)
    return out


def source_corpus(path: Column, private_prefix: str = "private-") -> Column:
    """Path component after `corpora`; else the first one if the path has an xml folder or a private prefix; else the bucket."""
    parts = F.filter(F.split(F.replace(F.coalesce(path, F.lit("")), F.lit("\\"), F.lit("/")), "/"), lambda p: p != "")
    low = F.transform(parts, F.lower)
    at = F.array_position(low, "corpora").cast("int")
    first = F.try_element_at(parts, F.lit(1))
    return F.when((at > 0) & (at < F.size(parts)), F.try_element_at(parts, at + 1)).when(F.arrays_overlap(low, F.array(F.lit("final_xml"), F.lit("xml"))), first).when(F.lower(first).startswith(private_prefix), first).otherwise(source_bucket(path))


def safe_tag(x: Column, default: str = "default", most: int = 48) -> Column:
    cut = F.regexp_replace(F.substring(F.regexp_replace(F.regexp_replace(key(x), "[^a-z0-9]+", "_"), "^_+|_+$", ""), 1, most), "^_+|_+$", "")
    return F.when(cut == "", default).otherwise(cut)


def slug(x: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(x), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def bool_parse(x: Column, true=("true", "1"), false=("false", "0"), strict: bool = True) -> Column:
    """Text to boolean; with strict an unknown value raises, else it is false."""
    v = F.lower(F.trim(x.cast("string")))
    other = F.raise_error(F.concat(F.lit("not a boolean: "), F.coalesce(v, F.lit("null")))).cast("boolean") if strict else F.lit(False)
    return F.when(v.isin(*true), True).when(v.isin(*false), False).otherwise(other)


def translation_kind(x: Column) -> Column:
    """Lower case, with runs of white space and underscores as one hyphen."""
    return F.regexp_replace(F.lower(F.trim(F.coalesce(x, F.lit("")))), "[\\s_]+", "-")


def row_type(value: Column, path: Column) -> Column:
    v = F.lower(F.trim(F.coalesce(value, F.lit(""))))
    lexical = F.lit(False)
    for hint in LEXICAL_PATHS:
        lexical = lexical | F.contains(F.lower(F.coalesce(path, F.lit(""))), F.lit(hint))
    return F.when(v.isin("sentence", "lexeme", "morpheme"), v).when(lexical, "lexeme").otherwise("unknown")


def length_bin(n: Column, edges=(5, 10, 20, 40)) -> Column:
    out = F.lit(f">{edges[-1]}")
    for low, high in reversed(list(zip((0, *edges), edges))):
        out = F.when(n <= high, f"{low + 1}-{high}" if low else f"<={high}").otherwise(out)
    return out


def char_ngrams(x: Column, orders=(3, 4, 5)) -> Column:
    """Distinct character n-grams; a text shorter than the least order is one gram; none for empty text.

    Linear in the length: characters are taken from an array, where substring would walk from the start each time.
    """
    none = F.array().cast("array<string>")

    def grams(c: Column) -> Column:
        cut = lambda n: F.transform(F.sequence(F.lit(0), F.size(c) - n), lambda i: F.concat(*(F.get(c, i + k) for k in range(n))))
        every = F.array_distinct(F.flatten(F.array(*(F.when(F.size(c) >= n, cut(n)).otherwise(none) for n in orders))))
        return F.when(F.size(c) < min(orders), F.array(F.array_join(c, ""))).otherwise(every)

    return F.when(F.length(x) == 0, none).otherwise(F.transform(F.array(F.split(x, "")), grams)[0])


def deletion_keys(x: Column) -> Column:
    """The text itself and all texts one character shorter."""
    n = F.length(x)
    cut = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.concat(F.substring(x, F.lit(1), i - 1), F.substring(x, i + 1, n)))
    return F.when(n == 0, F.array(x)).otherwise(F.array_distinct(F.concat(F.array(x), cut)))


def with_derived(df: DataFrame, src: str = "src", tgt: str = "tgt", lang: str = "lang", path: str = "path", kind: str = "row_type", language: str = "english") -> DataFrame:
    """df with the derived columns of pairs: keys, skeletons and their pairs, counts, marks, domain, corpus, document and task keys, and the row type made known."""
    s, t = F.col(src), F.col(tgt)
    out = df.withColumns({"src_key": key(s), "tgt_key": key(t), "src_skeleton": skeleton(s), "tgt_skeleton": skeleton(t), "src_tokens": token_count(s), "tgt_tokens": target_units(t, language, narrow=True), "src_terminal": terminal(s), "tgt_terminal": terminal(t), "tgt_han": han_count(t, narrow=True)})
    of = F.col(path)
    return out.withColumns({"pair_key": joined(F.col("src_key"), F.col("tgt_key")), "pair_skeleton": joined(F.col("src_skeleton"), F.col("tgt_skeleton")), "task_key": joined(F.col(lang), F.col("src_key")), "short_entry": (F.col("src_tokens") <= 2) & (F.col("tgt_tokens") <= 3), "bucket": source_bucket(of), "corpus": source_corpus(of), "document_key": key(of), kind: row_type(F.col(kind), of)})
