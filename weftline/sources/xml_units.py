"""Units of annotated XML texts: one row per S, W and M element, in document order, with their forms and translations.

Mixed content matters (text around nested elements), which the built-in XML source drops, so whole files are parsed in
Arrow batches of rows (path, content).
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LANG = "{http://www.w3.org/XML/1998/namespace}lang"
KINDS = {"S": "sentence", "W": "lexeme", "M": "morpheme"}
SCHEMA = """xml_path string, root_lang string, element_tag string, element_index int, xml_id string, unit_context string, row_type string,
  form string, form_kind string, contains_unclear boolean, translations array<struct<lang:string,kind:string,position:int,text:string>>, error string"""
_NAMES = ["xml_path", "root_lang", "element_tag", "element_index", "xml_id", "unit_context", "row_type", "form", "form_kind", "contains_unclear", "translations", "error"]


def _text(e: ET.Element) -> str:
    return "".join(e.itertext()).strip()


def _context(tag: str, above: list[str], has_words: bool) -> str:
    if tag == "S":
        return "sentence"
    if tag == "M":
        return "word_morpheme" if "W" in above else "sentence_morpheme" if "S" in above else "standalone_morpheme"
    if "S" in above:
        return "sentence_word"
    return "nested_word" if "W" in above else "ambiguous_word" if has_words else "standalone_word"


def _form(unit: ET.Element) -> tuple[str | None, str, bool]:
    """The standard tier if it has text, else the original, else a single untyped one; two of a kind are an error."""
    tiers: dict[str, tuple[str, bool]] = {}
    for f in unit.findall("FORM"):
        kind = (f.get("kindOf") or "").strip().lower() or "untyped"
        if kind in tiers:
            raise ValueError(f"two {kind} forms in {unit.get('id')}")
        tiers[kind] = (_text(f), f.find(".//UNCLEAR") is not None)
    for kind in ("standard", "original", "untyped"):
        if tiers.get(kind, ("", False))[0]:
            return tiers[kind][0], kind, tiers[kind][1]
    return None, "missing", any(u for _, u in tiers.values())


def parse(path: str, content: bytes) -> list[tuple]:
    """Rows of SCHEMA for one file; a file that can't be used gives one row with the error."""
    try:
        root = ET.fromstring(content)
        rows: list[tuple] = []

        def walk(e: ET.Element, above: list[str]) -> None:
            if e.tag in KINDS:
                form, kind, unclear = _form(e)
                counts: dict[str, int] = {}
                found = []
                for t in e.findall("TRANSL"):
                    if text := _text(t):
                        lang = t.get(LANG) or ""
                        found.append({"lang": lang, "kind": (t.get("kindOf") or "").strip(), "position": counts.setdefault(lang, 0), "text": text})
                        counts[lang] += 1
                rows.append((path, root.get(LANG), e.tag, len(rows), e.get("id"), _context(e.tag, above, e.find(".//W") is not None), KINDS[e.tag], form, kind, unclear, found, None))
            for c in e:
                walk(c, [*above, e.tag])

        walk(root, [])
        return rows
    except (ET.ParseError, ValueError) as x:
        return [(path, None, None, None, None, None, None, None, None, None, [], str(x))]


def units(files: DataFrame) -> DataFrame:
    """Units of files (path, content)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([r for p, c in zip(pdf["path"], pdf["content"]) for r in parse(p, bytes(c))], columns=_NAMES).astype({"element_index": "Int32"})

    return files.select("path", "content").mapInPandas(run, SCHEMA)


def read_units(spark: SparkSession, folder: str) -> DataFrame:
    return units(spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.xml").load(folder))


def unit_pairs(found: DataFrame, language: str) -> DataFrame:
    """Sentence-pair rows: a unit's form with each of its translations into language, with stable row ids."""
    from weftline.functions.text import row_id

    pairs = found.where("error is null and form is not null").withColumn("t", F.explode("translations")).where(F.col("t.lang") == language)
    ident = [F.col(c) for c in ("xml_path", "element_tag", "element_index", "xml_id")]
    return pairs.select(row_id(*ident, F.lit(language), F.col("t.position")).alias("row_id"), row_id(*ident).alias("source_record_id"), "xml_path", "row_type", "unit_context", F.col("form").alias("src"), F.col("t.text").alias("tgt"), F.col("t.kind").alias("translation_kind"), "contains_unclear")
