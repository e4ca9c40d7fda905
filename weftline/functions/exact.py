"""Arrow UDFs with exact Unicode semantics, and the ordered text standardizer. Use the native builders where text is ASCII."""

from __future__ import annotations

import html
import re
import unicodedata
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CONTROL = re.compile(r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]")
_KEEP = ("L", "N", "M")


def _squeeze(x: str) -> str:
    return " ".join(x.split()) if x.isascii() and not _CONTROL.search(x) else re.sub(r"\s+", " ", x).strip()


def clean(raw: str | None) -> tuple[str, list[str]]:
    """N1: controls to spaces, entities, NFC, white space; and the steps that changed something."""
    text, done = raw or "", []
    for name, step in (
        ("remove_controls", lambda t: "".join(" " if unicodedata.category(c) in ("Cc", "Cf", "Cs") else c for c in t)),
        ("html_unescape", html.unescape),
        ("unicode_nfc", lambda t: unicodedata.normalize("NFC", t)),
        ("whitespace", lambda t: re.sub(r"\s+", " ", t).strip()),
    ):
        new = step(text)
        if new != text:
            text = new
            done.append(name)
    return text, done


def exact_key(x: str | None) -> str:
    """N2."""
    return _squeeze(unicodedata.normalize("NFC", x or "").casefold())


def letters(x: str | None) -> str:
    """N3."""
    return "".join(c for c in unicodedata.normalize("NFC", x or "").casefold() if unicodedata.category(c)[0] in _KEEP)


def leakage_key(x: str | None) -> str:
    """N4."""
    return _squeeze(unicodedata.normalize("NFKC", x or "").casefold())


def leakage_skeleton(x: str | None) -> str:
    """N5."""
    return "".join(c for c in leakage_key(x) if unicodedata.category(c)[0] in _KEEP)


def overlap_key(x: str | None) -> str:
    """N6."""
    return " ".join(unicodedata.normalize("NFC", x or "").split())


@F.pandas_udf(T.StringType())
def exact_key_udf(x: pd.Series) -> pd.Series:
    return x.map(exact_key)


@F.pandas_udf(T.StringType())
def letters_udf(x: pd.Series) -> pd.Series:
    return x.map(letters)


@F.pandas_udf(T.StringType())
def leakage_key_udf(x: pd.Series) -> pd.Series:
    return x.map(leakage_key)


@F.pandas_udf(T.StringType())
def leakage_skeleton_udf(x: pd.Series) -> pd.Series:
    return x.map(leakage_skeleton)


@F.pandas_udf(T.StringType())
def overlap_key_udf(x: pd.Series) -> pd.Series:
    return x.map(overlap_key)


_STRINGS = T.ArrayType(T.StringType())


@F.pandas_udf(T.StructType().add("text", T.StringType()).add("transformations", _STRINGS))
def clean_udf(x: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([clean(v) for v in x], columns=["text", "transformations"])


# Fixed values of the standardizer.
UNRESOLVED = ("<", ">", "=", "Ø", "∅", "*", "_", "{", "}", "|", "\\")
NULL_MORPHEMES = ("Ø-", "∅-", "-Ø", "-∅", "Ø", "∅")
INVISIBLE = "​‌‍﻿"
HEADING = re.compile(r"(^|\s)==+\s*([^=\n]+?)\s*==+(?=\s|$)")
INFIX = (("unwrap_angle_infix", re.compile(r"<([^<>\s]{1,24})>")), ("unwrap_braced_morpheme", re.compile(r"\{([^{}\s]{1,24})}")))
OPTIONAL = re.compile(r"\(([^()\s]{1,16})\)")
SLASH = re.compile(r"(?<!\S)([^\s/]+)\s*/\s*([^\s/]+)(?!\S)")
TILDE = re.compile(r"(?<!\S)([^\s~]+)\s+~\s+([^\s~]+)(?!\S)")
SPEAKER = re.compile(r"^([A-Z][A-Za-z0-9_. -]{0,31}):\s+")
URL = re.compile(r"(?:https?://|www\.)", re.IGNORECASE)
FOOTNOTE = re.compile(r"(?<=\D)[⁰¹²³⁴⁵⁶⁷⁸⁹]+(?=\s|$)")
BOUNDARIES = (("-", "remove_hyphen_boundary"), ("~", "remove_tilde_boundary"), ("+", "remove_plus_boundary"))


def _letter(c: str) -> bool:
    return bool(c) and (unicodedata.category(c)[0] in _KEEP or c in "'’ʼ")


def _all_letters(x: str) -> bool:
    return bool(x) and all(map(_letter, x))


@dataclass
class _Edit:
    """A text under rewriting, with the ledger of the rules that changed it."""

    text: str
    ledger: list[tuple[str, int]] = field(default_factory=list)
    ambiguous: bool = False

    def set(self, rule: str, new: str, count: int = 1, ambiguous: bool = False) -> None:
        if new != self.text:
            self.text = new
            self.ledger.append((rule, max(count, 1)))
            self.ambiguous |= ambiguous

    def drop(self, rule: str, mark: str, ambiguous: bool = False) -> None:
        if mark in self.text:
            self.set(rule, self.text.replace(mark, ""), self.text.count(mark), ambiguous)

    def unwrap(self, rule: str, pattern: re.Pattern, allowed, ambiguous: bool = False, again: bool = False) -> None:
        """Replaces matches by their content where allowed(text, match); with again until nothing matches."""
        text, total = self.text, 0
        while True:
            hits = [m for m in pattern.finditer(text) if allowed(text, m)]
            for m in reversed(hits):
                text = text[: m.start()] + m.group(1) + text[m.end() :]
            total += len(hits)
            if not hits or not again:
                break
        if total:
            self.set(rule, text, total, ambiguous)


def _beside(text: str, a: int, b: int) -> tuple[str, str]:
    return text[a - 1 : a] if a else "", text[b : b + 1]


def _optional_ok(text: str, m: re.Match) -> bool:
    return _all_letters(m.group(1)) and all(_letter(c) or (c and c in "-=+~") for c in _beside(text, *m.span()))


def _strip_boundary(edit: _Edit, mark: str, rule: str) -> None:
    def keep(m: re.Match) -> str:
        before, after = _beside(edit.text, *m.span())
        gone = (_letter(before) or _letter(after)) and not (before.isdigit() and after.isdigit())
        counts.append(len(m.group()) if gone else 0)
        return "" if gone else m.group()

    counts: list[int] = []
    new = re.sub(re.escape(mark) + "+", keep, edit.text)
    edit.set(rule, new, sum(counts))


def standardize(raw: str | None, row_type: str = "sentence", unclear: bool = False, reviewed: bool = False, unresolved=UNRESOLVED) -> dict:
    """Rewrites annotated source text in a fixed order of rules and decides whether the result can be used.

    Accepted results don't change when they are standardized again.
    """
    out = {"text": "", "status": "ineligible", "confidence": "none", "eval_eligible": False, "transformations": [], "unresolved": [], "reason": "", "speaker_label": ""}
    if unclear or not (raw or "").strip():
        return out | {"reason": "contains_unclear" if unclear else "empty_source_standard"}
    e = _Edit(raw)
    e.set("remove_control_and_format_characters", _CONTROL.sub(" ", e.text).translate(dict.fromkeys(map(ord, INVISIBLE))))
    e.set("html_unescape", html.unescape(e.text))
    e.set("unicode_nfc", unicodedata.normalize("NFC", e.text))
    e.set("normalize_whitespace", re.sub(r"\s+", " ", e.text).strip())
    new, n = HEADING.subn(r"\1\2", e.text)
    e.set("strip_wiki_heading_markup", new, n)
    for mark in NULL_MORPHEMES:
        e.drop("remove_null_morpheme", mark)
    for rule, pattern in INFIX:
        e.unwrap(rule, pattern, lambda _, m: _all_letters(m.group(1)))
    if "__" not in e.text:
        e.drop("remove_annotation_underscore", "_", ambiguous=True)
    e.drop("remove_escape_backslash", "\\")
    while True:
        before = e.text
        e.drop("remove_clitic_boundary", "=")
        for mark, rule in BOUNDARIES:
            _strip_boundary(e, mark, rule)
        e.unwrap("include_optional_intraword_segment", OPTIONAL, _optional_ok, ambiguous=True, again=True)
        if e.text == before:
            break
    reason, slashes = "", e.text.count("/")
    if URL.search(e.text):
        reason = "url_in_source_standard"
    elif slashes > 4:
        reason = "complex_slash_notation"
    elif slashes:
        e.unwrap("select_first_slash_alternative", SLASH, lambda _, m: True, ambiguous=True, again=True)
        reason = "unresolved_slash_notation" if "/" in e.text else ""
    e.unwrap("select_first_tilde_alternative", TILDE, lambda _, m: True, ambiguous=True, again=True)
    new, n = FOOTNOTE.subn("", e.text)
    e.set("strip_superscript_footnote", new, n)
    e.set("normalize_whitespace", re.sub(r"\s+", " ", e.text).strip())
    speaker = SPEAKER.match(e.text)
    marks = sorted({m for m in unresolved if m in e.text} | ({"exercise_blank"} if "__" in e.text else set()))
    out |= {"text": e.text, "transformations": [{"rule": r, "count": c} for r, c in e.ledger], "unresolved": marks, "speaker_label": speaker.group(1) if speaker else ""}
    if not any(unicodedata.category(c)[0] in _KEEP for c in e.text):
        return out | {"reason": "empty_or_nonlinguistic_after_standardization"}
    if reason or marks:
        return out | {"status": "quarantine", "confidence": "ambiguous", "reason": reason or "unresolved_annotation_markers"}
    return out | {"status": "accepted", "confidence": "ambiguous" if e.ambiguous else "safe" if e.ledger else "unchanged", "eval_eligible": row_type == "sentence" and (not e.ambiguous or reviewed)}


STANDARD = T.StructType().add("text", "string").add("status", "string").add("confidence", "string").add("eval_eligible", "boolean").add("transformations", T.ArrayType(T.StructType().add("rule", "string").add("count", "integer"))).add("unresolved", _STRINGS).add("reason", "string").add("speaker_label", "string")


@F.pandas_udf(STANDARD)
def standardize_udf(text: pd.Series, row_type: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([standardize(t, r) for t, r in zip(text, row_type)], columns=STANDARD.names)
