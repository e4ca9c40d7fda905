"""Column builders for repository paths: predicates, parts, and hints of a language."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parts(path: Column) -> Column:
    return F.split(F.coalesce(path, F.lit("")), "/")


def part(path: Column, i: int) -> Column:
    """The i-th part from 0; empty if there is none."""
    return F.coalesce(F.get(parts(path), F.lit(i)), F.lit(""))


def public_xml(path: Column, root: str = "Corpora", folder: str = "XML") -> Column:
    """An .xml file below root with a folder of that name above it."""
    p = parts(path)
    return F.lower(F.coalesce(path, F.lit(""))).endswith(".xml") & (F.size(p) >= 3) & (part(path, 0) == root) & F.array_contains(F.slice(p, F.lit(1), F.size(p) - 1), folder)


def private_xml(path: Column, roots=("Final_XML", "XML")) -> Column:
    return F.lower(F.coalesce(path, F.lit(""))).endswith(".xml") & (F.size(parts(path)) >= 2) & part(path, 0).isin(*roots)


def corpus_root(path: Column, root: str = "Corpora") -> Column:
    """Second part of a path of three parts or more below root, else null."""
    return F.when((F.size(parts(path)) >= 3) & (part(path, 0) == root), part(path, 1))


def repository(path: Column, marker: str) -> Column:
    """The part after marker; empty without one."""
    p = parts(path)
    return F.coalesce(F.get(p, F.array_position(p, marker).cast("int")), F.lit(""))


def repository_name(value: Column, prefixes=("https://github.com/", "git@github.com:")) -> Column:
    """Last part of a repository's address in lower case, without .git and slashes at the end."""
    x = F.rtrim(F.trim(F.coalesce(value, F.lit(""))), F.lit("/"))
    for p in prefixes:
        x = F.when(x.startswith(p), F.substring(x, F.lit(len(p) + 1), F.length(x))).otherwise(x)
    x = F.regexp_replace(x, "\\.git$", "")
    return F.lower(F.trim(F.element_at(F.split(x, "/"), -1)))


def contains_any(value: Column, patterns) -> Column:
    """Whether any of the patterns (lower case) is in the value, whatever its case."""
    out = F.lit(False)
    for p in patterns:
        out = out | F.contains(F.lower(F.coalesce(value, F.lit(""))), F.lit(p))
    return out


def has_component(path: Column, names) -> Column:
    """Whether a whole part of the path is one of names, whatever its case."""
    return F.arrays_overlap(F.split(F.lower(F.coalesce(path, F.lit(""))), "/"), F.array(*map(F.lit, sorted(names))))


def language_hints(path: Column, hints: dict[str, str]) -> Column:
    """Sorted codes that the path's parts, or the words in them, stand for."""
    low = F.transform(parts(path), lambda p: F.regexp_replace(F.lower(p), "\\.xml$", ""))
    words = F.concat(low, F.flatten(F.transform(low, lambda p: F.split(p, "[^a-z0-9]+"))))
    table = F.create_map(*(F.lit(x) for kv in sorted(hints.items()) for x in kv))
    return F.array_sort(F.array_distinct(F.filter(F.transform(words, lambda w: F.try_element_at(table, w)), lambda c: c.isNotNull())))


def may_match_language(path: Column, language: Column, hints: dict[str, str]) -> Column:
    """No hint at all, or one of the language."""
    found = language_hints(path, hints)
    return (F.size(found) == 0) | F.array_contains(found, F.lower(F.trim(language)))


def pattern_list(*values: str) -> list[str]:
    """Comma-separated patterns in lower case, each once, in order."""
    return list(dict.fromkeys(p.strip().lower() for v in values for p in v.split(",") if p.strip()))


def percent_encoded(path: Column) -> Column:
    """Each part percent-encoded (a space as %20), slashes kept."""
    return F.array_join(F.transform(parts(path), lambda p: F.replace(F.url_encode(p), F.lit("+"), F.lit("%20"))), "/")
