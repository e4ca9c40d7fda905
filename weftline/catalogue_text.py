"""Registered queries of the text rules, normalizers, derived keys and metrics, each beside its DuckDB SQL.

The tables hold plain prose, so rows are marked by their number: a fixed phrase is put before, after or in place of the
first words of a text, and both sides judge the same marked texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.catalogue import HAN, PAIRS, Tables, _hits, _key, _numbered, _skel, _terminal, _tokens, _unbalanced, _ws, pairs, query
from weftline.catalogue_curation import RICH, rich
from weftline.functions import exact
from weftline.functions import text as X
from weftline.operators import metrics, rules
from weftline.sources import xml_units

_W = "substr(text, 1, 48)"
_PHRASES = (
    "'translation missing'", f"'Source: ' || {_W}", f"{_W} || ' (adapted from an old book)'", f"'Literal translation: ' || {_W}", f"{_W} || ' XXX ' || {_W}", f"{_W} || ' aaaaaaaa'", "'換下一個說。'", "'(noun)'",
    f"'A: ' || {_W}", "'The Long Way Home'", f"{_W} || chr(34) || chr(34)", f"{_W} || ' ' || chr(92) || 'n' || {_W}", f"'[no translation] ' || {_W}", f"{_W} || ' the root is kan, NOM and ACC'", "'kan=NOM ta-ACC 1SG'", "'S-NOM'",
    f"{_W} || ' ka-si-na-lu-ta: '", f"'qwrt tkan xkcm qrst ' || {_W}", f"{_W} || ' the cat and you'", "'dog（狗） cat（貓） cow（牛） pig（豬） hen（雞） fox（狐）'", f"'漢字 ' || {_W} || ' 㐀𠀀'", f"{_W} || ' www.example.com'", f"{_W} || ' <b>x</b>'", f"{_W} || '(unbalanced'",
)
_MARKED = "CASE doc_id % 26 " + " ".join(f"WHEN {i} THEN {p}" for i, p in enumerate(_PHRASES)) + f" ELSE {_W} END"
MARKED = f"SELECT doc_id, coalesce({_MARKED}, '') AS x FROM documents"


def marked(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.coalesce(F.expr(_MARKED.replace("chr(92)", "char(92)").replace("chr(34)", "char(34)")), F.lit("")).alias("x"))


def _sql(p: str) -> str:
    return p.replace("'", "''")


def _like(x: str, p: str) -> str:
    return f"regexp_matches({x}, '{_sql(p)}')"


# RE2 has no lookarounds and no back-references: these say the same in other words.
_BAD_ESCAPE = r'\\+[A-Za-z"“”]|["”]{2,}\s*$'
_REDACTED = "(?i)(?:^|[^A-Za-z])X{3,}(?:[^A-Za-z]|$)"


def _repeated(x: str) -> str:
    return f"coalesce(list_bool_or(list_transform(list_filter(list_distinct(string_split({x}, '')), lambda c: c <> '' AND NOT regexp_matches(c, '\\s')), lambda c: contains({x}, repeat(c, 8)))), false)"


def _heading(x: str) -> str:
    edge = "[()\\[\\]{}<>,;:\"“”‘’'']+"
    words = f"list_filter(list_transform(string_split_regex(trim({x}), '\\s+'), lambda w: regexp_replace(w, '^{edge}|{edge}$', '', 'g')), lambda w: w <> '')"
    return f"(trim({x}) <> '' AND NOT {_terminal(x)} AND len({words}) BETWEEN 2 AND 4 AND coalesce(list_bool_and(list_transform({words}, lambda w: regexp_matches(w, '^[A-Z][A-Za-z''’-]*$'))), true))"


_MARKS = {"missing": rules.MISSING, "embedded_missing": rules.EMBEDDED_MISSING, "prompt": rules.PROMPT, "commentary": rules.COMMENTARY, "stage_only": rules.STAGE_ONLY, "meta_label": rules.META_LABEL, "speaker": rules.SPEAKER, "url": X.URL, "markup": X.MARKUP}


@query(
    "SELECT doc_id, " + ", ".join(f"{_like('x', p)} AS {k}" for k, p in _MARKS.items())
    + f", {_like('trim(x)', rules.PROVENANCE)} AS provenance, {_like('x', _BAD_ESCAPE)} AS bad_escape, {_like('x', _REDACTED)} AS redacted, {_repeated('x')} AS repeated, {_hits('x', _sql(rules.VOCABULARY))} >= 6 AS vocabulary, {_heading('x')} AS heading, {_unbalanced('x')} AS unbalanced, {_numbered('x')} AS numbered FROM ({MARKED})"
)
def text_marks(t):
    x = F.col("x")
    return marked(t).select("doc_id", *(x.rlike(rules.ascii_edges(p)).alias(k) for k, p in _MARKS.items()), F.trim(x).rlike(rules.PROVENANCE).alias("provenance"), x.rlike(rules.BAD_ESCAPE).alias("bad_escape"), x.rlike(rules.REDACTED).alias("redacted"), x.rlike(rules.REPEATED).alias("repeated"), (F.regexp_count(x, F.lit(rules.VOCABULARY)) >= 6).alias("vocabulary"), rules._heading(x).alias("heading"), X.unbalanced(x).alias("unbalanced"), X.numbered_sequence(x).alias("numbered"))


_TAGS = "[" + ", ".join(f"'{c}'" for c in rules.LEXICAL_TAGS) + "]"
_MIXED = "(length(p) BETWEEN 2 AND 8 AND regexp_matches(p, '^[A-Za-z][A-Za-z0-9]*$') AND regexp_matches(p, '[a-z]') AND len(regexp_extract_all(p, '[A-Z]')) >= 2)"


def _tokens_of(x: str) -> str:
    """Per token: parts that are codes, whether it is cut, chained, and whether any part is a code of any kind."""
    edge = "[()\\[\\]{}<>,;:!?\"“”‘’'']+"
    token = f"list_transform(list_filter(string_split_regex(trim({x}), '\\s+'), lambda w: w <> ''), lambda w: regexp_replace(w, '^{edge}|{edge}$', '', 'g'))"
    chained = "len(regexp_extract_all(w, '[=_-]+'))"
    parts = "list_filter(string_split_regex(w, '[.=_-]+'), lambda p: p <> '')"
    code = f"(list_contains({_TAGS}, p) OR regexp_matches(p, '{rules.PERSON_CODE}') OR ({chained} > 0 AND {_MIXED}))"
    return f"""list_transform({token}, lambda w: struct_pack(hits := len(list_filter({parts}, lambda p: {code})), cut := regexp_matches(w, '[.=_-]'), chain := {chained} >= 4,
any_code := coalesce(list_bool_or(list_transform({parts}, lambda p: {code} OR regexp_matches(p, '{rules.GENERIC_CODE}') OR {_MIXED})), false)))"""


_ANY = lambda of, cond: f"coalesce(list_bool_or(list_transform({of}, lambda v: {cond})), false)"
_GLOSS = f"""({_ANY('g', 'v.chain')} OR len(list_filter(g, lambda v: v.hits > 0 AND v.cut)) >= 2 OR (len(list_filter(g, lambda v: v.hits > 0 AND v.cut)) >= 1 AND (coalesce(list_sum(list_transform(g, lambda v: v.hits)), 0) >= 2 OR len(g) <= 3)))"""
_CODES = "len(regexp_extract_all(x, '\\b(?:" + "|".join(sorted(rules.GLOSS_TAGS, key=len, reverse=True)) + ")\\b'))"
_MORPH = "len(regexp_extract_all(x, '(?:^|[^A-Za-z0-9_])[A-Za-z''’()]+(?:-[A-Za-z''’()]+)+\\s*:'))"
_ANALYSIS = f"({_like('x', rules.GRAMMAR)} OR {_CODES} >= 2 OR ({_CODES} > 0 AND {_MORPH} > 0) OR ({_like('x', rules.ROOT)} AND ({_CODES} > 0 OR {_MORPH} > 0)) OR {_MORPH} >= 2)"


@query(f"SELECT doc_id, {_GLOSS} AS gloss, {_GLOSS} OR regexp_matches(x, '\\S[=_]\\S') OR {_ANY('g', 'v.any_code AND (v.cut OR len(g) = 1)')} AS lexical_gloss, {_ANALYSIS} AS analysis FROM (SELECT doc_id, x, {_tokens_of('x')} AS g FROM ({MARKED}))")
def gloss_marks(t):
    x = F.col("x")
    return marked(t).select("doc_id", rules.gloss_structure(x).alias("gloss"), rules.lexical_gloss(x, "english").alias("lexical_gloss"), rules.linguistic_analysis(x, "english").alias("analysis"))


_LATIN_WORDS = "list_transform(regexp_extract_all(x, '[A-Za-z]+(?:[''’][A-Za-z]+)?'), lambda w: lower(w))"
_ODD = (
    "(CASE WHEN regexp_matches(w, 'q[^u]|q$') THEN 1 ELSE 0 END + CASE WHEN regexp_matches(w, '^(?:" + "|".join(rules.CLUSTERS) + ")') THEN 1 ELSE 0 END + CASE WHEN regexp_matches(w, '^[bcdfghjklmnpqrstvwxz]{3,}') AND NOT list_contains(["
    + ", ".join(f"'{c}'" for c in rules.ENGLISH_CLUSTERS) + "], substr(w, 1, 3)) THEN 1 ELSE 0 END + CASE WHEN regexp_matches(w, '[''’]') AND NOT regexp_matches(w, '[''’](?:s|t|re|ve|ll|d|m)$') THEN 1 ELSE 0 END)"
)
_ANCHORS = "[" + ", ".join(f"'{a}'" for a in rules.ANCHORS) + "]"
_FINE = f"(len(ws) < 4 OR list_has_any(list_transform(ws, lambda w: regexp_extract(w, '^[a-z]*')), {_ANCHORS}))"
_SCORE = f"coalesce(list_sum(list_transform(list_distinct(ws), lambda w: {_ODD})), 0)"
_MISMATCH = f"(NOT {_FINE} AND ({_SCORE} >= 2 OR ({_like('x', rules.PHONETIC)} AND {_unbalanced('x')})))"


@query(f"SELECT doc_id, {_MISMATCH} AS mismatch, NOT {_FINE} AND NOT {_MISMATCH} AS uncertain FROM (SELECT doc_id, x, {_LATIN_WORDS} AS ws FROM ({MARKED}))")
def english_quality(t):
    mismatch, uncertain = rules.english_doubt(F.col("x"))
    return marked(t).select("doc_id", mismatch.alias("mismatch"), uncertain.alias("uncertain"))


_NARROW = r"[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}]"


@query(f"SELECT doc_id, {_hits('x', HAN)} AS han, {_hits('x', _NARROW)} AS han_narrow, {_hits('x', HAN)} + {_tokens(f'regexp_replace(x, ' + chr(39) + HAN + chr(39) + ', ' + chr(39) + ' ' + chr(39) + ', ' + chr(39) + 'g' + chr(39) + ')')} AS units, {_tokens('x')} AS english_units FROM ({MARKED})")
def target_units(t):
    x = F.col("x")
    return marked(t).select("doc_id", X.han_count(x).alias("han"), X.han_count(x, narrow=True).alias("han_narrow"), X.target_units(x, "chinese").alias("units"), X.target_units(x, "english").alias("english_units"))


_KIND = "CASE doc_id % 5 WHEN 0 THEN 'Interlinear Gloss' WHEN 1 THEN 'interlinear__gloss' WHEN 2 THEN ' free ' WHEN 3 THEN 'GLOSS' ELSE '' END"
_RTYPE = "CASE doc_id % 4 WHEN 0 THEN ' Sentence' WHEN 1 THEN 'lexeme' WHEN 2 THEN 'odd' ELSE '' END"
_RPATH = "CASE doc_id % 3 WHEN 0 THEN 'a/Dictionary/b' WHEN 1 THEN 'a/學習詞表/b' ELSE 'a/stories/b' END"


@query(f"SELECT doc_id, regexp_replace(lower(trim({_KIND})), '[ _]+', '-', 'g') AS kind, CASE WHEN trim(lower({_RTYPE})) IN ('sentence', 'lexeme', 'morpheme') THEN trim(lower({_RTYPE})) WHEN doc_id % 3 < 2 THEN 'lexeme' ELSE 'unknown' END AS row_type FROM documents")
def kinds_and_types(t):
    return t.documents.select("doc_id", X.translation_kind(F.expr(_KIND)).alias("kind"), X.row_type(F.expr(_RTYPE), F.expr(_RPATH)).alias("row_type"))


_NFC = "nfc_normalize(coalesce({}, ''))".format
_FOLD = lambda x: f"replace(lower({x}), 'ß', 'ss')"
_NORMAL = "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '  ' || substr(text, 1, 80) || chr(10) || 'Straße' WHEN 1 THEN 'e' || chr(769) || ' &amp; ' || substr(text, 1, 80) ELSE substr(text, 1, 80) END AS x FROM documents"


@query(f"SELECT doc_id, replace({_ws(_NFC('x'))}, '&amp;', '&') AS clean, {_FOLD(_ws(_NFC('x')))} AS exact_key, regexp_replace({_FOLD(_NFC('x'))}, '[^\\p{{L}}\\p{{N}}\\p{{M}}]', '', 'g') AS letters, {_FOLD(_ws(_NFC('x')))} AS leakage_key, {_ws(_NFC('x'))} AS overlap_key, CAST(doc_id % 4 = 1 AS INT) AS unescaped FROM ({_NORMAL})")
def normalizers(t):
    x = t.documents.select("doc_id", F.expr(_NORMAL[len("SELECT doc_id, ") : -len(" AS x FROM documents")].replace("chr(769)", "'\u0301'").replace("chr(10)", "char(10)")).alias("x"))
    done = x.select("doc_id", exact.clean_udf("x").alias("c"), exact.exact_key_udf("x").alias("exact_key"), exact.letters_udf("x").alias("letters"), exact.leakage_key_udf("x").alias("leakage_key"), exact.overlap_key_udf("x").alias("overlap_key"))
    return done.select("doc_id", F.col("c.text").alias("clean"), "exact_key", "letters", "leakage_key", "overlap_key", F.array_contains("c.transformations", "html_unescape").cast("int").alias("unescaped"))


_TRAIN_TEXT = _ws(_NFC("text"))


@query(f"SELECT doc_id, md5({_TRAIN_TEXT}) AS digest, CAST(length({_TRAIN_TEXT}) AS BIGINT) AS characters FROM documents")
def training_text(t):
    """NFC with single spaces."""
    d = t.documents.select("doc_id", exact.overlap_key_udf("text").alias("x"))
    return d.select("doc_id", F.md5(F.col("x").cast("binary")).alias("digest"), F.length("x").cast("long").alias("characters"))


_PATH_CORPUS = "CASE WHEN contains(path, 'Dictionary') THEN 'a' ELSE 'b' END"


@query(f"""SELECT row_id, {_key('src')} AS src_key, {_key('tgt')} AS tgt_key, md5({_key('src')} || '␟' || {_key('tgt')}) AS pair_key, {_skel('src')} AS src_skeleton, {_skel('tgt')} AS tgt_skeleton, md5({_skel('src')} || '␟' || {_skel('tgt')}) AS pair_skeleton, {_tokens('src')} AS src_tokens, {_tokens('tgt')} AS tgt_tokens,
{_terminal('src')} AS src_terminal, {_terminal('tgt')} AS tgt_terminal, {_tokens('src')} <= 2 AND {_tokens('tgt')} <= 3 AS short_entry, CASE WHEN contains(path, 'Dictionary') THEN 'dictionary' ELSE 'narrative' END AS bucket, {_PATH_CORPUS} AS corpus, lower(path) AS document_key,
CASE WHEN lower(row_type) IN ('sentence', 'lexeme') THEN lower(row_type) WHEN contains(path, 'Dictionary') THEN 'lexeme' ELSE 'unknown' END AS row_type, {_hits('tgt', _NARROW)} AS tgt_han, lang || '␟' || {_key('src')} AS task_key FROM ({RICH})""")
def derived_keys(t):
    """The keys, counts and marks that splitting and validation work on."""
    return X.with_derived(rich(t)).select("row_id", "src_key", "tgt_key", F.md5(F.col("pair_key").cast("binary")).alias("pair_key"), "src_skeleton", "tgt_skeleton", F.md5(F.col("pair_skeleton").cast("binary")).alias("pair_skeleton"), "src_tokens", "tgt_tokens", "src_terminal", "tgt_terminal", "short_entry", "bucket", "corpus", "document_key", "row_type", "tgt_han", "task_key")


# ---- the pair catalogue ----

_SRC = "substr(text, 50, 6 + 30 * (doc_id % 4)) || CASE doc_id % 29 WHEN 0 THEN ' 456OTCA' WHEN 1 THEN '*' WHEN 2 THEN ' kan=a' WHEN 3 THEN ' 漢' WHEN 4 THEN ' (1) a (2) b' ELSE '' END"
_PAIR_ROWS = f"SELECT doc_id AS row_id, coalesce({_SRC}, '') AS s, coalesce(CASE WHEN doc_id % 31 = 5 THEN {_SRC} WHEN doc_id % 31 = 6 THEN '(1) one (2) two' ELSE {_MARKED} END, '') AS x FROM documents"
_SU, _TU = _tokens("s"), _tokens("x")
_EITHER = lambda p: f"({_like('s', p)} OR {_like('x', p)})"
_ONLY = lambda c: f"NOT regexp_matches({c}, '[\\p{{L}}\\p{{N}}\\p{{M}}]')"
_LET = lambda c: f"regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}}\\p{{M}}]', '', 'g')"
_HEAD = f"({_heading('x')} AND tu <= 3)"
_CHAIN = (
    ("source_artifact_marker", "rejected", "contains(lower(s), '456otca')"), ("source_annotation_marker", "rejected", "contains(s, '*')"), ("target_prompt_scaffolding", "quarantine", _like("x", rules.PROMPT)), ("target_annotation_gloss", "quarantine", _GLOSS), ("target_linguistic_analysis", "quarantine", _ANALYSIS),
    ("embedded_missing_translation_marker", "rejected", _like("x", rules.EMBEDDED_MISSING)), ("target_provenance_note", "quarantine", _like("trim(x)", rules.PROVENANCE)), ("target_translation_commentary", "quarantine", _like("x", rules.COMMENTARY)),
    ("target_numbered_multi_reference", "quarantine", f"{_numbered('trim(x)')} AND NOT {_numbered('s')} AND su <= 12"), ("malformed_source_escaping", "quarantine", _like("s", _BAD_ESCAPE)), ("malformed_target_escaping", "quarantine", _like("x", _BAD_ESCAPE)), ("missing_translation_marker", "rejected", _EITHER(rules.MISSING)),
    ("empty_or_punctuation_only", "rejected", f"({_ONLY('s')} OR {_ONLY('x')})"), ("source_model_length_overflow", "quarantine", "su > 384"), ("target_model_length_overflow", "quarantine", "tu > 384"), ("redaction_placeholder", "rejected", _EITHER(_REDACTED)), ("foreign_script_in_source", "quarantine", f"({_like('s', HAN)} OR {_like('s', X.KANA_HANGUL)})"),
    ("segmentation_marker_in_standard_sentence", "quarantine", "regexp_matches(s, '[=Ø]')"), ("url", "quarantine", _EITHER(X.URL)), ("markup", "quarantine", _EITHER(X.MARKUP)), ("repeated_character_noise", "quarantine", f"({_repeated('s')} OR {_repeated('x')})"), ("presentation_scaffolding", "rejected", _EITHER(rules.STAGE_ONLY)), ("target_meta_label_only", "rejected", _like("x", rules.META_LABEL)),
    ("english_target_script_mismatch", "quarantine", f"({_like('x', HAN)} OR {_like('x', X.KANA_HANGUL)})"), ("english_target_language_mismatch", "quarantine", _MISMATCH), ("source_target_identity", "quarantine", f"(length({_LET('s')}) >= 4 AND {_LET('s')} = {_LET('x')})"),
    ("obvious_alignment_mismatch", "quarantine", "((su >= 10 AND tu <= 2) OR (su >= 12 AND tu <= 3) OR (su >= 18 AND tu <= 5))"), ("target_heading_alignment_mismatch", "quarantine", f"su >= 7 AND {_HEAD}"), ("empty_units", "quarantine", "(su = 0 OR tu = 0)"), ("extreme_fertility", "quarantine", "(tu / su < 0.15 OR tu / su > 12.0)"),
)
_EVIDENCE = "(contains(x, ';') OR starts_with(ltrim(x), '(') OR regexp_matches(regexp_extract(x, '\\p{L}'), '^\\p{Ll}'))"
_PAIR_FLAGS = (
    ("english_language_uncertain", f"NOT {_FINE} AND NOT {_MISMATCH}"), ("lexical_content_sentence", f"su <= 4 AND {_EVIDENCE}"), ("heading_like_target", f"su >= 4 AND {_HEAD}"), ("target_fragment", f"su >= 4 AND tu <= 3 AND NOT {_terminal('x')}"), ("length_asymmetry", "su <= 3 AND tu >= 12"),
    ("definition_like_sentence", "su <= 3 AND tu >= 8 AND (regexp_matches(x, '[;(]') OR contains(lower(x), 'cf.'))"), ("unbalanced_target_delimiters", _unbalanced("x")), ("speaker_prefix_preserved", _EITHER(rules.SPEAKER)),
)
_CHAIN_SQL = lambda i, last: "CASE " + " ".join(f"WHEN {c[2]} THEN '{c[i]}'" for c in _CHAIN) + f" ELSE '{last}' END"


@query(f"""SELECT row_id, disposition, reason, CASE WHEN disposition = 'accepted' THEN flags ELSE '' END AS flags FROM (SELECT row_id, {_CHAIN_SQL(1, 'accepted')} AS disposition, {_CHAIN_SQL(0, '')} AS reason, array_to_string(list_filter([{', '.join(f"CASE WHEN {c} THEN '{n}' END" for n, c in _PAIR_FLAGS)}], lambda q: q IS NOT NULL), '|') AS flags
FROM (SELECT *, {_SU} AS su, {_TU} AS tu, {_tokens_of('x')} AS g, {_LATIN_WORDS} AS ws FROM ({_PAIR_ROWS})))""")
def pair_quality(t):
    chars = lambda sql: sql.replace("chr(92)", "char(92)").replace("chr(34)", "char(34)")
    p = t.documents.select(F.col("doc_id").alias("row_id"), F.coalesce(F.expr(_SRC), F.lit("")).alias("src"), F.coalesce(F.expr(chars(f"CASE WHEN doc_id % 31 = 5 THEN {_SRC} WHEN doc_id % 31 = 6 THEN '(1) one (2) two' ELSE {_MARKED} END")), F.lit("")).alias("tgt"))
    return rules.judge_pairs(p).select("row_id", "disposition", "reason", F.array_join("flags", "|").alias("flags"))


_NAME = "p_name || {} || p_type"
_RAW = "CASE p_partkey % 8 WHEN 0 THEN p_name || '-' || p_type WHEN 1 THEN p_name || '=' || p_type WHEN 2 THEN 'k<um>' || p_name WHEN 3 THEN p_name || '/' || p_type WHEN 4 THEN 'Ø-' || p_name WHEN 5 THEN p_name || ' http://x/y' WHEN 6 THEN '  ' || p_name || '  x' ELSE p_name END"


@query("""SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN p_name || p_type WHEN 1 THEN p_name || p_type WHEN 2 THEN 'kum' || p_name WHEN 5 THEN p_name || ' http://x/y' WHEN 6 THEN p_name || ' x' ELSE p_name END AS text, CASE p_partkey % 8 WHEN 5 THEN 'quarantine' ELSE 'accepted' END AS status,
CASE WHEN p_partkey % 8 IN (3, 5) THEN 'ambiguous' WHEN p_partkey % 8 = 7 THEN 'unchanged' ELSE 'safe' END AS confidence, p_partkey % 8 NOT IN (3, 5) AS eval_eligible, CASE WHEN p_partkey % 8 IN (5, 7) THEN 0 ELSE 1 END AS n_rules,
CASE p_partkey % 8 WHEN 0 THEN 'remove_hyphen_boundary' WHEN 1 THEN 'remove_clitic_boundary' WHEN 2 THEN 'unwrap_angle_infix' WHEN 3 THEN 'select_first_slash_alternative' WHEN 4 THEN 'remove_null_morpheme' WHEN 6 THEN 'normalize_whitespace' ELSE '' END AS rules FROM part""")
def standardize_text(t):
    d = t.part.select("p_partkey", exact.standardize_udf(F.expr(_RAW), F.lit("sentence")).alias("s"))
    return d.select("p_partkey", "s.text", "s.status", "s.confidence", "s.eval_eligible", F.size("s.transformations").alias("n_rules"), F.array_join(F.transform("s.transformations", lambda r: r["rule"]), "|").alias("rules"))


@query(f"""SELECT row_id, source_record_id, xml_path, 'sentence' AS row_type, src, tgt FROM (SELECT substr(sha256(concat_ws('␟', k, CASE WHEN i = 0 THEN '' ELSE CAST(i AS VARCHAR) END, n, 'eng', '')), 1, 24) AS row_id, substr(sha256(concat_ws('␟', k, CASE WHEN i = 0 THEN '' ELSE CAST(i AS VARCHAR) END, n)), 1, 24) AS source_record_id, path AS xml_path, s AS src, t AS tgt
FROM (SELECT path || '␟S' AS k, path, CASE WHEN n = '0' THEN '' ELSE n END AS n, s, t, row_number() OVER (PARTITION BY path ORDER BY n) - 1 AS i FROM (SELECT 'mem/' || (row_id // 1000) || '.xml' AS path, CAST(row_id AS VARCHAR) AS n, trim(src) AS s, trim(tgt) AS t FROM ({PAIRS}))))""")
def xml_units_scan(t):
    esc = lambda c: F.replace(F.replace(F.col(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    s = F.concat(F.lit("<S id='"), F.col("row_id").cast("string"), F.lit("'><FORM kindOf='standard'>"), esc("src"), F.lit("</FORM><TRANSL xml:lang='eng'>"), esc("tgt"), F.lit("</TRANSL></S>"))
    files = pairs(t).select(F.concat(F.lit("mem/"), F.floor(F.col("row_id") / 1000).cast("string"), F.lit(".xml")).alias("path"), s.alias("s")).groupBy("path").agg(F.array_join(F.array_sort(F.collect_list("s")), "").alias("body"))
    found = xml_units.units(files.select("path", F.concat(F.lit("<TEXT xml:lang='en'>"), "body", F.lit("</TEXT>")).cast("binary").alias("content")))
    return xml_units.unit_pairs(found, "eng").select("row_id", "source_record_id", "xml_path", "row_type", "src", "tgt")


# ---- metrics ----

# Words that both sides have get a letter each, the others one letter per side: the same edits, on short strings.
_CODE = lambda w, other: f"array_to_string(list_transform({w}, lambda q: CASE WHEN list_position(b, q) > 0 THEN chr(CAST(34 + list_position(b, q) AS INT)) ELSE '{other}' END), '')"


@query(f"SELECT row_id, levenshtein({_CODE('h', '!')}, {_CODE('r', chr(34))}) AS edits, len(r) AS ref_words FROM (SELECT row_id, h, r, list_distinct(list_intersect(h, r)) AS b FROM (SELECT row_id, list_filter(string_split_regex(src, '\\s+'), lambda q: q <> '') AS h, list_filter(string_split_regex(tgt, '\\s+'), lambda q: q <> '') AS r FROM ({PAIRS})))")
def word_edit_rate(t):
    return metrics.edits_of_pairs(pairs(t), "row_id", "src", "tgt")


def _tokens_13a(c: str) -> str:
    out = f"coalesce({c}, '')"
    for to, of in metrics.TOKENS_13A:
        out = f"replace({out}, '{of}', '{to}')"
    out = f"' ' || {out} || ' '"
    for pattern, by in metrics.SPLITS_13A:
        out = f"regexp_replace({out}, '{pattern}', '{by.replace('$', chr(92))}', 'g')"
    return _ws(out)


def _grams_of(words: bool, orders: int) -> str:
    unit = (lambda c: f"list_filter(string_split({_tokens_13a(c)}, ' '), lambda q: q <> '')") if words else (lambda c: f"list_filter(string_split(regexp_replace({c}, '[ \\t\\n\\x0B\\f\\r]', '', 'g'), ''), lambda q: q <> '')")
    gram = "list_transform(range(1, len(u) - n + 2), lambda i: array_to_string(u[i:i + n - 1], '␟'))"
    side = lambda c: f"SELECT row_id, n, g, count(*) AS k FROM (SELECT row_id, n, unnest({gram}) AS g FROM (SELECT row_id, {unit(c)} AS u, unnest(range(1, {orders} + 1)) AS n FROM ({PAIRS})) WHERE len(u) >= n) GROUP BY ALL"
    return f"""SELECT p.row_id, CAST(p.n AS INT) AS n, CAST(coalesce(matches, 0) AS BIGINT) AS matches, CAST(coalesce(hyp_total, 0) AS BIGINT) AS hyp_total, CAST(coalesce(ref_total, 0) AS BIGINT) AS ref_total FROM (SELECT row_id, unnest(range(1, {orders} + 1)) AS n FROM ({PAIRS})) p
LEFT JOIN (SELECT coalesce(h.row_id, r.row_id) AS row_id, coalesce(h.n, r.n) AS n, sum(least(coalesce(h.k, 0), coalesce(r.k, 0))) AS matches, sum(coalesce(h.k, 0)) AS hyp_total, sum(coalesce(r.k, 0)) AS ref_total FROM ({side('src')}) h FULL JOIN ({side('tgt')}) r ON h.row_id = r.row_id AND h.n = r.n AND h.g = r.g GROUP BY 1, 2) s ON s.row_id = p.row_id AND s.n = p.n"""


@query(_grams_of(False, 6))
def chrf_components(t):
    return metrics.ngram_statistics(pairs(t), "row_id", "src", "tgt")


_SUMS = "SELECT row_id % 3 AS slice, n, sum(matches) AS m, sum(hyp_total) AS h, sum(ref_total) AS r FROM ({}) GROUP BY ALL".format
_CHRF = f"SELECT slice, 100 * avg(CASE WHEN m > 0 THEN 5 * (m / h::DOUBLE) * (m / r::DOUBLE) / (4 * (m / h::DOUBLE) + m / r::DOUBLE) ELSE 0 END) AS chrf FROM ({_SUMS(_grams_of(False, 6))}) WHERE h > 0 OR r > 0 GROUP BY slice"
_BLEU = f"SELECT slice, CASE WHEN min(m) > 0 THEN 100 * exp(avg(CASE WHEN m > 0 THEN ln(m / h::DOUBLE) END) + least(0, 1 - max(CASE WHEN n = 1 THEN r END) / max(CASE WHEN n = 1 THEN h END)::DOUBLE)) ELSE 0 END AS bleu FROM ({_SUMS(_grams_of(True, 4))}) GROUP BY slice"


@query(f"SELECT slice, chrf, bleu FROM ({_CHRF}) JOIN ({_BLEU}) USING (slice)")
def corpus_scores(t):
    p = pairs(t).withColumn("slice", F.col("row_id") % 3)
    one = lambda words, n: metrics.ngram_statistics(p, "row_id", "src", "tgt", n, words).join(p.select("row_id", "slice"), "row_id")
    return metrics.chrf(one(False, 6), ["slice"]).join(metrics.bleu(one(True, 4), ["slice"]), "slice")


@query(f"""WITH w AS (SELECT lang AS s, n_chars::DOUBLE AS v, range AS b, (CAST('0x' || substr(md5('7:' || doc_id || ':' || range // 4), 1 + 8 * CAST(range % 4 AS INT), 8) AS BIGINT) + 0.5) / 4294967296.0 AS u FROM documents, range(200)),
k AS (SELECT s, b, v, {' + '.join(f'CAST(u > {c!r} AS INT)' for c in metrics.poisson_cuts())} AS k FROM w), m AS (SELECT s, b, CASE WHEN sum(k) > 0 THEN sum(k * v) / sum(k) ELSE 0 END AS mean, count(*) AS n FROM k GROUP BY ALL),
r AS (SELECT b, sum(mean * n) / sum(n) AS m FROM m GROUP BY b) SELECT quantile_cont(m, 0.025) AS lower, quantile_cont(m, 0.5) AS median, quantile_cont(m, 0.975) AS upper FROM r""")
def bootstrap_ci(t):
    return metrics.bootstrap(t.documents.select("doc_id", "lang", "n_chars"), "doc_id", "lang", F.col("n_chars"))


@query()
def translation_edit_rate(t):
    """Edits with block moves over reference words; the target beside itself with its first eight words moved to the end."""
    words = F.split("tgt", "\\s+")
    moved = F.concat_ws(" ", F.slice(words, F.lit(9), F.greatest(F.size(words) - 8, F.lit(0))), F.slice(words, 1, 8))
    p = pairs(t).select("row_id", moved.alias("hyp"), F.concat_ws(" ", words).alias("ref")).repartition(int(t.spark.conf.get("spark.sql.shuffle.partitions")), "row_id")  # much work per row
    return metrics.edit_rate(p, "row_id", "hyp", "ref")


@query("SELECT slice, rows, mean_score, exact, over_70, over_85, over_95 FROM (SELECT CAST(item_id % 3 AS BIGINT) AS slice, count(*) AS rows, avg(s) AS mean_score, count(*) FILTER (s = 1) AS exact, avg(CAST(s >= 0.7 AS INT)) AS over_70, avg(CAST(s >= 0.85 AS INT)) AS over_85, avg(CAST(s >= 0.95 AS INT)) AS over_95 FROM (SELECT item_id, (item_id * 37 % 101) / 100.0::DOUBLE AS s FROM benchmark) GROUP BY 1)")
def exposure_by_slice(t):
    """The report of exposure per slice, over given scores."""
    from weftline.operators import reports

    b = t.benchmark.select((F.col("item_id") % 3).alias("slice"), ((F.col("item_id") * 37 % 101) / 100.0).alias("s"))
    return reports.exposure(b, ["slice"], "s", F.col("s") == 1)
