"""Registered queries that write and read files of the shared folder, and that call the library's functions from SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.catalogue import Tables, pairs, query
from weftline.functions.registry import register
from weftline.operators import reports
from weftline.operators.split import candidate_groups, fill
from weftline.plans.storage import shared_dir
from weftline.sources import tables as files


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, coalesce(text, '') AS text, lang FROM documents")
def csv_round_trip(t):
    """Written as CSV and read back with all columns as text; checked on the way."""
    path = shared_dir(t.spark, "csv")
    files.write_csv(t.documents.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "lang"), path)
    return files.checked_csv(t.spark, path, ["doc_id"], "lang", ["de", "en", "es", "fr"])


@query("SELECT doc_id, lang, source, n_chars FROM documents")
def jsonl_inventory(t):
    path = shared_dir(t.spark, "inventory")
    d = t.documents.select("doc_id", "lang", "source", "n_chars")
    digest = files.content_digest(d)
    files.write_inventory(d, path, digest, ["doc_id"])
    return files.read_inventory(t.spark, path, "doc_id long, lang string, source string, n_chars long", digest)


@query("SELECT doc_id, md5(coalesce(text, '')) AS digest FROM documents")
def parquet_companion(t):
    path = shared_dir(t.spark, "companion")
    d = t.documents.select("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest"))
    digest = files.content_digest(d)
    files.write_with_manifest(d, path, digest)
    return files.read_with_manifest(t.spark, path, digest)


_SPLIT = "CASE WHEN doc_id % 20 < 17 THEN 'train' WHEN doc_id % 20 = 17 THEN 'validate' ELSE 'test' END"


@query(f"SELECT {_SPLIT} AS split, count(*) AS rows, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY 1")
def split_sinks(t):
    path = shared_dir(t.spark, "splits")
    files.write_splits(t.documents.select("doc_id", "n_chars", F.expr(_SPLIT).alias("split")), path)
    return t.spark.read.parquet(path).groupBy("split").agg(F.count("*").alias("rows"), F.sum("n_chars").alias("chars"))


_DISPOSITION = "CASE WHEN n_chars < 300 THEN 'rejected' WHEN n_chars > 6000 THEN 'quarantine' ELSE 'accepted' END"


@query(f"SELECT disposition, place, doc_id FROM (SELECT disposition, doc_id, row_number() OVER (PARTITION BY disposition ORDER BY doc_id) AS place FROM (SELECT doc_id, {_DISPOSITION} AS disposition FROM documents)) WHERE disposition <> 'accepted' AND place <= 3")
def rejection_ledger(t):
    """The rows that were not accepted, written by disposition; the first of each as evidence."""
    path = shared_dir(t.spark, "ledger")
    files.write_ledger(t.documents.select("doc_id", F.expr(_DISPOSITION).alias("disposition")).where("disposition <> 'accepted'"), path)
    return reports.samples(t.spark.read.parquet(path), "disposition", "doc_id", 3)


@query("SELECT doc_id, CASE WHEN doc_id % 17 = 0 THEN 'download_error' WHEN doc_id % 19 = 0 THEN 'checksum_error' ELSE 'kept' END AS status FROM documents")
def landed_blobs(t):
    d = t.documents.select("doc_id", F.concat(F.lit("f"), F.col("doc_id").cast("string")).alias("path"), F.coalesce("text", F.lit("")).alias("text"))
    listing = d.select("path", files.blob_digest(F.col("text")).alias("sha"))
    found = d.where("doc_id % 17 <> 0").select("path", F.when(F.col("doc_id") % 19 == 0, F.concat("text", F.lit("?"))).otherwise(F.col("text")).cast("binary").alias("content"))
    return files.landed(found, listing).select(F.expr("substring(path, 2)").cast("long").alias("doc_id"), "status")


@query("SELECT doc_id, sha1('blob ' || strlen(t) || chr(0) || t) AS sha FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)")
def blob_digests(t):
    return t.documents.select("doc_id", files.blob_digest(F.coalesce("text", F.lit(""))).alias("sha"))


@query("SELECT line AS before, upper(line) AS after, count(*) AS n FROM (SELECT lang || '/' || source AS line FROM documents) GROUP BY line")
def log_lines(t):
    """A log of lines `before -> after : n`, written and parsed, with lines of another form passed over."""
    path = shared_dir(t.spark, "log")
    n = t.documents.groupBy(F.concat_ws("/", "lang", "source").alias("b")).agg(F.count("*").alias("n"))
    lines = n.select(F.concat(F.col("b"), F.lit(" -> "), F.upper("b"), F.lit(" : "), F.col("n").cast("string")).alias("value"))
    lines.union(t.spark.createDataFrame([("starting",), ("done : x",)], "value string")).write.text(path)
    return files.read_log(t.spark, path)


@query("SELECT count(*) FILTER (trim(coalesce(text, '')) = '') AS blank_text, count(*) FILTER (lang NOT IN ('en', 'fr')) AS unknown_language, count(*) FILTER (n_chars <> length(text)) AS wrong_length, count(*) - count(DISTINCT doc_id) AS duplicate_ids FROM documents")
def contract_violations(t):
    d = t.documents
    one = files.contract(d, blank_text=F.trim(F.coalesce("text", F.lit(""))) == "", unknown_language=~F.col("lang").isin("en", "fr"), wrong_length=F.col("n_chars") != F.length("text"))
    return one.crossJoin(F.broadcast(d.agg((F.count("*") - F.countDistinct("doc_id")).alias("duplicate_ids"))))  # one row each


@query("SELECT p_partkey, lower(p_name || ' ' || p_type) AS exact_key, replace(lower(p_name || p_type), ' ', '') AS letters, 'accepted' AS status FROM part")
def registered_functions(t):
    register(t.spark)
    t.part.createOrReplaceTempView("weft_part")
    return t.spark.sql("SELECT p_partkey, weft_exact_key(concat('  ', p_name, '  ', p_type)) AS exact_key, weft_letters(concat(p_name, '-', p_type)) AS letters, weft_standardize(concat(p_name, '-', p_type), 'sentence').status AS status FROM weft_part")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS xml_id, 'S' AS element_tag, 0 AS element_index, 'sentence' AS row_type, s_name AS form, 1 AS translations FROM supplier")
def xml_table_function(t):
    register(t.spark)
    body = F.concat(F.lit("<TEXT xml:lang='en'><S id='"), F.col("s_suppkey").cast("string"), F.lit("'><FORM kindOf='standard'>"), F.col("s_name"), F.lit("</FORM><TRANSL xml:lang='eng'>x</TRANSL></S></TEXT>"))
    t.supplier.select(F.concat(F.lit("f"), F.col("s_suppkey").cast("string")).alias("path"), body.cast("binary").alias("content")).createOrReplaceTempView("weft_files")
    return t.spark.sql("SELECT u.xml_id, u.element_tag, u.element_index, u.row_type, u.form, u.translations FROM weft_files f, LATERAL weft_xml_units(f.path, f.content) u WHERE u.error IS NULL")


@query("SELECT region, slice, n FROM (SELECT r_name AS region, 'customers' AS slice, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1 UNION ALL SELECT r_name, 'suppliers', count(*) FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1)")
def release_counts(t):
    """Counts of two tables by a name two lookups away: unions of small grouped counts."""
    of = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("r_name").alias("region"))
    one = lambda df, key, name: df.groupBy(F.col(key).alias("n_nationkey")).agg(F.count("*").alias("c")).join(of, "n_nationkey").groupBy("region").agg(F.lit(name).alias("slice"), F.sum("c").alias("n"))
    return one(t.customer, "c_nationkey", "customers").union(one(t.supplier, "s_nationkey", "suppliers"))


_DIGEST = "CAST(sum(CAST('0x' || substr(md5({}), 1, 8) AS BIGINT)) AS BIGINT)".format


@query(f"SELECT 'labels' AS name, count(*) AS rows, {_DIGEST("concat_ws('␟', doc_id, quality, toxic)")} AS digest FROM labels UNION ALL SELECT 'nation', count(*), {_DIGEST("concat_ws('␟', n_nationkey, n_name, n_regionkey)")} FROM nation")
def provenance_bundle(t):
    return files.provenance({"labels": t.labels, "nation": t.nation})


@query("SELECT n_nationkey, n_name FROM nation WHERE n_regionkey <= 2")
def pinned_snapshot(t):
    """Made once, then read again for the same selection."""
    path = shared_dir(t.spark, "pinned")
    make = lambda: t.nation.where("n_regionkey <= 2").select("n_nationkey", "n_name")
    files.pinned(t.spark, path, {"regions": [0, 1, 2]}, make)
    return files.pinned(t.spark, path, {"regions": [0, 1, 2]}, lambda: make().limit(0))


# ---- groups and fills ----


def _groups(t: Tables):
    return candidate_groups(t.part, ["p_brand"], "p_name", F.col("p_size")).withColumn("md5", F.md5(F.col("p_name").cast("binary")))


_GROUPS = "SELECT p_brand, p_name, count(*) AS size, avg(p_size) AS score, md5(p_name) AS md5 FROM part GROUP BY p_brand, p_name"


@query(_GROUPS)
def quality_groups(t):
    return _groups(t)


@query(f"""WITH RECURSIVE g AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY -round(score, 6), md5) AS i FROM ({_GROUPS})), q AS (SELECT p_brand, CAST(ceil(count(*) * 0.15::DOUBLE) AS BIGINT) AS n FROM part GROUP BY p_brand),
r AS (SELECT g.p_brand, g.p_name, g.size, g.i, g.size <= q.n AS taken, CASE WHEN g.size <= q.n THEN q.n - g.size ELSE q.n END AS rest FROM g JOIN q USING (p_brand) WHERE g.i = 1
UNION ALL SELECT g.p_brand, g.p_name, g.size, g.i, g.size <= r.rest, CASE WHEN g.size <= r.rest THEN r.rest - g.size ELSE r.rest END FROM r JOIN g ON g.p_brand = r.p_brand AND g.i = r.i + 1)
SELECT p_brand, p_name, size FROM r WHERE taken""")
def group_fill(t):
    """Groups by quality until each stratum's quota is full; those that overflow are passed over."""
    quotas = t.part.groupBy("p_brand").agg(F.ceil(F.count("*") * F.lit(0.15)).cast("long").alias("n"))
    return fill(_groups(t), quotas, ["p_brand"], [-F.round("score", 6), F.col("md5")]).select("p_brand", "p_name", "size")


@query("SELECT row_id, su, tu, su > 0 AND tu > 0 AS both FROM (SELECT row_id, len(list_filter(string_split_regex(src, '[^A-Za-z]+'), lambda q: q <> '')) AS su, length(regexp_replace(tgt, '[^A-Za-z]', '', 'g')) AS tu FROM (SELECT u.conv_id * 1000 + u.turn AS row_id, u.text AS src, a.text AS tgt FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant'))")
def lexical_units(t):
    """Units of a text by words or by characters."""
    su = F.size(F.filter(F.split("src", "[^A-Za-z]+"), lambda q: q != "")).cast("long")
    return pairs(t).select("row_id", su.alias("su"), F.length(F.regexp_replace("tgt", "[^A-Za-z]", "")).cast("long").alias("tu")).withColumn("both", F.expr("su > 0 and tu > 0"))


@query("SELECT s_suppkey, trim(regexp_replace(lower(s_name || ' ' || s_acctbal), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM supplier")
def slugs(t):
    from weftline.functions.text import slug

    return t.supplier.select("s_suppkey", slug(F.concat_ws(" ", "s_name", F.col("s_acctbal").cast("string"))).alias("slug"))

