"""The corpus pipeline: five stages from documents to packed sequences, each written and read again by its caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import decontam, jaccard_join, packing, quality_model, secrets
from weftline.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality model, fitted on the labels, rejects."""
    return quality_model.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the one with the least id, of each group linked by a Jaccard similarity of 0.8 or more on five-word shingles."""
    return jaccard_join.keep_representatives(docs, width=5, num=80, den=100)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item."""
    return decontam.drop_leaked(docs, table(spark, sf_dir, "benchmark"))


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; all documents stay, and n_chars follows the text."""
    out = secrets.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else out


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the texts into sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("secret_redaction", secret_redaction), ("best_fit_packing", best_fit_packing)]

#: No SQL says what the trained model, the latent search and the packer do; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the whole documents table; each stage's rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
