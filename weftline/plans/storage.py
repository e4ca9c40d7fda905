"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used only where the session names no shared folder and its executors are threads of this machine (tests).
LOCAL_SHARED = "file:///tmp/checkpoints/weftline"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder that spark.checkpoint.dir names; raises if a cluster names none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = LOCAL_SHARED
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


#: Shuffle files of a write are of no use once it has ended.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_FOLDER = "_weft_folder"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once as Parquet in the shared folder and read back: cuts lineage, outlives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before) if before is not None else spark.conf.unset(CLEAN_UP)
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__[_FOLDER] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes the folders of stored tables that nothing will read any more; other tables are left alone."""
    for df in tables:
        path = df.__dict__.pop(_FOLDER, None)
        if path is not None:
            spark = df.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)
