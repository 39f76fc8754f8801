"""Shared helpers: tables, the scratch area of a job, row keys."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all executors share. Only a session
    that runs in one process (``local[...]``) and names none gets a folder of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="corpus-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"


#: Whether Spark removes the shuffle files of a query when it has ended (they stay until the driver collects garbage).
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, tidy: bool = False) -> DataFrame:
    """``df`` written to the scratch area and read again: lineage ends there,
    so a lost executor costs a read and not a recomputation. ``tidy``: the shuffle files go as soon as it is written."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    before = spark.conf.get(CLEANUP)
    if tidy:
        spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def dropped(df: DataFrame) -> None:
    """Removes a table made by ``written`` that nothing reads any more (what was made of it is written itself)."""
    sc = df.sparkSession.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(df.scratch)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


#: Bytes of rows that go to a Python worker, and come back, in one Arrow batch.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches by bytes too: 10,000 whole texts can be a gigabyte, which the executor and its
    Python worker hold several times over."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else untouched (``lower`` is right and fast only for pure ASCII)."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def row_key(id_col: str, text_col: str) -> list[Column]:
    """Columns that identify a row's content: equal rows share a key, and every
    result of these operators is a function of that key."""
    return [F.col(id_col).alias("__id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("__h")]


def same_key(a: DataFrame, b: DataFrame) -> Column:
    return a["__h"].eqNullSafe(b["__h"]) & a["__id"].eqNullSafe(b["__id"])
