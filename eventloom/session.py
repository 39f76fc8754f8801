"""Session settings the operators rely on, and the shared scratch location."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    # timestamps are rendered and compared in UTC
    "spark.sql.session.timeZone": "UTC",
    # a repeated JSON key keeps the last value instead of failing the parse
    "spark.sql.variant.allowDuplicateKeys": "true",
    # the staged timestamp parser of a wide contract has more than the 100 columns that generated code takes by default
    "spark.sql.codegen.maxFields": "400",
    # a longer method would never be compiled by the JVM: such a stage runs as projections, whose methods are split
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in SESSION_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    A session on a cluster must name one. Only a session that runs in one
    process (``local[...]``) and names none gets a private folder."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="eventloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint root for one job."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table below the checkpoint root: computed once, lineage cut,
    readable again after an executor is lost."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
