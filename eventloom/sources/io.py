"""Sources and sinks (S1-S4) for batch and Structured Streaming.

Every job reads a string ``value`` per record and writes one. The format is a
parameter, so the same pipeline runs on Kafka in production and on text or
parquet files (or the memory sink) in tests:

* ``kafka`` – ``value`` cast to string; key/headers dropped; partition and
  offset kept for lineage. Consumer group and ``startingOffsets=earliest``
  as the reference's consumer. Needs the Kafka connector on the classpath.
* ``text`` – one record per line (``wholetext=True``: one per file, for
  landing zones holding one API page per file).
* any other format Spark reads (``parquet``, ``json``...) with a ``value`` column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

KAFKA_META = ("topic", "partition", "offset", "timestamp")


def kafka_source_options(
    topic: str, bootstrap_servers: str, group_id: str | None = None, starting_offsets: str = "earliest"
) -> dict[str, str]:
    opts = {"subscribe": topic, "kafka.bootstrap.servers": bootstrap_servers, "startingOffsets": starting_offsets}
    if group_id:
        opts["kafka.group.id"] = group_id
    return opts


def kafka_sink_options(topic: str, bootstrap_servers: str) -> dict[str, str]:
    return {"topic": topic, "kafka.bootstrap.servers": bootstrap_servers}


def _reader(spark: SparkSession, streaming: bool):
    return spark.readStream if streaming else spark.read


def read_values(
    spark: SparkSession,
    fmt: str,
    path: str | None = None,
    options: Mapping[str, str] | None = None,
    *,
    streaming: bool = True,
    schema: str | None = None,
) -> DataFrame:
    """Records as a ``value`` STRING column (plus Kafka metadata for ``kafka``)."""
    r = _reader(spark, streaming).format(fmt).options(**dict(options or {}))
    if fmt == "kafka":
        return r.load().selectExpr("CAST(value AS STRING) AS value", *KAFKA_META)
    if fmt == "text":
        return r.load(path)
    if schema is not None:
        r = r.schema(schema)
    df = r.load(path)
    return df.selectExpr("CAST(value AS STRING) AS value", *[c for c in df.columns if c != "value"])


def stream_writer(
    df: DataFrame,
    fmt: str,
    checkpoint: str,
    *,
    path: str | None = None,
    options: Mapping[str, str] | None = None,
    trigger: Mapping[str, object] | None = None,
    query_name: str | None = None,
    partition_by: Sequence[str] = (),
) -> DataStreamWriter:
    """Append-mode writer; ``checkpointLocation`` is always set (exactly-once
    file sinks, at-least-once Kafka)."""
    w = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    w = w.options(**dict(options or {}))
    if path is not None and fmt not in ("memory", "kafka", "console"):
        w = w.option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if query_name:
        w = w.queryName(query_name)
    return w.trigger(**dict(trigger or {"availableNow": True}))


def start(writer: DataStreamWriter) -> StreamingQuery:
    return writer.start()


def write_values(df: DataFrame, fmt: str, path: str | None = None, options: Mapping[str, str] | None = None,
                 mode: str = "append") -> None:
    """Batch write of a ``value`` column (Kafka) or any columns (files)."""
    w = df.write.format(fmt).options(**dict(options or {}))
    if fmt != "kafka":
        w = w.mode(mode)
    w.save(path) if path is not None else w.save()
