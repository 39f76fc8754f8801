"""The two jobs as Structured Streaming queries (J1 ingest, J2 normalize).

J1  landing pages -> explode (S1) -> raw envelope (R1-R7) -> de-duplicate
    (D1 index of ids, D2 last accepted ids or D3 times and watermark) -> raw sink (S4)
J2  raw sink -> normalize by contract (N1-N4, P*, E*) -> normalized sink (S3)

Both are append-only, checkpointed, and run unchanged on any trigger
(``availableNow`` for catch-up / tests, ``processingTime`` for continuous).
Rejected rows go to the quarantine (Q1): a file sink is partitioned by
``outcome``, a Kafka sink sends them to ``quarantine_topic``. Counts by reason are
observed with every micro-batch (``lastProgress["observedMetrics"]["eventloom"]``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryProgress

from eventloom.operators.dedupe import DEFAULT_MEMORY
from eventloom.operators.ingest import arrival_columns, ingest_events, raw_events, verdicts
from eventloom.operators.normalize import NORMALIZED_COLUMNS, normalize
from eventloom.plans.pinning import filter_here
from eventloom.sources.io import read_values, stream_writer
from eventloom.sources.registry import SourceConfig
from eventloom.streaming.memory import FifoMemory, FirstMemory, HorizonMemory, Versions

REASONS = ("malformed", "unknown_source", "normalize_error", "invalid_event", "malformed_page", "duplicate")
#: What one micro-batch of an ingest takes at most, unless the caller sets it.
RATE_LIMIT = {"kafka": {"maxOffsetsPerTrigger": "100000"}}
FILE_RATE_LIMIT = {"maxFilesPerTrigger": "200"}
STREAM_ONLY = ("memory", "console")


class CountedQuery(StreamingQuery):
    """A query that counts its rows by reason inside ``foreachBatch``: ``lastProgress`` has the counts where observed metrics are."""

    def __init__(self, query: StreamingQuery, counts: Mapping[int, Mapping[str, int]]) -> None:
        super().__init__(query._jsq)
        self._counts = counts

    @property
    def lastProgress(self) -> StreamingQueryProgress | None:
        progress = super().lastProgress
        if progress is not None and (seen := self._counts.get(progress["batchId"])):
            progress["observedMetrics"] = {**progress["observedMetrics"], "eventloom": Row(**seen)}
        return progress


def reason_metrics() -> list[Column]:
    """Numbers of rows: all, accepted, rejected by reason (Q1)."""
    metrics = [F.count(F.lit(1)).alias("rows"), F.count_if(F.col("reason").isNull()).alias("ok")]
    return metrics + [F.count_if(F.col("reason") == F.lit(r)).alias(r) for r in REASONS]


def with_reason_counts(df: DataFrame, name: str = "eventloom") -> DataFrame:
    """The counts, computed alongside the write (``DataFrame.observe``)."""
    return df.observe(name, *reason_metrics())


def with_outcome(df: DataFrame) -> DataFrame:
    return df.withColumn("outcome", F.when(F.col("reason").isNull(), F.lit("ok")).otherwise(F.lit("quarantine")))


def to_topics(df: DataFrame, topic: str | None, quarantine_topic: str | None, key: str | None = None) -> DataFrame:
    """Rows for a Kafka sink: accepted ``value`` to ``topic`` (or the sink's own), rejected rows as JSON
    (reason, raw_value) to ``quarantine_topic``; without one they are only counted."""
    ok = F.col("reason").isNull()
    rejected = F.to_json(F.struct("reason", "raw_value"))
    if quarantine_topic is None:
        df = filter_here(df, "reason IS NULL")
    elif topic is None:
        raise ValueError("a quarantine topic needs the topic of accepted rows")
    names = [F.when(ok, F.lit(topic)).otherwise(F.lit(quarantine_topic)).alias("topic")] if topic else []
    keys = [F.when(ok, F.col(key)).alias("key")] if key else []
    return df.select(*names, *keys, F.when(ok, F.col("value")).otherwise(rejected).alias("value"))


def _start(out: DataFrame, sink_format: str, sink_path: str | None, sink_options: Mapping[str, str] | None,
           checkpoint: str, trigger: Mapping[str, Any] | None, quarantine_topic: str | None, key: str | None,
           partition_by: Sequence[str]) -> StreamingQuery:
    out = with_reason_counts(out)
    if sink_format == "kafka":
        options = dict(sink_options or {})
        topic = options.pop("topic", None)
        return stream_writer(to_topics(out, topic, quarantine_topic, key), "kafka", checkpoint, options=options,
                             trigger=trigger).start()
    return stream_writer(with_outcome(out), sink_format, checkpoint, path=sink_path, options=sink_options, trigger=trigger,
                         partition_by=partition_by if sink_format != "memory" else ()).start()


def start_ingest(
    spark: SparkSession,
    config: SourceConfig,
    *,
    source_format: str,
    source_path: str | None = None,
    source_options: Mapping[str, str] | None = None,
    sink_format: str,
    sink_path: str | None = None,
    sink_options: Mapping[str, str] | None = None,
    checkpoint: str,
    trigger: Mapping[str, Any] | None = None,
    dedupe: str = "fifo",
    quarantine_topic: str | None = None,
    **kw: Any,
) -> StreamingQuery:
    """J1. ``kw`` goes to :func:`ingest_events`; ``first`` and ``fifo`` need ``order``. File sources offer ``page_file``.

    ``first``, ``fifo`` and ``horizon`` with an ``order`` remember in tables beside the checkpoint (``<checkpoint>/memory``, see
    :mod:`eventloom.streaming.memory`) and write each micro-batch whole, for a file sink to ``batch=<n>`` below its path;
    their counts by reason are in ``<checkpoint>/memory/counts``. ``horizon`` takes ``delay``, in seconds. Without an ``order``,
    ``horizon`` is Spark's own de-duplication within a watermark, and for sinks that no batch can write (``memory``) ``fifo`` is a
    state of each scope."""
    options = RATE_LIMIT.get(source_format, FILE_RATE_LIMIT) | dict(source_options or {})
    pages = read_values(spark, source_format, source_path, options)
    if source_format != "kafka":
        pages = pages.select("*", F.col("_metadata.file_path").alias("page_file"))
    order = kw.get("order") or ()
    if dedupe in ("first", "fifo") and not order:
        raise ValueError(f"dedupe {dedupe!r} needs an arrival order, e.g. ['page_file', 'page_pos']")
    if dedupe == "first" and list(order) == ["page_pos"]:
        raise ValueError("page_pos counts within a page: the arrival order must tell pages apart, e.g. ['page_file', 'page_pos']")
    if dedupe == "first" or dedupe == "horizon" and order or dedupe == "fifo" and sink_format not in STREAM_ONLY:
        return _start_remembering(pages, config, dedupe, sink_format, sink_path, sink_options, checkpoint, trigger, quarantine_topic, **kw)
    out = ingest_events(pages, config, dedupe=dedupe, **kw).drop("payload")
    return _start(out, sink_format, sink_path, sink_options, checkpoint, trigger, quarantine_topic, None, ("outcome",))


def _start_remembering(pages: DataFrame, config: SourceConfig, dedupe: str, sink_format: str, sink_path: str | None, sink_options: Mapping[str, str] | None,
                       checkpoint: str, trigger: Mapping[str, Any] | None, quarantine_topic: str | None, *, order: Sequence[str] = (),
                       observed_at: Any = None, max_size: int = DEFAULT_MEMORY, horizon: str = "10 minutes", delay: float = 0) -> StreamingQuery:
    spark, root, arrival = pages.sparkSession, f"{checkpoint.rstrip('/')}/memory", arrival_columns(order)
    tables = Versions(spark, root)
    if dedupe == "horizon":
        memory = HorizonMemory(spark, root, horizon, delay, order=arrival)
    else:
        memory = FirstMemory(spark, root, order=arrival) if dedupe == "first" else FifoMemory(spark, root, max_size, order=arrival)
    counts: dict[int, dict[str, int]] = {}

    def write(batch: DataFrame, number: int) -> None:
        seen = Observation()
        out = verdicts(memory.mark(batch, number), arrival).drop("payload").observe(seen, *reason_metrics())
        if sink_format == "kafka":
            options = dict(sink_options or {})
            topic = options.pop("topic", None)
            to_topics(out, topic, quarantine_topic).write.format("kafka").options(**options).save()
        else:
            # a file open for each outcome, instead of sorting the full rows by it
            out.sparkSession.conf.set("spark.sql.maxConcurrentOutputFileWriters", "2")
            with_outcome(out).write.format(sink_format).mode("overwrite").options(**(sink_options or {})).partitionBy("outcome").save(f"{sink_path}/batch={number}")
        counts.clear()
        counts[number] = dict(seen.get)
        tables.write("counts", number, spark.createDataFrame(list(counts[number].items()), "reason string, rows long"))

    raw = raw_events(pages, config, order, observed_at)
    query = raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    return CountedQuery(query, counts)


def start_normalize(
    spark: SparkSession,
    contracts: Any,
    *,
    source_format: str,
    source_path: str | None = None,
    source_options: Mapping[str, str] | None = None,
    sink_format: str,
    sink_path: str | None = None,
    sink_options: Mapping[str, str] | None = None,
    checkpoint: str,
    trigger: Mapping[str, Any] | None = None,
    keep: Sequence[str] = (),
    output: str = "columns",
    partition_by: Sequence[str] = ("outcome",),
    kafka_key: str | None = None,
    quarantine_topic: str | None = None,
) -> StreamingQuery:
    """J2. File sinks get one table partitioned by ``outcome`` (``ok`` /
    ``quarantine``): normalized columns for accepted rows, ``reason`` and
    ``raw_value`` for rejected ones, written in a single pass. A Kafka sink
    gets the normalized JSON of accepted rows, keyed by ``kafka_key``
    (e.g. ``"partition_key"``) when given, so one entity's events share a
    Kafka partition, and the rejected rows on ``quarantine_topic``."""
    src = read_values(spark, source_format, source_path, source_options)
    out = normalize(src, contracts, keep=keep, output="json" if sink_format == "kafka" else output, with_reason=True)
    return _start(out, sink_format, sink_path, sink_options, checkpoint, trigger, quarantine_topic, kafka_key, partition_by)


__all__ = ["NORMALIZED_COLUMNS", "reason_metrics", "start_ingest", "start_normalize", "to_topics", "with_outcome"]
