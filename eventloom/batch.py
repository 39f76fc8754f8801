"""The two jobs as batch runs over a landing zone or a table.

Each run writes its output once, deterministically, with ``mode("overwrite")``:
re-running after a failure (or losing executors mid-run) gives the same
result. Both write one table partitioned by ``outcome`` (``ok`` /
``quarantine``), so accepted rows and the quarantine with its reasons come out
of a single pass, and return the number of rows by reason.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventloom.operators.ingest import ingest_events
from eventloom.operators.normalize import normalize
from eventloom.session import configure
from eventloom.sources.io import read_values
from eventloom.sources.registry import SourceConfig
from eventloom.streaming.jobs import reason_metrics, with_outcome


def _write(out: DataFrame, path: str, partition_by: Sequence[str]) -> dict[str, int]:
    counts = Observation("eventloom")
    with_outcome(out).observe(counts, *reason_metrics()).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return counts.get


def run_ingest(spark: SparkSession, config: SourceConfig, *, source_format: str, source_path: str,
               sink_path: str, source_options: Mapping[str, str] | None = None, **kw: Any) -> dict[str, int]:
    """Pages -> raw envelopes (:func:`ingest_events` takes ``kw``). File sources offer ``page_file``, the
    file's path, to the arrival order. ``payload`` is part of ``value`` and not written twice."""
    configure(spark)
    pages = read_values(spark, source_format, source_path, source_options, streaming=False)
    if source_format != "kafka":
        pages = pages.select("*", F.col("_metadata.file_path").alias("page_file"))
    return _write(ingest_events(pages, config, **kw).drop("payload"), sink_path, ("outcome",))


def run_normalize(spark: SparkSession, contracts: Any, *, source_format: str, source_path: str,
                  sink_path: str, source_options: Mapping[str, str] | None = None,
                  keep: Sequence[str] = (), output: str = "columns",
                  partition_by: Sequence[str] = ("outcome",)) -> dict[str, int]:
    """``partition_by`` may add e.g. ``source`` or ``event_type`` after ``outcome``."""
    configure(spark)
    src = read_values(spark, source_format, source_path, source_options, streaming=False)
    out = normalize(src, contracts, keep=keep, output=output, with_reason=True)
    return _write(out, sink_path, partition_by)


__all__ = ["ingest_events", "run_ingest", "run_normalize"]
