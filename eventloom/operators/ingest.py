"""J1 as a DataFrame: pages -> raw envelopes with a verdict on every event.

Nothing is dropped: a row either is accepted (``reason`` NULL, ``value`` the raw
envelope as JSON) or says why not (``malformed_page``, ``invalid_event``,
``duplicate``) and keeps its original text in ``raw_value`` (Q1).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.operators.dedupe import DEFAULT_MEMORY, dedupe_within_horizon, mark_fifo, mark_first, mark_horizon
from eventloom.operators.raw import RAW_COLUMNS, build_raw_events, encode_raw, explode_pages
from eventloom.plans.pinning import filter_here
from eventloom.sources.registry import SourceConfig

REASON_DUPLICATE = "duplicate"
DEDUPE = ("first", "fifo", "horizon", "none")


def raw_events(pages: DataFrame, config: SourceConfig, order: Sequence[str] = (), observed_at: Any = None) -> DataFrame:
    """Pages -> raw columns, ``arrival_1..n``, ``reason`` and ``raw_value``, before any de-duplication."""
    if observed_at is None and not pages.isStreaming:
        # one polling time for the run: the rows are read more than once, and must be the same each time
        observed_at = dt.datetime.now(dt.timezone.utc).isoformat()
    others = [c for c in pages.columns if c != "value"]
    items = explode_pages(pages, keep=others, raw_col="_page_text")
    arrival = arrival_columns(order)
    items = items.select("*", *[F.expr(e).alias(a) for e, a in zip(order, arrival, strict=True)])
    raw = build_raw_events(items, config, keep=[*arrival, "_page_text", "event"], observed_at=observed_at, with_reason=True)
    original = F.coalesce("_page_text", F.to_json("event"))
    return raw.select(*RAW_COLUMNS, *arrival, "reason", F.when(F.col("reason").isNotNull(), original).alias("raw_value"))


def arrival_columns(order: Sequence[str]) -> list[str]:
    return [f"arrival_{i}" for i in range(1, len(order) + 1)]


def verdicts(marked: DataFrame, arrival: Sequence[str]) -> DataFrame:
    """Rows with ``is_duplicate`` -> the ingest's result: duplicates get their reason and keep their text."""
    twice = F.col("is_duplicate")
    out = marked.select(
        *RAW_COLUMNS, *arrival, F.coalesce("reason", F.when(twice, F.lit(REASON_DUPLICATE))).alias("reason"),
        F.coalesce("raw_value", F.when(twice, F.to_json("payload"))).alias("raw_value"))
    return out.select(*RAW_COLUMNS, *arrival, encode_raw(F.col("reason").isNull()).alias("value"), "reason", "raw_value")


def ingest_events(
    pages: DataFrame,
    config: SourceConfig,
    *,
    dedupe: str = "first",
    order: Sequence[str] = (),
    max_size: int = DEFAULT_MEMORY,
    horizon: str = "10 minutes",
    observed_at: Any = None,
) -> DataFrame:
    """Pages (a ``value`` column of JSON arrays, plus any columns) -> raw columns,
    ``arrival_1..n``, ``value``, ``reason``, ``raw_value``; batch or streaming.

    ``order`` lists SQL expressions over the page's columns, ``page_pos`` and
    ``event`` that tell the arrival of any two events apart, page after page,
    e.g. ``["page_file", "page_pos"]`` for one page per file or ``["partition", "offset",
    "page_pos"]`` for Kafka. ``first`` and ``fifo`` need it and fail on ties.
    """
    if dedupe not in DEDUPE:
        raise ValueError(f"unknown dedupe {dedupe!r}, expected one of {', '.join(DEDUPE)}")
    if dedupe in ("first", "fifo") and not order:
        raise ValueError(f"dedupe {dedupe!r} needs an arrival order, e.g. ['page_file', 'page_pos']")
    if dedupe == "first" and pages.isStreaming:
        raise ValueError("dedupe 'first' remembers every id: stream it with streaming.jobs.start_ingest, which keeps an index of them")
    arrival = arrival_columns(order)
    raw = raw_events(pages, config, order, observed_at)
    if dedupe == "none":
        return raw.select(*RAW_COLUMNS, *arrival, encode_raw(F.col("reason").isNull()).alias("value"), "reason", "raw_value")
    if pages.isStreaming and dedupe == "horizon":
        # the stateful operator swallows duplicates: they reach no sink, its metrics count them
        return dedupe_within_horizon(filter_here(raw, "reason IS NULL"), horizon).select(
            *RAW_COLUMNS, *arrival, encode_raw().alias("value"), "reason", "raw_value")
    if pages.isStreaming:
        from eventloom.streaming.fifo import mark_fifo_stream

        marked = mark_fifo_stream(raw, max_size=max_size, order=arrival)
    else:
        valid, rejected = filter_here(raw, "reason IS NULL"), filter_here(raw, "reason IS NOT NULL")
        if dedupe == "first":
            marked = mark_first(valid, order=arrival)
        elif dedupe == "fifo":
            marked = mark_fifo(valid, max_size=max_size, order=arrival)
        else:
            marked = mark_horizon(valid, horizon, order=arrival)
        marked = marked.unionByName(rejected.withColumn("is_duplicate", F.lit(False)))
    return verdicts(marked, arrival)
