"""D1 and D3 over a stream against the batch operators: restarts, replayed batches, re-sends across batches."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from eventloom.operators.dedupe import mark_fifo, mark_first, mark_horizon
from eventloom.session import scratch_dir
from eventloom.sources.registry import SourceConfig
from eventloom.streaming import memory
from eventloom.streaming.jobs import start_ingest
from eventloom.streaming.memory import FifoMemory, FirstMemory, HorizonMemory
from test_streaming import land, page

FERRY = SourceConfig("ferry")
RAW = "source string, source_event_endpoint string, source_event_id string, observed_at string, seq long, reason string"
BEGIN = dt.datetime(2031, 3, 4, tzinfo=dt.timezone.utc)


def frame(spark, rows):
    return spark.createDataFrame([("ferry", "default", i, at and (BEGIN + dt.timedelta(seconds=at - 1)).isoformat(), seq, reason) for i, at, seq, reason in rows], RAW)


def flags(df):
    return sorted((r["seq"], r["is_duplicate"]) for r in df.collect())


def test_first_over_batches_equals_one_batch(spark, monkeypatch):
    monkeypatch.setattr(memory, "BUCKETS", 3)
    r = random.Random(5)
    rows = [(r.choice([None, "", *map(str, range(60))]), 1, seq, "invalid_event" if seq % 17 == 0 else None) for seq in range(300)]
    whole = {x["seq"]: x["is_duplicate"] for x in mark_first(frame(spark, [x for x in rows if x[3] is None])).collect()}
    first = FirstMemory(spark, scratch_dir(spark, "t-first"))
    for number, at in enumerate(range(0, 300, 75)):
        part = rows[at : at + 75]
        expected = sorted((seq, whole.get(seq, False)) for _, _, seq, _ in part)
        assert flags(first.mark(frame(spark, part), number)) == expected
        if number == 2:  # the batch is replayed, and in another order of rows
            assert flags(first.mark(frame(spark, part[::-1]), number)) == expected
    assert flags(first.mark(frame(spark, []), 4)) == []


def test_filters_know_every_key():
    import numpy as np
    import pyarrow as pa

    hashes = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000, dtype=np.int64)
    table = lambda h: pa.table({"bucket": pa.array([7] * len(h), pa.int32()), "hash": h, "key": [str(x) for x in h]})
    made = [memory.filter_of(table(hashes[k::2])) for k in (0, 1)]
    both = pa.concat_tables(made)
    assert memory.known_to(table(hashes), both).num_rows == 5000
    others = np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 5000, dtype=np.int64)
    assert memory.known_to(table(others), both).num_rows < 250
    assert memory.known_to(table(hashes), both.slice(0, 0)).num_rows == 0


@pytest.mark.parametrize("delay", [0, 400])
def test_horizon_over_batches_equals_one_batch(spark, delay):
    r = random.Random(delay)
    rows = [(r.choice(["a", "b", "c", None]), 1 + 90 * k + r.randint(0, delay), k, None) for k in range(80)] + [("d", None, 900, None), ("e", 5, 901, "invalid_event")]
    rows.append(("end", 10**6, 999, None))
    live = frame(spark, [x for x in rows if x[3] is None]).withColumn("seen_ts", F.to_timestamp("observed_at"))
    whole = {x["seq"]: x["is_duplicate"] for x in mark_horizon(live, "10 minutes", event_time="seen_ts", order=["seq"]).collect()} | {901: False}
    horizon = HorizonMemory(spark, scratch_dir(spark, "t-horizon"), "10 minutes", delay)
    got = []
    for number, at in enumerate(range(0, len(rows), 21)):
        part = frame(spark, rows[at : at + 21])
        decided = flags(horizon.mark(part, number))
        assert decided == flags(horizon.mark(part, number))  # replayed
        got += decided
    whole.pop(999)  # the watermark has not passed the last event
    got = [x for x in got if x[0] != 999]
    assert sorted(got) == sorted(whole.items())


def test_late_rows_count_as_seen_at_the_watermark(spark):
    horizon = HorizonMemory(spark, scratch_dir(spark, "t-late"), "10 minutes", 0)
    assert flags(horizon.mark(frame(spark, [("a", 1, 1, None), ("b", 1200, 2, None)]), 0)) == [(1, False), (2, False)]
    late = [("a", 2, 3, None), ("a", 1900, 4, None), ("a", 1750, 5, None), ("b", 3, 6, None)]
    # the first a is seen at 1200, so the two that follow within 600 seconds are duplicates; so is b
    assert flags(horizon.mark(frame(spark, late), 1)) == [(3, False), (4, False), (5, True), (6, True)]


def test_horizon_stores_full_rows_only_as_they_come(spark, monkeypatch):
    """The rows that a batch decides go to the sink without being stored a second time; times within the horizon are kept."""
    names, keep = [], memory.stored
    monkeypatch.setattr(memory, "stored", lambda df, name: names.append(name) or keep(df, name))
    horizon = HorizonMemory(spark, scratch_dir(spark, "t-stored"), "10 minutes", 0)
    assert flags(horizon.mark(frame(spark, [("a", 1, 1, None), ("a", 700, 2, None), ("b", 900, 3, None), ("b", 901, 4, None)]), 0)) == [(1, False), (2, False), (3, False), (4, True)]
    assert names == ["horizon-fresh"]
    seconds = lambda at: (BEGIN + dt.timedelta(seconds=at - 1)).timestamp() * 1_000_000
    times = spark.read.parquet(horizon.tables.path("times", 0)).select("source_event_id", "_at").collect()
    assert sorted(tuple(r) for r in times) == [("a", seconds(700)), ("b", seconds(900))]
    assert flags(horizon.mark(frame(spark, [("a", 1200, 5, None), ("a", 1301, 6, None), ("b", 1499, 7, None)]), 1)) == [(5, True), (6, False), (7, True)]


@pytest.mark.parametrize("dedupe", ["first", "horizon"])
def test_ingest_job_keeps_duplicates_and_counts(spark, dedupe):
    root = scratch_dir(spark, "t-remember")
    kw = {"dedupe": dedupe, "order": ["page_file", "page_pos"], "observed_at": "2031-03-04T05:06:07+00:00"}
    run = lambda: start_ingest(spark, FERRY, source_format="text", source_path=f"{root}/in", sink_format="parquet", sink_path=f"{root}/out", checkpoint=f"{root}/ckpt", **kw).awaitTermination()
    land(f"{root}/in", "p1.txt", page(1, 2, 2))
    run()
    land(f"{root}/in", "p2.txt", page(2, 3), "oops")
    run()
    out = spark.read.parquet(f"{root}/out")
    ok = sorted(json.loads(r["value"])["source_event_id"] for r in out.where("outcome = 'ok'").collect())
    assert ok == ["1", "2", "3"]
    bad = sorted((r["reason"], r["raw_value"] and (r["raw_value"] if r["raw_value"] == "oops" else json.loads(r["raw_value"])["id"])) for r in out.where("outcome = 'quarantine'").collect())
    assert bad == [("duplicate", "2"), ("duplicate", "2"), ("malformed_page", "oops")]
    counts = spark.read.parquet(f"{root}/ckpt/memory/counts").where("reason IN ('rows', 'ok', 'duplicate')").groupBy("reason").agg(F.sum("rows").alias("n")).collect()
    assert {r["reason"]: r["n"] for r in counts} == {"rows": 6, "ok": 3, "duplicate": 2}


def test_fifo_over_batches_equals_one_batch(spark):
    """Two scopes, more ids than the memory; one batch is replayed, one has no valid row."""
    r, root = random.Random(7), scratch_dir(spark, "t-fifo-memory")
    rows = [("ferry", f"e{i % 2}", str(r.randrange(14)), i, "bad" if i % 11 == 0 or 80 <= i < 90 else None) for i in range(160)]
    schema = "source string, source_event_endpoint string, source_event_id string, seq long, reason string"
    whole = spark.createDataFrame(rows, schema)
    marked = mark_fifo(whole.where("reason IS NULL"), 5).select("seq", "is_duplicate").collect()
    want = dict.fromkeys(range(160), False) | {x["seq"]: x["is_duplicate"] for x in marked}
    got = {}
    for n, (low, high) in enumerate([(0, 3), (3, 80), (80, 90), (90, 160)]):
        part = spark.createDataFrame(rows[low:high], schema)
        for _ in range(2 if n == 1 else 1):
            got |= dict(flags(FifoMemory(spark, root, 5, order=["seq"]).mark(part, n)))
    assert got == want and sum(got.values()) > 20


def test_fifo_stream_spreads_one_scope_over_tasks(spark, monkeypatch):
    """The rows of one scope are decided in chunks of their own, and none passes a state of its scope."""
    from eventloom.operators import dedupe

    sizes = []
    monkeypatch.setattr(dedupe, "chunk_number", lambda rows, chunk_rows: sizes.append(rows) or 4)
    root = scratch_dir(spark, "t-fifo-spread")
    for k in range(3):
        land(f"{root}/in", f"p{k}.txt", page(*range(100 * k, 100 * k + 150)))
    q = start_ingest(spark, FERRY, source_format="text", source_path=f"{root}/in", sink_format="parquet", sink_path=f"{root}/out", checkpoint=f"{root}/ckpt",
                     dedupe="fifo", order=["page_file", "page_pos"], observed_at="2031-03-04T05:06:07+00:00")
    q.awaitTermination()
    assert sizes == [450] and not q.lastProgress["stateOperators"]
    counts = q.lastProgress["observedMetrics"]["eventloom"].asDict()
    assert (counts["rows"], counts["ok"], counts["duplicate"]) == (450, 350, 100)
