"""J1 and J2 as streams: equal to the batch run, state and counts across restarts, rejected rows kept."""

import json
import os

import pytest
from event_helpers import POLLED, by_rid, envelope, values_df
from test_language import BASE

from eventloom.operators.normalize import normalize
from eventloom.plans.contract import Contract, builtin_contracts
from eventloom.session import scratch_dir
from eventloom.sources.registry import SourceConfig
from eventloom.streaming.jobs import start_ingest, start_normalize, to_topics
from test_normalizer import PLAIN

FERRY = SourceConfig("ferry")


def land(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/.{name}", "w") as f:
        f.write("\n".join(lines) + "\n")
    os.replace(f"{folder}/.{name}", f"{folder}/{name}")


def page(*ids, **more):
    return json.dumps([{"id": i, "type": "Departed", "n": n} | more for n, i in enumerate(ids)])


def test_normalize_stream_equals_batch(spark):
    root = scratch_dir(spark, "t-normalize")
    values = [envelope(BASE | {"deck": d}, event_id=str(d)) for d in range(4)] + ["{", envelope(BASE, source="kayak"), envelope(BASE | {"logged": "?"})]
    land(f"{root}/in", "a.txt", *values)
    q = start_normalize(spark, {"ferry": PLAIN}, source_format="text", source_path=f"{root}/in", sink_format="parquet", sink_path=f"{root}/out", checkpoint=f"{root}/ckpt")
    q.awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    batch = by_rid(normalize(values_df(spark, values), {"ferry": PLAIN}, keep=["rid"]))
    assert sorted((r.event_id, json.loads(r.attributes)["deck"]) for r in out.where("outcome = 'ok'").collect()) == [(r["event_id"], r["attributes"]["deck"]) for r in batch]
    assert sorted((r.reason, r.raw_value) for r in out.where("outcome = 'quarantine'").collect()) == sorted(zip(["malformed", "unknown_source", "normalize_error"], values[4:], strict=True))
    counts = q.lastProgress["observedMetrics"]["eventloom"].asDict()
    assert counts == {"rows": 7, "ok": 4, "malformed": 1, "unknown_source": 1, "normalize_error": 1, "invalid_event": 0, "malformed_page": 0, "duplicate": 0}


def ingest(spark, root, **kw):
    q = start_ingest(spark, FERRY, source_format="text", source_path=f"{root}/in", sink_format="parquet", sink_path=f"{root}/out", checkpoint=f"{root}/ckpt",
                     observed_at=POLLED.isoformat(), **kw)
    q.awaitTermination()
    return q.lastProgress["observedMetrics"]["eventloom"].asDict()


def test_fifo_memory_outlives_a_restart(spark):
    root = scratch_dir(spark, "t-ingest")
    order = ["page_file", "page_pos"]
    land(f"{root}/in", "p1.txt", page(10, 11, 12))
    ingest(spark, root, max_size=2, order=order)
    land(f"{root}/in", "p2.txt", page(12, 10, 11, 11))
    land(f"{root}/in", "p3.txt", page(11, 13))
    land(f"{root}/in", "p4.txt", "oops")
    counts = ingest(spark, root, max_size=2, order=order)
    rows = spark.read.parquet(f"{root}/out").collect()
    # remembered after the first run: 11, 12. 12 is a duplicate; 10 pushes out 11, 11 pushes out 12, then two more 11
    assert sorted(r.source_event_id for r in rows if r.outcome == "ok") == ["10", "10", "11", "11", "12", "13"]
    assert sorted((r.reason, r.source_event_id) for r in rows if r.outcome == "quarantine" and r.source_event_id) == [("duplicate", "11"), ("duplicate", "11"), ("duplicate", "12")]
    assert (counts["rows"], counts["ok"], counts["duplicate"], counts["malformed_page"]) == (7, 3, 3, 1)


def test_pages_of_one_micro_batch_do_not_interleave(spark):
    root = scratch_dir(spark, "t-order")
    land(f"{root}/in", "p1.txt", page(1, 2, 3, v="old"))
    land(f"{root}/in", "p2.txt", page(3, 2, 4, v="new"))
    ingest(spark, root, order=["page_file", "page_pos"])
    rows = spark.read.parquet(f"{root}/out").where("outcome = 'ok'").collect()
    assert sorted((r.source_event_id, json.loads(r.value)["payload"]["v"]) for r in rows) == [("1", "old"), ("2", "old"), ("3", "old"), ("4", "new")]


def test_horizon_stream(spark):
    root = scratch_dir(spark, "t-horizon")
    land(f"{root}/in", "p1.txt", page(1, 2, 1))
    land(f"{root}/in", "p2.txt", page(2, 3))
    ingest(spark, root, dedupe="horizon", source_options={"maxFilesPerTrigger": "1"})
    assert sorted(r.source_event_id for r in spark.read.parquet(f"{root}/out").collect()) == ["1", "2", "3"]


def test_streams_refuse_what_they_cannot_do(spark):
    root = scratch_dir(spark, "t-refuse")
    land(f"{root}/in", "p1.txt", page(1))
    for kw in ({"dedupe": "first", "order": ["page_pos"]}, {"dedupe": "fifo"}):
        with pytest.raises(ValueError):
            ingest(spark, root, **kw)


def test_rows_for_kafka(spark):
    out = normalize(values_df(spark, [envelope(BASE), "{"]), {"ferry": PLAIN}, output="json", with_reason=True)
    rows = {r.topic: r for r in to_topics(out, "good", "bad", "partition_key").collect()}
    assert rows["good"].key == "LXQT" and json.loads(rows["good"].value)["entity_id"] == "8102"
    assert rows["bad"].key is None and json.loads(rows["bad"].value) == {"reason": "malformed", "raw_value": "{"}
    assert [r.value for r in to_topics(out, None, None).collect()] == [rows["good"].value]
    with pytest.raises(ValueError):
        to_topics(out, None, "bad")


def test_scratch_folders_are_unique(spark):
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")
    assert isinstance(builtin_contracts()["shop"], Contract)
