"""Source/sink helpers (S2-S4) and F2 over timestamp columns."""

import datetime as dt

import pytest
from event_helpers import envelope

from eventloom.__main__ import main as cli
from eventloom.functions.time import to_millis_timestamp
from eventloom.operators.normalize import normalize
from eventloom.plans.contract import builtin_contracts
from eventloom.session import scratch_dir
from eventloom.sources.io import kafka_sink_options, kafka_source_options, read_values, stream_writer

EV = {"actor": {"id": 3, "login": "mira"}, "created_at": "2031-03-04T05:06:07Z", "value": 2.5, "props": {"k": 1}}


def test_kafka_options():
    assert kafka_source_options("events-raw", "b:9092", group_id="normalization") == {
        "subscribe": "events-raw", "kafka.bootstrap.servers": "b:9092", "startingOffsets": "earliest",
        "kafka.group.id": "normalization"}
    assert kafka_sink_options("events-normalized", "b:9092") == {
        "topic": "events-normalized", "kafka.bootstrap.servers": "b:9092"}


def test_memory_sink_stream(spark):
    root = scratch_dir(spark, "t-mem")
    spark.createDataFrame([(envelope({**EV, "id": "1"}, source="shop", event_type="view"),)], "value string") \
        .write.text(f"{root}/in")
    src = read_values(spark, "text", f"{root}/in")
    out = normalize(src, builtin_contracts())
    q = stream_writer(out, "memory", f"{root}/ckpt", query_name="t_mem_normalized").start()
    q.awaitTermination()
    rows = spark.sql("SELECT event_type, partition_key FROM t_mem_normalized").collect()
    assert [(r.event_type, r.partition_key) for r in rows] == [("view", "mira")]


def test_to_millis_timestamp(spark):
    df = spark.createDataFrame([(dt.datetime(2031, 3, 4, 5, 6, 7, 123456),), (None,)], "ts timestamp_ntz")
    got = [r[0] for r in df.select(to_millis_timestamp("ts")).collect()]
    assert got == [1930367167123, 0]


def test_cli_stream_needs_checkpoint():
    with pytest.raises(SystemExit):
        cli(["normalize", "--source", "/nowhere", "--sink", "/nowhere", "--stream"])
