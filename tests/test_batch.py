"""Batch runners and the command line."""

import json
import os

import pytest
from event_helpers import POLLED, envelope, values_df
from test_streaming import land, page

from eventloom.__main__ import main as cli
from eventloom.batch import run_ingest, run_normalize
from eventloom.operators.normalize import normalize
from eventloom.operators.raw import build_raw_events
from eventloom.plans.contract import builtin_contracts
from eventloom.session import checkpoint_root, scratch_dir
from eventloom.sources.registry import SourceConfig

SHOP = SourceConfig("shop")
CLICK = {"actor": {"id": 3, "login": "mira"}, "created_at": POLLED.isoformat(), "value": 2.5, "props": {"k": 1}}


def clicks(*ids):
    return json.dumps([CLICK | {"id": i, "type": "click"} for i in ids])


def test_ingest_then_normalize(spark):
    root = scratch_dir(spark, "t-batch")
    for k, text in enumerate([clicks(1, 2), clicks(2, 3), "[oops"]):
        land(f"{root}/pages", f"{k}.txt", text)
    counts = run_ingest(spark, SHOP, source_format="text", source_path=f"{root}/pages", sink_path=f"{root}/raw", dedupe="first", order=["page_file", "page_pos"])
    assert (counts["rows"], counts["ok"], counts["duplicate"], counts["malformed_page"]) == (5, 3, 1, 1)
    spark.read.parquet(f"{root}/raw").where("outcome = 'ok'").select("value").write.text(f"{root}/json")
    for _ in range(2):  # a second run replaces the first
        counts = run_normalize(spark, builtin_contracts(), source_format="text", source_path=f"{root}/json", sink_path=f"{root}/norm")
        assert counts["ok"] == 3
    assert sorted(r.event_id for r in spark.read.parquet(f"{root}/norm").collect()) == ["1", "2", "3"]


def test_whole_files_as_pages(spark):
    root = scratch_dir(spark, "t-whole")
    os.makedirs(f"{root}/pages")
    for k, text in enumerate([clicks(1, 2, 1), clicks(3, 1)]):
        with open(f"{root}/pages/{k}.json", "w") as f:
            f.write(json.dumps(json.loads(text), indent=1))
    run_ingest(spark, SHOP, source_format="text", source_path=f"{root}/pages", source_options={"wholetext": "true"}, sink_path=f"{root}/raw", dedupe="fifo",
               order=["page_file", "page_pos"])
    rows = spark.read.parquet(f"{root}/raw").where("outcome = 'ok'").collect()
    assert sorted((os.path.basename(r.arrival_1), r.arrival_2, r.source_event_id) for r in rows) == [("0.json", 0, "1"), ("0.json", 1, "2"), ("1.json", 0, "3")]


def test_command_line(spark):
    root = scratch_dir(spark, "t-cli")
    land(f"{root}/in", "a.txt", envelope(CLICK | {"id": "9"}, source="shop", event_id="9", event_type="click"), "{")
    cli(["normalize", "--source", f"{root}/in", "--sink", f"{root}/out"])
    assert sorted((r.outcome, r.reason) for r in spark.read.parquet(f"{root}/out").collect()) == [("ok", None), ("quarantine", "malformed")]
    land(f"{root}/pages", "a.txt", page(1, 2))
    land(f"{root}/pages", "b.txt", page(2, 3))
    for mode, more in (("batch", []), ("stream", ["--stream", "--checkpoint", f"{root}/ckpt"])):
        cli(["ingest", "--source", "github", "--input", f"{root}/pages", "--sink", f"{root}/{mode}", "--dedupe", "fifo", "--order", "page_file", "--order", "page_pos", *more])
        rows = spark.read.parquet(f"{root}/{mode}").collect()
        assert sorted((r.outcome, r.source_event_id) for r in rows) == [("ok", "1"), ("ok", "2"), ("ok", "3"), ("quarantine", "2")]


@pytest.mark.parametrize("args", [["--dedupe", "fifo"], ["--dedupe", "first"], ["--dedupe", "first", "--order", "page_pos", "--stream", "--checkpoint", "x"], ["--stream", "--order", "page_pos"]])
def test_command_line_refuses(spark, args):
    with pytest.raises(SystemExit):
        cli(["ingest", "--source", "github", "--input", "x", "--sink", "y", *args])


def filters(df):
    return [line for line in df._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Filter" in line]


def test_reason_filters_stay_where_they_are(spark):
    for df in (normalize(values_df(spark, [envelope(CLICK, source="shop", event_type="click")]), {"shop": builtin_contracts()["shop"]}, keep=["rid"]),
               build_raw_events(spark.createDataFrame([(0, "{}")], "rid long, event string"), SHOP, keep=["rid"])):
        last = [f for f in filters(df) if "reason" in f]
        assert len(last) == 1 and "__pin" in last[0] and len(last[0]) < 400


def test_the_checkpoint_folder_must_be_named_on_a_cluster(spark, monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://far:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())
