"""Raw layer: pages, ids, overlay, envelope."""

import json

import pytest

from eventloom.operators.raw import build_raw_events, explode_pages
from eventloom.sources.registry import SourceConfig, get_source_config

OBS = "2031-03-04T05:06:07+00:00"


def raw(spark, events, config, **kw):
    df = spark.createDataFrame([(i, e if isinstance(e, str) else json.dumps(e)) for i, e in enumerate(events)],
                               "rid long, event string")
    out = build_raw_events(df, config, keep=["rid"], observed_at=OBS, with_reason=True, encode=True, **kw)
    return {r.rid: r for r in out.collect()}


def test_github_envelope(spark):
    ev = {"id": "123", "type": "PushEvent", "actor": {"id": 1}, "public": True}
    r = raw(spark, [ev], get_source_config("github"))[0]
    assert (r.source, r.source_event_id, r.source_event_endpoint, r.source_event_type, r.schema_version) == (
        "github", "123", "default", "PushEvent", 1)
    doc = json.loads(r.value)
    assert doc["payload"] == ev and doc["observed_at"] == OBS


def test_id_stringification_and_invalid_rows(spark):
    events = [
        {"id": 123, "type": "X"},
        {"id": None, "type": "X"},        # present JSON null -> "None"
        {"id": True, "type": "X"},
        {"type": "X"},                    # no id
        {"id": "2"},                      # no type
        [1, 2],                           # not an object
        "not json",
    ]
    rows = raw(spark, events, SourceConfig("github"))
    assert [(rows[i].source_event_id, rows[i].reason) for i in range(len(events))] == [
        ("123", None), ("None", None), ("True", None),
        (None, "invalid_event"), (None, "invalid_event"), (None, "invalid_event"), (None, "invalid_event"),
    ]
    assert json.loads(rows[0].value)["payload"]["id"] == "123"


def test_nested_id_path(spark):
    cfg = SourceConfig("custom", id_field="meta.event.id", type_field="kind")
    rows = raw(spark, [{"meta": {"event": {"id": "42"}}, "kind": "K"}, {"meta": {"event": 5}, "kind": "K"}], cfg)
    assert rows[0].source_event_id == "42" and rows[1].reason == "invalid_event"


def test_gitlab_overlay_adds_type(spark):
    rows = raw(spark, [{"id": 9, "object_kind": "push", "user": "u"}], get_source_config("gitlab"))
    payload = json.loads(rows[0].value)["payload"]
    assert payload == {"id": "9", "object_kind": "push", "type": "push", "user": "u"}


def test_registry():
    assert get_source_config("gitlab").type_field == "object_kind"
    assert get_source_config("github", "organization").endpoint == "organization"
    with pytest.raises(NotImplementedError):
        get_source_config("bitbucket")
    with pytest.raises(ValueError):
        get_source_config("github", "nope")


def test_pages(spark):
    pages = spark.createDataFrame(
        [(0, json.dumps([{"id": 1, "type": "A"}, {"id": 2, "type": "B"}])), (1, "[]"), (2, "{broken"), (3, '{"id": 1}')],
        "page long, value string")
    items = explode_pages(pages, keep=["page"])
    got = sorted((r.page, r.page_pos, r.reason) for r in items.collect())
    assert got == [(0, 0, None), (0, 1, None), (2, 0, "malformed_page"), (3, 0, "malformed_page")]
    rawrows = build_raw_events(items, SourceConfig("github"), keep=["page", "page_pos"], observed_at=OBS,
                               with_reason=True).collect()
    assert sorted((r.page, r.source_event_id, r.reason) for r in rawrows) == [
        (0, "1", None), (0, "2", None), (2, None, "malformed_page"), (3, None, "malformed_page")]


def test_processing_time_observed_at(spark):
    df = spark.createDataFrame([(0, '{"id": 1, "type": "A"}')], "rid long, event string")
    r = build_raw_events(df, SourceConfig("github")).collect()[0]
    assert r.observed_at.endswith("+00:00") and r.observed_at[10] == "T"
