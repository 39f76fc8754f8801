"""J1 over a table of pages: arrival order, duplicates and quarantine (Q1)."""

import json

import pytest

from eventloom.operators.ingest import ingest_events
from eventloom.sources.registry import SourceConfig

FERRY = SourceConfig("ferry")


def page(*ids):
    return json.dumps([{"id": i, "type": "Departed", "knots": n} for n, i in enumerate(ids)])


def pages_df(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "page_no long, value string")


def outcome(df):
    return sorted((r.arrival_1, r.arrival_2, r.source_event_id, r.reason) for r in df.collect())


@pytest.mark.parametrize("dedupe", ["first", "fifo"])
def test_overlapping_pages_lose_no_event(spark, dedupe):
    pages = pages_df(spark, page(1, 2, 3), page(3, 4, 5), page(6, 7, 8))
    out = ingest_events(pages, FERRY, dedupe=dedupe, order=["page_no", "page_pos"])
    rows = outcome(out)
    assert [int(r[2]) for r in rows if r[3] is None] == [1, 2, 3, 4, 5, 6, 7, 8]
    assert [r for r in rows if r[3]] == [(1, 0, "3", "duplicate")]


@pytest.mark.parametrize("dedupe", ["first", "fifo", "horizon", "none"])
def test_every_rejected_row_has_a_reason_and_its_text(spark, dedupe):
    bad = json.dumps([{"id": 1, "type": "Departed"}, {"type": "no id"}, 5, {"id": 1, "type": "Departed"}])
    out = ingest_events(pages_df(spark, bad, "{broken", "[]", page(9)), FERRY, dedupe=dedupe, order=["page_no", "page_pos"])
    rows = {(r.arrival_1, r.arrival_2): r for r in out.collect()}
    assert {k: r.reason for k, r in rows.items()} == {
        (0, 0): None, (0, 1): "invalid_event", (0, 2): "invalid_event", (0, 3): None if dedupe == "none" else "duplicate", (1, 0): "malformed_page", (3, 0): None}
    assert json.loads(rows[0, 1].raw_value) == {"type": "no id"} and rows[0, 2].raw_value == "5" and rows[1, 0].raw_value == "{broken"
    for r in rows.values():
        assert (r.value is None) == (r.reason is not None) == (r.raw_value is not None)
    if dedupe != "none":
        assert json.loads(rows[0, 3].raw_value)["id"] == "1"


def test_the_order_is_required_and_must_tell_events_apart(spark):
    pages = pages_df(spark, page(1, 2), page(2, 3))
    for dedupe in ("first", "fifo"):
        with pytest.raises(ValueError, match="arrival order"):
            ingest_events(pages, FERRY, dedupe=dedupe)
    with pytest.raises(Exception, match="same arrival order"):
        ingest_events(pages, FERRY, dedupe="fifo", order=["page_pos"]).collect()
    with pytest.raises(ValueError, match="unknown dedupe"):
        ingest_events(pages, FERRY, dedupe="last")
