"""Rows of the tests' own domain: crossings of ferries, reported by harbours.

A module with a name of its own: ``conftest`` names whichever folder's conftest was imported last.
"""

import datetime as dt
import json

POLLED = dt.datetime(2031, 3, 4, 5, 6, 7, tzinfo=dt.timezone.utc)
POLLED_MS = int(POLLED.timestamp() * 1000)


def envelope(payload, *, source="ferry", event_id="1", event_type="Departed", endpoint="default", observed_at=POLLED.isoformat(), **over):
    """A raw envelope as JSON text; ``over`` replaces or adds fields."""
    doc = {"source": source, "source_event_id": event_id, "source_event_endpoint": endpoint, "source_event_type": event_type,
           "observed_at": observed_at, "schema_version": 1, "payload": payload} | over
    return json.dumps(doc)


def values_df(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "rid long, value string")


def by_rid(df):
    """Rows as dictionaries in the order of their ``rid``, ``attributes`` parsed."""
    rows = sorted((r.asDict() for r in df.collect()), key=lambda r: r["rid"])
    return [r | {"attributes": json.loads(r["attributes"])} if r.get("attributes") else r for r in rows]
