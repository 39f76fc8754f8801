"""F1 iso_to_millis and F2 to_millis: hand-picked borders, expectations from ``datetime`` itself (the
generated strings are in test_iso_property)."""

import datetime as dt
import json

import pytest

from eventloom.functions.time import iso_to_millis_sql, to_millis_sql, to_millis_string_sql

EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def millis(text):
    t = dt.datetime.fromisoformat(text)
    t = t if t.tzinfo else t.replace(tzinfo=dt.timezone.utc)
    us = (t - EPOCH) // dt.timedelta(microseconds=1)
    return us // 1000 if us >= 0 else -(-us // 1000)


READ = [
    "1970-01-01", "1970-01-01T00", "1970-01-01T00:00Z", "1969-12-31T23:59:59.999", "1999-12-31T23:59:59,75+05:45", "2000-02-29 12:00", "20000229T1200Z",
    "2038-01-19T03:14:08Z", "2031-03-04T05:06:07.000999Z", "2031-03-04T05:06:07.9999999Z", "2031-03-04T05:06:07-0930", "2031-03-04T00:00:00+14", "0001-01-01", "9999-12-31T23:59:59.999999",
]
REFUSED = ["never", "1900-02-29", "2031-00-10", "2031-01-32", "2031-01-01T24:00", "2031-01-01T10:60", "2031-01-01T10:10:61", "\t2031-01-01", "31-01-01", "2031", "2031-W10-2"]


def evaluate(spark, checked, rows, schema):
    df = spark.createDataFrame(list(enumerate(rows)) if not isinstance(rows[0], tuple) else rows, schema)
    return [(r.v, r.e) for r in df.selectExpr("i", f"{checked.value} AS v", f"{checked.error} AS e").orderBy("i").collect()]


def test_strings(spark):
    got = evaluate(spark, iso_to_millis_sql("parse_json(j)"), [json.dumps(s) for s in READ + REFUSED], "i int, j string")
    assert got == [(millis(s), False) for s in READ] + [(None, True) for _ in REFUSED]


def test_other_json_values(spark):
    rows = ['""', "null", "5", "0.5", "false", "[]", '{"t": 1}']
    assert evaluate(spark, iso_to_millis_sql("parse_json(j)"), rows, "i int, j string") == [(None, False)] * 2 + [(None, True)] * 5
    absent = iso_to_millis_sql("try_variant_get(parse_json(j), '$.gone', 'variant')")
    assert evaluate(spark, absent, ["{}"], "i int, j string") == [(None, False)]


@pytest.mark.parametrize("text,value", [
    ("null", 0), ("0", 0), ("2000000000", 2_000_000_000_000), ("300000000000", 300_000_000_000), ("1.25", 1250), ("false", 0), ('"2000-02-29T00:00:00+01:00"', millis("2000-02-29T00:00:00+01:00")),
    ("{}", None), ('"someday"', None),
])
def test_seconds_millis_or_text(spark, text, value):
    assert evaluate(spark, to_millis_sql("parse_json(j)"), [text], "i int, j string") == [(value, value is None)]


def test_text_column(spark):
    rows = [(0, None), (1, "1999-12-31T23:59:59Z")]
    assert evaluate(spark, to_millis_string_sql("s"), rows, "i int, s string") == [(0, False), (millis("1999-12-31T23:59:59Z"), False)]
