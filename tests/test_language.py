"""The rule language (P1-P12): one table of rules, payloads and what each yields."""

import json
import re

import pytest
from event_helpers import POLLED, POLLED_MS, by_rid, envelope, values_df

from eventloom.functions.variant import pluck_sql
from eventloom.operators.normalize import normalize
from eventloom.plans.contract import Contract, ContractError

HEAD = """
source: ferry
partition_key: {from: vessel.call_sign}
envelope:
  entity_id: {from: vessel.hull}
  entity_name: {from: vessel.call_sign}
  event_time: {from: logged, as: timestamp}
"""
BASE = {"vessel": {"hull": 8102, "call_sign": "LXQT"}, "logged": POLLED.isoformat()}


def contract(body, source="ferry"):
    return Contract.from_yaml(HEAD.replace("ferry", source) + body)


def evaluate(spark, rules, payloads, event_type="Departed"):
    """YAML of common rules -> the attributes of every payload."""
    body = "common:\n" + "\n".join(f"  {r}" for r in rules) + "\nevent_types: {}\n"
    values = [envelope(BASE | p, event_type=event_type) for p in payloads]
    return [r["attributes"] for r in by_rid(normalize(values_df(spark, values), {"ferry": contract(body)}, keep=["rid"]))]


CARGO = [{"kind": "car", "owner": {"town": "Oban"}}, {"kind": None}, {"weight": 3}, [{"kind": "van"}, [{"kind": "deep"}]], "loose", 7]

TABLE = [
    # rule, payloads -> values
    ("{from: route.legs.first}", [{"route": {"legs": {"first": ["a", {"b": 1}]}}}, {"route": {"legs": 4}}, {"route": [{"legs": {}}]}, {}], [["a", {"b": 1}], None, None, None]),
    ("{from: cargo, take: kind}", [{"cargo": CARGO}, {"cargo": []}, {"cargo": {"kind": "x"}}, {"cargo": "x"}, {}], [["car", "van"], [], None, None, None]),
    ("{from: cargo, take: owner.town}", [{"cargo": CARGO}], [["Oban"]]),
    ("{from: ice, as: boolean}", [{"ice": v} for v in (False, 0, "", [], {}, None)] + [{}], [True] * 5 + [False] * 2),
    ("{from: due, as: timestamp}", [{"due": "2031-03-04T07:06:07.25+02:00"}, {"due": ""}, {"due": None}, {}], [POLLED_MS + 250, None, None, None]),
    ("{from: note, default: calm}", [{"note": v} for v in (None, False, "", [], {}, 0, "fog")] + [{}], ["calm"] * 5 + [0, "fog", "calm"]),
    ("{from: note, default: null}", [{"note": False}, {}], [False, None]),
    ("{from: note, default: {sea: [1, {up: true}]}}", [{}], [{"sea": [1, {"up": True}]}]),
    ("{from: cargo, take: kind, default: [empty]}", [{"cargo": []}, {"cargo": CARGO}], [["empty"], ["car", "van"]]),
    ("{from: ice, as: boolean, default: open}", [{}, {"ice": 1}], ["open", True]),
    ("{from: cargo, take: kind, as: timestamp}", [{"cargo": [{"kind": "noon"}]}], [["noon"]]),
    ('{expression: "try_variant_get(payload, \'$.speed\', \'double\') / 2D", take: kind, as: boolean, default: 1}', [{"speed": 9}], None),
    ('{expression: "0", default: 5}', [{}], [0]),
    ('{expression: "size(try_cast(payload:cargo AS ARRAY<VARIANT>))"}', [{"cargo": CARGO}, {}], [6, None]),
]


@pytest.mark.parametrize("rule,payloads,expected", [t for t in TABLE if t[2] is not None], ids=lambda x: x if isinstance(x, str) else "")
def test_rule(spark, rule, payloads, expected):
    assert [a["x"] for a in evaluate(spark, [f"x: {rule}"], payloads)] == expected


def test_expressions_that_can_throw_are_refused(spark):
    """They would end the whole job on one bad row."""
    for bad, hint in [
        ("CAST(payload:speed AS INT)", "try_cast"), ("payload:speed::int", "try_cast"), ("variant_get(payload, '$.speed', 'int')", "try_variant_get"),
        ("1 / try_cast(payload:speed AS INT)", "try_divide"), ("try_cast(payload:speed AS BIGINT) + 1", "try_add"),
        ("split(try_cast(payload:tags AS STRING), ',')[2]", "get"), ("element_at(array(1, 2), try_cast(payload:n AS INT))", "try_element_at"),
        ("transform(try_cast(payload:cargo AS ARRAY<VARIANT>), x -> CAST(x AS INT))", "try_cast"),
    ]:
        with pytest.raises(ContractError, match=hint):
            evaluate(spark, [f'x: {{expression: "{bad}"}}'], [{}])


def test_failing_expressions_cost_their_own_row(spark):
    body = """
common: {}
event_types:
  Fuelled:
    litres: {expression: "try_multiply(try_cast(payload:litres AS BIGINT), 2L)"}
    grade: {expression: "CASE WHEN payload:grade IS NOT NULL THEN try_cast(payload:grade AS INT) END"}
    codes: {expression: "transform(try_cast(payload:codes AS ARRAY<VARIANT>), x -> try_cast(x AS INT))"}
"""
    rows = [({"litres": 4}, "Fuelled"), ({"litres": "much"}, "Fuelled"), ({}, "Fuelled"), ({"litres": None}, "Fuelled"), ({"litres": "much"}, "Departed"),
            ({"grade": "high"}, "Fuelled"), ({"codes": [1, "x"]}, "Fuelled"), ({"codes": 5}, "Fuelled")]
    values = [envelope(BASE | p, event_type=t) for p, t in rows]
    out = by_rid(normalize(values_df(spark, values), {"ferry": contract(body)}, keep=["rid"], with_reason=True))
    assert [r["reason"] for r in out] == [None, "normalize_error", None, None, None, None, None, "normalize_error"]
    assert [out[i]["attributes"].get("litres") for i in (0, 2, 3)] == [8, None, None]
    assert out[5]["attributes"]["grade"] is None and out[6]["attributes"]["codes"] == [1, None]


def test_sections_types_and_sources(spark):
    ferry = contract("""
common:
  port: {from: port}
  berth: {from: berth}
event_types:
  Docked:
    berth: {from: slip.number}
    crew: {from: crew, take: name}
""")
    plane = contract("""
common:
  gate: {from: berth}
event_types: {}
""", "plane")
    p = BASE | {"port": "Mallaig", "berth": 1, "slip": {"number": 9}, "crew": [{"name": "Io"}]}
    values = [envelope(p, event_type="Docked"), envelope(p, event_type="Adrift"), envelope(p, source="plane"), envelope(p, source="train")]
    out = by_rid(normalize(values_df(spark, values), {"ferry": ferry, "plane": plane}, keep=["rid"], with_reason=True))
    assert [r["attributes"] for r in out[:3]] == [{"port": "Mallaig", "berth": 9, "crew": ["Io"]}, {"port": "Mallaig", "berth": 1}, {"gate": 1}]
    assert [r["reason"] for r in out] == [None, None, None, "unknown_source"]


def test_wide_table(spark):
    c = contract("common:\n  knots: {from: knots}\nevent_types:\n  Docked:\n    slip: {from: slip}\ncolumn_types: {knots: double}\n")
    values = [envelope(BASE | {"knots": 3, "slip": 2}, event_type="Docked"), envelope(BASE | {"knots": "fast", "slip": 2})]
    out = normalize(values_df(spark, values), {"ferry": c}, keep=["rid"], output="wide", type_hints={"slip": "int"})
    assert dict(out.dtypes)["knots"] == "double"
    assert [(r["knots"], r["slip"]) for r in by_rid(out)] == [(3.0, 2), (None, None)]


def test_take_of_odd_arrays(spark):
    """An array of objects is read as structs of one field; any other goes the general way, with the same results."""
    docs = {
        '{"l": [{"a": 1}, {"a": "x", "b": 2}, {"b": 1}, {"a": null}, {"a": [1]}, {}]}': [1, "x", [1]],
        '{"l": [1, {"a": 2}, [{"a": 3}, [{"a": 9}], 4], null]}': [2, 3],
        '{"l": []}': [], '{"l": [null]}': [], '{"l": null}': None, "{}": None, '{"l": {"a": 1}}': None, '{"l": "x"}': None,
        '{"l": [{"A": 5}, {"a": {"C": 1}}]}': [{"C": 1}],
    }
    sql = pluck_sql("p", ["a"], ["l"])
    assert sql.count("array<struct<`a`: variant>>") == 1  # read once, without a copy of each element
    found = spark.createDataFrame([(d,) for d in docs], "d string").selectExpr("d", "parse_json(d) AS p").selectExpr("d", f"to_json(to_variant_object({sql})) AS x")
    assert {r["d"]: r["x"] and json.loads(r["x"]) for r in found.collect()} == docs


def test_rules_that_fail_alike_share_one_error(spark):
    read = "try_cast(payload:stops AS ARRAY<VARIANT>)"
    rules = contract(f"""
common:
  n: {{expression: "size({read})"}}
  last: {{expression: "array_max(transform({read}, x -> try_variant_get(x, '$', 'int')))"}}
event_types: {{}}
""")
    out = normalize(values_df(spark, ["{}"]), {"ferry": rules}, with_reason=True)
    names = set(re.findall(r"AS (_he\d+)#", out._jdf.queryExecution().analyzed().toString()))
    assert len(names) == 1
