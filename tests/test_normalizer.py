"""Envelope checks, coercion, outputs and plans of the normalizer."""

import json
import re

import pytest
from event_helpers import POLLED, POLLED_MS, by_rid, envelope, values_df
from pyspark.sql import functions as F
from test_language import BASE, HEAD

from eventloom.operators.normalize import normalize, quarantine
from eventloom.operators.raw import envelope_variant
from eventloom.plans.contract import Contract, builtin_contracts
from eventloom.session import configure

PLAIN = Contract.from_yaml(HEAD + "common:\n  deck: {from: deck}\nevent_types:\n  Docked:\n    moored: {from: moored, as: timestamp}\n")


def outcomes(spark, values, contracts=None):
    out = normalize(values_df(spark, values), contracts or {"ferry": PLAIN}, keep=["rid"], with_reason=True)
    return [r["reason"] for r in by_rid(out)]


def test_which_envelopes_are_read(spark):
    fine = [envelope(BASE), envelope(BASE, extra=[1]), envelope(BASE, schema_version=" 1_0.0 "), envelope(BASE, schema_version=2.0), envelope(BASE, schema_version=False)]
    gaps = [json.dumps({k: v for k, v in json.loads(fine[0]).items() if k != f}) for f in json.loads(fine[0])]
    wrong = [envelope("text"), envelope([BASE]), envelope(None), envelope(BASE, source_event_id=4), envelope(BASE, source_event_type=None),
             envelope(BASE, schema_version="1."), envelope(BASE, schema_version=0.5), envelope(BASE, schema_version="one")]
    broken = ["", "null", "[]", "{", envelope(BASE)[:-1], f"[{envelope(BASE)}]"]
    assert outcomes(spark, fine) == [None] * len(fine)
    assert set(outcomes(spark, gaps + wrong + broken)) == {"malformed"}


def test_normalized_envelope_checks(spark):
    vessel = BASE["vessel"]
    bad = [
        BASE | {"logged": "high tide"}, BASE | {"logged": 17}, BASE | {"logged": ""}, BASE | {"logged": None}, BASE | {"vessel": {"hull": 1}},
        BASE | {"vessel": vessel | {"call_sign": 5}}, BASE | {"vessel": vessel | {"call_sign": None}}, BASE | {"vessel": "LXQT"},
    ]
    assert outcomes(spark, [envelope(p) for p in bad]) == ["normalize_error"] * len(bad)
    moored = BASE | {"moored": "soon"}
    assert outcomes(spark, [envelope(moored, event_type="Docked"), envelope(moored), envelope(BASE, observed_at="dawn")]) == [
        "normalize_error", None, "normalize_error"]


@pytest.mark.parametrize("hull,text", [(True, "True"), (False, "False"), (None, "None"), (..., "None"), ("", ""), ("9", "9"), (10**15, str(10**15))])
def test_entity_id_text(spark, hull, text):
    vessel = {"call_sign": "LXQT"} | ({} if hull is ... else {"hull": hull})
    assert by_rid(normalize(values_df(spark, [envelope(BASE | {"vessel": vessel})]), {"ferry": PLAIN}, keep=["rid"]))[0]["entity_id"] == text


@pytest.mark.parametrize("change", ["common:\n  schema_version: {from: deck}", "common:\n  event_id: {from: deck}"])
def test_reserved_names_fail_their_rows(spark, change):
    c = Contract.from_yaml(HEAD + change + "\nevent_types: {}\n")
    assert outcomes(spark, [envelope(BASE)], {"ferry": c}) == ["normalize_error"]
    assert c.lint()


def test_missing_required_rule_fails_its_rows(spark):
    c = Contract.from_yaml(re.sub("  entity_name.*\n", "", HEAD) + "common: {}\nevent_types: {}\n")
    assert outcomes(spark, [envelope(BASE)], {"ferry": c}) == ["normalize_error"]


def test_json_document(spark):
    moments = [POLLED.isoformat(), "2031-03-04T05:06:07.089Z"]
    out = normalize(values_df(spark, [envelope(BASE | {"deck": 2}, event_type="Docked", observed_at=m) for m in moments]), {"ferry": PLAIN}, keep=["rid"], output="json")
    one, two = (json.loads(r["value"]) for r in by_rid(out))
    assert one == {"source": "ferry", "event_id": "1", "event_type": "Docked", "ingested_at": "2031-03-04T05:06:07Z", "schema_version": 1, "partition_key": "LXQT",
                   "entity_id": "8102", "entity_name": "LXQT", "event_time": POLLED_MS, "deck": 2, "moored": None}
    assert two["ingested_at"] == "2031-03-04T05:06:07.089000Z"


def test_quarantine_keeps_the_message(spark):
    values = [envelope(BASE), "{", envelope(BASE, source="kayak")]
    rows = by_rid(quarantine(values_df(spark, values), {"ferry": PLAIN}, keep=["rid"]))
    assert [(r["rid"], r["reason"], r["raw_value"]) for r in rows] == [(1, "malformed", "{"), (2, "unknown_source", values[2])]


def test_variant_and_struct_input(spark):
    text = values_df(spark, [envelope(BASE | {"deck": 1}), envelope(BASE, source="kayak")])
    want = [(r["reason"], r.get("attributes")) for r in by_rid(normalize(text, {"ferry": PLAIN}, keep=["rid"], with_reason=True))]
    variant = text.select("rid", F.parse_json("value").alias("value"))
    fields = "source string, source_event_id string, source_event_endpoint string, source_event_type string, observed_at string, schema_version int, payload string"
    struct = text.select("rid", F.from_json("value", fields).alias("e")).select("rid", "e.*").withColumn("payload", F.parse_json("payload")).select("rid", envelope_variant().alias("value"))
    for df in (variant, struct):
        assert [(r["reason"], r.get("attributes")) for r in by_rid(normalize(df, {"ferry": PLAIN}, keep=["rid"], with_reason=True))] == want


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_parses_once_and_runs_no_python(spark):
    plan = executed(normalize(values_df(spark, [envelope(BASE)]), {"ferry": PLAIN}, keep=["rid"]))
    assert plan.count("parseJson") == 1 and "Python" not in plan and "Exchange" not in plan


def github_plan(spark):
    """Lines of the executed plan of the widest contract, with all their columns."""
    configure(spark)
    before = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "2000")
    try:
        return executed(normalize(values_df(spark, [envelope(BASE, source="github")]), builtin_contracts(), keep=["rid"])).split("\n")
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", before)


def test_path_rules_of_the_widest_contract_are_in_generated_code(spark):
    """Only the stage of the lambda rules is interpreted, and it is not merged with its neighbours."""
    lines = [line for line in github_plan(spark) if "Project" in line]
    interpreted = [line for line in lines if not re.search(r"\*\(\d+\) Project", line)]
    assert len(interpreted) == 1 and "lambda" in interpreted[0]
    assert max(line.count("variant_get(payload") for line in lines if line not in interpreted) > 30


def test_timestamps_are_read_only_for_rows_whose_type_has_them(spark):
    reads = [line for line in github_plan(spark) if "submitted_at" in line and "variant_get" in line]
    assert reads
    for line in reads:
        for m in re.finditer("submitted_at", line):
            assert "CASE WHEN" in line[max(0, m.start() - 200) : m.start()]


def test_every_output_of_the_widest_contract_compiles(spark):
    before = spark.conf.get("spark.sql.codegen.fallback")
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        for output in ("columns", "json", "wide"):
            df = normalize(values_df(spark, [envelope(BASE, source="github")]), builtin_contracts(), keep=["rid"], output=output, with_reason=True)
            df.write.format("noop").mode("overwrite").save()  # every column is computed
    finally:
        spark.conf.set("spark.sql.codegen.fallback", before)


def test_methods_that_the_jvm_would_not_compile_are_split(spark):
    from eventloom.session import configure

    configure(spark)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000  # HotSpot's own limit
