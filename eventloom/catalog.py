"""Registered queries: every operator run over whole driver tables.

Each entry is ``name -> (spark_fn(spark, sf_dir) -> DataFrame, oracle_sql | None)``.
The tables hold no raw envelopes, so a query first derives API events (or raw
envelope JSON) from a table, runs the operator on all of it, and returns flat
scalar columns. The oracle states the expected rows directly over the source
columns in SQL that DuckDB runs on the same parquet files. Where a query
injects bad rows, it does so by a rule on the key (e.g. ``event_id % 7``) so
that the oracle can state the expected reason for *every* row; nothing is
filtered away to make a check cheaper.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.time import with_to_millis
from eventloom.functions.variant import select_keys_sql
from eventloom.operators.dedupe import dedupe_fifo, dedupe_first, dedupe_within_horizon, mark_horizon
from eventloom.operators.ingest import ingest_events
from eventloom.operators.normalize import normalize
from eventloom.operators.raw import build_raw_events, explode_pages
from eventloom.plans.contract import Contract, builtin_contracts
from eventloom.session import configure
from eventloom.sources.registry import SourceConfig, get_source_config
from eventloom.sources.tables import GITHUB_TYPES, github_events, iso_z, order_events, read_table, shop_event_json

QueryFn = Callable[[SparkSession, str], DataFrame]

# Fixed observation time injected into raw envelopes so results are reproducible.
OBSERVED_AT = "2031-03-04T05:06:07+00:00"
OBSERVED_AT_MS = 1930367167000

SHOP = SourceConfig(source="shop")
PAGE_ROWS = 100_000  # rows of API events that one task groups into pages

_ENVELOPE_RULES = """
partition_key: {from: actor.login}
envelope:
  entity_id: {from: actor.id}
  entity_name: {from: actor.login}
  event_time: {from: created_at, as: timestamp}
"""


def _contract(body: str, source: str = "shop") -> dict[str, Contract]:
    return {source: Contract.from_yaml(f"source: {source}\n{_ENVELOPE_RULES}\n{body}")}


def _shop_raw(spark: SparkSession, sf: str, event_sql: str | None = None, keep=("event_id", "seq")) -> DataFrame:
    """events -> raw envelope rows (with ``value`` JSON) for the shop source."""
    ev = read_table(spark, sf, "events")
    api = ev.selectExpr("event_id", "event_id * 10 AS seq", f"{event_sql or shop_event_json()} AS event")
    return build_raw_events(api, SHOP, observed_at=OBSERVED_AT, keep=list(keep), encode=True)


def _shop_normalized(spark: SparkSession, sf: str, contracts=None, event_sql=None, **kw) -> DataFrame:
    """events -> raw envelope JSON -> normalized; the table key rides along as ``rid``."""
    raw = _shop_raw(spark, sf, event_sql).withColumnRenamed("event_id", "rid")
    return normalize(raw, contracts or {"shop": builtin_contracts()["shop"]}, keep=["rid"], **kw)


REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def query(name: str, oracle: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        run.__name__ = name
        REGISTRY[name] = (run, oracle)
        return run

    return deco


# ---------------------------------------------------------------------------
# pages
# ---------------------------------------------------------------------------

@query("page_explode", """
SELECT conv_id, turn, role, CAST(length(text) AS INTEGER) AS text_len,
       CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS page_pos
FROM conversations
""")
def page_explode(spark, sf):
    conv = read_table(spark, sf, "conversations")
    pages = conv.groupBy("conv_id").agg(
        F.to_json(F.sort_array(F.collect_list(F.struct("turn", "role", "text")))).alias("value")
    )
    items = explode_pages(pages, keep=["conv_id"])
    return items.selectExpr(
        "conv_id",
        "try_variant_get(event, '$.turn', 'bigint') AS turn",
        "try_variant_get(event, '$.role', 'string') AS role",
        "length(try_variant_get(event, '$.text', 'string')) AS text_len",
        "page_pos",
    )


# ---------------------------------------------------------------------------
# Raw envelope
# ---------------------------------------------------------------------------

@query("raw_envelope", f"""
SELECT event_id, 'shop' AS source, CAST(event_id AS VARCHAR) AS source_event_id,
       'default' AS source_event_endpoint, event_type AS source_event_type,
       '{OBSERVED_AT}' AS observed_at, CAST(1 AS INTEGER) AS schema_version,
       user_id AS payload_actor_id, 'STRING' AS payload_id_type, value AS payload_value
FROM events
""")
def raw_envelope(spark, sf):
    raw = _shop_raw(spark, sf)
    return raw.selectExpr(
        "event_id", "source", "source_event_id", "source_event_endpoint", "source_event_type",
        "observed_at", "schema_version",
        "try_variant_get(payload, '$.actor.id', 'bigint') AS payload_actor_id",
        "schema_of_variant(payload:id) AS payload_id_type",
        "try_variant_get(payload, '$.value', 'double') AS payload_value",
    )


_INVALID = "(event_id % 17 = 0 OR event_id % 7 = 0 OR event_id % 11 = 0)"


@query("raw_invalid_rows", f"""
SELECT event_id,
       CASE WHEN {_INVALID} THEN 'invalid_event' END AS reason,
       CASE WHEN {_INVALID} THEN NULL WHEN event_id % 13 = 0 THEN 'None'
            ELSE CAST(event_id AS VARCHAR) END AS source_event_id,
       CASE WHEN {_INVALID} THEN NULL ELSE event_type END AS source_event_type
FROM events
""")
def raw_invalid_rows(spark, sf):
    ev = read_table(spark, sf, "events")
    event = (
        f"CASE WHEN event_id % 17 = 0 THEN to_json(array(event_id)) "
        f"WHEN event_id % 7 = 0 THEN {shop_event_json(drop=('id',))} "
        f"WHEN event_id % 11 = 0 THEN {shop_event_json(drop=('type',))} "
        f"WHEN event_id % 13 = 0 THEN {shop_event_json({'id': 'CAST(NULL AS VARIANT)'})} "
        f"ELSE {shop_event_json()} END"
    )
    api = ev.selectExpr("event_id", f"{event} AS event")
    raw = build_raw_events(api, SHOP, observed_at=OBSERVED_AT, keep=["event_id"], with_reason=True)
    return raw.select("event_id", "reason", "source_event_id", "source_event_type")


@query("raw_payload_overlay", """
SELECT event_id, CAST(event_id AS VARCHAR) AS payload_id, 'STRING' AS payload_id_type,
       event_type AS payload_type, event_type AS payload_object_kind, user_id AS payload_user_id,
       CAST(4 AS INTEGER) AS payload_keys
FROM events
""")
def raw_payload_overlay(spark, sf):
    ev = read_table(spark, sf, "events")
    base = "'id', event_id, 'object_kind', event_type, 'user_id', user_id"
    event = (
        f"CASE WHEN event_id % 5 = 0 THEN to_json(named_struct({base}, 'type', 'legacy')) "
        f"ELSE to_json(named_struct({base})) END"
    )
    api = ev.selectExpr("event_id", f"{event} AS event")
    raw = build_raw_events(api, get_source_config("gitlab"), observed_at=OBSERVED_AT, keep=["event_id"])
    return raw.selectExpr(
        "event_id",
        "try_variant_get(payload, '$.id', 'string') AS payload_id",
        "schema_of_variant(payload:id) AS payload_id_type",
        "try_variant_get(payload, '$.type', 'string') AS payload_type",
        "try_variant_get(payload, '$.object_kind', 'string') AS payload_object_kind",
        "try_variant_get(payload, '$.user_id', 'bigint') AS payload_user_id",
        "size(try_cast(payload AS MAP<STRING, VARIANT>)) AS payload_keys",
    )


# ---------------------------------------------------------------------------
# De-duplication
# ---------------------------------------------------------------------------

def _with_resends(spark, sf, resend_where: str, resend_seq: str) -> DataFrame:
    """Originals (seq = 10*id) plus re-sends of some ids (value + 1000, own seq)."""
    ev = read_table(spark, sf, "events")
    orig = ev.selectExpr("event_id", "event_id * 10 AS seq", f"{shop_event_json()} AS event")
    dup = ev.where(resend_where).selectExpr(
        "event_id", f"{resend_seq} AS seq", f"{shop_event_json({'value': 'value + 1000'})} AS event"
    )
    api = orig.unionByName(dup)
    return build_raw_events(api, SHOP, observed_at=OBSERVED_AT, keep=["event_id", "seq"])


def _value_out(df: DataFrame) -> DataFrame:
    return df.selectExpr("event_id", "source_event_id", "seq", "try_variant_get(payload, '$.value', 'double') AS value")


@query("dedupe_first", """
SELECT event_id, CAST(event_id AS VARCHAR) AS source_event_id,
       CASE WHEN event_id % 6 = 0 THEN event_id * 10 - 5 ELSE event_id * 10 END AS seq,
       CASE WHEN event_id % 6 = 0 THEN value + 1000 ELSE value END AS value
FROM events
""")
def dedupe_first_q(spark, sf):
    raw = _with_resends(spark, sf, "event_id % 3 = 0",
                        "CASE WHEN event_id % 6 = 0 THEN event_id * 10 - 5 ELSE event_id * 10 + 5 END")
    return _value_out(dedupe_first(raw, order=["seq"]))


@query("dedupe_fifo_near", """
SELECT event_id, CAST(event_id AS VARCHAR) AS source_event_id, event_id * 10 AS seq, value
FROM events
""")
def dedupe_fifo_near(spark, sf):
    raw = _with_resends(spark, sf, "event_id % 3 = 0", "event_id * 10 + 5")
    return _value_out(dedupe_fifo(raw, max_size=120, order=["seq"]))


@query("dedupe_fifo_far", """
SELECT event_id, CAST(event_id AS VARCHAR) AS source_event_id, event_id * 10 AS seq, value FROM events
UNION ALL
SELECT event_id, CAST(event_id AS VARCHAR) AS source_event_id, 1000000000000 + event_id AS seq, value + 1000 AS value
FROM events WHERE event_id % 3 = 1
""")
def dedupe_fifo_far(spark, sf):
    # re-sends arrive after every original: far more than 120 accepted ids later
    raw = _with_resends(spark, sf, "event_id % 3 = 1", "1000000000000 + event_id")
    return _value_out(dedupe_fifo(raw, max_size=120, order=["seq"]))


@query("dedupe_watermark", """
SELECT DISTINCT 'shop' AS source, 'default' AS source_event_endpoint, CAST(event_id AS VARCHAR) AS source_event_id
FROM events
""")
def dedupe_watermark(spark, sf):
    ev = read_table(spark, sf, "events")
    obs = "concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '+00:00')"
    obs_late = "concat(date_format(ts + INTERVAL 1 MINUTE, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '+00:00')"
    orig = ev.selectExpr(f"{shop_event_json()} AS event", f"{obs} AS obs")
    dup = ev.where("event_id % 3 = 0").selectExpr(f"{shop_event_json()} AS event", f"{obs_late} AS obs")
    api = orig.unionByName(dup)
    raw = build_raw_events(api, SHOP, observed_at=F.col("obs"), keep=["obs"])
    return dedupe_within_horizon(raw, "10 minutes").select("source", "source_event_endpoint", "source_event_id")


@query("dedupe_first_null_order", """
SELECT event_id, CAST(event_id AS VARCHAR) AS source_event_id,
       CASE WHEN event_id % 3 = 0 THEN event_id * 10 + 5 WHEN event_id % 5 = 0 THEN NULL ELSE event_id * 10 END AS seq,
       CASE WHEN event_id % 3 = 0 THEN value + 1000 ELSE value END AS value
FROM events
""")
def dedupe_first_null_order(spark, sf):
    """An unknown arrival sorts behind every known one, and its row keeps its columns."""
    raw = _with_resends(spark, sf, "event_id % 3 = 0", "event_id * 10 + 5")
    unknown = "CASE WHEN (event_id % 5 = 0 OR event_id % 3 = 0) AND seq % 10 = 0 THEN NULL ELSE seq END"
    return _value_out(dedupe_first(raw.withColumn("seq", F.expr(unknown)), order=["seq"]))


@query("dedupe_fifo_overlap", """
SELECT event_id, CAST(event_id AS VARCHAR) AS source_event_id, event_id // 30 * 90 AS seq, value FROM events
""")
def dedupe_fifo_overlap(spark, sf):
    """Overlapping polls: every id comes in three consecutive polls of 90 events; its first sighting stays."""
    ev = read_table(spark, sf, "events")
    polls = ev.selectExpr("event_id", f"{shop_event_json()} AS event", "explode(array(0, 1, 2)) AS again").selectExpr(
        "event_id", "event", "(event_id DIV 30 + again) * 90 AS seq", "event_id AS place")
    raw = build_raw_events(polls, SHOP, observed_at=OBSERVED_AT, keep=["event_id", "seq", "place"])
    return _value_out(dedupe_fifo(raw, max_size=120, order=["seq", "place"], chunk_rows=20_000))


@query("dedupe_horizon_far", """
SELECT event_id, CAST(event_id AS VARCHAR) AS source_event_id, event_id * 10 + s AS seq, value + v AS value
FROM events, (VALUES (0, 0), (2, 2000)) AS r(s, v) WHERE s = 0 OR event_id % 3 = 1
""")
def dedupe_horizon_far(spark, sf):
    """Re-sends 4 minutes later (dropped) and, of some ids, 11 minutes later (accepted again, horizon 10
    minutes) and 20 minutes later (9 after the last accepted: dropped)."""
    ev = read_table(spark, sf, "events")
    sends = ev.selectExpr("*", "explode(CASE WHEN event_id % 3 = 1 THEN array(0, 1, 2, 3) ELSE array(0, 1) END) AS again")
    sends = sends.selectExpr("*", "ts + make_dt_interval(0, 0, element_at(array(0, 4, 11, 20), again + 1), 0) AS seen")
    api = sends.selectExpr(
        "event_id", "event_id * 10 + again AS seq", f"{shop_event_json({'value': 'value + 1000 * again'})} AS event",
        "concat(date_format(seen, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '+00:00') AS obs")
    raw = build_raw_events(api, SHOP, observed_at=F.col("obs"), keep=["event_id", "seq", "obs"])
    return _value_out(dedupe_within_horizon(raw, "10 minutes", order=["seq"]))


@query("dedupe_horizon_dense", """
WITH RECURSIVE t AS (
  SELECT ts, min(event_id) AS event_id FROM events GROUP BY ts
), n AS (
  SELECT a.ts, a.event_id, (SELECT min(b.ts) FROM t b WHERE b.ts >= a.ts + INTERVAL 2 HOUR) AS following FROM t a
), walk AS (
  SELECT ts, event_id, following FROM n WHERE ts = (SELECT min(ts) FROM t)
  UNION ALL SELECT n.ts, n.event_id, n.following FROM n JOIN walk ON n.ts = walk.following
)
SELECT event_id, NOT EXISTS (SELECT 1 FROM walk WHERE walk.event_id = e.event_id) AS is_duplicate FROM events e
""")
def dedupe_horizon_dense(spark, sf):
    """All events are sends of one id that never pauses for two hours: one key over many small chunks."""
    ev = read_table(spark, sf, "events")
    rows = ev.selectExpr("event_id", "'shop' AS source", "'default' AS source_event_endpoint", "'1' AS source_event_id", "CAST(ts AS TIMESTAMP) AS observed_ts")
    return mark_horizon(rows, "2 hours", order=["event_id"], chunk_rows=200).select("event_id", "is_duplicate")


def _overlapping_pages(spark, sf) -> DataFrame:
    """``events`` as API pages of 20 that overlap by 10, newest page last; every seventh page is no JSON,
    and every page holds one event without an id."""
    ev = read_table(spark, sf, "events")
    rows = ev.selectExpr("event_id", f"{shop_event_json()} AS event", "explode(array(event_id DIV 10, event_id DIV 10 + 1)) AS page_no")
    # a task groups about so many rows, however many there are
    rows = rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-2 * ev.count() // PAGE_ROWS)), "page_no")
    pages = rows.groupBy("page_no").agg(F.expr(
        "concat('[', array_join(transform(sort_array(collect_list(struct(event_id, event))), x -> x.event), ','), ',{\"type\": \"click\"}]')"
    ).alias("value"))
    return pages.withColumn("value", F.expr("CASE WHEN page_no % 7 = 3 THEN substring(value, 2) ELSE value END"))


@query("ingest_pages_fifo", """
SELECT event_id, CAST(event_id AS VARCHAR) AS source_event_id,
       CAST(CASE WHEN event_id // 10 % 7 = 3 THEN event_id // 10 + 1 ELSE event_id // 10 END AS BIGINT) AS page_no, value
FROM events
""")
def ingest_pages_fifo(spark, sf):
    """Pages that overlap, in arrival order, with the defaults of the ingest: every first sighting stays."""
    out = ingest_events(_overlapping_pages(spark, sf), SHOP, dedupe="fifo", order=["page_no", "page_pos"], observed_at=OBSERVED_AT)
    return out.where("reason IS NULL").selectExpr(
        "CAST(source_event_id AS BIGINT) AS event_id", "source_event_id", "CAST(arrival_1 AS BIGINT) AS page_no",
        "CAST(get_json_object(value, '$.payload.value') AS DOUBLE) AS value")


@query("ingest_quarantine", """
WITH p AS (
  SELECT event_id, page_no FROM (SELECT event_id, event_id // 10 AS page_no FROM events UNION ALL SELECT event_id, event_id // 10 + 1 FROM events)
), good AS (SELECT * FROM p WHERE page_no % 7 <> 3)
SELECT 'ok' AS reason, count(DISTINCT event_id) AS n FROM good
UNION ALL SELECT 'duplicate', count(*) - count(DISTINCT event_id) FROM good
UNION ALL SELECT 'invalid_event', count(DISTINCT page_no) FROM good
UNION ALL SELECT 'malformed_page', count(DISTINCT page_no) FROM p WHERE page_no % 7 = 3
""")
def ingest_quarantine(spark, sf):
    """Every rejected page and event, and every duplicate, with its reason and text."""
    out = ingest_events(_overlapping_pages(spark, sf), SHOP, dedupe="fifo", order=["page_no", "page_pos"], observed_at=OBSERVED_AT)
    bare = F.col("reason").isNotNull() & F.col("raw_value").isNull()
    return out.select(F.when(bare, F.lit("no text")).otherwise(F.coalesce("reason", F.lit("ok"))).alias("reason")).groupBy(
        "reason").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------------------
# Parse, routing, row errors
# ---------------------------------------------------------------------------

_MALFORMED = ("(event_id % 17 = 0 OR event_id % 19 = 0 OR event_id % 23 = 0 "
              "OR event_id % 31 = 0 OR event_id % 37 = 0)")


@query("raw_parse_filter", f"""
SELECT event_id, CASE WHEN {_MALFORMED} THEN 'malformed' END AS reason,
       CASE WHEN {_MALFORMED} THEN NULL ELSE CAST(event_id AS VARCHAR) END AS out_event_id
FROM events
""")
def raw_parse_filter(spark, sf):
    raw = _shop_raw(spark, sf).selectExpr("*", "to_json(payload) AS pj")

    def env(**over):
        f = {
            "source": "source", "source_event_id": "source_event_id",
            "source_event_endpoint": "source_event_endpoint", "source_event_type": "source_event_type",
            "observed_at": "observed_at", "schema_version": "schema_version", "payload": "payload",
        }
        f.update(over)
        f = {k: v for k, v in f.items() if v is not None}
        return "to_json(named_struct(" + ", ".join(f"'{k}', {v}" for k, v in f.items()) + "))"

    value = (
        "CASE WHEN event_id % 17 = 0 THEN substring(value, 1, length(value) - 1) "
        f"WHEN event_id % 19 = 0 THEN {env(payload='pj')} "
        f"WHEN event_id % 23 = 0 THEN {env(source_event_endpoint=None)} "
        f"WHEN event_id % 31 = 0 THEN {env(schema_version='1.5D')} "
        f"WHEN event_id % 37 = 0 THEN {env(source_event_id='event_id')} "
        f"WHEN event_id % 29 = 0 THEN {env(schema_version=chr(39) + '1' + chr(39))} "
        "ELSE value END"
    )
    corrupted = raw.selectExpr("event_id AS rid", f"{value} AS value")
    out = normalize(corrupted, {"shop": builtin_contracts()["shop"]}, keep=["rid"], with_reason=True)
    return out.selectExpr("rid AS event_id", "reason", "CASE WHEN reason IS NULL THEN event_id END AS out_event_id")


@query("unknown_source_filter", """
SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'unknown_source' END AS reason,
       CASE WHEN event_id % 4 = 0 THEN 'gitlab' ELSE 'shop' END AS raw_source
FROM events
""")
def unknown_source_filter(spark, sf):
    raw = _shop_raw(spark, sf)
    value = ("CASE WHEN event_id % 4 = 0 THEN to_json(named_struct('source', 'gitlab', "
             "'source_event_id', source_event_id, 'source_event_endpoint', source_event_endpoint, "
             "'source_event_type', source_event_type, 'observed_at', observed_at, "
             "'schema_version', schema_version, 'payload', payload)) ELSE value END")
    src = raw.selectExpr("event_id AS rid", f"{value} AS value")
    out = normalize(src, {"shop": builtin_contracts()["shop"]}, keep=["rid"], with_reason=True)
    return out.selectExpr("rid AS event_id", "reason",
                          "coalesce(source, get_json_object(raw_value, '$.source')) AS raw_source")


# ---------------------------------------------------------------------------
# The rule language
# ---------------------------------------------------------------------------

@query("rule_path", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_id * 2 AS deep,
       CAST(NULL AS VARCHAR) AS missing, CAST(NULL AS VARCHAR) AS through_scalar,
       CAST(NULL AS VARCHAR) AS through_array
FROM events
""")
def rule_path(spark, sf):
    contracts = _contract("""
common:
  k: {from: props.k}
  deep: {from: meta.a.b.c}
  missing: {from: props.nope.x}
  through_scalar: {from: props.k.x}
  through_array: {from: meta.list.a}
event_types: {}
""")
    event = shop_event_json({"meta": "named_struct('a', named_struct('b', named_struct('c', event_id * 2)), "
                                     "'list', array(named_struct('a', 1)))"})
    out = _shop_normalized(spark, sf, contracts, event, output="wide",
                           type_hints={"k": "bigint", "deep": "bigint", "missing": "string",
                                       "through_scalar": "string", "through_array": "string"})
    return out.selectExpr("rid AS event_id", "k", "deep", "missing", "through_scalar", "through_array")


_ORDER_LINES = """
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_orderkey
"""


def _orders_normalized(spark, sf, common: str, hints: dict[str, str]) -> DataFrame:
    contracts = _contract(common + "\nevent_types: {}\n", source="orders")
    ev = order_events(spark, sf)
    raw = build_raw_events(ev, SourceConfig(source="orders"), observed_at=OBSERVED_AT,
                           keep=["o_orderkey"], encode=True)
    return normalize(raw, contracts, keep=["o_orderkey"], output="wide", type_hints=hints)


@query("rule_take", f"""
SELECT o.o_orderkey,
       COALESCE(string_agg(CAST(l.l_partkey AS VARCHAR), ','
                           ORDER BY l.l_linenumber, l.l_partkey, l.l_quantity), '') AS parts,
       CAST(COUNT(l.l_partkey) AS INTEGER) AS n_parts
{_ORDER_LINES}
""")
def rule_take(spark, sf):
    out = _orders_normalized(spark, sf, """
common:
  parts: {from: lines, take: l_partkey}
""", {})
    out = out.selectExpr("o_orderkey", "try_cast(parts AS ARRAY<STRING>) AS parts")
    return out.selectExpr("o_orderkey", "array_join(parts, ',') AS parts", "size(parts) AS n_parts")


@query("rule_presence", """
SELECT event_id, CASE WHEN event_id % 6 IN (0, 1) THEN false ELSE true END AS has_flag
FROM events
""")
def rule_presence(spark, sf):
    contracts = _contract("""
common:
  has_flag: {from: flag, as: boolean}
event_types: {}
""")
    flag = ("CASE event_id % 6 WHEN 1 THEN parse_json('null') WHEN 2 THEN parse_json('false') "
            "WHEN 3 THEN parse_json('0') WHEN 4 THEN parse_json('\"\"') WHEN 5 THEN parse_json('\"x\"') END")
    event = (f"CASE WHEN event_id % 6 = 0 THEN {shop_event_json()} "
             f"ELSE {shop_event_json({'flag': flag})} END")
    out = _shop_normalized(spark, sf, contracts, event, output="wide", type_hints={"has_flag": "boolean"})
    return out.selectExpr("rid AS event_id", "has_flag")


@query("rule_timestamp", """
SELECT event_id,
       CASE event_id % 8
         WHEN 4 THEN epoch_ms(date_trunc('second', ts))
         WHEN 6 THEN epoch_ms(date_trunc('day', ts))
         ELSE epoch_us(ts) // 1000 END AS event_time
FROM events
""")
def rule_timestamp(spark, sf):
    fmt = {
        0: "concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), 'Z')",
        1: "concat(date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '+00:00')",
        2: "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")",
        3: "concat(date_format(ts + INTERVAL 2 HOURS, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '+02:00')",
        4: "concat(date_format(ts, \"yyyyMMdd'T'HHmmss\"), 'Z')",
        5: "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSS')",
        6: "date_format(ts, 'yyyy-MM-dd')",
        7: "concat(date_format(ts - INTERVAL '5:30' HOUR TO MINUTE, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '-05:30')",
    }
    created = "CASE event_id % 8 " + " ".join(f"WHEN {k} THEN {v}" for k, v in fmt.items()) + " END"
    out = _shop_normalized(spark, sf, event_sql=shop_event_json({"created_at": created}))
    return out.selectExpr("rid AS event_id", "event_time")


@query("rule_default_falsy", """
SELECT event_id, CASE WHEN event_id % 7 = 6 THEN '0' ELSE '"dflt"' END AS v_json,
       CAST(json_extract(props, '$.k') AS BIGINT) AS w
FROM events
""")
def rule_default_falsy(spark, sf):
    contracts = _contract("""
common:
  v: {from: v, default: dflt}
  w: {from: props.k, default: 5}
event_types: {}
""")
    v = ("CASE event_id % 7 WHEN 1 THEN parse_json('null') WHEN 2 THEN parse_json('false') "
         "WHEN 3 THEN parse_json('\"\"') WHEN 4 THEN parse_json('[]') WHEN 5 THEN parse_json('{}') "
         "WHEN 6 THEN parse_json('0') END")
    event = f"CASE WHEN event_id % 7 = 0 THEN {shop_event_json()} ELSE {shop_event_json({'v': v})} END"
    out = _shop_normalized(spark, sf, contracts, event, output="wide", type_hints={"w": "bigint"})
    return out.selectExpr("rid AS event_id", "to_json(v) AS v_json", "w")


# read once for each expression, as the two typed fields: no line is copied as a VARIANT
_LINES = "try_variant_get(payload, '$.lines', 'array<struct<l_partkey: bigint, l_quantity: double>>')"


@query("rule_expression", f"""
SELECT o.o_orderkey, CAST(COUNT(l.l_orderkey) AS INTEGER) AS n_lines, MAX(l.l_quantity) AS max_qty,
       COALESCE(SUM(l.l_quantity), 0) AS sum_qty, arg_min(l.l_partkey, CAST(l.l_linenumber AS BIGINT) * 1000000000 + l.l_partkey) AS first_part,
       COALESCE(string_agg(CAST(l.l_partkey AS VARCHAR), ',' ORDER BY l.l_partkey), '') AS sorted_parts
{_ORDER_LINES}
""")
def rule_expression(spark, sf):
    qty = f"transform({_LINES}, x -> x.l_quantity)"
    out = _orders_normalized(spark, sf, f"""
common:
  n_lines: {{expression: "size({_LINES})"}}
  max_qty: {{expression: "array_max({qty})"}}
  sum_qty: {{expression: "aggregate({qty}, 0D, (a, x) -> a + x)"}}
  first_part: {{expression: "try_variant_get(payload, '$.lines[0].l_partkey', 'bigint')"}}
  sorted_parts: {{expression: "array_join(array_sort(transform({_LINES}, x -> x.l_partkey)), ',')"}}
""", {"n_lines": "int", "max_qty": "double", "sum_qty": "double", "first_part": "bigint", "sorted_parts": "string"})
    return out.select("o_orderkey", "n_lines", "max_qty", "sum_qty", "first_part", "sorted_parts")


@query("rule_select_keys", """
SELECT l.l_orderkey AS o_orderkey, l.l_linenumber AS l_linenumber, l.l_partkey AS l_partkey
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
""")
def rule_select_keys(spark, sf):
    expr = select_keys_sql("payload:lines", ["l_linenumber", "l_partkey"]).replace('"', '\\"')
    out = _orders_normalized(spark, sf, f"""
common:
  picked: {{expression: "{expr}"}}
""", {})
    return out.selectExpr("o_orderkey", "explode(try_cast(picked AS ARRAY<VARIANT>)) AS e").selectExpr(
        "o_orderkey",
        "try_variant_get(e, '$.l_linenumber', 'int') AS l_linenumber",
        "try_variant_get(e, '$.l_partkey', 'bigint') AS l_partkey",
    )


@query("rule_precedence", """
SELECT event_id,
       CASE WHEN event_id % 3 = 2 THEN '["x"]' ELSE '["none"]' END AS a_json,
       CASE WHEN event_id % 2 = 1 THEN 'true' ELSE '"no"' END AS b_json,
       CAST(0.0 AS DOUBLE) AS c
FROM events
""")
def rule_precedence(spark, sf):
    contracts = _contract("""
common:
  a: {from: tags, take: name, as: boolean, default: [none]}
  b: {from: flag, as: boolean, default: "no"}
  c: {expression: "try_variant_get(payload, '$.value', 'double') * 0", take: name, as: boolean, default: 7}
event_types: {}
""")
    tags = "CASE WHEN event_id % 3 = 1 THEN parse_json('[]') WHEN event_id % 3 = 2 THEN parse_json('[{\"name\": \"x\"}]') END"
    flag = "CASE WHEN event_id % 2 = 1 THEN parse_json('1') END"
    event = shop_event_json({"tags": tags, "flag": flag})
    out = _shop_normalized(spark, sf, contracts, event, output="wide", type_hints={"c": "double"})
    return out.selectExpr("rid AS event_id", "to_json(a) AS a_json", "to_json(b) AS b_json", "c")


@query("section_overlay", """
SELECT event_id,
       CASE WHEN event_type = 'view' THEN event_type ELSE concat('user_', user_id) END AS partition_key,
       event_type AS entity_name,
       CASE WHEN event_type = 'click' THEN concat('user_', user_id)
            ELSE CAST(json_extract(props, '$.k') AS VARCHAR) END AS label
FROM events
""")
def section_overlay(spark, sf):
    contracts = _contract("""
common:
  entity_name: {from: type}
  label: {from: props.k}
event_types:
  click:
    label: {from: actor.login}
  view:
    partition_key: {from: type}
""")
    out = _shop_normalized(spark, sf, contracts, output="wide", type_hints={"label": "string"})
    return out.selectExpr("rid AS event_id", "partition_key", "entity_name", "label")


_ATTR_KEYS = ("CASE event_type WHEN 'click' THEN 'amount,prop_k,target' WHEN 'view' THEN 'amount,prop_k,seen' "
              "WHEN 'purchase' THEN 'amount,prop_k,items' ELSE 'amount,prop_k' END")


@query("type_dispatch", f"""
SELECT event_id, event_type, {_ATTR_KEYS} AS attr_keys,
       CASE WHEN event_type = 'click' THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS target,
       CASE WHEN event_type = 'view' THEN true END AS seen,
       value AS amount,
       CASE WHEN event_type = 'purchase' THEN 'sku-' || CAST(user_id AS VARCHAR) || ',sku-' || CAST(event_id AS VARCHAR) END AS items
FROM events
""")
def type_dispatch(spark, sf):
    # items: two objects around a JSON null (dropped by the pluck)
    items = ("parse_json(concat('[{\"sku\": \"sku-', user_id, '\"}, null, {\"sku\": \"sku-', "
             "event_id, '\"}]'))")
    out = _shop_normalized(spark, sf, event_sql=shop_event_json({"items": items}))
    return out.selectExpr(
        "rid AS event_id", "event_type", "array_join(json_object_keys(attributes), ',') AS attr_keys",
        "CAST(get_json_object(attributes, '$.target') AS BIGINT) AS target",
        "CAST(get_json_object(attributes, '$.seen') AS BOOLEAN) AS seen",
        "CAST(get_json_object(attributes, '$.amount') AS DOUBLE) AS amount",
        "array_join(from_json(get_json_object(attributes, '$.items'), 'array<string>'), ',') AS items",
    )


@query("type_fallback", """
SELECT event_id, event_type, event_type NOT IN ('click', 'view', 'purchase', 'signup') AS is_fallback,
       CASE WHEN event_type NOT IN ('click', 'view', 'purchase', 'signup') THEN 'amount,prop_k' END AS fallback_keys,
       value AS amount, CAST(json_extract(props, '$.k') AS BIGINT) AS prop_k
FROM events
""")
def type_fallback(spark, sf):
    # every row; undeclared types (P11) get envelope + common fields only
    out = _shop_normalized(spark, sf)
    fallback = "event_type NOT IN ('click', 'view', 'purchase', 'signup')"
    return out.selectExpr(
        "rid AS event_id", "event_type", f"{fallback} AS is_fallback",
        f"CASE WHEN {fallback} THEN array_join(json_object_keys(attributes), ',') END AS fallback_keys",
        "CAST(get_json_object(attributes, '$.amount') AS DOUBLE) AS amount",
        "CAST(get_json_object(attributes, '$.prop_k') AS BIGINT) AS prop_k",
    )


@query("source_dispatch", """
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'shop' ELSE 'shop_v2' END AS source,
       CASE WHEN event_id % 2 = 0 THEN concat('user_', user_id) ELSE event_type END AS partition_key,
       CASE WHEN event_id % 2 = 0 THEN
         CASE event_type WHEN 'click' THEN 'amount,prop_k,target' WHEN 'view' THEN 'amount,prop_k,seen'
                         WHEN 'purchase' THEN 'amount,prop_k,items' ELSE 'amount,prop_k' END
       ELSE 'v2_value' END AS attr_keys
FROM events
""")
def source_dispatch(spark, sf):
    v2 = Contract.from_yaml("""
source: shop_v2
partition_key: {from: type}
envelope:
  entity_id: {from: actor.id}
  entity_name: {from: actor.login}
  event_time: {from: created_at, as: timestamp}
common:
  v2_value: {from: value}
event_types: {}
""")
    contracts = {"shop": builtin_contracts()["shop"], "shop_v2": v2}
    raw = _shop_raw(spark, sf)
    value = ("CASE WHEN event_id % 2 = 1 THEN to_json(named_struct('source', 'shop_v2', "
             "'source_event_id', source_event_id, 'source_event_endpoint', source_event_endpoint, "
             "'source_event_type', source_event_type, 'observed_at', observed_at, "
             "'schema_version', schema_version, 'payload', payload)) ELSE value END")
    src = raw.selectExpr("event_id AS rid", f"{value} AS value")
    out = normalize(src, contracts, keep=["rid"])
    return out.selectExpr("rid AS event_id", "source", "partition_key",
                          "array_join(json_object_keys(attributes), ',') AS attr_keys")


# ---------------------------------------------------------------------------
# F2
# ---------------------------------------------------------------------------

@query("to_millis_mixed", """
SELECT event_id,
       CASE event_id % 5 WHEN 0 THEN (epoch_us(ts) // 1000000) * 1000
                         WHEN 3 THEN 0 ELSE epoch_us(ts) // 1000 END AS millis
FROM events
""")
def to_millis_mixed(spark, sf):
    ev = read_table(spark, sf, "events")
    iso = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"
    ms = "(CAST(unix_micros(CAST(ts AS TIMESTAMP)) AS DECIMAL(20,0)) DIV 1000)"
    v = (
        f"CASE event_id % 5 WHEN 0 THEN CAST({ms} DIV 1000 AS VARIANT) "
        f"WHEN 1 THEN CAST({ms} AS VARIANT) "
        f"WHEN 2 THEN CAST({iso_z('ts')} AS VARIANT) "
        f"WHEN 3 THEN parse_json('null') "
        f"ELSE CAST(concat(date_format(ts + INTERVAL 1 HOUR, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '+01:00') AS VARIANT) END"
    )
    staged = with_to_millis(ev.selectExpr("event_id", f"{v} AS v"), {"v": "v"})
    return staged.selectExpr("event_id", "v_ms AS millis")


# ---------------------------------------------------------------------------
# The normalized event
# ---------------------------------------------------------------------------

_ENVELOPE_ORACLE = f"""
SELECT event_id AS raw_id, 'shop' AS source, CAST(event_id AS VARCHAR) AS event_id, event_type,
       CAST({OBSERVED_AT_MS} AS BIGINT) AS ingested_ms, CAST(1 AS INTEGER) AS schema_version,
       concat('user_', user_id) AS partition_key,
       CASE WHEN event_id % 10 = 0 THEN 'None' ELSE CAST(user_id AS VARCHAR) END AS entity_id,
       concat('user_', user_id) AS entity_name, epoch_us(ts) // 1000 AS event_time
FROM events
"""

_ACTOR_SOMETIMES_NO_ID = ("CASE WHEN event_id % 10 = 0 THEN to_variant_object(named_struct('login', concat('user_', user_id))) "
                          "ELSE to_variant_object(named_struct('id', user_id, 'login', concat('user_', user_id))) END")


def _envelope_out(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        "rid AS raw_id", "source", "event_id", "event_type", "unix_millis(ingested_at) AS ingested_ms",
        "schema_version", "partition_key", "entity_id", "entity_name", "event_time",
    )


@query("normalized_envelope", _ENVELOPE_ORACLE)
def normalized_envelope(spark, sf):
    out = _shop_normalized(spark, sf, event_sql=shop_event_json({"actor": _ACTOR_SOMETIMES_NO_ID}))
    return _envelope_out(out)


@query("row_error_drop", """
SELECT event_id,
       CASE WHEN event_id % 9 IN (0, 1, 2) OR event_id % 10 = 3
                 OR (event_type = 'click' AND event_id % 9 = 4) THEN 'normalize_error' END AS reason
FROM events
""")
def row_error_drop(spark, sf):
    contracts = _contract("""
common:
  amount: {from: value}
event_types:
  click:
    clicked_at: {from: clicked_at, as: timestamp}
""")
    created = ("CASE event_id % 9 WHEN 0 THEN CAST('not a date' AS VARIANT) WHEN 1 THEN CAST(12345 AS VARIANT) "
               f"WHEN 2 THEN CAST('' AS VARIANT) ELSE CAST({iso_z('ts')} AS VARIANT) END")
    actor = ("CASE WHEN event_id % 10 = 3 THEN to_variant_object(named_struct('id', user_id, 'login', user_id)) "
             "ELSE to_variant_object(named_struct('id', user_id, 'login', concat('user_', user_id))) END")
    clicked = "CASE WHEN event_id % 9 = 4 THEN 'bad' ELSE " + iso_z("ts") + " END"
    event = shop_event_json({"created_at": created, "actor": actor, "clicked_at": clicked})
    raw = _shop_raw(spark, sf, event).withColumnRenamed("event_id", "rid")
    out = normalize(raw, contracts, keep=["rid"], with_reason=True)
    return out.selectExpr("rid AS event_id", "reason")


@query("expression_error_drop", """
SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'normalize_error' END AS reason,
       CASE WHEN event_id % 7 <> 0 AND event_id % 5 <> 0 THEN event_id * 2 END AS doubled,
       CASE WHEN event_id % 7 <> 0 AND event_id % 3 <> 0 THEN event_id END AS lenient
FROM events
""")
def expression_error_drop(spark, sf):
    """An expression that fails on a row costs that row; a missing input, or one that CASE handles, costs none."""
    contracts = _contract("""
common:
  doubled: {expression: "try_multiply(try_cast(payload:n AS BIGINT), 2L)"}
  lenient: {expression: "coalesce(try_cast(payload:m AS BIGINT), CAST(NULL AS BIGINT))"}
event_types: {}
""")
    n = "CASE WHEN event_id % 7 = 0 THEN CAST('abc' AS VARIANT) WHEN event_id % 5 = 0 THEN NULL ELSE CAST(event_id AS VARIANT) END"
    m = "CASE WHEN event_id % 3 = 0 THEN CAST('abc' AS VARIANT) ELSE CAST(event_id AS VARIANT) END"
    raw = _shop_raw(spark, sf, shop_event_json({"n": n, "m": m})).withColumnRenamed("event_id", "rid")
    out = normalize(raw, contracts, keep=["rid"], output="wide", with_reason=True, type_hints={"doubled": "bigint", "lenient": "bigint"})
    ok = "CASE WHEN reason IS NULL THEN {} END AS {}"
    return out.selectExpr("rid AS event_id", "reason", ok.format("doubled", "doubled"), ok.format("lenient", "lenient"))


@query("expression_totality", """
SELECT event_id, CASE WHEN event_id % 11 = 0 OR event_id % 13 = 0 OR event_id % 17 = 0 OR event_id % 19 = 0 THEN 'normalize_error' END AS reason,
       CASE WHEN NOT (event_id % 11 = 0 OR event_id % 13 = 0 OR event_id % 17 = 0 OR event_id % 19 = 0) THEN CASE WHEN event_id % 5 <> 0 THEN strftime(ts, '%Y-%m-%d') END END AS day,
       CASE WHEN NOT (event_id % 11 = 0 OR event_id % 13 = 0 OR event_id % 17 = 0 OR event_id % 19 = 0) THEN 'a b' || event_id END AS page,
       CASE WHEN NOT (event_id % 11 = 0 OR event_id % 13 = 0 OR event_id % 17 = 0 OR event_id % 19 = 0) THEN CAST(event_id AS BIGINT) END AS number,
       CASE WHEN NOT (event_id % 11 = 0 OR event_id % 13 = 0 OR event_id % 17 = 0 OR event_id % 19 = 0) THEN CASE WHEN event_id % 3 <> 0 THEN 't' || event_id END END AS second_tag,
       CASE WHEN NOT (event_id % 11 = 0 OR event_id % 13 = 0 OR event_id % 17 = 0 OR event_id % 19 = 0) THEN CASE WHEN event_id % 7 = 0 THEN -1 ELSE event_id END END AS lenient,
       CASE WHEN NOT (event_id % 11 = 0 OR event_id % 13 = 0 OR event_id % 17 = 0 OR event_id % 19 = 0) THEN 'bad' END AS kind
FROM events
""")
def expression_totality(spark, sf):
    """Expressions over bad texts: a time, a percent code, a number and a document that don't parse cost their row each;
    an index that isn't there, and what the author handles, cost none."""
    contracts = _contract("""
common:
  day: {expression: "date_format(try_to_timestamp(try_variant_get(payload, '$.when', 'string')), 'yyyy-MM-dd')"}
  page: {expression: "try_url_decode(try_variant_get(payload, '$.page', 'string'))"}
  number: {expression: "CAST(try_to_number(try_variant_get(payload, '$.number', 'string'), '999999999999') AS STRING)"}
  second_tag: {expression: "get(split(try_variant_get(payload, '$.tags', 'string'), '[,;]'), 1)"}
  lenient: {expression: "coalesce(try_to_number(try_variant_get(payload, '$.loose', 'string'), '999999999999'), -1)"}
  kind: {expression: "regexp_extract(try_variant_get(try_parse_json(try_variant_get(payload, '$.inner', 'string')), '$.kind', 'string'), '^([a-z]+)', 1)"}
event_types: {}
""")
    n = "CAST(event_id AS STRING)"
    raw = _shop_raw(spark, sf, shop_event_json({
        "when": "CASE WHEN event_id % 11 = 0 THEN 'soon' WHEN event_id % 5 <> 0 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss') END",
        "page": f"CASE WHEN event_id % 13 = 0 THEN '100%zz' ELSE concat('a%20b', {n}) END",
        "number": f"CASE WHEN event_id % 17 = 0 THEN concat('x', {n}) ELSE {n} END",
        "tags": f"CASE WHEN event_id % 3 = 0 THEN 'one' ELSE concat('one;t', {n}, ',three') END",
        "loose": f"CASE WHEN event_id % 7 = 0 THEN 'none' ELSE {n} END",
        "inner": "CASE WHEN event_id % 19 = 0 THEN '{' ELSE '{\"kind\": \"bad1\"}' END",
    })).withColumnRenamed("event_id", "rid")
    hints = {"number": "bigint", "lenient": "bigint"} | dict.fromkeys(("day", "page", "second_tag", "kind"), "string")
    out = normalize(raw, contracts, keep=["rid"], output="wide", with_reason=True, type_hints=hints)
    return out.selectExpr("rid AS event_id", "reason", *(f"CASE WHEN reason IS NULL THEN {c} END AS {c}" for c in ("day", "page", "number", "second_tag", "lenient", "kind")))


#: Integers as JSON values in all spellings, with what the envelope reads (None: the row is rejected).
INT_SPELLINGS: list[tuple[str, int | None]] = [
    ("'7'", 7), ("'+7'", 7), ("' 7 '", 7), ("'7.0'", 7), ("'7.000'", 7), ("'7_0'", 70), ("'-7_0.0 '", -70), ("'007'", 7), ("'-0.0'", 0),
    ("'7.'", None), ("'.0'", None), ("'7.5'", None), ("'7__0'", None), ("'_7'", None), ("'7_'", None), ("'7e3'", None), ("'0x7'", None),
    ("''", None), ("'- 7'", None), ("'7 0'", None), ("'7_.0'", None), ("7", 7), ("7.0D", 7), ("7.5D", None), ("true", 1), ("false", 0),
]


@query("int_coercion", "SELECT event_id, CASE event_id % {} {} END AS event_time, CASE WHEN event_id % {} IN ({}) THEN 'normalize_error' END AS reason FROM events".format(
    len(INT_SPELLINGS), " ".join(f"WHEN {i} THEN {'NULL' if n is None else n}::BIGINT" for i, (_, n) in enumerate(INT_SPELLINGS)),
    len(INT_SPELLINGS), ", ".join(str(i) for i, (_, n) in enumerate(INT_SPELLINGS) if n is None)))
def int_coercion(spark, sf):
    contract = Contract.from_yaml("""
source: shop
partition_key: {from: actor.login}
envelope:
  entity_id: {from: actor.id}
  entity_name: {from: actor.login}
  event_time: {from: at}
common: {}
event_types: {}
""")
    at = f"CASE event_id % {len(INT_SPELLINGS)} " + " ".join(f"WHEN {i} THEN CAST({v} AS VARIANT)" for i, (v, _) in enumerate(INT_SPELLINGS)) + " END"
    raw = _shop_raw(spark, sf, shop_event_json({"at": at})).withColumnRenamed("event_id", "rid")
    out = normalize(raw, {"shop": contract}, keep=["rid"], with_reason=True)
    return out.selectExpr("rid AS event_id", "CASE WHEN reason IS NULL THEN event_time END AS event_time", "reason")


@query("normalized_json", f"""
SELECT event_id, '2031-03-04T05:06:07Z' AS ingested_at, epoch_us(ts) // 1000 AS event_time,
       value AS amount, concat('user_', user_id) AS partition_key,
       CASE event_type WHEN 'click' THEN 12 WHEN 'view' THEN 12 WHEN 'purchase' THEN 12 ELSE 11 END AS n_keys
FROM events
""")
def normalized_json(spark, sf):
    out = _shop_normalized(spark, sf, output="json")
    return out.selectExpr(
        "rid AS event_id",
        "get_json_object(value, '$.ingested_at') AS ingested_at",
        "CAST(get_json_object(value, '$.event_time') AS BIGINT) AS event_time",
        "CAST(get_json_object(value, '$.amount') AS DOUBLE) AS amount",
        "get_json_object(value, '$.partition_key') AS partition_key",
        "size(json_object_keys(value)) AS n_keys",
    )


# ---------------------------------------------------------------------------
# Q1: quarantine
# ---------------------------------------------------------------------------

@query("quarantine_counts", """
SELECT reason, CAST(COUNT(*) AS BIGINT) AS n FROM (
  SELECT CASE WHEN event_id % 7 = 0 THEN 'invalid_event'
              WHEN event_id % 11 = 0 THEN 'malformed'
              WHEN event_id % 13 = 0 THEN 'unknown_source'
              WHEN event_id % 17 = 0 THEN 'normalize_error'
              ELSE 'ok' END AS reason
  FROM events) GROUP BY reason
""")
def quarantine_counts(spark, sf):
    ev = read_table(spark, sf, "events")
    event = (f"CASE WHEN event_id % 7 = 0 THEN {shop_event_json(drop=('id',))} "
             f"WHEN event_id % 17 = 0 THEN {shop_event_json({'created_at': chr(39) + 'never' + chr(39)})} "
             f"ELSE {shop_event_json()} END")
    api = ev.selectExpr("event_id", f"{event} AS event")
    raw = build_raw_events(api, SHOP, observed_at=OBSERVED_AT, keep=["event_id"], with_reason=True, encode=True)
    value = ("CASE WHEN event_id % 11 = 0 THEN substring(value, 2) "
             "WHEN event_id % 13 = 0 THEN replace(value, '\"source\":\"shop\"', '\"source\":\"gitlab\"') "
             "ELSE value END")
    staged = raw.selectExpr("event_id AS rid", "reason AS raw_reason", f"{value} AS value")
    # one pass: rows the raw layer rejected carry no envelope and keep their raw-layer reason
    out = normalize(staged, {"shop": builtin_contracts()["shop"]}, keep=["rid", "raw_reason"], with_reason=True)
    return out.selectExpr("coalesce(raw_reason, reason, 'ok') AS reason") \
        .groupBy("reason").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------------------
# Flagship: the shipped GitHub contract over GitHub-shaped events
# ---------------------------------------------------------------------------

_GH = "CASE event_id % 12 " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(GITHUB_TYPES)) + " END"
#: Number of attributes by type: the five common ones and those the type declares.
_GH_ATTRS = "CASE event_id % 12 " + " ".join(
    f"WHEN {i} THEN {n}" for i, n in enumerate((6, 21, 18, 15, 19, 10, 8, 5, 6, 19, 8, 5))) + " END"


@query("github_events", f"""
SELECT event_id, {_GH} AS event_type,
       concat('org/repo-', CAST(user_id % 10 AS VARCHAR)) AS partition_key,
       CAST(user_id AS VARCHAR) AS entity_id, concat('user_', user_id) AS entity_name,
       epoch_us(ts) // 1000 AS event_time, user_id % 10 AS repo_id,
       CASE WHEN user_id % 2 = 0 THEN 'acme' END AS org_login, event_id % 2 = 0 AS public,
       CASE event_id % 12 WHEN 0 THEN 'started' WHEN 1 THEN 'created' WHEN 2 THEN 'opened' WHEN 3 THEN 'submitted'
                          WHEN 4 THEN 'created' WHEN 9 THEN 'assigned' WHEN 10 THEN 'added' END AS action,
       CASE WHEN event_id % 12 IN (1, 9) THEN concat('k', CAST(json_extract(props, '$.k') AS BIGINT) % 3, ',u', user_id % 2) END AS issue_labels,
       CASE WHEN event_id % 12 = 1 THEN event_id % 24 = 1 END AS issue_is_pull_request,
       CASE WHEN event_id % 12 IN (2, 3, 4) THEN event_id END AS pr_number,
       CASE event_id % 12 WHEN 5 THEN 'repository' WHEN 6 THEN 'branch' END AS ref_type,
       CASE WHEN event_id % 12 = 3 THEN CASE WHEN event_id % 24 = 3 THEN 'approved' ELSE 'commented' END END AS review_state,
       CASE WHEN event_id % 12 = 3 THEN epoch_us(ts) // 1000 END AS review_submitted_at,
       CASE WHEN event_id % 12 = 4 THEN concat('src/f', event_id % 9, '.py') END AS comment_path,
       CASE WHEN event_id % 12 = 4 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS comment_position,
       CASE WHEN event_id % 12 = 8 THEN CAST(event_id % 3 + 1 AS INTEGER) END AS n_pages,
       CASE WHEN event_id % 12 = 8 THEN concat('Page ', event_id % 3, ' of ', event_id) END AS last_page_title,
       CASE WHEN event_id % 12 = 9 THEN concat('user_', user_id, ',user_', user_id + 1) END AS assignees,
       CASE WHEN event_id % 12 = 10 THEN concat('user_', user_id + 1) END AS member_login,
       CAST({_GH_ATTRS} AS INTEGER) AS n_attrs
FROM events
""")
def github_events_q(spark, sf):
    api = github_events(spark, sf)
    raw = build_raw_events(api, get_source_config("github"), observed_at=OBSERVED_AT, keep=["event_id"], encode=True)
    out = normalize(raw.withColumnRenamed("event_id", "rid"), {"github": builtin_contracts()["github"]}, keep=["rid"])

    def attr(name: str, kind: str = "string") -> str:
        return f"CAST(get_json_object(attributes, '$.{name}') AS {kind}) AS {name}"

    def joined(name: str) -> str:
        return f"array_join(from_json(get_json_object(attributes, '$.{name}'), 'array<string>'), ',') AS {name}"

    pages = "from_json(get_json_object(attributes, '$.pages'), 'array<struct<title: string>>')"
    return out.selectExpr(
        "rid AS event_id", "event_type", "partition_key", "entity_id", "entity_name", "event_time",
        attr("repo_id", "BIGINT"), attr("org_login"), attr("public", "BOOLEAN"), attr("action"), joined("issue_labels"),
        attr("issue_is_pull_request", "BOOLEAN"), attr("pr_number", "BIGINT"), attr("ref_type"), attr("review_state"),
        attr("review_submitted_at", "BIGINT"), attr("comment_path"), attr("comment_position", "BIGINT"),
        f"CASE WHEN {pages} IS NOT NULL THEN size({pages}) END AS n_pages",
        f"element_at({pages}, -1).title AS last_page_title", joined("assignees"), attr("member_login"),
        "size(json_object_keys(attributes)) AS n_attrs",
    )


# ---------------------------------------------------------------------------
# J1 / J2 as Structured Streaming queries (file landing zone, availableNow)
# ---------------------------------------------------------------------------

@query("stream_normalize", _ENVELOPE_ORACLE)
def stream_normalize(spark, sf):
    from eventloom.session import scratch_dir
    from eventloom.streaming.jobs import start_normalize

    root = scratch_dir(spark, "stream-normalize")
    raw = _shop_raw(spark, sf, shop_event_json({"actor": _ACTOR_SOMETIMES_NO_ID}))
    raw.select("value").write.mode("overwrite").text(f"{root}/landing")
    q = start_normalize(
        spark, {"shop": builtin_contracts()["shop"]},
        source_format="text", source_path=f"{root}/landing", source_options={"maxFilesPerTrigger": "4"},
        sink_format="parquet", sink_path=f"{root}/out", checkpoint=f"{root}/checkpoint",
    )
    q.awaitTermination()
    out = spark.read.parquet(f"{root}/out").where("outcome = 'ok'")
    return out.selectExpr(
        "CAST(event_id AS BIGINT) AS raw_id", "source", "event_id", "event_type",
        "unix_millis(ingested_at) AS ingested_ms", "schema_version", "partition_key", "entity_id",
        "entity_name", "event_time",
    )


@query("stream_ingest", """
SELECT event_id, CAST(event_id AS VARCHAR) AS source_event_id, event_id * 10 AS seq, value
FROM events
""")
def stream_ingest(spark, sf):
    from eventloom.session import scratch_dir
    from eventloom.streaming.jobs import start_ingest

    root = scratch_dir(spark, "stream-ingest")
    ev = read_table(spark, sf, "events")
    orig = ev.selectExpr("event_id DIV 100 AS page_no", "event_id * 10 AS seq",
                         f"{shop_event_json({'seq': 'event_id * 10'})} AS event")
    # every third event is sent again right behind itself, with a changed value
    dup = ev.where("event_id % 3 = 0").selectExpr(
        "event_id DIV 100 AS page_no", "event_id * 10 + 5 AS seq",
        f"{shop_event_json({'seq': 'event_id * 10 + 5', 'value': 'value + 1000'})} AS event")
    pages = orig.unionByName(dup).groupBy("page_no").agg(
        F.expr("concat('[', array_join(transform(sort_array(collect_list(struct(seq, event))), "
               "x -> x.event), ','), ']')").alias("value"))
    # two landings, each consumed by its own run of the same checkpointed query:
    # the FIFO state of the first run carries into the second (a restart)
    for half in (0, 1):
        pages.where(f"page_no % 2 = {half}").select("value").write.mode("append").text(f"{root}/landing")
        q = start_ingest(
            spark, SHOP, source_format="text", source_path=f"{root}/landing",
            sink_format="parquet", sink_path=f"{root}/out",
            checkpoint=f"{root}/checkpoint", dedupe="fifo", max_size=120,
            order=["try_variant_get(event, '$.seq', 'bigint')"], observed_at=OBSERVED_AT,
        )
        q.awaitTermination()
    out = spark.read.parquet(f"{root}/out").where("outcome = 'ok'")
    return out.selectExpr(
        "CAST(source_event_id AS BIGINT) AS event_id", "source_event_id", "arrival_1 AS seq",
        "CAST(get_json_object(value, '$.payload.value') AS DOUBLE) AS value",
    )


def _pages_of(events: DataFrame, by: str) -> DataFrame:
    """Events (page_no, JSON, ``by`` for the order) -> one page (a JSON array) for each page_no."""
    return events.groupBy("page_no").agg(F.expr(
        f"concat('[', array_join(transform(sort_array(collect_list(struct({by}, event))), x -> x.event), ','), ']')").alias("value"))


def _forget_last_commit(spark, checkpoint: str) -> None:
    """As if the job had died before the last micro-batch was committed: the next run replays it."""
    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = folder.getFileSystem(sc._jsc.hadoopConfiguration())
    names = [f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().isdigit()]
    fs.delete(max(names, key=lambda p: int(p.getName())), False)


@query("stream_first", """
SELECT event_id, event_id * 10 AS seq, value, NULL::VARCHAR AS reason FROM events
UNION ALL SELECT event_id, event_id * 10 + 5, value + 1000, 'duplicate' FROM events WHERE event_id % 5 = 0
UNION ALL SELECT event_id, event_id * 10 + k, value + 1000 * k, 'duplicate' FROM events, (VALUES (1), (2)) AS t(k) WHERE event_id % 3 < k AND event_id % 2 = 0
""")
def stream_first(spark, sf):
    """D1 over three runs of a stream: re-sends in the same landing and in later ones; one micro-batch is replayed."""
    from eventloom.session import scratch_dir
    from eventloom.streaming.jobs import start_ingest

    root = scratch_dir(spark, "stream-first")
    ev = read_table(spark, sf, "events")

    def sends(where: str, step: int, more: str) -> DataFrame:
        fields = {"seq": f"event_id * 10 + {step}", "value": f"value + {more}"}
        return ev.where(where).selectExpr("event_id DIV 100 AS page_no", f"event_id * 10 + {step} AS seq", f"{shop_event_json(fields)} AS event")

    for run in range(3):
        landed = sends(f"event_id % 3 = {run}", 0, "0").unionByName(sends(f"event_id % 3 = {run} AND event_id % 5 = 0", 5, "1000"))
        if run:
            landed = landed.unionByName(sends(f"event_id % 3 < {run} AND event_id % 2 = 0", run, str(1000 * run)))
        _pages_of(landed, "seq").select("value").write.mode("append").text(f"{root}/landing")
        job = lambda: start_ingest(
            spark, SHOP, source_format="text", source_path=f"{root}/landing", sink_format="parquet", sink_path=f"{root}/out",
            checkpoint=f"{root}/checkpoint", dedupe="first", order=["try_variant_get(event, '$.seq', 'bigint')"], observed_at=OBSERVED_AT)
        job().awaitTermination()
        if run == 1:
            _forget_last_commit(spark, f"{root}/checkpoint")
    out = spark.read.parquet(f"{root}/out")
    text = F.coalesce(F.get_json_object("value", "$.payload.value"), F.get_json_object("raw_value", "$.value"))
    return out.select(F.col("source_event_id").cast("long").alias("event_id"), F.col("arrival_1").alias("seq"), text.cast("double").alias("value"), "reason")


@query("stream_horizon", """
SELECT event_id, event_id * 10 + s AS seq, value + 1000 * s AS value, CASE WHEN s IN (1, 3) THEN 'duplicate' END AS reason
FROM events, (VALUES (0), (1), (2), (3)) AS r(s) WHERE s < 2 OR event_id % 3 = 1
""")
def stream_horizon(spark, sf):
    """D3 over three runs of a stream, with the sends of ``dedupe_horizon_far``: rows come up to five minutes out of order
    and are decided once the watermark has passed them; a last event, a day later, lets it pass all."""
    from eventloom.session import scratch_dir
    from eventloom.streaming.jobs import start_ingest

    root = scratch_dir(spark, "stream-horizon")
    ev = read_table(spark, sf, "events")
    sends = ev.selectExpr("*", "explode(CASE WHEN event_id % 3 = 1 THEN array(0, 1, 2, 3) ELSE array(0, 1) END) AS again")
    sends = sends.selectExpr("*", "ts + make_dt_interval(0, 0, element_at(array(0, 4, 11, 20), again + 1), 0) AS seen")
    first, last = (r := ev.agg(F.min("ts"), F.max("ts")).first())[0], r[1]
    third = max(1, int((last - first).total_seconds()) // 3)
    iso = "concat(date_format(seen, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"), '+00:00')"
    event = shop_event_json({"value": "value + 1000 * again", "seq": "event_id * 10 + again", "obs": iso})
    seconds = f"unix_seconds(CAST(seen AS TIMESTAMP)) - unix_seconds(CAST(TIMESTAMP_NTZ'{first}' AS TIMESTAMP))"
    api = sends.selectExpr("event_id DIV 100 AS page_no", "event_id * 10 + again AS seq", f"{event} AS event",
                           f"least(2, ({seconds} + event_id % 300) DIV {third}) AS run")
    end = shop_event_json({"id": "-1", "obs": f"'{last + dt.timedelta(days=1):%Y-%m-%dT%H:%M:%S}+00:00'", "seq": "-1"})
    for run in range(3):
        pages = _pages_of(api.where(f"run = {run}"), "seq").select("value")
        if run == 2:
            pages = pages.unionByName(ev.orderBy("event_id").limit(1).selectExpr(f"concat('[', {end}, ']') AS value"))
        pages.write.mode("append").text(f"{root}/landing")
        start_ingest(
            spark, SHOP, source_format="text", source_path=f"{root}/landing", sink_format="parquet", sink_path=f"{root}/out", checkpoint=f"{root}/checkpoint",
            dedupe="horizon", horizon="10 minutes", delay=600, order=["try_variant_get(event, '$.seq', 'bigint')"],
            observed_at=F.expr("try_variant_get(event, '$.obs', 'string')"),
        ).awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    text = F.coalesce(F.get_json_object("value", "$.payload.value"), F.get_json_object("raw_value", "$.value"))
    return out.select(F.col("source_event_id").cast("long").alias("event_id"), F.col("arrival_1").alias("seq"), text.cast("double").alias("value"), "reason")


def queries() -> dict[str, QueryFn]:
    return {name: fn for name, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql.strip() for name, (_, sql) in REGISTRY.items() if sql}
