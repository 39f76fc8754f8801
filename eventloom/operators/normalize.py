"""Raw envelope JSON -> normalized events.

The whole operator is a chain of narrow projections, identical in batch and
Structured Streaming:

1. parse the message once (``try_parse_json``);
2. read and validate the raw envelope (N1);
3. route to a contract branch by (source, event type) (N2, P10-P12);
4. evaluate every rule of the contract set once (P1-P9), pick each field by branch;
5. check the normalized envelope (E5) and collect row errors (N3);
6. project the normalized event (E1-E4, E6) as typed columns plus a JSON
   tail, a full JSON document (E8) or a wide table (E9).

Rows that fail keep a ``reason`` (``malformed``, ``unknown_source``,
``normalize_error``) for the quarantine output (Q1) instead of disappearing.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from eventloom.functions.time import Checked, with_iso_millis
from eventloom.functions.variant import (
    ident,
    is_json_string_sql,
    is_object_sql,
    py_str_sql,
    sql_str,
    to_json_keep_nulls_sql,
    variant_of_sql,
    vget_sql,
)
from eventloom.plans.compiler import ContractPlan, in_list, rule_key
from eventloom.plans.pinning import filter_here, pinned_stage
from eventloom.plans.contract import as_contracts
from eventloom.plans.safety import check_expression

log = logging.getLogger(__name__)

# Fixed values of the raw and normalized envelopes.
RAW_STRING_FIELDS = ("source", "source_event_id", "source_event_endpoint", "source_event_type", "observed_at")
NORMALIZED_SCHEMA_VERSION = 1
NORMALIZED_COLUMNS = (
    "source",
    "event_id",
    "event_type",
    "ingested_at",
    "schema_version",
    "partition_key",
    "entity_id",
    "entity_name",
    "event_time",
)
REASON_MALFORMED = "malformed"
REASON_UNKNOWN_SOURCE = "unknown_source"
REASON_NORMALIZE_ERROR = "normalize_error"

# Integers in strings as the reference's model library reads them (fixed grammar): white space around,
# a sign, digits with single underscores between them, and a fraction of zeros.
_SPACE = r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]*"
_INT_STRING = rf"^{_SPACE}[+-]?[0-9]+(?:_[0-9]+)*(?:\.0+)?{_SPACE}\z"


def coerce_int_sql(v: str) -> Checked:
    """Lax integer coercion of a JSON value: integers; floats/decimals with no
    fractional part; integers in strings (" 1 ", "1.0", "1_000"); booleans as 0/1.
    Anything else (null, 1.5, "x", objects, arrays, beyond 64 bits) is an error."""
    t = f"schema_of_variant({v})"
    dec = f"try_cast({v} AS DECIMAL(38,9))"
    dbl = f"try_cast({v} AS DOUBLE)"
    text = f"try_cast({v} AS STRING)"
    digits = f"regexp_replace(regexp_replace({text}, '[^0-9+.-]', ''), '[.]0+$', '')"
    value = (
        f"(CASE WHEN {t} IN ('BIGINT', 'INT', 'SMALLINT', 'TINYINT') THEN try_cast({v} AS BIGINT) "
        f"WHEN ({t} IN ('DOUBLE', 'FLOAT') OR {t} LIKE 'DECIMAL%') "
        f"AND coalesce({dec} = floor({dec}), {dbl} = floor({dbl})) "
        f"THEN coalesce(try_cast({dec} AS BIGINT), try_cast({dbl} AS BIGINT)) "
        f"WHEN {t} = 'BOOLEAN' THEN CASE WHEN try_cast({v} AS BOOLEAN) THEN 1L ELSE 0L END "
        f"WHEN {t} = 'STRING' AND {text} RLIKE {sql_str(_INT_STRING)} "
        f"THEN try_cast({digits} AS BIGINT) END)"
    )
    return Checked(value, f"({value} IS NULL)")


def millis_to_iso_utc_sql(ms: str) -> str:
    """Epoch ms -> ``YYYY-MM-DDTHH:MM:SS[.ffffff]Z`` in UTC, independent of the session time zone."""
    day = f"CAST(floor({ms} / 86400000) AS INT)"
    rem = f"({ms} - CAST(floor({ms} / 86400000) AS BIGINT) * 86400000)"
    clock = (
        f"format_string('%02d:%02d:%02d', CAST(floor({rem} / 3600000) AS INT), "
        f"CAST(floor(({rem} % 3600000) / 60000) AS INT), CAST(floor(({rem} % 60000) / 1000) AS INT))"
    )
    frac = f"({rem} % 1000)"
    fraction = f"(CASE WHEN {frac} = 0 THEN '' ELSE format_string('.%03d000', CAST({frac} AS INT)) END)"
    return f"concat(date_format(date_from_unix_date({day}), 'yyyy-MM-dd'), 'T', {clock}, {fraction}, 'Z')"


def normalize(
    df: DataFrame,
    contracts: Any,
    *,
    value_col: str = "value",
    keep: Sequence[str] = (),
    output: str = "columns",
    type_hints: Mapping[str, str] | None = None,
    with_reason: bool = False,
) -> DataFrame:
    """Normalize raw envelopes by contract. ``value_col`` holds each envelope as
    JSON text (a Kafka value), or as a VARIANT / struct when it comes from an
    in-process raw layer (then nothing is parsed).

    ``output``:
      * ``"columns"`` – the nine envelope columns + ``attributes`` (tail as JSON);
      * ``"json"`` – the above + ``value``, the whole normalized event as JSON;
      * ``"wide"`` – the envelope + one column per tail field of any contract
        (VARIANT, or typed by the contracts' ``column_types`` / ``type_hints``),
        NULL where the row's event type does not declare the field.

    ``keep`` passes input columns through (e.g. Kafka partition/offset).
    ``with_reason=True`` returns every row with ``reason`` (NULL = normalized)
    and, for rejected rows, ``raw_value`` (the original message); otherwise
    only normalized rows.
    """
    if output not in ("columns", "json", "wide"):
        raise ValueError(f"unknown output {output!r}")
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    resolved = as_contracts(contracts)
    for c in resolved.values():
        for warning in c.lint():
            log.warning(warning)
    plan = ContractPlan(resolved)
    keep = [ident(c) for c in keep]

    # 1. one parse per message (none when the envelope already is a VARIANT or a struct)
    vtype_ = df.schema[value_col].dataType
    if isinstance(vtype_, T.VariantType):
        s1 = df.selectExpr(*keep, f"to_json({ident(value_col)}) AS _value", f"{ident(value_col)} AS _doc")
    elif isinstance(vtype_, (T.StructType, T.MapType)):
        s1 = df.selectExpr(*keep, f"to_json({ident(value_col)}) AS _value",
                           f"to_variant_object({ident(value_col)}) AS _doc")
    else:
        v = f"CAST({ident(value_col)} AS STRING)"
        s1 = df.selectExpr(*keep, f"{v} AS _value", f"try_parse_json({v}) AS _doc")

    # 2. raw envelope (N1): extract once, then type-check the extracted columns
    s2 = s1.selectExpr(
        *keep, "_value", "_doc IS NOT NULL AS _parsed",
        *[f"{vget_sql('_doc', [f])} AS _r_{f}" for f in RAW_STRING_FIELDS],
        f"{vget_sql('_doc', ['schema_version'])} AS _r_schema_version",
        f"{vget_sql('_doc', ['payload'])} AS payload",
    )
    n1 = " AND ".join(
        ["_parsed", is_object_sql("payload"), f"NOT {coerce_int_sql('_r_schema_version').error}"]
        + [is_json_string_sql(f"_r_{f}") for f in RAW_STRING_FIELDS]
    )
    s3 = s2.selectExpr(
        *keep, "_value",
        *[f"try_cast(_r_{f} AS STRING) AS _{f}" for f in RAW_STRING_FIELDS],
        f"coalesce({n1}, false) AS _n1_ok",
        "payload",
    )

    # 3. routing (N2, P10-P12); ingestion time (E3) and rule timestamps
    #    are parsed in staged projections, once per distinct path
    s3 = s3.selectExpr(
        "*", f"CASE WHEN _n1_ok THEN {plan.branch_id_sql('_source', '_source_event_type')} END AS _b"
    )
    ts_paths = plan.timestamp_paths()
    ts_names = {p: f"_ts{i}" for i, p in enumerate(ts_paths)}
    # a timestamp is read and parsed only for rows whose branch has the rule
    ts_inputs = {"_ing": "CASE WHEN _b IS NOT NULL THEN _observed_at END"}
    for path, bids in ts_paths.items():
        ts_inputs[ts_names[path]] = f"CASE WHEN {in_list('_b', bids)} THEN {vget_sql('payload', path)} END"
    ts_modes = {n: ("to_millis" if n == "_ing" else "rule") for n in ts_inputs}
    s3 = with_iso_millis(s3, ts_inputs, mode=ts_modes)

    # 4. rules (P1-P9), each compiled once and picked per branch
    def resolve(expression: str) -> tuple[str, str]:
        error, dtype = check_expression(s3, expression)
        return variant_of_sql(f"({expression})", dtype), error

    def timestamps(path: tuple) -> tuple[str, str]:
        n = ts_names[path]
        return f"{n}_ms", f"{n}_err"

    plan.bind("payload", resolve, timestamps)
    lambda_rules = plan.lambda_rules()
    if lambda_rules:
        # a projection of their own, each only for rows of a branch that has the rule; the stage is pinned,
        # so the rules below stay in fused code (see eventloom.plans.pinning)
        # rules that fail alike (they read one array, say) share the column of the error
        hcols, cols, errors = {}, [], {}
        for i, r in enumerate(lambda_rules):
            rule, mine = plan.compiled(r), plan.branches_of(r)
            cols.append(f"CASE WHEN {in_list('_b', mine)} THEN {rule.value} END AS _h{i}")
            if rule.can_fail:
                errors.setdefault(rule.error, (f"_he{i}", set()))[1].update(mine)
            hcols[rule_key(r)] = (f"_h{i}", errors[rule.error][0] if rule.can_fail else "false")
        cols += [f"CASE WHEN {in_list('_b', bids)} THEN {error} ELSE false END AS {name}" for error, (name, bids) in errors.items()]
        s3 = pinned_stage(s3.selectExpr("*", *cols))
        plan.precompute(hcols)
    names = plan.all_fields()
    fcol = {n: f"_f{i}" for i, n in enumerate(names)}
    s4 = s3.selectExpr(
        *keep, "_value", *[f"_{f}" for f in RAW_STRING_FIELDS], "_n1_ok", "_b",
        "_ing_ms AS _ingested_ms", "_ing_err AS _ingested_err",
        *[f"{plan.field_sql(n, '_b')} AS {fcol[n]}" for n in names],
        f"{plan.rule_error_sql('_b')} AS _rule_err",
    )

    # 5. normalized envelope checks (E5) and row errors
    def fv(name: str) -> str:
        return fcol.get(name, "CAST(NULL AS VARIANT)")

    et = coerce_int_sql(fv("event_time"))
    bad = (
        f"_rule_err OR _ingested_err OR NOT {is_json_string_sql(fv('partition_key'))} "
        f"OR NOT {is_json_string_sql(fv('entity_name'))} OR {et.error}"
    )
    reason = (
        f"CASE WHEN NOT _n1_ok THEN '{REASON_MALFORMED}' WHEN _b IS NULL THEN '{REASON_UNKNOWN_SOURCE}' "
        f"WHEN coalesce({bad}, true) THEN '{REASON_NORMALIZE_ERROR}' END"
    )
    # the reason gets its own projection, and filters on it - here or by the
    # caller - stay on top of it (see eventloom.plans.pinning: pushing them
    # down would copy every rule into the predicate)
    s5 = s4.selectExpr("*", f"{et.value} AS _event_time", f"{reason} AS reason")
    s5 = pinned_stage(s5) if with_reason else filter_here(s5, "reason IS NULL")

    # 6. output projection
    fixed = {
        "source": "_source",
        "event_id": "_source_event_id",
        "event_type": "_source_event_type",
        "ingested_at": "timestamp_millis(_ingested_ms)",
        "schema_version": f"CAST({NORMALIZED_SCHEMA_VERSION} AS INT)",
        "partition_key": f"try_cast({fv('partition_key')} AS STRING)",
        "entity_id": py_str_sql(fv("entity_id"), missing="None"),
        "entity_name": f"try_cast({fv('entity_name')} AS STRING)",
        "event_time": "_event_time",
    }
    cols = [f"{fixed[c]} AS {c}" for c in NORMALIZED_COLUMNS]

    def named_struct(pairs: list[tuple[str, str]]) -> str:
        return "named_struct(" + ", ".join(f"{sql_str(k)}, {e}" for k, e in pairs) + ")"

    if output in ("columns", "json"):
        def attrs(branch) -> str:
            if not branch.tail:
                return "'{}'"
            return to_json_keep_nulls_sql(named_struct([(n, fv(n)) for n in branch.tail]))

        cols.append(f"{plan.per_branch_sql('_b', attrs)} AS attributes")
    if output == "json":
        envelope = dict(fixed, ingested_at=millis_to_iso_utc_sql("_ingested_ms"))
        cols.append(to_json_keep_nulls_sql(named_struct([(c, envelope[c]) for c in NORMALIZED_COLUMNS])) + " AS _envelope")
    if output == "wide":
        hints = {k: v for c in resolved.values() for k, v in c.column_types.items()}
        hints.update(type_hints or {})
        for n in plan.tail_fields():
            if n in NORMALIZED_COLUMNS:
                continue
            expr = f"try_variant_get({fv(n)}, '$', {sql_str(hints[n])})" if n in hints else fv(n)
            cols.append(f"{expr} AS {ident(n)}")

    # the original message is kept for rejected rows only (accepted rows are the normalized event)
    out = s5.selectExpr(*keep, *cols, "reason", "CASE WHEN reason IS NOT NULL THEN _value END AS raw_value")
    if output == "json":
        # the document is the envelope's object followed by the tail's: both are built once, not once per branch
        both = "concat(substr(_envelope, 1, length(_envelope) - 1), ',', substr(attributes, 2))"
        doc = f"CASE WHEN reason IS NULL THEN CASE WHEN attributes = '{{}}' THEN _envelope ELSE {both} END END AS value"
        out = out.selectExpr(*[ident(c) for c in out.columns if c not in ("_envelope", "reason", "raw_value")], doc, "reason", "raw_value")
    if with_reason:
        return out
    return out.drop("reason", "raw_value")


def quarantine(df: DataFrame, contracts: Any, *, value_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Only the rejected rows: ``keep`` columns, ``reason`` and ``raw_value``."""
    out = normalize(df, contracts, value_col=value_col, keep=keep, with_reason=True)
    return filter_here(out, "reason IS NOT NULL").select(*keep, "reason", "raw_value")
