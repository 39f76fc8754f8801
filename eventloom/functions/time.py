"""ISO-8601 and epoch conversions (F1 ``iso_to_millis``, F2 ``to_millis``).

The parser is a regular expression plus integer arithmetic, all JVM-side.
It follows the grammar of Python's ``datetime.fromisoformat`` (3.11+), which
is what contracts are written against:

* date ``YYYY-MM-DD`` or ``YYYYMMDD`` (week and ordinal dates are rejected);
* optional time after any single separator character: ``HH``, ``HH:MM``,
  ``HH:MM:SS``, ``HHMM``, ``HHMMSS`` (separators not mixed), then an optional
  seconds fraction ``.f``/``,f`` of any length (digits past the sixth ignored);
* optional offset ``Z``, ``±HH``, ``±HH:MM``, ``±HHMM``, ``±HH:MM:SS[.f]``;
* a naive value is UTC; the result is epoch milliseconds, truncated toward zero.

Results never depend on ``spark.sql.session.timeZone``. The common layout
(``yyyy-MM-ddTHH:mm:ss[.ffffff]`` plus ``Z`` or ``±HH:MM``) is read by Spark's
own timestamp parser; only other spellings go through the regular expression.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.variant import is_absent_sql, sql_str

# Fixed grammar (see module docstring).
# date: extended or basic; time: HH, then MM and SS either all with ':' or all without;
# a fraction may follow the last component and counts as a fraction of a second.
_DATE = r"(\d{4}-\d{2}-\d{2}|\d{8})"
_TIME = r"(\d{2})(?:(?::(\d{2})(?::(\d{2}))?)|(?:(\d{2})(\d{2})?))?(?:[.,](\d+))?"
_ZONE = r"(Z|[+-]\d{2}(?:(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?)|(?:\d{2}(?:\d{2}(?:[.,]\d+)?)?))?)?"
ISO_PATTERN = "^" + _DATE + "(?:." + _TIME + _ZONE + ")?$"
OFFSET_PATTERN = (r"^([+-])(\d{2})(?:(?::(\d{2})(?::(\d{2})(?:[.,](\d+))?)?)"
                  r"|(?:(\d{2})(?:(\d{2})(?:[.,](\d+))?)?))?$")
# the common layout, read by Spark's own parser first; anything else takes the regex path
FAST_PATTERN = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX"
# replacement templates: date|HH|MM|SS|fraction|zone and sign|HH|MM|SS|fraction
_ISO_PARTS = "$1|$2|$3$5|$4$6|$7|$8"
_OFF_PARTS = "$1|$2|$3$6|$4$7|$5$8"

_ISO = sql_str(ISO_PATTERN)
_OFF = sql_str(OFFSET_PATTERN)
_BAR = sql_str(r"\|")  # an escaped single char: Java's split fast path, no regex compile per row


@dataclass(frozen=True)
class Checked:
    """A value and a row-error flag (never NULL), as SQL text."""

    value: str
    error: str

    def columns(self) -> tuple[Column, Column]:
        return F.expr(self.value), F.expr(self.error)


def _int(s: str) -> str:
    return f"coalesce(try_cast(nullif({s}, '') AS BIGINT), 0L)"


def _frac_us(s: str) -> str:
    return f"coalesce(try_cast(rpad(substring(nullif({s}, ''), 1, 6), 6, '0') AS BIGINT), 0L)"


def trunc_div_1000_sql(us: str) -> str:
    """Exact integer division truncating toward zero (Python's ``int()``)."""
    return f"CAST(CAST({us} AS DECIMAL(20,0)) / 1000 AS BIGINT)"


def parts_sql(s: str) -> str:
    return f"split(regexp_replace({s}, {_ISO}, '{_ISO_PARTS}'), {_BAR})"


def matches_sql(s: str) -> str:
    return f"coalesce({s} RLIKE {_ISO}, false)"


def zone_parts_sql(p: str) -> str:
    return f"split(regexp_replace(get({p}, 5), {_OFF}, '{_OFF_PARTS}'), {_BAR})"


def zone_is_offset_sql(p: str) -> str:
    return f"coalesce(get({p}, 5) RLIKE {_OFF}, false)"


def micros_from_parts_sql(ok: str, p: str, zo: str, z: str) -> Checked:
    """Epoch microseconds from the split pieces; ``error`` when the text does not
    match or a field is out of range."""
    day = f"try_to_date(replace(get({p}, 0), '-', ''), 'yyyyMMdd')"
    hh, mi, ss = _int(f"get({p}, 1)"), _int(f"get({p}, 2)"), _int(f"get({p}, 3)")
    frac = _frac_us(f"get({p}, 4)")
    zsign = f"(CASE WHEN get({z}, 0) = '-' THEN -1 ELSE 1 END)"
    zh, zm, zs = _int(f"get({z}, 1)"), _int(f"get({z}, 2)"), _int(f"get({z}, 3)")
    zf = _frac_us(f"get({z}, 4)")
    offset = f"(CASE WHEN {zo} THEN {zsign} * ((({zh} * 60 + {zm}) * 60 + {zs}) * 1000000 + {zf}) ELSE 0L END)"
    valid = (
        f"coalesce({ok} AND {day} IS NOT NULL AND {hh} <= 23 AND {mi} <= 59 AND {ss} <= 59 "
        f"AND (NOT {zo} OR ({zh} <= 23 AND {zm} <= 59 AND {zs} <= 59)), false)"
    )
    micros = (
        f"(CAST(unix_date({day}) AS BIGINT) * 86400000000L + (({hh} * 60 + {mi}) * 60 + {ss}) * 1000000L "
        f"+ {frac} - {offset})"
    )
    return Checked(f"(CASE WHEN {valid} THEN {micros} END)", f"(NOT {valid})")


def iso_micros_sql(s: str) -> Checked:
    """Single-expression parse of a string (inlines the split; fine for a few columns)."""
    p = parts_sql(s)
    return micros_from_parts_sql(matches_sql(s), p, zone_is_offset_sql(p), zone_parts_sql(p))


def iso_to_millis_sql(v: str) -> Checked:
    """F1 over a VARIANT: null/absent/``""`` -> NULL; other strings must parse;
    any non-string JSON value is an error."""
    s = f"(CASE WHEN schema_of_variant({v}) = 'STRING' THEN try_cast({v} AS STRING) END)"
    parsed = iso_micros_sql(s)
    absent = is_absent_sql(v)
    is_str = f"coalesce(schema_of_variant({v}) = 'STRING', false)"
    empty = f"({is_str} AND {s} = '')"
    value = f"(CASE WHEN NOT {absent} AND {is_str} AND NOT {empty} THEN {trunc_div_1000_sql(parsed.value)} END)"
    error = f"coalesce(NOT {absent} AND (NOT {is_str} OR (NOT {empty} AND {parsed.error})), false)"
    return Checked(value, error)


def to_millis_sql(v: str) -> Checked:
    """F2 over a VARIANT: null -> 0; a number with ``|x| > 1e11`` is already
    milliseconds, otherwise seconds (``x * 1000``, truncated); booleans count
    as 0/1 seconds; strings are ISO-8601 (every ``Z`` read as ``+00:00``);
    objects and arrays are errors."""
    t = f"schema_of_variant({v})"
    is_num = f"({t} IN ('BIGINT', 'INT', 'SMALLINT', 'TINYINT', 'DOUBLE', 'FLOAT') OR {t} LIKE 'DECIMAL%')"
    num = f"try_cast({v} AS DECIMAL(38,6))"
    dbl = f"try_cast({v} AS DOUBLE)"
    num_ms = f"CAST(CASE WHEN abs({num}) > 1e11 THEN {num} ELSE {num} * 1000 END AS BIGINT)"
    dbl_ms = f"CAST(CASE WHEN abs({dbl}) > 1e11 THEN {dbl} ELSE {dbl} * 1000 END AS BIGINT)"
    s = f"replace(try_cast({v} AS STRING), 'Z', '+00:00')"
    parsed = iso_micros_sql(s)
    value = (
        f"(CASE WHEN {is_absent_sql(v)} THEN 0L "
        f"WHEN {t} = 'BOOLEAN' THEN CASE WHEN try_cast({v} AS BOOLEAN) THEN 1000L ELSE 0L END "
        f"WHEN {is_num} THEN coalesce({num_ms}, {dbl_ms}) "
        f"WHEN {t} = 'STRING' THEN {trunc_div_1000_sql(parsed.value)} END)"
    )
    error = (
        f"coalesce(NOT {is_absent_sql(v)} AND {t} <> 'BOOLEAN' AND NOT {is_num} "
        f"AND ({t} <> 'STRING' OR {parsed.error}), false)"
    )
    return Checked(value, error)


def to_millis_string_sql(s: str) -> Checked:
    """F2 for a STRING column: NULL -> 0, else ISO-8601 (``Z`` read as ``+00:00``)."""
    parsed = iso_micros_sql(f"replace({s}, 'Z', '+00:00')")
    return Checked(
        f"(CASE WHEN {s} IS NULL THEN 0L ELSE {trunc_div_1000_sql(parsed.value)} END)",
        f"coalesce({s} IS NOT NULL AND {parsed.error}, false)",
    )


def to_millis_timestamp_sql(ts: str, naive: bool = True) -> str:
    """F2 for TIMESTAMP_NTZ (``naive``, read as UTC) or TIMESTAMP: epoch ms, NULL -> 0."""
    if naive:
        us = iso_micros_sql(f"date_format({ts}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")").value
    else:
        us = f"unix_micros({ts})"
    return f"coalesce({trunc_div_1000_sql(us)}, 0L)"


def with_iso_millis(df: DataFrame, inputs: dict[str, str], mode: str | dict[str, str] = "rule") -> DataFrame:
    """Add ``<name>_ms`` / ``<name>_err`` for each input (SQL text) through staged
    projections (extract, type, split, offset, arithmetic), so each regular
    expression runs once per value and no stage outgrows code generation.

    ``mode="rule"``: F1 over VARIANT (absent/``""`` -> NULL, non-string -> error).
    ``mode="to_millis"``: F2 over STRING (NULL -> 0, ``Z`` read as ``+00:00``).
    ``mode`` may also map each input name to its mode.
    """
    names = list(inputs)
    modes = mode if isinstance(mode, dict) else {n: mode for n in names}
    if not names:
        return df
    base = ["`" + c + "`" for c in df.columns]
    d = df.selectExpr(*base, *[f"{inputs[n]} AS {n}__v" for n in names])
    stage = []
    for n in names:
        v = f"{n}__v"
        if modes[n] == "rule":
            stage += [f"{is_absent_sql(v)} AS {n}__a",
                      f"coalesce(schema_of_variant({v}) = 'STRING', false) AS {n}__isstr",
                      f"CASE WHEN schema_of_variant({v}) = 'STRING' THEN try_cast({v} AS STRING) END AS {n}__s"]
        else:
            stage += [f"{v} IS NULL AS {n}__a", f"true AS {n}__isstr", f"replace({v}, 'Z', '+00:00') AS {n}__s"]
    d = d.selectExpr(*base, *stage)
    # fast path: an offset-qualified extended timestamp with up to 6 fraction digits
    stage = []
    for n in names:
        stage += [f"{n}__a", f"{n}__isstr", f"{n}__s",
                  f"unix_micros(try_to_timestamp({n}__s, {sql_str(FAST_PATTERN)})) AS {n}__fast"]
    d = d.selectExpr(*base, *stage)
    # regex path, evaluated only where the fast path did not read the text
    stage = []
    for n in names:
        s, slow = f"{n}__s", f"{n}__fast IS NULL"
        stage += [f"{n}__a", f"{n}__isstr", s, f"{n}__fast",
                  f"(CASE WHEN {slow} THEN {matches_sql(s)} ELSE false END) AS {n}__ok",
                  f"(CASE WHEN {slow} THEN {parts_sql(s)} END) AS {n}__p"]
    d = d.selectExpr(*base, *stage)
    stage = []
    for n in names:
        p = f"{n}__p"
        utc = f"coalesce(get({p}, 5) IN ('', 'Z'), true)"  # no offset to parse: skip the regex
        stage += [f"{n}__a", f"{n}__isstr", f"{n}__s", f"{n}__fast", f"{n}__ok", p,
                  f"(CASE WHEN {utc} THEN false ELSE {zone_is_offset_sql(p)} END) AS {n}__zo",
                  f"(CASE WHEN {utc} THEN CAST(NULL AS ARRAY<STRING>) ELSE {zone_parts_sql(p)} END) AS {n}__z"]
    d = d.selectExpr(*base, *stage)
    # integer components in their own projection, so the checks and the
    # arithmetic below read plain columns
    stage = []
    for n in names:
        p, z, zo = f"{n}__p", f"{n}__z", f"{n}__zo"
        stage += [
            f"{n}__a", f"{n}__isstr", f"{n}__s", f"{n}__ok", f"{n}__fast", zo,
            f"unix_date(try_to_date(replace(get({p}, 0), '-', ''), 'yyyyMMdd')) AS {n}__day",
            f"{_int(f'get({p}, 1)')} AS {n}__hh", f"{_int(f'get({p}, 2)')} AS {n}__mi",
            f"{_int(f'get({p}, 3)')} AS {n}__ss", f"{_frac_us(f'get({p}, 4)')} AS {n}__fr",
            f"(CASE WHEN get({z}, 0) = '-' THEN -1 ELSE 1 END) AS {n}__zsg",
            f"{_int(f'get({z}, 1)')} AS {n}__zh", f"{_int(f'get({z}, 2)')} AS {n}__zm",
            f"{_int(f'get({z}, 3)')} AS {n}__zs", f"{_frac_us(f'get({z}, 4)')} AS {n}__zf",
        ]
    d = d.selectExpr(*base, *stage)
    stage = []
    for n in names:
        c = {k: f"{n}__{k}" for k in ("a", "isstr", "s", "ok", "zo", "day", "hh", "mi", "ss", "fr",
                                      "zsg", "zh", "zm", "zs", "zf")}
        valid = (
            f"coalesce({c['ok']} AND {c['day']} IS NOT NULL AND {c['hh']} <= 23 AND {c['mi']} <= 59 "
            f"AND {c['ss']} <= 59 AND (NOT {c['zo']} OR ({c['zh']} <= 23 AND {c['zm']} <= 59 AND {c['zs']} <= 59)), false)"
        )
        offset = (f"(CASE WHEN {c['zo']} THEN {c['zsg']} * ((({c['zh']} * 60 + {c['zm']}) * 60 + {c['zs']}) "
                  f"* 1000000 + {c['zf']}) ELSE 0L END)")
        micros = (f"(CAST({c['day']} AS BIGINT) * 86400000000L + (({c['hh']} * 60 + {c['mi']}) * 60 + {c['ss']}) "
                  f"* 1000000L + {c['fr']} - {offset})")
        stage.append(f"({n}__fast IS NOT NULL OR {valid}) AS {n}__valid")
        stage.append(f"coalesce({n}__fast, {micros}) AS {n}__us")
        stage += [c["a"], c["isstr"], c["s"]]
    d = d.selectExpr(*base, *stage)
    stage = []
    for n in names:
        a, is_str, s_, ok, us = f"{n}__a", f"{n}__isstr", f"{n}__s", f"{n}__valid", f"{n}__us"
        ms = trunc_div_1000_sql(us)
        if modes[n] == "rule":
            empty = f"({is_str} AND {s_} = '')"
            value = f"CASE WHEN NOT {a} AND {is_str} AND NOT {empty} AND {ok} THEN {ms} END"
            error = f"coalesce(NOT {a} AND (NOT {is_str} OR (NOT {empty} AND NOT {ok})), false)"
        else:
            value = f"CASE WHEN {a} THEN 0L WHEN {ok} THEN {ms} END"
            error = f"coalesce(NOT {a} AND NOT {ok}, false)"
        stage += [f"{value} AS {n}_ms", f"{error} AS {n}_err"]
    return d.selectExpr(*base, *stage)


def with_to_millis(df: DataFrame, inputs: dict[str, str]) -> DataFrame:
    """F2 over VARIANT inputs as staged projections: adds ``<name>_ms`` and
    ``<name>_err`` (see :func:`to_millis_sql` for the rules)."""
    names = list(inputs)
    base = ["`" + c + "`" for c in df.columns]
    d = df.selectExpr(*base, *[f"{inputs[n]} AS {n}__tv" for n in names])
    d = d.selectExpr(*base, *[x for n in names for x in (
        f"{n}__tv", f"schema_of_variant({n}__tv) AS {n}__tt",
        f"CASE WHEN schema_of_variant({n}__tv) = 'STRING' THEN try_cast({n}__tv AS STRING) END AS {n}__ts")])
    d = with_iso_millis(d, {f"{n}__iso": f"{n}__ts" for n in names}, mode="to_millis")
    stage = []
    for n in names:
        v, t = f"{n}__tv", f"{n}__tt"
        is_num = f"({t} IN ('BIGINT', 'INT', 'SMALLINT', 'TINYINT', 'DOUBLE', 'FLOAT') OR {t} LIKE 'DECIMAL%')"
        num = f"try_cast({v} AS DECIMAL(38,6))"
        dbl = f"try_cast({v} AS DOUBLE)"
        value = (
            f"CASE WHEN {is_absent_sql(v)} THEN 0L "
            f"WHEN {t} = 'BOOLEAN' THEN CASE WHEN try_cast({v} AS BOOLEAN) THEN 1000L ELSE 0L END "
            f"WHEN {is_num} THEN coalesce(CAST(CASE WHEN abs({num}) > 1e11 THEN {num} ELSE {num} * 1000 END AS BIGINT), "
            f"CAST(CASE WHEN abs({dbl}) > 1e11 THEN {dbl} ELSE {dbl} * 1000 END AS BIGINT)) "
            f"WHEN {t} = 'STRING' THEN {n}__iso_ms END"
        )
        error = (f"coalesce(NOT {is_absent_sql(v)} AND {t} <> 'BOOLEAN' AND NOT {is_num} "
                 f"AND ({t} <> 'STRING' OR {n}__iso_err), false)")
        stage += [f"{value} AS {n}_ms", f"{error} AS {n}_err"]
    return d.selectExpr(*base, *stage)


# -- Column API (input: SQL text such as a column name) -------------------------

def iso_to_millis(v: str) -> tuple[Column, Column]:
    return iso_to_millis_sql(v).columns()


def to_millis(v: str) -> tuple[Column, Column]:
    return to_millis_sql(v).columns()


def to_millis_string(s: str) -> tuple[Column, Column]:
    return to_millis_string_sql(s).columns()


def to_millis_timestamp(ts: str, naive: bool = True) -> Column:
    return F.expr(to_millis_timestamp_sql(ts, naive))
