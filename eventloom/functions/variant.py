"""Expression builders over ``VARIANT`` values.

Each helper exists twice: ``*_sql`` returns Spark SQL text (the compiler
assembles whole projections from these and hands them to ``selectExpr`` in
one call, so plan building does not pay one JVM round trip per expression
node), and the plain name returns a :class:`Column` built from that text.
Everything stays inside Catalyst and whole-stage codegen; nothing here runs
Python per row.

Null handling: a VARIANT can be SQL NULL (key absent, path unresolvable) or
hold a JSON ``null``. The contract language treats both as "null", so
:func:`is_absent` collapses them. Only the raw layer (R1/R2) tells them apart.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sql_str(s: str) -> str:
    """A Spark SQL string literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _e(x: str | Column) -> str:
    if isinstance(x, Column):
        raise TypeError("SQL builders take SQL text; use the Column helpers for Columns")
    return x


def json_path(steps: Sequence[str]) -> str:
    """``['a', 'b']`` -> ``$["a"]["b"]`` (bracket form: keys may hold any char but quotes)."""
    for s in steps:
        if '"' in s or "\\" in s:
            raise ValueError(f"path step {s!r} may not contain quotes or backslashes")
    return "$" + "".join(f'["{s}"]' for s in steps)


# -- SQL text builders -------------------------------------------------------

def vget_sql(v: str, steps: Sequence[str]) -> str:
    """Lenient path lookup: SQL NULL for a missing key or a step through a non-object."""
    if not steps:
        return _e(v)
    return f"try_variant_get({v}, {sql_str(json_path(steps))}, 'variant')"


def is_absent_sql(v: str) -> str:
    return f"coalesce(({v}) IS NULL OR is_variant_null({v}), true)"


def present_sql(v: str) -> str:
    return f"(NOT {is_absent_sql(v)})"


def is_json_string_sql(v: str) -> str:
    return f"coalesce(schema_of_variant({v}) = 'STRING', false)"


def is_object_sql(v: str) -> str:
    """Cheap object test: the cast to a one-field struct looks up a single key."""
    return f"(try_cast({v} AS STRUCT<__k: VARIANT>) IS NOT NULL)"


def as_array_sql(v: str) -> str:
    return f"try_cast({v} AS ARRAY<VARIANT>)"


def is_falsy_sql(v: str) -> str:
    """JMESPath falsiness: null, false, "", [], {} are false; 0 is true."""
    return f"({is_absent_sql(v)} OR coalesce(to_json({v}) IN ('false', '\"\"', '[]', '{{}}'), false))"


def json_literal_sql(value: Any) -> str:
    return f"parse_json({sql_str(json.dumps(value))})"


def py_str_sql(v: str, missing: str | None = "None") -> str:
    """``str()`` of a JSON value as Python prints it: JSON null -> ``None``,
    booleans -> ``True``/``False``, strings as is, numbers in Spark's spelling,
    objects/arrays as JSON text. SQL NULL (absent) -> ``missing``."""
    t = f"schema_of_variant({v})"
    body = (
        f"CASE WHEN is_variant_null({v}) THEN 'None' "
        f"WHEN {t} = 'BOOLEAN' THEN initcap(try_cast({v} AS STRING)) "
        f"WHEN {t} LIKE 'OBJECT%' OR {t} LIKE 'ARRAY%' THEN to_json({v}) "
        f"ELSE try_cast({v} AS STRING) END"
    )
    if missing is None:
        return f"(CASE WHEN ({v}) IS NULL THEN NULL ELSE {body} END)"
    return f"(CASE WHEN ({v}) IS NULL THEN {sql_str(missing)} ELSE {body} END)"


def to_json_keep_nulls_sql(x: str) -> str:
    return f"to_json({x}, map('ignoreNullFields', 'false'))"


def flatten_one_sql(v: str, var: str = "__e") -> str:
    """JMESPath ``x[]``: an array with nested arrays spliced in one level; non-array -> NULL."""
    return f"flatten(transform({as_array_sql(v)}, {var} -> coalesce({as_array_sql(var)}, array({var}))))"


def pluck_sql(v: str, take: Sequence[str], path: Sequence[str] = ()) -> str:
    """JMESPath ``from[].take`` of the value below ``path``: flatten one level, read ``take`` from each
    element, drop nulls. Not an array (or absent) -> NULL; ``[]`` -> ``[]``.
    Result type ``array<variant>``.

    An array of objects only, the common case, is read as structs of the one field: no element is copied whole. Any other
    element is a null struct, and the array then takes the general way."""
    picked = f"transform({flatten_one_sql(vget_sql(v, path))}, __p -> {vget_sql('__p', take)})"
    general = f"filter({picked}, __x -> {present_sql('__x')})"
    if not take:
        return general
    kind, field = "variant", "__o"
    for step in reversed(take):
        kind = f"struct<{ident(step)}: {kind}>"
    for step in take:
        field += f".{ident(step)}"
    structs = f"try_variant_get({v}, {sql_str(json_path(path))}, {sql_str(f'array<{kind}>')})"
    plain = f"filter(transform(__a, __o -> {field}), __x -> {present_sql('__x')})"
    # a lambda over the one array binds it: it is read once
    return f"get(transform(array({structs}), __a -> CASE WHEN forall(__a, __o -> __o IS NOT NULL) THEN {plain} ELSE {general} END), 0)"


def select_keys_sql(v: str, keys: Sequence[str]) -> str:
    """JMESPath ``from[].{k: k, ...}``: array -> array of structs with the chosen
    keys (missing keys null, null elements dropped); not an array -> NULL."""
    kept = f"filter({flatten_one_sql(v)}, __s -> {present_sql('__s')})"
    fields = ", ".join(f"{sql_str(k)}, {vget_sql('__s', [k])}" for k in keys)
    return f"transform({kept}, __s -> named_struct({fields}))"


def variant_of_sql(expr: str, dtype: T.DataType) -> str:
    """Wrap an expression of type ``dtype`` as VARIANT."""
    if isinstance(dtype, T.VariantType):
        return expr
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return f"to_variant_object({expr})"
    if isinstance(dtype, T.NullType):
        return "CAST(NULL AS VARIANT)"
    return f"CAST({expr} AS VARIANT)"


# -- Column API ----------------------------------------------------------------

def vget(v: Column, steps: Sequence[str]) -> Column:
    if not steps:
        return v
    return F.try_variant_get(v, json_path(steps), "variant")


def is_absent(v: Column) -> Column:
    return F.coalesce(v.isNull() | F.is_variant_null(v), F.lit(True))


def present(v: Column) -> Column:
    return ~is_absent(v)


def vtype(v: Column) -> Column:
    """Spark type name of a variant (``STRING``, ``BIGINT``, ``DECIMAL(p,s)``, ...)."""
    return F.schema_of_variant(v)


def is_json_string(v: Column) -> Column:
    return F.coalesce(vtype(v) == "STRING", F.lit(False))


def is_object(v: Column) -> Column:
    return F.coalesce(v.try_cast("struct<__k: variant>").isNotNull(), F.lit(False))


def as_array(v: Column) -> Column:
    return v.try_cast("array<variant>")


def json_literal(value: Any) -> Column:
    return F.expr(json_literal_sql(value))


def to_json_keep_nulls(c: Column) -> Column:
    return F.to_json(c, {"ignoreNullFields": "false"})


def py_str(v: str, missing: str | None = "None") -> Column:
    """Column form of :func:`py_str_sql`; ``v`` is SQL text (e.g. a column name)."""
    return F.expr(py_str_sql(v, missing))


def pluck(v: str, take: Sequence[str]) -> Column:
    return F.expr(pluck_sql(v, take))


def select_keys(v: str, keys: Sequence[str]) -> Column:
    return F.expr(select_keys_sql(v, keys))
