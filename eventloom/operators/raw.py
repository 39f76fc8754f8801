"""API events -> raw envelopes (S1 page explode, R1-R7).

An API event is an open JSON object; the source registry says where its id and
type live (dotted paths). The raw envelope is the fixed record

    source, source_event_id, source_event_endpoint, source_event_type,
    observed_at, schema_version, payload

whose payload is the event with top-level ``id`` and ``type`` replaced by the
stringified id and type. Everything is one narrow projection.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.functions.variant import as_array, ident, py_str_sql, to_json_keep_nulls, vget_sql
from eventloom.plans.pinning import filter_here

if TYPE_CHECKING:
    from eventloom.sources.registry import SourceConfig

RAW_SCHEMA_VERSION = 1
RAW_COLUMNS = (
    "source",
    "source_event_id",
    "source_event_endpoint",
    "source_event_type",
    "observed_at",
    "schema_version",
    "payload",
)
REASON_INVALID_EVENT = "invalid_event"
REASON_MALFORMED_PAGE = "malformed_page"


def _as_variant(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.VariantType):
        return F.col(name)
    if isinstance(dtype, T.StringType):
        return F.try_parse_json(F.col(name))
    return F.to_variant_object(F.col(name)) if isinstance(dtype, (T.StructType, T.MapType, T.ArrayType)) else F.col(name).cast("variant")


def explode_pages(
    df: DataFrame, page_col: str = "value", *, keep: Sequence[str] = (), raw_col: str | None = None
) -> DataFrame:
    """One row per element of a JSON-array page, with ``page_pos`` (0-based).

    An empty page yields no rows. A page that is not a JSON array yields one
    row with ``reason = 'malformed_page'`` and a NULL ``event`` (quarantine),
    so one bad page never fails the batch; ``raw_col`` then names a column that
    holds its text.
    """
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    keep = list(keep)
    page = _as_variant(df, page_col)
    raw = [F.col(page_col).cast("string").alias("_page")] if raw_col else []
    s1 = df.select(*keep, *raw, as_array(page).alias("_arr"))
    ok = F.col("_arr").isNotNull()
    items = F.when(ok, F.col("_arr")).otherwise(F.array(F.lit(None).cast("variant")))
    return s1.select(
        *keep,
        F.posexplode(items).alias("page_pos", "event"),
        F.when(~ok, F.lit(REASON_MALFORMED_PAGE)).alias("reason"),
        *([F.when(~ok, F.col("_page")).alias(raw_col)] if raw_col else []),
    )


def utc_now_iso() -> Column:
    """``observed_at`` (R6): processing time as ISO-8601 with ``+00:00``, microsecond precision."""
    us = F.unix_micros(F.current_timestamp())
    day = F.floor(us / F.lit(86_400_000_000)).cast("int")
    rem = us - day.cast("long") * 86_400_000_000
    clock = F.format_string(
        "%02d:%02d:%02d",
        F.floor(rem / 3_600_000_000).cast("int"),
        F.floor((rem % 3_600_000_000) / 60_000_000).cast("int"),
        F.floor((rem % 60_000_000) / 1_000_000).cast("int"),
    )
    frac = rem % 1_000_000
    fraction = F.when(frac == 0, F.lit("")).otherwise(F.format_string(".%06d", frac.cast("int")))
    return F.concat(F.date_format(F.date_from_unix_date(day), "yyyy-MM-dd"), F.lit("T"), clock, fraction, F.lit("+00:00"))


def build_raw_events(
    df: DataFrame,
    config: "SourceConfig",
    *,
    event_col: str = "event",
    observed_at: str | Column | None = None,
    keep: Sequence[str] = (),
    with_reason: bool = False,
    encode: bool = False,
) -> DataFrame:
    """R1-R7 over a column of API events (JSON text or VARIANT).

    * R1: id / type by strict dotted path (missing step or non-object -> invalid;
      a present JSON null is valid and stringifies to ``"None"``);
    * R2: ``str()`` of id and type;
    * R3: invalid rows (not an object, id or type unresolved) get
      ``reason = 'invalid_event'``; they are dropped unless ``with_reason``;
    * R4: payload = event with top-level ``id``/``type`` set to those strings;
    * R5: constant ``source``, ``source_event_endpoint``, ``schema_version``;
    * R6: ``observed_at`` = processing time (or the given literal / column);
    * R7: ``encode=True`` adds ``value``, the envelope as JSON.

    An incoming ``reason`` column (e.g. from :func:`explode_pages`) is kept.
    """
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    keep = list(keep)
    prior = F.col("reason") if "reason" in df.columns else F.lit(None).cast("string")
    s1 = df.select(*keep, _as_variant(df, event_col).alias("_ev"), prior.alias("_prior"))
    s2 = s1.selectExpr(
        *[ident(c) for c in keep], "_prior",
        "try_cast(_ev AS MAP<STRING, VARIANT>) AS _m",
        f"{vget_sql('_ev', config.id_path)} AS _idv",
        f"{vget_sql('_ev', config.type_path)} AS _typev",
    )
    s2 = s2.selectExpr(
        *[ident(c) for c in keep], "_prior", "_m",
        f"{py_str_sql('_idv', missing=None)} AS _id",
        f"{py_str_sql('_typev', missing=None)} AS _type",
    )
    valid = F.col("_m").isNotNull() & F.col("_id").isNotNull() & F.col("_type").isNotNull()
    overlay = F.map_concat(
        F.map_filter(F.col("_m"), lambda k, _: ~k.isin("id", "type")),
        F.create_map(F.lit("id"), F.col("_id").cast("variant"), F.lit("type"), F.col("_type").cast("variant")),
    )
    if observed_at is None:
        obs = utc_now_iso()
    elif isinstance(observed_at, Column):
        obs = observed_at
    else:
        obs = F.lit(observed_at)
    envelope = {
        "source": F.lit(config.source),
        "source_event_id": F.col("_id"),
        "source_event_endpoint": F.lit(config.endpoint),
        "source_event_type": F.col("_type"),
        "observed_at": obs,
        "schema_version": F.lit(RAW_SCHEMA_VERSION).cast("int"),
        "payload": F.to_variant_object(overlay),
    }
    reason = F.coalesce(F.col("_prior"), F.when(~F.coalesce(valid, F.lit(False)), F.lit(REASON_INVALID_EVENT)))
    cols = [F.when(reason.isNull(), envelope[c]).alias(c) for c in RAW_COLUMNS]
    out = s2.select(*keep, *cols, reason.alias("reason"))
    if encode:
        out = out.withColumn("value", encode_raw(F.col("reason").isNull()))
    if with_reason:
        return out
    return filter_here(out, "reason IS NULL").drop("reason")


def encode_raw(when: Column | None = None) -> Column:
    """The raw envelope columns as one JSON document (nulls kept)."""
    doc = to_json_keep_nulls(F.struct(*[F.col(c) for c in RAW_COLUMNS]))
    return doc if when is None else F.when(when, doc)


def envelope_variant() -> Column:
    """The raw envelope as one VARIANT, for handing to ``normalize`` in-process
    (no JSON text in between)."""
    return F.to_variant_object(F.struct(*[F.col(c) for c in RAW_COLUMNS]))
