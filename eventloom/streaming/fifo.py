"""D2 in Structured Streaming: the bounded FIFO memory as per-scope state.

State per (source, endpoint) is the ordered list of the last ``max_size``
accepted ids (at most 120 by default), committed with each micro-batch in the
checkpoint, so a restart or a lost executor resumes with the same memory and
a failed sink write is replayed. Rows of one scope within a micro-batch are
put in arrival order before the memory runs over them, so one task holds the
micro-batch of a scope: the jobs bound it by a rate limit at the source.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from eventloom.operators.dedupe import DEFAULT_ID, DEFAULT_MEMORY, DEFAULT_SCOPE, AcceptCounter

STATE_SCHEMA = "ids array<string>"

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _variants_as(df: DataFrame, names: list[str], change) -> DataFrame:
    return df.select(*[change(F.col(c)).alias(c) if c in names else F.col(c) for c in df.columns])


def mark_fifo_stream(
    df: DataFrame,
    max_size: int = DEFAULT_MEMORY,
    scope: Sequence[str] = DEFAULT_SCOPE,
    id_col: str = DEFAULT_ID,
    order: Sequence[str] = ("seq",),
) -> DataFrame:
    """All rows of a streaming DataFrame with ``is_duplicate`` under the FIFO memory rule. Rows
    that already bear a ``reason`` pass through unseen by the memory."""
    scope, order = list(scope), list(order)
    variants = [f.name for f in df.schema.fields if isinstance(f.dataType, T.VariantType)]
    enc = _variants_as(df, variants, F.to_json)
    schema = T.StructType([*enc.schema.fields, T.StructField("is_duplicate", T.BooleanType())])
    with_reason = "reason" in df.columns

    def step(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        chunks = [b for b in batches if len(b)]
        if not chunks:
            return
        batch = pd.concat(chunks, ignore_index=True).sort_values(order, kind="stable")
        live = batch["reason"].isna() if with_reason else pd.Series(True, index=batch.index)
        if batch.loc[live].duplicated(order).any():
            raise ValueError("two rows of one scope have the same arrival order")
        counter = AcceptCounter(max_size, list(state.get[0]) if state.exists else [])
        flags = [bool(ok) and counter.take(v) is False for v, ok in zip(batch[id_col].astype(str), live, strict=True)]
        state.update((counter.memory(),))
        yield batch.assign(is_duplicate=flags)

    out = enc.groupBy(*scope).applyInPandasWithState(
        step, schema, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout
    )
    return _variants_as(out, variants, F.parse_json)


def dedupe_fifo_stream(df: DataFrame, *args, **kw) -> DataFrame:
    """The accepted rows (see :func:`mark_fifo_stream`)."""
    return mark_fifo_stream(df, *args, **kw).where("NOT is_duplicate").drop("is_duplicate")
