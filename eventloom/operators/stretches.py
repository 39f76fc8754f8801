"""Which times of a key are accepted under a time horizon (D3), over sorted chunks, exactly.

A time is accepted if it lies at least a horizon after the last accepted one. The (key, time) rows are
range-partitioned into sorted chunks, so a key that never pauses spreads over many. What a chunk does to
a key that enters it is a function from the earliest time that may be accepted to the same behind
the chunk: constant between some bounds, as different entries soon meet in the same accepted time. A key's
functions, far smaller than its rows, are applied one after the other to get each chunk's entry;
with it each chunk is decided by itself. Keys that begin and end inside a chunk need none of this.
"""

from __future__ import annotations

import sys
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.session import stored

OPEN = -(2**63)
CHUNK_ROWS = 250_000  # narrow rows that one task of a sorted pass holds
MOST_CHUNKS = 1000  # as every chunk is a task of its own, smaller chunks than these bring nothing but messages to the driver
EFFECT = "_sk string, _chunk int, bounds array<long>, exits array<long>"

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def chunk_number(rows: int, chunk_rows: int) -> int:
    """Into how many chunks of about ``chunk_rows`` so many rows go: more than ``MOST_CHUNKS`` only if the chunks would have more than ``CHUNK_ROWS``."""
    return max(1, min(-(-rows // chunk_rows), max(MOST_CHUNKS, -(-rows // CHUNK_ROWS))))


def heads(keys: pa.ChunkedArray) -> list[int]:
    """Where each key of sorted rows begins, and the end."""
    n = len(keys)
    if not n:
        return [0]
    changes = pc.not_equal(keys[1:], keys[:-1]).to_numpy()
    return [0, *(np.flatnonzero(changes) + 1).tolist(), n]


def effect(times: list[int], low: int, high: int, span: int) -> tuple[list[int], list[int]]:
    """What the times from low to high do to an entry: up to bounds[j] (and above the bound before) it leaves as exits[j];
    an entry behind the last bound stays as it is."""
    last = list(range(high - low))
    for i in range(high - low - 2, -1, -1):
        after = bisect_left(times, times[low + i] + span, low + i + 1, high) - low
        if after < high - low:
            last[i] = last[after]
    bounds, exits = [], []
    for i, j in enumerate(last):
        if i + 1 == len(last) or last[i + 1] != j:
            bounds.append(times[low + i])
            exits.append(times[low + j] + span)
    return bounds, exits


def effects(span: int):
    """One chunk's sorted rows -> the effect on its first and its last key."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("_sk", "ascending"), ("_at", "ascending")])
        times, at = table.column("_at").to_pylist(), heads(table.column("_sk"))
        parts = list(zip(at[:-1], at[1:], strict=True))
        out = []
        for low, high in dict.fromkeys([parts[0], parts[-1]]):
            bounds, exits = effect(times, low, high, span)
            out.append({"_sk": table.column("_sk")[low].as_py(), "_chunk": table.column("_chunk")[0].as_py(), "bounds": bounds, "exits": exits})
        return pa.Table.from_pylist(out, EFFECTS)

    return run


EFFECTS = pa.schema([("_sk", pa.string()), ("_chunk", pa.int32()), ("bounds", pa.list_(pa.int64())), ("exits", pa.list_(pa.int64()))])


def entries(table: pa.Table) -> pa.Table:
    """The effects on one key -> (chunk, key, entry): the earliest time that each chunk may accept."""
    out, entry = [], OPEN
    for row in sorted(table.to_pylist(), key=lambda r: r["_chunk"]):
        out.append({"_chunk": row["_chunk"], "_sk": row["_sk"], "entry": entry})
        if entry <= row["bounds"][-1]:
            entry = row["exits"][bisect_left(row["bounds"], entry)]
    return pa.Table.from_pylist(out, pa.schema([("_chunk", pa.int32()), ("_sk", pa.string()), ("entry", pa.int64())]))


def accept(span: int):
    """One chunk's rows and its entries -> the accepted rows."""

    def run(rows: pa.Table, begin: pa.Table) -> pa.Table:
        rows = rows.sort_by([("_sk", "ascending"), ("_at", "ascending")])
        entry = dict(zip(begin.column("_sk").to_pylist(), begin.column("entry").to_pylist(), strict=True))
        at, times = heads(rows.column("_sk")), rows.column("_at").to_pylist()
        keep = []
        first = {k: rows.column("_sk")[k].as_py() for k in {at[0], at[-2]}} if len(times) else {}
        for low, high in zip(at[:-1], at[1:], strict=True):
            i = low
            if low in first and (begins := entry.get(first[low], OPEN)) > OPEN:
                i = bisect_left(times, begins, low, high)
            while i < high:
                keep.append(i)
                i = bisect_left(times, times[i] + span, i + 1, high) if i + 1 < high else high
        return rows.drop_columns(["_chunk"]).take(pa.array(keep, pa.int64()))

    return run


def accepted_times(times: DataFrame, span: int, chunk_rows: int) -> DataFrame:
    """Rows (_sk, _at, ...), distinct by key and time -> those that are accepted."""
    times = stored(times, "horizon-times")
    n = times.count()
    chunks = max(chunk_number(n, chunk_rows), min(times.sparkSession.sparkContext.defaultParallelism, -(-n // 5000)))
    ranged = times.repartitionByRange(chunks, "_sk", "_at").withColumn("_chunk", F.spark_partition_id())
    ranged = stored(ranged, "horizon-chunks")
    done = ranged.select("_sk", "_at", "_chunk").groupBy("_chunk").applyInArrow(effects(span), EFFECT)
    begin = stored(done.groupBy("_sk").applyInArrow(entries, "_chunk int, _sk string, entry long"), "horizon-entries")
    schema = T.StructType([f for f in ranged.schema.fields if f.name != "_chunk"])
    return ranged.groupBy("_chunk").cogroup(begin.groupBy("_chunk")).applyInArrow(accept(span), schema)
