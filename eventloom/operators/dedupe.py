"""Duplicate elimination of raw envelopes.

Every operator works on narrow columns (scope, id, order) and comes in two
forms: ``mark_*`` returns all rows with a boolean ``is_duplicate`` (for the
quarantine), ``dedupe_*`` returns the accepted rows.

* D1 ``first`` - the earliest row of every (source, endpoint, id) wins.
* D2 ``fifo`` - an id is a duplicate while it is among the last ``max_size``
  *accepted* ids of its (source, endpoint); a hit does not refresh it.
* D3 ``horizon`` - an id is a duplicate for ``horizon`` after it was last
  accepted.

``order`` is the arrival order: a list of columns that together are unique in
a scope, e.g. (file, position in the file, position in the page). Nothing is
assumed about it: a tie raises an error, since the outcome would depend on
chance.
"""

from __future__ import annotations

import sys
from collections import deque
from collections.abc import Iterable, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from eventloom.functions.time import to_millis_string_sql, with_iso_millis
from eventloom.operators.stretches import CHUNK_ROWS, accepted_times, chunk_number
from eventloom.plans.pinning import pinned_stage
from eventloom.session import stored

DEFAULT_SCOPE = ("source", "source_event_endpoint")
DEFAULT_ID = "source_event_id"
DEFAULT_MEMORY = 120  # ids remembered per scope by the ingestion process

# Python workers get these functions by value and need not import the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _equal(left: dict[str, str], columns: Iterable[str]) -> Column:
    cond = None
    for c in columns:
        one = F.col(c).eqNullSafe(F.col(left[c]))
        cond = one if cond is None else cond & one
    return cond


def _accepted(marked: DataFrame) -> DataFrame:
    return marked.where("NOT is_duplicate").drop("is_duplicate")


# ---------------------------------------------------------------------------
# D1
# ---------------------------------------------------------------------------

def mark_first(
    df: DataFrame, keys: Sequence[str] = (*DEFAULT_SCOPE, DEFAULT_ID), order: Sequence[str] = ("seq",)
) -> DataFrame:
    """``is_duplicate`` is false for the earliest row of every key.

    A NULL in ``order`` sorts behind every value; ties in (key, order) raise.
    Two narrow aggregations (partial in every map task, so a hot key ships one
    row per task and order) find each key's first order; the full rows only
    meet that small table in a hash join and are never sorted or aggregated.
    The table is stored first, so both join sides are plain exchanges, of which
    Spark splits a hot key.
    """
    keys, order = list(keys), list(order)
    per = df.groupBy(*keys, *order).agg(F.count(F.lit(1)).alias("_n"))
    rank = [x for c in order for x in (F.col(c).isNull().alias(f"_none_{c}"), F.col(c))]
    first = per.groupBy(*keys).agg(F.min(F.struct(*rank, F.col("_n"))).alias("_w"))
    names = {c: f"_k{i}" for i, c in enumerate(keys)} | {c: f"_o{i}" for i, c in enumerate(order)}
    first = stored(
        first.select(*[F.col(c).alias(names[c]) for c in keys], *[F.col(f"_w.{c}").alias(names[c]) for c in order],
                     F.col("_w._n").alias("_n")),
        "first",
    )
    joined = df.join(first.hint("shuffle_hash"), _equal(names, keys), "left")
    earliest = _equal(names, order)
    tie = F.raise_error(F.lit("two rows of one key have the same arrival order"))
    flag = F.when(earliest & (F.col("_n") > 1), tie.cast("boolean")).otherwise(~earliest)
    return joined.select(*df.columns, flag.alias("is_duplicate"))


def dedupe_first(
    df: DataFrame, keys: Sequence[str] = (*DEFAULT_SCOPE, DEFAULT_ID), order: Sequence[str] = ("seq",)
) -> DataFrame:
    """The earliest row of every key (see :func:`mark_first`)."""
    return _accepted(mark_first(df, keys, order))


# ---------------------------------------------------------------------------
# D2
# ---------------------------------------------------------------------------

class AcceptCounter:
    """The FIFO memory told by counting: the k-th accepted id is remembered
    until ``size`` more ids have been accepted.

    ``start`` lists the ids remembered at the beginning, oldest first, or is
    None if that is not known. Then some rows cannot be decided; the counter
    keeps how many (``open_rows``) and bounds every later decision by them, until
    enough certain accepts have pushed out whatever was not known.
    """

    def __init__(self, size: int, start: list | None):
        self.size, self.blind = size, start is None
        self.accepts = self.open_rows = self.run = 0
        self.when: dict = {}  # id -> (accepts, open rows) when it was last accepted
        self.doubt: dict = {}  # id -> accepts at its last undecided row
        self.latest: deque = deque(maxlen=size)
        for v in start or ():
            self._accept(v)

    def _accept(self, v) -> bool:
        self.accepts += 1
        self.run += 1
        self.when[v] = (self.accepts, self.open_rows)
        self.doubt.pop(v, None)
        self.latest.append(v)
        return True

    def take(self, v, first_sighting: bool = False) -> bool | None:
        """True: accepted; False: a duplicate; None: undecided."""
        if not first_sighting:
            if v in self.doubt:
                undecided = self.accepts - self.doubt[v] < self.size
            elif v in self.when:
                at, opened = self.when[v]
                least = self.accepts - at
                if least + self.open_rows - opened < self.size:
                    return False
                undecided = least < self.size
            else:
                undecided = self.blind and self.accepts < self.size
            if undecided:
                self.doubt[v] = self.accepts
                self.when.pop(v, None)
                self.open_rows += 1
                self.run = 0
                return None
        return self._accept(v)

    def memory(self) -> list | None:
        """The remembered ids, oldest first, or None if they are not known."""
        return list(self.latest) if self.run >= self.size or not self.blind else None


def _same_as_before(column: pa.ChunkedArray):
    """For every row but the first: whether the value is that of the row before (two NULLs are equal)."""
    left, right = column[1:], column[:-1]
    if pa.types.is_nested(column.type):
        return pa.array([x == y for x, y in zip(left.to_pylist(), right.to_pylist(), strict=True)], pa.bool_())
    same = pc.fill_null(pc.equal(left, right), False)
    if pa.types.is_floating(column.type):
        same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(left), pc.is_nan(right)), False))
    return pc.or_(same, pc.and_(pc.is_null(left), pc.is_null(right)))


def _replay(rows: pa.Table, size: int, start: list | None, order: Sequence[str]) -> tuple[list[int], int | None, AcceptCounter]:
    """Rows of one chunk, sorted -> places of the duplicates, place of the last undecided row, and the counter of the last scope."""
    if len(rows) > 1:
        tied = _same_as_before(rows.column("_sk"))
        changes = pc.invert(tied).to_pylist()
        for c in order:
            tied = pc.and_(tied, _same_as_before(rows.column(c)))
        if pc.any(tied).as_py():
            raise ValueError("two rows of one scope have the same arrival order")
    else:
        changes = []
    counter, undecided, out = AcceptCounter(size, start), None, []
    ids, first = rows.column("_id").to_pylist(), rows.column("_first").to_pylist()
    for i, (v, sure, other) in enumerate(zip(ids, first, [False, *changes], strict=True)):
        if other:
            counter = AcceptCounter(size, [])
        taken = counter.take(v, sure)
        if taken is False:
            out.append(i)
        elif taken is None:
            undecided = i
    return out, undecided, counter


def _guess(size: int, keys: Sequence[str], order: Sequence[str], schema: pa.Schema):
    """One chunk without the memory it starts with -> its duplicates behind the last row that depends on that memory, and one
    row on the chunk: its scopes, the memory at its end and up to where it is to be replayed (NULL: nowhere)."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_at")
        twice, undecided, counter = _replay(rows, size, None, order)
        known = counter.memory()
        last = len(rows) - 1 if known is None else undecided
        found = rows.select(keys).take(pa.array([i for i in twice if last is None or i > last], pa.int64()))
        at, sk = rows.column("_at"), rows.column("_sk")
        end = {"_chunk": rows.column("_chunk")[0].as_py(), "head": sk[0].as_py(), "tail": sk[-1].as_py(), "memory": known,
               "until": None if last is None else at[last].as_py()}
        return _stacked(found, end, schema)

    return run


def _exact(size: int, keys: Sequence[str], order: Sequence[str], schema: pa.Schema):
    """The first rows of one chunk, from the memory it starts with -> the duplicates among them, and the memory behind them."""

    def run(rows: pa.Table, begin: pa.Table) -> pa.Table:
        rows, one = rows.sort_by("_at"), begin.to_pylist()[0]
        twice, _, counter = _replay(rows, size, list(one["start"]), order)
        return _stacked(rows.select(keys).take(pa.array(twice, pa.int64())), {"n": one["n"], "memory": counter.memory()}, schema)

    return run


def _stacked(found: pa.Table, end: dict, schema: pa.Schema) -> pa.Table:
    """The keys of duplicates, with NULL in the other columns, and one row without keys."""
    columns = []
    for f in schema:
        more = pa.array([end.get(f.name)], f.type)
        head = found.column(f.name).cast(f.type) if f.name in found.column_names else pa.chunked_array([pa.nulls(len(found), f.type)])
        columns.append(pa.chunked_array([*head.chunks, more], f.type))
    return pa.Table.from_arrays(columns, schema=schema)


def mark_fifo(
    df: DataFrame,
    max_size: int = DEFAULT_MEMORY,
    scope: Sequence[str] = DEFAULT_SCOPE,
    id_col: str = DEFAULT_ID,
    order: Sequence[str] = ("seq",),
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """D2 over a whole table, exact for every input, with a scope spread over many tasks.

    1. The narrow rows (scope, id, order) are range-partitioned by (scope,
       order) into chunks of about ``chunk_rows`` (more, if they were too many: :func:`chunk_number`); an id's first
       sighting in its scope is a certain accept (a partial aggregation finds it).
    2. Every chunk is replayed without knowing the memory it starts with. After
       enough certain accepts the memory at its end is known all the same:
       an exact cut. All chunks run in parallel. What follows the last undecided row is decided.
    3. The rows of a chunk up to its last undecided one are replayed exactly, once the predecessor's end is
       known. Chunks that are left (a chunk through which fewer than ``max_size`` certain accepts
       run after its last undecided row) follow in further rounds, whole, each from
       the exact end of the one before; a round takes all that have become ready.

    Input that cannot be cut at all - chunk after chunk that repeats fewer than
    ``max_size`` ids without a new one - is replayed chunk by chunk. Payload columns
    are not read by Python; the full rows meet the duplicates' keys in a hash join and are never sorted.
    """
    if max_size < 1:
        raise ValueError("max_size must be >= 1")
    scope, order = list(scope), list(order)
    sk = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in scope]), {"ignoreNullFields": "false"})
    narrow = stored(df.select(*scope, F.col(id_col).cast("string").alias("_id"), *order, sk.alias("_sk")), "fifo-rows")
    chunks = chunk_number(narrow.count(), chunk_rows)
    ranged = (narrow.repartitionByRange(chunks, "_sk", *order).sortWithinPartitions("_sk", *order)
              .withColumns({"_chunk": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))
    ranged = stored(ranged, "fifo-ranges")
    keys = list(dict.fromkeys([*scope, *order]))
    seen = ranged.groupBy("_sk", "_id").agg(F.min("_at").alias("_at")).select("_at", F.lit(True).alias("_first"))
    rows = ranged.join(seen, "_at", "left").select(
        "_chunk", "_at", "_sk", "_id", *keys, F.coalesce("_first", F.lit(False)).alias("_first"))
    rows = stored(rows, "fifo-flagged")

    places = [T.StructField(c, rows.schema[c].dataType) for c in keys]
    memory = T.StructField("memory", T.ArrayType(T.StringType()))
    guessed = T.StructType([*places, T.StructField("_chunk", T.IntegerType()), T.StructField("head", T.StringType()),
                            T.StructField("tail", T.StringType()), memory, T.StructField("until", T.LongType())])
    replayed = T.StructType([*places, T.StructField("n", T.IntegerType()), memory])
    first = stored(rows.groupBy("_chunk").applyInArrow(_guess(max_size, keys, order, to_arrow_schema(guessed)), guessed), "fifo-ends")
    exact = _exact(max_size, keys, order, to_arrow_schema(replayed))
    rejected, ends = first.where("_chunk IS NULL").select(*keys), first.where("_chunk IS NOT NULL").drop(*keys)
    # the one pass over all chunks in order sees their numbers only, 4 bytes each; the memories are joined to it
    numbers = ends.select("_chunk").withColumn("n", F.row_number().over(Window.orderBy("_chunk")))
    numbered = stored(ends.join(numbers, "_chunk"), "fifo-chunks")
    before = numbered.select((F.col("n") + 1).alias("n"), F.col("tail").alias("last"), F.col("memory").alias("prior"))
    fresh = F.array().cast("array<string>")
    starts = numbered.where("until IS NOT NULL").join(before, "n", "left").select(
        "n", "_chunk", "until", F.when(F.col("last") == F.col("head"), F.col("prior")).otherwise(fresh).alias("start"))
    pending = stored(starts, "fifo-starts")
    while True:
        ready = pending.where("start IS NOT NULL")
        mine = rows.join(F.broadcast(ready.select("_chunk", "until")), "_chunk").where("_at <= until").drop("until")
        done = stored(mine.groupBy("_chunk").cogroup(ready.groupBy("_chunk")).applyInArrow(exact, replayed), "fifo-done")
        rejected = rejected.unionByName(done.where("n IS NULL").select(*keys))
        waiting = pending.where("start IS NULL").drop("start")
        if waiting.isEmpty():
            break
        behind = done.where("n IS NOT NULL").select((F.col("n") + 1).alias("n"), F.col("memory").alias("start"))
        pending = stored(waiting.join(behind, "n", "left"), "fifo-starts")
    names = {c: f"_k{i}" for i, c in enumerate(keys)}
    keyed = stored(rejected.select(*[F.col(c).alias(names[c]) for c in names], F.lit(True).alias("_hit")), "fifo-rejected")
    joined = df.join(keyed.hint("shuffle_hash"), _equal(names, names), "left")
    return joined.select(*df.columns, F.coalesce("_hit", F.lit(False)).alias("is_duplicate"))


def dedupe_fifo(
    df: DataFrame,
    max_size: int = DEFAULT_MEMORY,
    scope: Sequence[str] = DEFAULT_SCOPE,
    id_col: str = DEFAULT_ID,
    order: Sequence[str] = ("seq",),
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """The accepted rows (see :func:`mark_fifo`)."""
    return _accepted(mark_fifo(df, max_size, scope, id_col, order, chunk_rows))


# ---------------------------------------------------------------------------
# D3
# ---------------------------------------------------------------------------

def observed_ts(col: str = "observed_at"):
    """``observed_at`` (ISO text) as a TIMESTAMP for watermarking."""
    return F.expr(f"timestamp_millis({to_millis_string_sql(col).value})")


def mark_horizon(
    df: DataFrame,
    horizon: str = "10 minutes",
    keys: Sequence[str] = (*DEFAULT_SCOPE, DEFAULT_ID),
    event_time: str = "observed_ts",
    order: Sequence[str] = (),
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """D3 over a table: a row is a duplicate if its key was accepted less than
    ``horizon`` of event time before; a later re-send is accepted again.

    Rows of one key and event time are reduced to one on the map side (the
    least by ``order``, which must tell them apart; a tie raises). Which times are accepted is decided over sorted
    chunks of about ``chunk_rows``, so a key that never pauses is many tasks too (:mod:`eventloom.operators.stretches`). A row
    without an event time is never a duplicate. The rows are read twice, so the event time
    must not be a processing time that changes between reads.
    """
    timed = horizon_times(df, keys, event_time)
    return horizon_flags(timed, horizon_accepts(timed, horizon, order, chunk_rows), order).select(*df.columns, "is_duplicate")


def horizon_times(df: DataFrame, keys: Sequence[str], event_time: str) -> DataFrame:
    """All rows with their event time (``_at``, microseconds) and key (``_sk``)."""
    if event_time in df.columns:
        timed = df.withColumn("_at", F.unix_micros(F.col(event_time).cast("timestamp")))
    else:
        timed = with_iso_millis(df, {"_seen": "observed_at"}, mode="to_millis")
        timed = timed.withColumn("_at", F.expr("CASE WHEN observed_at IS NOT NULL THEN _seen_ms * 1000 END"))
    sk = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in keys]), {"ignoreNullFields": "false"})
    # pinned: the parsed time and the key are computed once per row, not once per use
    return pinned_stage(timed.select(*[c for c in df.columns if c != "_at"], "_at", sk.alias("_sk")))


def horizon_accepts(timed: DataFrame, horizon: str, order: Sequence[str], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Rows of :func:`horizon_times` -> the accepted (key, time) with the least row's order, stored."""
    span = timed.sparkSession.sql(f"SELECT unix_micros(timestamp'1970-01-01 00:00:00Z' + INTERVAL {horizon})").first()[0]
    tied = [x for c in order for x in (F.col(c).isNull().alias(f"_none_{c}"), F.col(c))]
    times = timed.where("_at IS NOT NULL").select("_sk", "_at", *order)
    per = times.groupBy("_sk", "_at", *order).agg(F.count(F.lit(1)).alias("_n"))
    rank = F.struct(*tied, F.col("_n"))
    least = per.groupBy("_sk", "_at").agg(F.min(rank).alias("_w"))
    kept = accepted_times(least, span, chunk_rows).select(F.col("_sk").alias("_k"), F.col("_at").alias("_t"), "_w")
    return stored(kept, "horizon")


def horizon_flags(timed: DataFrame, kept: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows of :func:`horizon_times`, all or some, with ``is_duplicate`` by what :func:`horizon_accepts` found in all of them."""
    joined = timed.join(kept.hint("shuffle_hash"), (F.col("_sk") == F.col("_k")) & (F.col("_at") == F.col("_t")), "left")
    mine = F.lit(True)
    for c in order:
        mine = mine & F.col(c).eqNullSafe(F.col(f"_w.{c}"))
    tie = F.raise_error(F.lit("two rows of one key and event time have the same order"))
    flag = F.when(F.col("_at").isNull(), F.lit(False)).when(F.col("_k").isNull() | ~mine, F.lit(True))
    flag = flag.when(F.col("_w._n") > 1, tie.cast("boolean")).otherwise(F.lit(False))
    return joined.select(*timed.columns, flag.alias("is_duplicate"))


def dedupe_within_horizon(
    df: DataFrame,
    horizon: str = "10 minutes",
    keys: Sequence[str] = (*DEFAULT_SCOPE, DEFAULT_ID),
    event_time: str = "observed_ts",
    order: Sequence[str] = (),
) -> DataFrame:
    """D3: drop a key accepted less than ``horizon`` before, in event time.

    A table goes through :func:`mark_horizon`. A stream goes through
    ``withWatermark`` + ``dropDuplicatesWithinWatermark``: state is keyed by id and expires as the
    watermark passes, which follows micro-batches; a re-send shortly after the horizon may
    therefore still be dropped there, and among equal keys of one micro-batch any row may stay.
    (:class:`eventloom.streaming.memory.HorizonMemory` is the exact form, with the duplicates' rows.)"""
    if not df.isStreaming:
        return _accepted(mark_horizon(df, horizon, keys, event_time, order))
    if event_time not in df.columns:
        df = df.withColumn(event_time, observed_ts())
    return df.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark(list(keys))


__all__ = [
    "AcceptCounter", "DEFAULT_ID", "DEFAULT_MEMORY", "DEFAULT_SCOPE", "dedupe_fifo", "dedupe_first", "dedupe_within_horizon",
    "mark_fifo", "mark_first", "mark_horizon", "observed_ts",
]
