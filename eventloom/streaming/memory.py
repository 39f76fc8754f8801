"""D1, D2 and D3 over a stream, exact, with every duplicate's row.

What a stream remembers lies in tables below one folder, a version for each micro-batch: a version is
written whole, and again if the batch is replayed, and a batch reads only versions of earlier ones. So a
replayed batch, a lost executor or a restart gives the same rows. The memories are used inside
``foreachBatch``; the rows go through the batch operators of :mod:`eventloom.operators.dedupe`.

* :class:`FirstMemory` (D1): every key ever accepted. A micro-batch adds its new keys and, for each of
  ``BUCKETS`` hash buckets, a Bloom filter over them (about ``BITS`` bits a key). Later batches read the
  filters first; only keys that a filter may know are joined with the stored keys.
* :class:`FifoMemory` (D2): the last accepted ids of each scope. They go before the rows of the next micro-batch, whose
  chunks are decided by many tasks (:func:`eventloom.operators.dedupe.mark_fifo`).
* :class:`HorizonMemory` (D3): per key the last accepted time, as long as it is within the horizon, and the
  rows that the watermark (the latest event time less ``delay``) has not passed yet. Rows are decided in the order of
  event time once it has passed them; a row that comes later than that counts as seen at the watermark.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.functions.time import with_iso_millis
from eventloom.operators.dedupe import DEFAULT_ID, DEFAULT_MEMORY, DEFAULT_SCOPE, horizon_accepts, horizon_flags, horizon_times, mark_fifo, mark_first
from eventloom.session import stored

BUCKETS = 256
BITS, HASHES = 10, 7

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Versions:
    """Tables of a streaming job, one folder for each micro-batch."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str, batch: int) -> str:
        return f"{self.root}/{name}/batch={batch}"

    def write(self, name: str, batch: int, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name, batch))
        return self.spark.read.schema(df.schema).parquet(self.path(name, batch))

    def before(self, name: str, batch: int, schema: T.StructType | str) -> DataFrame:
        """All rows of earlier batches, with their ``batch``."""
        folder = f"{self.root}/{name}"
        if not self._there(folder):
            empty = self.spark.createDataFrame([], schema)
            return empty.withColumn("batch", F.lit(None).cast("long"))
        wide = T.StructType([*self.spark.createDataFrame([], schema).schema.fields, T.StructField("batch", T.LongType())])
        return self.spark.read.schema(wide).parquet(folder).where(F.col("batch") < batch)

    def last(self, name: str, batch: int, schema: T.StructType | str) -> DataFrame:
        """The rows of the batch before."""
        if not self._there(self.path(name, batch - 1)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path(name, batch - 1))

    def _there(self, folder: str) -> bool:
        sc = self.spark.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(sc._jsc.hadoopConfiguration()).exists(path)


def key_text(keys: Sequence[str]):
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in keys]), {"ignoreNullFields": "false"})


def bit_places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The places of every hash in a filter: one row for each."""
    low, high = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    return (low[:, None] + high[:, None] * np.arange(HASHES, dtype=np.uint64)) % np.uint64(bits)


def filter_of(table: pa.Table) -> pa.Table:
    """The keys of one bucket (bucket, hash) -> its filter (bucket, bits)."""
    hashes = np.unique(table.column("hash").to_numpy()).view(np.uint64)
    marks = np.zeros(-(-BITS * len(hashes) // 64) * 64, dtype=bool)
    marks[bit_places(hashes, len(marks)).ravel().astype(np.int64)] = True
    return pa.table({"bucket": table.column("bucket")[:1].cast(pa.int32()), "bits": pa.array([np.packbits(marks).tobytes()], pa.binary())})


def known_to(keys: pa.Table, filters: pa.Table) -> pa.Table:
    """Keys of one bucket that one of the bucket's filters may know."""
    hashes = keys.column("hash").to_numpy().view(np.uint64)
    known = np.zeros(len(hashes), dtype=bool)
    for bits in filters.column("bits"):
        marks = np.unpackbits(np.frombuffer(bits.as_py(), dtype=np.uint8))
        open_ones = np.flatnonzero(~known)
        known[open_ones] = marks[bit_places(hashes[open_ones], len(marks)).astype(np.int64)].all(axis=1)
    return keys.select(["bucket", "key"]).filter(pa.array(known))


class FirstMemory:
    """D1 over the micro-batches of a stream; ``root`` holds the index."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str] = (*DEFAULT_SCOPE, DEFAULT_ID), order: Sequence[str] = ("seq",)):
        self.tables, self.keys, self.order = Versions(spark, root), list(keys), list(order)

    def mark(self, df: DataFrame, batch: int) -> DataFrame:
        """All rows with ``is_duplicate``; rows that bear a ``reason`` pass through unseen."""
        live, rejected = (df.where("reason IS NULL"), df.where("reason IS NOT NULL")) if "reason" in df.columns else (df, None)
        marked = stored(mark_first(live, self.keys, self.order).withColumn("_key", key_text(self.keys)), "first-marked")
        hashed = marked.where("NOT is_duplicate").select("_key", F.xxhash64("_key").alias("hash"))
        fresh = stored(hashed.select(F.pmod("hash", F.lit(BUCKETS)).cast("int").alias("bucket"), "hash", F.col("_key").alias("key")), "first-fresh")
        filters = self.tables.before("filters", batch, "bucket int, bits binary")
        maybe = fresh.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(known_to, "bucket int, key string")
        old = self.tables.before("keys", batch, "bucket int, key string")
        seen = stored(maybe.join(old, ["bucket", "key"], "left_semi").select(F.col("key").alias("_seen")), "first-seen")
        new = fresh.join(seen, F.col("key") == F.col("_seen"), "left_anti")
        out = marked.join(seen, F.col("_key") == F.col("_seen"), "left")
        out = out.select(*df.columns, (F.col("is_duplicate") | F.col("_seen").isNotNull()).alias("is_duplicate"))
        self._add(new, batch)
        return out if rejected is None else out.unionByName(rejected.withColumn("is_duplicate", F.lit(False)))

    def _add(self, new: DataFrame, batch: int) -> None:
        kept = self.tables.write("keys", batch, new.select("bucket", "hash", "key").repartition("bucket").sortWithinPartitions("bucket", "key"))
        self.tables.write("filters", batch, kept.groupBy("bucket").applyInArrow(filter_of, "bucket int, bits binary"))


class FifoMemory:
    """D2 over the micro-batches of a stream; ``root`` holds the remembered ids, oldest first by ``_turn`` (below 0)."""

    def __init__(self, spark: SparkSession, root: str, max_size: int = DEFAULT_MEMORY, scope: Sequence[str] = DEFAULT_SCOPE,
                 id_col: str = DEFAULT_ID, order: Sequence[str] = ("seq",)):
        self.tables, self.max_size, self.scope, self.id_col, self.order = Versions(spark, root), max_size, list(scope), id_col, list(order)

    def mark(self, df: DataFrame, batch: int) -> DataFrame:
        """All rows with ``is_duplicate``; rows that bear a ``reason`` pass through unseen."""
        fresh = stored(df, "fifo-batch")
        live, rejected = (fresh.where("reason IS NULL"), fresh.where("reason IS NOT NULL")) if "reason" in df.columns else (fresh, None)
        names = T.StructType([*(fresh.schema[c] for c in [*self.scope, self.id_col]), T.StructField("_turn", T.LongType())])
        known = self.tables.last("fifo", batch, names)
        # distinct ids before all others: each is accepted, and the memory behind them is the one that was stored
        rows = live.withColumn("_turn", F.lit(0).cast("long")).unionByName(known, allowMissingColumns=True)
        order = ["_turn", *self.order]
        marked = stored(mark_fifo(rows, self.max_size, self.scope, self.id_col, order), "fifo-marked")
        latest = Window.partitionBy(*self.scope).orderBy(*[F.col(c).desc() for c in order])
        kept = marked.where("NOT is_duplicate").select(*self.scope, self.id_col, *order).withColumn("_back", F.row_number().over(latest))
        kept = kept.where(F.col("_back") <= self.max_size)
        self.tables.write("fifo", batch, kept.select(*self.scope, self.id_col, (-F.col("_back")).cast("long").alias("_turn")))
        out = marked.where("_turn = 0").select(*df.columns, "is_duplicate")
        return out if rejected is None else out.unionByName(rejected.withColumn("is_duplicate", F.lit(False)))


class HorizonMemory:
    """D3 over the micro-batches of a stream; ``root`` holds the times, the rows that wait and the watermark.

    ``delay`` (seconds) is how much later than a later event a row may come and still be put in its place."""

    def __init__(self, spark: SparkSession, root: str, horizon: str = "10 minutes", delay: float = 0,
                 keys: Sequence[str] = (*DEFAULT_SCOPE, DEFAULT_ID), order: Sequence[str] = ("seq",)):
        self.tables, self.horizon, self.delay = Versions(spark, root), horizon, int(delay * 1_000_000)
        self.keys, self.order = list(keys), list(order)

    def mark(self, df: DataFrame, batch: int) -> DataFrame:
        """The rows that this batch decides, with ``is_duplicate``: those that the watermark has passed by now. Rows that bear
        a ``reason``, or no event time, are decided at once."""
        spark = df.sparkSession
        before = self.tables.last("watermark", batch, "at long").first()
        passed = before["at"] if before else None
        if "reason" not in df.columns:
            df = df.withColumn("reason", F.lit(None).cast("string"))
        timed = with_iso_millis(df, {"_seen": "observed_at"}, mode="to_millis")
        at = F.when(F.col("reason").isNull() & F.col("observed_at").isNotNull(), F.col("_seen_ms") * 1000)
        if passed is not None:  # later than the watermark: it counts as seen there
            at = F.when(at.isNotNull(), F.greatest(at, F.lit(passed)))
        fresh = stored(timed.select(*df.columns, at.alias("_at")), "horizon-fresh")
        latest = fresh.where("reason IS NULL").agg(F.max("_at")).first()[0]
        mark = max((x for x in (passed, latest and latest - self.delay) if x is not None), default=None)
        self.tables.write("watermark", batch, spark.createDataFrame([(mark,)] if mark is not None else [], "at long"))
        waiting = fresh.where("reason IS NULL AND _at IS NOT NULL").unionByName(self.tables.last("waiting", batch, fresh.schema))
        released = F.col("_at") <= F.lit(mark).cast("long")
        self.tables.write("waiting", batch, waiting.where(~F.coalesce(released, F.lit(False))))
        names = T.StructType([*(fresh.schema[c] for c in self.keys), T.StructField("_at", T.LongType())])
        seeds = self.tables.last("times", batch, names)
        rows = waiting.where(released).withColumn("_row", F.lit(1)).unionByName(seeds.withColumn("_row", F.lit(0)), allowMissingColumns=True)
        order = ["_row", *self.order]
        # the times are decided on narrow rows and stored; the full rows are read once more, on their way to the sink
        accepts = horizon_accepts(self._timed(rows), self.horizon, order)
        span = F.expr(f"unix_micros(timestamp'1970-01-01 00:00:00Z' + INTERVAL {self.horizon})")
        recent = rows.where(F.col("_at") + span > F.lit(mark).cast("long")).select(*self.keys, *order, "_at")
        kept = horizon_flags(self._timed(recent), accepts, order).where("NOT is_duplicate")
        self.tables.write("times", batch, kept.groupBy(*self.keys).agg(F.max("_at").alias("_at")))
        decided = horizon_flags(self._timed(rows.where("_row = 1")), accepts, order).select(*df.columns, "is_duplicate")
        at_once = fresh.where("reason IS NOT NULL OR _at IS NULL").select(*df.columns, F.lit(False).alias("is_duplicate"))
        return decided.unionByName(at_once)

    def _timed(self, rows: DataFrame) -> DataFrame:
        return horizon_times(rows.withColumn("_when", F.timestamp_micros("_at")), self.keys, "_when")


__all__ = ["FifoMemory", "FirstMemory", "HorizonMemory", "Versions"]
