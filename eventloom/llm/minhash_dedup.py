"""Near-duplicates: one-permutation hashing, banded buckets, star-shaped candidate edges, exact confirmation.

A document is the set of its distinct word shingles. Equal sets become one node. One pass over a
node's sorted hashes fills ``BANDS * ROWS`` bins with each bin's least hash; an empty bin takes the
value of the first filled bin that its own random sequence of bins names (optimal densification).
Bands of ``ROWS`` bins are the buckets: two sets with similarity 0.75 miss each other in all of
them with a probability of about 4 in a million.

Every bucket sends one edge from each member to its hub: as many candidate pairs as bucket rows,
however large a group of copies is. Candidates are confirmed on their full sets. A star may lack
a link between two members that both differ from the hub. So, after the stars' components are
known, buckets with more than one component are settled exactly: each member outside a bucket's
largest component meets the members of other components there, in blocks of about ``BLOCK`` by
``BLOCK`` members, or ``BLOCK_BYTES`` of text a side, a task, each pair only in the first bucket that it shares. No pair inside a known
component and no pair of copies is looked at. Components then come from rounds of least labels with
pointer jumping; every round is written to the shared folder.

Defined cases: a text without words (null too) has the empty set, is linked with nothing, and is a
component of its own; with fewer words than a shingle, the whole sequence is the one shingle;
repeated rows are one node; a null id counts as the greatest; rows that repeat an id are nodes by
their texts; other columns are ignored, or kept by ``keep_one``. Sets are told apart by 128 bits.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm import shingles
from eventloom.llm.common import row_key, same_key, written

SHINGLE = 5
ROWS, BANDS = 6, 64
BLOCK, BLOCK_BYTES = 512, 1 << 24
BINS = ROWS * BANDS
#: For each try the bin that an empty bin asks.
DONORS = np.random.default_rng(11).integers(0, BINS, (64, BINS))
FOLD = shingles.powers(shingles.BASE, ROWS)


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """The bucket of each band of a (sorted, non-empty) set."""
    bins = ((hashes >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)  # rises with the hash: a bin's first is its least
    first = np.flatnonzero(np.concatenate(([True], bins[1:] != bins[:-1])))
    at = bins[first].astype(np.int64)
    filled, values = np.zeros(BINS, dtype=bool), np.zeros(BINS, dtype=np.uint64)
    filled[at], values[at] = True, hashes[first]
    empty = np.flatnonzero(~filled)
    for donors in DONORS:
        if not len(empty):
            break
        asked = donors[empty]
        found = filled[asked]
        values[empty[found]] = values[asked[found]]
        empty = empty[~found]
    if len(empty):  # few bins are filled: the next one round the circle
        values[empty] = values[at[np.searchsorted(at, empty) % len(at)]]
    return shingles.mix((values.reshape(BANDS, ROWS) * FOLD).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(__id, __h, text) -> (__id, __h, n, s1, s2, bands)."""
    hasher = shingles.Hasher(lower=True)
    for whole in batches:
        for at in range(0, whole.num_rows, 1000):
            batch = whole.slice(at, 1000)
            sizes, s1, s2, bands = [], [], [], []
            for found in shingles.shingle_sets(batch.column(2).to_pylist(), SHINGLE, hasher):
                digest = np.frombuffer(hashlib.blake2b(found.tobytes(), digest_size=16).digest(), dtype="<i8")
                sizes.append(len(found))
                s1.append(int(digest[0]))
                s2.append(int(digest[1]))
                bands.append(band_keys(found) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int32()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                names=["__id", "__h", "n", "s1", "s2", "bands"],
            )


def linked(common: int, a: int, b: int) -> bool:
    return 100 * common >= 75 * (a + b - common)


class Sets:
    """The shingle sets of the texts used last."""

    def __init__(self, most: int = 256):
        self.hasher, self.held, self.most = shingles.Hasher(lower=True), OrderedDict(), most

    def of(self, node: int, text: str) -> np.ndarray:
        if node not in self.held:
            self.held[node] = shingles.shingle_sets([text], SHINGLE, self.hasher)[0]
            if len(self.held) > self.most:
                self.held.popitem(last=False)
        self.held.move_to_end(node)
        return self.held[node]


def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, text_a, b, text_b) -> the linked (a, b)."""
    sets = Sets()
    for batch in batches:
        out = []
        for a, ta, b, tb in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            x, y = sets.of(a, ta), sets.of(b, tb)
            if linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)):
                out.append((a, b))
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in out], pa.int64()), pa.array([p[1] for p in out], pa.int64())], names=["a", "b"])


def settle(table: pa.Table) -> pa.Table:
    """One block of a bucket: rows (band, outside, node, label, main, hub, bands, text). Links between those outside the
    largest component and all others of another component, if this is the first bucket that the pair shares."""
    hasher = shingles.Hasher(lower=True)
    rows = table.to_pylist()
    mine, others = [r for r in rows if r["outside"]], [r for r in rows if not r["outside"]]
    band = rows[0]["band"]
    sets = shingles.shingle_sets([r["text"] for r in others], SHINGLE, hasher)
    if not mine or not others:
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    sizes = np.array([len(s) for s in sets])
    keys = np.array([r["bands"][:band] for r in others], dtype=np.int64).reshape(len(others), band)
    node, label = np.array([r["node"] for r in others]), np.array([r["label"] for r in others])
    main, hub = label == rows[0]["main"], rows[0]["hub"]
    out_a, out_b = [], []
    for r, x in zip(mine, shingles.shingle_sets([r["text"] for r in mine], SHINGLE, hasher), strict=True):
        if r["node"] == hub:
            continue
        ok = (label != r["label"]) & (node != hub) & (main | (node > r["node"])) & (100 * np.minimum(sizes, len(x)) >= 75 * np.maximum(sizes, len(x)))
        if band:
            ok &= ~(keys == np.array(r["bands"][:band], dtype=np.int64)).any(axis=1)
        at = np.flatnonzero(ok)
        if len(at):
            joined = np.concatenate([sets[k] for k in at])
            place = np.minimum(np.searchsorted(x, joined), len(x) - 1)
            common = np.add.reduceat((x[place] == joined).astype(np.int64), np.concatenate(([0], np.cumsum(sizes[at])[:-1])))
            yes = at[100 * common >= 75 * (sizes[at] + len(x) - common)]
            out_a += [r["node"]] * len(yes)
            out_b += node[yes].tolist()
    return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})


def components(edges: DataFrame) -> DataFrame:
    """Undirected (a, b) -> (node, label) for every node with an edge; label: the component's least node."""
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = written(labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")), "labels")
        target = step.select(F.col("node").alias("label"), F.col("label").alias("next"))
        jumped = written(step.join(target, "label").select("node", "old", F.least("label", "next").alias("label")), "labels")
        labels = jumped.select("node", "label")
        if jumped.where("old <> label").isEmpty():
            return labels


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: __id, __h (row key), n (set size), group (a node of its component, null for the empty set),
    component (least id reachable)."""
    keyed = documents.select(*row_key(id_col, text_col), F.col(text_col).alias("text"))
    id_field = keyed.schema["__id"]
    schema = T.StructType([id_field, T.StructField("__h", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("s1", T.LongType()), T.StructField("s2", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))])
    rows = written(keyed.mapInArrow(sketches, schema), "sketches")
    key = F.struct(F.col("__id").isNull().alias("none"), "__id", "__h")
    nodes = written(
        rows.where("n > 0").groupBy("s1", "s2").agg(F.min(key).alias("row"), F.first("n").alias("n"), F.first("bands").alias("bands"))
        .select(F.col("s1").alias("node"), "row.__id", "row.__h", "n", "bands"), "nodes",
    )
    places = nodes.select("node", "n", F.posexplode("bands").alias("band", "bucket"))
    hubs = places.groupBy("band", "bucket").agg(F.min(F.struct("node", "n")).alias("hub"), F.count("*").alias("size")).where("size > 1")
    hubs = written(hubs.select("band", "bucket", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n"), "size"), "hubs")
    members = written(places.join(hubs, ["band", "bucket"]), "members")
    near_size = 100 * F.least("n", "hub_n") >= 75 * F.greatest("n", "hub_n")
    pairs = written(members.where(near_size & (F.col("node") != F.col("hub"))).select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    asked = members.select("node").distinct().join(nodes.select("node", "__id", "__h"), "node")
    found = keyed.join(asked.withColumnsRenamed({"__id": "i", "__h": "h"}), (F.col("__h") == F.col("h")) & F.col("__id").eqNullSafe(F.col("i")))
    texts = written(found.select("node", "text", F.octet_length("text").alias("bytes")).dropDuplicates(["node"]), "texts")
    side = lambda c: texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}"))
    stars = written(pairs.join(side("b"), "b").join(side("a"), "a").select("a", "text_a", "b", "text_b").mapInArrow(confirm, "a long, b long"), "links")
    labels = components(stars)
    edges = stars.unionByName(rest(members, nodes, labels, texts))
    labels = components(edges)
    least = labels.join(nodes.select("node", "__id"), "node").groupBy("label").agg(F.min("__id").alias("component"))
    named = labels.join(least, "label").select("node", "label", "component")
    group = written(
        nodes.join(named, "node", "left").select(F.col("node").alias("s1"), F.coalesce("label", "node").alias("group"), F.coalesce("component", "__id").alias("component")), "groups",
    )
    return rows.select("__id", "__h", "n", F.when(F.col("n") > 0, F.col("s1")).alias("s1")).join(group, "s1", "left").select(
        "__id", "__h", "n", "group", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("__id")).alias("component")
    )


def rest(members: DataFrame, nodes: DataFrame, labels: DataFrame, texts: DataFrame) -> DataFrame:
    """Links that the stars don't show: between components that share a bucket."""
    named = members.where("size > 2").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    placed = written(named.join(texts.select("node", "bytes"), "node"), "labelled")
    by_label = placed.groupBy("band", "bucket", "label").agg(F.count("*").alias("k"), F.sum("bytes").alias("bytes"))
    open_buckets = by_label.groupBy("band", "bucket").agg(
        F.max(F.struct("k", "label", "bytes")).alias("most"), F.sum("k").alias("all"), F.sum("bytes").alias("bytes"), F.count("*").alias("labels")
    ).where("labels > 1")
    blocks = lambda rows, size: F.greatest(F.ceil(rows / BLOCK), F.ceil(size / BLOCK_BYTES)).cast("int")
    open_buckets = written(
        open_buckets.select(
            "band", "bucket", F.col("most.label").alias("main"), blocks(F.col("all"), F.col("bytes")).alias("wide"),
            blocks(F.col("all") - F.col("most.k"), F.col("bytes") - F.col("most.bytes")).alias("high"),
        ), "open",
    )
    rows = placed.select("band", "bucket", "node", "label", "hub").join(open_buckets, ["band", "bucket"])
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    deal = lambda n: F.array(F.pmod(F.xxhash64("node"), F.col(n)).cast("int"))
    inside = rows.select("*", F.lit(False).alias("outside"), F.explode(deal("wide")).alias("x")).select("*", F.explode(every("high")).alias("y"))
    outside = rows.where("label <> main").select("*", F.lit(True).alias("outside"), F.explode(every("wide")).alias("x")).select("*", F.explode(deal("high")).alias("y"))
    full = inside.unionByName(outside).join(nodes.select("node", "bands"), "node").join(texts.select("node", "text"), "node")
    full = full.select("band", "bucket", "x", "y", "outside", "node", "label", "main", "hub", "bands", "text")
    return written(full.groupBy("band", "bucket", "x", "y").applyInArrow(settle, "a long, b long"), "links")


def keep_one(documents: DataFrame) -> DataFrame:
    """The documents, all columns: of each component the one with the least id, and all without words. Of rows that are equal
    in id and text one stays, the same one in every run: that with the least hash of all its columns."""
    found = near_duplicates(documents)
    first = found.where(F.col("group").isNotNull()).groupBy("group").agg(F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", "__h")).alias("r"))
    stay = first.select("r.__id", "r.__h").union(found.where(F.col("group").isNull()).select("__id", "__h")).distinct()
    rows = found.groupBy("__id", "__h").agg(F.count("*").alias("rows"))
    stay = written(stay.join(rows, same_key(stay, rows)).select(stay["__id"].alias("__i"), stay["__h"].alias("__k"), "rows"), "kept")
    keyed = documents.withColumns({"__id": F.col("doc_id"), "__h": F.xxhash64("doc_id", "text")})
    kept = keyed.join(stay, (F.col("__h") == F.col("__k")) & F.col("__id").eqNullSafe(F.col("__i")))
    whole = F.struct(*documents.columns)
    twice = kept.where("rows > 1").groupBy("__id", "__h").agg(F.min_by(whole, F.xxhash64(*documents.columns)).alias("row"))
    return kept.where("rows = 1").select(documents.columns).unionByName(twice.select("row.*"))
