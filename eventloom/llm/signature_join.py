"""Jaccard join of word n-gram sets by signature trees, and the components of its links.

A document is the set of its distinct shingles, as 64-bit hashes; equal sets become one node.
A node's signature is a bitmap with a few bits for each shingle (a power of two, so that a
wider one folds onto a narrower one). A tree over some nodes, sorted by size and least shingle,
holds for every inner node the OR of its children's bitmaps, the range of their sizes, the most
shingles that any of them has beyond its set bits, and the component known so far if it is one.
Two sets share at most ``popcount(x AND y)`` shingles plus that excess. The dual traversal goes
from pairs of roots to pairs of leaves and drops each pair of nodes whose sizes can't match,
whose greatest possible overlap is too small, or which is known to be one component.

All trees against all would be quadratic, so trees stand over *neighbourhoods*: the nodes that
share a necessary shingle. A set of n shingles has p = n - ceil(t n) + 1 necessary ones, the first p
in an order common to all; two linked sets share one of these. The order takes the lower part of the
hash space first (``LOWER``), less the frequent shingles there (more than ``FREQUENT`` sets), by hash.
So neighbourhoods are small, and a passage that many documents share makes none. *Deficient*
sets have fewer than p infrequent shingles there: small ones, and members of large groups of near
copies. A linked pair with only one deficient set still shares an infrequent one of the other's, and
pairs of two deficient sets are found among these alone, with necessary shingles by rising frequency.

A neighbourhood of at most ``FREQUENT`` nodes falls into runs of sizes that can match; each run is one tree.
Of the surviving pairs one for each node is confirmed on the full sets first; of the others then those
between different components. Larger neighbourhoods (of deficient sets only) first link every member to one hub. Where more than
one component is left, the members outside the largest are dealt into tiles, the others too, bounded
by rows and by bytes; a tree of one tile meets a tree of the other, and pairs are confirmed on the
spot, no more than join two components. Every step is written to the shared folder.

Defined cases: a text without words (null too) has the empty set, is linked with nothing, and is a
component of its own; with fewer words than a shingle, the whole sequence is the one shingle; repeated
rows are one node; a null id counts as the greatest; rows that repeat an id are nodes by their texts;
other columns are ignored; an empty table gives an empty result. Sets are told apart by 64 bits.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm import shingles
from eventloom.llm.common import dropped, row_key
from eventloom.llm.common import written as stored
from eventloom.llm.minhash_dedup import components

SHINGLE = 4
#: Linked: COMMON_PER * intersection >= UNION_PER * union.
COMMON_PER, UNION_PER = 100, 85
#: Bits for each shingle of a signature: of one that is kept, and of one made from the full set.
BITS, FULL_BITS = 4, 16
#: Share of the hash space whose shingles are counted, in sixteenths.
LOWER = 4
FREQUENT = 64
FAN = 8
#: A tile's rows and bytes, and the pairs of tree nodes looked at together.
TILE, TILE_BYTES, PAIRS = 1024, 1 << 24, 1 << 14
CUT = np.uint64(LOWER << 60)


def written(df: DataFrame, name: str) -> DataFrame:
    """Every table here is much smaller than the shuffles that make it: these go at once."""
    return stored(df, name, tidy=True)


def necessary(n: np.ndarray | int) -> np.ndarray | int:
    """How many shingles of a set of n must be looked at."""
    return n - -(-UNION_PER * n // COMMON_PER) + 1


def is_linked(common, a, b):
    return COMMON_PER * common >= UNION_PER * (a + b - common)


def signature(hashes: np.ndarray, each: int = BITS) -> np.ndarray:
    """The bitmap of a set as 64-bit words."""
    width = max(64, 1 << int(each * max(1, len(hashes)) - 1).bit_length())
    out = np.zeros(width // 64, dtype=np.uint64)
    place = hashes & np.uint64(width - 1)
    np.bitwise_or.at(out, (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
    return out


def folded(bitmap: np.ndarray, words: int) -> np.ndarray:
    return bitmap if len(bitmap) == words else np.bitwise_or.reduce(bitmap.reshape(-1, words), axis=0)


@dataclass
class Level:
    """Tree nodes side by side: OR bitmaps, least and greatest size, greatest excess, component (-1: several)."""

    bits: np.ndarray
    low: np.ndarray
    high: np.ndarray
    excess: np.ndarray
    label: np.ndarray


def tree(bitmaps: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> list[Level]:
    """Levels from the leaves (the sets themselves, in their order) to one root."""
    levels = [Level(bitmaps, sizes, sizes, sizes - np.bitwise_count(bitmaps).sum(axis=1).astype(np.int64), labels)]
    while len(levels[-1].low) > 1:
        at = np.arange(0, len(levels[-1].low), FAN)
        x = levels[-1]
        first, last = np.minimum.reduceat(x.label, at), np.maximum.reduceat(x.label, at)
        levels.append(
            Level(
                np.bitwise_or.reduceat(x.bits, at, axis=0), np.minimum.reduceat(x.low, at), np.maximum.reduceat(x.high, at),
                np.maximum.reduceat(x.excess, at), np.where((first == last) & (first >= 0), first, -1),
            )
        )
    return levels


def possible(x: Level, i: np.ndarray, y: Level, j: np.ndarray) -> np.ndarray:
    """Which of the pairs of tree nodes may hold a link that is not known yet."""
    low, high = np.minimum(x.low[i], y.low[j]), np.minimum(x.high[i], y.high[j])
    ok = (COMMON_PER * high >= UNION_PER * np.maximum(x.low[i], y.low[j])) & ~((x.label[i] == y.label[j]) & (x.label[i] >= 0))
    at = np.flatnonzero(ok)
    for k in range(0, len(at), PAIRS):
        some = at[k : k + PAIRS]
        both = np.bitwise_count(x.bits[i[some]] & y.bits[j[some]]).sum(axis=1).astype(np.int64)
        most = np.minimum(both + np.minimum(x.excess[i[some]], y.excess[j[some]]), high[some])
        # the smallest members need the least overlap: t / (1 + t) of both sizes together
        ok[some] = (COMMON_PER + UNION_PER) * most >= UNION_PER * (x.low[i[some]] + y.low[j[some]])
    return ok


def traversal(a: list[Level], b: list[Level] | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of leaves that survive: of two trees, or of one with itself (each pair once)."""
    own = b is None
    b = a if b is None else b
    stack = [(len(a) - 1, len(b) - 1, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))]
    while stack:
        p, q, i, j = stack.pop()
        keep = possible(a[p], i, b[q], j) if not own else (i == j) & ((a[p].label[i] < 0) | (p == 0)) | possible(a[p], i, b[q], j)
        i, j = i[keep], j[keep]
        if p == 0 and q == 0:
            if own:
                i, j = i[i < j], j[i < j]
            if len(i):
                yield i, j
            continue
        if not len(i):
            continue
        fan_a, fan_b = (FAN if p else 1), (FAN if q else 1)
        for k in range(0, len(i), PAIRS // (FAN * FAN)):
            some = slice(k, k + PAIRS // (FAN * FAN))
            ci = (i[some, None] * fan_a + np.arange(fan_a)).repeat(fan_b, axis=1).ravel()
            cj = np.tile(j[some, None] * fan_b + np.arange(fan_b), (1, fan_a)).ravel()
            there = (ci < len(a[max(p - 1, 0)].low)) & (cj < len(b[max(q - 1, 0)].low))
            if own:
                there &= ci <= cj
            stack.append((max(p - 1, 0), max(q - 1, 0), ci[there], cj[there]))


def planted(bitmaps: list[np.ndarray], sizes: np.ndarray, labels: np.ndarray, least: np.ndarray, words: int) -> tuple[list[Level], np.ndarray]:
    """A tree over sets, and the order of its leaves."""
    order = np.lexsort((least, labels, sizes))
    return tree(np.stack([folded(bitmaps[k], words) for k in order]), sizes[order], labels[order]), order


def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(__id, __h, text) -> (__id, __h, node, n, lower, bits)."""
    hasher = shingles.Hasher(lower=True)
    for whole in batches:
        for at in range(0, whole.num_rows, 500):
            batch = whole.slice(at, 500)
            node, sizes, lower, bits = [], [], [], []
            for found in shingles.shingle_sets(batch.column(2).to_pylist(), SHINGLE, hasher):
                node.append(int.from_bytes(hashlib.blake2b(found.tobytes(), digest_size=8).digest(), "little", signed=True) if len(found) else None)
                sizes.append(len(found))
                lower.append(found[: np.searchsorted(found, CUT)].view(np.int64) if len(found) else None)
                bits.append(signature(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(node, pa.int64()), pa.array(sizes, pa.int64()), pa.array(lower, pa.list_(pa.int64())), pa.array(bits, pa.binary())],
                names=["__id", "__h", "node", "n", "lower", "bits"],
            )


def whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, text) -> (node, n, set): the hashes as bytes."""
    hasher = shingles.Hasher(lower=True)
    for whole in batches:
        for at in range(0, whole.num_rows, 500):
            batch = whole.slice(at, 500)
            found = shingles.shingle_sets(batch.column(1).to_pylist(), SHINGLE, hasher)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) for x in found], pa.int64()), pa.array([x.tobytes() for x in found], pa.binary())], names=["node", "n", "set"]
            )


def hashes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, n, set) -> a row (node, n, need, shingle) for each shingle."""
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            some = batch.slice(at, 200)
            sets = [np.frombuffer(x.as_py(), dtype="<i8") for x in some.column(2)]
            n = some.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(x, n)) for x in (some.column(0).to_numpy(), n, necessary(n))] + [pa.array(np.concatenate(sets))],
                names=["node", "n", "need", "shingle"],
            )


def tree_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbourhoods (nodes, sizes, bitmaps) -> candidate pairs (a, b) that survive a tree's traversal of itself."""
    for batch in batches:
        out_a, out_b = [], []
        nodes, sizes, bits = (batch.column(k) for k in range(3))
        for r in range(batch.num_rows):
            node, size = nodes[r].values.to_numpy(), sizes[r].values.to_numpy()
            bitmaps = [np.frombuffer(x.as_py(), dtype="<u8") for x in bits[r].values]
            words = min(map(len, bitmaps))
            levels, order = planted(bitmaps, size, np.full(len(node), -1), node, words)
            for i, j in traversal(levels, None):
                x, y = node[order[i]], node[order[j]]
                out_a.append(np.minimum(x, y))
                out_b.append(np.maximum(x, y))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(side) if side else np.zeros(0, np.int64)) for side in (out_a, out_b)], names=["a", "b"]
        )


class Sets:
    """The shingle sets of the texts used last."""

    def __init__(self, most: int = 256):
        self.hasher, self.held, self.most = shingles.Hasher(lower=True), OrderedDict(), most

    def of(self, node: int, text: pa.StringScalar) -> np.ndarray:
        if node not in self.held:
            self.held[node] = shingles.shingle_sets([text.as_py()], SHINGLE, self.hasher)[0]
            if len(self.held) > self.most:
                self.held.popitem(last=False)
        self.held.move_to_end(node)
        return self.held[node]


def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, text_a, b, text_b) -> the linked (a, b)."""
    sets = Sets()
    for batch in batches:
        out = []
        for a, ta, b, tb in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), batch.column(3), strict=True):
            x, y = sets.of(a, ta), sets.of(b, tb)
            if is_linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)):
                out.append((a, b))
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in out], pa.int64()), pa.array([p[1] for p in out], pa.int64())], names=["a", "b"])


class Union:
    """Components within one pair of tiles."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x

    def join(self, x: int, y: int) -> None:
        self.up[self.root(x)] = self.root(y)


def meet(table: pa.Table) -> pa.Table:
    """One pair of tiles of a neighbourhood: rows (outside, node, label, set). Links between those outside the largest
    component and all others, no more than join two components."""
    outside = np.array(table.column("outside").to_pylist(), dtype=bool)
    node, label = table.column("node").to_numpy(), table.column("label").to_numpy()
    sets = [np.frombuffer(x.as_py(), dtype="<u8") for x in table.column("set")]
    sizes, least = np.array([len(s) for s in sets], dtype=np.int64), np.array([s[0] for s in sets], dtype=np.uint64)
    names, known = np.unique(label, return_inverse=True)
    mine, others = np.flatnonzero(outside), np.flatnonzero(~outside)
    out: list[tuple[int, int]] = []
    if len(mine) and len(others):
        words = len(signature(sets[int(sizes.argmin())], FULL_BITS))
        side = [planted([signature(sets[k], FULL_BITS) for k in at], sizes[at], known[at].astype(np.int64), least[at], words) for at in (mine, others)]
        joined = Union()
        for i, j in traversal(side[0][0], side[1][0]):
            for x, y in zip(mine[side[0][1][i]].tolist(), others[side[1][1][j]].tolist(), strict=True):
                if joined.root(int(known[x])) != joined.root(int(known[y])) and is_linked(
                    len(np.intersect1d(sets[x], sets[y], assume_unique=True)), int(sizes[x]), int(sizes[y])
                ):
                    joined.join(int(known[x]), int(known[y]))
                    out.append((int(node[x]), int(node[y])))
    return pa.table({"a": pa.array([p[0] for p in out], pa.int64()), "b": pa.array([p[1] for p in out], pa.int64())})


def infrequent(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Necessary shingles (shingle, node, n) among the infrequent of the lower hash space, and the deficient nodes."""
    need = (F.col("n") - F.ceil(F.col("n") * UNION_PER / COMMON_PER) + 1).cast("int")
    narrow = nodes.select("node", "__id", "__h", "n", need.alias("need"), F.size("lower").alias("size"))
    rows = nodes.select("node", F.posexplode("lower").alias("at", "shingle"))
    counts = rows.groupBy("shingle").count().where("count > 1").select("shingle", (F.col("count") > FREQUENT).alias("frequent"))
    shared = written(rows.join(counts, "shingle"), "shared")
    before = Window.partitionBy("node").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = shared.withColumn("frequent_before", F.sum(F.col("frequent").cast("int")).over(before))
    kept = placed.where(~F.col("frequent")).join(narrow.select("node", "n", "need"), "node")
    kept = kept.where(F.col("at") - F.col("frequent_before") < F.col("need")).select("shingle", "node", "n")
    lost = shared.where("frequent").groupBy("node").agg(F.count("*").alias("lost"))
    deficient = narrow.join(lost, "node", "left").where(F.col("size") - F.coalesce("lost", F.lit(0)) < F.col("need"))
    return kept, deficient.select("node", "__id", "__h")


def by_frequency(sets: DataFrame) -> DataFrame:
    """Necessary shingles (shingle, node, n) of whole sets, the rarest first."""
    rows = sets.mapInArrow(hashes_of, "node long, n long, need long, shingle long")
    counts = rows.groupBy("shingle").count()
    order = Window.partitionBy("node").orderBy("count", "shingle")
    placed = rows.join(counts, "shingle").withColumn("place", F.row_number().over(order))
    return placed.where((F.col("place") <= F.col("need")) & (F.col("count") > 1)).select("shingle", "node", "n")


def texts_of(documents: DataFrame, asked: DataFrame) -> DataFrame:
    """(node, text) for nodes named by the key of one of their rows."""
    named = asked.select("node", F.col("__id").alias("i"), F.col("__h").alias("h"))
    found = documents.join(named, (F.col("__h") == F.col("h")) & F.col("__id").eqNullSafe(F.col("i")))
    return found.select("node", "text").dropDuplicates(["node"])


def confirmed(pairs: DataFrame, documents: DataFrame, nodes: DataFrame) -> DataFrame:
    """The linked ones of the pairs (a, b)."""
    asked = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct().join(nodes.select("node", "__id", "__h"), "node")
    texts = written(texts_of(documents, asked), "texts")
    side = lambda c: texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}"))
    full = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "text_a", "b", "text_b")
    links = written(full.mapInArrow(confirm, "a long, b long"), "links")
    dropped(texts)
    return links


def similar_documents(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: __id, __h (row key), n (set size), component (least id reachable by links)."""
    keyed = documents.select(*row_key(id_col, text_col), F.col(text_col).alias("text"))
    schema = T.StructType([keyed.schema["__id"], *T._parse_datatype_string("__h long, node long, n long, lower array<long>, bits binary").fields])
    sketched = written(keyed.mapInArrow(sketches, schema), "sketches")
    key = F.struct(F.col("__id").isNull().alias("none"), "__id", "__h")
    nodes = written(
        sketched.where("n > 0").groupBy("node").agg(F.min(key).alias("row"), F.first("n").alias("n"), F.first("lower").alias("lower"), F.first("bits").alias("bits"))
        .select("node", "row.__id", "row.__h", "n", "lower", "bits"), "nodes",
    )
    rows = written(sketched.select("__id", "__h", "n", "node"), "rows")
    dropped(sketched)
    names = written(nodes.select("node", "__id", "__h", "n"), "names")
    kept, deficient = infrequent(nodes)
    sets = written(texts_of(keyed, written(deficient, "deficient")).mapInArrow(whole_sets, "node long, n long, set binary"), "sets")
    places = written(kept.withColumn("deficient", F.lit(False)).unionByName(by_frequency(sets).withColumn("deficient", F.lit(True))), "places")
    place = ["shingle", "deficient"]
    sizes = written(places.groupBy(*place).agg(F.count("*").alias("members"), F.min("node").alias("hub")).where("members > 1"), "sizes")
    members = places.join(sizes, place)
    pairs = written(trees(members.where(F.col("members") <= FREQUENT), nodes, place).distinct(), "pairs")
    dropped(nodes)
    large = written(members.where(F.col("members") > FREQUENT).select("shingle", "node", "n", "hub"), "large")
    stars = large.where("node <> hub").join(names.select(F.col("node").alias("hub"), F.col("n").alias("m")), "hub")
    stars = stars.where(COMMON_PER * F.least("n", "m") >= UNION_PER * F.greatest("n", "m")).select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b"))
    first = written(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b").union(stars).distinct(), "first")
    links = confirmed(first, keyed, names)
    labels = components(links)
    side = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"label_{c}"))
    known = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left").where(F.coalesce("label_a", "a") != F.coalesce("label_b", "b"))
    left = written(known.select("a", "b").join(first, ["a", "b"], "left_anti"), "left")
    links = links.unionByName(confirmed(left, keyed, names)).unionByName(between(large, labels, sets))
    labels = components(links)
    least = labels.join(names.select("node", "__id"), "node").groupBy("label").agg(F.min("__id").alias("component"))
    named = written(labels.join(least, "label").select("node", "component"), "named")
    own = names.select("node", F.col("__id").alias("own")).join(named, "node", "left")
    return rows.select("__id", "__h", "n", "node").join(own, "node", "left").select(
        "__id", "__h", "n", F.coalesce("component", "own", "__id").alias("component")
    )


def trees(members: DataFrame, nodes: DataFrame, place: list[str]) -> DataFrame:
    """Candidate pairs (a, b) of small neighbourhoods (*place, node, n): a tree for each run of sizes that can match."""
    by_size = Window.partitionBy(*place).orderBy("n", "node")
    gap = COMMON_PER * F.lag("n").over(by_size) < UNION_PER * F.col("n")
    runs = members.withColumn("gap", F.coalesce(gap, F.lit(False)).cast("int")).withColumn("run", F.sum("gap").over(by_size))
    lists = runs.groupBy(*place, "run").agg(F.sort_array(F.collect_list("node")).alias("nodes")).where(F.size("nodes") > 1)
    same = written(lists.select("nodes").distinct().select(F.xxhash64("nodes").alias("place"), F.explode("nodes").alias("node")), "runs")
    grown = same.join(nodes.select("node", "n", "bits"), "node").groupBy("place").agg(F.collect_list(F.struct("node", "n", "bits")).alias("m"))
    return grown.select("m.node", "m.n", "m.bits").mapInArrow(tree_pairs, "a long, b long")


def between(large: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between components that meet in a large neighbourhood."""
    known = large.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    placed = written(known.join(sets.select("node", F.octet_length("set").alias("bytes")), "node"), "labelled")
    by_label = placed.groupBy("shingle", "label").agg(F.count("*").alias("k"), F.sum("bytes").alias("bytes"))
    least = F.min(F.struct((-F.col("k")).alias("k"), "label", "bytes"))
    open_ones = by_label.groupBy("shingle").agg(least.alias("main"), F.sum("k").alias("all"), F.sum("bytes").alias("bytes"), F.count("*").alias("labels")).where("labels > 1")
    tiles = lambda rows, size: F.greatest(F.ceil(rows / TILE), F.ceil(size / TILE_BYTES)).cast("int")
    open_ones = written(
        open_ones.select(
            "shingle", F.col("main.label").alias("largest"), tiles(F.col("all"), F.col("bytes")).alias("wide"),
            tiles(F.col("all") + F.col("main.k"), F.col("bytes") - F.col("main.bytes")).alias("high"),
        ), "open",
    )
    rows = placed.select("shingle", "node", "label").join(open_ones, "shingle")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    deal = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    others = rows.select("*", F.lit(False).alias("outside"), deal("wide").alias("x"), every("high").alias("y"))
    outside = rows.where("label <> largest").select("*", F.lit(True).alias("outside"), every("wide").alias("x"), deal("high").alias("y"))
    full = others.unionByName(outside).join(sets.select("node", "set"), "node").select("shingle", "x", "y", "outside", "node", "label", "set")
    return written(full.groupBy("shingle", "x", "y").applyInArrow(meet, "a long, b long"), "links")
