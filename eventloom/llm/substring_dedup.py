"""Substring dedup: suffix automata of reference shards, matching statistics, removal of repeated spans.

A window of ``WINDOW`` words is removed if its words also start anywhere else. Each window is named by
its anchor, the least-hashed run of ``GRAM`` words in it (the leftmost of equals): equal windows have
equal anchors, so they meet in one shard however the corpus is spread. Consecutive windows with one
anchor form a segment. An anchor that occurs once has no repeated window; if all its segments are
equal, all their windows repeat. For the other anchors the distinct segments, with their numbers of
occurrences, are the reference: each shard builds the suffix automaton of an anchor's segments, adds
up occurrences along its suffix links, and streams the segments through it for their matching
statistics, capped at the window's length. A window repeats if the state that its last ``WINDOW``
words reach has two occurrences or more.

Automata are sent to the segments that can match them and not to all documents: broadcasting every
shard to every document would cost shards times corpus. An anchor with more than ``HOT`` distinct
segments (a line that a third of all documents share) is dealt out further: each of its windows
is a shard of its own, keyed by 128 bits of its content, where an automaton would be one chain; the
grouping counts it, and equal windows are added up before they are shuffled.

Defined cases: null and empty texts have no words; texts of fewer words than a window keep them
all; in repeated rows everything from a window's length on repeats and goes from each; null ids are
ids like any other; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm import shingles
from eventloom.llm.common import row_key, written

WINDOW = 35
GRAM = 5
HOT = 1000
#: Distinct segments of a shard, about.
SHARD = 2000


def runs_hash(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums and inverse powers, from which the hash of any run of words is taken."""
    up, down = shingles.powers(shingles.BASE, len(hashes) + 1), shingles.powers(shingles.INVERSE, len(hashes) + 1)
    return np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(hashes * up[:-1], dtype=np.uint64))), down


def anchors(hashes: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one document's words: each segment's anchor position, first and last window."""
    view = np.lib.stride_tricks.sliding_window_view(grams, WINDOW - GRAM + 1)
    at = view.argmin(axis=1) + np.arange(len(view))
    edge = np.flatnonzero(at[1:] != at[:-1]) + 1
    first = np.concatenate(([0], edge))
    return at[first], first, np.concatenate((edge, [len(at)])) - 1


def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(__id, __h, text) -> (__id, __h, anchor, digest, place) of every segment; place: first * 2^32 + last window."""
    hasher = shingles.Hasher(lower=False)
    for batch in batches:
        done = 0
        for _, texts in shingles.blocks(batch.column(2).to_pylist()):
            hashes, _, _, owner = hasher.words(texts)
            cut = np.searchsorted(owner, np.arange(len(texts) + 1))
            grams = shingles.grams(hashes, GRAM)
            rows, names, digests, places = [], [], [], []
            for k, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
                if b - a < WINDOW:
                    continue
                gram = grams[a : b - GRAM + 1]
                at, first, last = anchors(hashes[a:b], gram)
                sums, down = runs_hash(hashes[a:b])
                end = last + WINDOW
                rows.append(np.full(len(at), done + k))
                names.append(gram[at])
                digests.append(shingles.mix((sums[end] - sums[first]) * down[first] + (end - first).astype(np.uint64)))
                places.append(first.astype(np.int64) << 32 | last)
            done += len(texts)
            if rows:
                index = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(index), batch.column(1).take(index), pa.array(np.concatenate(names).view(np.int64)), pa.array(np.concatenate(digests).view(np.int64)), pa.array(np.concatenate(places))],
                    names=["__id", "__h", "anchor", "digest", "place"],
                )


class Automaton:
    """The suffix automaton of several sequences; count: occurrences of a state's words in all of them."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def state(self, length: int, moves: dict, link: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.count.append(0)
        return len(self.next) - 1

    def clone(self, p: int, word, q: int) -> int:
        copy = self.state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def extended(self, last: int, word) -> int:
        q = self.next[last].get(word)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self.clone(last, word, q)
        new, p = self.state(self.length[last] + 1, {}, 0), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self.clone(p, word, q)
        return new

    def add(self, words: list, times: int) -> None:
        last = 0
        for word in words:
            last = self.extended(last, word)
            self.count[last] += times

    def settle(self) -> None:
        """Adds up occurrences along the suffix links, longest states first."""
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            self.count[self.link[s]] += self.count[s]

    def repeated(self, words: list, window: int) -> list[bool]:
        """Of each window of the sequence: whether it occurs twice or more. state and matched are the matching
        statistics at the current word, matched capped at the window."""
        state, matched, out = 0, 0, []
        for k, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state, matched = self.next[state][word], matched + 1
            while self.length[self.link[state]] >= window:
                state = self.link[state]
            matched = min(matched, window)
            if k >= window - 1:
                out.append(matched == window and self.count[state] >= 2)
        return out


def spans(flags: list[bool]) -> list[int]:
    """first, last, first, last, ... of the runs of true."""
    out, at = [], 0
    for value, some in groupby(flags):
        n = len(list(some))
        if value:
            out += [at, at + n - 1]
        at += n
    return out


def match(table: pa.Table) -> pa.Table:
    """A shard: rows (anchor, digest, times, words) -> (anchor, digest, runs)."""
    rows = sorted(table.select(["anchor", "digest", "times", "words"]).to_pylist(), key=lambda r: r["anchor"])
    out = []
    for anchor, some in groupby(rows, key=lambda r: r["anchor"]):
        automaton, held = Automaton(), [(r["digest"], r["times"], r["words"].split()) for r in some]
        for _, times, words in held:
            automaton.add(words, times)
        automaton.settle()
        out += [{"anchor": anchor, "digest": digest, "runs": spans(automaton.repeated(words, WINDOW))} for digest, _, words in held]
    return pa.Table.from_pylist(out, pa.schema([("anchor", pa.int64()), ("digest", pa.int64()), ("runs", pa.list_(pa.int32()))]))


def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, wanted: [(anchor, digest, times, place, hot)]) -> the segments' words; of hot ones each window's hash (w1, w2, at)."""
    hasher = shingles.Hasher(lower=False)
    fields = pa.schema([("anchor", pa.int64()), ("digest", pa.int64()), ("times", pa.int64()), ("words", pa.binary()), ("w1", pa.int64()), ("w2", pa.int64()), ("at", pa.int32())])
    for batch in batches:
        out = []
        for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            data = text.encode("utf-8", "replace")
            words, hashes = data.split(), None
            for w in wanted:
                first, last = w["place"] >> 32, w["place"] & 0xFFFFFFFF
                row = {"anchor": w["anchor"], "digest": w["digest"], "times": w["times"]}
                if not w["hot"]:
                    out.append(row | {"words": b" ".join(words[first : last + WINDOW])})
                    continue
                if hashes is None:
                    hashes = hasher.words([data])[0]
                part = hashes[first : last + WINDOW]
                w1 = shingles.grams(part, WINDOW).view(np.int64).tolist()
                w2 = shingles.grams(shingles.mix(part + np.uint64(1)), WINDOW).view(np.int64).tolist()
                out += [row | {"w1": a, "w2": b, "at": k} for k, (a, b) in enumerate(zip(w1, w2, strict=True))]
            if len(out) > 5000:
                yield pa.RecordBatch.from_pylist(out, fields)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, fields)


def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(__id, text, runs: [[first, last window, ...]]) -> (__id, n_words, n_removed, kept)."""
    for whole in batches:
        for at in range(0, whole.num_rows, 1000):
            batch = whole.slice(at, 1000)
            total, gone, kept = [], [], []
            for text, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = text.encode("utf-8", "replace").split() if text else []
                total.append(len(words))
                if runs:
                    stay = np.ones(len(words), dtype=bool)
                    for first, last in zip(runs[0::2], runs[1::2], strict=True):
                        stay[first : last + WINDOW] = False
                    words = [words[k] for k in np.flatnonzero(stay)]
                gone.append(total[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], names=["__id", "n_words", "n_removed", "kept"])


def remove_repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_words, n_removed, kept (the text that stays, words joined by one space)."""
    docs = documents.select(*row_key(id_col, text_col), F.col(text_col).alias("text"))
    keys = [docs.schema["__id"], docs.schema["__h"]]
    longs = [T.StructField(n, T.LongType()) for n in ("anchor", "digest", "place")]
    found = written(docs.mapInArrow(segments, T.StructType([*keys, *longs])), "segments")
    often = found.groupBy("anchor").agg(F.count("*").alias("times"), F.min("digest").alias("least"), F.max("digest").alias("most")).where("times > 1")
    often = written(often.select("anchor", (F.col("least") != F.col("most")).alias("differ")), "anchors")
    shared = written(found.join(often, "anchor"), "shared")
    # one occurrence of each distinct segment spells it
    reference = shared.where("differ").groupBy("anchor", "digest").agg(F.count("*").alias("times"), F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", "__h", "place")).alias("r"))
    reference = written(reference.select("anchor", "digest", "times", "r.__id", "r.__h", "r.place"), "reference")
    sizes = reference.groupBy("anchor").count().where(F.col("count") > HOT)
    hot = written(sizes.select("anchor", F.lit(True).alias("hot")), "hot")
    wanted = reference.join(hot, "anchor", "left").groupBy("__id", "__h").agg(
        F.collect_list(F.struct("anchor", "digest", "times", "place", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("wanted")
    )
    shards = max(1, reference.count() // SHARD)
    texts = docs.join(wanted.withColumnsRenamed({"__id": "i", "__h": "h"}), (F.col("__h") == F.col("h")) & F.col("__id").eqNullSafe(F.col("i")))
    spelt = texts.select("text", "wanted").mapInArrow(spelled, "anchor long, digest long, times long, words binary, w1 long, w2 long, at int")
    spelt = written(spelt, "spelt")
    pieces = spelt.where(F.col("words").isNotNull()).select("anchor", "digest", "times", "words").dropDuplicates(["anchor", "digest"])
    runs = pieces.withColumn("shard", F.pmod("anchor", F.lit(shards))).groupBy("shard").applyInArrow(match, "anchor long, digest long, runs array<int>")
    windows = spelt.where(F.col("words").isNull()).select("anchor", "digest", "times", "w1", "w2", "at").dropDuplicates(["anchor", "digest", "at"])
    twice = written(windows.groupBy("w1", "w2").agg(F.sum("times").alias("n")).where("n > 1").select("w1", "w2"), "windows")
    of_hot = windows.join(twice, ["w1", "w2"]).groupBy("anchor", "digest").agg(F.flatten(F.collect_list(F.array("at", "at"))).alias("runs"))
    runs = written(runs.where(F.size("runs") > 0).unionByName(of_hot), "runs")
    first = F.shiftright("place", 32).cast("int")
    whole = shared.where(~F.col("differ")).select("__id", "__h", F.array(first, F.col("place").bitwiseAND(0xFFFFFFFF).cast("int")).alias("runs"))
    moved = shared.where("differ").join(runs, ["anchor", "digest"]).select("__id", "__h", F.transform("runs", lambda x: x + first).alias("runs"))
    # a row that repeats a million times has one set of runs, merged on the map side
    gone = whole.unionByName(moved).groupBy("__id", "__h").agg(F.flatten(F.collect_set("runs")).alias("runs"))
    gone = gone.withColumnsRenamed({"__id": "i", "__h": "h"})
    marked = docs.join(gone, (F.col("__h") == F.col("h")) & F.col("__id").eqNullSafe(F.col("i")), "left").select("__id", "text", "runs")
    schema = T.StructType([keys[0], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])
    return marked.mapInArrow(cleaned, schema).withColumnRenamed("__id", id_col)
