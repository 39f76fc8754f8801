"""Alignment of two tokenizers' tokens over the same bytes, by diagonal run skipping.

Both encodings of a text are arrays of token ends, as byte offsets. Where tokens correspond one
to one the two arrays run equal at a constant index shift. From a place where both sides end
together the arrays are compared at the current shift: ``FIRST`` entries one by one, as most runs are short,
then as many at a time, then twice as many, and so on; the first bit that differs in the first unequal probe ends the run, which is jumped as that many
groups of one token each. What follows is an irregular group: the side that lies behind advances until both
end together, and the shift changes by the difference of the two sides' tokens.

A group of p and q tokens has p + q - 1 links: the pairs of tokens whose bytes overlap. How often
an id pair is linked in the corpus needs all documents: each document's links are kept as packed
pair codes (4 bytes), counted with a partial sum per task, and looked up again. The ``COMMON``
most frequent pairs (a fixed number, whatever the corpus) travel to the tasks, which add up what
they cover; links of rarer pairs meet their counts in a join, a row per document and pair.

Defined cases: a text that is null or empty, or for which either side's bytes joined are not a space and
the text, has no tokens: zeros and the empty digest column; special tokens' strings are plain text; repeated
rows count each; null ids are rows like any other; other columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.bpe import PLAIN
from eventloom.llm.common import dropped, written

#: Pairs whose counts the tasks hold: 6 MB.
COMMON = 1 << 19
#: Entries compared one by one, and entries of the first probe.
FIRST = 16
#: Bytes encoded at a time, and distinct pairs a task counts before it hands them on.
BLOCK = 1 << 20
HELD = 1 << 20
ALIGNED = "__row string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"

#: Byte-level symbols: printable Latin-1 bytes stand for themselves, the others follow at 256 in order.
OTHERS = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b)]
BYTE_OF = {chr(b): b for b in range(256) if b not in OTHERS} | {chr(256 + n): b for n, b in enumerate(OTHERS)}


#: The byte-level pre-tokenizer's rule (a fixed value of such files).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteLevel:
    """A byte-level tokenizer file: ids of a text, and every id's bytes. Plain text goes through the faster
    encoder of the same merges, if the file's ids are their ranks; characters on whose class Unicode
    versions may differ go through the file's own library."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_str(spec)
        self.lib.no_truncation()
        self.lib.no_padding()
        self.lib.encode_special_tokens = True
        parsed = json.loads(spec)
        added = {x["id"]: x["content"].encode() for x in parsed["added_tokens"]}
        vocab = self.lib.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes[i] = added[i] if i in added else bytes(BYTE_OF[c] for c in token)
        self.fast = None
        rule = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        merges = [m if isinstance(m, list) else m.split(" ") for m in parsed["model"]["merges"]]
        ranked = all(vocab.get(x + y) == 256 + k for k, (x, y) in enumerate(merges)) and all(len(self.bytes[k]) == 1 for k in range(256))
        if ranked and parsed["normalizer"] is None and rule.items() <= (parsed["pre_tokenizer"] or {}).items():
            from tiktoken import Encoding

            self.fast = Encoding("ranks", pat_str=SPLIT, mergeable_ranks={x: i for i, x in enumerate(self.bytes) if i not in added}, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        plain = [self.fast is not None and PLAIN.fullmatch(t) is not None for t in texts]
        rest = iter(self.lib.encode_batch_fast([t for t, p in zip(texts, plain, strict=True) if not p], add_special_tokens=False))
        return [self.fast.encode_ordinary(t) if p else next(rest).ids for t, p in zip(texts, plain, strict=True)]


class Pieces:
    """A piece model: ids of a text, and every id's bytes. The model adds the leading space itself."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.lib = SentencePieceProcessor(model_proto=model)
        self.bytes = []
        for i in range(self.lib.get_piece_size()):
            piece = self.lib.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.lib.is_byte(i) else piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.lib.encode(texts, num_threads=1)


def diagonal(a: bytes, b: bytes, i: int, j: int, most: int) -> int:
    """How many ends (4 bytes each) from a[i], b[j] on are equal one to one, by exponential probing."""
    at, reach = 0, FIRST
    while at < most:
        if at + reach > most:
            reach = most - at
        x, y = a[4 * (i + at) : 4 * (i + at + reach)], b[4 * (j + at) : 4 * (j + at + reach)]
        if x != y:  # the lowest bit that differs lies in the first unequal end
            differ = int.from_bytes(x, "little") ^ int.from_bytes(y, "little")
            return at + ((differ & -differ).bit_length() - 1) // 32
        at += reach
        reach *= 2
    return at


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of one-to-one groups (first a, first b, length) and irregular groups (first a, first b, a tokens, b tokens), a
    row each, and the token places of the latter's links. Both sides end at the same byte."""
    a, b = ends_a.astype("<u4").tobytes(), ends_b.astype("<u4").tobytes()  # a value of a column has fewer than 2^31 bytes
    list_a, list_b = ends_a.tolist(), ends_b.tolist()
    size_a, size_b = len(list_a), len(list_b)
    i = j = 0  # the shift is j - i
    runs: list[int] = []  # flat: a tuple for each run would be work for the garbage collection
    irregular: list[int] = []
    walk_a: list[int] = []
    walk_b: list[int] = []
    while i < size_a:
        if list_a[i] == list_b[j]:
            most, run = min(size_a - i, size_b - j), 1
            short = min(FIRST, most)
            while run < short and list_a[i + run] == list_b[j + run]:
                run += 1
            if run == FIRST:
                run += diagonal(a, b, i + run, j + run, most - run)
            runs += i, j, run
            i += run
            j += run
            if i == size_a:
                break
        p, q = i, j
        x, y = list_a[p], list_b[q]
        while True:  # neighbours overlap until both end together
            walk_a.append(p)
            walk_b.append(q)
            if x < y:
                p += 1
                x = list_a[p]
            elif y < x:
                q += 1
                y = list_b[q]
            else:
                break
        irregular += i, j, p + 1 - i, q + 1 - j
        i, j = p + 1, q + 1
    return tuple(np.array(x, dtype=np.int64).reshape(shape) for x, shape in ((runs, (-1, 3)), (irregular, (-1, 4)), (walk_a, -1), (walk_b, -1)))


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every stretch, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


class Spelling:
    """Short byte strings by number, side by side, to spell many of them at once."""

    def __init__(self, strings: list[bytes]):
        self.sizes = np.array([len(x) for x in strings], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(strings), dtype=np.uint8)

    def joined(self, numbers: np.ndarray) -> bytes:
        return self.flat[spread(self.starts[numbers], self.sizes[numbers])].tobytes()


def names(n: int, signs: str) -> np.ndarray:
    """The ids as text, each with the sign that follows it and zero bytes up to 8: all with the first sign, then all with the second."""
    return np.array([f"{k}{sign}".encode() for sign in signs for k in range(n)], dtype="S8").view(np.uint64)


class Aligner:
    """Both tokenizers in one worker."""

    def __init__(self, spec: str, model: bytes):
        self.a, self.b = ByteLevel(spec), Pieces(model)
        if max(len(self.a.bytes), len(self.b.bytes)) > 1 << 16:
            raise ValueError("a pair code has 16 bits for an id")
        self.spelt_a, self.spelt_b = Spelling(self.a.bytes), Spelling(self.b.bytes)
        self.size_a, self.size_b = self.spelt_a.sizes, self.spelt_b.sizes
        self.names_a, self.names_b = names(len(self.a.bytes), ",|"), names(len(self.b.bytes), ",;")

    def said(self, ids_a: np.ndarray, ids_b: np.ndarray, irregular: np.ndarray) -> bytes:
        """All groups as text: every id in its place, with the sign that follows it."""
        last_a, last_b = np.ones(len(ids_a), dtype=bool), np.ones(len(ids_b), dtype=bool)
        for last, first, size in ((last_a, irregular[:, 0], irregular[:, 2]), (last_b, irregular[:, 1], irregular[:, 3])):
            last[spread(first, size)] = False
            last[first + size - 1] = True
        until_a, until_b = np.flatnonzero(last_a) + 1, np.concatenate([[0], np.flatnonzero(last_b) + 1])
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        out = np.empty(len(ids_a) + len(ids_b), dtype=np.uint64)
        out[np.arange(len(ids_a)) + until_b[group_a]] = self.names_a[ids_a + len(self.size_a) * last_a]
        out[np.arange(len(ids_b)) + until_a[group_b]] = self.names_b[ids_b + len(self.size_b) * last_b]
        return out.tobytes().translate(None, b"\0")[:-1]

    def document(self, data: bytes, a: list[int], b: list[int]) -> tuple[int, int, int, int, str, bytes]:
        """(n_a, n_b, n_groups, n_links, groups_sha256, sorted pair codes) of a text with its leading space."""
        ids_a, ids_b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        if self.spelt_a.joined(ids_a) != data or self.spelt_b.joined(ids_b) != data:
            return 0, 0, 0, 0, "", b""
        runs, irregular, walk_a, walk_b = align(self.size_a[ids_a].cumsum(), self.size_b[ids_b].cumsum())
        at_a = np.concatenate([spread(runs[:, 0], runs[:, 2]), walk_a])
        at_b = np.concatenate([spread(runs[:, 1], runs[:, 2]), walk_b])
        codes = (ids_a[at_a] << 16 | ids_b[at_b]).astype("<u4")
        codes.sort()
        groups = int(runs[:, 2].sum()) + len(irregular)
        said = self.said(ids_a, ids_b, irregular)
        return len(a), len(b), groups, len(codes), hashlib.sha256(said).hexdigest(), codes.tobytes()


def aligned(spec: str, model: bytes):
    """(id, text) -> the id and ALIGNED."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        aligner, mark, number = Aligner(spec, model), uuid.uuid4().hex, 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
            at = 0
            while at < batch.num_rows:
                end, held = at, 0
                while end < batch.num_rows and (end == at or held < BLOCK):
                    held += int(sizes[end])
                    end += 1
                some = batch.slice(at, end - at)
                texts = some.column(1).to_pylist()
                full = [t for t in texts if t]
                found = zip(full, aligner.a.encode([" " + t for t in full]), aligner.b.encode(full), strict=True)
                done = []
                for t in texts:
                    if not t:
                        done.append((0, 0, 0, 0, "", b""))
                    else:
                        _, a, b = next(found)
                        done.append(aligner.document(b" " + t.encode(), a, b))
                rows = [f"{mark}-{number + k}" for k in range(len(texts))]
                number += len(texts)
                kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(rows, pa.string()), *(pa.array([d[k] for d in done], kind) for k, kind in enumerate(kinds))],
                    names=["__id", "__row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"],
                )
                at = end

    return run


def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(links) -> (code, n): counts of a task's links."""
    held_codes, held_counts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def merged(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        unique, back = np.unique(codes, return_inverse=True)
        total = np.zeros(len(unique), dtype=np.int64)
        np.add.at(total, back, counts)
        return unique, total

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held_codes), pa.array(held_counts)], names=["code", "n"])

    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            some = batch.slice(at, 256).column(0)
            codes, counts = np.unique(np.frombuffer(b"".join(x.as_py() for x in some), "<u4").astype(np.int64), return_counts=True)
            held_codes, held_counts = merged(np.concatenate([held_codes, codes]), np.concatenate([held_counts, counts]))
            if len(held_codes) > HELD:
                yield rows()
                held_codes, held_counts = held_codes[:0], held_counts[:0]
    if len(held_codes):
        yield rows()


def scored(common):
    """Aligned rows -> the same without their links, with n_best and count_sum over links of common pairs, and the codes
    of the others with how often the document links them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, best = common.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                n_best, count_sum, rare, times = [], [], [], []
                for x in some.column(some.schema.get_field_index("links")):
                    mine, k = np.unique(np.frombuffer(x.as_py(), "<u4").astype(np.int64), return_counts=True)
                    place = np.minimum(np.searchsorted(codes, mine), max(0, len(codes) - 1))
                    known = codes[place] == mine if len(codes) else np.zeros(len(mine), dtype=bool)
                    here = place[known]
                    n_best.append(int(k[known][best[here]].sum()))
                    count_sum.append(int((counts[here] * k[known]).sum()))
                    rare.append(mine[~known])
                    times.append(k[~known])
                more = [pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), pa.array(rare, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int64()))]
                kept = [n for n in some.schema.names if n != "links"]
                yield pa.RecordBatch.from_arrays([*(some.column(some.schema.get_field_index(n)) for n in kept), *more], names=[*kept, "n_best", "count_sum", "rare", "times"])

    return run


def counted(links: DataFrame) -> DataFrame:
    """(links) -> (code, n, best): every linked id pair's count, and whether it is its B id's highest."""
    counts = written(links.mapInArrow(tally, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")), "pairs")
    b = F.col("code").bitwiseAND(65535)
    highest = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))  # a row for each B id: its vocabulary bounds it
    return counts.join(highest, b == F.col("b")).select("code", "n", (F.col("n") == F.col("most")).alias("best"))


def common_pairs(pairs: DataFrame, most: int = COMMON):
    """The most frequent pairs, at most ``most``, as sorted arrays, and a condition for those left out.
    Frequencies are cut by twelfths of an octave: a level that doesn't fit is left out whole."""
    level = F.floor(12 * F.log2("n")).cast("int")
    least, held = None, 0
    for r in pairs.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        if held + r["count"] > most:
            break
        least, held = r["level"], held + r["count"]
    if least is None:
        return (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)), pairs
    got = pairs.where(level >= least).select("code", "n", "best").toArrow().sort_by("code")
    arrays = tuple(got.column(c).to_numpy() for c in ("code", "n", "best"))
    return arrays, pairs.where(level < least)


def align_tokens(docs: DataFrame, byte_level: str, piece_model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. The two tokenizer
    files are read on the driver and go to the workers (a few MB)."""
    with open(byte_level, encoding="utf-8") as f:
        spec = f.read()
    with open(piece_model, "rb") as g:
        model = g.read()
    spark = docs.sparkSession
    keyed = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    schema = T.StructType([keyed.schema["__id"], *T._parse_datatype_string(ALIGNED).fields])
    rows = written(keyed.mapInArrow(aligned(spec, model), schema), "aligned")
    pairs = written(counted(rows.select("links")), "counts")
    arrays, others = common_pairs(pairs)
    common = spark.sparkContext.broadcast(arrays)
    more_fields = T._parse_datatype_string("n_best long, count_sum long, rare array<long>, times array<long>").fields
    sums = written(rows.mapInArrow(scored(common), T.StructType([f for f in rows.schema.fields if f.name != "links"] + more_fields)), "sums")
    dropped(rows)
    rare = sums.select("__row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("__row", F.col("x.rare").alias("code"), F.col("x.times").alias("k"))
    more = rare.join(others, "code").groupBy("__row").agg(
        F.sum(F.when(F.col("best"), F.col("k")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("k")).alias("more_sum")
    )
    return sums.join(more, "__row", "left").select(
        F.col("__id").alias(id_col), "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256",
    )
