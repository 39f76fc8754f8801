"""BPE encoding and decoding with a public tokenizer file, long unsplit text by tree concatenation.

White space always ends a word, so a text of more than ``PIECE`` characters is cut behind
white space into pieces that are encoded apart, on different tasks. A word that is itself
longer than ``LEAF`` characters (text that nothing splits) is normalised, halved until its
leaves are short enough, and the leaves are encoded in parallel. Neighbours are then
concatenated pairwise, up the tree: a window around the join is encoded again and grown
until one of its tokens falls together with a token of the left side and a later one
with a token of the right side. As each adjacent pair of tokens in the result then
occurs in a right encoding, and the merges of a rank file make a sequence right exactly if
each adjacent pair is, the result is the encoding of the whole.

Words of ordinary Latin text repeat; a bounded memory of word -> ids (``WORDS`` entries) spares
the tokenizer most of them. Text with any character for which the tokenizer's own
normalisation or splitting could differ from ours is handed to it whole.

Defined cases: a null text encodes like the empty one, to no ids and an empty decoded
text; special tokens' strings in a text become their ids, as the library does; repeated
rows and null ids are rows like any other; other columns are kept unless they bear a
result's name.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate, groupby

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.common import written

PIECE = 1 << 16
LEAF = 1 << 12
WORDS = 200_000
#: Characters that NFC keeps, whose lower case is one plain character, and on whose class all Unicode versions agree.
PLAIN = re.compile("[\t\n\r\x20-\x7e¡-āĂ-įĲ-ňŊ-ž]*")
SPACE = re.compile("[ \n\t\r]")
PARTS = pa.schema([("__row", pa.int64()), ("seq", pa.int32()), ("kind", pa.string()), ("number", pa.int32()), ("part", pa.string())])
OWN_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _class(kind: str) -> str:
    """The characters up to U+017F (all that PLAIN has) of a Unicode class, spelt out."""
    return re.escape("".join(chr(c) for c in range(0x180) if regex.match(kind, chr(c))))


#: OWN_SPLIT over plain text, with its classes spelt out for the faster engine.
PLAIN_SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d|[{_class(r'\p{L}')}]+|[{_class(r'\p{N}')}]|[^{_class(r'\s')}{_class(r'\p{L}')}{_class(r'\p{N}')}]+"

#: Byte-level symbols: printable Latin-1 bytes stand for themselves, the others follow at 256 in order.
OTHERS = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b)]
SYMBOL = {b: 256 + n for n, b in enumerate(OTHERS)}


class Codec:
    """The tokenizer in one worker, with a memory of words."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_str(spec)
        self.lib.no_truncation()
        self.lib.no_padding()
        parsed = json.loads(spec)
        if parsed["decoder"] is not None or parsed["pre_tokenizer"] is None:
            raise ValueError("a tokenizer file with a pre-tokenizer and without a decoder is expected")
        self.special = [x["content"] for x in parsed["added_tokens"]]
        self.tokens = {i: t for t, i in self.lib.get_vocab(with_added_tokens=True).items()}
        self.bytes = {i: i.to_bytes(4, "little") for i in self.tokens}
        self.suffix = parsed["model"].get("end_of_word_suffix") or ""
        self.own = json.dumps(OWN_SPLIT) in json.dumps(parsed["pre_tokenizer"]) and self.suffix != ""
        self.find = re.compile(PLAIN_SPLIT).findall
        self.memory: dict[str, tuple[bytes, str]] = {}

    def symbols(self, normal: str) -> list[str]:
        """Words of a normalised text, spelt in the alphabet that the merges work on (a character a byte)."""
        return [w for w, _ in self.lib.pre_tokenizer.pre_tokenize_str(normal)]

    def merged(self, symbols: str) -> list[int]:
        return [t.id for t in self.lib.model.tokenize(symbols)]

    def long_word(self, symbols: str) -> list[int]:
        return concatenated(self, [(x, self.merged(x)) for x in halves(symbols)])

    def packed(self, ids: list[int]) -> tuple[bytes, str]:
        return array("I", ids).tobytes(), " ".join([self.tokens[i] for i in ids])

    def word(self, word: str) -> tuple[bytes, str]:
        """Of a word of plain text: its ids as bytes, and its tokens joined by spaces."""
        if len(word) > LEAF:
            return self.packed([i for w in self.symbols(word) for i in self.long_word(w)])
        symbols = word if word.isascii() else word.encode().decode("latin-1").translate(SYMBOL)
        tokens = self.lib.model.tokenize(symbols)
        found = b"".join([self.bytes[t.id] for t in tokens]), " ".join([t.value for t in tokens])
        if len(self.memory) >= WORDS:
            self.memory.clear()
        if len(word) <= 64:
            self.memory[word] = found
        return found

    def plain(self, text: str) -> bool:
        return self.own and PLAIN.fullmatch(text) is not None and not any(s in text for s in self.special)

    def piece(self, text: str) -> tuple[bytes, str]:
        """Of a text between two cuts."""
        if not self.plain(text):
            return self.packed(self.lib.encode(text, add_special_tokens=False).ids)
        get, word = self.memory.get, self.word
        parts = [get(w) or word(w) for w in self.find(text.lower())]
        return b"".join([p[0] for p in parts]), " ".join([p[1] for p in parts])


def halves(word: str) -> list[str]:
    if len(word) <= LEAF:
        return [word]
    return halves(word[: len(word) // 2]) + halves(word[len(word) // 2 :])


def starts(codec: Codec, ids: list[int]) -> list[int]:
    """Offset of every token of one word."""
    sizes = [len(codec.tokens[i].removesuffix(codec.suffix)) for i in ids]
    return list(accumulate(sizes, initial=0))[:-1]


def spliced(codec: Codec, left: tuple[str, list[int]], right: tuple[str, list[int]]) -> tuple[str, list[int]]:
    """Two neighbouring parts of one word -> the encoding of both. The left part's and the window's last
    token bear a word's end mark, which the whole doesn't have there: neither counts as agreement."""
    (x, a), (y, b) = left, right
    text, width = x + y, 8
    at_a, at_b = starts(codec, a), [len(x) + p for p in starts(codec, b)]
    while True:
        lo, hi = max(0, len(a) - width), min(len(b), width)
        begin, whole = at_a[lo], hi == len(b)
        window = codec.merged(text[begin:] if whole else text[begin : at_b[hi]])
        places = list(zip((begin + p for p in starts(codec, window)), window, strict=True))
        in_a = {(at_a[k], a[k]): k for k in range(lo, len(a) - 1)}
        in_b = {(at_b[k], b[k]): k for k in range(hi)}
        first = next(((w, in_a[p]) for w, p in enumerate(places) if p in in_a), (0, 0) if lo == 0 else None)
        if first and whole:
            return text, a[: first[1]] + window[first[0] :]
        if first:
            last = next(((w, in_b[places[w]]) for w in range(len(places) - 2, first[0], -1) if places[w] in in_b), None)
            if last:
                return text, a[: first[1]] + window[first[0] : last[0]] + b[last[1] :]
        width *= 2


def concatenated(codec: Codec, parts: list[tuple[str, list[int]]]) -> list[int]:
    """Leaves of one word -> its ids, pairwise up the tree."""
    while len(parts) > 1:
        parts = [spliced(codec, *parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0][1]


def cut(text: str) -> list[str]:
    """Pieces of about PIECE characters that end behind white space; a run without any stays whole."""
    out, at = [], 0
    while len(text) - at > PIECE:
        end = max(text.rfind(c, at + PIECE // 2, at + PIECE) for c in " \n\t\r")
        if end < 0:
            found = SPACE.search(text, at + PIECE)
            if not found:
                break
            end = found.start()
        out.append(text[at : end + 1])
        at = end + 1
    return [*out, text[at:]]


def parts_of(codec: Codec, text: str) -> Iterator[tuple[str, int, str]]:
    """(kind, number of the long word, part): 'text' pieces as they are; of a piece that nothing splits,
    'words' in merge symbols, parted by spaces, and the 'leaf's of long words."""
    marks = re.compile("(" + "|".join(map(re.escape, codec.special)) + ")") if codec.special else None
    number = 0
    for piece in cut(text):
        if len(piece) <= 2 * PIECE:
            yield "text", 0, piece
            continue
        for k, part in enumerate(marks.split(piece) if marks else [piece]):
            if k % 2:  # a special token
                yield "text", 0, part
                continue
            short: list[str] = []
            held = 0
            for word in codec.symbols(codec.lib.normalizer.normalize_str(part) if codec.lib.normalizer else part):
                if len(word) <= LEAF:
                    short.append(word)
                    held += len(word)
                if short and (len(word) > LEAF or held > PIECE):
                    yield "words", 0, " ".join(short)
                    short, held = [], 0
                if len(word) > LEAF:
                    number += 1
                    for x in halves(word):
                        yield "leaf", number, x
            if short:
                yield "words", 0, " ".join(short)


def split_long(spec: str):
    """(__row, text) -> (__row, seq, kind, number, part)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(spec)
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for seq, (kind, number, part) in enumerate(parts_of(codec, text)):
                    yield pa.RecordBatch.from_pylist([{"__row": row, "seq": seq, "kind": kind, "number": number, "part": part}], PARTS)

    return run


def encode_parts(spec: str):
    """Adds each part's ids; only leaves keep their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(spec)
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["kind"] == "text":
                    ids = codec.piece(r["part"])[0]
                elif r["kind"] == "words":
                    ids = array("I", [i for w in r["part"].split(" ") for i in codec.merged(w)]).tobytes()
                else:
                    ids = array("I", codec.merged(r["part"])).tobytes()
                out.append(r | {"ids": ids, "part": r["part"] if r["kind"] == "leaf" else None})
            yield pa.RecordBatch.from_pylist(out, PARTS.append(pa.field("ids", pa.binary())))

    return run


def assemble(spec: str):
    """All parts of one row -> its ids and decoded text."""

    def run(table: pa.Table) -> pa.Table:
        codec = Codec(spec)
        rows = sorted(table.to_pylist(), key=lambda r: r["seq"])
        ids: list[int] = []
        for (kind, _), some in groupby(rows, key=lambda r: (r["kind"], r["number"])):
            if kind == "leaf":
                ids += concatenated(codec, [(r["part"], list(array("I", r["ids"]))) for r in some])
            else:
                for r in some:
                    ids += array("I", r["ids"])
        packed, decoded = codec.packed(ids)
        return pa.table({"__row": pa.array([rows[0]["__row"]], pa.int64()), "ids": pa.array([packed], pa.binary()), "decoded": pa.array([decoded], pa.string())})

    return run


def encode_short(spec: str, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(spec)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                done = [codec.piece(t) if t else (b"", "") for t in some.column(some.schema.get_field_index("__text")).to_pylist()]
                kept = [some.column(some.schema.get_field_index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())],
                    names=[*keep, "ids", "decoded"],
                )

    return run


def encode(docs: DataFrame, tokenizer_path: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default) with ``ids`` (binary, little-endian unsigned 32-bit) and ``decoded``.
    The tokenizer file is read on the driver and goes to the workers as text (a file of a few MB)."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("ids", "decoded", "__row", "__text")]
    rows = docs.select(*[F.col(c) for c in keep], F.col(text_col).alias("__text"), F.monotonically_increasing_id().alias("__row"))
    is_long = F.char_length("__text") > PIECE
    fields = [docs.schema[c] for c in keep] + [T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())]
    # stored once, so that a long text's number stays the same in every pass over it
    long_rows = written(rows.where(is_long), "long-texts")
    short = rows.where(F.coalesce(~is_long, F.lit(True))).select(*keep, "__text").mapInArrow(encode_short(spec, keep), T.StructType(fields))
    parts = long_rows.select("__row", "__text").mapInArrow(split_long(spec), "__row long, seq int, kind string, number int, part string")
    done = (
        parts.repartition("__row", "seq")
        .mapInArrow(encode_parts(spec), "__row long, seq int, kind string, number int, part string, ids binary")
        .groupBy("__row").applyInArrow(assemble(spec), "__row long, ids binary, decoded string")
    )
    return short.unionByName(long_rows.select(*keep, "__row").join(done, "__row").select(*keep, "ids", "decoded"))
