"""Cross-tokenizer alignment against brute force."""

import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest

from eventloom.llm import alignment
from eventloom.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
PATHS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=PATHS[1])


def byte_symbols():
    """Printable bytes stand for themselves, the others for U+0100 and on."""
    table, extra = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            table[chr(b)] = b
        else:
            table[chr(256 + extra)] = b
            extra += 1
    return table


def spans(tokens):
    at, out = 0, []
    for t in tokens:
        out.append((at, at + len(t)))
        at += len(t)
    return out


def plain(libraries, text):
    """(n_a, n_b, n_groups, digest, links as id pairs) by comparing every pair of spans."""
    if not text:
        return 0, 0, 0, "", []
    a, b = libraries
    symbols = byte_symbols()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(symbols[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("\u2581", " ").encode() for i in ids_b for p in [b.id_to_piece(i)]]
    whole = (" " + text).encode()
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return 0, 0, 0, "", []
    sa, sb = spans(bytes_a), spans(bytes_b)
    cuts = sorted({e for _, e in sa} & {e for _, e in sb})
    inside = lambda s, ids, low, high: ",".join(str(i) for (x, y), i in zip(s, ids, strict=True) if low <= x and y <= high)
    groups = [inside(sa, ids_a, low, high) + "|" + inside(sb, ids_b, low, high) for low, high in zip([0, *cuts], cuts, strict=False)]
    links = [(i, j) for (p, q), i in zip(sa, ids_a, strict=True) for (x, y), j in zip(sb, ids_b, strict=True) if p < y and x < q]
    return len(ids_a), len(ids_b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest(), links


def expected(libraries, rows):
    found = [(i, plain(libraries, t)) for i, t in rows]
    count = Counter(x for _, f in found for x in f[4])
    best = Counter()
    for (_, j), n in count.items():
        best[j] = max(best[j], n)
    return sorted(
        ((i, f[0], f[1], f[2], len(f[4]), sum(count[x] == best[x[1]] for x in f[4]), sum(count[x] for x in f[4]), f[3]) for i, f in found), key=repr
    )


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    (None, "a text with a null id"), (1, None), (2, ""), (3, " "), (4, "x"), (5, "caf\u00e9 \u2014 \u65e5\u672c\u8a9e \U0001f600!"), (6, "two  blanks\tand\nlines\r\n"), (7, "<|endoftext|> and <s></s><unk> <0x41>"),
    (8, "piece \u2581 mark"), (9, "same row"), (9, "same row"), (10, "tokenization " * 40 + "x" * 300), (11, "e\u0301" * 30 + "\u00a0\u3000"), (12, "don't we'll 123456 $%^&*()"),
]


@pytest.mark.parametrize("common", [alignment.COMMON, 40])
def test_odd_rows_against_brute_force(spark, documents, libraries, monkeypatch, common):
    monkeypatch.setattr(alignment, "COMMON", common)
    docs = documents(ODD).withColumnRenamed("__x", "links").withColumnRenamed("pos", "n_a")
    out = alignment.align_tokens(docs, *PATHS)
    assert out.columns == COLUMNS
    assert sorted((tuple(r) for r in out.collect()), key=repr) == expected(libraries, ODD)
    assert alignment.align_tokens(docs.limit(0), *PATHS).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_op11_on_whole_documents(spark, libraries):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op11_alignment"](spark, SF).select(COLUMNS).collect()}
    short = {i for i, t in rows if len(t or "") < 3000}
    for e in expected(libraries, [(i, t) for i, t in rows if i in short]):
        assert got[e[0]][:5] == e[:5] and got[e[0]][7] == e[7]  # counts need all documents:
    aligner = alignment.Aligner(open(PATHS[0], encoding="utf-8").read(), open(PATHS[1], "rb").read())
    per, count, best = {}, Counter(), Counter()
    for i, t in rows:
        done = aligner.document((" " + (t or "")).encode(), aligner.a.encode([" " + (t or "")])[0], aligner.b.encode([t or ""])[0])
        per[i] = np.frombuffer(done[5], "<u4").tolist() if t else []
        count.update(per[i])
    for c, n in count.items():
        best[c & 65535] = max(best[c & 65535], n)
    assert all(got[i][5:7] == (sum(count[c] == best[c & 65535] for c in x), sum(count[c] for c in x)) for i, x in per.items())


def test_fast_encoder_equals_the_files_own_library(libraries):
    level = alignment.ByteLevel(open(PATHS[0], encoding="utf-8").read())
    assert level.fast is not None
    r = random.Random(3)
    words = ["the", "don't", "  ", "\n\n", "x1y22", "\u00e9\u00df", "<|endoftext|>", "...", " ", "'s", "\t", "na\u00efve", "0123456789", "$", "aaaaaaaaaaaa", "QwErTy", "\u00b2\u00bd\u00aa"]
    texts = ["".join(r.choice(words) for _ in range(r.randint(1, 60))) for _ in range(800)]
    assert level.encode(texts) == [e.ids for e in libraries[0].encode_batch(texts, add_special_tokens=False)]


def test_run_skipping_on_random_ends():
    r = np.random.default_rng(8)
    for size in (1, 2, 5, 40, 400):
        for keep_a, keep_b in ((1.0, 1.0), (0.95, 0.97), (0.5, 0.6), (0.02, 0.9)):
            ends = np.cumsum(r.integers(1, 4, size))
            a, b = (np.unique(np.append(ends[r.random(size) < k], ends[-1])) for k in (keep_a, keep_b))
            runs, irregular, walk_a, walk_b = alignment.align(a, b)
            both = np.intersect1d(a, b)
            assert sum(x[2] for x in runs) + len(irregular) == len(both)
            pairs = sorted([(i + k, j + k) for i, j, n in runs for k in range(n)] + list(zip(walk_a, walk_b, strict=True)))
            begin_a, begin_b = np.append(0, a[:-1]), np.append(0, b[:-1])
            assert pairs == [(i, j) for i in range(len(a)) for j in range(len(b)) if begin_a[i] < b[j] and begin_b[j] < a[i]]


def test_runs_that_end_around_a_probe():
    first = alignment.FIRST
    for n in (1, first - 1, first, first + 1, 2 * first - 1, 2 * first, 2 * first + 1, 4 * first, 4 * first + 1, 500):
        a = np.append(np.arange(1, n + 1), [n + 1, n + 2, n + 3])
        runs, irregular, walk_a, walk_b = alignment.align(a, np.delete(a, n))
        assert (runs.tolist(), irregular.tolist()) == ([[0, 0, n], [n + 2, n + 1, 1]], [[n, n, 2, 1]])
        assert (walk_a.tolist(), walk_b.tolist()) == ([n, n + 1], [n, n])


def test_joined_spelling():
    spelt = alignment.Spelling([b"", b"ab", b"\0", b"caf\xc3\xa9"])
    assert spelt.joined(np.array([3, 0, 2, 1, 1])) == b"caf\xc3\xa9\0abab"
    assert spelt.joined(np.zeros(0, dtype=np.int64)) == b""
