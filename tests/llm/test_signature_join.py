"""The signature tree join against all pairs."""

import os
import re

import numpy as np
import pytest

from eventloom.llm import shingles, signature_join
from eventloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_sets(rows):
    out = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        out.append(frozenset(tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))) if w else frozenset())
    return out


def all_pairs(rows):
    """(id, set size, least id reachable) of every row, by comparing all pairs of texts."""
    sets = word_sets(rows)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and 85 * max(len(x), len(y)) <= 100 * min(len(x), len(y)) and 100 * len(x & y) >= 85 * len(x | y):
                parent[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(((i, len(sets[k]), least.get(find(k)) if sets[k] else i) for k, (i, _) in enumerate(rows)), key=repr)


def joined(docs):
    return sorted(((r["__id"], r["n"], r["component"]) for r in signature_join.similar_documents(docs).collect()), key=repr)


ODD = [
    (None, "a text with a null id and some more words"), (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One"), (6, "two words"), (7, "w " * 30), (8, "w " * 50), (9, "w " * 50),
    (10, "null\x00byte and 'quotes'"), (11, "\xa0 \u2028x"), (12, " ".join(f"w{k % 977}x{k % 13}" for k in range(20_000))), (13, " ".join(f"w{k % 977}x{k % 13}" for k in range(19_000))),
]


def corpus(seed, groups, size, own):
    """Near copies in groups of all sizes around a passage that all texts share."""
    r = np.random.default_rng(seed)
    passage = [f"common{k}" for k in range(30)]
    rows = []
    for g in range(groups):
        base = [f"g{g}n{k}" for k in range(int(r.integers(5, 140)))] + (passage if g % 3 else [])
        for _ in range(int(r.integers(1, size))):
            w = list(base)
            for k in r.integers(0, len(w), int(r.integers(0, 1 + own * len(w)))):
                w[int(k)] = f"e{r.integers(1 << 30)}"
            rows.append((len(rows) * 7 % 1009 + 2000, " ".join(w)))
    return rows


def test_odd_rows(spark, documents):
    docs = documents(ODD).withColumnRenamed("pos", "node").withColumnRenamed("__x", "bits")
    assert joined(docs) == all_pairs(ODD)
    assert joined(docs.limit(0)) == []
    twice = [*ODD, *ODD[3:], (4, "another text under the id of another row, with some words")]
    assert {r for r in joined(documents(twice))} == {r for r in all_pairs(twice)}


@pytest.mark.parametrize("frequent,tile,size_of_tiles", [(signature_join.FREQUENT, signature_join.TILE, signature_join.TILE_BYTES), (3, 5, 1 << 24), (2, 1 << 20, 4000)])
def test_near_copies_against_all_pairs(spark, documents, monkeypatch, frequent, tile, size_of_tiles):
    monkeypatch.setattr(signature_join, "FREQUENT", frequent)
    monkeypatch.setattr(signature_join, "TILE", tile)
    monkeypatch.setattr(signature_join, "TILE_BYTES", size_of_tiles)
    rows = corpus(6, 25, 12, 0.035)
    assert joined(documents(rows)) == all_pairs(rows)


def test_traversal_loses_no_pair():
    r = np.random.default_rng(9)
    for trial in range(30):
        sets = []
        for _ in range(int(r.integers(1, 120))):
            if sets and r.random() < 0.6:
                x = sets[int(r.integers(len(sets)))].copy()
                k = int(r.integers(0, 1 + len(x) // 8))
                x[r.integers(0, len(x), k)] = r.integers(0, 2**63, k, dtype=np.uint64)
                sets.append(np.unique(x))
            else:
                sets.append(np.unique(r.integers(0, 2**63, int(r.integers(1, 200)), dtype=np.uint64)))
        sizes, label = np.array([len(x) for x in sets]), np.full(len(sets), -1)
        bitmaps = [signature_join.signature(x) for x in sets]
        words = min(map(len, bitmaps))
        levels, order = signature_join.planted(bitmaps, sizes, label, sizes.astype(np.uint64), words)
        assert all(len(x.low) == 1 for x in levels[-1:]) and len(levels[0].low) == len(sets)
        found = {tuple(sorted((int(order[a]), int(order[b])))) for i, j in signature_join.traversal(levels, None) for a, b in zip(i, j, strict=True)}
        links = {(i, j) for j in range(len(sets)) for i in range(j) if signature_join.is_linked(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j]))}
        assert links <= found
        half = len(sets) // 2
        if half:
            two = [signature_join.planted(bitmaps[a:b], sizes[a:b], label[a:b], sizes[a:b].astype(np.uint64), words) for a, b in ((0, half), (half, len(sets)))]
            across = {(int(two[0][1][a]), half + int(two[1][1][b])) for i, j in signature_join.traversal(two[0][0], two[1][0]) for a, b in zip(i, j, strict=True)}
            assert {(i, j) for i, j in links if i < half <= j} <= across


def test_necessary_shingles_by_definition():
    for n in range(1, 2000):
        assert signature_join.necessary(n) == n - next(k for k in range(n + 1) if 100 * k >= 85 * n) + 1
    x = shingles.shingle_sets(["a b c d e f g"], 4, shingles.Hasher(lower=True))[0]
    assert np.bitwise_count(signature_join.signature(x)).sum() <= len(x) == 4


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_op13_on_the_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in QUERIES["op13_signature_join"](spark, SF).collect()), key=repr)
    assert got == all_pairs(rows) and any(c != i for i, _, c in got)
