"""Whitening against a dense eigensolver."""

import os
from decimal import Decimal

import numpy as np
import pytest

from eventloom.llm import whitening
from eventloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, component int, n int, x double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 0.5) for i, v in rows], SCHEMA)


def against_dense(found, ids, vectors, want=8):
    x = np.floor(1024 * np.array(vectors, dtype=float)).astype(np.int64) + 100_000
    n, d = x.shape
    y = x - x.sum(axis=0) / n
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    k = min(want, d)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    exact = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, x.sum(axis=0), strict=True)) for row in x]
    rows = {}
    for r in found:
        rows.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    assert sorted(rows, key=repr) == sorted(set(ids), key=repr) and len(found) == n * k
    live = e > 1e-9 * e.sum()
    for c in range(k):
        want_c = (y @ u[:, c]) / np.sqrt(e[c]) if live[c] else None
        sign = None
        for at, i in enumerate(ids):
            r = min(rows[i][c + 1], key=lambda r: abs(r["deviation_exact"] - exact[at]))
            assert r["n"] == n and r["deviation"] == exact[at] and r["deviation_exact"] == Decimal(exact[at])
            assert r["explained"] == pytest.approx(e[c] / e_total if (e_total := float(np.trace(v))) else 0, abs=1e-12)
            if not live[c]:
                assert r["whitened"] is None
                continue
            if sign is None and abs(want_c[at]) > 1e-3:
                sign = np.sign(want_c[at] * r["whitened"])
            if sign is not None:
                assert r["whitened"] * sign == pytest.approx(want_c[at], abs=1e-8)
        assert rows[ids[0]][c + 1][0]["identity_error"] is None or rows[ids[0]][c + 1][0]["identity_error"] < 1e-10


def test_odd_rows(spark):
    r = np.random.default_rng(4)
    rows = [(k, r.normal(size=5).tolist()) for k in range(40)] + [(3, [1.0, 2.0, 3.0, 4.0, 5.0]), (None, [0.5] * 5)]
    bad = [(50, None), (51, [None, 1.0, 1.0, 1.0, 1.0]), (52, [float("nan")] * 5), (53, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (54, [])]
    found = whitening.whiten(frame(spark, rows + bad)).collect()
    against_dense(found, [i for i, _ in rows], [v for _, v in rows])
    assert whitening.whiten(frame(spark, bad)).count() == 0 and whitening.whiten(frame(spark, [])).count() == 0
    mixed = whitening.whiten(frame(spark, rows + [(100 + k, r.normal(size=3).tolist()) for k in range(9)])).collect()
    against_dense([x for x in mixed if x["vec_id"] is None or x["vec_id"] < 100], [i for i, _ in rows], [v for _, v in rows])
    assert sum(x["vec_id"] is not None and x["vec_id"] >= 100 for x in mixed) == 27


def test_without_variance(spark):
    one = whitening.whiten(frame(spark, [(1, [1.0, 2.0, 3.0])])).collect()
    assert [(r["component"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(c, 0, None, None, None) for c in (1, 2, 3)]
    flat = [(k, [float(k % 7), 1.0, -2.0]) for k in range(30)]
    against_dense(whitening.whiten(frame(spark, flat)).collect(), [i for i, _ in flat], [v for _, v in flat])


def test_large_entries(spark):
    rows = [(k, [2.0**45 + 3.0 * k, float(k * k), 1.0 * (k % 3)]) for k in range(20)]
    found = whitening.whiten(frame(spark, rows)).collect()
    against_dense(found, [i for i, _ in rows], [[v[0] - 2.0**45, v[1], v[2]] for _, v in rows])  # only deviations from the mean count
    wide = [(k, [(-1.0) ** k * 2.0**50, 1.0 * k]) for k in range(6)]
    assert all(r["deviation"] is None and r["deviation_exact"] > 2**63 for r in whitening.whiten(frame(spark, wide)).collect())
    with pytest.raises(Exception, match="does not fit 64 bits"):
        whitening.whiten(frame(spark, [(1, [1e30, 1.0, 1.0])])).collect()


@pytest.mark.parametrize("n,d", [(30, 4), (200, 64), (50, 300)])
def test_solver_on_close_and_repeated_eigenvalues(n, d):
    r = np.random.default_rng(d)
    q = np.linalg.qr(r.normal(size=(d, d)))[0]
    values = np.sort(np.concatenate([[5.0, 5.0, 5.0, 4.9999][: min(4, d)], 1 + r.random(max(0, d - 4))]))[::-1]
    a = q * values @ q.T
    found, vectors = whitening.leading(lambda block: a @ block, d, min(8, d))
    assert np.allclose(found, values[: len(found)], atol=1e-12)
    assert np.linalg.norm(a @ vectors - vectors * found, axis=0).max() < 1e-12 and np.allclose(vectors.T @ vectors, np.eye(len(found)), atol=1e-12)
    assert not len(whitening.leading(lambda block: 0 * block, d, 2)[0]) == 0


def test_minres_solves():
    r = np.random.default_rng(2)
    m = r.normal(size=(30, 30))
    a, none = m @ m.T + np.eye(30), np.zeros((30, 0))
    b = r.normal(size=30)
    t = whitening.solved(lambda block: a @ block, [whitening.minres(0.0, none, b, 60), whitening.minres(2.0, none, b, 60)])
    assert np.allclose(a @ t[0], b, atol=1e-6) and np.allclose((a - 2 * np.eye(30)) @ t[1], b, atol=1e-6)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_op12_on_the_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    against_dense(QUERIES["op12_whitening"](spark, SF).collect(), [r["vec_id"] for r in rows], [r["embedding"] for r in rows])
