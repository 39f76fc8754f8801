"""Whitening of embeddings with the leading components of their covariance, by Jacobi-Davidson.

The covariance is never formed. Vectors are packed into chunks of whole numbers; a product with a
block of directions is one pass over the chunks, each of which is centred and then multiplied, and
the partial products are added up in Spark entry by entry. On the driver lie only blocks of a few
directions. Each round of the method:

* Rayleigh-Ritz in the search space gives the leading pairs and their residuals;
* pairs at double precision (``TOLERANCE`` of the greatest eigenvalue) are locked, greatest first,
  and leave the search space;
* for every open pair the correction equation, projected off the locked and the current vectors,
  is solved by a few steps of MINRES. All equations step together, so one pass serves them all;
* the corrections, made orthogonal, extend the search space, which restarts from its best
  directions when it is full.

Exact parts: each entry c becomes floor(1024 c) + 100000; sums are whole numbers; a row is centred on the
whole part of the mean before the rest of it is taken off; ``deviation_exact`` is a whole number.

Defined cases: rows whose vector is null or holds a null or non-finite entry are left out; vectors of
different lengths are fitted apart, each length a list of its own, and an empty vector has no
component; repeated rows and null ids are rows like any other; an entry whose whole number doesn't fit
64 bits is an error; a component without variance (one row, a constant entry) has explained 0
(null if there is no variance at all) and whitened null, and does not count in identity_error;
``deviation`` is null where it doesn't fit 64 bits, ``deviation_exact`` never is; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Generator, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.common import written

SCALE, SHIFT = 1024, 100_000
#: Entries of a chunk: 1 MB.
CHUNK = 1 << 17
#: A residual below this share of the greatest eigenvalue is at double precision.
TOLERANCE = 2.0**-45
#: Steps of MINRES a round.
INNER = 3
ROUNDS = 200
#: The search space begins with so many directions, and restarts at so many, for each wanted pair.
START, SPACE = 4, 8
#: Pairs beyond the wanted ones that are corrected too, so that close ones are told apart.
GUARD = 2


def whole_numbers(vector: Column) -> Column:
    """floor(1024 c) + 100000 of every entry; null if the vector takes no part."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))

    def number(c: Column) -> Column:
        scaled = F.floor(c.cast("double") * SCALE)
        fits = F.abs(c.cast("double") * SCALE) < float(2**62)
        return F.when(fits, scaled + SHIFT).otherwise(F.raise_error(F.lit("an entry does not fit 64 bits")).cast("long"))

    return F.when(F.coalesce(bad, F.lit(True)), F.lit(None)).otherwise(F.transform(vector, number))


def pack(dim: int):
    """(id, x) -> chunks (n, ids, x, sums)."""
    most = max(1, CHUNK // dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                some = batch.slice(at, most)
                x = some.column(1).flatten().to_numpy(zero_copy_only=False).astype("<i8").reshape(some.num_rows, dim)
                small = int(np.abs(x).max()) < 2**62 // len(x)
                sums = [Decimal(int(s)) for s in (x if small else x.astype(object)).sum(axis=0)]
                ids = pa.ListArray.from_arrays(pa.array([0, some.num_rows], pa.int32()), some.column(0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([some.num_rows], pa.int64()), ids, pa.array([x.tobytes()], pa.binary()), pa.array([sums], pa.list_(pa.decimal128(38, 0)))],
                    names=["n", "ids", "x", "sums"],
                )

    return run


@dataclass
class Centre:
    """The exact mean S/n as a whole part and a rest below one, n-ths."""

    n: int
    whole: np.ndarray
    rest: list[int]

    @classmethod
    def of(cls, n: int, sums: list[int]) -> Centre:
        return cls(n, np.array([s // n for s in sums], dtype=np.int64), [s % n for s in sums])

    def moved(self, data: bytes) -> np.ndarray:
        """x minus the whole part of the mean, exact."""
        return np.frombuffer(data, "<i8").reshape(-1, len(self.whole)) - self.whole

    def centred(self, data: bytes) -> np.ndarray:
        return self.moved(data).astype(np.float64) - np.array([r / self.n for r in self.rest])

    def deviations(self, data: bytes) -> list[int]:
        """Per row the sum over dimensions of (n x - S)^2, as n^2 a - 2 n b + c over whole numbers."""
        y, r = self.moved(data), np.array(self.rest, dtype=np.int64)
        most = int(np.abs(y).max(initial=0))
        if max(most * most, most * self.n) * len(r) >= 2**62:
            y, r = y.astype(object), r.astype(object)
        a, b, c = (y * y).sum(axis=1), (y * r).sum(axis=1), sum(x * x for x in self.rest)
        return [self.n * self.n * int(p) - 2 * self.n * int(q) + c for p, q in zip(a, b, strict=True)]


class Rows:
    """Packed rows of one dimension, and passes over them."""

    def __init__(self, chunks: DataFrame, dim: int):
        self.chunks, self.dim = chunks, dim
        n = chunks.agg(F.sum("n")).first()[0]
        sums = chunks.select(F.posexplode("sums").alias("at", "s")).groupBy("at").agg(F.sum("s").alias("s")).collect()
        self.centre = Centre.of(n, [int(s) for _, s in sorted((r["at"], r["s"]) for r in sums)])

    def total(self, part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
        """The sum over all chunks of ``part`` of the centred chunk."""
        centre = self.centre

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = np.zeros(shape)
            for batch in batches:
                for x in batch.column(0):
                    held += part(centre.centred(x.as_py()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(held.size, dtype=np.int32)), pa.array(held.ravel())], names=["at", "v"])

        added = self.chunks.select("x").mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
        out = np.zeros(shape)
        for r in added:
            out.flat[r["at"]] = r["v"]
        return out

    def product(self, block: np.ndarray) -> np.ndarray:
        """Covariance times the columns of ``block``."""
        return self.total(lambda y: y.T @ (y @ block), block.shape) / self.centre.n

    def trace(self) -> float:
        return float(self.total(lambda y: np.array([(y * y).sum()]), (1,))[0]) / self.centre.n


def off(x: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """x without its part in the span of the orthonormal ``basis``; twice, for full orthogonality."""
    for _ in range(2):
        x = x - basis @ (basis.T @ x)
    return x


def minres(theta: float, basis: np.ndarray, rhs: np.ndarray, steps: int) -> Generator[np.ndarray, np.ndarray, np.ndarray]:
    """Solves (A - theta) t = rhs off ``basis``. Yields each direction and is sent A times it; returns t."""
    t = np.zeros_like(rhs)
    v = off(rhs, basis)
    eta = beta = float(np.linalg.norm(v))
    if beta == 0:
        return t
    v, before = v / beta, np.zeros_like(v)
    w, w_before = np.zeros_like(v), np.zeros_like(v)
    cos, cos_before, sin, sin_before = 1.0, 1.0, 0.0, 0.0
    beta = 0.0
    for _ in range(steps):
        image = off((yield v) - theta * v, basis)
        alpha = float(v @ image)
        image = image - alpha * v - beta * before
        following = float(np.linalg.norm(image))
        turned = cos * alpha - cos_before * sin * beta
        length = float(np.hypot(turned, following))
        if length == 0:
            break
        step = (v - (sin * alpha + cos_before * cos * beta) * w - sin_before * beta * w_before) / length
        cos_before, cos, sin_before, sin = cos, turned / length, sin, following / length
        t = t + cos * eta * step
        eta = -sin * eta
        w_before, w = w, step
        if following <= 1e-14 * abs(theta):
            break
        before, v, beta = v, image / following, following
    return t


def solved(product: Callable[[np.ndarray], np.ndarray], equations: list[Generator]) -> list[np.ndarray]:
    """All equations, one product for the next directions of all of them at a time."""
    out: list[np.ndarray | None] = [None] * len(equations)
    asked: dict[int, np.ndarray] = {}

    def move(k: int, image: np.ndarray | None) -> None:
        try:
            asked[k] = equations[k].send(image)
        except StopIteration as done:
            out[k] = done.value

    for k in range(len(equations)):
        move(k, None)
    while asked:
        ks = sorted(asked)
        images = product(np.stack([asked.pop(k) for k in ks], axis=1))
        for c, k in enumerate(ks):
            move(k, images[:, c])
    return out


def leading(product: Callable[[np.ndarray], np.ndarray], dim: int, want: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The ``want`` greatest eigenvalues of a symmetric operator without negative ones, and their unit vectors."""
    start = min(dim, START * want)
    space = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, start)))[0]
    image = product(space)
    locked, values = np.zeros((dim, 0)), []
    scale = 0.0
    for _ in range(ROUNDS):
        small = space.T @ image
        ritz, turn = np.linalg.eigh((small + small.T) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        scale = max([scale, *np.abs(ritz), *values])
        residual = image - space * ritz
        sizes = np.linalg.norm(residual, axis=0)
        whole = space.shape[1] + locked.shape[1] == dim
        done = 0
        while done < len(ritz) and len(values) < want and sizes[done] <= TOLERANCE * scale:
            values.append(float(ritz[done]))
            done += 1
        locked = np.concatenate([locked, space[:, :done]], axis=1)
        space, image, ritz, residual = space[:, done:], image[:, done:], ritz[done:], residual[:, done:]
        if len(values) >= want:
            order = np.argsort(-np.array(values), kind="stable")
            return np.array(values)[order], locked[:, order]
        active = min(want - len(values) + GUARD, space.shape[1])
        if whole:  # nothing to add: multiply anew, which takes off the rounding of earlier rounds
            space = np.linalg.qr(off(space, locked))[0]
            image = product(space)
            continue
        near = np.concatenate([locked, space[:, :active]], axis=1)
        corrections = solved(product, [minres(float(ritz[k]), near, -residual[:, k], INNER) for k in range(active)])
        if space.shape[1] + active > max(SPACE * want, start):
            keep = min(space.shape[1], 2 * want + GUARD)
            space, image = space[:, :keep], image[:, :keep]
        new = np.zeros((dim, 0))
        for k, t in enumerate(corrections):
            size = np.linalg.norm(t)
            t = off(t / size if size > 0 else residual[:, k], np.concatenate([locked, space, new], axis=1))
            if np.linalg.norm(t) > 1e-12:
                t = off(t / np.linalg.norm(t), np.concatenate([locked, space, new], axis=1))
                new = np.concatenate([new, (t / np.linalg.norm(t))[:, None]], axis=1)
        if not new.shape[1]:  # a closed space: a random direction opens it
            t = off(np.random.default_rng(seed + len(values) + space.shape[1]).normal(size=dim), np.concatenate([locked, space], axis=1))
            new = (t / np.linalg.norm(t))[:, None]
        space, image = np.concatenate([space, new], axis=1), np.concatenate([image, product(new)], axis=1)
    raise ArithmeticError(f"{want - len(values)} of {want} components did not reach double precision in {ROUNDS} rounds")


@dataclass
class Fit:
    """Components of one dimension: unit vectors by falling eigenvalue, those without variance not ``live``."""

    centre: Centre
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    live: np.ndarray

    def whitened(self, y: np.ndarray) -> np.ndarray:
        """Of centred rows, over the live components."""
        return (y @ self.vectors[:, self.live]) / np.sqrt(self.values[self.live])


def fit(rows: Rows, want: int = 8) -> Fit:
    values, vectors = leading(rows.product, rows.dim, min(want, rows.dim))
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
    trace = rows.trace()
    return Fit(rows.centre, vectors, np.maximum(values, 0), trace, values > 1e-13 * max(trace, 1e-300))


def identity_error(rows: Rows, found: Fit) -> float | None:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    k = int(found.live.sum())
    if not k:
        return None
    mean = rows.total(lambda y: found.whitened(y).sum(axis=0), (k,)) / found.centre.n

    def spread(y: np.ndarray) -> np.ndarray:
        z = found.whitened(y) - mean
        return z.T @ z

    return float(np.abs(rows.total(spread, (k, k)) / found.centre.n - np.eye(k)).max())


def project(found: Fit, error: float | None):
    """Chunks -> one row per id and component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, n = len(found.values), found.centre.n
        explained = found.values / found.trace if found.trace > 0 else None
        for batch in batches:
            for at in range(batch.num_rows):
                data = batch.column(1)[at].as_py()
                ids = batch.column(0)[at].values
                rows = len(ids)
                white = np.full((rows, k), np.nan)
                white[:, found.live] = found.whitened(found.centre.centred(data))
                exact = [d for d in found.centre.deviations(data) for _ in range(k)]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(np.repeat(np.arange(rows), k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * k, n, dtype=np.int64)),
                        pa.array([d if d < 2**63 else None for d in exact], pa.int64()),
                        pa.array([Decimal(d) for d in exact], pa.decimal128(38, 0)),
                        pa.array(white.ravel(), from_pandas=True),
                        pa.array(np.tile(explained, rows) if explained is not None else [None] * (rows * k), pa.float64()),
                        pa.array([error] * (rows * k), pa.float64()),
                    ],
                    names=["id", "component", "n", "deviation", "deviation_exact", "whitened", "explained", "identity_error"],
                )

    return run


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", want: int = 8) -> DataFrame:
    """Per row and component: the id, component, n, deviation, deviation_exact, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    id_type = vectors.schema[id_col].dataType
    result = T.StructType(
        [T.StructField(id_col, id_type), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
         T.StructField("deviation_exact", T.DecimalType(38, 0)), *(T.StructField(c, T.DoubleType()) for c in ("whitened", "explained", "identity_error"))]
    )
    rows = vectors.select(F.col(id_col).alias("id"), whole_numbers(F.col(vector_col)).alias("x")).where(F.size("x") > 0)
    dims = sorted(r["dim"] for r in rows.select(F.size("x").alias("dim")).distinct().collect())
    chunk = T.StructType(
        [T.StructField("n", T.LongType()), T.StructField("ids", T.ArrayType(id_type)), T.StructField("x", T.BinaryType()), T.StructField("sums", T.ArrayType(T.DecimalType(38, 0)))]
    )
    parts = []
    for dim in dims:  # lengths differ only between models: each is a fit of its own
        packed = Rows(written(rows.where(F.size("x") == dim).mapInArrow(pack(dim), chunk), "vectors"), dim)
        found = fit(packed, want)
        parts.append(packed.chunks.select("ids", "x").mapInArrow(project(found, identity_error(packed, found)), result))
    out = spark.createDataFrame([], result) if not parts else parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
