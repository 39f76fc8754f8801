"""Exact top-k inner products by norm-bucketed retrieval.

Candidates are range-partitioned by vector length, longest first, and packed into
chunks of at most ``CHUNK`` components: each chunk is a bucket of similar lengths. The
queries, a stated set, are taken in blocks of at most ``QUERY_BLOCK`` vectors. For a
block, the longest chunks give every query a k-th best score that it can't fall below.
For every other bucket that bound divided by |q| and the bucket's greatest length is a
local cosine threshold t:

* t > 1: no vector of the bucket can reach the bound (length pruning of the bucket);
* t >= ``COORDINATE``: only vectors whose coordinate at the query's largest component
  lies in the band that cosine t allows are looked at (coordinate pruning);
* else: only the bucket's vectors of length >= bound / |q| are looked at, which, sorted
  by length, are its first rows (length pruning inside the bucket).

What is left is verified by the exact integer product. Products are computed in 64-bit
floats while they can't pass 2^53, in 64-bit integers while they fit, else in integers without bound.

Defined cases: vectors that are null, empty or hold null or non-finite components take no part; a
component that doesn't fit 64 bits when scaled is an error, and so is one of a query's k best scores that
doesn't; only vectors of equal dimension meet; an id that repeats with several vectors asks with the smallest; a row with a null id is a candidate that never wins a tie by id and is
no query; rows with the query's own id are not its candidates; repeated rows are
candidates each; fewer than k candidates give fewer rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import written

#: Components of a chunk (at 64 dimensions: 8192 vectors, 4 MB) and queries of a block.
CHUNK = 2**19
QUERY_BLOCK = 8192
COORDINATE = 0.8
SCHEMA = "dim int, n int, longest double, ids binary, vectors binary"


def integers(embedding: Column) -> Column:
    """floor(256 * x) of every component, null if the vector takes no part."""
    scaled = F.transform(embedding, lambda x: F.floor(x.cast("double") * 256))
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    large = F.exists(embedding, lambda x: F.abs(x.cast("double") * 256) >= float(2**63))
    error = F.raise_error(F.lit("a component does not fit 64 bits when scaled")).cast("array<long>")
    return F.when(F.coalesce(bad, F.lit(True)) | (F.size(embedding) == 0), F.lit(None)).when(large, error).otherwise(scaled).cast("array<long>")


def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by dimension and falling length -> chunks."""
    held: list[tuple[int, np.ndarray]] = []

    def chunk() -> pd.DataFrame:
        ids = np.array([i for i, _ in held], dtype="<i8")
        m = np.stack([v for _, v in held]).astype("<i8")
        longest = float(np.sqrt((m.astype(np.float64) ** 2).sum(axis=1).max()))
        return pd.DataFrame([(m.shape[1], len(held), longest, ids.tobytes(), m.tobytes())], columns=["dim", "n", "longest", "ids", "vectors"])

    for pdf in batches:
        for i, v in zip(pdf["id"], pdf["v"], strict=True):
            if held and ((len(held) + 1) * len(v) > CHUNK or len(held[-1][1]) != len(v)):
                yield chunk()
                held.clear()
            held.append((int(i), np.asarray(v)))
    if held:
        yield chunk()


def unpack(row) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row.ids, "<i8"), np.frombuffer(row.vectors, "<i8").reshape(row.n, row.dim)


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best: higher score, then smaller id."""
    if scores.dtype == object:
        return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i]))[:k], dtype=int)
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
        return at[np.lexsort((ids[at], -scores[at]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def search(q_ids: np.ndarray, q: np.ndarray, least: list[int | None], k: int):
    """Chunks -> (query_id, vec_id, score): each chunk's k best for a query that may reach ``least``, the score that its
    k best don't fall below (None: not known)."""
    floor = np.array([-np.inf if x is None else float(x) for x in least])
    q_len = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
    focus = np.abs(q).argmax(axis=1) if len(q) else np.zeros(0, int)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                ids, m = unpack(row)
                if m.shape[1] != q.shape[1]:
                    continue
                lengths = np.sqrt((m.astype(np.float64) ** 2).sum(axis=1))
                most = int(np.abs(q).max()) * int(np.abs(m).max()) * m.shape[1]
                kind = np.float64 if most < 2**52 else np.int64 if most < 2**63 else object
                mk, qk = m.astype(kind), q.astype(kind)
                unit = m / np.maximum(lengths, 1e-300)[:, None]
                out_q, out_v, out_s = [], [], []
                with np.errstate(divide="ignore", invalid="ignore"):
                    t = floor / (q_len * row.longest)
                for j in np.flatnonzero(~(t > 1 + 1e-9)):  # NaN: a zero vector, which meets all
                    at = None
                    if t[j] >= COORDINATE:
                        f, c, s = focus[j], min(t[j], 1.0), q[j, focus[j]] / q_len[j]
                        half = np.sqrt((1 - c * c) * max(0.0, 1 - s * s)) + 1e-9
                        x = unit[:, f]
                        # cosine >= c with unit coordinate s: x >= c s - half on the query's side, x <= c s + half unless the angle is free
                        at = np.flatnonzero(x >= c * s - half) if s > 0 else np.flatnonzero(x <= c * s + half)
                    elif t[j] > 0:
                        at = slice(0, int(np.searchsorted(-lengths, -(floor[j] / q_len[j]) * (1 - 1e-9), side="right")))
                    some, names = (mk, ids) if at is None else (mk[at], ids[at])
                    scores = some @ qk[j]
                    keep = names != q_ids[j]
                    if least[j] is not None:
                        keep &= scores >= least[j]
                    scores, names = scores[keep], names[keep]
                    best = best_of(scores, names, k)
                    scores = scores[best]
                    if kind is object:
                        if any(x >= 2**63 for x in scores):
                            raise OverflowError("a score does not fit 64 bits")
                        scores = np.array([max(x, BELOW) for x in scores], dtype=object)
                    out_q += [q_ids[j]] * len(best)
                    out_v += names[best].tolist()
                    out_s += scores.astype(np.int64).tolist()
                if out_q:
                    yield pd.DataFrame({"query_id": out_q, "vec_id": out_v, "score": out_s})

    return run


NO_ID = 2**63 - 1
#: A score this low or lower doesn't fit, which is an error if it is among a query's best.
BELOW = -(2**63)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for every row where ``is_query`` holds, against all rows."""
    spark = vectors.sparkSession
    rows = vectors.select(
        F.coalesce(F.col(id_col), F.lit(NO_ID)).cast("long").alias("id"), integers(F.col(vector_col)).alias("v"),
        (F.coalesce(is_query, F.lit(False)) & F.col(id_col).isNotNull()).alias("is_query"),
    ).where(F.col("v").isNotNull())
    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    order = [F.size("v").alias("dim"), (-length).alias("short"), F.col("id")]
    chunks = written(
        rows.select("id", "v", *order[:2], F.monotonically_increasing_id().alias("row"))
        .repartitionByRange("dim", "short", "row").sortWithinPartitions("dim", "short", "row").select("id", "v")
        .mapInPandas(pack, SCHEMA), "vectors",
    )
    queries = written(
        rows.where("is_query").groupBy("id").agg(F.min("v").alias("v"))
        .withColumns({"dim": F.size("v"), "deal": F.xxhash64("id")}), "queries",
    )
    parts = []
    for dim, n in [(r["dim"], r["count"]) for r in queries.groupBy("dim").count().collect()]:
        mine = chunks.where(F.col("dim") == dim)
        top = [r["longest"] for r in mine.select("longest").orderBy(F.desc("longest")).limit(2).collect()]
        blocks = max(1, -(-n * 5 // (QUERY_BLOCK * 4)))
        for b in range(blocks):  # a block of bounded size at a time, against all candidates
            block = queries.where((F.col("dim") == dim) & (F.pmod("deal", F.lit(blocks)) == b)).select("id", "v").collect()
            if not block:
                continue
            q_ids = np.array([r["id"] for r in block], dtype=np.int64)
            q = np.array([r["v"] for r in block], dtype=np.int64)
            first = mine.where(F.col("longest") >= min(top)).mapInPandas(
                search(q_ids, q, [None] * len(q), k), "query_id long, vec_id long, score long"
            )
            known = {
                r["query_id"]: r["s"]
                for r in first.groupBy("query_id").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s")).collect()
            }
            least = [s[k - 1] if len(s := known.get(int(i), [])) >= k and s[k - 1] > BELOW else None for i in q_ids]
            parts.append(written(mine.mapInPandas(search(q_ids, q, least, k), "query_id long, vec_id long, score long"), "scores"))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    # at most k rows per (query, chunk) come here; each query keeps its k best of them
    best = F.slice(F.array_sort(F.collect_list(F.struct(F.bitwise_not("score").alias("falling"), "vec_id"))), 1, k)
    ranked = found.groupBy("query_id").agg(best.alias("best")).select("query_id", F.posexplode("best").alias("at", "b"))
    score = F.bitwise_not("b.falling")
    error = F.raise_error(F.lit("a score does not fit 64 bits")).cast("long")
    return ranked.select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"),
        F.when(F.col("b.vec_id") != NO_ID, F.col("b.vec_id")).alias("vec_id"), F.when(score == BELOW, error).otherwise(score).alias("score"),
    )
