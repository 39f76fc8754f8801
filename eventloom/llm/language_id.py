"""Language identification with a byte convolutional network.

UTF-8 bytes, in windows of ``WINDOW`` bytes, go through filters of several widths, ReLU,
max pooling over the window and a softmax layer. A byte convolution over one-hot input
is a sum of table rows, so a filter bank of width w is w tables of 256 rows; at
prediction neighbouring tables are fused into one table over byte pairs. The network
is trained in numpy with Adam on at most ``PER_LANGUAGE`` labelled windows of each of at
most ``LANGUAGES`` languages (the bounds of the sample; rows are drawn by a hash of their
id). Prediction reads whole texts: every window counts by its bytes, and the mean of
the windows' probabilities decides.

Defined cases: a null text or one without a letter is ``und`` with score 0; equal scores
go to the language that sorts first; without any labelled row everything is ``und``;
rows with a null id are predicted but not learned from and not held out; repeated rows
get equal results; all other columns are kept or ignored, as the caller says.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.common import bounded_batches

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
PER_LANGUAGE = 500
LANGUAGES = 200
EPOCHS = 6
UND = "und"
#: The only label of a network without labelled rows: a text with a letter, in an unknown language.
UND_LETTERS = "unknown"
LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Network:
    """labels; per width the tables (width, 256, FILTERS) and biases; the softmax layer."""

    labels: list[str]
    tables: list[np.ndarray]
    biases: list[np.ndarray]
    dense: np.ndarray
    offset: np.ndarray


def windows_of(data: bytes) -> np.ndarray:
    """The bytes as rows of WINDOW, the last filled with zeros."""
    rows = max(1, -(-len(data) // WINDOW))
    out = np.zeros(rows * WINDOW, dtype=np.uint8)
    out[: len(data)] = np.frombuffer(data, dtype=np.uint8)
    return out.reshape(rows, WINDOW)


def train(samples: list[tuple[str, str]], seed: int = 7) -> Network:
    """samples: (text window, language)."""
    labels = sorted({y for _, y in samples})
    rng = np.random.default_rng(seed)
    tables = [rng.normal(0, 0.3, (w, 256, FILTERS)) for w in WIDTHS]
    for t in tables:
        t[:, 0] = 0
    params = [*tables, *(np.zeros(FILTERS) for _ in WIDTHS), rng.normal(0, 0.3, (FILTERS * len(WIDTHS), len(labels))), np.zeros(len(labels))]
    n = len(WIDTHS)
    if len(labels) > 1:
        rows = []
        for text, _ in samples:  # whole windows and shorter pieces, as short texts occur too
            data = text.encode("utf-8", "ignore")[:WINDOW]
            rows.append(windows_of(data[: int(rng.integers(24, WINDOW + 1))] if rng.random() < 0.5 else data)[0])
        x, y = np.stack(rows), np.array([labels.index(lang) for _, lang in samples])
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for at in range(0, len(x), 64):
                step += 1
                grads = gradients(params, x[order[at : at + 64]], y[order[at : at + 64]])
                for p, g, m, v in zip(params, grads, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    p -= 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    f32 = [p.astype(np.float32) for p in params]
    return Network(labels, f32[:n], f32[n : 2 * n], f32[2 * n], f32[2 * n + 1])


def gradients(params: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross entropy; a filter's gradient runs through the position of its maximum only."""
    n = len(WIDTHS)
    tables, biases, dense, offset = params[:n], params[n : 2 * n], params[2 * n], params[2 * n + 1]
    rows, pooled, places = np.arange(len(x)), [], []
    for t, b in zip(tables, biases, strict=True):
        w = len(t)
        z = sum(t[j][x[:, j : WINDOW - w + 1 + j]] for j in range(w)) + b
        places.append(z.argmax(axis=1))
        pooled.append(np.maximum(z.max(axis=1), 0))
    h = np.concatenate(pooled, axis=1)
    logits = h @ dense + offset
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    p[rows, y] -= 1
    p /= len(x)
    back = (p @ dense.T) * (h > 0)
    d_tables, d_biases = [], []
    for k, t in enumerate(tables):
        g = back[:, k * FILTERS : (k + 1) * FILTERS]
        d = np.zeros_like(t)
        for j in range(len(t)):
            np.add.at(d[j], (x[rows[:, None], places[k] + j], np.arange(FILTERS)[None, :]), g)
        d[:, 0] = 0
        d_tables.append(d)
        d_biases.append(g.sum(axis=0))
    return [*d_tables, *d_biases, h.T @ p, p.sum(axis=0)]


def pair_tables(net: Network) -> list[list[np.ndarray]]:
    """Per width: tables over (byte, next byte), and one over single bytes if the width is odd."""
    return [
        [(t[j][:, None, :] + t[j + 1][None, :, :]).reshape(65536, FILTERS) if j + 1 < len(t) else t[j] for j in range(0, len(t), 2)]
        for t in net.tables
    ]


def probabilities(net: Network, fused: list[list[np.ndarray]], x: np.ndarray) -> np.ndarray:
    """Of each language for each window."""
    out = np.empty((len(x), len(net.labels)), dtype=np.float32)
    for at in range(0, len(x), 128):
        part = x[at : at + 128]
        pairs = part[:, :-1].astype(np.int32) * 256 + part[:, 1:]
        pooled = []
        for parts, t, b in zip(fused, net.tables, net.biases, strict=True):
            room = WINDOW - len(t) + 1
            z = np.take(parts[0], pairs[:, :room], axis=0)
            for k, table in enumerate(parts[1:], 1):
                z += np.take(table, (pairs if len(table) > 256 else part)[:, 2 * k : 2 * k + room], axis=0)
            pooled.append(np.maximum(z.max(axis=1) + b, 0))
        logits = np.concatenate(pooled, axis=1) @ net.dense + net.offset
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        out[at : at + 128] = p / p.sum(axis=1, keepdims=True)
    return out


def has_letter(text: str) -> bool:
    hit = LETTER.search(text)
    return bool(hit) and (hit[0].isalpha() or any(map(str.isalpha, text)))


def predictor(net: Network | None, text_col: str, keep: list[str]):
    """Arrow batches -> the kept columns, __lang and __score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fused = pair_tables(net) if net else []
        for batch in batches:
            langs, scores = [UND] * batch.num_rows, np.zeros(batch.num_rows)
            todo: list[tuple[int, bytes]] = []
            held = 0
            texts = batch.column(batch.schema.get_field_index(text_col))

            def settle() -> None:
                rows = [windows_of(data) for _, data in todo]
                p = probabilities(net, fused, np.concatenate(rows))
                at = 0
                for (i, data), r in zip(todo, rows, strict=True):
                    weight = np.full(len(r), WINDOW, dtype=np.float64)
                    weight[-1] = len(data) - WINDOW * (len(r) - 1)
                    mean = weight @ p[at : at + len(r)] / weight.sum()
                    at += len(r)
                    best = int(mean.argmax())
                    langs[i], scores[i] = net.labels[best], min(1.0, float(mean[best]))
                todo.clear()

            for i in range(batch.num_rows if net else 0):
                text = texts[i].as_py()
                if text is None or not has_letter(text):
                    continue
                todo.append((i, text.encode("utf-8", "replace")))
                held += len(todo[-1][1])
                if held > 1 << 21:
                    settle()
                    held = 0
            if todo:
                settle()
            kept = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*keep, "__lang", "__score"])

    return run


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> list[tuple[str, str]]:
    """At most PER_LANGUAGE windows of text per language from rows that may be learned from."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        F.col("id").isNotNull() & ~held_out("id") & F.col("lang").isNotNull()
    )
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()}
    if not counts:
        return []
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 1.5 * PER_LANGUAGE / n))]), F.col("lang"))
    draw = F.pmod(F.xxhash64(F.lit("sample"), "id"), F.lit(1 << 20)) / (1 << 20)
    place = 1 + F.pmod(F.xxhash64(F.lit("place"), "id"), F.greatest(F.char_length("text") - WINDOW, F.lit(1)))
    drawn = rows.where(F.col("lang").isin(*counts) & (draw < share)).select(
        "lang", "id", draw.alias("draw"), F.substring("text", place.cast("int"), F.lit(WINDOW)).alias("piece")
    )
    kept = drawn.withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy("draw", "id", "piece"))).where(
        F.col("at") <= PER_LANGUAGE
    )
    found = sorted((r["lang"], r["piece"]) for r in kept.select("lang", "piece").collect() if r["piece"] and has_letter(r["piece"]))
    return [(piece, lang) for lang, piece in found]


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Network | None:
    sample = labelled_sample(docs, id_col, text_col, lang_col)
    return train(sample) if sample else None


def predict(docs: DataFrame, net: Network | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default) with __lang and __score."""
    keep = docs.columns if keep is None else keep
    bounded_batches(docs.sparkSession)
    fields = [docs.schema[c] for c in keep] + [T.StructField("__lang", T.StringType()), T.StructField("__score", T.DoubleType())]
    return docs.mapInArrow(predictor(net, text_col, keep), T.StructType(fields))


def keep_identified(docs: DataFrame, least: float = 0.0, lang_col: str = "lang") -> DataFrame:
    """The documents, all columns, whose language can be told: those with a letter, and a score of ``least`` or more (at 0
    the network rejects none). A null ``lang`` becomes the predicted language; without any labelled row it stays null. What a
    label is called plays no part: ``und`` may be one."""
    net = fit(docs, lang_col=lang_col)
    found = predict(docs, net or train([("", UND_LETTERS)]))
    told = F.coalesce(lang_col, "__lang") if net else F.col(lang_col)
    kept = found.where((F.col("__score") > 0) & (F.col("__score") >= least))  # 0 marks a text without a letter
    return kept.withColumn(lang_col, told).select(docs.columns)
