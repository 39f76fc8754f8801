"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

An item becomes windows of ``size`` consecutive words (an item with fewer words is one
window). A window occurs in a document only if every one of its words does, so its
rarest word, by corpus count, is a necessary prefix: documents are joined on that one
word alone. The word's position in both sides then fixes where the window would start;
starts outside the document are cut by position and length, and what is left is
verified word by word. Windows with a word that the corpus lacks are dropped before
the join.

The benchmark is a stated query set. Its distinct windows are dealt into blocks of at
most ``BLOCK`` windows, so what is broadcast at a time has a fixed bound, however large
the benchmark is; each block is held against all documents. The join, the bounds and the
verification run in one code-generated stage over each document's words; only windows
that really occur are shuffled.

Defined cases: null or wordless texts have no words, no hits and are clean; null and
repeated ids and repeated rows are judged row by row; an empty benchmark hits nothing;
an item without words has no window; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import ascii_lower, row_key, same_key, written

#: Distinct windows broadcast at a time (of 10 words: about 150 bytes each).
BLOCK = 50_000
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; a null text has none. (A run of separators
    at either end leaves an empty string, which goes.)"""
    return F.coalesce(F.array_remove(F.split(ascii_lower(text), SEPARATORS), ""), F.array().cast("array<string>"))


def item_windows(benchmark: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(item_id, window): each item's distinct windows."""
    items = benchmark.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - F.lit(size - 1), F.lit(1)))
    return items.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("window")).distinct()


def occurrences(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(__id, __h, start, window) of every place where one of ``windows`` occurs. docs: __id, __h, words."""
    tokens = windows.select("window", F.posexplode("window").alias("off", "token"))
    seen = docs.select(F.explode("words").alias("token"))
    counts = seen.join(F.broadcast(tokens.select("token").distinct()), "token").groupBy("token").count()
    ranked = tokens.join(counts, "token", "left").groupBy("window").agg(
        F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "token", "off")).alias("rarest")
    )
    prefix = ranked.where("rarest.n > 0").select("window", F.col("rarest.token").alias("token"), F.col("rarest.off").alias("off"))
    placed = docs.select("__id", "__h", "words", F.posexplode("words").alias("pos", "word"))
    start = F.col("pos") - F.col("off")
    inside = (start >= 0) & (start + F.size("window") <= F.size("words"))
    same = F.when(inside, F.slice("words", F.greatest(start, F.lit(0)) + 1, F.size("window")) == F.col("window"))
    return placed.join(F.broadcast(prefix), (F.col("word") == F.col("token")) & same).select(
        "__id", "__h", start.alias("start"), "window"
    )


def find_contamination(
    documents: DataFrame, benchmark: DataFrame, size: int = 10, doc_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """Per document: doc id, __h, n_words, n_hit (words inside any occurrence), items (array of item ids)."""
    docs = documents.select(*row_key(doc_col, text_col), words(F.col(text_col)).alias("words"))
    windows = written(item_windows(benchmark, size, item_col, item_text_col), "windows")
    distinct = written(
        windows.select("window").distinct().withColumn("block", F.xxhash64("window")), "distinct-windows"
    )
    blocks = max(1, -(-distinct.count() * 5 // (BLOCK * 4)))  # a quarter spare, as a hash deals them
    found = reduce(
        DataFrame.unionByName,
        [occurrences(docs, distinct.where(F.pmod("block", F.lit(blocks)) == b).select("window")) for b in range(blocks)],
    )
    found = written(found, "occurrences")
    covered = F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["n"] - 1)))
    hit = found.groupBy("__id", "__h").agg(
        F.collect_set(F.struct("start", F.size("window").alias("n"))).alias("spans")
    ).select("__id", "__h", F.size(F.array_distinct(covered)).cast("long").alias("n_hit"))
    of_item = found.select("__id", "__h", "window").distinct().join(windows, "window").groupBy("__id", "__h").agg(
        F.collect_set("item_id").alias("items")
    )
    out = docs.select("__id", "__h", F.size("words").cast("long").alias("n_words"))
    out = out.join(hit.withColumnsRenamed({"__id": "i1", "__h": "h1"}), F.col("__id").eqNullSafe(F.col("i1")) & (F.col("__h") == F.col("h1")), "left")
    out = out.join(of_item.withColumnsRenamed({"__id": "i2", "__h": "h2"}), F.col("__id").eqNullSafe(F.col("i2")) & (F.col("__h") == F.col("h2")), "left")
    none = F.array().cast(windows.schema["item_id"].dataType.simpleString().join(["array<", ">"]))
    return out.select(
        F.col("__id").alias(doc_col), "__h", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", none).alias("items"),
    )


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """The documents, all columns, in which no benchmark window occurs."""
    found = find_contamination(documents, benchmark, size).where("n_hit > 0").select(F.col("doc_id").alias("__id"), "__h").distinct()
    keyed = documents.withColumns({"__id": F.col("doc_id"), "__h": F.xxhash64("doc_id", "text")})
    return keyed.join(found, same_key(keyed, found), "left_anti").drop("__id", "__h")
