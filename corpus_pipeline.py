"""The corpus pipeline: STAGES applied to ``documents``, each written as Parquet and read again.

Every stage takes all that its predecessor kept and returns the columns of ``documents``; the last
adds the encoding. Language ID drops texts without a telling letter, near-dedup keeps the least id of
each group, decontamination drops documents that hold a benchmark window, the secret scan masks
secrets in the text (n_chars follows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import bpe, decontamination, language_id, minhash_dedup, secret_scans
from eventloom.llm.common import table, written
from eventloom.llm.queries import tokenizer_path


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_dedup.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scans.redact(docs, secret_scans.train(spark))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = bpe.encode(docs, tokenizer_path())
    return done.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))


STAGES = [
    ("language ID", identify),
    ("MinHash near-dedup", deduplicate),
    ("benchmark decontamination", decontaminate),
    ("secret scans", mask_secrets),
    ("BPE encoding and decoding", tokenize),
]

#: Trained models and a tokenizer decide: SQL can't express it. Tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
