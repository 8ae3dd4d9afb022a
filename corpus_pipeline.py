"""Corpus pipeline: from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; ``run`` writes every
stage's result as Parquet in the shared folder and reads it back as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfprice.llm import bpe, decontaminate, linededup, simhash, toxicity
from shelfprice.llm.common import landed, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on the labelled ones, doesn't reject."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that an earlier one nearly equals (one word edit,
    two from 20 words on)."""
    out = linededup.drop_lines(docs, two_from=20)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each SimHash component (3 words, 2 bits)."""
    return simhash.keep_one(docs, words=3, max_bits=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    found = decontaminate.find_passages(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("hits") == 0).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of their decoded bytes."""
    return bpe.tokenize(docs, outputs=("ids", "n_tokens", "decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("byte_level_bpe", tokenize),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
