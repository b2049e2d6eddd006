"""The corpus pipeline: language ID, line dedup, near-duplicate removal, mixing to target weights, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the last return the
columns of documents. Language ID and sum-of-squares packing can't be said in SQL, so ORACLE_SQL is None and tests/llm compares
run() with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm._common import checkpoint
from lexmill.llm.jaccard import drop_near_duplicates
from lexmill.llm.langid import identify
from lexmill.llm.line_dedup import dedup_lines
from lexmill.llm.mixing import TARGETS, mix
from lexmill.llm.packing import pack_documents


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified, and isn't surely another than they say."""
    return identify(docs).where("accepted").select(docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat earlier passages; those of which nothing but white space is left go."""
    d = dedup_lines(docs).where("lines_removed = 0 or text rlike '[^ \\\\t\\\\n\\\\r\\\\x0B\\\\f]'")
    return d.withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, and all others."""
    return drop_near_duplicates(docs).select(docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Half of all tokens, by the target weights of domains, languages and sources as far as they go."""
    return mix(docs, weights=TARGETS).select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bins of the training sequences."""
    return pack_documents(docs)


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = checkpoint(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
