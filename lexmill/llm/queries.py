"""Queries of the corpus operators for __spark_entry__, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexmill.llm.fingerprints import fingerprints, fingerprints_sql
from lexmill.llm.jaccard import jaccard_groups, jaccard_sql
from lexmill.llm.langid import identify
from lexmill.llm.licenses import scan_licenses
from lexmill.llm.line_dedup import dedup_lines, dedup_lines_sql
from lexmill.llm.mixing import TARGETS, mix, mix_sql
from lexmill.llm.packing import pack_documents
from lexmill.llm.pii import surrogate_pii
from lexmill.llm.quality import quality_filter, quality_sql
from lexmill.llm.revisits import records_of_pages, resolve_revisits, revisits_sql


LINE_WORDS = 4


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op1_whole_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1_line_dedup, with repeated single lines of LINE_WORDS words taken out too."""
    return dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"), line_words=LINE_WORDS)


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogate_pii(_table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = identify(_table(spark, sf_dir, "documents"))
    return d.where("accepted").select("doc_id", "lang", "predicted", "confidence")


def op4_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_revisits(records_of_pages(_table(spark, sf_dir, "pages")))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(_table(spark, sf_dir, "documents"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(_table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents"), weights=TARGETS).select("doc_id", "domain", "lang", "source", "n_tokens", "epoch")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_filter(_table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op1_whole_lines": op1_whole_lines,
    "op2_pii_surrogates": op2_pii_surrogates,
    "op3_language_id": op3_language_id,
    "op4_revisits": op4_revisits,
    "op5_fingerprints": op5_fingerprints,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_mixing": op7_mixing,
    "op8_license_scan": op8_license_scan,
    "op9_quality_rules": op9_quality_rules,
    "op10_packing": op10_packing,
}

ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": dedup_lines_sql(),
    "op1_whole_lines": dedup_lines_sql(line_words=LINE_WORDS),
    "op4_revisits": revisits_sql(),
    "op5_fingerprints": fingerprints_sql(),
    "op6_ngram_jaccard_join": jaccard_sql(),
    "op7_mixing": mix_sql(weights=TARGETS),
    "op9_quality_rules": quality_sql(),
}
