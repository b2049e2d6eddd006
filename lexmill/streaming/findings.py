"""Findings over a stream of changed articles: the batch operators, on a folder that files arrive in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators.style import check_lines


def read_changes(spark: SparkSession, path: str, schema: str = "doc_id bigint, text string, ts timestamp") -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def change_findings(changes: DataFrame, late: str = "10 minutes", every: str = "1 hour") -> DataFrame:
    """(window, code, n): style findings by hour of change; changes that are late by more than ``late`` are dropped."""
    found = changes.withWatermark("ts", late).select(F.struct("doc_id", "ts").alias("key"), "text")
    return check_lines(found, "key").groupBy(F.window("key.ts", every), "code").agg(F.count("*").alias("n"))
