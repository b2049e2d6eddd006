"""Steps that several operators share: results that are kept, small batches for Python, and lookups of many occurrences in a large table."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kept(df: DataFrame) -> DataFrame:
    """``df`` in the folder of spark.checkpoint.dir; only a local session without one gets a folder of its own."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        path = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not path and not (sc.master or "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(path or tempfile.mkdtemp(prefix="lexmill-"))
    return df.checkpoint(eager=True)


def small_batches(spark: SparkSession, size: str = "4m") -> None:
    """Let Arrow batches hold 4 MB, where the session has the default of 64 MB, of which a Python worker has several in memory at once."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, "67108864b").lower() in ("67108864b", "67108864", "64mb", "64m"):
        spark.conf.set(key, size)


def looked_up(each: DataFrame, table: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Inner join of many rows ``each`` with ``table`` by ``key``, both free to be of any size.

    ``hot``: (key) of the most frequent values, few enough to go along by broadcast; only rows with other values are shuffled.
    """
    common = table.join(F.broadcast(hot), key, "left_semi")
    return each.join(F.broadcast(common), key).unionByName(each.join(F.broadcast(hot), key, "left_anti").join(table, key))
