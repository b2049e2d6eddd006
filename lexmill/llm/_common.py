"""Helpers shared by the corpus operators: cutting lineage, and vectorised byte-level text hashing.

Texts are handled as the raw UTF-8 buffers of Arrow string columns, a few MB at a time, so that the hot
loops are numpy operations over bytes and never Python loops over words.
"""

from __future__ import annotations

import ctypes
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

CHUNK_BYTES = 1 << 18
_P = 0x9E3779B97F4A7C15
_C = np.uint64(0xD6E8FEB86659FD93)
_MASK = (1 << 64) - 1
R = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64)
_POW: dict[int, np.ndarray] = {}


def checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder of spark.checkpoint.dir and cut its lineage there.

    Only a local session without such a folder (tests) gets one of its own; on a cluster a folder of this machine would be no use.
    """
    spark: SparkSession = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path and not (sc.master or "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(path or tempfile.mkdtemp(prefix="lexmill-"))
    return df.checkpoint(eager=True)


def partitions(df: DataFrame, mb: int = 16) -> int:
    """How many parts of about ``mb`` MB the input of ``df`` has by the optimiser's statistics, and no fewer than spark.sql.shuffle.partitions."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(least, min(size // (mb << 20), 1 << 20) if size < 1 << 60 else 0)  # unknown sizes are said to be huge


def free_names(df: DataFrame, n: int) -> list[str]:
    """``n`` column names that ``df`` doesn't have in any case."""
    have, out, k = {c.lower() for c in df.columns}, [], 0
    while len(out) < n:
        if f"__{k}" not in have:
            out.append(f"__{k}")
        k += 1
    return out


def small_batches(spark: SparkSession, size: str = "4m") -> None:
    """Let Arrow batches hold 4 MB, where the session has the default of 64 MB, of which several are in memory for each task."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, "67108864b").lower() in ("67108864b", "67108864", "64mb", "64m"):
        spark.conf.set(key, size)


def tidy() -> None:
    """Give memory that was freed back to the system, so that idle workers stay small."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the process."""
    have = _POW.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        have = np.full(size, base & _MASK, dtype=np.uint64)
        have[0] = 1
        with np.errstate(over="ignore"):
            np.multiply.accumulate(have, out=have)
        _POW[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * _C
    h ^= h >> np.uint64(29)
    h = h * _C
    return h ^ (h >> np.uint64(32))


def buffers(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if isinstance(col, pa.ChunkedArray):  # combine_chunks keeps several chunks beyond 2 GB
        col = pa.concat_arrays([c.cast(pa.large_string()) for c in col.chunks])
    if pa.types.is_null(col.type) or not len(col):
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    wide = pa.types.is_large_string(col.type)
    if not wide and not pa.types.is_string(col.type):
        col = col.cast(pa.string())
    _, off, data = col.buffers()
    o = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    if col.null_count:  # a null may own bytes
        valid = np.asarray(col.is_valid())
        if (np.diff(o)[~valid] > 0).any():
            return buffers(col.fill_null(""))
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), o


def spans(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts hold about ``limit`` bytes together; a longer text makes a range alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
NOT_SPACE = ~SPACE


def words(b: np.ndarray, docs: np.ndarray, is_word: np.ndarray = NOT_SPACE, table: np.ndarray = R):
    """Start, end and 64-bit hash of each word of the bytes ``b``; no word crosses a start in ``docs``."""
    n = len(b)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64)
    w = is_word[b]
    edge = np.zeros(n + 1, bool)
    edge[docs[docs <= n]] = True
    first = w.copy()
    first[1:] &= ~w[:-1] | edge[1:n]
    last = w.copy()
    last[:-1] &= ~w[1:] | edge[1:n]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    return s, e, span_hash(b, s, e, table)


def span_hash(b: np.ndarray, s: np.ndarray, e: np.ndarray, table: np.ndarray = R) -> np.ndarray:
    """Polynomial hash, modulo 2**64 and then mixed, of the byte spans [s, e)."""
    n = len(b)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(table[b] * powers(_P, n), out=total[1:])
    return mix((total[e] - total[s]) * powers(pow(_P, -1, 1 << 64), n + 1)[s] + (e - s).astype(np.uint64))
