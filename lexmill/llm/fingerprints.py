"""Document fingerprints by winnowing: rolling k-gram hashes, window minima, rightmost ties, positions.

Any passage of at least ``k + window - 1`` characters that two documents share gives both a common
fingerprint, and at the same place of the passage. The pass is map-only: nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lexmill.llm._common import buffers, powers, small_batches, spans, tidy

BASE = 0x9E3779B97F4A7C15
SPREAD = 0x2545F4914F6CDD1D  # odd and under 2**62
_POS = 24
_LOW = np.uint64((1 << _POS) - 1)
_SEGMENT = 1 << 18


def kgram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """H(i) = SPREAD * sum(codes[i+j] * BASE**j, j < k) modulo 2**64, rolled by prefix sums."""
    n = len(codes)
    if n < k:
        return np.zeros(0, np.uint64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(codes * powers(BASE, n), out=total[1:])
    return (total[k:] - total[:-k]) * powers(pow(BASE, -1, 1 << 64), n)[: n - k + 1] * np.uint64(SPREAD)


def _lows(key: np.ndarray, w: int) -> np.ndarray:
    """Least value of each window of ``w``."""
    m = len(key)
    blocks = np.concatenate([key, np.full(-m % w, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: m - w + 1], ahead[w - 1 : m])


def window_minima(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions of the rightmost minimum of each window; fewer hashes than a window are one window.

    The upper 40 bits of a hash and its place are one number, so that minima are found by accumulation; where these bits are those of a smaller hash
    beside it, which the minima of whole hashes show, the part is ranked in full.
    """
    n = len(hashes)
    if n == 0:
        return np.zeros(0, np.int64)
    w, found = min(window, n), []
    for at in range(0, n - w + 1, _SEGMENT):
        part = hashes[at : min(n, at + _SEGMENT + w - 1)]
        m = len(part)
        key = (part & ~_LOW) | (_LOW - np.arange(m, dtype=np.uint64))
        pos = (_LOW - (_lows(key, w) & _LOW)).astype(np.int64)
        if (part[pos] != _lows(part, w)).any():
            order = np.lexsort((-np.arange(m), part))
            rank = np.empty(m, np.uint64)
            rank[order] = np.arange(m, dtype=np.uint64)
            pos = order[_lows(rank, w).astype(np.int64)]
        found.append(at + pos[np.r_[True, pos[1:] != pos[:-1]]])
    out = np.concatenate(found)
    return out[np.r_[True, out[1:] != out[:-1]]]


def _winnow(k: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(1))
            ids = batch.column(0)
            for i, j in spans(off):
                raw = data[off[i] : off[j]]
                codes = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.uint64)
                seen = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
                cut = seen[off[i : j + 1] - off[i]]
                row, at, value = [], [], []
                for d in range(j - i):
                    h = kgram_hashes(codes[cut[d] : cut[d + 1]], k)
                    p = window_minima(h, window)
                    row.append(np.full(len(p), i + d))
                    at.append(p)
                    value.append(h[p])
                row = np.concatenate(row)
                if len(row):
                    value = (np.concatenate(value) >> np.uint64(1)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(row)), pa.array(np.concatenate(at)), pa.array(value)], ["doc_id", "pos", "fingerprint"])

    return run


def fingerprints(docs: DataFrame, k: int = 32, window: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, pos, fingerprint): the winnowed k-grams of each whole text, positions in characters.

    Null and empty texts, and texts under ``k`` characters, have no fingerprint. Texts of fewer than
    ``window`` k-grams have one. Texts of any length are worked in overlapping segments. Among equal
    hashes in a window the rightmost is kept, so repeated passages within a text give few rows.
    Repeated rows give repeated results; a null id is kept as null; other columns are ignored,
    whatever their names. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    return docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(
        _winnow(k, window), "doc_id bigint, pos bigint, fingerprint bigint"
    )


def fingerprints_sql(k: int = 32, window: int = 64) -> str:
    """The same rows for DuckDB: sums of k terms of a polynomial over all characters, brought to the k-gram's own powers, modulo 2**64 in 128-bit integers."""
    two64 = 1 << 64
    inverse = pow(BASE, -1, two64)
    lst = lambda b, step: "[" + ", ".join(f"{pow(b, j * step, two64)}::UHUGEINT" for j in range(512)) + "]"
    power = lambda name, i: f"(({name}0[1 + {i} % 512] * {name}1[1 + {i} // 512]) % {two64}::UHUGEINT)"
    return f"""
WITH p AS (SELECT {lst(BASE, 1)} AS b0, {lst(BASE, 512)} AS b1, {lst(inverse, 1)} AS i0, {lst(inverse, 512)} AS i1),
d AS (SELECT doc_id, text, length(text) AS n FROM documents WHERE length(text) >= {k}),
c AS (SELECT doc_id, n, unnest(string_split(text, '')) AS x, unnest(range(0, n)) AS pos FROM d),
t AS (SELECT doc_id, n, pos, ((unicode(x)::UHUGEINT * {power("b", "pos")}) % {two64}::UHUGEINT)::HUGEINT AS term FROM c, p),
s AS (SELECT doc_id, n - {k} + 1 AS n, pos, sum(term) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {k - 1} FOLLOWING) AS s FROM t),
h AS (SELECT doc_id, n, pos, ((((s % {two64}::HUGEINT)::UHUGEINT * {power("i", "pos")}) % {two64}::UHUGEINT) * {SPREAD}::UHUGEINT % {two64}::UHUGEINT)::HUGEINT AS hash FROM s, p WHERE pos < n),
o AS (SELECT doc_id, n, pos, hash, hash * {1 << 24}::HUGEINT + ({(1 << 24) - 1}::HUGEINT - pos) AS key FROM h),
m AS (SELECT doc_id, n, pos, min(key) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {window - 1} FOLLOWING) AS low FROM o),
f AS (SELECT DISTINCT doc_id, low FROM m WHERE pos <= greatest(n - {window}, 0))
SELECT doc_id, ({(1 << 24) - 1}::HUGEINT - low % {1 << 24}::HUGEINT)::BIGINT AS pos, (low // {1 << 25}::HUGEINT)::BIGINT AS fingerprint FROM f
"""
