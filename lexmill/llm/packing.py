"""Best-fit packing by sum of squares: a document goes where the squared counts of open bins per gap become smallest.

With N(g) open bins of gap g (free tokens, 0 < g < capacity), putting a piece of s tokens into a bin of gap g changes
the sum of N(g)**2 by 2 (N(g - s) - N(g)) + 2, or by 1 - 2 N(g) if it fills the bin; a new bin changes it by
2 N(capacity - s) + 1. The least change wins; of equal ones the smallest gap, and an open bin before a new one; of bins with one gap
that which was used last.

The rule is sequential, so shards of about ``shard_docs`` documents, by hash of the id and text, are packed on their own and in
parallel. Only ids and token counts are shuffled.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.mixing import n_tokens

SCHEMA = "shard int, bin bigint, slot int, doc_id bigint, piece int, start bigint, n_tokens int"


def pack(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and slot of each piece, in order; sizes are from 1 to capacity."""
    count = np.zeros(capacity + 1, np.int64)  # count[0] stays 0: full bins aren't open
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    filled: list[int] = []
    bins, slots = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int32)
    far = np.int64(1 << 60)
    for i, s in enumerate(sizes.tolist()):
        change = 2 * (count[: capacity + 1 - s] - count[s:]) + 2  # by gap s..capacity
        change[0] -= 1
        change[count[s:] == 0] = far
        g = int(change.argmin())
        fresh = 2 * int(count[capacity - s]) + 1 if s < capacity else 0
        if change[g] <= fresh:
            gap = g + s
            b = stacks[gap].pop()
            count[gap] -= 1
        else:
            gap, b = capacity, len(filled)
            filled.append(0)
        bins[i], slots[i] = b, filled[b]
        filled[b] += 1
        if gap > s:
            stacks[gap - s].append(b)
            count[gap - s] += 1
    return bins, slots


def sharded(docs: DataFrame, shard_docs: int, seed: int) -> DataFrame:
    """(doc_id, n, h, shard) of the documents with tokens; h is their order."""
    d = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))
    # as many shards as the documents need, from one count without reading texts
    shards = max(1, -(-docs.count() // shard_docs))
    # with the text in it, rows without an id spread like others
    d = d.select("doc_id", n_tokens(F.col("text")).alias("n"), F.xxhash64(F.lit(seed), "doc_id", F.when(F.col("doc_id").isNull(), F.col("text"))).alias("h")).where("n > 0")
    return d.withColumn("shard", F.pmod("h", F.lit(shards)).cast("int"))


def pack_documents(docs: DataFrame, capacity: int = 2048, shard_docs: int = 20_000, seed: int = 11) -> DataFrame:
    """(shard, bin, slot, doc_id, piece, start, n_tokens): where each piece of each document lies.

    Tokens are whitespace-separated words. A text over ``capacity``, however long, is cut into pieces of that size, each a full bin,
    and a last, shorter one. Documents without tokens (null, empty, white space) have no piece. Within a shard
    documents come in hashed order of id, then size; repeated rows (ties) are placed each on its own. Null ids are
    kept as null and spread by their texts. Ids are cast to bigint. Extra columns are ignored, whatever their names. An empty table gives an empty result. Bins number from 0 in each shard.
    How many shards there are follows the number of documents, so that one holds ``shard_docs`` at any size.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "n", "doc_id"], kind="stable")
        n = pdf["n"].to_numpy(np.int64)
        pieces = -(-n // capacity)
        row = np.repeat(np.arange(len(n)), pieces)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        size = np.minimum(n[row] - piece * capacity, capacity)
        bins, slots = pack(size, capacity)
        return pd.DataFrame({"shard": pdf["shard"].to_numpy()[row], "bin": bins, "slot": slots, "doc_id": pdf["doc_id"].astype("Int64").array[row], "piece": piece.astype(np.int32), "start": piece * capacity, "n_tokens": size.astype(np.int32)})

    return sharded(docs, shard_docs, seed).groupBy("shard").applyInPandas(run, SCHEMA)
