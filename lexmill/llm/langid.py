"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

Training is by follow-the-regularised-leader with elastic-net penalties (FTRL-proximal), which leaves most weights
exactly zero; a temperature, fitted on rows held out, then calibrates the probabilities.

Features are the 2- and 3-grams of the text's characters, hashed to 2**16 buckets. The weight of a bucket is its
count over the number of n-grams of the text, times log((1 + N) / (1 + df)) + 1. Document frequencies cover all documents. Only
the rows that the classifier is fitted on are bounded, ``sample`` a language, by hash of the id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.window import Window

from lexmill.llm._common import buffers, free_names, small_batches, spans, tidy

BITS = 16
_M2, _M3 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77)


def _codes(raw: np.ndarray) -> np.ndarray:
    """Code points of the bytes, letters without case, what isn't a letter as a space."""
    codes = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    return np.where(codes < 65536, _TABLE[np.minimum(codes, 65535)], codes)


_TABLE = np.array([ord(chr(c).lower()[0]) if chr(c).isalpha() else 32 for c in range(65536)], np.uint32)


def features(raw: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of several texts, 2-grams and 3-grams apart, and those of each text: (2, n) ids and a mask of validity.

    ``cuts`` are the texts' character offsets. Grams of white space alone, or across texts, aren't valid.
    """
    c = _codes(raw)
    n = len(c)
    g = np.zeros((2, n), np.uint32)
    ok = np.zeros((2, n), bool)
    letter = c != 32
    shift = np.uint32(32 - BITS)
    if n > 1:
        g[0, :-1] = (c[:-1] * _M2 + c[1:] * _M3) * _M2 >> shift
        ok[0, :-1] = letter[:-1] | letter[1:]
    if n > 2:
        g[1, :-2] = ((c[:-2] * _M3 + c[1:-1]) * _M2 + c[2:] * _M3) * _M2 >> shift
        ok[1, :-2] = (letter[:-2] & letter[1:-1]) | (letter[1:-1] & letter[2:])
    inner = cuts[(cuts > 0)]
    ok[0, inner - 1] = False
    ok[1, inner - 1] = False
    ok[1, np.maximum(inner - 2, 0)[inner >= 2]] = False
    return g, ok


def _parts(batch_column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, off = buffers(batch_column)
    for i, j in spans(off, 1 << 17):
        raw = data[off[i] : off[j]]
        seen = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        yield i, j, raw, seen[off[i : j + 1] - off[i]]


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Number of documents, and of those with each bucket, over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for i, j, raw, cuts in _parts(batch.column(0)):
                g, ok = features(raw, cuts)
                doc = np.repeat(np.arange(j - i, dtype=np.uint64), np.diff(cuts)) << np.uint64(BITS)
                key = np.concatenate([(doc | g[k])[ok[k]] for k in (0, 1)])
                key.sort()
                key = key[np.r_[True, key[1:] != key[:-1]]] if len(key) else key
                total += np.bincount((key & np.uint64((1 << BITS) - 1)).astype(np.int64), minlength=1 << BITS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[some, -1].astype(np.int32)), pa.array(np.r_[total[some], rows])], ["bucket", "n"])

    got = docs.select("text").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    bucket, n = got.column("bucket").to_numpy(), got.column("n").to_numpy()
    df = np.zeros(1 << BITS, np.int64)
    df[bucket[bucket >= 0]] = n[bucket >= 0]
    return int(n[bucket < 0].sum()), df


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray  # bucket, language
    bias: np.ndarray
    temperature: float

    def table(self) -> np.ndarray:
        return (self.idf[:, None] * self.weights).astype(np.float32)


def _rows(texts: list[str], idf: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for t in texts:
        raw = np.frombuffer(t.encode(), np.uint8)
        g, ok = features(raw, np.array([0, len(t)]))
        b, n = np.unique(np.concatenate([g[0][ok[0]], g[1][ok[1]]]), return_counts=True)
        out.append((b.astype(np.int64), n / max(n.sum(), 1) * idf[b]))
    return out


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=-1, keepdims=True))
    return z / z.sum(axis=-1, keepdims=True)


def train(texts: list[str], labels: list[str], idf: np.ndarray, alpha: float = 8.0, beta: float = 0.1, l1: float = 2e-5, l2: float = 1e-4, passes: int = 3, seed: int = 5) -> Model:
    """FTRL-proximal with per-coordinate rates, one row at a time; a fifth of the rows is held out for the temperature."""
    langs = sorted(set(labels))
    rows, y = _rows(texts, idf), np.array([langs.index(x) for x in labels], int)
    k = len(langs)
    z, n = np.zeros((len(idf) + 1, k)), np.zeros((len(idf) + 1, k))  # the last row is the bias
    rng = np.random.Generator(np.random.PCG64(seed))
    perm = rng.permutation(len(rows))
    held, fit = perm[: len(rows) // 5], perm[len(rows) // 5 :]

    def weight(zz: np.ndarray, nn: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zz) <= l1, 0.0, -(zz - np.sign(zz) * l1) / ((beta + np.sqrt(nn)) / alpha + l2))

    for _ in range(passes):
        for r in rng.permutation(fit):
            b, x = rows[r]
            b, x = np.append(b, len(idf)), np.append(x, 0.1)
            w = weight(z[b], n[b])
            p = _softmax(x @ w)
            p[y[r]] -= 1
            g = x[:, None] * p[None, :]
            z[b] += g - (np.sqrt(n[b] + g * g) - np.sqrt(n[b])) / alpha * w
            n[b] += g * g
    w = weight(z, n)
    logits = np.array([x @ w[b] + 0.1 * w[-1] for b, x in (rows[r] for r in held)]).reshape(len(held), k)
    # temperature by golden section on the held-out log loss
    loss = lambda t: -np.log(np.maximum(_softmax(logits / np.exp(t))[np.arange(len(held)), y[held]], 1e-12)).mean() if len(held) else abs(t)
    lo, hi, gold = np.log(0.02), np.log(50.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, c = hi - gold * (hi - lo), lo + gold * (hi - lo)
        lo, hi = (lo, c) if loss(a) < loss(c) else (a, hi)
    return Model(langs, idf, w[:-1], 0.1 * w[-1], float(np.exp((lo + hi) / 2)))


def fit(docs: DataFrame, sample: int = 600, seed: int = 5, most_rows: int = 60_000) -> Model | None:
    """Model of the languages in ``lang``; None without any labelled text.

    It is fitted on ``sample`` rows a language, fewer where the languages are so many that ``most_rows`` would be passed (but one of each at least).
    """
    d = docs.select(docs["doc_id"].cast("string").alias("id"), docs["lang"].cast("string").alias("lang"), docs["text"].cast("string").alias("text"))
    total, df = document_frequencies(d)
    idf = np.log((1 + total) / (1 + df)) + 1
    d = d.where("lang is not null and text is not null and text != ''")
    langs = d.agg(F.count_distinct("lang")).first()[0]
    if not langs:
        return None
    each = max(1, min(sample, most_rows // langs))
    # the order is that of a hash; a row is picked by what it consists of, so ids can be null or repeated
    order = F.xxhash64(F.lit(seed), "id", F.when(F.col("id").isNull(), F.col("text")))
    cut = d.select("lang", order.alias("h")).withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where(F.col("k") <= each)
    cut = cut.groupBy("lang").agg(F.max("h").alias("most"))
    # one row a language
    rows = d.withColumn("h", order).join(F.broadcast(cut.withColumnRenamed("lang", "of")), F.col("lang") == F.col("of")).where("h <= most").select("h", "lang", "text").toArrow().to_pylist()
    rows.sort(key=lambda r: (r["h"], r["lang"], r["text"]))
    taken, left = [], dict.fromkeys((r["lang"] for r in rows), each)
    for r in rows:  # repeated rows share a hash
        if left[r["lang"]]:
            left[r["lang"]] -= 1
            taken.append(r)
    return train([r["text"] for r in taken], [r["lang"] for r in taken], idf, seed=seed)


def scores(texts: pa.Array, model: tuple) -> tuple[list[str | None], np.ndarray, np.ndarray]:
    """Best language, its probability (nan without letters) and number of n-grams of each text."""
    weights, bias, temperature, langs = model
    best, prob, grams = [None] * len(texts), np.full(len(texts), np.nan), np.zeros(len(texts), np.int64)
    for i, j, raw, cuts in _parts(texts):
        g, ok = features(raw, cuts)
        # sums by text over prefix sums would lose digits; reduceat adds up each text on its own
        score, count = np.zeros((j - i, len(langs))), np.zeros(j - i, np.int64)
        full = np.flatnonzero(np.diff(cuts) > 0)
        if len(g[0]) and len(full):
            at = cuts[:-1][full]
            both = np.where(ok[0], 1.0, 0.0).astype(np.float32)[:, None] * weights[g[0]]
            both += np.where(ok[1], 1.0, 0.0).astype(np.float32)[:, None] * weights[g[1]]
            score[full] = np.add.reduceat(both, at, axis=0, dtype=np.float64)
            count[full] = np.add.reduceat(ok[0].astype(np.int64) + ok[1], at)
        p = _softmax((score / np.maximum(count, 1)[:, None] + bias) / temperature)
        top = p.argmax(axis=1)
        grams[i:j] = count
        prob[i:j] = np.where(count > 0, p[np.arange(j - i), top], np.nan)
        best[i:j] = [langs[t] if c else None for t, c in zip(top, count)]
    return best, prob, grams


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """Columns of ``docs`` and predicted, confidence, n_grams; predicted and confidence are null for texts without letters."""
    small_batches(docs.sparkSession)
    rest = [docs[c] for c in docs.columns if c not in ("predicted", "confidence", "n_grams")]
    if model is None:
        return docs.select(*rest, F.lit(None).cast("string").alias("predicted"), F.lit(None).cast("double").alias("confidence"), F.lit(0).cast("bigint").alias("n_grams"))
    shared = docs.sparkSession.sparkContext.broadcast((model.table(), model.bias, model.temperature, model.langs))

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for t in texts:
            best, prob, grams = scores(t, shared.value)
            yield pa.StructArray.from_arrays([pa.array(best, pa.string()), pa.array(prob, pa.float64(), mask=np.isnan(prob)), pa.array(grams)], ["predicted", "confidence", "n_grams"])
        tidy()

    # texts go to Python once and only results come back; not to be run again where a filter asks for the result
    (got,) = free_names(docs, 1)
    each = arrow_udf(run, "struct<predicted:string,confidence:double,n_grams:bigint>").asNondeterministic()
    d = docs.select(*rest, each(docs["text"].cast("string")).alias(got))
    names = [c for c in docs.columns if c not in ("predicted", "confidence", "n_grams")]
    return d.select(*names, *[F.col(got)[c].alias(c) for c in ("predicted", "confidence", "n_grams")])


def identify(docs: DataFrame, min_confidence: float = 0.5, sure: float = 0.9, sample: int = 600) -> DataFrame:
    """Columns of ``docs`` and predicted, confidence, n_grams, accepted.

    accepted: the text has letters, some language reaches ``min_confidence``, and none but the document's own ``lang``
    reaches ``sure``; with a null lang the last rule is left out. Null and empty texts have no prediction and aren't
    accepted. Texts of any length count in whole. Without any labelled text there is no model and nothing is predicted or accepted. Repeated rows are
    judged alike. Equal probabilities go to the first language by name. Columns that have one of the four names are replaced, other extra columns
    pass through. An empty table gives an empty result.
    """
    p = predict(docs, fit(docs, sample))
    p = p.drop("accepted")
    own = F.col("lang").isNull() | (F.col("predicted") == F.col("lang")) | (F.col("confidence") < sure)
    return p.withColumn("accepted", F.coalesce((F.col("confidence") >= min_confidence) & own, F.lit(False)))
