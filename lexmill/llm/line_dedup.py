"""Line dedup by winnowing over line hashes: minima of windows are fingerprints, matches of them are extended, later repeated runs go.

A run of consecutive lines with at least ``min_words`` words that began earlier in the corpus (by document, then line) is a
repeat; every line of every repeat goes, so only the first copy of a passage stays.

1. *Select.* The window of a line is the shortest run from it on with ``min_words`` words. Of each window the line with the least
   hash (the rightmost of equal ones) is a fingerprint; neighbouring windows mostly select the same line.
2. *Join.* A repeated run holds whole windows, and equal windows select equal lines, so each of its windows has a fingerprint that
   occurs elsewhere. Only the windows of such fingerprints go on: all others are unique, and their lines aren't looked at again.
3. *Extend.* Matches are extended through windows: to the right by those that begin in a line, to the left by mirrored ones (the shortest runs that
   end in it), as far as their whole contents occurred before. A repeated run is exactly the union of these, since what lies behind its last forward window is
   shorter than a window and so inside the mirrored window of its last line. Each content has one first place; no pairs of copies are formed.
4. *Delete.* All windows but those at the first place of their content go.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm._common import buffers, checkpoint, free_names, mix, powers, small_batches, span_hash, spans, tidy, words

_B1, _B2 = 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9
_SALT = np.uint64(0x94D049BB133111EB)


def line_windows(line_words: np.ndarray, doc_end: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the shortest runs with ``least`` words from each line on; ``doc_end``: end of each line's document."""
    total = np.concatenate([[0], np.cumsum(line_words)])
    end = np.searchsorted(total, total[:-1] + least, "left")
    ok = (end <= doc_end) & (line_words > 0)
    return np.flatnonzero(ok), end[ok]


def window_minima(h: np.ndarray, a: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Place of the least hash of each window [a, z), the rightmost of equal ones."""
    order = np.lexsort((-np.arange(len(h)), h))
    level = np.empty(len(h), np.int64)
    level[order] = np.arange(len(h))
    out, step = level[a].copy(), 1
    longest = int((z - a).max()) if len(a) else 0
    while step <= longest:
        m = ((z - a) >= step) & ((z - a) < 2 * step)
        out[m] = np.minimum(level[a[m]], level[z[m] - step])
        if 2 * step > longest:
            break
        level = np.minimum(level[:-step], level[step:])
        step *= 2
    return order[out]


def _minima(h: np.ndarray, n_words: np.ndarray, doc_end: np.ndarray, least: int, line_words: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Forward windows (starts, ends), the place that each selects, and single lines that are long enough to be runs."""
    a, z = line_windows(n_words, doc_end, least)
    whole = np.flatnonzero(n_words >= max(1, line_words)) if line_words is not None else a[:0]
    return a, z, window_minima(h, a, z), whole


def _select(least: int, line_words: int | None = None):
    """Per document that has a window: the hashes and words of its lines, and the fingerprints with their lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(2))
            for i, j in spans(off):
                b = data[off[i] : off[j]]
                docs = off[i : j + 1] - off[i]
                nl = np.flatnonzero(b == 10)
                starts = np.sort(np.concatenate([docs[:-1], nl + 1]))  # an empty text is one empty line
                ends = np.sort(np.concatenate([nl, docs[1:]]))
                # a newline that ends a text starts an empty line there, before the next text's first line
                doc = np.sort(np.concatenate([np.arange(j - i), np.searchsorted(docs, nl, "right") - 1]))
                first = np.searchsorted(doc, np.arange(j - i + 1))
                ws, we, _ = words(b, docs)
                lo = np.searchsorted(ws, starts)
                hi = np.searchsorted(ws, ends)
                n_words = hi - lo
                # the line without the white space around it
                has = n_words > 0
                s, e = starts.copy(), starts.copy()
                s[has], e[has] = ws[lo[has]], we[hi[has] - 1]
                h = span_hash(b, s, e) if len(b) else np.zeros(len(s), np.uint64)
                _, _, least_at, whole = _minima(h, n_words, first[doc + 1], least, line_words)
                chosen = np.unique(np.concatenate([least_at, whole]))
                some = np.unique(doc[chosen])
                if not len(some):
                    continue
                prints = pa.StructArray.from_arrays([pa.array(h[chosen].view(np.int64)), pa.array((chosen - first[doc[chosen]]).astype(np.int32))], ["f", "line"])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.bincount(np.searchsorted(some, doc[chosen]), minlength=len(some)))]).astype(np.int32)), prints)
                at = pa.array(some + i)
                rows = [(h[first[d] : first[d + 1]].tobytes(), n_words[first[d] : first[d + 1]].astype(np.int32).tobytes()) for d in some.tolist()]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary()), lists], ["doc", "body", "hashes", "words", "prints"])
        tidy()

    return run


def _extend(least: int, line_words: int | None = None):
    """The windows, forward and mirrored, whose fingerprint occurs elsewhere: hash of the content, place and number of lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            size = np.array([len(x) // 8 for x in whole_batch.column(2).to_pylist()], np.int64)
            total = np.concatenate([[0], np.cumsum(size)])
            for i, j in spans(total, 1 << 16):
                batch = whole_batch.slice(i, j - i)
                h = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint64)
                n_words = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.int32).astype(np.int64)
                first = total[i : j + 1] - total[i]
                doc = np.repeat(np.arange(j - i), np.diff(first))
                n = len(h)
                matched = np.zeros(n, bool)
                lines = batch.column(4)
                matched[np.asarray(lines.flatten()) + np.repeat(first[:-1], np.asarray(lines.value_lengths()))] = True
                fs, fe, least_at, whole = _minima(h, n_words, first[doc + 1], least, line_words)
                goes = np.zeros(n, bool)
                goes[fs] = matched[least_at]
                back, ms = line_windows(n_words[::-1], n - first[doc[::-1]], least)
                me, ms = n - back, n - ms
                whole = whole[matched[whole]]
                ok, mok = goes[fs], goes[ms]
                a, z = np.concatenate([fs[ok], ms[mok], whole]), np.concatenate([fe[ok], me[mok], whole + 1])
                if not len(a):
                    continue
                same = np.unique(a * (n + 1) + z)
                a, z = same // (n + 1), same % (n + 1)
                p1 = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * powers(_B1, n))])
                p2 = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h ^ _SALT) * powers(_B2, n))])
                k1 = mix((p1[z] - p1[a]) * powers(pow(_B1, -1, 1 << 64), n)[a] + (z - a).astype(np.uint64))
                k2 = mix((p2[z] - p2[a]) * powers(pow(_B2, -1, 1 << 64), n)[a])
                at = pa.array(doc[a])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), batch.column(0).take(at), batch.column(1).take(at), pa.array((a - first[doc[a]]).astype(np.int32)), pa.array((z - a).astype(np.int32))],
                    ["k1", "k2", "doc", "body", "line", "n"],
                )
        tidy()

    return run


def repeated_runs(docs: DataFrame, min_words: int = 40, line_words: int | None = None) -> DataFrame:
    """(doc, body, runs): the windows (line, n) of each document that began earlier in the corpus; body is the hash of its text."""
    small_batches(docs.sparkSession)
    text = docs["text"].cast("string")
    d = docs.select(docs["doc_id"].cast("bigint").alias("doc"), F.xxhash64(text).alias("body"), text.alias("text")).where("doc is not null and text is not null")
    lines = checkpoint(d.mapInArrow(_select(min_words, line_words), "doc bigint, body bigint, hashes binary, words binary, prints array<struct<f:bigint,line:int>>"))
    prints = lines.select("doc", "body", F.explode("prints").alias("p")).select("doc", "body", "p.f", "p.line")
    # a fingerprint is counted, not gathered: whatever the number of its places, each stays a row of its own
    twice = prints.groupBy("f").agg(F.count("*").alias("places")).where("places > 1").select("f")
    matched = prints.join(twice, "f", "left_semi").groupBy("doc", "body").agg(F.collect_set("line").alias("matched"))
    w = lines.select("doc", "body", "hashes", "words").join(matched, ["doc", "body"]).mapInArrow(_extend(min_words, line_words), "k1 bigint, k2 bigint, doc bigint, body bigint, line int, n int")
    w = checkpoint(w)
    first = w.groupBy("k1", "k2").agg(F.min(F.struct("doc", "body", "line")).alias("first"), F.count("*").alias("places")).where("places > 1").drop("places")
    later = w.join(first, ["k1", "k2"]).where(F.struct("doc", "body", "line") != F.col("first"))
    return later.groupBy("doc", "body").agg(F.collect_set(F.struct("line", "n")).alias("runs"))


def dedup_lines(docs: DataFrame, min_words: int = 40, line_words: int | None = None) -> DataFrame:
    """All columns of ``docs`` with the repeated runs of lines taken out of text, and lines_removed.

    With ``line_words``, a single line of at least so many words (blank ones never) counts as a run too: headers, footers and other
    boilerplate that no longer passage surrounds. Lines are split at newlines and compared without the white space around them; blank lines have no
    words and go only inside a repeated run. The first copy, by (doc_id, hash of the text, line), stays: rows with the
    same doc_id and text (ties, repeated rows) are one document and are cut alike; rows with one doc_id and different texts are documents of their own. Repeats inside one document go as
    well. A null text stays null and an empty one empty; rows with a null doc_id are never changed. Ids are compared as bigint, and those that aren't numbers fail.
    Texts of any length are worked in whole. A document may be left with an empty text. Extra columns pass through, whatever their names; a column named lines_removed
    is replaced. An empty table gives an empty result.
    """
    ident, body, runs, gone = free_names(docs, 4)
    found = repeated_runs(docs, min_words, line_words).withColumnsRenamed({"doc": ident, "body": body, "runs": runs})
    text = docs["text"].cast("string")
    j = docs.join(found, (docs["doc_id"].cast("bigint") == found[ident]) & (F.xxhash64(text) == found[body]), "left")
    lines = F.flatten(F.transform(F.col(runs), lambda r: F.sequence(r["line"], r["line"] + r["n"] - 1)))
    j = j.withColumn(gone, F.array_distinct(lines))
    cut = F.split(text, "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(cut) - 1), F.col(gone))
    new = F.when(F.col(gone).isNull(), text).otherwise(F.array_join(F.transform(left, lambda i: F.get(cut, i)), "\n"))
    rest = [new.alias("text") if c == "text" else docs[c] for c in docs.columns if c != "lines_removed"]
    return j.select(*rest, F.when(F.col(gone).isNull(), 0).otherwise(F.size(gone)).alias("lines_removed"))

def dedup_lines_sql(min_words: int = 40, source: str = "documents", line_words: int | None = None) -> str:
    """DuckDB SQL for (doc_id, text, lines_removed), by the definition: all shortest runs forward and backward, by their text, and with ``line_words`` single lines."""
    whole = "" if line_words is None else f" UNION SELECT doc_id, line, line FROM t WHERE w >= {max(1, line_words)}"
    return f"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM {source}),
n AS (SELECT doc_id, line, raw, trim(raw, E' \\t\\r\\v\\f') AS s, len(regexp_extract_all(raw, '[^ \\t\\r\\x0B\\f]+')) AS w FROM l),
t AS (SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY line) AS upto FROM n),
fw AS (SELECT a.doc_id, a.line AS a, min(b.line) AS z FROM t a JOIN t b ON a.doc_id = b.doc_id AND b.line >= a.line AND b.upto - a.upto + a.w >= {min_words} WHERE a.w > 0 GROUP BY ALL),
bw AS (SELECT b.doc_id, max(a.line) AS a, b.line AS z FROM t b JOIN t a ON a.doc_id = b.doc_id AND b.line >= a.line AND b.upto - a.upto + a.w >= {min_words} WHERE b.w > 0 GROUP BY b.doc_id, b.line),
win AS (SELECT * FROM fw UNION SELECT * FROM bw{whole}),
c AS (SELECT win.doc_id, a, z, string_agg(s, chr(10) ORDER BY line) AS body FROM win JOIN n ON n.doc_id = win.doc_id AND n.line BETWEEN a AND z GROUP BY ALL),
later AS (SELECT doc_id, a, z, row_number() OVER (PARTITION BY body ORDER BY doc_id, a) AS k FROM c),
gone AS (SELECT DISTINCT n.doc_id, n.line FROM n JOIN later ON n.doc_id = later.doc_id AND n.line BETWEEN a AND z WHERE k > 1)
SELECT n.doc_id, coalesce(string_agg(n.raw, chr(10) ORDER BY n.line) FILTER (WHERE gone.line IS NULL), '') AS text, count(gone.line)::INT AS lines_removed
FROM n LEFT JOIN gone ON n.doc_id = gone.doc_id AND n.line = gone.line GROUP BY n.doc_id
"""
