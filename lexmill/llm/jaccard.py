"""N-gram Jaccard join: all links between documents whose sets of word n-grams have a Jaccard distance of at most r = 1 - s.

Documents are points of the Jaccard metric; equal sets are one point (a class) from the start. Nearly all points
lie at distance 1 of each other, where the triangle inequality says nothing, so the join rests on pivots that cover points:

1. *Peeling.* A document of n n-grams of which fewer than s * n occur elsewhere has no neighbour and leaves.
2. *Pivots.* Of the points that share an n-gram the least one leads it; who leads at least half of its shared n-grams is a pivot. In
   a cluster few points can, so pivots lie apart.
3. *Voronoi regions.* Each point has its home at the pivot nearest by the n-grams that they share; within COVER of it, the pivot covers the point.
4. *Windows.* Neighbours of a covered point x lie within COVER + r < 1 of its pivot p, by the triangle inequality, so they
   share n-grams with p and are found by p's: all of these are replicated to the region. Inside it only those with
   |d(x, p) - d(y, p)| <= r are compared with x, by exact counts of common n-grams.
5. *Recursion.* All links of covered points are known then. Those not covered are joined again, among themselves and with pivots of
   their own, till none that shares n-grams is left; a rest that fits into one block is a region as a whole, and of a crowd of which a round
   settles less than half, which lies too far apart for pivots to cover, each point is a pivot that covers itself.

A large region is cut into blocks of members, and each pair of blocks is a task of its own, so no region has to fit into a worker.
Neighbours share many n-grams, hence also some of the rarest of each: only those are looked up (a prefix in the order of a count
sketch), and as many as that lets common ones be required in number.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.window import Window

from lexmill.llm._common import buffers, checkpoint, free_names, mix, partitions, small_batches, spans, tidy, words

_A = np.uint64(0x9E3779B97F4A7C15)
_DOCS = 1 << 15  # of one blob, so that two bytes number them
_GRAMS = 1 << 18  # of one slice of points
COVER = 0.3  # the less, the more n-grams windows share, and the fewer points a pivot covers
_SHARED = 0.05  # of a point's n-grams, that it has to share in the prefix, where the window's share isn't less
_CELLS = 1 << 16
_BLOCK, _BLOCK_GRAMS = 2048, 1 << 20
_PAIRS = 1 << 18  # of pivots and points, counted and handed on at once
_WIDE = 4  # ids whose broadcast takes what a row of tasks does


def ngram_hashes(b: np.ndarray, docs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of all word n-grams; a document of fewer words has one, of all its words."""
    s, _, h = words(b, docs)
    doc = np.searchsorted(docs, s, "right") - 1
    count = np.bincount(doc, minlength=len(docs) - 1) if len(doc) else np.zeros(len(docs) - 1, np.int64)
    at = np.concatenate([[0], np.cumsum(count)])
    m = len(h) - n + 1
    g, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if m > 0:
        g = h[:m].copy()
        for k in range(1, n):
            g = g * _A + h[k : k + m]
        ok = doc[:m] == doc[n - 1 :]
        g, owner = g[ok], doc[:m][ok]
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        own = np.zeros(len(short), np.uint64)
        for k in range(n - 1):
            more = count[short] > k
            own[more] = own[more] * _A + h[at[short[more]] + k]
        g, owner = np.concatenate([g, own * _A + np.uint64(1)]), np.concatenate([owner, short])
    return owner, mix(g)


def _blobs(n: int, buckets: int):
    """Each batch's distinct n-grams by bucket, four bytes each, with the number of their document in the batch; its ids and sizes once.

    These go along with another bucket from batch to batch: one that all went along with would hold twelve bytes of every document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 32
        for whole in batches:
            for start in range(0, whole.num_rows, _DOCS):
                batch = whole.slice(start, _DOCS)
                data, off = buffers(batch.column(1))
                keys = []
                for i, j in spans(off):
                    doc, g = ngram_hashes(data[off[i] : off[j]], off[i : j + 1] - off[i], n)
                    key = (doc + i).astype(np.uint64) << np.uint64(48) | g >> np.uint64(16)
                    key.sort()
                    keys.append(key[np.r_[True, key[1:] != key[:-1]]] if len(key) else key)
                key = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
                doc, token = (key >> np.uint64(48)).astype(np.uint16), key & np.uint64((1 << 48) - 1)
                size = np.bincount(doc, minlength=batch.num_rows)
                bucket = (token % np.uint64(buckets)).astype(np.int32)
                token = (token // np.uint64(buckets)).astype(np.uint32)
                order = np.argsort(bucket.astype(np.uint16) if buckets < 65536 else bucket, kind="stable")
                token, doc = token[order], doc[order]
                cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
                full = np.flatnonzero(np.diff(cut))
                full = full if len(full) else np.array([0])
                rows = [(int(k), serial, token[cut[k] : cut[k + 1]].tobytes(), doc[cut[k] : cut[k + 1]].tobytes(), None, None) for k in full]
                ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                head = int(mix(np.array([serial], np.uint64))[0] % np.uint64(len(rows)))
                rows[head] = (*rows[head][:4], ids.tobytes(), size.astype(np.int32).tobytes())
                kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["bucket", "batch", "tokens", "docs", "ids", "sizes"])
                serial += 1
        tidy()

    return run


def _views(column: pa.Array | pa.ChunkedArray, kind: type) -> list[np.ndarray]:
    """The arrays of a binary column without nulls, each as a view of Arrow's memory."""
    out = []
    for c in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        off, data = (np.frombuffer(b, k) if b is not None else np.zeros(0, k) for b, k in zip(c.buffers()[1:], (np.int32, np.uint8)))
        off = off[c.offset : c.offset + len(c) + 1].tolist()
        out += [data[i:j].view(kind) if i % np.dtype(kind).itemsize == 0 else np.frombuffer(data[i:j].tobytes(), kind) for i, j in zip(off, off[1:])]
    return out


def _shared(table: pa.Table) -> pa.Table:
    """Of each blob the documents' numbers, once for each n-gram that another document of the bucket has too."""
    tokens = _views(table.column("tokens"), np.uint32)
    every = np.concatenate(tokens)
    every.sort()
    twice = every[1:][every[1:] == every[:-1]]
    del every
    twice = twice[np.r_[True, twice[1:] != twice[:-1]]] if len(twice) else twice
    out = []
    for t, d in zip(tokens, _views(table.column("docs"), np.uint16)):
        hit = twice[np.minimum(np.searchsorted(twice, t), len(twice) - 1)] == t if len(twice) else np.zeros(len(t), bool)
        out.append(d[hit].tobytes())
    tidy()
    return pa.table({"batch": table.column("batch"), "docs": pa.array(out, pa.binary()), "ids": table.column("ids"), "sizes": table.column("sizes")})


def _alive(similarity: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        head = pdf[pdf["ids"].notna()].iloc[0]
        ids, size = np.frombuffer(head["ids"], np.int64), np.frombuffer(head["sizes"], np.int32)
        n = np.bincount(np.concatenate([np.frombuffer(d, np.uint16) for d in pdf["docs"]]), minlength=len(ids))
        return pd.DataFrame({"doc_id": ids[(size > 0) & (n >= similarity * size - 1e-9)]})

    return run


def peel(docs: DataFrame, n: int, similarity: float) -> DataFrame:
    """(doc_id): the documents of whose n-grams a share of ``similarity`` occurs in other documents too.

    N-grams are compared by 32 bits and their bucket, of which there are as many as the data needs; a collision only keeps a document for the steps behind.
    """
    buckets = partitions(docs)
    blobs = docs.mapInArrow(_blobs(n, buckets), "bucket int, batch bigint, tokens binary, docs binary, ids binary, sizes binary")
    shared = blobs.groupBy("bucket").applyInArrow(_shared, "batch bigint, docs binary, ids binary, sizes binary")
    return shared.groupBy("batch").applyInPandas(_alive(similarity), "doc_id bigint").distinct()


def point_sets(b: np.ndarray, docs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Documents that have n-grams, the hash of each one's set, where its n-grams begin and end, and these, sorted."""
    doc, g = ngram_hashes(b, docs, n)
    order = np.lexsort((g, doc))
    doc, g = doc[order], g[order]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (g[1:] != g[:-1])] if len(g) else np.zeros(0, bool)
    doc, g = doc[new], g[new]
    size = np.bincount(doc, minlength=len(docs) - 1)
    some = np.flatnonzero(size)
    at = np.concatenate([[0], np.cumsum(size[some])])
    point = mix(np.add.reduceat(mix(g), at[:-1]) + size[some].astype(np.uint64)).view(np.int64) if len(some) else np.zeros(0, np.int64)
    return some, point, at, g


def _sets(n: int, grams: bool):
    """(doc_id, point) of each text, or (doc_id, point, size, grams); point is the hash of the set of n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = buffers(batch.column(1))
            for i, j in spans(off):
                some, point, at, g = point_sets(data[off[i] : off[j]], off[i : j + 1] - off[i], n)
                if not len(some):
                    continue
                cols = [batch.column(0).take(pa.array(some + i)), pa.array(point)]
                if grams:
                    cols += [pa.array(np.diff(at).astype(np.int32)), pa.array([g[a:z].tobytes() for a, z in zip(at[:-1], at[1:])], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "point", "size", "grams"][: len(cols)])
        tidy()

    return run


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Pieces of batches (point, grams, ..) of about _GRAMS n-grams, with the sizes of their sets and all n-grams."""
    for whole in batches:
        g = whole.column(1)
        off = np.frombuffer(g.buffers()[1], np.int32)[g.offset : g.offset + len(g) + 1].astype(np.int64) if len(g) else np.zeros(1, np.int64)
        for i, j in spans(off, 8 * _GRAMS):
            for start in range(i, j, _DOCS):
                end = min(j, start + _DOCS)
                yield whole.slice(start, end - start), np.diff(off[start : end + 1]) // 8, np.frombuffer(g.buffers()[2], np.uint8)[off[start] : off[end]].view(np.uint64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(_CELLS, np.int64)
    for _, _, g in _slices(batches):
        total += np.bincount((g & np.uint64(_CELLS - 1)).astype(np.int64), minlength=_CELLS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["cell", "n"])


def sketch(points: DataFrame) -> np.ndarray:
    """How often n-grams of each of _CELLS cells occur in the points: the order of n-grams, from rare to frequent."""
    got = points.select("point", "grams").mapInArrow(_counted, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(_CELLS, np.int64)
    out[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    return out


def _required(size: np.ndarray, least: float) -> np.ndarray:
    """How many of its prefix a set has to share with a larger or equal one."""
    return 1 + np.floor(min(_SHARED, least) * size).astype(np.int64)


def _behind(size: np.ndarray, least: float) -> np.ndarray:
    """How many n-grams of a set lie behind its prefix."""
    return np.maximum(np.ceil(least * size - 1e-9).astype(np.int64) - _required(size, least), 0)


def _prefixes(buckets: int, least: float, cells):
    """The rarest n-grams of each point by bucket: (tokens, numbers of their points among those of the row), points, sizes, pivots.

    Two sets of which a share ``least`` of each is common have at least the lesser of what they require in common in their prefixes, and of all that is
    common no more lies outside than the larger of them has behind its prefix. Of a token 32 bits and the bucket are kept; a collision only adds to a count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, size, g in _slices(batches):
            row = np.repeat(np.arange(len(size)), size)
            order = np.lexsort((g, cells.value[(g & np.uint64(_CELLS - 1)).astype(np.int64)], row))
            at = np.concatenate([[0], np.cumsum(size)])
            keep = np.arange(len(g)) - at[row] < (size - _behind(size, least))[row]
            g, row = g[order][keep], row[keep]
            bucket = (g % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            g, row = (g[order] // np.uint64(buckets)).astype(np.uint32), row[order]
            cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
            point, pivot = np.asarray(batch.column(0)), batch.column(2).to_numpy(zero_copy_only=False).astype(np.uint8)
            out = []
            for k in np.flatnonzero(np.diff(cut)):
                some, number = np.unique(row[cut[k] : cut[k + 1]], return_inverse=True)
                out.append((int(k), g[cut[k] : cut[k + 1]].tobytes(), number.astype(np.uint16).tobytes(), point[some].tobytes(), size[some].astype(np.int32).tobytes(), pivot[some].tobytes()))
            if out:
                kinds = (pa.int32(), *[pa.binary()] * 5)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["bucket", "tokens", "rows", "points", "sizes", "pivots"])
        tidy()

    return run


_INDEX = "bucket int, tokens binary, rows binary, points binary, sizes binary, pivots binary"


def _blocks(pdf: pd.DataFrame):
    """Tokens and the points that hold them, sorted by both; the points, their sizes and whether they are pivots."""
    lists = [np.frombuffer(x, np.int64) for x in pdf["points"]]
    at = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    every, first, number = np.unique(np.concatenate(lists), return_index=True, return_inverse=True)
    g = np.concatenate([np.frombuffer(t, np.uint32) for t in pdf["tokens"]])
    p = np.concatenate([number[a + np.frombuffer(r, np.uint16).astype(np.int64)] for a, r in zip(at, pdf["rows"])])
    order = np.lexsort((p, g))
    column = lambda name, kind: np.concatenate([np.frombuffer(x, kind) for x in pdf[name]])[first]
    return g[order], p[order], every, column("sizes", np.int32).astype(np.int64), column("pivots", np.uint8)


def _leads(pdf: pd.DataFrame) -> pd.DataFrame:
    """(point, led, shared): of each point's tokens in the bucket those that it is the least to have, and those that others have too."""
    g, p, every, _, _ = _blocks(pdf)
    start = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
    size = np.diff(np.r_[start, len(g)])
    shared = np.bincount(p[np.repeat(size > 1, size)], minlength=len(every))
    led = np.bincount(p[start[size > 1]], minlength=len(every))
    some = shared > 0
    tidy()
    return pd.DataFrame({"point": every[some], "led": led[some], "shared": shared[some]})


def _pairs(least: float, most: int = _PAIRS):
    """(pivot, point, n, required, sizes): how many tokens of the bucket a pivot and a point share, for sizes that allow a share ``least``.

    A token that m pivots and k points hold makes m * k pairs, so they are counted and handed on in pieces of ``most``, by pivot; a pair that two pieces meet has a row in each.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        g, p, every, size, pivot = _blocks(pd.concat(list(batches)))
        start = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        count = np.diff(np.r_[start, len(g)])
        block = np.repeat(np.arange(len(start)), count)
        lead = np.flatnonzero(pivot[p].astype(bool) & (count[block] > 1))
        lead = lead[np.argsort(p[lead], kind="stable")]
        a, first, total = p[lead], start[block[lead]], np.concatenate([[0], np.cumsum(count[block[lead]])])
        del g, block, lead
        for done in range(0, int(total[-1]), most):
            k = np.arange(done, min(done + most, int(total[-1])))
            which = np.searchsorted(total, k, "right") - 1
            x, y = a[which], p[first[which] + k - total[which]]
            ok = (x != y) & (np.minimum(size[x], size[y]) >= least * np.maximum(size[x], size[y]) - 1e-9)
            code, n = np.unique(x[ok] * len(every) + y[ok], return_counts=True)
            x, y = code // len(every), code % len(every)
            common = np.ceil(least / (1 + least) * (size[x] + size[y]) - 1e-9).astype(np.int64) - np.maximum(_behind(size[x], least), _behind(size[y], least))
            required = np.maximum(_required(np.minimum(size[x], size[y]), least), common)
            if len(code):
                yield pd.DataFrame({"pivot": every[x], "point": every[y], "n": n.astype(np.int32), "required": required.astype(np.int32), "sizes": (size[x] + size[y]).astype(np.int32)})
        tidy()

    return run


def common_counts(rows: list[np.ndarray], cols: list[np.ndarray]) -> np.ndarray:
    """How many n-grams each of the sets ``rows`` has in common with each of ``cols``: frequent ones by a matrix product, rare ones by pairs."""
    h, m = len(rows), len(cols)
    size = np.array([len(x) for x in rows] + [len(x) for x in cols])
    g = np.concatenate([*rows, *cols])
    order = np.argsort(g, kind="stable")
    g, owner = g[order], np.repeat(np.arange(h + m), size)[order]
    start = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
    many = np.diff(np.r_[start, len(g)])
    first = np.add.reduceat((owner < h).astype(np.int64), start)  # of the rows, which come first in each block
    second = many - first
    out = np.zeros((h, m), np.float32)
    limit = max(4.0, np.sqrt(h * m) / 16)
    dense = np.flatnonzero((first > 0) & (second > 0) & (many > limit))
    for k in range(0, len(dense), 512):
        part = dense[k : k + 512]
        a, b = np.zeros((h, len(part)), np.float32), np.zeros((m, len(part)), np.float32)
        for x, c in enumerate(part.tolist()):
            s, e = start[c], start[c] + many[c]
            a[owner[s : s + first[c]], x] = 1
            b[owner[s + first[c] : e] - h, x] = 1
        out += a @ b.T
    sparse = np.flatnonzero((first > 0) & (second > 0) & (many <= limit))
    each = first[sparse] * second[sparse]
    total, done = np.concatenate([[0], np.cumsum(each)]), 0
    flat = out.ravel()
    while done < len(sparse):
        end = max(done + 1, int(np.searchsorted(total, total[done] + (1 << 20), "right")) - 1)
        t, n = sparse[done:end], each[done:end]
        k = np.arange(n.sum()) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        s, wide = np.repeat(start[t], n), np.repeat(second[t], n)
        np.add.at(flat, owner[s + k // wide] * m + owner[s + np.repeat(first[t], n) + k % wide] - h, np.float32(1))
        done = end
    return out


def region_links(rows: list[np.ndarray], cols: list[np.ndarray], to_rows: np.ndarray, to_cols: np.ndarray, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, columns, matrix of neighbours) for pieces of a region. ``to_rows``, ``to_cols``: distances to the pivot; what lies outside a row's triangle window isn't compared with it."""
    far = 1 - similarity + 1e-9
    num = round(similarity * 1000)
    n_rows, n_cols = np.array([len(x) for x in rows]), np.array([len(x) for x in cols])
    r_order, c_order = np.argsort(to_rows, kind="stable"), np.argsort(to_cols, kind="stable")
    for k in range(0, len(rows), 256):
        r = r_order[k : k + 256]
        lo, hi = np.searchsorted(to_cols[c_order], [to_rows[r[0]] - far, to_rows[r[-1]] + far], "left")
        c = c_order[lo:hi]
        if len(c):
            common = common_counts([rows[x] for x in r], [cols[x] for x in c]).astype(np.float64)
            yield r, c, common * 1000 >= num * (n_rows[r][:, None] + n_cols[c][None, :] - common)


_FOUND = "a bigint, b bigint, covered boolean, own bigint, other bigint"


def _region(similarity: float, cover: float):
    """Rows of _FOUND: a point, whether its home covers it, its links if so, and its links to covered points of others' regions; or an edge a-b."""

    def run(table: pa.Table) -> pa.Table:
        role, point = table.column("role").to_numpy(), table.column("point").to_numpy()
        grams = _views(table.column("grams"), np.uint64)
        size = np.array([len(g) for g in grams])
        pivot = grams[int(np.flatnonzero(role & 4)[0])]
        common = np.array([np.count_nonzero(pivot[np.minimum(np.searchsorted(pivot, g), len(pivot) - 1)] == g) for g in grams])
        far = 1 - common / (size + len(pivot) - common)
        home, member = np.flatnonzero((role & 1 > 0) & (far <= cover + 1e-9)), np.flatnonzero(role & 2)
        own, other = np.zeros(len(home), np.int64), np.zeros(len(member), np.int64)
        edges: list[tuple[int, int]] = []
        # the same point, as a row and as a column, is one
        _, at = np.unique(point, return_inverse=True)
        comp = np.arange(len(point))
        for r, c, near in region_links([grams[x] for x in home], [grams[x] for x in member], far[home], far[member], similarity) if len(home) and len(member) else ():
            mine, theirs = at[home[r]], at[member[c]]
            near &= mine[:, None] != theirs[None, :]
            own[r] += near.sum(axis=1)
            other[c] += near.sum(axis=0)
            for i in np.flatnonzero(near.any(axis=1)).tolist():
                which = theirs[near[i]]
                for y in which[np.unique(comp[which], return_index=True)[1]].tolist() if len(which) > 1 else which.tolist():
                    if comp[y] != comp[mine[i]]:
                        edges.append((mine[i], y))
                        comp[comp == comp[y]] = comp[mine[i]]
        name = np.zeros(len(point), np.int64)
        name[at] = point
        more = other > 0
        n_home, n_more, n_edges = len(home), int(more.sum()), len(edges)
        e = np.array(edges, np.int64).reshape(-1, 2)
        none = np.zeros(n_home + n_more, np.int64)
        return pa.table({
            "a": pa.array(np.concatenate([point[home], point[member][more], name[e[:, 0]]])),
            "b": pa.array(np.concatenate([none, name[e[:, 1]]]), mask=np.arange(n_home + n_more + n_edges) < n_home + n_more),
            "covered": pa.array(np.arange(n_home + n_more + n_edges) < n_home),
            "own": pa.array(np.concatenate([own, np.zeros(n_more + n_edges, np.int64)])),
            "other": pa.array(np.concatenate([np.zeros(n_home, np.int64), other[more], np.zeros(n_edges, np.int64)])),
        })

    return run


def components(edges: DataFrame) -> DataFrame:
    """(point, label): the least point of its component, for every point of an edge."""
    ways = F.explode(F.array(F.struct(F.col("a").alias("v"), F.col("b").alias("u")), F.struct(F.col("b").alias("v"), F.col("a").alias("u"))))
    both = checkpoint(edges.select(ways.alias("e")).select("e.v", "e.u").distinct())
    label = checkpoint(both.groupBy("v").agg(F.least(F.min("u"), F.first("v")).alias("label")))
    while True:
        near = both.join(label.select(F.col("v").alias("u"), "label"), "u").groupBy("v").agg(F.min("label").alias("near"))
        step = label.join(near, "v").select("v", F.least("label", "near").alias("to"), "label")
        # pointer jumping: the label of the label
        jump = step.join(label.select(F.col("v").alias("to"), F.col("label").alias("further")), "to").select("v", F.least("to", "further").alias("label"), (F.least("to", "further") != F.col("label")).alias("moved"))
        jump = checkpoint(jump)
        label = jump.select("v", "label")
        if jump.where("moved").isEmpty():
            return label.withColumnRenamed("v", "point")


def _tasks(place: DataFrame, points: DataFrame) -> DataFrame:
    """(pivot, i, j, point, role): the pairs of blocks of each region, and who goes where: 1 as one at home, 2 as a member, 4 as the pivot."""
    sized = place.join(points.select("point", "size"), "point")
    blocks = F.greatest(F.ceil(F.count("*") / _BLOCK), F.ceil(F.sum("size") / _BLOCK_GRAMS)).cast("int")
    large = sized.groupBy("pivot").agg(blocks.alias("k")).where("k > 1")
    k = F.coalesce("k", F.lit(1))
    d = place.join(large, "pivot", "left").withColumn("k", k).withColumn("at", F.pmod(F.xxhash64("point"), F.col("k")).cast("int"))
    grid = F.sequence(F.lit(0), F.col("k") - 1)
    cell = lambda i, j: F.struct(
        i.alias("i"), j.alias("j"), (F.when(F.col("home") & (i == F.col("at")), 1).otherwise(0) + F.when(j == F.col("at"), 2).otherwise(0) + F.when(F.col("pivot") == F.col("point"), 4).otherwise(0)).alias("role")
    )
    every = F.flatten(F.transform(grid, lambda i: F.transform(grid, lambda j: cell(i, j))))
    cross = F.concat(F.transform(grid, lambda j: cell(F.col("at"), j)), F.transform(F.filter(grid, lambda i: i != F.col("at")), lambda i: cell(i, F.col("at"))))
    cells = F.when(F.col("k") == 1, F.array(cell(F.lit(0), F.lit(0)))).when(F.col("pivot") == F.col("point"), every).otherwise(cross)
    return d.select("pivot", "point", F.explode(cells).alias("c")).select("pivot", "c.i", "c.j", "point", "c.role").where("role > 0")


def point_links(points: DataFrame, similarity: float, broadcast_limit: int = 2_000_000) -> tuple[DataFrame, DataFrame]:
    """(point, links) of the points that have neighbours, and a spanning set of edges (a, b), of distinct points (point, size, grams)."""
    spark = points.sparkSession
    small = lambda d: F.broadcast(d) if d.count() <= broadcast_limit else d
    cover = max(0.0, min(COVER, similarity - 0.05))
    cells = spark.sparkContext.broadcast(sketch(points))
    buckets = partitions(points)
    rest, links, edges, rounds, apart, before = points, [], [], 0, False, 0
    while True:
        n_rest, n_grams = rest.agg(F.count("*"), F.sum("size")).first()
        if not n_rest:
            break
        # what fits into one block is joined as one region
        apart = rounds > 1 and 2 * n_rest > before
        before, reach, least = n_rest, 0.0 if apart else cover, similarity - (0.0 if apart else cover)  # least: that of a window, 1 - cover - r
        whole = rounds > 0 and n_rest <= _BLOCK and n_grams <= _BLOCK_GRAMS
        index = lambda d: d.mapInArrow(_prefixes(buckets, least, cells), _INDEX)  # noqa: B023, E731
        if whole:
            least_point = rest.agg(F.min("point")).first()[0]
            role = F.when(F.col("point") == least_point, 7).otherwise(3)
            sent, reach = rest.select("point", "grams", F.lit(least_point).alias("pivot"), F.lit(0).alias("i"), F.lit(0).alias("j"), role.alias("role")), 1.0
        else:
            led = index(rest.select("point", "grams", F.lit(False).alias("pivot"))).groupBy("bucket").applyInPandas(_leads, "point bigint, led bigint, shared bigint")
            led = led.groupBy("point").agg(F.sum("led").alias("led"), F.sum("shared").alias("shared"))
            # later rounds have fewer points, and more of them are pivots
            share = (0.5, 0.5, 0.25, 0.1)[rounds] if rounds < 4 else 0.0
            pivot = F.lit(True) if apart else (F.col("led") > 0) & (F.col("led") >= share * F.col("shared"))
            led = checkpoint(led.select("point", pivot.alias("pivot"), "shared"))
            if led.where("pivot").isEmpty():
                break
            # who shares too few with all others together has no neighbour among them
            alive = rest.join(small(led), "point").where(F.col("shared") >= F.floor(F.lit(min(_SHARED, least) * similarity) * F.col("size")))
            alive = checkpoint(alive.select("point", "size", "grams", "pivot"))
            near = index(alive.select("point", "grams", "pivot")).groupBy("bucket").applyInPandas(_pairs(least), "pivot bigint, point bigint, n int, required int, sizes int")
            near = near.groupBy("pivot", "point").agg(F.sum("n").alias("n"), F.first("required").alias("required"), F.first("sizes").alias("sizes")).where("n >= required")
            if apart:  # each pair once: the region of the lesser one counts it for both
                near = near.where("pivot < point")
            near = checkpoint(near)
            pivots = alive.where("pivot").select("point")
            best = near.groupBy("point").agg(F.min_by("pivot", F.struct(F.expr("-n / (sizes - n)"), "pivot")).alias("nearest")).join(pivots, "point", "left_anti")
            place = near.select("pivot", "point").join(best, "point", "left").select("pivot", "point", F.coalesce(F.col("pivot") == F.col("nearest"), F.lit(False)).alias("home"))
            own = near.select("pivot").distinct().select("pivot", F.col("pivot").alias("point"), F.lit(True).alias("home"))
            place = checkpoint(place.unionByName(own))
            # in a large region a place has as many rows as blocks
            tasks = checkpoint(_tasks(place, alive))
            sent = alive.select("point", "grams").join(F.broadcast(tasks) if _WIDE * tasks.count() <= broadcast_limit else tasks, "point")
        found = checkpoint(sent.groupBy("pivot", "i", "j").applyInArrow(_region(similarity, reach), _FOUND))
        edges.append(found.where("b is not null").select("a", "b"))
        each = found.where("b is null").groupBy("a").agg(F.max("covered").alias("covered"), F.sum("own").alias("own"), F.sum("other").alias("other"))
        each = checkpoint(each)
        links.append(each.select(F.col("a").alias("point"), (F.col("own") + F.col("other") if apart else F.when(F.col("covered"), F.col("own")).otherwise(F.col("other"))).alias("links")))
        if whole:
            break
        # a pivot to which nothing came has no neighbour
        gone = each.where("covered").select(F.col("a").alias("point")).union(pivots).distinct()
        rest = checkpoint(alive.join(small(gone), "point", "left_anti").select("point", "size", "grams"))
        rounds += 1
    union = lambda parts, kind: reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], kind)
    return union(links, "point bigint, links bigint").groupBy("point").agg(F.sum("links").alias("links")).where("links > 0"), union(edges, "a bigint, b bigint")


def jaccard_points(docs: DataFrame, n: int = 3, similarity: float = 0.6, broadcast_limit: int = 2_000_000) -> DataFrame:
    """(doc_id, point, class_id, links, group_id) of jaccard_groups; point is the hash of the document's set of n-grams."""
    small_batches(docs.sparkSession)
    d = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text")).where("doc_id is not null and text is not null")
    alive = checkpoint(peel(d, n, similarity))
    small = alive.count() <= broadcast_limit
    kept = d.join(F.broadcast(alive) if small else alive, "doc_id", "left_semi")
    members = checkpoint(kept.mapInArrow(_sets(n, False), "doc_id bigint, point bigint").distinct())
    first = checkpoint(members.groupBy("point").agg(F.min("doc_id").alias("doc_id")))
    # n-grams of one document of each point, made anew, which is less than keeping those of all
    ids = first.select("doc_id").distinct()
    kept = d.join(F.broadcast(ids) if small else ids, "doc_id", "left_semi")
    sets = kept.mapInArrow(_sets(n, True), "doc_id bigint, point bigint, size int, grams binary")
    points = checkpoint(sets.join(F.broadcast(first) if small else first, ["point", "doc_id"], "left_semi").select("point", "size", "grams"))
    if points.count() > first.count():  # of repeated rows one
        points = checkpoint(points.dropDuplicates(["point"]))
    links, edges = point_links(points, similarity, broadcast_limit)
    label = components(edges)
    named = members.join(first.withColumnRenamed("doc_id", "class_id"), "point").join(label, "point", "left").join(links, "point", "left")
    named = checkpoint(named.select("doc_id", "point", "class_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("links"), F.coalesce("label", "point").alias("label")))
    groups = named.groupBy("label").agg(F.min("class_id").alias("group_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    return named.join(groups, "label").select("doc_id", "point", "class_id", "links", "group_id")


def jaccard_groups(docs: DataFrame, n: int = 3, similarity: float = 0.6, broadcast_limit: int = 2_000_000) -> DataFrame:
    """(doc_id, class_id, links, group_id) of the documents that have a copy or a link.

    class_id: the least id among documents with the same set of n-grams, which are copies. links: how many other classes lie within the
    distance 1 - ``similarity``, counted exactly and without forming the pairs. group_id: the least id among those that links and copies join.

    Words are split at white space; a text of fewer than ``n`` words has one n-gram, of all of them. Null, empty and blank texts and
    null ids are left out. Ids are cast to bigint. Repeated rows (ties) are one document; an id with several texts has a row for each of
    its classes, and doesn't tie them together. Texts of any length are worked in whole. Extra columns are ignored, whatever their names. An
    empty table gives an empty result. N-grams are compared by 64 bits of a hash.
    Ids of the documents left by peeling go along by broadcast up to ``broadcast_limit`` of them, the tasks of regions up to a quarter of it, beyond that by a shuffled join.
    """
    return jaccard_points(docs, n, similarity, broadcast_limit).drop("point").distinct()


def _marked(n: int):
    """Arrow function of (text, [(point, keep)] of its id): null outside groups, else whether the document is the one that stays."""

    def run(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, own in columns:
            flag: list[bool | None] = [None] * len(texts)
            some = np.flatnonzero(np.asarray(own.is_valid()))
            if len(some):
                data, off = buffers(texts.take(pa.array(some)))
                lists = own.take(pa.array(some)).to_pylist()
                for i, j in spans(off):
                    docs, point, _, _ = point_sets(data[off[i] : off[j]], off[i : j + 1] - off[i], n)
                    for d, p in zip((docs + i).tolist(), point.tolist()):
                        flag[some[d]] = next((x["keep"] for x in lists[d] if x["point"] == p), None)
            yield pa.array(flag, pa.bool_())
        tidy()

    return arrow_udf(run, "boolean").asNondeterministic()


def drop_near_duplicates(docs: DataFrame, n: int = 3, similarity: float = 0.6, broadcast_limit: int = 2_000_000) -> DataFrame:
    """``docs`` with one document of each group of jaccard_groups, that of the least doc_id; of its repeated rows the first by their values stays.

    A text goes only for a text that it is near to by links: of an id with several texts each is judged on its own. Documents in no group
    stay as they are, also those with null ids, null, empty or blank texts, and all of their repeated rows. Texts of any length count in whole. Extra columns pass
    through, whatever their names; an empty table gives an empty result.
    """
    got = jaccard_points(docs, n, similarity, broadcast_limit)
    keep = (F.col("doc_id") == F.col("group_id")) & (F.col("doc_id") == F.col("class_id"))
    # an id may have several sets in one group: of those the least hash is its first
    first = got.groupBy("group_id").agg(F.min(F.when(keep, F.struct("doc_id", "point"))).alias("m"))
    got = got.join(first, "group_id").select("doc_id", "point", F.coalesce((F.col("m.doc_id") == F.col("doc_id")) & (F.col("m.point") == F.col("point")), F.lit(False)).alias("keep"))
    lists = checkpoint(got.distinct().groupBy("doc_id").agg(F.collect_list(F.struct("point", "keep")).alias("own")))
    small = lists.count() <= broadcast_limit
    ident, own, flag, rank = free_names(docs, 4)
    lists = lists.select(F.col("doc_id").alias(ident), F.col("own").alias(own))
    j = docs.join(F.broadcast(lists) if small else lists, docs["doc_id"].cast("bigint") == lists[ident], "left")
    # only texts of ids in groups go to Python
    text = F.when(F.col(own).isNotNull(), docs["text"].cast("string"))
    marked = j.withColumn(flag, _marked(n)(text, F.col(own))).drop(ident, own).where(f"{flag} is null or {flag}")
    # of repeated rows of one that stays the first
    order = Window.partitionBy(flag, "doc_id").orderBy("text", F.to_json(F.struct(*docs.columns)))
    stays = marked.where(flag).withColumn(rank, F.row_number().over(order)).where(f"{rank} = 1")
    return marked.where(f"{flag} is null").drop(flag).unionByName(stays.drop(flag, rank))


def jaccard_sql(n: int = 3, similarity: float = 0.6, source: str = "documents") -> str:
    """The same rows for DuckDB, by all pairs of classes that share an n-gram and a recursive closure."""
    num, den = round(similarity * 1000), 1000
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(text, '[^ \\t\\n\\r\\x0B\\f]+') AS w FROM {source} WHERE doc_id IS NOT NULL),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < {n} THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i + {n - 1}], ' ')) END) AS gram FROM w WHERE len(w) > 0),
s AS (SELECT doc_id, md5(string_agg(gram, chr(10) ORDER BY gram)) AS k FROM g GROUP BY doc_id),
m AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY k) AS class_id FROM s),
cg AS (SELECT doc_id, gram, count(*) OVER (PARTITION BY doc_id) AS n FROM g WHERE doc_id IN (SELECT class_id FROM m)),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS n FROM cg a JOIN cg b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM c WHERE n * {den} >= {num} * (na + nb - n)),
r AS (SELECT a AS class_id, a AS other FROM e UNION SELECT r.class_id, e.b FROM r JOIN e ON e.a = r.other),
x AS (SELECT m.doc_id, m.class_id, coalesce(l.links, 0) AS links, coalesce(o.group_id, m.class_id) AS group_id FROM m
  LEFT JOIN (SELECT a, count(*) AS links FROM e GROUP BY a) l ON l.a = m.class_id LEFT JOIN (SELECT class_id, min(other) AS group_id FROM r GROUP BY class_id) o ON o.class_id = m.class_id)
SELECT doc_id, class_id, links, group_id FROM x WHERE group_id IN (SELECT group_id FROM x GROUP BY group_id HAVING count(*) > 1)
"""
