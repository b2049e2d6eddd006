"""Licence scans: a generalised suffix automaton of licence tokens streams over each file.

Templates are token sequences (lower-case letters and digits). One automaton holds all their substrings; fed with a
file's tokens it gives matching statistics: for each token the length of the longest match that ends there. Long
maximal matches (``min_match`` tokens) are then chained per template, in order in both file and template, and the
chain is reported as a covered span. The automaton depends on the templates alone, so broadcasting it is bounded.

Tokens that no template has reset the automaton, so only maximal runs of known tokens are streamed, found by numpy.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Mapping, Sequence
from functools import lru_cache
from heapq import heapify, heappop, heappush
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lexmill.llm._common import buffers, small_batches, spans, tidy, words

_GNU = {"GPL": "GNU General Public License", "LGPL": "GNU Lesser General Public License", "AGPL": "GNU Affero General Public License"}
_NO_WARRANTY = "This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {1} for more details."
_CC = {"BY": [""], "BY-SA": ["ShareAlike", "Share Alike"], "BY-ND": ["NoDerivatives", "NoDerivs", "No Derivatives", "No Derivative Works"], "BY-NC": ["NonCommercial", "Non-Commercial"], "BY-NC-SA": ["NonCommercial-ShareAlike", "Non-Commercial-Share Alike", "Non-Commercial ShareAlike"], "BY-NC-ND": ["NonCommercial-NoDerivatives", "NonCommercial-NoDerivs", "Non-Commercial-No Derivatives", "Non-Commercial No Derivative Works"]}


def _notices() -> dict[str, list[tuple[str, str]]]:
    """Forms of each licence's notice, and in each the words that tell it from those of other licences and versions."""
    out: dict[str, list[tuple[str, str]]] = {
        "MIT-notice": [(f"{x} under the MIT License.", "MIT License") for x in ("Released", "Licensed", "Distributed")],
        "BSD-2-Clause-notice": [(f"Licensed under the {x}", x) for x in ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License")],
        "BSD-3-Clause-notice": [(f"Licensed under the {x}", x) for x in ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License")],
        "ISC-notice": [("Licensed under the ISC License.", "ISC License")],
        "Unlicense-notice": [("Released into the public domain under the Unlicense.", "the Unlicense")],
        "CC0-1.0-notice": [("Licensed under CC0 1.0 Universal.", "CC0 1.0"), ("Creative Commons CC0 1.0 Universal Public Domain Dedication", "CC0 1.0")],
        "Apache-2.0-notice": [(f"Licensed under the {x}", x) for x in ("Apache License, Version 2.0.", "Apache License 2.0", "Apache License v2.0", "Apache 2.0 License")],
        "Apache-1.1-notice": [(f"Licensed under the {x}", x) for x in ("Apache License, Version 1.1.", "Apache Software License, Version 1.1")],
        "MPL-2.0-header": [("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.", "Mozilla Public License, v. 2.0")],
    }
    for v in ("1.1", "2.0"):
        out[f"MPL-{v}-notice"] = [(f"Licensed under the {x}", x) for x in (f"Mozilla Public License, version {v}", f"Mozilla Public License {v}", f"Mozilla Public License v{v}")]
    for short, v in (("GPL", "1"), ("GPL", "2"), ("GPL", "3"), ("LGPL", "2"), ("LGPL", "2.1"), ("LGPL", "3"), ("AGPL", "3")):
        whole, name = _GNU[short] if (short, v) != ("LGPL", "2") else "GNU Library General Public License", f"{short}-{v if '.' in v else v + '.0'}"
        keys = [f"{whole}, version {v}", f"{whole} v{v}", f"{whole} {v}", f"version {v} of the {whole}", f"GNU {short} version {v}", f"GNU {short} v{v}"]
        out[f"{name}-notice"] = [(f"{at} under the {k}.", k) for k in keys for at in ("This work is licensed", "Licensed")]
        what = "library" if whole != _GNU["GPL"] and short == "LGPL" else "program"
        for version in (f"either version {v} of the License, or (at your option) any later version", f"version {v} of the License", f"version {v}"):
            key = f"{whole} as published by the Free Software Foundation, {version}"
            out.setdefault(f"{name}-header", []).append((f"This {what} is free software: you can redistribute it and/or modify it under the terms of the {key}. " + _NO_WARRANTY.format(what, whole), key))
    for form, spelled in _CC.items():
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            kind = "International" if v == "4.0" else "Unported" if v == "3.0" else "Generic"
            keys = [f"Creative Commons Attribution {x} {v}" for x in spelled]
            out[f"CC-{form}-{v}-notice"] = [(f"{at}{k} {kind} License", k) for k in keys for at in ("This work is licensed under a ", "")] + [(f"Licensed under CC {form} {v}.", f"CC {form} {v}")]
    return out


_TEXTS = {p.stem: p.read_text("utf-8") for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}
#: Template texts by name. Whole texts end in -text where the plain name is that of the licence's file header.
TEMPLATES: dict[str, str | list[str]] = {k: [t for t, _ in x] for k, x in _notices().items()} | {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
} | {f"{k}-text" if k == "Apache-2.0" else k: [t, t.partition("THE SOFTWARE IS PROVIDED")[0]] if k in ("MIT", "ISC") else t for k, t in _TEXTS.items()}
#: Words of which those of one form have to stand together in a match, by template.
KEYS: dict[str, list[str]] = {k: [key for _, key in x] for k, x in _notices().items()} | {
    "Apache-2.0": ["Apache License, Version 2.0"],
    "BSD-3-Clause": ["endorse or promote products derived from this software without specific prior written permission"],
    "GPL-3.0": ["13. Use with the GNU Affero General Public License"],
    "AGPL-3.0": ["13. Remote Network Interaction; Use with the GNU General Public License"],
    "MPL-1.1": ["Mozilla Public License Version 1.1"],
    "GFDL-1.2": ["GNU Free Documentation License Version 1.2, November 2002"],
    "GFDL-1.3": ["GNU Free Documentation License Version 1.3, 3 November 2008"],
}
_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_FOLD = np.arange(256)
_FOLD[65:91] += 32
_FOLDED = None
SCHEMA = "doc_id bigint, license string, start_char bigint, end_char bigint, template_start int, template_end int, matched int, coverage_permille int, matches int"


def _folded() -> np.ndarray:
    global _FOLDED
    if _FOLDED is None:
        from lexmill.llm._common import R

        _FOLDED = R[_FOLD]
    return _FOLDED


def tokens(text: str) -> list[int]:
    b = np.frombuffer(text.encode(), np.uint8)
    return words(b, np.zeros(1, np.int64), _LETTER, _folded())[2].tolist()


class SuffixAutomaton:
    """Generalised suffix automaton over several token sequences; ``ends`` lists (sequence, end) of each state's substrings."""

    def __init__(self, sequences: list[list[int]]):
        self.sequences = sequences
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.ends = [-1], [0], [[]]
        for k, seq in enumerate(sequences):
            at = 0
            for i, t in enumerate(seq):
                at = self._extend(at, t)
                self.ends[at].append((k, i + 1))
        for s in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            self.ends[self.link[s]].extend(self.ends[s])
        self.ends = [sorted(set(e)) for e in self.ends]
        self.ends[0] = []

    def _state(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        self.ends.append([])
        return len(self.link) - 1

    def _split(self, p: int, q: int, t: int) -> int:
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(t) == q:
            self.next[p][t] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, t: int) -> int:
        q = self.next[last].get(t)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, t)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and t not in self.next[p]:
            self.next[p][t] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][t]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, t)
        return new

    def statistics(self, seq: list[int]) -> Iterator[tuple[int, int]]:
        """(length of the longest substring of any sequence that ends here, its state), for each token."""
        s = n = 0
        for t in seq:
            while s and t not in self.next[s]:
                s = self.link[s]
                n = self.length[s]
            if t in self.next[s]:
                s = self.next[s][t]
                n += 1
            yield n, s


def maximal_matches(auto: SuffixAutomaton, seq: list[int], least: int) -> list[tuple[int, int, int, int]]:
    """(template, file start, template start, length) of each template's matches that can be made longer on neither side."""
    out = []
    for i, (n, s) in enumerate(auto.statistics(seq)):
        after, seen = seq[i + 1] if i + 1 < len(seq) else None, set()
        # what only shorter suffixes match is found along the links
        while n >= least:
            for k, end in auto.ends[s]:
                if (k, end) not in seen:
                    seen.add((k, end))
                    if end == len(auto.sequences[k]) or auto.sequences[k][end] != after:
                        out.append((k, i + 1 - n, end - n, n))
            s = auto.link[s]
            n = auto.length[s]
    return out


def chains(matches: list[tuple[int, int, int, int]], gap: int) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """(template, [(file start, template start, length)]): matches of a template in order on both sides, at most ``gap`` tokens
    apart in the file, chosen from the heaviest chain on until no match is left that overlaps no chosen chain of its template.

    A chain runs through its template once, so what a match can continue lies within the template's length and gaps before it, and taking a chain
    out changes the chains of the matches next to it alone.
    """
    out = []
    by: dict[int, list[tuple[int, int, int]]] = {}
    for k, *m in matches:
        by.setdefault(k, []).append(tuple(m))
    for k in sorted(by):
        rest = sorted(by[k])
        starts = [m[0] for m in rest]
        longest = max(m[2] for m in rest)
        span = max(m[1] + m[2] for m in rest)
        reach = span * (1 + gap) + gap
        best, prev, gone = [m[2] for m in rest], [-1] * len(rest), [False] * len(rest)

        def weigh(i: int) -> None:
            f, t, n = rest[i]  # noqa: B023
            best[i], prev[i] = n, -1  # noqa: B023
            for j in range(i - 1, bisect_left(starts, f - gap - longest) - 1, -1):  # noqa: B023
                fj, tj, nj = rest[j]  # noqa: B023
                if not gone[j] and fj + nj <= f and tj + nj <= t and f - fj - nj <= gap and best[j] + n > best[i]:  # noqa: B023
                    best[i], prev[i] = best[j] + n, j  # noqa: B023

        for i in range(len(rest)):
            weigh(i)
        heap = [(-best[i], i) for i in range(len(rest))]
        heapify(heap)
        while heap:
            w, i = heappop(heap)
            if gone[i] or -w != best[i]:
                continue
            chain = []
            while i >= 0:
                chain.append(rest[i])
                i = prev[i]
            chain.reverse()
            lo, hi = chain[0][0], chain[-1][0] + chain[-1][2]
            out.append((k, chain))
            for i in range(bisect_left(starts, lo - longest), bisect_left(starts, hi)):
                gone[i] = gone[i] or rest[i][0] + rest[i][2] > lo
            for i in range(bisect_left(starts, hi), bisect_left(starts, hi + reach)):
                if not gone[i]:
                    was = best[i]
                    weigh(i)
                    if best[i] != was:
                        heappush(heap, (-best[i], i))
    return out


@lru_cache(2)
def _automaton(sequences: tuple[tuple[int, ...], ...]) -> SuffixAutomaton:
    return SuffixAutomaton(sequences)


def key_spans(seq: Sequence[int], keys: list[Sequence[int]]) -> list[tuple[int, int]]:
    """Where the keys stand in a template."""
    return [(i, i + len(k)) for k in keys for i in range(len(seq) - len(k) + 1) if tuple(seq[i : i + len(k)]) == tuple(k)]


def scan_tokens(auto: SuffixAutomaton, sizes: list[int], seq: list[int], least: int, gap: int, coverage: int, keys: Mapping[int, list[tuple[int, int]]] | None = None):
    """(template, first token, end token, template start, template end, matched, per mille, matches) of a token sequence.

    ``keys``: template spans of which a chain must hold one in a single match. Of chains on the same tokens that with
    the most tokens stays, so that a whole text goes before the notice in it; then the greatest coverage.
    """
    found, matches, total, held = [], maximal_matches(auto, seq, least), {}, set()
    for k, _, t, m in matches:
        total[k] = total.get(k, 0) + m
        if not keys or k not in keys or any(t <= a and z <= t + m for a, z in keys[k]):
            held.add(k)
    # no chain of the others can be long enough, or hold a key
    matches = [m for m in matches if m[0] in held and total[m[0]] * 1000 >= coverage * sizes[m[0]]]
    for k, chain in chains(matches, gap):
        n = sum(c[2] for c in chain)
        if n * 1000 >= coverage * sizes[k] and (not keys or k not in keys or any(t <= a and z <= t + m for _, t, m in chain for a, z in keys[k])):
            found.append((k, chain[0][0], chain[-1][0] + chain[-1][2], chain[0][1], chain[-1][1] + chain[-1][2], n, n * 1000 // sizes[k], len(chain)))
    found.sort(key=lambda x: (-x[5], -x[6], x[0], x[1]))
    kept = []
    for x in found:
        if all(x[2] <= y[1] or x[1] >= y[2] for y in kept):
            kept.append(x)
    return sorted(kept, key=lambda x: (x[1], x[0]))


def scan_licenses(docs: DataFrame, templates: Mapping[str, str | list[str]] | None = None, min_match: int = 4, max_gap: int = 8, min_coverage: int = 600) -> DataFrame:
    """SCHEMA: spans of each whole text that cover at least ``min_coverage`` per mille of a licence template.

    start_char and end_char are character offsets into the text, template_start and template_end are tokens. A text
    may hold several spans; of overlapping ones that with the most tokens stays (then the greatest coverage, then the
    earliest template). A template may have several forms. The words in KEYS, name and version as a rule, have to stand
    together: a gap inside them is no match, so that other versions and kinds of a licence aren't taken for it. Null and empty texts and those without licences give no row; texts of any length are streamed in whole. Templates of fewer tokens
    than ``min_match`` match never. Repeated rows give repeated results, null ids are kept, extra columns are
    ignored whatever their names. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    known_keys = KEYS if templates is None else {}
    forms = [(k, f) for k, t in (TEMPLATES if templates is None else templates).items() for f in ([t] if isinstance(t, str) else t)]
    names, seqs = [k for k, _ in forms], tuple(tuple(tokens(t)) for _, t in forms)
    keys = {i: key_spans(seqs[i], [tokens(x) for x in known_keys[k]]) for i, k in enumerate(names) if k in known_keys}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto, sizes = _automaton(seqs), [len(s) for s in seqs]
        known = np.unique(np.array([t for s in seqs for t in s], np.uint64))
        # a filter by 16 bits, before the search
        low = np.zeros(1 << 16, bool)
        low[known & np.uint64(0xFFFF)] = True
        for batch in batches:
            data, off = buffers(batch.column(1))
            ids, rows = batch.column(0), []
            for i, j in spans(off):
                b = data[off[i] : off[j]]
                docs_at = off[i : j + 1] - off[i]
                s, e, h = words(b, docs_at, _LETTER, _folded())
                if not len(h) or not len(known):
                    continue
                hit = low[h & np.uint64(0xFFFF)]
                at = np.flatnonzero(hit)
                at = at[known[np.minimum(np.searchsorted(known, h[at]), len(known) - 1)] == h[at]]
                if not len(at):
                    continue
                doc = np.searchsorted(docs_at, s[at], "right") - 1
                # runs of known tokens; a run too short for a match only breaks a chain by its distance
                edge = np.flatnonzero(np.r_[True, (np.diff(at) > 1) | (np.diff(doc) > 0), True])
                long = np.diff(edge) >= min_match
                by_doc: dict[int, list[tuple[int, int]]] = {}
                for x, y in zip(edge[:-1][long].tolist(), edge[1:][long].tolist()):
                    by_doc.setdefault(int(doc[x]), []).append((int(at[x]), int(at[y - 1]) + 1))
                for d, runs in by_doc.items():
                    seq: list[int] = []
                    where: list[int] = []
                    for x, y in runs:
                        if where and x > where[-1] + 1:  # a stand-in for the unknown tokens between two runs
                            fill = min(x - where[-1] - 1, max_gap + 1)
                            seq += [-1] * fill
                            where += [where[-1]] * fill
                        seq += h[x:y].tolist()
                        where += range(x, y)
                    for k, a, z, ta, tz, n, share, m in scan_tokens(auto, sizes, seq, min_match, max_gap, min_coverage, keys):
                        base, sa, ez = int(docs_at[d]), int(s[where[a]]), int(e[where[z - 1]])
                        chars = lambda p: int(((b[base:p] & 0xC0) != 0x80).sum())  # noqa: B023, E731
                        rows.append((i + d, names[k], chars(sa), chars(ez), ta, tz, n, share, m))
            if rows:
                c = list(zip(*rows))
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(c[0])), *[pa.array(x, t) for x, t in zip(c[1:], kinds)]], [f.split()[0] for f in SCHEMA.split(", ")])

    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(run, SCHEMA)
