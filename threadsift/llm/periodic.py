"""Periodic runs of words by a difference-cover index (operator 13).

A run is a stretch of words with smallest period q, of ``max(6, 4 * q)`` words or more, that no
neighbouring word extends.  Runs are found from longest common extensions (LCE) of two places.

``Lce`` sorts only the suffixes that begin at places of a difference cover: for any two places some
shift below ``V`` brings both onto it.  So a query compares at most ``V`` words and then reads the rest
from a sparse table of minima over the sorted samples' common prefixes.  A second index over the
reversed words extends to the left.

A run of period q covers, for at least one multiple i of 3q, both i and i + q; so the places 0, 3q, 6q, ...
of every q (a harmonic number of them in all) find every run, each with its smallest period, as a
multiple of that period gives the same stretch again.

Words are told apart by two independent 64-bit hashes.  Documents of a slice share one index; a word
that occurs once stands between two documents, and nothing extends across it.

Defined cases: a null text has no words; a text without runs has nulls for the longest run and the
digest of nothing for its runs; a row without doc_id is never rewritten; repeated rows get equal results;
an empty table gives an empty result; a very long text is a slice of its own, in memory in proportion
to it; extra columns are left out by name.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsift.llm.text import column_bytes, slices, span_hashes, word_spans

#: a perfect difference set: every distance below V occurs between two of these modulo V
V = 31
COVER = np.array([0, 1, 3, 8, 12, 18])
_RANK = np.full(V, -1)
_RANK[COVER] = np.arange(COVER.size)
#: least shift that brings two residues onto the cover together
_SHIFT = np.array([[next(d for d in range(V) if _RANK[(i + d) % V] >= 0 and _RANK[(j + d) % V] >= 0) for j in range(V)] for i in range(V)])
MIN_WORDS, MIN_POWER = 6, 4
SLICE = 1 << 19
GRID = 1 << 20  # places looked at together


class Lce:
    """Longest common extensions over an array of word numbers whose last one occurs once."""

    def __init__(self, words: np.ndarray):
        self.n = words.size
        self.words = np.r_[words.astype(np.int64) + 1, np.zeros(V, np.int64)]

    def _sample(self, at: np.ndarray) -> np.ndarray:
        return at // V * COVER.size + _RANK[at % V]

    @cached_property
    def _sorted(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """(rank of every sample, sparse table of the common prefixes of neighbours in that order)."""
        at = np.arange(-(-self.n // V))[:, None] * V + COVER
        at = at.ravel()[:int((at < self.n).sum())]
        # by the first V words, two to a key
        w = self.words
        two = w[:-1] << 32 | w[1:]
        keys = [two[at + k] for k in range(0, V - 1, 2)] + [w[at + V - 1]]
        order = np.lexsort(keys[::-1])
        new = np.zeros(at.size, bool)
        for key in keys:
            new[1:] |= key[order[1:]] != key[order[:-1]]
        del keys, two
        rank = np.empty(at.size, np.int64)
        rank[order] = np.cumsum(new)
        ranks, step = [rank], V
        while rank.max(initial=0) + 1 < at.size:  # twice the words: a sample moved by a multiple of V is a sample
            after = np.minimum(at + step, self.n - 1)
            ahead = np.where(at + step < self.n, rank[self._sample(np.where(at + step < self.n, after, at))], 0)
            rank = np.unique(rank * (at.size + 1) + ahead, return_inverse=True)[1]
            ranks.append(rank)
            step *= 2
        order = np.argsort(rank)
        a, b = at[order[:-1]], at[order[1:]]
        size = np.zeros(a.size, np.int64)
        for r in reversed(ranks[:-1]):
            step //= 2
            same = r[self._sample(a + size)] == r[self._sample(b + size)]
            size += np.where(same, step, 0)
        size += self._direct(a + size, b + size, np.full(a.size, V))
        table, reach = [size], 1
        while 2 * reach <= size.size:
            table.append(np.minimum(table[-1][:-reach], table[-1][reach:]))
            reach *= 2
        return rank, table

    def _direct(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from i and j on, at most ``most`` (V at the highest)."""
        out = np.zeros(i.size, np.int64)
        go = np.arange(i.size)
        for k in range(V):
            go = go[(most[go] > k)]
            go = go[self.words[i[go] + k] == self.words[j[go] + k]]
            if not go.size:
                break
            out[go] += 1
        return out

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal words from place i and from place j on (i and j differ)."""
        shift = _SHIFT[i % V, j % V]
        out = self._direct(i, j, shift)
        far = np.flatnonzero(out == shift)
        if far.size:
            rank, table = self._sorted
            a, b = rank[self._sample(i[far] + shift[far])], rank[self._sample(j[far] + shift[far])]
            lo, hi = np.minimum(a, b), np.maximum(a, b)
            level = np.frexp((hi - lo).astype(float))[1] - 1
            for k in np.unique(level):
                at = np.flatnonzero(level == k)
                t = table[k]
                out[far[at]] += np.minimum(t[lo[at]], t[hi[at] - (1 << int(k))])
        return out


def runs(words: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of every run by start and period, over an array of word numbers whose first
    and last occur once; no run is longer than ``longest`` words."""
    n = words.size
    right, left = Lce(words), Lce(words[::-1])
    found = []
    lo, top = 1, longest // MIN_POWER
    while lo <= top:
        # as many periods as make about GRID places
        q = np.arange(lo, min(top, lo + max(1, GRID // max(1, n // (3 * lo)))) + 1)
        many = np.maximum(0, -(-(n - q) // (3 * q)))
        lo = int(q[-1]) + 1
        period = np.repeat(q, many)
        i = (np.arange(period.size) - np.repeat(np.cumsum(many) - many, many)) * 3 * period
        same = np.flatnonzero(words[i] == words[i + period])
        i, period = i[same], period[same]
        end = i + period + right(i, i + period)
        start = i - left(n - i, n - i - period)
        long = np.flatnonzero(end - start >= np.maximum(MIN_WORDS, MIN_POWER * period))
        found.append(np.stack([start[long], end[long], period[long]]))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    s, e, q = np.concatenate(found, 1)
    order = np.lexsort((q, e, s))
    s, e, q = s[order], e[order], q[order]
    first = np.ones(s.size, bool)
    first[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])  # the smallest period of a stretch
    s, e, q = s[first], e[first], q[first]
    order = np.lexsort((q, s))
    return s[order], e[order], q[order]


def _numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The number of each word: equal words have equal numbers."""
    h, g = (span_hashes(data, starts, ends, salt=k) for k in (0, 1))
    _, first, code = np.unique(h, return_index=True, return_inverse=True)
    if (g[first][code] != g).any():
        order = np.lexsort((g, h))
        new = np.zeros(h.size, bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1])
        code = np.empty(h.size, np.int64)
        code[order] = np.cumsum(new)
    return code


def rewritten(n: int, doc_id: int | None) -> np.ndarray:
    """Which word stands at each place: for a tenth of the documents (by the CRC-32 of doc_id) a tail of the
    text becomes repeats of its first words."""
    at = np.arange(n)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        at[a:] = a + (at[a:] - a) % p
    return at


def _slice_runs(ids: list, data: np.ndarray, offs: np.ndarray, rewrite: bool) -> list[tuple]:
    starts, ends, rows = word_spans(data, offs)
    edge = np.searchsorted(rows, np.arange(offs.size))
    size = np.diff(edge)
    number = _numbers(data, starts, ends) if starts.size else np.zeros(0, np.int64)
    source = np.concatenate([a + (rewritten(int(n), d) if rewrite else np.arange(n)) for a, n, d in zip(edge, size, ids)])
    # a number of its own before each document and after the last
    base = edge[:-1] + np.arange(size.size) + 1  # where each document begins
    words = number.max(initial=0) + 1 + np.arange(source.size + size.size + 1)
    words[np.arange(source.size) + np.repeat(np.arange(size.size), size) + 1] = number[source]
    s, e, q = runs(words, int(size.max(initial=0)))
    own = np.searchsorted(base, s, "right") - 1
    cut = np.searchsorted(own, np.arange(size.size + 1))
    drop = np.zeros(words.size + 1, np.int64)
    np.add.at(drop, s + q, 1)
    np.add.at(drop, e, -1)
    keep = np.flatnonzero((np.cumsum(drop)[:-1] == 0)[np.arange(source.size) + np.repeat(np.arange(size.size), size) + 1])
    # kept words with a blank after each
    a, b = starts[source[keep]], ends[source[keep]]
    lens = b - a + 1
    total = np.r_[0, np.cumsum(lens)]
    at = np.arange(int(total[-1])) - np.repeat(total[:-1] - a, lens)
    flat = data[np.minimum(at, max(0, data.size - 1))]
    flat[total[1:] - 1] = 0x20
    split = total[np.searchsorted(keep, edge)]
    out = []
    for d, doc in enumerate(ids):
        x, y = cut[d], cut[d + 1]
        start, length, period = (s[x:y] - base[d]).tolist(), (e[x:y] - s[x:y]).tolist(), q[x:y].tolist()
        listed = "".join(f"{i},{n},{p}\n" for i, n, p in zip(start, length, period))
        top = min(zip([-n for n in length], start, period), default=None)
        best = (None,) * 4 if top is None else (top[1], -top[0], top[2], -1000 * top[0] // top[2])
        out.append((doc, y - x, *best, hashlib.sha256(listed.encode()).hexdigest(), flat[split[d]:max(split[d], split[d + 1] - 1)].tobytes(), listed))
    return out


def scan(docs: DataFrame, rewrite: bool = False) -> DataFrame:
    """One row per document: doc_id, n_runs, the longest run (start, length, period, exponent_milli),
    runs (``start,length,period`` lines), runs_sha256, collapsed (the text without repeats of runs),
    collapsed_sha256."""
    return _run(docs, rewrite, True)


def digest(docs: DataFrame) -> DataFrame:
    """As ``scan``, over the rewritten texts, without the runs and texts themselves."""
    return _run(docs, True, False)


def _run(docs, rewrite, whole):
    schema = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
              + ("runs string, " if whole else "") + "runs_sha256 string, " + ("collapsed string, " if whole else "") + "collapsed_sha256 string")
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        for b in batches:
            data, offs = column_bytes(b.column(1))
            rows = [r for i, j, d, o in slices(data, offs, SLICE) for r in _slice_runs(b.column(0).slice(i, j - i).to_pylist(), d, o, rewrite)]
            cols = [pa.array([r[c] for r in rows], pa.int64()) for c in range(6)]
            cols += [pa.array([r[8] for r in rows], pa.string())] if whole else []
            cols += [pa.array([r[6] for r in rows], pa.string())]
            cols += [pa.array([r[7].decode() for r in rows], pa.string())] if whole else []
            cols += [pa.array([hashlib.sha256(r[7]).hexdigest() for r in rows], pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
