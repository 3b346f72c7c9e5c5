"""Byte-level BPE encoding and decoding over rank files (operator 2).

Texts are cut by the pattern; distinct pieces are encoded once per worker (a memory of at most
``REMEMBER`` bytes) and their ids gathered back with numpy.  Pieces are laid by length into padded
id matrices.  In each round every row merges its leftmost pair of minimum rank; pair ranks come
from an open-addressing hash table in numpy arrays; finished rows and freed columns are compacted
away.  The rounds of a row of n bytes cost n * n, so a piece longer than ``LONG`` bytes (a run of that
many letters without a blank) goes alone with the same merges from a heap, in n * log n.

Decoding gathers each id's bytes from one table.

Defined cases: a null text is empty and has no ids; rows are independent, so repeated rows repeat; an
empty table gives an empty result; a very long text is encoded whole, in memory in proportion to it;
columns outside ``carry`` are left out by name, and a carried one may not be named as a result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cached_property, lru_cache, partial
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsift.llm.text import column_bytes, lean, slices, span_hashes

LONG = 256
REMEMBER = 32 << 20  # bytes
INF = np.int32(np.iinfo(np.int32).max)
_H = np.uint64(0x9E3779B97F4A7C15)


class Ranks:
    """A rank file as numpy tables: token bytes, and a hash table from id pairs to merged ids.

    Built once, on the driver; the arrays (some MB) travel with the tasks, and only the look-up of
    whole tokens is made anew from them in a worker.
    """

    def __init__(self, blob: bytes):
        ids = {base64.b64decode(t): int(r) for t, r in (line.split() for line in blob.splitlines() if line.strip())}
        n = max(ids.values()) + 1
        by_id = [b""] * n
        for t, r in ids.items():
            by_id[r] = t
        self.lens = np.array([len(t) for t in by_id], np.int32)
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.single = np.array([ids[bytes([i])] for i in range(256)], np.int32)
        left, right, merged = [], [], []
        for t, r in ids.items():
            for k in range(1, len(t)):
                a = ids.get(t[:k])
                b = ids.get(t[k:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(r)
        self._build(np.array(left, np.uint64), np.array(right, np.uint64), np.array(merged, np.int32))

    @cached_property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.lens, dtype=np.int64) - self.lens

    @cached_property
    def ids(self) -> dict[bytes, int]:
        raw = self.bytes.tobytes()
        return {raw[a:a + n]: i for i, (a, n) in enumerate(zip(self.starts.tolist(), self.lens.tolist())) if n}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("starts", "ids")}

    def _build(self, a, b, r):
        bits = max(8, int(np.ceil(np.log2(max(1, a.size) * 4))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.vals = np.full(1 << bits, INF, np.int32)
        key = ((a << np.uint64(32)) | b).astype(np.int64)
        slot = ((key.astype(np.uint64) * _H) >> self.shift).astype(np.int64)
        todo = np.arange(key.size)
        while todo.size:
            free = self.keys[slot[todo]] < 0
            cand = todo[free]
            _, first = np.unique(slot[cand], return_index=True)
            won = cand[first]
            self.keys[slot[won]], self.vals[slot[won]] = key[won], r[won]
            left = np.ones(key.size, bool)
            left[won] = False
            todo = todo[left[todo]]
            taken = self.keys[slot[todo]] >= 0
            slot[todo[taken]] = (slot[todo[taken]] + 1) & self.mask

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair (any shape); INF where the pair does not merge or has padding (-1)."""
        shape = a.shape
        a, b = a.ravel().astype(np.int64), b.ravel().astype(np.int64)
        key = (a << 32) | b
        out = np.full(key.size, INF, np.int32)
        todo = np.flatnonzero((a >= 0) & (b >= 0))
        k = key[todo]
        slot = ((k.astype(np.uint64) * _H) >> self.shift).astype(np.int64)
        while todo.size:
            at = self.keys[slot]
            hit = at == k
            out[todo[hit]] = self.vals[slot[hit]]
            go = ~hit & (at >= 0)
            todo, k, slot = todo[go], k[go], (slot[go] + 1) & self.mask
        return out.reshape(shape)

    def _rows(self, m: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Merge every row of a padded matrix; yields (row numbers, finished id rows)."""
        rows = np.arange(m.shape[0])
        r = self.pair(m[:, :-1], m[:, 1:])
        while rows.size:
            if r.shape[1] == 0:
                yield rows, m
                return
            p = r.argmin(1)
            best = r[np.arange(rows.size), p]
            done = best == INF
            if done.any():
                yield rows[done], m[done]
                go = ~done
                rows, m, r, p, best = rows[go], m[go], r[go], p[go], best[go]
                if not rows.size:
                    return
            k, w = np.arange(rows.size), m.shape[1]
            m[k, p] = best
            keep = np.ones(m.shape, bool)
            keep[k, p + 1] = False
            m = m[keep].reshape(rows.size, w - 1)
            keep = np.ones(r.shape, bool)
            keep[k, p] = False
            r = r[keep].reshape(rows.size, w - 2)
            x = np.flatnonzero(p > 0)
            r[x, p[x] - 1] = self.pair(m[x, p[x] - 1], m[x, p[x]])
            x = np.flatnonzero(p < w - 2)
            r[x, p[x]] = self.pair(m[x, p[x]], m[x, p[x] + 1])

    def _rank(self, a: int, b: int) -> int:
        """Rank of one pair, as ``pair`` gives it."""
        key = a << 32 | b
        slot = (key * int(_H) & 0xFFFFFFFFFFFFFFFF) >> int(self.shift)
        while (at := int(self.keys[slot])) >= 0:
            if at == key:
                return int(self.vals[slot])
            slot = slot + 1 & self.mask
        return int(INF)

    def _alone(self, ids: np.ndarray) -> np.ndarray:
        """One long piece: the same merges, least rank first and leftmost among equals, from a heap
        of pairs over linked places."""
        n = ids.size
        r = self.pair(ids[:-1], ids[1:])
        at = np.flatnonzero(r < INF)
        heap = list(zip(r[at].tolist(), at.tolist()))
        heapify(heap)
        tok, rank = ids.tolist(), [*r.tolist(), int(INF)]
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        while heap:
            best, i = heappop(heap)
            if tok[i] < 0 or rank[i] != best:
                continue  # merged away, or paired anew since
            gone = after[i]
            tok[i], tok[gone] = best, -1
            after[i] = end = after[gone]
            if end < n:
                before[end] = i
            for x, y in ((before[i], i), (i, end)):
                if x >= 0:
                    rank[x] = self._rank(tok[x], tok[y]) if y < n else int(INF)
                    if rank[x] < INF:
                        heappush(heap, (rank[x], x))
        out = np.array(tok, np.int32)
        return out[out >= 0]

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in a row, number of ids of each)."""
        n = len(pieces)
        whole = np.fromiter((self.ids.get(p, -1) for p in pieces), np.int64, n)
        size = np.fromiter(map(len, pieces), np.int64, n)
        begin = np.cumsum(size) - size
        data = np.frombuffer(b"".join(pieces), np.uint8)
        count = np.where(whole >= 0, 1, 0)
        parts = [(np.flatnonzero(whole >= 0), whole[whole >= 0][:, None].astype(np.int32))]
        open_ = whole < 0
        lo, width = 0, 8
        while lo < LONG:
            rows = np.flatnonzero(open_ & (size > lo) & (size <= width))
            if rows.size:
                col = np.arange(width)
                inside = col < size[rows][:, None]
                m = np.full(inside.shape, -1, np.int32)
                m[inside] = self.single[data[(begin[rows][:, None] + col)[inside]]]
                for k, done in self._rows(m):
                    parts.append((rows[k], done))
            lo, width = width, width * 2
        for i in np.flatnonzero(open_ & (size > LONG)):
            parts.append((np.array([i]), self._alone(self.single[data[begin[i]:begin[i] + size[i]]])[None, :]))
        for rows, m in parts:
            count[rows] = (m >= 0).sum(1)
        start = np.cumsum(count) - count
        out = np.empty(int(count.sum()), np.int32)
        for rows, m in parts:
            inside = m >= 0
            out[(start[rows][:, None] + np.arange(m.shape[1]))[inside]] = m[inside]
        return out, count

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all ids in a row, number of bytes of each)."""
        n = self.lens[ids]
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        return self.bytes[at + np.repeat(self.starts[ids], n)], n


#: the pattern that the vectorised splitter below knows
STANDARD = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_SIGN, LETTER, _NUMBER, _SPACE = 0, 1, 2, 3


def _points(step: int = 1 << 14) -> Iterator[tuple[int, str]]:
    """All code points that text can hold, ``step`` at a time: (first, the characters)."""
    for lo, hi in ((0, 0xD800), (0xE000, 0x110000)):
        for a in range(lo, hi, step):
            yield a, "".join(map(chr, range(a, min(a + step, hi))))


@lru_cache(1)
def regex_classes() -> np.ndarray:
    """Class of every code point, as the regex module sees it.  Made on the driver, a stretch of
    code points at a time; 1.1 MB that travel with the tasks."""
    out = np.zeros(0x110000, np.uint8)
    for cls, pat in ((LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
        find = regex.compile(pat).finditer
        for first, chars in _points():
            for m in find(chars):
                out[first + m.start():first + m.end()] = cls
    return out


def observed_classes(pieces_of) -> np.ndarray:
    """Class of every code point, as a pre-tokenizer of this pattern shows it (libraries differ in
    their Unicode version): ``pieces_of(text)`` gives the offsets of the pieces.

    Code points in order fall into runs of one class, and one of each run tells which.
    """
    out = np.zeros(0x110000, np.uint8)
    for first, chars in _points():
        for a, b in pieces_of(chars):
            c = chars[a]
            out[first + a:first + b] = LETTER if len(pieces_of("a" + c)) == 1 else _NUMBER if len(pieces_of("1" + c)) == 1 else _SIGN
    white = [c for c in np.flatnonzero(regex_classes() == _SPACE) if len(pieces_of("  " + chr(c))) == 1]
    out[white] = _SPACE
    return out


def _code_points(data: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Code points of UTF-8 bytes, given where the characters begin."""
    lead = data[pos]
    cp = lead.astype(np.int32)
    for low, high, keep, more in ((0xC0, 0xDF, 0x1F, 1), (0xE0, 0xEF, 0x0F, 2), (0xF0, 0xF7, 0x07, 3)):
        at = np.flatnonzero((lead >= low) & (lead <= high))
        if at.size:
            v = lead[at].astype(np.int32) & keep
            for k in range(1, more + 1):
                v = v << 6 | (data[pos[at] + k] & 0x3F)
            cp[at] = v
    return cp


def standard_pieces(data: np.ndarray, offs: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the matches of STANDARD in a slice of documents, by class runs.

    A run of letters, numbers or signs is a match, with one blank before it.  Of a white run that
    something follows, the last character stands alone or (a blank) goes with what follows.  A lone
    apostrophe takes the ending of a contraction from the letters after it.
    """
    if not data.size:
        z = np.zeros(0, np.int64)
        return z, z, z
    pos = np.flatnonzero((data & 0xC0) != 0x80)
    cp = _code_points(data, pos)
    c, n = classes[cp], pos.size
    edge = np.zeros(n + 1, bool)
    edge[np.searchsorted(pos, offs)] = True
    begins = edge[:-1].copy()
    begins[1:] |= c[1:] != c[:-1]
    runs = np.flatnonzero(begins)
    ends = np.r_[runs[1:], n]
    cut = np.zeros(n + 1, bool)
    cut[runs] = True
    white = c[runs] == _SPACE
    last = ends[white] - 1
    last = last[~edge[last + 1]]  # white runs that something follows
    cut[last] = True
    joined = last[cp[last] == 0x20]
    cut[joined + 1] = False
    mark = runs[(cp[runs] == 0x27) & (ends - runs == 1) & ~edge[ends]]
    mark = mark[cut[mark] & (c[np.minimum(mark + 1, n - 1)] == LETTER)]
    if mark.size:
        run_end = ends[np.searchsorted(runs, mark + 1)]
        one, two = cp[mark + 1], np.where(run_end - mark > 2, cp[np.minimum(mark + 2, n - 1)], 0)
        short = np.isin(one, [ord(x) for x in "stmd"])
        pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        size = np.where(short, 1, np.where(pair, 2, 0))
        hit = size > 0
        mark, size, run_end = mark[hit], size[hit], run_end[hit]
        cut[mark + 1] = False
        rest = mark + 1 + size
        cut[rest[rest < run_end]] = True
    starts = pos[np.flatnonzero(cut[:n])]
    return starts, np.r_[starts[1:], data.size], np.searchsorted(offs, starts, "right") - 1


def _pattern_pieces(pattern: str):
    """The same for any pattern whose matches cover the text, by the regex module."""
    find = regex.compile(pattern).findall

    def split(data, offs):
        sizes, rows = [], []
        for r, (a, b) in enumerate(zip(offs[:-1], offs[1:])):
            got = [len(p.encode()) for p in find(data[a:b].tobytes().decode())]
            sizes += got
            rows += [r] * len(got)
        ends = np.cumsum(np.array(sizes, np.int64))
        return ends - np.array(sizes, np.int64), ends, np.array(rows, np.int64)
    return split


class PieceMemory:
    """Ids of the distinct pieces seen by one worker, in one growing array; emptied when it holds
    ``limit`` bytes.

    A piece is found by a 64-bit hash and taken only if its length and a second, independent hash
    agree; a piece whose first hash belongs to another one is encoded each time.
    """

    def __init__(self, pattern: str, encode, classes: np.ndarray, limit: int = REMEMBER):
        self.split = partial(standard_pieces, classes=classes) if pattern == STANDARD else _pattern_pieces(pattern)
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self):
        self.keys, self.code = np.empty(0, np.uint64), np.empty(0, np.int32)  # sorted hashes, their codes
        self.flat, self.used = np.empty(1 << 16, np.int32), 0
        self.start, self.count, self.known = np.empty(1 << 12, np.int64), np.empty(1 << 12, np.int32), 0
        self.size, self.check = np.empty(1 << 12, np.int32), np.empty(1 << 12, np.uint64)

    @staticmethod
    def _room(a: np.ndarray, n: int) -> np.ndarray:
        return a if n <= a.size else np.r_[a, np.empty(max(a.size // 2, n - a.size), a.dtype)]

    def _learn(self, pieces: list[bytes], size: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Codes of new pieces."""
        ids, count = self.encode(pieces)
        k, n = self.known, len(pieces)
        self.flat = self._room(self.flat, self.used + ids.size)
        self.flat[self.used:self.used + ids.size] = ids
        for name, v in (("start", self.used + np.cumsum(count) - count), ("count", count), ("size", size), ("check", check)):
            a = self._room(getattr(self, name), k + n)
            a[k:k + n] = v
            setattr(self, name, a)
        self.used, self.known = self.used + ids.size, k + n
        return np.arange(k, k + n)

    def ids(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents of a slice in a row, number of ids of each document)."""
        if 36 * self.known + 4 * self.used > self.limit:
            self._clear()
        starts, ends, rows = self.split(data, offs)
        sizes, check = ends - starts, span_hashes(data, starts, ends, salt=1)
        h, first, back = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, h)
        there = at < self.keys.size
        there[there] = self.keys[at[there]] == h[there]
        code = np.full(h.size, -1, np.int64)
        code[there] = self.code[at[there]]
        raw = data.tobytes()

        def bytes_of(i):
            return [raw[a:b] for a, b in zip(starts[i].tolist(), ends[i].tolist())]
        new = np.flatnonzero(~there)
        if new.size:
            one = first[new]
            code[new] = self._learn(bytes_of(one), sizes[one], check[one])
            self.code = np.insert(self.code, at[new], code[new].astype(np.int32))
            self.keys = np.insert(self.keys, at[new], h[new])
        codes = code[back]
        other = np.flatnonzero((self.size[codes] != sizes) | (self.check[codes] != check))
        if other.size:
            codes[other] = self._learn(bytes_of(other), sizes[other], check[other])
        n = self.count[codes].astype(np.int64)
        total = np.r_[0, np.cumsum(n)]
        cut = np.searchsorted(rows, np.arange(offs.size))
        at = np.arange(int(total[-1])) - np.repeat(total[:-1], n)
        return self.flat[at + np.repeat(self.start[codes], n)], np.diff(total[cut])


_KEPT: dict = {}


def kept(key, make):
    """``make()``, kept by this worker under ``key`` between tasks; one at a time, so that memory of
    an earlier stage is let go."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def tables(rank_path: str) -> tuple[str, Ranks, np.ndarray]:
    """(name, tables of the rank file, classes of the code points), made on the driver."""
    with open(rank_path, "rb") as f:
        blob = f.read()
    return hashlib.sha256(blob).hexdigest(), _ranks(blob), regex_classes()


@lru_cache(2)
def _ranks(blob: bytes) -> Ranks:
    return Ranks(blob)


def rank_memory(name: str, ranks: Ranks, classes: np.ndarray, pattern: str) -> tuple[Ranks, PieceMemory]:
    """Tables and memory of one rank file; kept between the tasks of a worker."""
    return kept((name, pattern), lambda: (ranks, PieceMemory(pattern, ranks.encode_pieces, classes)))


def encode(docs: DataFrame, rank_path: str, pattern: str, carry: list[str] | None = None) -> DataFrame:
    """doc_id, the ``carry`` columns, n_tokens, ids (binary: little-endian unsigned 32-bit),
    ids_sha256, decoded_sha256 (of the bytes decoded from those ids), per row of ``docs``.

    The rank file (of bounded size: one vocabulary) is read and its tables are built on the driver.
    """
    return _run(docs, rank_path, pattern, ["doc_id", *(carry or [])], True)


def encode_digests(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """As ``encode``, without the ids."""
    return _run(docs, rank_path, pattern, ["doc_id"], False)


def _run(docs, rank_path, pattern, cols, with_ids):
    made = tables(rank_path)
    src = docs.select(*cols, "text")
    fields = ", ".join(f"`{c}` {src.schema[c].dataType.simpleString()}" for c in cols)
    out = f"{fields}, n_tokens long" + (", ids binary" if with_ids else "") + ", ids_sha256 string, decoded_sha256 string"

    def run(batches):
        ranks, memory = rank_memory(*made, pattern)
        for b in batches:
            n, raw, h_ids, h_back = [], [], [], []
            data, offs = column_bytes(b.column(b.num_columns - 1))
            for _, _, d, o in slices(data, offs):
                ids, each = memory.ids(d, o)
                back, size = ranks.decode(ids)
                end = np.cumsum(each)
                total = np.r_[0, np.cumsum(size)]
                words = ids.astype("<u4")
                for e, k in zip(end, each):
                    part = words[e - k:e].tobytes()
                    n.append(int(k))
                    if with_ids:
                        raw.append(part)
                    h_ids.append(hashlib.sha256(part).hexdigest())
                    h_back.append(hashlib.sha256(back[total[e - k]:total[e]].tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(n, pa.int64()), *([pa.array(raw, pa.binary())] if with_ids else []), pa.array(h_ids), pa.array(h_back)],
                [*cols, "n_tokens", *(["ids"] if with_ids else []), "ids_sha256", "decoded_sha256"])
    return src.withColumn("text", F.coalesce("text", F.lit(""))).mapInArrow(lean(run), out)
