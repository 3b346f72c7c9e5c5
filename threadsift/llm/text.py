"""Helpers shared by the operators: Arrow text columns as numpy bytes, vectorised word hashes,
tables written to the shared folder.

A text column arrives as one UTF-8 buffer with offsets.  Everything here works on slices of that
buffer of about ``SLICE`` bytes (at least one document), so memory does not grow with the batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from threadsift.session import checkpoint_path

SLICE = 1 << 19
#: words are ``[^\x20\x09-\x0D]+`` everywhere in this folder
WORD = r"[^\x20\x09-\x0D]+"
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_M1, _M2, _G = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser over a uint64 array (new array)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def seeds(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random uint64 values."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed) * np.uint64(1_000_003)) * _G)


#: A-Z folded to a-z
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
try:
    _LIBC = ctypes.CDLL("libc.so.6")
    _LIBC.malloc_trim  # noqa: B018 -- glibc only
except (OSError, AttributeError):
    _LIBC = None
_SALT = seeds(8, 11)
_PLACE = seeds(1024, 12)


def _places(n: int) -> np.ndarray:
    global _PLACE
    if _PLACE.size < n:
        _PLACE = seeds(2 * n, 12)
    return _PLACE


def _give_back() -> None:
    """Free memory goes back to the system: a Python worker lives on between tasks and stages, and what
    it keeps is missing in the executor."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def lean(run):
    """A function for ``mapInArrow`` that gives its free memory back when its task ends."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            _give_back()
    return wrapped


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    o = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    d = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return d, o


def slices(data: np.ndarray, offs: np.ndarray, size: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) over whole documents, about ``size`` bytes each."""
    i, n = 0, offs.size - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + size, "right")) - 1)
        j = min(j, n)
        yield i, j, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def word_spans(data: np.ndarray, offs: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every run of bytes outside ``gap``; none spans two documents."""
    if not data.size:
        z = np.zeros(0, np.int64)
        return z, z, z
    ink = ~gap[data]
    first, last = ink.copy(), ink.copy()
    first[1:] &= ~ink[:-1]
    last[:-1] &= ~ink[1:]
    b = offs[:-1][offs[:-1] < data.size]
    first[b] = ink[b]
    e = offs[1:][offs[1:] > 0] - 1
    last[e] = ink[e]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False, salt: int = 0) -> np.ndarray:
    """64-bit hash of each non-empty byte span; ``lower`` folds A-Z, each ``salt`` (0 to 7) gives a
    hash of its own.

    The span is read in words of eight bytes.  Each is mixed, shifted by its place and mixed again
    before the words are added: nothing in it is linear in the bytes, so no arrangement of bytes
    cancels out for every salt, as arrangements do in a polynomial modulo a power of two.
    """
    if not starts.size:
        return np.zeros(0, np.uint64)
    lens = ends - starts
    padded = np.zeros(data.size + 8, np.uint8)
    padded[:data.size] = LOWER[data] if lower else data
    eight = np.ndarray((data.size + 1,), "<u8", padded.data, strides=(1,))
    many = (lens + 7) >> 3
    base = np.cumsum(many) - many
    k = np.arange(int(many.sum())) - np.repeat(base, many)
    pos = np.repeat(starts, many) + (k << 3)
    short = 8 - np.minimum(np.repeat(ends, many) - pos, 8)
    w = eight[pos] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (short << 3).astype(np.uint64))
    v = mix(mix(w + _SALT[salt]) + _places(int(many.max()))[k])
    return mix(np.add.reduceat(v, base) + lens.astype(np.uint64) * _G + _SALT[salt])


def shingles(words: np.ndarray, rows: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every ``w``-word shingle; a row of fewer words gives its whole sequence as one."""
    n = words.size
    if not n:
        return words, rows
    acc, count = words.copy(), np.ones(n, np.uint64)
    for j in range(1, w):
        m = n - j
        if m <= 0:
            break
        same = rows[j:] == rows[:m]
        acc[:m] = np.where(same, mix(acc[:m] * _M2 + words[j:]), acc[:m])
        count[:m] += same
    head = np.ones(n, bool)
    head[1:] = rows[1:] != rows[:-1]
    use = (count == w) | head
    return mix(acc[use] + count[use] * _G), rows[use]


def row_edges(rows: np.ndarray, n: int) -> np.ndarray:
    """Where each row's run begins in the ascending ``rows``; n + 1 values."""
    return np.searchsorted(rows, np.arange(n + 1))


def written(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet under ``spark.checkpoint.dir`` and read again: cuts the lineage at a
    table all executors share, so a lost executor never restarts the whole chain."""
    spark = df.sparkSession
    path = checkpoint_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def doc_texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text and the named columns: clashing extra columns never reach the operators."""
    return docs.select("doc_id", "text", *more)
