"""Which of many keywords a text contains, for all texts of an Arrow batch at once.

``contains`` walks over a text once per keyword, some hundred times for the lexicons.  Here a batch is walked over
once per width (8, 4, 2 and 1 bytes): the first bytes of every keyword are looked up among the text's windows of that
width, and only keywords whose first bytes occur are searched for in the text.  Results equal ``contains`` on the bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

WIDTHS = (8, 4, 2, 1)
SLICE = 1 << 17  # windows looked up at a time
HASH = {8: (np.uint64(0x9E3779B97F4A7C15), np.uint64(48)), 4: (np.uint32(0x9E3779B1), np.uint32(16))}


def _hash(x: np.ndarray, width: int) -> np.ndarray:
    """Windows as numbers below 2 ** 16; those of one or two bytes stand for themselves."""
    return x if width < 4 else (x * HASH[width][0]) >> HASH[width][1]


class Finder:
    def __init__(self, words: list[str]):
        self.words = [w.encode() for w in words]
        size = np.array([len(w) for w in self.words], np.int64)
        self.size, self.empty, self.groups = size, np.flatnonzero(size == 0), []
        for k, width in enumerate(WIDTHS):
            ids = np.flatnonzero((size >= width) & (size < WIDTHS[k - 1] if k else size >= width))
            if len(ids):
                first = np.array([int.from_bytes(self.words[i][:width], "little") for i in ids], f"<u{width}")
                ids, first = ids[np.argsort(first, kind="stable")], np.sort(first)
                table = np.zeros(1 << 16, bool)
                table[_hash(first, width)] = True
                self.groups.append((width, ids, first, table))

    def _near(self, data: bytes, lo: int, hi: int):
        """(position, word) of all words whose first bytes stand between lo and hi."""
        for width, ids, first, table in self.groups:
            for at in range(lo, hi - width + 1, SLICE):
                windows = np.ndarray((min(SLICE, hi - width + 1 - at),), f"<u{width}", data, at, (1,))
                hit = np.flatnonzero(table[_hash(windows, width)])
                w = windows[hit]
                left = np.searchsorted(first, w, "left")
                n = np.searchsorted(first, w, "right") - left
                before = np.repeat(np.cumsum(n) - n, n)
                yield np.repeat(hit + at, n), ids[np.repeat(left, n) + np.arange(len(before)) - before]

    def pairs(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(row, word) of every word that a text contains, once each, by row; none for null texts."""
        texts = texts.cast(pa.large_string())
        n, k = len(texts), len(self.words)
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1] if n else np.zeros(1, np.int64)
        data = texts.buffers()[2].to_pybytes() if n and texts.buffers()[2] is not None else b""
        found = [np.arange(n).repeat(len(self.empty)) * k + np.tile(self.empty, n)]
        for at, word in self._near(data, int(ends[0]), int(ends[-1])):
            row = np.searchsorted(ends, at, "right") - 1
            fits = at + self.size[word] <= ends[row + 1]
            found.append(np.unique(row[fits] * k + word[fits]))
        row, word = np.divmod(np.unique(np.concatenate(found)), max(k, 1))
        here = np.array([s in WIDTHS or s == 0 or data.find(self.words[w], a, b) >= 0
                         for w, s, a, b in zip(word.tolist(), self.size[word].tolist(), ends[row].tolist(), ends[row + 1].tolist())], bool)
        if texts.null_count:
            here &= texts.is_valid().to_numpy(zero_copy_only=False)[row]
        return row[here], word[here]


def held(low: Column, words: list[str]) -> Column:
    """Those of ``words`` that the text contains, each once; null for null.

    Marked as not deterministic, so that Spark evaluates it once where a filter on its result follows."""
    words = sorted(set(words))
    finder, names = Finder(words), np.array(words, object)

    def run(texts: pa.Array) -> pa.Array:
        row, word = finder.pairs(texts)
        ends = np.searchsorted(row, np.arange(len(texts) + 1))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(names[word], pa.string()), mask=texts.is_null() if len(texts) else None)

    return F.arrow_udf(run, "array<string>").asNondeterministic()(low)
