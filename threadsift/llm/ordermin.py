"""Order MinHash fingerprints (operator 8).

The k-mers of a text (``K`` code points) are numbered by occurrence, so that repeats count.  For
each of ``SIZE`` hash functions the ``L`` k-mers of least hash are taken, put back into their text
order, and the tuple is hashed: two texts agree in a position when they share those k-mers in the
same order, which is sensitive to edit distance and not only to the shared content.  The likeness
of two fingerprints is the share of equal positions.

``neighbours`` compares each document with an edited version and with the next document in falling
doc_id order.  Documents are range-partitioned and sorted, so the next one is the next row; only
the first and the last row of each partition carry their text on, and meet in a table of one row
per partition.

Defined cases: a null text is empty; a text of fewer than ``K`` code points is a single k-mer; with
fewer than ``L`` k-mers the tuple is shorter; rows of one doc_id follow each other by their text's
hash; null doc_ids come last; a single document is its own next.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadsift.llm.text import mix, seeds, slices, column_bytes, written

K, L, SIZE = 5, 2, 32
_MULT = seeds(SIZE, 8) | np.uint64(1)
_XOR = seeds(SIZE, 9)
_ROLL = seeds(K, 10) | np.uint64(1)
_M = np.uint64(0x94D049BB133111EB)


def fingerprint(codes: np.ndarray) -> np.ndarray:
    """uint32[SIZE] of a text's code points."""
    c = codes.astype(np.uint64)
    n = max(1, c.size - K + 1)
    if c.size < K:
        h = mix(np.array([(c * _ROLL[:c.size]).sum(dtype=np.uint64) + np.uint64(c.size + 1)], np.uint64))
    else:
        h = np.zeros(n, np.uint64)
        for j in range(K):
            h += (c[j:j + n] + np.uint64(7)) * _ROLL[j]
        h = mix(h)
    # number the occurrences: sort (hash, place) packed into one word, so equal hashes stay in text order
    bits = np.uint64(max(1, int(n).bit_length()))
    packed = np.sort(((h >> bits) << bits) | np.arange(n, dtype=np.uint64))
    place = (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    group = packed >> bits
    first = np.ones(n, bool)
    first[1:] = group[1:] != group[:-1]
    nth = np.arange(n) - np.maximum.accumulate(np.where(first, np.arange(n), 0))
    base = np.empty(n, np.uint64)
    base[place] = mix(h[place] + nth.astype(np.uint64) * _M)
    take = min(L, n)
    at = np.empty((SIZE, take), np.int64)
    top, step = np.uint64(0xFFFFFFFFFFFFFFFF), max(1, (1 << 15) // n)
    for j in range(0, SIZE, step):
        v = (base ^ _XOR[j:j + step, None]) * _MULT[j:j + step, None]
        lines = np.arange(v.shape[0])
        for i in range(take):
            best = v.argmin(1)
            at[j:j + step, i] = best
            v[lines, best] = top
    at.sort(1)  # back into text order
    acc = np.full(SIZE, take, np.uint64)
    for i in range(take):
        acc = mix(acc * _M + base[at[:, i]])
    return (acc >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def _raw(f: np.ndarray) -> bytes:
    return f.astype(">u4").tobytes()


def _codes(t: str) -> np.ndarray:
    return np.frombuffer(t.encode("utf-32-le"), np.uint32)


def _pair(doc_id, text: str, f: np.ndarray, nxt: str, nf: np.ndarray) -> tuple:
    m = len(text) // 3
    edited = text[:len(text) - m] + nxt[:m]
    e = f if edited == text else fingerprint(_codes(edited))
    return doc_id, len(text), hashlib.sha256(edited.encode()).digest(), _raw(f), _raw(e), likeness(f, e), likeness(f, nf)


#: digests and fingerprints travel and are written as bytes, and are spelled out at the end
RAW = "doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_BYTES = ["edited_sha256", "fingerprint", "edited_fingerprint"]


def neighbours(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (hex), near_edited, near_next:
    one row per row of ``docs``; next is the following row by falling doc_id, cyclic."""
    n = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    key = F.col("doc_id").desc_nulls_last()
    names = [x.split()[0] for x in RAW.split(", ")]

    def run(batches):
        prev = first = pid = None
        for b in batches:
            if not b.num_rows:
                continue
            rows = []
            data, offs = column_bytes(b.column(1))
            for i, j, _, _ in slices(data, offs):
                for doc_id, text in zip(b.column(0).slice(i, j - i).to_pylist(), b.column(1).slice(i, j - i).to_pylist()):
                    cur = (doc_id, text, fingerprint(_codes(text)))
                    if prev is None:
                        first, pid = cur, b.column(2)[0].as_py()
                    else:
                        rows.append((*_pair(*prev, cur[1], cur[2]), None, None, None, pid))
                    prev = cur
            if rows:
                yield _batch(rows)
        if prev is not None:  # the last row of the partition waits for the first of the next one
            yield _batch([(prev[0], None, None, None, None, None, None, first[1], prev[1], first[0], pid)])

    def _batch(rows):
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.string(), pa.string(), pa.int64(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [*names, "head", "tail", "head_id", "pid"])

    src = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
           .repartitionByRange(n, key).sortWithinPartitions(key, F.xxhash64("text")).withColumn("pid", F.spark_partition_id()))
    done = written(src.mapInArrow(run, RAW + ", head string, tail string, head_id long, pid int"), "neighbours")
    ends = done.filter("tail is not null")  # one row per written partition
    w = Window.orderBy("pid")
    ring = ends.select("doc_id", "tail", F.lead("head").over(w).alias("nxt"), F.first("head").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("round"))

    def join_ends(batches):
        for b in batches:
            rows = []
            for doc_id, text, nxt in zip(*(b.column(i).to_pylist() for i in range(3))):
                rows.append(_pair(doc_id, text, fingerprint(_codes(text)), nxt, fingerprint(_codes(nxt))))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)
    last = ring.select("doc_id", "tail", F.coalesce("nxt", "round").alias("nxt")).mapInArrow(join_ends, RAW)
    both = done.filter("tail is null").select(*names).unionByName(last)
    return both.select(*[F.lower(F.hex(c)).alias(c) if c in _BYTES else F.col(c) for c in names])
