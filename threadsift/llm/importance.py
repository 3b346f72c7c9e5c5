"""Quality classifier by importance resampling (operator 3).

Two generative models over hashed n-grams (words with word pairs, and byte 4-grams, in ``BUCKETS``
buckets each): the target from labelled good documents, the raw one from all documents.  A document's log weight
is the sum over its n-grams of log(target / raw); with Gumbel noise drawn from its doc_id, the top
k keys are a sample without replacement in proportion to the weights.

The target model is fitted on at most ``MAX_TARGET`` good rows (in hash order of doc_id).  The raw
counts cover every document: each task adds up fixed-size vectors, so the shuffle carries at most
``2 * BUCKETS`` rows a task, and ``2 * BUCKETS`` rows reach the driver.  k is the share of good rows among
the labelled ones times the number of documents; the top k are found by range-sorting the keys and
counting, never in one task.

Defined cases: a null or empty text has no n-grams and weight 0; without labels every document is
kept; equal keys go by doc_id; repeated rows have equal weights and noise.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsift.llm.order import running_sum
from threadsift.llm.text import column_bytes, mix, slices, span_hashes, word_spans, written

BUCKETS = 1 << 16
MAX_TARGET = 20_000
GRAM = 4
SMOOTH = 1.0
NOISE_SEED = 3


def _grams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of every n-gram of a slice: words and pairs in the first half of the buckets,
    byte 4-grams in the second."""
    starts, ends, rows = word_spans(data, offs)
    h = span_hashes(data, starts, ends)
    pair = mix(h[1:] + h[:-1] * np.uint64(0x94D049BB133111EB))[rows[1:] == rows[:-1]] if h.size > 1 else h[:0]
    b = [h, pair]
    r = [rows, rows[1:][rows[1:] == rows[:-1]] if h.size > 1 else rows[:0]]
    out = [np.concatenate(b) & np.uint64(BUCKETS - 1)]
    at = [np.concatenate(r)]
    m = data.size - GRAM + 1
    if m > 0:
        v = data[:m].astype(np.uint32)
        for k in range(1, GRAM):
            v = v << np.uint32(8) | data[k:k + m]
        row = np.repeat(np.arange(offs.size - 1), np.diff(offs))
        same = row[:m] == row[GRAM - 1:]
        g = (v[same] * np.uint32(0x9E3779B1)) >> np.uint32(16)
        out.append(g.astype(np.uint64) + np.uint64(BUCKETS))
        at.append(row[:m][same])
    return np.concatenate(out).astype(np.int64), np.concatenate(at)


def _counts(docs: DataFrame) -> np.ndarray:
    """n-gram counts of all rows: float[2 * BUCKETS]."""
    def run(batches):
        total = np.zeros(2 * BUCKETS, np.int64)
        for b in batches:
            data, offs = column_bytes(b.column(0))
            for _, _, d, o in slices(data, offs):
                total += np.bincount(_grams(d, o)[0], minlength=2 * BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])
    got = docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(2 * BUCKETS)
    out[got["bucket"].to_numpy()] = got["n"].to_numpy()
    return out


def _log_model(counts: np.ndarray) -> np.ndarray:
    half = counts.reshape(2, BUCKETS) + SMOOTH
    return np.log(half / half.sum(1, keepdims=True)).ravel()


def log_ratio(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """(log(target / raw) per bucket, share of good rows among the labelled)."""
    lab = (labels.select("doc_id", "quality").filter("doc_id is not null and quality is not null")
           .groupBy("doc_id").agg(F.max("quality").alias("quality")))
    n = lab.agg(F.count("*").alias("n"), F.sum((F.col("quality") == 1).cast("long")).alias("k")).first()
    if not n["k"]:
        return np.zeros(2 * BUCKETS), 1.0
    good = written(lab.filter("quality = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_TARGET).select("doc_id"), "target-ids")
    # at most MAX_TARGET ids
    target = _counts(docs.select("doc_id", "text").join(F.broadcast(good), "doc_id", "left_semi"))
    raw = _counts(docs)
    # the raw counts scaled to the target's size, so that smoothing weighs alike on both
    for i in (0, 1):
        half = slice(i * BUCKETS, (i + 1) * BUCKETS)
        raw[half] *= target[half].sum() / max(raw[half].sum(), 1)
    return _log_model(target) - _log_model(raw), n["k"] / n["n"]


def weights(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """doc_id, n_grams, log_weight of every row."""
    ratio = ratio.astype(np.float64)

    def run(batches):
        for b in batches:
            n, w = [np.zeros(0, np.int64)], [np.zeros(0)]
            data, offs = column_bytes(b.column(1))
            for i, j, d, o in slices(data, offs):
                g, r = _grams(d, o)
                n.append(np.bincount(r, minlength=j - i))
                w.append(np.bincount(r, ratio[g], minlength=j - i))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.concatenate(n)), pa.array(np.concatenate(w))], ["doc_id", "n_grams", "log_weight"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_grams long, log_weight double")


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None) -> DataFrame:
    """doc_id, n_grams, log_weight, sample_key, kept; ``share`` of the documents is kept (default:
    the share of good rows among the labelled)."""
    ratio, good = log_ratio(docs, labels)
    share = good if share is None else share
    # 52 bits of a hash of the doc_id, strictly inside (0, 1)
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(NOISE_SEED)), 12).cast("double") + 0.5) / float(1 << 52)
    keyed = written(weights(docs, ratio).withColumn("sample_key", F.col("log_weight") - F.log(-F.log(u))), "weights")
    total = keyed.count()
    ranked = running_sum(keyed, [F.col("sample_key").desc(), F.col("doc_id")], F.lit(1), "place")
    return ranked.withColumn("kept", F.col("place") < int(round(share * total))).drop("place")
