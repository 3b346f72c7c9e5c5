"""Toxicity by non-negative positive-unlabelled learning (operator 10).

Positives are confirmed toxic rows; everything else is unlabelled text, toxic rows among it.  The
risk of a linear classifier f is corrected by the class prior:

    prior * E_P[l(f)] + max(0, E_U[l(-f)] - prior * E_P[l(-f)])

and where the second part falls below zero (the classifier has begun to remember the sample) the
step goes the other way.  Features are the presence of words and word beginnings, by 64-bit hash.

Fitting uses bounded samples, in hash order of doc_id: ``MAX_POSITIVE`` toxic rows and
``MAX_UNLABELLED`` documents, none from the held-out fold; the prior is the share of toxic rows among
all labelled rows outside that fold.  Feature counts of the samples are summed per partition, so
only counts of features that set the samples apart and the samples' hits on them reach the driver.
Scoring reads every whole text.

Defined cases: null and empty texts have no features and get the score of the bias; without any
positive row every score is 0; repeated rows get equal scores; a row without doc_id is not held out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsift.llm.text import column_bytes, lean, mix, slices, span_hashes, word_spans, written

MAX_POSITIVE, MAX_UNLABELLED = 20_000, 40_000
FOLDS = 5
BEGINNINGS = (4, 5, 6, 7, 8)
BUCKETS = 1 << 20
MAX_FEATURES, MIN_Z = 4096, 5.0
STEPS, RATE, DECAY = 600, 0.05, 1e-5
#: words here are runs of letters and digits: ASCII signs and spaces part them
_GAP = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every word and word beginning of a slice; repeats included."""
    starts, ends, rows = word_spans(data, offs, _GAP)
    hs, rs = [span_hashes(data, starts, ends, lower=True)], [rows]
    for k in BEGINNINGS:
        long = ends - starts > k
        hs.append(mix(span_hashes(data, starts[long], starts[long] + k, lower=True) + np.uint64(k)))
        rs.append(rows[long])
    return np.concatenate(hs), np.concatenate(rs)


def _unique(h: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (hash, row)."""
    order = np.lexsort((h, r))
    h, r = h[order], r[order]
    new = np.ones(h.size, bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    return h[new], r[new]


def _sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """(text, positive) of the bounded samples, and the class prior."""
    lab = (labels.select("doc_id", "toxic").filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n = lab.agg(F.count("*").alias("n"), F.sum((F.col("toxic") == 1).cast("long")).alias("k")).first()
    prior = (n["k"] or 0) / n["n"] if n["n"] else 0.0
    pos = lab.filter("toxic = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_POSITIVE).select("doc_id", F.lit(True).alias("positive"))
    unl = (docs.select("doc_id").filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).distinct()
           .orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(MAX_UNLABELLED).select("doc_id", F.lit(False).alias("positive")))
    ids = written(pos.union(unl), "sample-ids")
    # at most MAX_POSITIVE + MAX_UNLABELLED ids
    return written(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("text", "positive"), "sample"), prior


def _z(p: np.ndarray, u: np.ndarray, n_p: int, n_u: int) -> np.ndarray:
    both = (p + u) / (n_p + n_u)
    return (p / n_p - u / n_u) / np.sqrt(np.maximum(both * (1 - both), 1e-12) * (1 / n_p + 1 / n_u))


def _buckets(sample: DataFrame) -> DataFrame:
    """(bucket, p, u): documents of each sample with a feature in the bucket."""
    def run(batches):
        count = np.zeros((2, BUCKETS), np.int32)
        for b in batches:
            data, offs = column_bytes(b.column(0))
            side = b.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for i, j, d, o in slices(data, offs):
                h, r = features(d, o)
                key = np.unique(r * BUCKETS + (h & np.uint64(BUCKETS - 1)).astype(np.int64))
                for s in (0, 1):
                    count[s] += np.bincount(key[side[i:j][key // BUCKETS] == s] % BUCKETS, minlength=BUCKETS).astype(np.int32)
        at = np.flatnonzero(count.any(0))
        for i in range(0, at.size, 100_000):
            a = at[i:i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(count[1, a], pa.int64()), pa.array(count[0, a], pa.int64())], ["bucket", "p", "u"])
    return sample.mapInArrow(lean(run), "bucket long, p long, u long").groupBy("bucket").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))


def fit(rows: np.ndarray, feats: np.ndarray, positive: np.ndarray, n_features: int, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias from (row, feature) presences; ``positive`` marks the rows of P."""
    n = positive.size
    n_p, n_u = max(1, int(positive.sum())), max(1, int((~positive).sum()))
    w, b = np.zeros(n_features), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for t in range(1, STEPS + 1):
        # sigmoid loss: l(f) = s(-f), l(-f) = s(f); both slopes have the size s (1 - s)
        s = 1 / (1 + np.exp(-np.clip(b + np.bincount(rows, w[feats], minlength=n), -60, 60)))
        slope = s * (1 - s)
        neg = s[~positive].mean() - prior * s[positive].mean()
        g = np.where(positive, -prior * slope / n_p, slope / n_u)
        g = g + np.where(positive, -prior * slope / n_p, 0) if neg >= 0 else -g
        grad = np.r_[np.bincount(feats, g[rows], minlength=n_features) + DECAY * w, g.sum()]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        step = RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def train(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray, float] | None:
    """(sorted feature hashes, their weights, bias); None without positive rows."""
    sample, prior = _sample(docs, labels)
    size = {r["positive"]: r["n"] for r in sample.groupBy("positive").agg(F.count("*").alias("n")).collect()}
    n_p, n_u = size.get(True, 0), size.get(False, 0)
    if not n_p or not n_u or not prior:
        return None
    both = (F.col("p") + F.col("u")) / (n_p + n_u)
    z = (F.col("p") / n_p - F.col("u") / n_u) / F.sqrt(F.greatest(both * (1 - both), F.lit(1e-12)) * (1 / n_p + 1 / n_u))
    top = _buckets(sample).withColumn("z", F.abs(z)).filter(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "bucket").limit(MAX_FEATURES)
    chosen = np.zeros(BUCKETS, bool)
    chosen[[r["bucket"] for r in top.select("bucket").collect()]] = True

    def hits(batches):
        for b in batches:
            data, offs = column_bytes(b.column(0))
            vals, lens = [], []
            for i, j, d, o in slices(data, offs):
                h, r = features(d, o)
                at = chosen[(h & np.uint64(BUCKETS - 1)).astype(np.int64)]
                h, r = _unique(h[at], r[at])
                vals.append(h.astype(np.int64))
                lens.append(np.bincount(r, minlength=j - i))
            cut = np.r_[0, np.cumsum(np.concatenate(lens))].astype(np.int32) if lens else np.zeros(1, np.int32)
            flat = np.concatenate(vals) if vals else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column(1), pa.ListArray.from_arrays(pa.array(cut), pa.array(flat))], ["positive", "hits"])
    got = sample.mapInArrow(lean(hits), "positive boolean, hits array<long>").toArrow()
    positive = np.asarray(got["positive"].to_pylist(), bool)
    lists = got["hits"].combine_chunks()
    lens = np.diff(lists.offsets.to_numpy())
    rows, feats = np.repeat(np.arange(positive.size), lens), lists.flatten().to_numpy().view(np.uint64)
    names, code = np.unique(feats, return_inverse=True)
    p = np.bincount(code[positive[rows]], minlength=names.size)
    u = np.bincount(code[~positive[rows]], minlength=names.size)
    good = np.abs(_z(p, u, n_p, n_u)) >= MIN_Z if names.size else np.zeros(0, bool)
    new = np.cumsum(good) - 1
    use = good[code]
    w, b = fit(rows[use], new[code[use]], positive, int(good.sum()), min(prior, 0.95))
    return names[good], w, b


def score(docs: DataFrame, model, keep: list[str], out: str = "score") -> DataFrame:
    """``keep`` columns and ``out`` (double), the score of every row."""
    src = docs.select(*keep, F.col("text").alias("__text"))
    fields = ", ".join(f"`{c}` {src.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches):
        for b in batches:
            got = np.zeros(b.num_rows)
            if model is not None:
                names, w, bias = model
                data, offs = column_bytes(b.column(b.num_columns - 1))
                for i, j, d, o in slices(data, offs):
                    h, r = features(d, o)
                    at = np.searchsorted(names, h)
                    hit = names[np.minimum(at, names.size - 1)] == h if names.size else np.zeros(h.size, bool)
                    x, y = _unique(at[hit].astype(np.uint64), r[hit])
                    f = bias + np.bincount(y, w[x.astype(np.int64)], minlength=j - i)
                    got[i:j] = 1 / (1 + np.exp(-np.clip(f, -60, 60)))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(got)], [*keep, out])
    return src.mapInArrow(lean(run), f"{fields}, `{out}` double")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    s = score(docs, train(docs, labels), ["doc_id"])
    return s.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, with the columns of ``docs``."""
    cols = docs.columns
    return score(docs, train(docs, labels), cols, "__score").filter("__score < 0.5").select(*cols)
