"""Ranked lexical search over bit-sliced Bloom signatures (operator 12).

``build`` reads each text once and writes blocks of documents of like size: a Bloom signature per
document, laid by bit position (a slice holds one bit of every document of the block), and the exact
terms with their counts.  A term is entered once for each threshold of ``LEVELS`` that its count reaches.

``search`` ANDs the slices of each query term: the result covers every document that holds the term (and
a few more), and the first threshold that fails bounds its count from above.  Weighted sums of these
bounds, with each document's exact length, bound its score.  Documents are taken by falling bound and
scored exactly from their terms until the bound falls below the tenth best score found; a document is
left out only when its bound proves that it cannot enter.  A task returns at most ``k`` rows an item, from
which the ranks follow.

Scores: a term's weight is ``floor(1000 * ln((2N + 2) / (2 df + 1)))``, a document's ``m`` is
``25 + (75 * n * N) div L``, and an item's terms (repeats included) add ``w * ((10**9 * tf) div (1000 * tf + 8 * m))``.
Terms are told apart by a mixed 64-bit hash.

Items go in blocks of ``ITEMS``, so what travels to the tasks is bounded whatever the number of items.

Defined cases: null and empty texts have no terms, and are not ranked; an item without terms has no rows;
equal scores rank by doc_id, a row without doc_id first; repeated rows are ranked each; of several texts
of one item_id the least counts; empty tables give an empty result; a very long text is a block with few
others, in memory in proportion to it; extra columns are left out by name.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadsift.llm.text import column_bytes, mix, seeds, slices, span_hashes, word_spans
from threadsift.session import checkpoint_path

#: thresholds of a term's count
LEVELS = np.array([1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256, 384, 512, 768, 1024])
HASHES, BITS_A_TERM = 6, 16
CELLS, WIDEST = 1 << 21, 512
ITEMS = 512
#: terms are runs of digits, ASCII letters and whatever is not ASCII
GAP = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_SALT = seeds(LEVELS.size, 31)
INDEX = "doc_ids array<long>, n binary, slices binary, cuts binary, terms binary, counts binary"


def terms(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every term of a slice, repeats included."""
    starts, ends, rows = word_spans(data, offs, GAP)
    return span_hashes(data, starts, ends, lower=True), rows


def _counted(data: np.ndarray, offs: np.ndarray):
    """For each document: (terms in a row, distinct term hashes ascending, their counts)."""
    h, rows = terms(data, offs)
    order = np.lexsort((h, rows))
    h, rows = h[order], rows[order]
    new = np.ones(h.size, bool)
    new[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.r_[at, h.size])
    edge = np.searchsorted(rows[at], np.arange(offs.size))
    total = np.r_[0, np.cumsum(count)]
    for a, b in zip(edge[:-1], edge[1:]):
        yield int(total[b] - total[a]), h[at[a:b]], count[a:b]


def _places(h: np.ndarray, level: int, bits: int) -> np.ndarray:
    """Bit positions of terms at a level in a signature of ``bits`` (a power of two): [terms, HASHES]."""
    key = mix(h + _SALT[level])
    step = (key >> np.uint64(32)) | np.uint64(1)
    return ((key[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)) & np.uint64(bits - 1)).astype(np.int64)


def _width(bits: int) -> int:
    return max(8, min(WIDEST, CELLS // bits))


def build(docs: DataFrame, path: str) -> DataFrame:
    """The index of ``docs`` (doc_id, text), written to ``path``; no shuffle."""
    def run(batches):
        held: dict[int, list] = {}

        def flush(bits):
            got = held.pop(bits)
            h, c = np.concatenate([g[2] for g in got]), np.concatenate([g[3] for g in got])
            size = np.array([g[2].size for g in got])
            j = np.repeat(np.arange(len(got)), size)
            cells = np.zeros((bits, -(-len(got) // 8) * 8), np.uint8)
            for k, least in enumerate(LEVELS):
                on = np.flatnonzero(c >= least)
                if not on.size:
                    break
                cells[_places(h[on], k, bits), j[on, None]] = 1
            raw = [np.array([g[1] for g in got], np.int64), np.packbits(cells, axis=1, bitorder="little"), np.r_[0, np.cumsum(size)].astype(np.int64), h, c.astype(np.uint32)]
            return pa.RecordBatch.from_arrays([pa.array([[g[0] for g in got]], pa.list_(pa.int64())), *[pa.array([x.tobytes()], pa.binary()) for x in raw]],
                                              ["doc_ids", "n", "slices", "cuts", "terms", "counts"])
        for b in batches:
            data, offs = column_bytes(b.column(1))
            for i, j, d, o in slices(data, offs):
                for doc, (n, h, c) in zip(b.column(0).slice(i, j - i).to_pylist(), _counted(d, o)):
                    if n:
                        entries = int(np.searchsorted(LEVELS, c, "right").sum())
                        bits = max(256, BITS_A_TERM << (entries - 1).bit_length())
                        held.setdefault(bits, []).append((doc, n, h, c))
                        if len(held[bits]) == _width(bits):
                            yield flush(bits)
        for bits in sorted(held):
            yield flush(bits)
    # a block is large: few to a row group, so that a reader never holds many at once
    (docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, INDEX)
     .write.option("parquet.block.row.count.limit", 8).parquet(path))
    return docs.sparkSession.read.schema(INDEX).parquet(path)


def _statistics(index: DataFrame, q: np.ndarray) -> tuple[int, int, np.ndarray]:
    """(documents, their terms, documents that hold each of the ascending hashes ``q``)."""
    def run(batches):
        df, n, total = np.zeros(q.size, np.int64), 0, 0
        for b in batches:
            for lens, held in zip(b.column(0), b.column(1)):
                lens, h = np.frombuffer(lens.as_buffer(), np.int64), np.frombuffer(held.as_buffer(), np.uint64)
                n, total = n + lens.size, total + int(lens.sum())
                if q.size:
                    at = np.minimum(np.searchsorted(q, h), q.size - 1)
                    df += np.bincount(at[q[at] == h], minlength=q.size)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-2, -1, at]), pa.array(np.r_[n, total, df[at]])], ["term", "c"])
    # one row for each term of the items in hand
    got = {r["term"]: r["c"] for r in index.select("n", "terms").mapInArrow(run, "term long, c long").groupBy("term").agg(F.sum("c").alias("c")).collect()}
    df = np.zeros(q.size, np.int64)
    for t, c in got.items():
        if t >= 0:
            df[t] = c
    return got.get(-2, 0), got.get(-1, 0), df


def _gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _bounds(sliced: np.ndarray, q: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """[terms, documents]: the most that each term can add, before its weight."""
    bits, width = sliced.shape
    level = np.zeros((q.size, width * 8), np.uint8)
    go = np.arange(q.size)
    alive = np.full((q.size, width), 255, np.uint8)
    for k in range(LEVELS.size):
        alive = alive & np.bitwise_and.reduce(sliced[_places(q[go], k, bits)], axis=1)
        some = alive.any(1)
        go, alive = go[some], alive[some]
        if not go.size:
            break
        level[go] += np.unpackbits(alive, axis=1, bitorder="little")
    top = np.r_[LEVELS[1:] - 1, np.iinfo(np.int32).max]
    most = np.zeros((LEVELS.size + 1, width * 8), np.int64)
    most[1:, :n.size] = _gain(np.minimum(top[:, None], n), m)
    return most[level, np.arange(width * 8)][:, :n.size]


def _search(index: DataFrame, items: list[tuple], k: int) -> DataFrame:
    """(item_id, doc_id, score): the best ``k`` of every task for each of ``items`` (item_id, text)."""
    data, offs = column_bytes(pa.array([t for _, t in items], pa.string()))
    h, rows = terms(data, offs)
    q, code = np.unique(h, return_inverse=True)
    n_docs, n_terms, df = _statistics(index, q)
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(c) + 1))) for c in df], np.int64)
    wanted = []  # (position of the item, its terms, their weights with repeats)
    for i in range(len(items)):
        t, times = np.unique(code[rows == i], return_counts=True)
        if t.size:
            wanted.append((i, t, weight[t] * times))
    ids = [i for i, _ in items]

    def run(batches):
        best: dict[int, list] = {i: [] for i, _, _ in wanted}  # heaps of (score, doc_id falling)
        for b in batches:
            for docs, *raw in zip(*b.columns):
                docs = docs.as_py()
                n, sliced, cuts, held, count = (np.frombuffer(x.as_buffer(), t) for x, t in zip(raw, (np.int64, np.uint8, np.int64, np.uint64, np.uint32)))
                m = 25 + (75 * n * n_docs) // n_terms
                sliced = sliced.reshape(-1, -(-len(docs) // 8))
                most = _bounds(sliced, q, n, m)
                exact: dict[int, np.ndarray] = {}

                def gains(j):
                    if j not in exact:
                        h, c = held[cuts[j]:cuts[j + 1]], count[cuts[j]:cuts[j + 1]].astype(np.int64)
                        at = np.minimum(np.searchsorted(q, h), q.size - 1)
                        hit = q[at] == h
                        exact[j] = np.zeros(q.size, np.int64)
                        exact[j][at[hit]] = _gain(c[hit], m[j])
                    return exact[j]
                for i, t, w in wanted:
                    top = best[i]
                    bound = w @ most[t]
                    at = np.flatnonzero(bound >= (top[0][0] if len(top) == k else 1))
                    for j in at[np.argsort(-bound[at], kind="stable")].tolist():
                        if len(top) == k and bound[j] < top[0][0]:
                            break
                        score = int(w @ gains(j)[t])
                        if score > 0:
                            d = docs[j]
                            row = (score, (0, 0) if d is None else (-1, -d))
                            if len(top) < k:
                                heapq.heappush(top, row)
                            elif row > top[0]:
                                heapq.heapreplace(top, row)
        out = [(ids[i], None if d[0] == 0 else -d[1], s) for i, top in best.items() for s, d in top]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(3)], ["item_id", "doc_id", "score"])
    return index.select("doc_ids", "n", "slices", "cuts", "terms", "counts").mapInArrow(run, "item_id long, doc_id long, score long")


def rank(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents of highest score above 0 for each item (item_id, text)."""
    spark = docs.sparkSession
    index = build(docs, checkpoint_path(spark, "sliced-index"))
    items = items.groupBy(F.col("item_id").cast("long").alias("item_id")).agg(F.min("text").alias("text"))
    parts = max(1, -(-items.count() // ITEMS))
    found = None
    for p in range(parts):
        rows = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == p).orderBy("item_id").collect()  # about ITEMS rows
        one = _search(index, [(r["item_id"], r["text"]) for r in rows], k)
        found = one if found is None else found.unionByName(one)
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_first("doc_id")))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _oracle() -> str:
    """The same result in DuckDB SQL."""
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH p AS (SELECT rid, doc_id, unnest(regexp_extract_all({low}, '{pattern}')) AS term FROM (SELECT row_number() OVER () AS rid, doc_id, text FROM documents)),
tf AS (SELECT rid, doc_id, term, count(*) AS c FROM p GROUP BY ALL),
len AS (SELECT rid, CAST(sum(c) AS BIGINT) AS n FROM tf GROUP BY rid),
total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM len),
m AS (SELECT rid, 25 + (75 * n * n_docs) // n_terms AS m FROM len, total),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all({low}, '{pattern}')) AS term
      FROM (SELECT item_id, min(text) AS text FROM benchmark GROUP BY item_id)) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM tf WHERE term IN (SELECT term FROM q) GROUP BY term), total),
s AS (SELECT item_id, rid, doc_id, CAST(sum(times * w * ((1000000000 * c) // (1000 * c + 8 * m))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (rid) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM s WHERE score > 0) WHERE rank <= 10"""


ORACLE = _oracle()
