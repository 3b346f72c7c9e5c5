"""op12 against brute force, its bounds, and its defined edge cases."""

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa

from tests.conftest import SF_SMALL
from tests.llm.conftest import EDGES, WORDS
from threadsift.llm import queries
from threadsift.llm import sliced_search as ss

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(t):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def by_force(docs, items, k=10):
    held = [(i, collections.Counter(terms_of(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, total = len(held), sum(n for *_, n in held)
    df = collections.Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        want, scores = collections.Counter(terms_of(text)), []
        for i, c, n in held:
            m = 100 - 75 + (75 * n * n_docs) // total
            s = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t, q in want.items())
            if s > 0:
                scores.append((-s, i is not None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def test_ranks_equal_brute_force(spark):
    docs, items = (queries.table(spark, SF_SMALL, t) for t in ("documents", "benchmark"))
    want = by_force([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert len({r[0] for r in want}) > 5
    got = queries.op12(spark, SF_SMALL)
    assert dict(got.dtypes)["rank"] == "int" and sorted(map(tuple, got.collect()), key=str) == want


def test_items_in_blocks_ties_and_repeats(spark, make, monkeypatch):
    monkeypatch.setattr(ss, "ITEMS", 3)
    monkeypatch.setattr(ss, "WIDEST", 16)
    rnd = random.Random(5)
    docs = [(i, " ".join(rnd.choice(WORDS) for _ in range(rnd.choice([3, 3, 40, 400]))), "en", "s") for i in range(200)]
    docs += [(500 + i, "alpha beta", "en", "s") for i in range(15)] + [(7, "alpha beta", "en", "s")] * 2
    items = [(i, " ".join(rnd.choice([*WORDS, "NOWHERE", "Alpha,ALPHA"]) for _ in range(5))) for i in range(10)] + [(90, "alpha beta beta"), (91, ""), (92, None), (93, "nowhere")]
    got = ss.rank(make(docs), spark.createDataFrame(items, "item_id long, text string"), 10)
    assert sorted(map(tuple, got.collect()), key=str) == by_force([(i, t) for i, t, *_ in docs], items)


def test_slices_never_miss_a_term():
    rng = np.random.default_rng(2)
    h = np.sort(rng.integers(0, 1 << 63, 400).astype(np.uint64))
    tf = rng.choice([1, 2, 3, 5, 9, 40, 3000], (6, h.size)) * (rng.random((6, h.size)) < 0.4)
    bits = 1 << 14
    cells = np.zeros((bits, 8), np.uint8)
    for j in range(6):
        for k, least in enumerate(ss.LEVELS):
            cells[ss._places(h[tf[j] >= least], k, bits), j] = 1
    n = tf.sum(1)
    m = 25 + n // 50
    most = ss._bounds(np.packbits(cells, axis=1, bitorder="little"), h, n, m)
    exact = np.stack([ss._gain(tf[j], m[j]) for j in range(6)], 1)
    assert (most >= exact).all() and (most < 1.6 * exact + 1)[exact > 0].mean() > 0.95 and (most[exact == 0] == 0).mean() > 0.9


def test_edges(spark, make):
    items = spark.createDataFrame([(1, "same text here one", "x"), (2, None, "x"), (None, "no id é日😀", "x"), (1, "zzz", "x")], "item_id long, text string, score string")
    got = sorted(map(tuple, ss.rank(make(EDGES, extra=True), items).collect()), key=str)
    want = by_force([(i, t) for i, t, *_ in EDGES], [(1, "same text here one"), (None, "no id é日😀")])
    assert got == want and any(r[2] is None for r in got)
    assert ss.rank(make([]), items).count() == 0
    assert ss.rank(make(EDGES), items.limit(0)).count() == 0
    data, offs = ss.column_bytes(pa.array(["A_b é9;x", None, ""]))
    assert [int(r) for r in ss.terms(data, offs)[1]] == [0, 0, 0, 0]
