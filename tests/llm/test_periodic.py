"""op13 against brute force, the LCE index, and the defined edge cases."""

import hashlib
import random
import re
import zlib

import numpy as np

from tests.conftest import SF_SMALL
from tests.llm.conftest import EDGES
from threadsift.llm import periodic, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_force(doc_id, text, rewrite=True):
    w = WORD.findall(text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if rewrite and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    seen, found = set(), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i < n - q and w[i] == w[i + q]:
                i += 1
            e = i + q
            if e - s >= max(6, 4 * q) and (s, e) not in seen:
                seen.add((s, e))
                found.append((s, e - s, q))
    found.sort(key=lambda r: (r[0], r[2]))
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    best = (None,) * 4 if top is None else (*top, 1000 * top[1] // top[2])
    digest = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{size},{q}\n" for s, size, q in found), " ".join(x for i, x in enumerate(w) if i not in gone))]
    return (doc_id, len(found), *best, *digest)


def texts(rnd):
    for k in range(250):
        parts = []
        for _ in range(rnd.randrange(1, 5)):
            unit = [rnd.choice("ab" if k % 2 else "abcdefgh") for _ in range(rnd.choice([1, 1, 2, 3, 5, 9, 40]))]
            parts += (unit * rnd.randrange(1, 12))[:rnd.randrange(1, 200)]
        yield " ".join(parts)


def test_lce_equals_comparison():
    rng = np.random.default_rng(1)
    for kinds in (1, 2, 5):
        w = rng.integers(0, kinds, 700)
        w[200:500] = w[100:400]
        w = np.r_[w, 99]
        lce = periodic.Lce(w)
        i, j = rng.integers(0, 700, (2, 3000))
        i, j = i[i != j], j[i != j]
        for a, b, n in zip(i, j, lce(i, j)):
            k = 0
            while max(a, b) + k < w.size and w[a + k] == w[b + k]:
                k += 1
            assert n == k
    gaps = {int((a - b) % periodic.V) for a in periodic.COVER for b in periodic.COVER}
    assert gaps == set(range(periodic.V)) and periodic._SHIFT.max() < periodic.V


def test_runs_equal_brute_force(make, monkeypatch):
    rnd = random.Random(3)
    rows = [(i, t, "en", "s") for i, t in enumerate(texts(rnd))]
    want = [by_force(i, t) for i, t, *_ in rows]
    assert sum(r[1] > 1 for r in want) > 60 and len({r[4] for r in want}) > 8
    got = sorted(map(tuple, periodic.digest(make(rows)).collect()))
    assert got == want
    monkeypatch.setattr(periodic, "GRID", 50)
    monkeypatch.setattr(periodic, "SLICE", 300)
    data, offs = periodic.column_bytes(periodic.pa.array([t for _, t, *_ in rows]))
    again = [r for i, j, d, o in periodic.slices(data, offs, 300) for r in periodic._slice_runs(list(range(i, j)), d, o, True)]
    assert [r[:7] for r in again] == [r[:7] for r in want]


def test_query_equals_brute_force(spark):
    docs = queries.table(spark, SF_SMALL, "documents").collect()
    short = {r["doc_id"]: r["text"] for r in docs if len(r["text"] or "") < 6000}
    got = {r[0]: tuple(r) for r in queries.op13(spark, SF_SMALL).collect()}
    assert len(got) == len(docs) and all(got[i] == by_force(i, t) for i, t in short.items())


def test_words_of_one_hash_are_told_apart(monkeypatch):
    real = periodic.span_hashes
    monkeypatch.setattr(periodic, "span_hashes", lambda d, a, b, salt=0: real(d, a, b, salt=1) if salt else np.ones(a.size, np.uint64))
    data, offs = periodic.column_bytes(periodic.pa.array(["a b c d e f g h", "a a a a a a a"]))
    got = periodic._slice_runs([1, 2], data, offs, False)
    assert [r[1] for r in got] == [0, 1]


def test_edges(make):
    long = (77, "x y z " * 50_000, "en", "s")
    got = periodic.scan(make([*EDGES, long], extra=True)).collect()
    assert len(got) == len(EDGES) + 1
    for r in got:
        if r["doc_id"] == 77:
            assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"], r["collapsed"]) == (1, 0, 150_000, 3, 50_000_000, "x y z")
        assert hashlib.sha256(r["runs"].encode()).hexdigest() == r["runs_sha256"]
    short = [r for r in EDGES if r[0] != 8]
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r) for r in periodic.digest(make(short)).collect()), key=key) == sorted((by_force(i, t) for i, t, *_ in short), key=key)
    assert periodic.digest(make([])).count() == 0
