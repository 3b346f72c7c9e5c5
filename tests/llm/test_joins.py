"""op11 against brute force, and its defined edge cases."""

import random

import numpy as np
import pytest

from tests.llm.conftest import EDGES
from tests.llm.test_documents import groups_by_force
from threadsift.llm import jaccard_join as jj


@pytest.mark.parametrize("w,num", [(3, 90), (2, 70)])
def test_groups_equal_brute_force(make, w, num, monkeypatch):
    monkeypatch.setattr(jj, "BLOCK", 8)  # several blocks even here
    rnd = random.Random(w)
    vocab = [f"w{i}" for i in range(3000)]
    rows, passage = [], " ".join(rnd.choice(vocab) for _ in range(60))
    for g in range(8):
        base = [rnd.choice(vocab) for _ in range(rnd.randrange(30, 150))]
        for _ in range(24):  # clouds of copies around the threshold, at both ends of it
            x = list(base)
            for _ in range(rnd.randrange(0, 4 if w == 3 else 9)):
                x[rnd.randrange(len(x))] = rnd.choice(vocab)
            if rnd.random() < 0.3:
                x = x[:rnd.randrange(len(x) * 9 // 10, len(x))]
            rows.append((len(rows) * 7 % 1009, " ".join(x)))
        rows += [(1100 + 10 * g + k, f"{passage} {' '.join(rnd.choice(vocab) for _ in range(6 + 3 * k))}") for k in range(10)]
    rows += [(2000 + i, t) for i, t in enumerate([None, "", "  ", "one", "ONE", "one two", "One  two", "a b c", "A b C", "a b c a b c a b c"])]
    rnd.shuffle(rows)
    want, sets = groups_by_force(rows, w, num, 100)
    assert len(set(want.values())) < len(want) - 60
    got = {r["doc_id"]: r for r in jj.linked_groups(make([(i, t, "en", "s") for i, t in rows]), w, num, 100).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s[0]) for i, s in sets.items()}


def test_prefixes_meet_under_every_order():
    rng = np.random.default_rng(4)
    level = rng.integers(0, 5, 1 << jj.BITS).astype(np.uint8)
    for _ in range(300):
        n = int(rng.integers(1, 200))
        s = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        t = np.unique(np.r_[s[rng.random(s.size) < 0.97], rng.integers(0, 1 << 63, int(rng.integers(0, 5))).astype(np.uint64)])
        both = np.intersect1d(s, t).size
        if t.size and 100 * both >= 90 * (s.size + t.size - both):
            for x, y in zip(jj.prefixes(s, level, 90, 100), jj.prefixes(t, level, 90, 100)):
                assert np.intersect1d(x, y).size
    orders = jj.prefixes(np.unique(rng.integers(0, 1 << 63, 100).astype(np.uint64)), level, 50, 100)
    assert len({o.tobytes() for o in orders}) == jj.ORDERS


def test_counters_cover_all_documents(make):
    rows = [(i, f"shared words here {i} and {i + 1} more {i * 7}", "en", "s") for i in range(500)]
    level = jj.rarity(make(rows), 3)
    s = next(jj.sets_of(*jj.column_bytes(jj.pa.array(["shared words here"])), 3))
    assert level[int(s[0] >> jj._TOP)] == 9  # 500 documents hold it, some two to the eighth beyond chance


def test_edges(make):
    got = jj.linked_groups(make(EDGES, extra=True)).collect()
    assert len(got) == len(EDGES)
    comp = {r["doc_id"]: r["component_id"] for r in got}
    want, sets = groups_by_force([(i, t) for i, t, *_ in EDGES if i is not None], 3, 90, 100)
    assert comp.pop(None) is None and comp == want
    assert {r["doc_id"]: r["n_shingles"] for r in got if r["doc_id"] is not None} == {i: len(s[0]) for i, s in sets.items()}
    assert jj.linked_groups(make([])).count() == 0
    two = make([(1, "a b c d e f", "en", "s"), (1, "u v w x y z", "en", "s"), (2, "A b c d e f", "en", "s"), (3, "u v w x y z", "en", "s")])
    assert {r["component_id"] for r in jj.linked_groups(two).collect()} == {1}


def test_first_of_a_cluster_meets_every_block(make, monkeypatch):
    """A cluster of several blocks; the smallest id has two texts, and each ties members of its own; sets are stored for open clusters only."""
    monkeypatch.setattr(jj, "BLOCK", 4)
    stored = []
    items = jj._items
    monkeypatch.setattr(jj, "_items", lambda docs, ids, w: stored.append(ids.count()) or items(docs, ids, w))
    one, two = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(5, one, "en", "s"), (5, two, "en", "s")]
    rows += [(10 + i, f"{one if i % 2 else two} end{i}", "en", "s") for i in range(30)]
    rows += [(100, one.replace("a30", "zz"), "en", "s")]  # three of 58 shingles changed
    got = {r["doc_id"]: r["component_id"] for r in jj.linked_groups(make(rows)).collect()}
    assert got == {5: 5, **{10 + i: 5 for i in range(30)}, 100: 5}
    assert stored == [0]


def test_prefixes_share_what_near_sizes_need():
    """``_least`` holds under every order, and asks for far more than one shingle of sets of about a size."""
    rng = np.random.default_rng(5)
    level = rng.integers(0, 5, 1 << jj.BITS).astype(np.uint8)
    tight = 0
    for _ in range(400):
        s = np.unique(rng.integers(0, 1 << 63, int(rng.integers(1, 600))).astype(np.uint64))
        t = np.unique(np.r_[s[rng.random(s.size) < rng.uniform(0.9, 1)], rng.integers(0, 1 << 63, int(rng.integers(0, 20))).astype(np.uint64)])
        both = np.intersect1d(s, t).size
        if t.size and 100 * both >= 90 * (s.size + t.size - both):
            need = jj._least(s.size, t.size, max(s.size, t.size), 90, 100)
            assert need >= 1
            for x, y in zip(jj.prefixes(s, level, 90, 100), jj.prefixes(t, level, 90, 100)):
                met = np.intersect1d(x, y).size
                assert met >= need
                tight += met < 2 * need
    assert tight
    assert jj._least(1000, 1000, 1000, 90, 100) == 49 and jj._least(1000, 900, 1000, 90, 100) == 1


@pytest.mark.parametrize("listed", [0, 32])
def test_chance_meetings_move_no_sets(make, monkeypatch, listed):
    """Long texts with a few rare passages in common are no candidates: their sets are not stored, in listed buckets nor in
    blocks; prefixes go to blocks for the large buckets only; shuffle files go with each step, and the session's choice is back."""
    monkeypatch.setattr(jj, "LISTED", listed)
    monkeypatch.setattr(jj, "rarity", lambda docs, w: np.zeros(1 << jj.BITS, np.uint8))  # any order is valid: passages stand in prefixes
    stored, opened, dropped = [], [], []
    items, block_pass, written = jj._items, jj._block_pass, jj.written
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    monkeypatch.setattr(jj, "_items", lambda docs, ids, w: stored.append(ids.count()) or items(docs, ids, w))
    monkeypatch.setattr(jj, "_block_pass", lambda o, *a: opened.append(o.count()) or block_pass(o, *a))
    monkeypatch.setattr(jj, "written", lambda df, name: dropped.append(df.sparkSession.conf.get(key)) or written(df, name))
    rnd = random.Random(9)
    passages = [" ".join(f"p{g}x{i}" for i in range(40)) for g in range(12)]
    rows = []
    for i in range(60):
        own = [f"d{i}w{k}" for k in range(400)]
        rows.append((i, " ".join([*own[:200], *rnd.sample(passages, 4), *own[200:]]), "en", "s"))
    rows.append((100, rows[7][1] + " end", "en", "s"))
    docs = make(rows)
    docs.sparkSession.conf.set(key, "false")
    try:
        got = {r["doc_id"]: r["component_id"] for r in jj.linked_groups(docs).collect()}
        assert docs.sparkSession.conf.get(key) == "false"
    finally:
        docs.sparkSession.conf.unset(key)
    assert got == {**{i: i for i in range(60)}, 100: 7}
    assert stored == [0]
    assert (opened[0] == 0) == (listed == 32)
    assert set(dropped) == {"true"}


@pytest.mark.parametrize("texts", [1, 2])
def test_small_and_large_buckets_together(make, monkeypatch, texts):
    """Pairs whose common buckets are partly listed and partly large; with a smallest doc_id of two texts, each near members of its own."""
    monkeypatch.setattr(jj, "LISTED", 4)
    monkeypatch.setattr(jj, "BLOCK", 4)
    rnd = random.Random(texts)
    vocab = [f"w{i}" for i in range(4000)]
    rows = []
    for g in range(14):
        head = [rnd.choice(vocab) for _ in range(40)] if g % 3 == 0 else head  # three groups share their beginning
        base = head + [rnd.choice(vocab) for _ in range(rnd.randrange(20, 160))]
        for _ in range(rnd.randrange(3, 16)):
            x = list(base)
            for _ in range(rnd.randrange(0, 4)):
                x[rnd.randrange(len(x))] = rnd.choice(vocab)
            rows.append((len(rows) * 7 % 1009, " ".join(x[:rnd.randrange(len(x) * 93 // 100, len(x)) + 1])))
    rnd.shuffle(rows)
    want, _ = groups_by_force(rows, 3, 90, 100)
    want = {i + 1: c + 1 for i, c in want.items()}
    rows = [(i + 1, t) for i, t in rows]
    if texts == 2:
        ends = {want[rows[0][0]], want[rows[-1][0]]}
        want = {0: 0, **{i: 0 if c in ends else c for i, c in want.items()}}
        rows += [(0, rows[0][1]), (0, rows[-1][1])]
    assert {r["doc_id"]: r["component_id"] for r in jj.linked_groups(make([(i, t, "en", "s") for i, t in rows])).collect()} == want


def test_crowded_buckets_make_no_pairs(make, monkeypatch):
    """Texts of one size that share crowded passages: no pair is listed, and only the near copies' texts are joined."""
    monkeypatch.setattr(jj, "rarity", lambda docs, w: np.zeros(1 << jj.BITS, np.uint8))  # counters that see no frequency
    listed, picked = [], []
    passing, among = jj._passing, jj._among

    def picking(rows, name, ids):
        if "text" in rows.columns:
            picked.append({r[0] for r in among(rows, name, ids).select(name).collect()})
        return among(rows, name, ids)
    monkeypatch.setattr(jj, "_passing", lambda p, *a: listed.append(p.count()) or passing(p, *a))
    monkeypatch.setattr(jj, "_among", picking)
    rnd = random.Random(3)
    passages = [" ".join(f"p{g}x{i}" for i in range(20)) for g in range(6)]
    rows = [(i, " ".join([*rnd.sample(passages, 2), *(f"d{i}w{k}" for k in range(400))]), "en", "s") for i in range(60)]
    rows.append((100, rows[7][1] + " end", "en", "s"))
    got = {r["doc_id"]: r["component_id"] for r in jj.linked_groups(make(rows)).collect()}
    assert got == {**{i: i for i in range(60)}, 100: 7}
    assert listed[1] == 0
    assert picked == [{7, 100}, set()]


def test_similar_sets_meet_in_buckets_of_a_high_rank(make):
    """However buckets crowd, a linked pair meets in ``_seen`` or more of those that are ``_far_enough``."""
    from pyspark.sql import functions as F
    rnd = np.random.default_rng(6)
    level = np.zeros(1 << jj.BITS, np.uint8)
    common = rnd.integers(0, 1 << 63, 60).astype(np.uint64)
    sets = []
    for _ in range(30):
        base = np.unique(np.r_[rnd.choice(common, int(rnd.integers(0, 60)), False), rnd.integers(0, 1 << 63, int(rnd.integers(5, 300))).astype(np.uint64)])
        sets += [np.unique(np.r_[base[rnd.random(base.size) < rnd.uniform(0.92, 1)], rnd.integers(0, 1 << 63, int(rnd.integers(0, 6))).astype(np.uint64)]) for _ in range(4)]
    spark = make([]).sparkSession
    heads = spark.createDataFrame([(i, s.size, False, [int(v) for v in jj.prefixes(s, level, 90, 100)[0].view(np.int64)]) for i, s in enumerate(sets)],
                                  "id long, n_shingles long, several boolean, first array<long>")
    ranked = jj._ranked(heads)
    x, y = (ranked.select("key", *(F.col(c).alias(c + k) for c in ("id", "n", "rank"))) for k in "ab")
    need = jj._need(F.col("na"), F.col("nb"), 90, 100)
    met = (x.join(y, "key").filter("ida < idb").groupBy("ida", "idb", "na", "nb")
           .agg(F.sum(jj._far_enough(F.col("ranka"), F.col("rankb"), need).cast("long")).alias("c")).select("*", need.alias("need"), jj._seen(need).alias("seen")).collect())
    met = {(r["ida"], r["idb"]): r for r in met}
    linked = [(i, j) for j in range(len(sets)) for i in range(j) if jj._linked(sets[i], sets[j], 90, 100)]
    assert len(linked) > 60 and any(r["c"] == 0 for r in met.values())
    for i, j in linked:
        r = met[i, j]
        assert r["need"] == jj._least(sets[i].size, sets[j].size, max(sets[i].size, sets[j].size), 90, 100)
        assert r["c"] >= r["seen"] >= 1


def test_leader_of_two_texts_is_held_by_both(make, monkeypatch):
    """The smaller text of the smallest doc_id stands in every bucket of the larger one, and is too small for its copy."""
    monkeypatch.setattr(jj, "rarity", lambda docs, w: np.zeros(1 << jj.BITS, np.uint8))
    level = np.zeros(1 << jj.BITS, np.uint8)

    def first(words):
        s = next(jj.sets_of(*jj.column_bytes(jj.pa.array([" ".join(words)])), 3))
        return set(jj.prefixes(s, level, 90, 100)[0].tolist())
    k = next(k for k in range(1000) if first(f"k{k}w{i}" for i in range(30)) == first(f"k{k}w{i}" for i in range(27)) == first(f"k{k}w{i}" for i in range(31)))
    rows = [(d, " ".join(f"k{k}w{i}" for i in range(m)), "en", "s") for d, m in ((1, 27), (1, 30), (2, 31))]
    assert {r["doc_id"]: r["component_id"] for r in jj.linked_groups(make(rows)).collect()} == {1: 1, 2: 1}


def test_among_picks_all_and_few_others(make):
    from pyspark.sql import functions as F
    spark = make([]).sparkSession
    rows = spark.range(-5000, 200_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("id")).union(spark.createDataFrame([(None, "x")], "doc_id long, id string"))
    ids = spark.range(-5000, 200_000, 7)
    got = [r[0] for r in jj._among(rows, "doc_id", ids).collect()]
    want = set(range(-5000, 200_000, 7))
    assert want <= set(got) and len(got) == len(set(got)) < 1.02 * len(want)  # one other in 573
    assert jj._among(rows, "doc_id", spark.range(0)).count() == 0


def test_merged_equals_components_of_all(make):
    spark = make([]).sparkSession
    rnd = random.Random(8)
    old, new = ([(rnd.randrange(300), rnd.randrange(300)) for _ in range(n)] for n in (120, 60))
    frame = [spark.createDataFrame([(min(p), max(p)) for p in e], "a long, b long") for e in (old, new, old + new)]
    want = {tuple(r) for r in jj.components(frame[2]).collect()}
    assert {tuple(r) for r in jj._merged(jj.components(frame[0]), frame[1]).collect()} == want
