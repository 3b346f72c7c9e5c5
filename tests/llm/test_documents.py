"""op3, op4, op5, op6, op8 and op10 against brute force, and their defined edge cases."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import EDGES, WORDS
from threadsift.llm import importance, mixing, ordermin, setsketch, toxicity, weaksup
from threadsift.llm import text as text_tools

WORD = re.compile(r"[^\x20\x09-\x0D]+")


VOCAB = [a + b + c for a in "bdfgklmnprst" for b in ("a", "en", "io", "ur") for c in ("ta", "lo", "rin", "s", "mek")]


def prose(rnd, n, words=WORDS):
    return " ".join(rnd.choice(words) for _ in range(n))


# ---- helpers of the text kernel


def test_words_and_hashes():
    texts = ["One  two\tTWO", "", None, "é two", "\x1cthree\x85 x", "two"]
    data, offs = text_tools.column_bytes(pa.array(texts))
    starts, ends, rows = text_tools.word_spans(data, offs)
    got = [(int(r), data[a:b].tobytes().decode()) for a, b, r in zip(starts, ends, rows)]
    assert got == [(i, w) for i, t in enumerate(texts) for w in WORD.findall(t or "")]
    exact, low = (text_tools.span_hashes(data, starts, ends, lower=x) for x in (False, True))
    by = [w for _, w in got]
    two = [i for i, w in enumerate(by) if w == "two"]
    assert len(set(exact[two].tolist())) == 1 and exact[by.index("TWO")] != exact[two[0]] and low[by.index("TWO")] == low[two[0]]
    sliced = pa.array(["zz", *texts])[1:]
    d2, o2 = text_tools.column_bytes(sliced)
    assert [d2[a:b].tobytes() for a, b in zip(o2[:-1], o2[1:])] == [(t or "").encode() for t in texts]


# ---- operator 4


def groups_by_force(rows, w=2, num=80, den=100):
    def low(t):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    sets = collections.defaultdict(list)
    for i, t in rows:
        x = WORD.findall(low(t))
        sets[i].append({tuple(x[k:k + w]) for k in range(len(x) - w + 1)} if len(x) >= w else ({tuple(x)} if x else set()))
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and find(a) != find(b) and any(p and q and den * len(p & q) >= num * len(p | q) for p in sets[a] for q in sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}, sets


@pytest.mark.parametrize("w", [2, 5])
def test_near_groups_equal_brute_force(make, w, monkeypatch):
    monkeypatch.setattr(setsketch, "BLOCK", 8)  # several blocks even here
    rnd = random.Random(w)
    vocab = [f"w{i}" for i in range(4000)]
    rows = []
    for g in range(6):
        base = [rnd.choice(vocab) for _ in range(60)]
        for _ in range(25):  # a cloud of copies around the threshold
            x = list(base)
            for _ in range(rnd.randrange(0, 9 if w == 2 else 5)):
                x[rnd.randrange(60)] = rnd.choice(vocab)
            rows.append((len(rows) * 3 % 997 + 1, " ".join(x)))
    rows += [(2000 + i, prose(rnd, 40, vocab)) for i in range(20)] + [(3000, rows[3][1].upper()), (3001, rows[3][1]), (4000, "solo"), (4001, "SOLO"), (4002, None), (4003, " ")]
    rows = list({i: (i, t) for i, t in rows}.values())
    want, sets = groups_by_force(rows, w)
    got = {r["doc_id"]: r for r in setsketch.near_groups(make([(i, t, "en", "a") for i, t in rows]), w).collect()}
    assert len(got) == len(rows)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["kept"] == (want[i] == i) and r["n_shingles"] == len(sets[i][0]) for i, r in got.items())


def test_near_groups_edges(make):
    out = setsketch.near_groups(make(EDGES, extra=True), 2).collect()
    assert len(out) == len(EDGES)
    by = collections.defaultdict(list)
    for r in out:
        by[r["doc_id"]].append((r["n_shingles"], r["component_id"], r["kept"]))
    assert by[1] == [(0, 1, True)] and by[2] == [(0, 2, True)] and by[3] == [(0, 3, True)]
    assert by[5] == [(2, 5, True)] * 2 and by[6] == [(2, 5, False)]  # repeated rows are one node
    assert by[None] == [(3, None, True)]
    assert setsketch.near_groups(make([])).count() == 0
    # two texts of one doc_id tie their groups together
    out = setsketch.near_groups(make([(1, "a b c", "", ""), (1, "d e f", "", ""), (2, "a b c", "", ""), (3, "d e f", "", "")]), 2).collect()
    assert {r["component_id"] for r in out} == {1}


def test_registers_estimate_similarity():
    rnd = np.random.default_rng(2)
    n = setsketch.ROWS * setsketch.BANDS
    for j in (0.2, 0.5, 0.8, 0.95):
        equal = []
        for _ in range(30):
            u = text_tools.mix(rnd.integers(0, 1 << 63, 600, dtype=np.uint64))
            both = int(600 * j)
            rest = (600 - both) // 2
            a, b = u[:both + rest], np.r_[u[:both], u[both + rest:both + 2 * rest]]
            ra, rb = setsketch.registers(a), setsketch.registers(b)
            equal.append((ra == rb).mean())
            assert (np.maximum(ra, rb) == setsketch.registers(np.unique(np.r_[a, b]))).all()  # registers merge
        assert abs(np.mean(equal) - j) < 0.03
    ok = setsketch.may_reach(np.array([20, 70]), np.array([20, 70]), np.array([n - 40, n - 140]), np.array([500.0, 500]), np.array([500.0, 500]), 0.8)
    assert ok.tolist() == [True, False]


def test_components_of_chains_and_stars(spark):
    rnd = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(200, 200 + i) for i in range(1, 50)] + [(500, 499), (499, 300), (300, 160)]
    rnd.shuffle(edges)
    got = {r["id"]: r["comp"] for r in setsketch.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(got.values()) == {100, 200} and got[500] == 100 and got[249] == 200
    assert setsketch.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- operator 5


def counts_by_force(t):
    t = t or ""
    w = WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    at = collections.defaultdict(list)
    for k in range(len(w) - 7):
        at[tuple(w[k:k + 8])].append(k)
    marked = {k + j for ks in at.values() if len(ks) > 1 for k in ks for j in range(8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(marked)


def test_quality_counts_and_verdict(make):
    rnd = random.Random(4)
    good = [(100 + i, "\n".join(prose(rnd, 15, VOCAB) for _ in range(6)), "en", "a") for i in range(120)]
    signs = [(300 + i, " ".join(w + "$$" for w in prose(rnd, 60, VOCAB).split()), "en", "a") for i in range(10)]
    repeated = [(400 + i, (prose(rnd, 12) + "\n") * 5, "en", "a") for i in range(10)]
    rows = EDGES + good + signs + repeated + [(500, "a b\na b\n a b\n\na b", "en", "a"), (501, "x " * 9, "en", "a"), (502, "\n\n", "en", "a")]
    got = weaksup.digest(make(rows, extra=True)).collect()
    key = lambda r: (str(r[0]), *map(str, r[1:]))
    want = []
    for i, t, *_ in rows:
        c = counts_by_force(t)
        want.append((i, *c, c[0] < 20 or 100 * c[4] > 30 * c[0]))
    assert sorted((tuple(r)[:7] for r in got), key=key) == sorted(want, key=key)
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert all(kept[i] for i, *_ in good) and not any(kept[i] for i, *_ in signs + repeated)
    assert all(not r["kept"] for r in got if r["base_failed"])
    assert weaksup.digest(make([])).count() == 0


def test_em_finds_accuracies():
    rnd = np.random.default_rng(0)
    y = rnd.random(4000) < 0.85
    v = np.full((4000, 5), 2)
    for j in range(4):  # each rule notices a quarter of the bad rows and errs on 1 % of the good
        v[:, j][(~y & (rnd.integers(0, 4, 4000) == j)) | (y & (rnd.random(4000) < 0.01))] = 0
    v[:, 4] = np.where(rnd.random(4000) < np.where(y, 0.8, 0.05), 1, 2)
    pats, back, n = np.unique(v, axis=0, return_inverse=True, return_counts=True)
    post, rate, prior = weaksup.fit(pats, n.astype(float))
    assert abs(prior - 0.85) < 0.05 and ((post[back.ravel()] >= 0.5) == y).mean() > 0.93


# ---- operator 6


def mix_by_force(rows):
    sizes = collections.Counter()
    for _, t, _, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, free, target = 1.5 * sum(sizes.values()), set(names), {}
    while True:
        level = left / sum(w[s] for s in free) if free else 0
        over = {s for s in free if level * w[s] > 2 * sizes[s]}
        if not over:
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        free -= over
    return sizes, {**target, **{s: level * w[s] for s in free}}


def test_mix_targets_and_budgets(make):
    rnd = random.Random(6)
    rows = [(i, prose(rnd, rnd.randrange(0, 80)), "en", rnd.choice(["a", "a", "a", "b", "ü", None])) for i in range(300)] + EDGES
    sizes, target = mix_by_force(rows)
    out = mixing.mix(make(rows, extra=True), ["doc_id", "source"]).collect()
    assert len(out) == len(rows)
    taken = collections.Counter()
    for r in out:
        s = r["source"]
        assert r["source_size"] == sizes[s] and math.isclose(r["target"], target[s], rel_tol=1e-12)
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert all(taken[s] == math.floor(target[s] + 1e-9) for s in sizes)
    again = mixing.mix(make(rows, extra=True), ["doc_id", "source"]).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    full = mixing.mixed(make(rows, extra=True))
    assert full.columns == make(rows, extra=True).columns
    words = collections.Counter()
    for r in full.collect():
        words[r["source"]] += len(WORD.findall(r["text"]))
    assert {s: n for s, n in words.items() if n} == {s: n for s, n in taken.items() if n}
    assert mixing.mix(make([]), ["doc_id"]).count() == 0
    assert mixing.mix(make([(1, None, "en", "a"), (2, " ", "en", None)]), ["doc_id"]).filter("taken = 0 and target = 0").count() == 2


# ---- operator 8


def test_order_minhash_neighbours(make):
    rnd = random.Random(8)
    rows = [(i * 7 % 101, prose(rnd, rnd.randrange(0, 120)), "en", "a") for i in range(60)] + [(i + 200, t, la, s) for i, t, la, s in EDGES if i not in (None, 5)]
    got = {r["doc_id"]: r for r in ordermin.neighbours(make(rows, extra=True)).collect()}
    by = sorted(((i, t or "") for i, t, *_ in rows), reverse=True)
    assert len(got) == len(by)
    for k, (i, t) in enumerate(by):
        nxt = by[(k + 1) % len(by)][1]
        m = len(t) // 3
        edited = t[:len(t) - m] + nxt[:m]
        f, e, n = (ordermin.fingerprint(ordermin._codes(x)) for x in (t, edited, nxt))
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (ordermin._raw(f).hex(), ordermin._raw(e).hex())
        assert (r["near_edited"], r["near_next"]) == (ordermin.likeness(f, e), ordermin.likeness(f, n))
    # repeated rows, a row without id and a single row
    assert ordermin.neighbours(make(EDGES)).count() == len(EDGES)
    one = ordermin.neighbours(make([(1, "abcdef", "en", "a")])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0 and one[0]["n_chars"] == 6
    assert ordermin.neighbours(make([])).count() == 0


def test_order_minhash_follows_edits_and_order():
    rnd = random.Random(9)
    fp = lambda t: ordermin.fingerprint(ordermin._codes(t))
    near, far, turned = [], [], []
    for _ in range(20):
        t = prose(rnd, 200, [f"v{k}" for k in range(2000)])
        w = t.split()
        near.append(ordermin.likeness(fp(t), fp(" ".join(w[:100] + ["new"] + w[101:]))))
        far.append(ordermin.likeness(fp(t), fp(prose(rnd, 200, [f"u{k}" for k in range(2000)]))))
        turned.append(ordermin.likeness(fp(t), fp(" ".join(w[100:] + w[:100]))))
    assert np.mean(near) > 0.9 and np.mean(far) < 0.02 and np.mean(turned) < 0.65  # same k-mers, other order


# ---- operators 3 and 10


def labelled(rnd, n=400):
    vocab = [f"v{k}" for k in range(3000)]
    rows, lab = [], []
    for i in range(n):
        words = prose(rnd, rnd.randrange(30, 80), vocab).split()
        toxic = i % 8 == 0
        junk = i % 8 == 4
        if toxic:
            for _ in range(rnd.randrange(1, 4)):
                words.insert(rnd.randrange(len(words)), rnd.choice(["nastyword", "foulish", "foulest"]))
        if junk:
            words = [w + "$$%" for w in words]
        rows.append((i, " ".join(words), "en", "a"))
        if i % 3 != 2:
            lab.append((i, int(not junk), int(toxic)))
    return rows, lab


def test_toxicity_holds_out_and_learns(spark, make):
    rows, lab = labelled(random.Random(10), 900)
    labels = spark.createDataFrame(lab, "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in toxicity.judge(make(rows), labels).collect()}
    import zlib
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in out.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out.values())
    held = [(r["predicted"], int(i % 8 == 0)) for i, r in out.items() if r["held_out"]]
    assert sum(p == y for p, y in held) >= 0.97 * len(held)
    # labels of the held-out fold are never read
    wrong = spark.createDataFrame([(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in lab], "doc_id long, quality int, toxic int")
    again = {r["doc_id"]: r["score"] for r in toxicity.judge(make(rows), wrong).collect()}
    assert all(abs(again[i] - r["score"]) < 1e-9 for i, r in out.items())
    kept = toxicity.clean(make(rows, extra=True), labels)
    assert kept.columns == make(rows, extra=True).columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in out.items() if r["score"] < 0.5}


def test_toxicity_edges(spark, make):
    schema = "doc_id long, quality int, toxic int"
    none = spark.createDataFrame([(1, 1, 0), (None, None, None)], schema)
    out = toxicity.judge(make(EDGES, extra=True), none).collect()
    assert len(out) == len(EDGES) and {r["score"] for r in out} == {0.0}
    assert toxicity.judge(make([]), spark.createDataFrame([], schema)).count() == 0
    rows, lab = labelled(random.Random(11), 300)
    out = toxicity.judge(make(rows + [(i + 9000 if i else None, t, la, s) for i, t, la, s in EDGES]), spark.createDataFrame(lab + [(None, 1, 1), (5, None, None)], schema)).collect()
    empty = {r["score"] for r in out if r["doc_id"] in (9001, 9002, 9003)}
    assert len(out) == 300 + len(EDGES) and len(empty) == 1 and empty.pop() < 0.5


def test_negative_risk_turns_back():
    # two features, one of them in every positive row only: the fit must not run away
    rows = np.r_[np.arange(20), np.arange(20, 220, 2)]
    feats = np.r_[np.zeros(20, int), np.ones(100, int)]
    positive = np.arange(220) < 20
    w, b = toxicity.fit(rows, feats, positive, 2, 0.1)
    assert np.isfinite(w).all() and b < 0 < w[0] + b and w[1] + b < 0


def test_importance_resampling(spark, make):
    rows, lab = labelled(random.Random(12), 600)
    schema = "doc_id long, quality int, toxic int"
    labels = spark.createDataFrame(lab, schema)
    out = {r["doc_id"]: r for r in importance.resample(make(rows), labels).collect()}
    share = sum(q for _, q, _ in lab) / len(lab)
    assert sum(r["kept"] for r in out.values()) == round(share * len(rows))
    junk = [r["kept"] for i, r in out.items() if i % 8 == 4]
    assert sum(junk) <= 0.1 * len(junk)
    low = min(r["sample_key"] for r in out.values() if r["kept"])
    assert all(r["kept"] or r["sample_key"] <= low for r in out.values())
    # the weights are those of the plainly counted models
    ratio, _ = importance.log_ratio(make(rows), labels)
    data, offs = text_tools.column_bytes(pa.array([t for _, t, *_ in rows]))
    g, r = importance._grams(data, offs)
    w = np.bincount(r, ratio[g], minlength=len(rows))
    assert all(abs(out[i]["log_weight"] - w[k]) < 1e-6 for k, (i, *_) in enumerate(rows))
    edge = importance.resample(make(EDGES, extra=True), spark.createDataFrame([], schema)).collect()
    assert len(edge) == len(EDGES) and all(r["kept"] and r["log_weight"] == 0 for r in edge)
    assert importance.resample(make([]), labels).count() == 0


def test_gumbel_sample_is_proportional(spark):
    # of rows with weights 1 and 3, equally many, a draw of few takes about three of the second for one of the first
    from pyspark.sql import functions as F
    d = spark.range(40_000).select(F.col("id").alias("doc_id"))
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(importance.NOISE_SEED)), 12).cast("double") + 0.5) / float(1 << 52)
    w = F.when(F.col("doc_id") % 2 == 0, F.lit(math.log(3.0))).otherwise(F.lit(0.0))
    top = d.withColumn("k", w - F.log(-F.log(u))).orderBy(F.desc("k")).limit(2000)
    heavy = top.filter("doc_id % 2 = 0").count()
    assert 1420 < heavy < 1580


# ---- words that collide in any polynomial modulo 2 ** 64


def test_words_alike_under_a_polynomial(make):
    a = "".join("ab"[i.bit_count() % 2] for i in range(1024))
    b = "".join("ba"[i.bit_count() % 2] for i in range(1024))
    rows = [(1, f"{a} x", "en", "s"), (2, f"{b} x", "en", "s"), (3, f"{a}\n{b}", "en", "s"), (4, f"{a}\n{a}", "en", "s")]
    comp = {r["doc_id"]: r["component_id"] for r in setsketch.near_groups(make(rows), 2).collect()}
    assert comp == {i: i for i in (1, 2, 3, 4)}
    dup = {r["doc_id"]: r["n_dup_lines"] for r in weaksup.judge(make(rows)).collect()}
    assert dup == {1: 0, 2: 0, 3: 0, 4: 1}


def test_passages_of_one_hash_are_told_apart(monkeypatch):
    """Two independent hashes decide; here the first one always agrees."""
    real = weaksup.span_hashes
    monkeypatch.setattr(weaksup, "span_hashes", lambda d, a, b, salt=0: real(d, a, b, salt=1) if salt else np.ones(a.size, np.uint64))
    words = [f"w{i}" for i in range(40)]
    data, offs = text_tools.column_bytes(pa.array([" ".join(words), "\n".join(words[:9] * 2)]))
    got = weaksup._counts(data, offs)
    assert [got[weaksup.COUNTS.index(c)].tolist() for c in ("n_dup_lines", "n_repeat_words", "n_stutter")] == [[0, 9], [0, 18], [0, 0]]
