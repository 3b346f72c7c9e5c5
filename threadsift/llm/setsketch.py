"""Near-duplicate groups by SetSketch registers (operator 4).

Each document's word shingles make a set.  A register holds the minimum of an exponential hash
over the set, on an exponentially spaced, truncated grid: ``K = clip(floor(1 - log_b(min)), 0, q+1)``.
Registers of a union are the maxima of the registers, and two sets agree in a register with a
probability close to their Jaccard similarity.

1. ``sketches``: one pass over the text gives size, a digest of the set and the registers.
   Equal sets (equal digests) become one class at once, by a map-side combined aggregation.
2. Registers are banded (``BANDS`` x ``ROWS``); a band's bucket has its smallest id as leader.
   Every member is compared with its leader only: linear in the bucket, whatever its size.
3. A pair is first estimated: the joint likelihood of (above, below, equal) register counts given
   both set sizes.  Only pairs whose likelihood at the threshold is within ``MARGIN`` nats of the
   maximum go on; those are verified exactly on their full sets.
4. Links form components.  A bucket whose members all share a component is settled.  Open ones are
   compared across components in blocks of ``BLOCK`` members inside tasks, twice: first only the
   likeliest partner of a member in each other component leaves a task, which ties nearly every
   member to its group; then, in the buckets still open, every pair that passes the likelihood is
   verified where it is found, on the sets that the blocks carry, once (in the first band it
   shares), and only links leave the task.  So no pair in a common bucket goes unchecked, and the
   pairs of a group are never listed.

At similarity 0.8 two documents share no bucket with probability (1 - 0.8**5)**40 = 1.2e-7.

Defined cases: null and word-less texts have an empty set, are linked with nothing and kept;
rows of one doc_id (repeated rows) are one node; a row without doc_id stays, with a null component;
an empty table gives an empty result; a very long text is one set, in memory in proportion to it;
extra columns are left out by name.  A group of the block comparison holds at most 2 * BLOCK members
of a bucket, whatever the bucket's size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsift.llm.text import column_bytes, lean, mix, row_edges, seeds, shingles, slices, span_hashes, word_spans, written

ROWS, BANDS = 5, 40
BASE_B, RATE_A, TOP_Q = 1.001, 20.0, (1 << 16) - 2
MARGIN = 14.0
BLOCK = 1024
SLICE = 1 << 19  # bytes of text at a time: a worker's arrays stay at some tens of MB
_MULT = seeds(ROWS * BANDS, 4) | np.uint64(1)
_XOR = seeds(ROWS * BANDS, 5)


def registers(s: np.ndarray) -> np.ndarray:
    """uint16 registers of a set of 64-bit hashes (not empty)."""
    low = np.full(_MULT.size, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, s.size, 1024):
        np.minimum(low, ((s[i:i + 1024, None] ^ _XOR) * _MULT).min(axis=0), out=low)
    u = (low.astype(np.float64) + 0.5) / 2.0**64
    x = -np.log1p(-np.minimum(u, 1 - 2.0**-53)) / RATE_A
    return np.clip(np.floor(1.0 - np.log(x) / np.log(BASE_B)), 0, TOP_Q + 1).astype(np.uint16)


def sets_of(data: np.ndarray, offs: np.ndarray, w: int, salt: int = 0) -> Iterator[np.ndarray]:
    """The sorted set of shingle hashes of each document of a slice."""
    starts, ends, rows = word_spans(data, offs)
    h, r = shingles(span_hashes(data, starts, ends, lower=True, salt=salt), rows, w)
    e = row_edges(r, offs.size - 1)
    for i in range(offs.size - 1):
        s = np.sort(h[e[i]:e[i + 1]])
        yield s[np.r_[True, s[1:] != s[:-1]]] if s.size else s


def sketches(docs: DataFrame, w: int) -> DataFrame:
    """doc_id, n_shingles, digest (of the set, by two independent hashes; null when empty), regs (binary)."""
    def run(batches):
        for b in batches:
            data, offs = column_bytes(b.column(1))
            n, dig, reg = [], [], []
            for _, _, d, o in slices(data, offs, SLICE):
                for s, t in zip(sets_of(d, o, w), sets_of(d, o, w, 1)):
                    n.append(s.size)
                    if s.size:
                        a, c = mix(s).sum(dtype=np.uint64), mix(t).sum(dtype=np.uint64)
                        dig.append(f"{int(a):016x}{int(c):016x}")
                        reg.append(registers(s).tobytes())
                    else:
                        dig.append(None)
                        reg.append(None)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(dig, pa.string()),
                                              pa.array(reg, pa.binary())], ["doc_id", "n_shingles", "digest", "regs"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(run), "doc_id long, n_shingles long, digest string, regs binary")


def _log_p(x: np.ndarray) -> np.ndarray:
    """-log_b(1 - x (b-1)/b): the chance that one register exceeds the other."""
    return np.maximum(-np.log1p(-np.maximum(x, 0) * (BASE_B - 1) / BASE_B) / np.log(BASE_B), 1e-300)


def may_reach(above: np.ndarray, below: np.ndarray, equal: np.ndarray, na: np.ndarray, nb: np.ndarray, threshold: float) -> np.ndarray:
    """Whether a similarity of ``threshold`` or more is within MARGIN nats of the likeliest one."""
    u = na / (na + nb)
    v = 1.0 - u
    top = np.minimum(u / v, v / u)

    def ll(j):
        p, q = _log_p(u - v * j), _log_p(v - u * j)
        return above * np.log(p) + below * np.log(q) + equal * np.log(np.maximum(1 - p - q, 1e-12))

    grid = np.linspace(0, 1, 65)[:, None] * top
    best = reduce(np.maximum, (ll(j) for j in grid))
    at = reduce(np.maximum, (ll(np.minimum(threshold + (top - threshold) * f, top)) for f in np.linspace(0, 1, 17)))
    return (top >= threshold - 1e-12) & (best - at <= MARGIN)


def _regs(col: pa.Array) -> np.ndarray:
    d, o = column_bytes(col)
    return np.frombuffer(d[o[0]:o[-1]].tobytes(), np.uint16).reshape(len(col), -1).astype(np.int32)


def _estimated(pairs: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose registers leave the threshold possible."""
    x = reps.select(F.col("id").alias("b"), F.col("n_shingles").alias("nb"), F.col("regs").alias("rb"))
    y = reps.select(F.col("id").alias("a"), F.col("n_shingles").alias("na"), F.col("regs").alias("ra"))
    near = F.least("na", "nb") * 1.0 >= F.greatest("na", "nb") * threshold * 0.999999

    def run(batches):
        for t in batches:
            if t.num_rows:
                ra, rb = _regs(t.column(3)), _regs(t.column(5))
                ok = may_reach((ra > rb).sum(1), (ra < rb).sum(1), (ra == rb).sum(1),
                               t.column(2).to_numpy().astype(float), t.column(4).to_numpy().astype(float), threshold)
                yield t.select([0, 1]).filter(pa.array(ok))
    return (pairs.join(x, "b").join(y, "a").filter(near).select("a", "b", "na", "ra", "nb", "rb")
            .mapInArrow(lean(run), "a long, b long"))


def _items(docs: DataFrame, ids: DataFrame, w: int) -> DataFrame:
    """(id, items): the sorted shingle hashes of the documents in ``ids``, from their whole texts."""
    def sets(batches):
        for t in batches:
            data, offs = column_bytes(t.column(1))
            out = [s.tobytes() for _, _, d, o in slices(data, offs, SLICE) for s in sets_of(d, o, w)]
            yield pa.RecordBatch.from_arrays([t.column(0), pa.array(out, pa.binary())], ["id", "items"])
    return written(docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(ids, "id", "left_semi")
                   .select("id", "text").mapInArrow(lean(sets), "id long, items binary"), "sets")


def _linked(p: np.ndarray, q: np.ndarray, num: int, den: int) -> bool:
    if p.size * den < num * q.size or q.size * den < num * p.size or not p.size or not q.size:
        return False
    at = np.searchsorted(p, q)
    both = int((p[np.minimum(at, p.size - 1)] == q).sum())
    return den * both >= num * (p.size + q.size - both)


def _verified(cand: DataFrame, full: DataFrame, num: int, den: int) -> DataFrame:
    """Candidate pairs that reach num/den on their full sets."""
    def exact(batches):
        for t in batches:
            ok = [_linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), num, den)
                  for x, y in zip(t.column(2), t.column(3))]
            yield t.select([0, 1]).filter(pa.array(ok, pa.bool_()))
    return (cand.join(full.select(F.col("id").alias("b"), F.col("items").alias("y")), "b")
            .join(full.select(F.col("id").alias("a"), F.col("items").alias("x")), "a")
            .select("a", "b", "x", "y").mapInArrow(lean(exact), "a long, b long"))


def components(edges: DataFrame) -> DataFrame:
    """(id, comp): the smallest id reachable, for every id of an edge (a, b).

    Each round takes the least label of the neighbours and then jumps to the label's own label, so
    the number of rounds is logarithmic for the chains and stars that near-duplicates form.  Every
    round is written to the shared folder; joins on a hub split by AQE's skew handling.
    """
    sym = written(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b"), F.col("a"))).distinct(), "edges")
    lab = written(sym.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("l")), "labels")
    while True:
        least = sym.join(lab.select(F.col("u").alias("v"), F.col("l").alias("lv")), "v").groupBy("u").agg(F.min("lv").alias("m"))
        met = written(lab.join(least, "u").select("u", F.least("l", "m").alias("k"), F.col("l").alias("was")), "met")
        new = written(met.join(met.select(F.col("u").alias("k"), F.col("k").alias("kk")), "k")
                      .select("u", F.col("kk").alias("l"), (F.col("kk") < F.col("was")).alias("moved")), "labels")
        if not new.filter("moved").limit(1).count():
            return new.select(F.col("u").alias("id"), F.col("l").alias("comp"))
        lab = new.select("u", "l")


def _with_comp(members: DataFrame, comp: DataFrame | None) -> DataFrame:
    if comp is None:
        return members.withColumn("comp", F.col("id"))
    return members.join(comp, "id", "left").withColumn("comp", F.coalesce("comp", "id"))


def _open_buckets(members: DataFrame, comp: DataFrame) -> DataFrame:
    """Members (key, band, id, comp, home) of buckets that still hold several components, without
    the leader, whose pairs are all known; ``home`` is its component."""
    m = _with_comp(members, comp)
    lead = m.filter("id = leader").select("key", F.col("comp").alias("home"))
    rest = written(m.filter("id <> leader").select("key", "band", "id", "comp"), "rest")
    span = rest.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
    keys = written(span.join(lead, "key").select("key", "home"), "open")
    return written(rest.join(keys, "key"), "open_members")


def _block_pairs(opened: DataFrame, heads: DataFrame, num: int, den: int, full: DataFrame | None = None) -> DataFrame:
    """Pairs of open buckets across components that pass the likelihood, compared in blocks.

    Without ``full``: each member's likeliest partner in its block.  With the sets in ``full`` (id,
    items): links, verified here; components that a link has joined count as one from then on.  Both
    are linear in the members of a block.
    """
    threshold, verify = num / den, full is not None
    size = opened.groupBy("key").agg(F.sum((F.col("comp") == F.col("home")).cast("long")).alias("n_in"),
                                     F.sum((F.col("comp") != F.col("home")).cast("long")).alias("n_out"))
    blocks = written(size.select("key", F.ceil(F.col("n_in") / BLOCK).alias("bi"), F.ceil(F.col("n_out") / BLOCK).alias("bo")), "blocks")
    inside = F.col("comp") == F.col("home")
    # blocks 0..bi-1 hold the leader's component, the rest the others; two inner blocks need no comparison
    own = F.when(inside, F.lit(0)).otherwise(F.col("bi")) + F.pmod(F.xxhash64("id"), F.greatest(F.when(inside, F.col("bi")).otherwise(F.col("bo")), F.lit(1)))
    partner = F.expr("CASE WHEN comp = home THEN IF(bo > 0, sequence(bi, bi + bo - 1), array()) ELSE sequence(0L, bi + bo - 1) END")
    laid = (opened.join(blocks, "key").withColumn("own", own).withColumn("other", F.explode(partner))
            .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "band", "own", "id", "comp")
            .join(heads.select("id", "n_shingles", "regs"), "id"))
    laid = laid.join(full, "id") if verify else laid.withColumn("items", F.lit(None).cast("binary"))
    n = int(laid.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = (laid.repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j")
            .select("key", "i", "j", "band", "own", "id", "comp", "n_shingles", "regs", "items"))
    # a pair at the threshold agrees in that share of its registers, give or take six deviations
    least = ROWS * BANDS * threshold - 6 * (ROWS * BANDS * threshold * (1 - threshold)) ** 0.5

    def compare(t: pa.Table):
        i, j, band = (t.column(c)[0].as_py() for c in (1, 2, 3))
        own, ids, comp = (t.column(c).to_numpy() for c in (4, 5, 6))
        comp = comp.copy()
        n, regs = t.column(7).to_numpy().astype(float), _regs(t.column(8)).astype(np.uint16)
        sets = [] if not verify else [np.frombuffer(v.as_buffer(), np.uint64) for v in t.column(9).combine_chunks()]
        left, right = np.flatnonzero(own == j), np.flatnonzero(own == i)  # block j is never an inner one
        for x in left:
            r = right[(comp[right] != comp[x]) & ((ids[right] > ids[x]) if i == j else True)]
            r = r[np.minimum(n[r], n[x]) >= threshold * 0.999999 * np.maximum(n[r], n[x])]
            if not r.size:
                continue
            a = regs[x]
            same = regs[r] == a
            equal = same.sum(1)
            go = equal >= least
            r, same, equal = r[go], same[go], equal[go]
            if not r.size:
                continue
            above = (regs[r] < a).sum(1)
            ok = may_reach(above, a.size - equal - above, equal, np.full(r.size, n[x]), n[r], threshold)
            r, same, equal = r[ok], same[ok], equal[ok]
            order = np.argsort(-equal, kind="stable")
            if not verify:
                yield from ((min(ids[x], ids[y]), max(ids[x], ids[y])) for y in r[order[:1]])
                continue
            first = same.reshape(-1, BANDS, ROWS).all(2).argmax(1) == band
            for y in r[order][first[order]]:
                if comp[y] != comp[x] and _linked(sets[x], sets[y], num, den):
                    comp[comp == comp[y]] = comp[x]
                    yield min(ids[x], ids[y]), max(ids[x], ids[y])

    def run(batches):
        held: list[pa.RecordBatch] = []
        last = None

        def flush():
            got = list(compare(pa.Table.from_batches(held)))
            return pa.RecordBatch.from_arrays([pa.array([int(p[k]) for p in got], pa.int64()) for k in (0, 1)], ["a", "b"])
        for b in batches:
            if not b.num_rows:
                continue
            k = np.stack([b.column(c).to_numpy() for c in range(3)], 1)
            cuts = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1), b.num_rows]
            for x, y in zip(cuts[:-1], cuts[1:]):
                key = tuple(k[x])
                if key != last and held:
                    yield flush()
                    held = []
                last = key
                held.append(b.slice(x, y - x))
        if held:
            yield flush()
    return laid.mapInArrow(lean(run), "a long, b long").distinct()


def near_groups(docs: DataFrame, w: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept (see the module docstring).

    Two documents are linked when ``den * |A & B| >= num * |A | B|`` on their ``w``-word shingle
    sets; ``component_id`` is the smallest doc_id of the connected documents, ``kept`` marks it.
    """
    threshold = num / den
    base = written(sketches(docs, w), "sketches")
    live = base.filter("digest is not null and doc_id is not null")
    reps = written(live.groupBy("digest").agg(F.min("doc_id").alias("id")), "classes")
    heads = written(live.join(reps.withColumnRenamed("id", "doc_id"), ["digest", "doc_id"], "left_semi")
                    .select(F.col("doc_id").alias("id"), "n_shingles", "regs"), "heads")
    keys = F.expr(f"transform(sequence(0, {BANDS - 1}), j -> xxhash64(j, substring(regs, j * {2 * ROWS} + 1, {2 * ROWS})))")
    bands = heads.select("id", F.posexplode(keys).alias("band", "key"))
    leaders = written(bands.groupBy("key").agg(F.min("id").alias("leader"), F.count("*").alias("n")).filter("n > 1").select("key", "leader"), "leaders")
    members = written(bands.join(leaders, "key"), "members")

    pairs = members.filter("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    cand = written(_estimated(pairs, heads, threshold), "candidates")
    # the sets of all that may still be compared are made once: candidates, and members of buckets
    # that hold others besides the leader
    crowded = members.groupBy("key").agg(F.count("*").alias("n")).filter("n > 2").select("key")
    ids = (cand.select(F.col("a").alias("id")).union(cand.select("b")).union(members.join(crowded, "key", "left_semi").select("id")).distinct())
    full = _items(docs, ids, w)

    # a doc_id with several texts ties its classes together
    mine = written(live.select("doc_id", "digest").distinct().join(reps, "digest").select("doc_id", "id"), "mine")
    several = mine.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("z")).filter("a <> z")
    links = _verified(cand, full, num, den).union(mine.join(several, "doc_id").filter("id <> a").select("a", F.col("id").alias("b")))
    links = written(links, "links")
    comp = components(links)
    for best in (True, False):
        opened = _open_buckets(members, comp)
        if not opened.limit(1).count():
            break
        if best:
            more = _verified(written(_block_pairs(opened, heads, num, den), "candidates"), full, num, den)
        else:
            more = _block_pairs(opened, heads, num, den, full)
        more = written(more, "links")
        if more.limit(1).count():
            links = written(links.union(more), "links")
            comp = components(links)
    node = _with_comp(mine, comp).groupBy("doc_id").agg(F.min("comp").alias("component_id"))
    node = written(node, "nodes")
    out = base.select("doc_id", "n_shingles").join(node, "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
