"""Similarity join on word n-grams by several global token orders (operator 11).

Two sets of n and m shingles with Jaccard similarity t share t / (1 + t) * (n + m) of them.  So under
ANY order of all shingles the first ``n - ceil(t * n) + 1`` of the one and the first ``m - ceil(t * m) + 1``
of the other have one in common.  Candidates must pass that test under ``ORDERS`` orders at once.
The nearer the sizes, the more they must share: what the one has in the prefix that ends first and the
other lacks is at most what the whole sets may differ in (``_least``), for equal sizes near half a prefix.

An order puts rare shingles first and breaks ties by a hash of its own, so the orders differ wherever
frequency does not decide.  Frequencies come from ``1 << BITS`` counters over all documents, reduced to
one byte each: what travels to the tasks has a fixed size, and since any order is valid, the counters
weigh on the speed and never on the result.

1. Equal sets (by a digest of two independent hashes) become one class; one member goes on.
2. Each shingle in a prefix of the first order is a bucket, with its smallest id as leader.  Members are
   held against their leader only: linear in the bucket.  Cheap tests come first: the sizes, and the
   most that two sets can share given where the common shingle stands in both; then the prefixes of the
   other orders.  Pairs that pass tie documents into clusters.
3. Buckets that still hold several clusters are compared across clusters by the same tests.  Those of
   at most ``LISTED`` members list their pairs as ids, and a pair's buckets are counted before any prefix
   moves; larger ones are compared inside tasks in blocks of ``BLOCK`` members.  The counters have a fixed
   size and miss more frequent shingles as the corpus grows, but the members of each bucket are known now:
   of the buckets that two sets must share, the j-th most crowded is at best the j-th most crowded of either
   (its ``rank``), so no pair is listed for a bucket of a low rank in one of them (``_far_enough``).  Now
   every linked pair has both ends in one cluster, and every document stands in one cluster only: full sets
   move once a block.
4. Within a cluster, sets are compared in full: first each with the cluster's smallest id, which goes to
   every block of members, so that a set moves once and is not stored; then, where that leaves several
   components, across components in blocks.

What leaves a task is linear in its members (an edge that joins two groups makes them one from then
on; a listed bucket has at most ``LISTED`` pairs a member), and no pair that can be linked goes unchecked.
Texts, sets and prefixes that few rows need are picked by ``_among`` before they are joined.
Each step ends in a written table, and its shuffle files go with it.

Defined cases: null and word-less texts have an empty set and are linked with nothing; rows of one
doc_id (repeated rows) are one node; a row without doc_id has a null component; ties in an order fall by
hash; an empty table gives an empty result; a very long text is one set, in memory in proportion to it;
extra columns are left out by name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadsift.llm.setsketch import _items, _linked, components, sets_of
from threadsift.llm.text import column_bytes, lean, mix, seeds, slices, written
from threadsift.session import shuffles_dropped

ORDERS = 3
BITS = 19
BLOCK = 512
LISTED = 512
MARKS = 1 << 24
SLICE = 1 << 19
_CHUNK = 1 << 13
_SEED = seeds(ORDERS, 21)
_TOP = np.uint64(64 - BITS)


def rarity(docs: DataFrame, w: int) -> np.ndarray:
    """A level for each counter: 0 for what is as frequent as chance makes it, then one more for each
    doubling of the excess.  ``1 << BITS`` bytes on the driver, whatever the corpus."""
    def count(batches):
        total = np.zeros(1 << BITS, np.int64)
        for b in batches:
            data, offs = column_bytes(b.column(0))
            for _, _, d, o in slices(data, offs, SLICE):
                h = np.concatenate(list(sets_of(d, o, w)))
                total += np.bincount((h >> _TOP).astype(np.int64), minlength=total.size)
        rows = []
        for c in range(0, total.size, _CHUNK):
            part = total[c:c + _CHUNK]
            at = np.flatnonzero(part)
            if at.size:
                rows.append((c // _CHUNK, at.astype(np.uint16).tobytes(), part[at].astype(np.int64).tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.binary(), pa.binary()))], ["chunk", "at", "n"])

    def add(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for c, at, n in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                held.setdefault(c, np.zeros(_CHUNK, np.int64))[np.frombuffer(at.as_buffer(), np.uint16)] += np.frombuffer(n.as_buffer(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([v.tobytes() for v in held.values()], pa.binary())], ["chunk", "n"])
    got = (docs.select("text").mapInArrow(count, "chunk int, at binary, n binary").repartition((1 << BITS) // _CHUNK, "chunk")
           .mapInArrow(add, "chunk int, n binary").collect())
    total = np.zeros(1 << BITS, np.int64)
    for r in got:
        total[r["chunk"] * _CHUNK:(r["chunk"] + 1) * _CHUNK] = np.frombuffer(r["n"], np.int64)
    mean = total.mean()
    excess = total - mean - 6 * np.sqrt(mean)
    return np.where(excess < 1, 0, 1 + np.floor(np.log2(np.maximum(excess, 1)))).astype(np.uint8)


def prefixes(s: np.ndarray, level: np.ndarray, num: int, den: int) -> list[np.ndarray]:
    """The prefix of a set under each order, in that order."""
    p = s.size + (-num * s.size) // den + 1
    rare = level[(s >> _TOP).astype(np.int64)].astype(np.uint64) << np.uint64(58)
    out = []
    for seed in _SEED:
        place = rare | (mix(s ^ seed) >> np.uint64(6))
        at = np.argpartition(place, p - 1)[:p] if p < s.size else np.arange(s.size)
        out.append(s[at[np.argsort(place[at], kind="stable")]])
    return out


def _prefixed(docs: DataFrame, w: int, num: int, den: int, level: np.ndarray) -> DataFrame:
    """doc_id, n_shingles, digest, first (prefix of the first order), others (the others', as sorted uint32)."""
    def run(batches):
        for b in batches:
            data, offs = column_bytes(b.column(1))
            n, dig, first, lens, others = [], [], [], [], []
            for _, _, d, o in slices(data, offs, SLICE):
                for s, t in zip(sets_of(d, o, w), sets_of(d, o, w, 1)):
                    n.append(s.size)
                    if s.size:
                        dig.append(f"{int(mix(s).sum(dtype=np.uint64)):016x}{int(mix(t).sum(dtype=np.uint64)):016x}")
                        p = prefixes(s, level, num, den)
                        first.append(p[0])
                        others.append(b"".join(np.sort((x >> np.uint64(16)).astype(np.uint32)).tobytes() for x in p[1:]))
                    else:
                        dig.append(None)
                        first.append(s)
                        others.append(None)
                    lens.append(first[-1].size)
            cut = np.r_[0, np.cumsum(np.array(lens, np.int64))].astype(np.int32)
            flat = np.concatenate(first).view(np.int64) if first else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(dig, pa.string()),
                                              pa.ListArray.from_arrays(pa.array(cut), pa.array(flat)), pa.array(others, pa.binary())],
                                             ["doc_id", "n_shingles", "digest", "first", "others"])
    return (docs.select(F.col("doc_id").cast("long"), "text")
            .mapInArrow(run, "doc_id long, n_shingles long, digest string, first array<long>, others binary"))


def _may_share(na: Column, ia: Column, nb: Column, ib: Column, num: int, den: int) -> Column:
    """Whether sets of na and nb shingles, with one in common at places ia and ib of the first order, can reach num/den."""
    most = F.least(ia, ib) + F.least(na - ia, nb - ib)
    return (den * F.least(na, nb) >= num * F.greatest(na, nb)) & ((num + den) * most >= num * (na + nb))


def _least(na, nb, top, num: int, den: int):
    """How many shingles the prefixes of sets of na and nb, ``top`` the larger, share under any order if the sets reach
    num/den: integers, at least one where the sizes allow it."""
    return 1 - (-num * (na + nb)) // (num + den) + (-num * top) // den


def _need(na: Column, nb: Column, num: int, den: int) -> Column:
    """``_least`` of two columns of sizes."""
    return 1 + F.ceil(num * (na + nb) / (num + den)) - F.ceil(num * F.greatest(na, nb) / den)


def _far_enough(ra: Column, rb: Column, need: Column) -> Column:
    """Whether a bucket, the ra-th and rb-th most crowded of two sets, is one to look at: of the ``need`` or more
    buckets that they share if they are similar, all are but half of ``need`` less one, rounded up (``_seen``)."""
    return F.least(ra, rb) >= F.ceil(need / 2)


def _seen(need: Column) -> Column:
    """In how many buckets that are ``_far_enough`` similar sets meet at least."""
    return need - F.ceil(need / 2) + 1


def _among(rows: DataFrame, name: str, ids: DataFrame) -> DataFrame:
    """The rows whose column ``name`` is one of the ``id`` of ``ids``, and a few others: one in MARKS / (number of
    ids).  So what a join with ids moves is in proportion to them.  The ids are marked in MARKS bits, broadcast
    in words: at most MARKS / 64 rows, whatever the corpus."""
    mark = F.pmod(F.xxhash64("id"), F.lit(MARKS))
    marks = (ids.select(F.shiftright(mark, 6).alias("word_"), F.expr(f"shiftleft(1L, CAST(pmod(xxhash64(id), {MARKS}) % 64 AS INT))").alias("bit_"))
             .groupBy("word_").agg(F.bit_or("bit_").alias("bits_")))
    own = F.pmod(F.xxhash64(F.col(name).cast("long")), F.lit(MARKS))
    return rows.join(F.broadcast(marks), (F.shiftright(own, 6) == F.col("word_")) & (F.getbit("bits_", (own % 64).cast("int")) == 1), "left_semi")


def _orders(col: pa.Array) -> list[list[np.ndarray]]:
    """For each row, the sorted prefixes of the other orders."""
    out = []
    for v in col:
        x = np.frombuffer(v.as_buffer(), np.uint32)
        out.append(np.split(x, ORDERS - 1))
    return out


def _meet(x: np.ndarray, y: np.ndarray) -> int:
    at = np.searchsorted(x, y)
    return int((x[np.minimum(at, x.size - 1)] == y).sum())


def _passing(pairs: DataFrame, heads: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) whose prefixes share enough under the other orders too."""
    def run(batches):
        for t in batches:
            na, nb = t.column(4).to_numpy(), t.column(5).to_numpy()
            need = np.maximum(_least(na, nb, np.maximum(na, nb), num, den), 1)
            ok = [all(_meet(p, q) >= c for p, q in zip(x, y)) for x, y, c in zip(_orders(t.column(2)), _orders(t.column(3)), need)]
            yield t.select([0, 1]).filter(pa.array(ok, pa.bool_()))
    heads = _among(heads, "id", pairs.select(F.explode(F.array("a", "b")).alias("id")))
    return (pairs.join(heads.select(F.col("id").alias("b"), F.col("others").alias("y"), F.col("n_shingles").alias("nb")), "b")
            .join(heads.select(F.col("id").alias("a"), F.col("others").alias("x"), F.col("n_shingles").alias("na")), "a")
            .select("a", "b", "x", "y", "na", "nb").mapInArrow(lean(run), "a long, b long"))


def _ranked(heads: DataFrame) -> DataFrame:
    """Members (key, id, n, pos, several, rank) of the buckets of two or more; ``rank`` 1 is the most crowded bucket of
    an id, with the buckets of all its texts, so that no text has a higher rank on its own."""
    rows = heads.select("id", F.col("n_shingles").cast("int").alias("n"), "several", F.posexplode("first").alias("pos", "key"))
    crowds = written(rows.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1"), "crowds")
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("c"), "key"))
    return written(rows.join(crowds, "key").select("key", "id", "n", "pos", "several", rank.alias("rank")), "ranked")


def _listed(opened: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) across components in open groups of at most LISTED members, that stand together in as many of them
    as similar sets do.  A pair that also meets in a larger group is compared there, and one with a group's
    leader was held against it: so the groups counted here are all that matter to a pair.
    Pairs of an id with several texts pass uncounted."""
    x, y = (opened.select("key", "id", F.col("n").cast("long").alias("n"), F.col("pos").cast("long").alias("pos"), "comp", "rank", "several").alias(k) for k in "xy")
    size = F.col("x.n"), F.col("y.n")
    near = _may_share(size[0], F.col("x.pos"), size[1], F.col("y.pos"), num, den) & _far_enough(F.col("x.rank"), F.col("y.rank"), _need(*size, num, den))
    met = (x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.id") < F.col("y.id")) & (F.col("x.comp") != F.col("y.comp")) & near)
           .select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), size[0].alias("na"), size[1].alias("nb"),
                   (F.col("x.several") | F.col("y.several")).alias("several")))
    return (met.groupBy("a", "b", "na", "nb").agg(F.count("*").alias("c"), F.max("several").alias("several"))
            .filter((F.col("c") >= _seen(_need(F.col("na"), F.col("nb"), num, den))) | F.col("several")).select("a", "b").distinct())


def _merged(comp: DataFrame, more: DataFrame) -> DataFrame:
    """comp (id, comp) with the edges (a, b) of ``more``: only components that an edge joins are looked at again."""
    ends = more.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(comp, "id", "left_anti")
    known = written(comp.select("id", "comp").union(ends.select("id", F.col("id").alias("comp"))), "known")
    at = [known.select(F.col("id").alias(x), F.col("comp").alias("c" + x)) for x in "ab"]
    over = components(written(more.join(at[0], "a").join(at[1], "b").filter("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct(), "merges"))
    top = over.select(F.col("id").alias("comp"), F.col("comp").alias("top"))
    return written(known.join(top, "comp", "left").select("id", F.coalesce("top", "comp").alias("comp")), "merged")


def _open(members: DataFrame, comp: DataFrame) -> DataFrame:
    """Members (key, id, n, pos, rank, several, comp, home, many) of groups that still hold several components, without the
    leader, whose pairs are all known; ``home`` is its component, ``many`` the number of members."""
    m = members.join(comp, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    lead = m.filter("id = leader").select("key", F.col("comp").alias("home"))
    rest = written(m.filter("id <> leader").select("key", "id", "n", "pos", "rank", "several", "comp"), "rest")
    span = rest.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("many")).filter("lo <> hi")
    return written(rest.join(span.join(lead, "key").select("key", "home", "many"), "key"), "open")


def _block_pass(opened: DataFrame, heads: DataFrame, num: int, den: int, full: DataFrame | None = None) -> DataFrame:
    """Open groups in blocks, across components: pairs (a, b) that pass all filters, or with the sets in
    ``full`` (id, items) pairs that are linked.  Components that a pair has joined count as one from
    then on, so a block gives fewer pairs than it has members."""
    inside = F.col("comp") == F.col("home")
    size = opened.groupBy("key").agg(F.sum(inside.cast("long")).alias("n_in"), F.sum((~inside).cast("long")).alias("n_out"))
    blocks = written(size.select("key", F.ceil(F.col("n_in") / BLOCK).alias("bi"), F.ceil(F.col("n_out") / BLOCK).alias("bo")), "blocks")
    # blocks 0..bi-1 hold the leader's component, the rest the others; two inner blocks need no comparison
    own = F.when(inside, F.lit(0)).otherwise(F.col("bi")) + F.pmod(F.xxhash64("id"), F.greatest(F.when(inside, F.col("bi")).otherwise(F.col("bo")), F.lit(1)))
    partner = F.expr("CASE WHEN comp = home THEN IF(bo > 0, sequence(bi, bi + bo - 1), array()) ELSE sequence(0L, bi + bo - 1) END")
    # prefixes and sets join last, so that each moves only to the blocks it goes to
    laid = (opened.join(blocks, "key").withColumn("own", own).withColumn("other", F.explode(partner))
            .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "comp", "n", "pos")
            .join(_among(heads.select("id", "others"), "id", opened), "id"))
    laid = laid.join(full, "id") if full is not None else laid.withColumn("items", F.lit(None).cast("binary"))
    laid = laid.select("key", "i", "j", "own", "id", "comp", "n", "pos", "others", "items")
    parts = int(laid.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = laid.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j")
    verify = full is not None

    def compare(t: pa.Table):
        i, j = t.column(1)[0].as_py(), t.column(2)[0].as_py()
        own, ids, comp, n, pos = (t.column(c).to_numpy() for c in (3, 4, 5, 6, 7))
        comp, n, pos = comp.copy(), n.astype(np.int64), pos.astype(np.int64)
        pre = _orders(t.column(8).combine_chunks())
        sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in t.column(9).combine_chunks()] if verify else []
        left, right = np.flatnonzero(own == j), np.flatnonzero(own == i)
        if not left.size or not right.size:
            return
        tokens = []  # of each other order: the right side's tokens in order, and whose they are
        for k in range(ORDERS - 1):
            flat = np.concatenate([pre[y][k] for y in right])
            who = np.repeat(right, [pre[y][k].size for y in right])
            order = np.argsort(flat, kind="stable")
            tokens.append((flat[order], who[order]))
        for x in left:
            go = np.zeros(own.size, bool)
            most = np.minimum(pos[right], pos[x]) + np.minimum(n[right] - pos[right], n[x] - pos[x])
            go[right] = ((comp[right] != comp[x]) & (den * np.minimum(n[right], n[x]) >= num * np.maximum(n[right], n[x]))
                         & ((num + den) * most >= num * (n[right] + n[x])) & ((ids[right] > ids[x]) if i == j else True))
            need = np.maximum(_least(n, n[x], np.maximum(n, n[x]), num, den), 1)
            for k, (flat, who) in enumerate(tokens):
                if not go.any():
                    break
                lo, hi = np.searchsorted(flat, pre[x][k], "left"), np.searchsorted(flat, pre[x][k], "right")
                some = hi > lo
                lo, many = lo[some], (hi - lo)[some]
                at = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + np.repeat(lo, many)
                go &= np.bincount(who[at], minlength=own.size) >= need
            for y in np.flatnonzero(go):
                if comp[y] != comp[x] and (not verify or _linked(sets[x], sets[y], num, den)):
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


def _with_first(docs: DataFrame, cluster: DataFrame, w: int, num: int, den: int) -> DataFrame:
    """Links (a, b) of each cluster's smallest id with its members, on full sets.  Members are dealt in blocks of about
    BLOCK; a row with the smallest id (its doc_id may have several texts) goes to every block, ahead of the members."""
    size = cluster.groupBy("comp").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    block = F.when(F.col("id") == F.col("comp"), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array(F.pmod(F.xxhash64("id"), F.col("blocks"))))
    dealt = cluster.join(size, "comp").select("id", "comp", F.explode(block).alias("block"))

    def sets(batches):
        for t in batches:
            data, offs = column_bytes(t.column(3))
            out = [s.tobytes() for _, _, d, o in slices(data, offs, SLICE) for s in sets_of(d, o, w)]
            yield pa.RecordBatch.from_arrays([*(t.column(c) for c in range(3)), pa.array(out, pa.binary())], ["id", "comp", "block", "items"])

    def compare(batches):
        at, first = None, []
        for t in batches:
            a, b = [], []
            for i, c, k, v in zip(*(t.column(c).to_pylist() for c in range(3)), t.column(3)):
                x = np.frombuffer(v.as_buffer(), np.uint64)
                if (c, k) != at:
                    at, first = (c, k), []
                if i == c:
                    first.append(x)
                elif any(_linked(y, x, num, den) for y in first):
                    a.append(c)
                    b.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    laid = (_among(docs.select(F.col("doc_id").cast("long").alias("id"), "text"), "id", cluster).join(dealt, "id").select("id", "comp", "block", "text")
            .mapInArrow(lean(sets), "id long, comp long, block long, items binary"))
    parts = int(laid.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the smallest id of a cluster is its name, so it comes first
    return laid.repartition(parts, "comp", "block").sortWithinPartitions("comp", "block", "id").mapInArrow(lean(compare), "a long, b long").distinct()


def linked_groups(docs: DataFrame, w: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (see the module docstring).

    Two documents are linked when ``den * |A & B| >= num * |A | B|`` on their ``w``-word shingle sets;
    ``component_id`` is the smallest doc_id of the connected documents.
    """
    with shuffles_dropped(docs.sparkSession):
        return _linked_groups(docs, w, num, den)


def _linked_groups(docs: DataFrame, w: int, num: int, den: int) -> DataFrame:
    base = written(_prefixed(docs, w, num, den, rarity(docs, w)), "prefixes")
    live = base.filter("digest is not null and doc_id is not null")
    # several: an id that is the smallest of several classes, so that it has several texts
    reps = written(live.groupBy("digest").agg(F.min("doc_id").alias("id"))
                   .withColumn("several", F.count("*").over(Window.partitionBy("id")) > 1), "classes")
    heads = written(live.join(reps.withColumnRenamed("id", "doc_id"), ["digest", "doc_id"]).dropDuplicates(["digest", "doc_id"])
                    .select(F.col("doc_id").alias("id"), "n_shingles", "several", "first", "others"), "heads")
    ranked = _ranked(heads)
    leaders = written(ranked.groupBy("key").agg(F.min(F.struct("id", "n", "pos", "several")).alias("l"), F.count("*").alias("c"))
                      .select("key", F.col("l.id").alias("leader"), F.col("l.n").alias("ln"), F.col("l.pos").alias("lpos"),
                              F.col("l.several").alias("leads"), (F.col("c") > 2).alias("crowded")), "leaders")
    members = written(ranked.join(leaders, "key"), "members")

    # clusters: documents tied by pairs that pass every filter; of a leader with several texts one is kept, so all its pairs go on
    share = _may_share(*(F.col(c).cast("long") for c in ("n", "pos", "ln", "lpos")), num, den)
    pairs = written(members.filter("id <> leader").filter(share | F.col("leads")).select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct(), "pairs")
    ties = written(_passing(pairs, heads, num, den), "ties")
    cluster = components(ties)
    left = _open(members.filter("crowded"), cluster)
    listed = written(_listed(left.filter(F.col("many") <= LISTED), num, den), "listed")
    more = written(_passing(listed, heads, num, den).union(_block_pass(left.filter(F.col("many") > LISTED), heads, num, den)), "ties")
    if more.limit(1).count():
        cluster = _merged(cluster, more)

    # within clusters, on full sets
    # a doc_id with several texts ties its classes together
    mine = written(live.select("doc_id", "digest").distinct().join(reps, "digest").select("doc_id", "id"), "mine")
    several = mine.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("z")).filter("a <> z")
    tied = mine.join(several, "doc_id").filter("id <> a").select("a", F.col("id").alias("b"))
    links = written(_with_first(docs, cluster, w, num, den).union(tied), "links")
    comp = components(links)
    of = cluster.join(heads.select("id", "n_shingles"), "id").select(F.col("comp").alias("key"), "id", F.col("n_shingles").cast("int").alias("n"), F.lit(0).alias("pos"),
                                                                   F.lit(0).alias("rank"), F.lit(False).alias("several"), F.col("comp").alias("leader"))
    left = _open(of, comp)
    ids = left.select("id").distinct()
    full = _items(_among(docs.select("doc_id", "text"), "doc_id", ids), ids, w)
    more = written(_block_pass(left, heads, num, den, full), "links")
    if more.limit(1).count():
        comp = _merged(comp, more)
    node = written(mine.join(comp, "id", "left").groupBy("doc_id").agg(F.min(F.coalesce("comp", "id")).alias("component_id")), "nodes")
    return (base.select("doc_id", "n_shingles").join(node, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))
