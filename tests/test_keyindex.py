"""Keep-first where order values repeat, the bucketed key index, and resuming over runs that count from 0."""

import json
import os
import random

from pyspark.sql import functions as F

from threadsift.operators import dedup as DD
from threadsift.session import checkpoint_path
from threadsift.streaming import ingest as ING
from threadsift.streaming import keyindex as KI


def test_keep_first_with_repeated_orders(spark):
    def kept(rows, **kw):
        df = spark.createDataFrame(rows, "k string, seq long, v string")
        return sorted(map(tuple, DD.keep_first(df, "k", "seq", **kw).collect()), key=str)
    assert kept([("a", 1, "x"), ("a", 2, "y"), ("b", 2, "z"), ("b", 3, "w")]) == [("a", 1, "x"), ("b", 2, "z")]
    assert kept([("a", 1, "x"), ("a", 1, "x")]) == [("a", 1, "x")]
    assert len(kept([("a", 1, "x"), ("a", 1, "y"), ("b", 1, "z")])) == 2
    rows = [(None, 5, "x"), (None, 4, "y"), ("", 9, "z"), ("c", None, "u"), ("c", 7, "v"), ("d", None, "w")]
    assert kept(rows) == [("", 9, "z"), ("c", 7, "v"), ("d", None, "w"), (None, 4, "y")]
    assert kept(rows, null_key=False) == [("", 9, "z"), ("c", 7, "v"), ("d", None, "w")]
    assert kept([]) == []


def test_keep_first_equals_a_fold(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice([None, *"abcdefgh"]), rnd.randrange(6), i) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, seq long, v long")
    want = {}
    for k, s, _ in rows:
        want[k] = min(want.get(k, 99), s)
    got = DD.keep_first(df, "k", "seq").collect()
    assert {r["k"]: r["seq"] for r in got} == want and len(got) == len(want)
    texts = spark.createDataFrame([(1, " a "), (1, "b"), (2, "a"), (0, "  "), (3, None)], "seq long, text string")
    assert sorted((r["seq"], r["text"]) for r in DD.distinct_text_first(texts).collect()) == [(1, " a "), (1, "b")]


def keys(spark, names):
    return spark.createDataFrame([(n,) for n in names], "dedup_key string")


def test_index_equals_the_anti_join_and_opens_few_files(spark):
    index = checkpoint_path(spark, "keys")
    assert KI.unseen(keys(spark, ["a"]), 0, index).count() == 1
    stored = [f"k{i}" for i in range(3000)]
    KI.add(keys(spark, stored[:2000]), 0, index)
    KI.add(keys(spark, stored[2000:]), 1, index)
    probe = [f"k{i}" for i in range(1990, 2010)] + [f"n{i}" for i in range(500)]
    assert sorted(r[0] for r in KI.unseen(keys(spark, probe), 2, index).collect()) == sorted(f"n{i}" for i in range(500))
    # a replayed batch 1 sees batch 0 only
    assert sorted(r[0] for r in KI.unseen(keys(spark, probe), 1, index).collect()) == sorted([f"k{i}" for i in range(2000, 2010)] + [f"n{i}" for i in range(500)])
    assert {r["dedup_key"] for r in KI.may_be_stored(keys(spark, probe), index, 2).collect()} >= {f"k{i}" for i in range(1990, 2010)}
    # three keys open the files of their buckets at most
    few = KI.may_be_stored(keys(spark, ["k1", "k2001", "n9", "n10"]), index, 2)
    buckets = sorted(r["bucket"] for r in few.select("bucket").distinct().collect())
    assert len(buckets) <= 3
    read = KI.stored_keys(spark, index, 2, buckets)
    every = spark.read.schema(KI.KEYS).parquet(f"{index}/keys")
    names = {r[0] for r in read.select(F.input_file_name()).distinct().collect()}
    assert 0 < len(names) <= 2 * len(buckets) and len(every.inputFiles()) > KI.BUCKETS
    scan = [x for x in read._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in x]
    assert scan and all("bucket" in x for x in scan)
    target = checkpoint_path(spark, "keys")
    KI.compacted(spark, index, target, 2)
    assert sorted(r[0] for r in KI.unseen(keys(spark, probe), 1, target).collect()) == sorted(f"n{i}" for i in range(500))
    assert len(spark.read.schema(KI.KEYS).parquet(f"{target}/keys").inputFiles()) <= KI.BUCKETS


def post(url, index):
    return json.dumps({"index": index, "text": f"a post of {url}", "url": url})


def write(path, name, lines, mtime):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")
    os.utime(f"{path}/{name}", (mtime, mtime))


def test_runs_that_count_from_zero_store_a_key_once(spark):
    """Two files of two runs in one batch, then a third run; names fall while times rise."""
    landing, sink, ck = (checkpoint_path(spark, n) for n in ("landing", "sink", "ckpt"))
    write(landing, "z.json", [post("u1", 0), post("u2", 1), post("u2", 1)], 1_000_000)
    write(landing, "a.json", [post("u2", 0), post("u3", 0), post("u1", 1)], 2_000_000)
    ING.ingest_anti_join(spark, landing, sink, ck)
    got = sorted((r["dedup_key"], r["index"]) for r in spark.read.schema(ING.STORED).parquet(sink).collect())
    assert got == [("u1", 0), ("u2", 1), ("u3", 0)]
    write(landing, "m.json", [post("u4", 0), post("u3", 1), post("u1", 2)], 3_000_000)
    ING.ingest_anti_join(spark, landing, sink, ck)
    got = sorted((r["dedup_key"], r["index"]) for r in spark.read.schema(ING.STORED).parquet(sink).collect())
    assert got == [("u1", 0), ("u2", 1), ("u3", 0), ("u4", 0)]
    by_name, ck = checkpoint_path(spark, "sink"), checkpoint_path(spark, "ckpt")
    ING.ingest_anti_join(spark, landing, by_name, ck, order="name")
    got = sorted((r["dedup_key"], r["index"]) for r in spark.read.schema(ING.STORED).parquet(by_name).collect())
    assert got == [("u1", 1), ("u2", 0), ("u3", 0), ("u4", 0)]
