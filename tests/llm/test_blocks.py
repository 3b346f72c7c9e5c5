"""Open buckets: what leaves a block is linear in its members."""

import numpy as np
from pyspark.sql import functions as F

from threadsift.llm import setsketch

N = 40


def test_pairs_of_a_block_are_not_listed(spark):
    s = np.random.default_rng(1).integers(0, 1 << 63, 200).astype(np.uint64)
    regs = np.asarray(setsketch.registers(np.sort(s))).astype("<u2").tobytes()
    # no member is linked yet: each is a component of its own, none of them the leader's
    opened = spark.range(1, N + 1).select(F.lit(7).cast("long").alias("key"), F.lit(0).alias("band"), "id", F.col("id").alias("comp"), F.lit(0).cast("long").alias("home"))
    heads = spark.createDataFrame([(i, 200, bytearray(regs)) for i in range(1, N + 1)], "id long, n_shingles long, regs binary")
    full = spark.createDataFrame([(i, bytearray(np.sort(s).tobytes())) for i in range(1, N + 1)], "id long, items binary")
    assert setsketch._block_pairs(opened, heads, 80, 100).count() < N
    links = setsketch._block_pairs(opened, heads, 80, 100, full)
    got = links.collect()
    assert len(got) == N - 1 and {r["id"] for r in setsketch.components(links).filter("comp = 1").collect()} == set(range(1, N + 1))
