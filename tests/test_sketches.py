"""Merged sketches against exact figures; profiles by own lexicons."""

import pytest
from pyspark.sql import functions as F

from threadsift import lexicons as L
from threadsift.operators import sketches as SKT
from threadsift.plans import demographics as DM


def test_distinct_sketches_merge(spark):
    # keys shared between rounds, one round holding most rows, NULL keys
    p = spark.range(60_000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 5).alias("round"),
                                   F.when(F.col("id") % 11 > 0, F.sha2((F.col("id") % 23_000).cast("string"), 256)).alias("key"))
    exact = p.select(F.count_distinct("key")).first()[0]
    s = SKT.distinct_sketches(p, ["round"], F.col("key"))
    est = SKT.distinct_total(s).first().estimate
    assert abs(est - exact) <= exact * SKT.DISTINCT_BOUND
    assert SKT.distinct_total(SKT.distinct_sketches(p.union(p), ["round"], F.col("key"))).first().estimate == est  # repeats change nothing
    assert SKT.distinct_total(s.limit(0)).first().estimate == 0
    assert SKT.distinct_total(SKT.distinct_sketches(p.withColumn("key", F.lit(None).cast("string")), ["round"], F.col("key"))).first().estimate == 0


def test_quantile_sketches_merge(spark):
    rows = spark.range(50_000).select((F.col("id") % 7).alias("round"), F.when(F.col("id") % 10 == 0, "few").otherwise("most").alias("kind"),
                                      F.when(F.col("id") % 13 > 0, F.pmod(F.hash("id"), F.lit(9_973)) * F.pmod(F.hash("id", "id"), F.lit(31))).alias("v"))
    points = {"p50": 0.5, "p90": 0.9, "p99": 0.99}
    got = {r.kind: r for r in SKT.quantiles(SKT.quantile_sketches(rows, ["round", "kind"], "v"), ["kind"], points).collect()}
    for kind in ("few", "most"):
        values = sorted(r.v for r in rows.filter((F.col("kind") == kind) & F.col("v").isNotNull()).collect())
        for n, p in points.items():
            v = got[kind][n]
            below, upto = sum(x < v for x in values) / len(values), sum(x <= v for x in values) / len(values)
            assert below <= p + SKT.RANK_BOUND and upto >= p - SKT.RANK_BOUND, (kind, n)
    assert SKT.quantiles(SKT.quantile_sketches(rows.limit(0), ["round", "kind"], "v"), ["kind"], points).count() == 0


def test_profiles_by_own_lexicons(spark):
    types = L.Lexicon.of("types", {"Bakery": ["bread"], "Harbour": ["ship"]})
    pains = L.Lexicon.of("pains", {"Rain": ["rain"], "Wind": ["wind"]})
    posts = spark.createDataFrame([(0, "bread and rain", "a"), (1, "a ship in the wind, rain", "a"), (2, "a ship", "b"), (3, "none", "c")],
                                  "seq long, text string, author string").withColumns({c: F.lit("") for c in ("likes", "comments", "timestamp")})
    own = {"dimensions": {"business_type": types}, "pains": pains}
    got = {r.author: r for r in DM.profiles(DM.label_posts(posts, **own), **own).collect()}
    # each label keeps its name, also those outside the declared scale
    assert {a: r.business_type for a, r in got.items()} == {"a": "Bakery", "b": "Harbour", "c": None}
    assert got["a"].pain_points == ["Rain", "Wind"] and got["b"].pain_points == []
    with pytest.raises(ValueError, match="no such label"):
        DM.label_posts(posts, dimensions={"colour": types})
