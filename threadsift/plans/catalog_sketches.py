"""Totals over ingest rounds from stored sketches, held against the exact figures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from threadsift.functions.identity import dedup_key
from threadsift.operators import sketches as SKT
from threadsift.plans import sqlgen as G
from threadsift.plans.catalog_profiles import PROF, labeled
from threadsift.plans.registry import register
from threadsift.session import checkpoint_path
from threadsift.sources.adapter import posts_from_tables

ROUNDS = 7  # posts are dealt to so many rounds by their place
POINTS = {"p50": 0.5, "p90": 0.9, "p99": 0.99}


def _stored(spark, df, name):
    path = checkpoint_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@register("unique_over_rounds", "WITH " + G.posts_cte() + f"""
SELECT count(DISTINCT {G.dedup_key()}) AS unique_posts, count(DISTINCT seq % {ROUNDS}) AS rounds, true AS estimate_within_bound FROM posts""")
def unique_over_rounds(spark, sf):
    """Unique posts over all rounds from one stored sketch a round, beside the exact count."""
    p = posts_from_tables(spark, sf).select((F.col("seq") % ROUNDS).alias("round"), dedup_key(F.col("url"), F.col("text")).alias("key"))
    sketches = _stored(spark, SKT.distinct_sketches(p, ["round"], F.col("key")), "round-keys")
    est = SKT.distinct_total(sketches).crossJoin(sketches.agg(F.count(F.lit(1)).alias("rounds")))
    exact = p.agg(F.count_distinct("key").alias("unique_posts"))  # one row each
    return exact.crossJoin(est).select("unique_posts", "rounds", (F.abs(F.col("estimate") - F.col("unique_posts")) <= F.col("unique_posts") * SKT.DISTINCT_BOUND).alias("estimate_within_bound"))


@register("engagement_quantiles", PROF + """
SELECT coalesce(business_type, 'none') AS business_type, count(*) AS posts, """ + ", ".join(
    f"round(quantile_cont(engagement, {p}), 6) AS {n}, true AS {n}_estimate_within_bound" for n, p in POINTS.items()) + " FROM lab GROUP BY 1")
def engagement_quantiles(spark, sf):
    """exact quantiles of engagement per business type; the merged sketches' values must lie within the rank bound."""
    lab = _stored(spark, labeled(spark, sf).select("seq", F.coalesce("business_type", F.lit("none")).alias("business_type"), "engagement"), "engagement")
    rounds = _stored(spark, SKT.quantile_sketches(lab.withColumn("round", F.col("seq") % ROUNDS), ["round", "business_type"], "engagement"), "round-engagement")
    est = SKT.quantiles(rounds, ["business_type"], {f"{n}_est": p for n, p in POINTS.items()})
    aggs = [F.count(F.lit(1)).alias("posts"), *[F.percentile("engagement", F.lit(p)).alias(n) for n, p in POINTS.items()]]
    for n in POINTS:
        aggs += [F.avg((F.col("engagement") < F.col(f"{n}_est")).cast("int")).alias(f"{n}_below"), F.avg((F.col("engagement") <= F.col(f"{n}_est")).cast("int")).alias(f"{n}_upto")]
    g = lab.join(est, "business_type").groupBy("business_type").agg(*aggs)  # a row per type on the right side
    cols = [(F.round(F.col(n), 6).alias(n), ((F.col(f"{n}_below") <= p + SKT.RANK_BOUND) & (F.col(f"{n}_upto") >= p - SKT.RANK_BOUND)).alias(f"{n}_estimate_within_bound"))
            for n, p in POINTS.items()]
    return g.select("business_type", "posts", *reduce(lambda a, b: a + b, cols))
