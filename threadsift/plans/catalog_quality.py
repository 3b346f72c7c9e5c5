"""Data-quality report."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadsift import lexicons as L
from threadsift.functions import text as TX
from threadsift.operators.dedup import distinct_text_first
from threadsift.plans import sqlgen as G
from threadsift.plans.registry import register
from threadsift.schema import DEFAULTS_QUALITY
from threadsift.sources.adapter import posts_from_tables
from threadsift.sources.readers import with_defaults

UNIQUE_CTE = "WITH " + G.posts_cte() + f"""
, u AS (SELECT * FROM (SELECT *, {G.strip('text')} AS k FROM posts) WHERE k <> ''
        QUALIFY row_number() OVER (PARTITION BY k ORDER BY seq) = 1)"""


def unique_posts(spark, sf):
    return distinct_text_first(with_defaults(posts_from_tables(spark, sf), DEFAULTS_QUALITY), unique=True)


@register("dedup_text_first", UNIQUE_CTE + "\nSELECT seq, md5(text) AS text_md5 FROM u")
def dedup_text_first(spark, sf):
    """Distinct by stripped text, first in input order, empty dropped (skew-safe aggregate)."""
    return unique_posts(spark, sf).select("seq", F.md5("text").alias("text_md5"))


def _cov(c):
    return f"CAST(sum(CASE WHEN {G.strip(c)} <> '' THEN 1 ELSE 0 END) AS BIGINT)"


@register("field_coverage", UNIQUE_CTE + f"""
, s AS (SELECT count(*) AS total, {_cov('author')} AS has_author, {_cov('url')} AS has_url,
  {_cov('likes')} AS has_likes, {_cov('comments')} AS has_comments FROM u)
SELECT total, has_author, CAST(CASE WHEN total > 0 THEN floor(100 * has_author / total) END AS BIGINT) AS pct_author,
  has_url, CAST(CASE WHEN total > 0 THEN floor(100 * has_url / total) END AS BIGINT) AS pct_url,
  has_likes, CAST(CASE WHEN total > 0 THEN floor(100 * has_likes / total) END AS BIGINT) AS pct_likes,
  has_comments, CAST(CASE WHEN total > 0 THEN floor(100 * has_comments / total) END AS BIGINT) AS pct_comments FROM s""")
def field_coverage(spark, sf):
    """F16: non-blank author / url / likes / comments with floor percentages (total 0 guarded)."""
    u = unique_posts(spark, sf)
    agg = u.agg(F.count(F.lit(1)).alias("total"),
                *[F.sum(F.when(TX.py_strip(F.col(c)) != "", 1).otherwise(0)).cast("long").alias(f"has_{c}")
                  for c in ("author", "url", "likes", "comments")])
    t = F.col("total")
    cols = ["total"]
    for c in ("author", "url", "likes", "comments"):
        cols += [f"has_{c}", F.when(t > 0, F.floor(F.col(f"has_{c}") * 100 / t)).cast("long").alias(f"pct_{c}")]
    return agg.select(*cols)


@register("length_buckets", UNIQUE_CTE + f"""
, b AS (SELECT CASE WHEN length(text) < {L.LENGTH_SHORT_BELOW} THEN 'short' WHEN length(text) < {L.LENGTH_LONG_FROM} THEN 'medium' ELSE 'long' END AS bucket FROM u)
SELECT bucket, count(*) AS count, CAST(floor(100 * count(*) / sum(count(*)) OVER ()) AS BIGINT) AS pct FROM b GROUP BY bucket""")
def length_buckets(spark, sf):
    """Short / medium / long counts with floor percentages."""
    u = unique_posts(spark, sf)
    b = u.groupBy(TX.length_bucket(F.col("text")).alias("bucket")).agg(F.count(F.lit(1)).alias("count"))
    from pyspark.sql import Window
    return b.withColumn("pct", F.floor(F.col("count") * 100 / F.sum("count").over(Window.partitionBy())).cast("long"))


@register("truncated_count", UNIQUE_CTE + """
SELECT CAST(sum(CASE WHEN contains(text, 'See more') OR contains(text, 'عرض المزيد') THEN 1 ELSE 0 END) AS BIGINT) AS truncated,
  count(*) AS total FROM u""")
def truncated_count(spark, sf):
    """Posts still carrying a 'see more' marker."""
    u = unique_posts(spark, sf)
    return u.agg(F.sum(F.when(TX.truncated(F.col("text")), 1).otherwise(0)).cast("long").alias("truncated"),
                 F.count(F.lit(1)).alias("total"))


@register("longest_posts", UNIQUE_CTE + f"""
SELECT row_number() OVER (ORDER BY length(text) DESC, seq) AS rank, seq, author, likes, comments,
  CAST(length(text) AS BIGINT) AS length, substr(text, 1, 400) AS head FROM u QUALIFY rank <= {L.TOP_LONGEST}""")
def longest_posts(spark, sf):
    """The five longest unique posts (stable: ties keep input order); a bounded top-k."""
    u = unique_posts(spark, sf)
    top = u.orderBy(F.length("text").desc(), F.col("seq")).limit(L.TOP_LONGEST)
    from pyspark.sql import Window
    return top.select(F.row_number().over(Window.orderBy(F.length("text").desc(), F.col("seq"))).cast("long").alias("rank"),
                      "seq", "author", "likes", "comments", F.length("text").cast("long").alias("length"),
                      F.substring("text", 1, 400).alias("head"))
