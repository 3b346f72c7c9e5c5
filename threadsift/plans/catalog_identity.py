"""Identity and incremental-ingest semantics."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadsift.functions.identity import dedup_key
from threadsift.operators import dedup as DD
from threadsift.plans import sqlgen as G
from threadsift.plans.registry import register
from threadsift.sources.adapter import posts_from_tables, table

KEY_SQL = G.dedup_key()


@register("dedup_key_first", "WITH " + G.posts_cte() + f"""
SELECT seq, dedup_key FROM (SELECT seq, {KEY_SQL} AS dedup_key FROM posts)
QUALIFY row_number() OVER (PARTITION BY dedup_key ORDER BY seq) = 1""")
def dedup_key_first(spark, sf):
    """First post per dedup key (skew-safe keep-first aggregate)."""
    p = posts_from_tables(spark, sf)
    return DD.first_order(p, dedup_key(F.col("url"), F.col("text")), "seq", "dedup_key").select("seq", "dedup_key")


@register("distinct_key_posts", "WITH " + G.posts_cte() + f"""
SELECT seq, author, url, likes, md5(text) AS text_md5 FROM (SELECT *, {KEY_SQL} AS dedup_key FROM posts)
QUALIFY row_number() OVER (PARTITION BY dedup_key ORDER BY seq) = 1""")
def distinct_key_posts(spark, sf):
    """The whole posts that ``dedup_key_first`` keeps."""
    p = DD.distinct_key_first(posts_from_tables(spark, sf), unique=True)
    return p.select("seq", "author", "url", "likes", F.md5("text").alias("text_md5"))


@register("resume_anti_join", "WITH " + G.posts_cte() + f"""
, stored AS (SELECT DISTINCT {KEY_SQL} AS k FROM posts p JOIN labels l ON l.doc_id = p.seq)
SELECT seq FROM posts WHERE {KEY_SQL} NOT IN (SELECT k FROM stored)""")
def resume_anti_join(spark, sf):
    """Incoming posts whose key is not already stored (stored = posts that have a labels row)."""
    p = posts_from_tables(spark, sf)
    stored = p.join(table(spark, sf, "labels").select(F.col("doc_id").alias("seq")), "seq", "left_semi")
    return DD.not_seen(p, stored).select("seq")


@register("running_index", "WITH " + G.posts_cte() + f"""
, k AS (SELECT seq FROM (SELECT seq, {KEY_SQL} AS key FROM posts) QUALIFY row_number() OVER (PARTITION BY key ORDER BY seq) = 1)
SELECT seq, row_number() OVER (ORDER BY seq) - 1 AS "index" FROM k""")
def running_index(spark, sf):
    """Running 0-based index of accepted (key-deduplicated) posts in input order."""
    p = DD.first_order(posts_from_tables(spark, sf), dedup_key(F.col("url"), F.col("text"))).select("seq")
    return DD.running_index(p, "seq", "index").select("seq", "index")


@register("dedup_canonical_key", "WITH " + G.posts_cte() + f"""
, c AS (SELECT seq, regexp_replace({G.strip('url')}, '[?#].*$', '') AS cu, text FROM posts)
SELECT min(seq) AS seq, CASE WHEN cu <> '' THEN cu ELSE sha256({G.strip('text')}) END AS dedup_key FROM c GROUP BY ALL""")
def dedup_canonical_key(spark, sf):
    """Opt-in canonical key (Q10): query string and fragment dropped before keep-first."""
    from threadsift.functions.identity import canonical_url
    p = posts_from_tables(spark, sf).withColumn("url", canonical_url(F.col("url")))
    return DD.first_order(p, dedup_key(F.col("url"), F.col("text")), "seq", "dedup_key").select("seq", "dedup_key")
