"""Pain-point analysis: tag every post, then frequency / severity / engagement
statistics per tag, per-segment breakdowns, samples and the result document.

Plan shape: scan -> one narrow projection (tags, severity, segment, counts)
-> filter -> ``explode`` -> ``groupBy(tag)`` (partial aggregation map-side, so
a tag held by a third of all posts is combined before the shuffle) -> tiny
sorts over at most one row per lexicon category.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsift import lexicons as L
from threadsift.functions import lexicon as LX
from threadsift.functions.numbers import parse_count
from threadsift.functions.text import preview
from threadsift.operators import tagging as TG
from threadsift.operators.reports import rank_by
from threadsift.schema import DEFAULTS_PAIN
from threadsift.sources.readers import with_defaults


def category_rank(c, lex: L.Lexicon):
    m = F.create_map(*[x for i, cat in enumerate(lex.categories) for x in (F.lit(cat), F.lit(i))])
    return m[F.col(c) if isinstance(c, str) else c]


def analyze(posts: DataFrame, lex: L.Lexicon | None = None, keep_untagged: bool = False) -> DataFrame:
    """Per-post result rows: only posts with text and at least one tag.

    ``keep_untagged=True`` skips the B3 filter for consumers that explode the tag
    array anyway (statistics): Catalyst would otherwise push ``size(tags) > 0``
    below the projection and evaluate every tag regex twice.
    """
    lex = lex or L.pain_lexicon()
    seg = L.segment_lexicon()
    p = with_defaults(posts, DEFAULTS_PAIN).filter(F.col("text") != "").withColumn("_low", F.lower("text"))
    p = p.withColumn("pain_points", LX.tags("text", lex, "_low"))
    if not keep_untagged:
        p = p.filter(F.size("pain_points") > 0)
    p = TG.classify(p, seg, out="segment", low="_low")
    likes, comments, shares = (parse_count(F.col(c), "strict") for c in ("likes", "comments", "shares"))
    return p.select(
        "seq",
        preview(F.col("text"), 200).alias("text"),
        "pain_points",
        LX.severity("_low", L.URGENCY_KEYWORDS, L.SEVERITY_KEYWORDS, L.SEVERITY_BASE,
                    L.SEVERITY_URGENCY_W, L.SEVERITY_SEVERITY_W, L.SEVERITY_CAP).alias("severity"),
        F.col("segment"),
        likes.alias("likes"), comments.alias("comments"), shares.alias("shares"),
        (likes + comments + shares).alias("total_engagement"),
        F.col("timestamp"), F.col("url"),
    )


def tag_stats(analyzed: DataFrame, lex: L.Lexicon | None = None) -> DataFrame:
    """one row per tag: frequency, average severity and engagement, per-segment counts, first seen."""
    lex = lex or L.pain_lexicon()
    e = analyzed.select("seq", "severity", "segment", "total_engagement", F.explode("pain_points").alias("tag"))
    seg_counts = [F.sum(F.when(F.col("segment") == s, 1).otherwise(0)).cast("long").alias(s) for s in L.SEGMENTS]
    return (e.groupBy("tag").agg(
        F.count(F.lit(1)).alias("frequency"),
        F.sum("severity").alias("_sev"),
        F.sum("total_engagement").alias("_eng"),
        F.min("seq").alias("first_seq"),
        *seg_counts)
        .withColumn("average_severity", F.round(F.col("_sev") / F.col("frequency"), 6))
        .withColumn("average_engagement", F.round(F.col("_eng") / F.col("frequency"), 6))
        .withColumn("cat_rank", category_rank("tag", lex))
        .drop("_sev", "_eng"))


def tag_ranking(stats: DataFrame, k: int = L.TOP_TAGS) -> DataFrame:
    """G1: top-k tags by frequency; ties by first appearance (post order, then category order)."""
    r = rank_by(stats, [F.col("frequency").desc(), F.col("first_seq"), F.col("cat_rank")], k)
    return r.select("rank", "tag", "frequency", "average_severity", "average_engagement")


def tag_by_segment(stats: DataFrame) -> DataFrame:
    """every tag with its freelancer / startup / sme counts (unknown excluded)."""
    return stats.select("tag", *L.SEGMENTS)


def totals(analyzed: DataFrame) -> DataFrame:
    """posts with at least one tag and total tag mentions (untagged rows, if kept, are not counted)."""
    return analyzed.agg(F.count_if(F.size("pain_points") > 0).alias("total_posts_analyzed"),
                        F.coalesce(F.sum(F.size("pain_points")), F.lit(0)).cast("long").alias("total_mentions"))


def top_tags_per_segment(stats: DataFrame, k: int = L.TOP_PER_SEGMENT) -> DataFrame:
    """Top-k tags per segment over the dense (segment x tag) grid; zero counts take part."""
    segs = F.array(*[F.struct(F.lit(s).alias("segment"), F.col(s).alias("count")) for s in L.SEGMENTS])
    grid = stats.select("tag", "first_seq", "cat_rank", F.inline(segs))
    r = rank_by(grid, [F.col("count").desc(), F.col("first_seq"), F.col("cat_rank")], k, part=["segment"])
    return r.select("segment", "rank", "tag", "count")


def sample_posts(analyzed: DataFrame, n: int = L.SAMPLE_POSTS) -> DataFrame:
    """First ``n`` result rows in input order (a bounded top-n, not a full sort)."""
    return analyzed.orderBy("seq").limit(n)
