"""Lexicon tagging and tag statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadsift import lexicons as L
from threadsift.functions import lexicon as LX
from threadsift.operators import tagging as TG
from threadsift.plans import pain_points as PP
from threadsift.plans import sqlgen as G
from threadsift.plans.registry import register
from threadsift.sources.adapter import posts_from_tables

PROBE = L.probe_lexicon(regex=True)
SEG = L.segment_lexicon()


def analyzed(spark, sf, keep_untagged: bool = False):
    return PP.analyze(posts_from_tables(spark, sf), PROBE, keep_untagged)


def stats(spark, sf):
    """Per-tag statistics; explode drops untagged posts, so no separate B3 filter pass."""
    return PP.tag_stats(analyzed(spark, sf, keep_untagged=True), PROBE)


# --- shared oracle CTEs -------------------------------------------------------
def _analyzed_sql() -> str:
    return f"""WITH {G.posts_cte()},
_t AS (SELECT *, {G.tags('text', PROBE)} AS pain_points FROM posts WHERE text <> ''),
an AS (
  SELECT seq, pain_points, {G.severity('text')} AS severity,
    {G.best_label('text', SEG)} AS segment,
    {G.parse_strict('likes')} + {G.parse_strict('comments')} + {G.parse_strict('shares')} AS total_engagement,
    text, likes, comments, shares, "timestamp", url
  FROM _t WHERE len(pain_points) > 0),
st AS (
  SELECT tag, count(*) AS frequency,
    round(sum(severity) / count(*), 6) AS average_severity,
    round(sum(total_engagement) / count(*), 6) AS average_engagement,
    min(seq) AS first_seq, {G.cat_rank('tag', PROBE)} AS cat_rank,
    {", ".join(f"CAST(sum(CASE WHEN segment = '{s}' THEN 1 ELSE 0 END) AS BIGINT) AS {s}" for s in L.SEGMENTS)}
  FROM (SELECT seq, severity, segment, total_engagement, unnest(pain_points) AS tag FROM an) GROUP BY tag)"""


ANALYZED_SQL = _analyzed_sql()
TAG_RANKING_SQL = _analyzed_sql() + f"""
SELECT CAST(row_number() OVER (ORDER BY frequency DESC, first_seq, cat_rank) AS BIGINT) AS rank,
  tag, frequency, average_severity, average_engagement
FROM st QUALIFY rank <= {L.TOP_TAGS}"""


@register("tag_ranking", TAG_RANKING_SQL)
def tag_ranking(spark, sf):
    """Flagship: tag every post, rank tags by frequency with average severity and engagement."""
    r = PP.tag_ranking(stats(spark, sf))
    return r.withColumn("rank", F.col("rank").cast("long"))


@register("tag_by_segment", _analyzed_sql() + "\nSELECT tag, freelancer, startup, sme FROM st")
def tag_by_segment(spark, sf):
    return PP.tag_by_segment(stats(spark, sf))


@register("tag_totals", _analyzed_sql() + """
SELECT count(*) AS total_posts_analyzed, CAST(coalesce(sum(len(pain_points)), 0) AS BIGINT) AS total_mentions FROM an""")
def tag_totals(spark, sf):
    return PP.totals(analyzed(spark, sf, keep_untagged=True))


@register("top5_tags_per_segment", _analyzed_sql() + f"""
, grid AS ({" UNION ALL ".join(f"SELECT tag, first_seq, cat_rank, '{s}' AS segment, {s} AS count FROM st" for s in L.SEGMENTS)})
SELECT segment, CAST(row_number() OVER (PARTITION BY segment ORDER BY count DESC, first_seq, cat_rank) AS BIGINT) AS rank,
  tag, count FROM grid QUALIFY rank <= {L.TOP_PER_SEGMENT}""")
def top5_tags_per_segment(spark, sf):
    r = PP.top_tags_per_segment(stats(spark, sf))
    return r.withColumn("rank", F.col("rank").cast("long"))


@register("sample_posts", _analyzed_sql() + f"""
SELECT seq, CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END AS text,
  array_to_string(pain_points, '|') AS pain_points, severity, segment,
  {G.parse_strict('likes')} AS likes, {G.parse_strict('comments')} AS comments, {G.parse_strict('shares')} AS shares,
  total_engagement, "timestamp", url
FROM an ORDER BY seq LIMIT {L.SAMPLE_POSTS}""")
def sample_posts(spark, sf):
    s = PP.sample_posts(analyzed(spark, sf))
    return s.withColumn("pain_points", F.array_join("pain_points", "|")).withColumn("severity", F.col("severity").cast("long"))


# --- per-post lexicon operators ------------------------------------------------
@register("tag_regex", f"""WITH {G.posts_cte()}
SELECT seq, array_to_string({G.tags('text', PROBE)}, '|') AS tags FROM posts""")
def tag_regex(spark, sf):
    """Multi-label regex tagging (case-insensitive, declared order, each category once)."""
    p = posts_from_tables(spark, sf)
    return TG.tag(p, PROBE, out="tags").select("seq", F.array_join("tags", "|").alias("tags"))


PAIN = L.pain_lexicon()


@register("tag_regex_reference", f"""WITH {G.posts_cte()}
SELECT seq, array_to_string({G.tags('text', PAIN)}, '|') AS tags FROM posts""")
def tag_regex_reference(spark, sf):
    """D1 with the 20 declared regex categories."""
    return TG.tag(posts_from_tables(spark, sf), PAIN, out="tags").select("seq", F.array_join("tags", "|").alias("tags"))


_DA = L.demographic_lexicons()
_TOOLS = L.tool_lexicon()
_PAINS = L.pain_point_lexicon()


@register("tag_keywords", f"""WITH {G.posts_cte()}
SELECT seq, array_to_string({G.tags('text', _TOOLS)}, '|') AS tool_preferences,
  array_to_string({G.tags('text', _PAINS)}, '|') AS pain_points FROM posts""")
def tag_keywords(spark, sf):
    """Multi-label keyword tagging (lower-cased substring) for tools and pain points."""
    p = posts_from_tables(spark, sf).withColumn("_low", F.lower("text"))
    p = TG.tag(p, _TOOLS, out="tool_preferences", low="_low")
    p = TG.tag(p, _PAINS, out="pain_points", low="_low")
    return p.select("seq", F.array_join("tool_preferences", "|").alias("tool_preferences"),
                    F.array_join("pain_points", "|").alias("pain_points"))


@register("classify_dims", f"""WITH {G.posts_cte()}
SELECT seq, {", ".join(f"{G.best_label('text', lx)} AS {d}" for d, lx in _DA.items())},
  round(least({G.best_score('text', _DA['business_stage'])} / 5.0, 1.0), 6) AS stage_confidence
FROM posts""")
def classify_dims(spark, sf):
    """Best label on five dimensions in one projection, plus the stage confidence."""
    p = posts_from_tables(spark, sf).withColumn("_low", F.lower("text"))
    p = TG.classify_many(p, _DA, low="_low", score_cols={"business_stage": "_stage_score"})
    return p.select("seq", *_DA, F.round(LX.confidence(F.col("_stage_score")), 6).alias("stage_confidence"))


@register("severity_score", f"""WITH {G.posts_cte()}
SELECT seq, {G.severity('text')} AS severity FROM posts""")
def severity_score(spark, sf):
    """urgency/severity keyword score, capped at 10."""
    p = posts_from_tables(spark, sf).withColumn("_low", F.lower("text"))
    return p.select("seq", LX.severity("_low", L.URGENCY_KEYWORDS, L.SEVERITY_KEYWORDS).cast("long").alias("severity"))


@register("segment_label", f"""WITH {G.posts_cte()}
SELECT seq, {G.best_label('text', SEG)} AS segment FROM posts""")
def segment_label(spark, sf):
    """Freelancer / startup / sme by hit count, ties in that order, none -> unknown."""
    p = posts_from_tables(spark, sf)
    return TG.classify(p, SEG, out="segment").select("seq", "segment")


@register("tag_keywords_join", f"""WITH {G.posts_cte()}
SELECT seq, array_to_string({G.tags('text', _TOOLS)}, '|') AS tool_preferences FROM posts""")
def tag_keywords_join(spark, sf):
    """D2 join plan: the lexicon as a table, met on text pieces; equals the array plan."""
    p = posts_from_tables(spark, sf)
    return TG.tag_join(p, _TOOLS, out="tool_preferences").select(
        "seq", F.array_join("tool_preferences", "|").alias("tool_preferences"))


SEG_NORM = SEG.normalized()


@register("segment_normalized", f"""WITH {G.posts_cte()}
SELECT seq, {G.best_label('text', SEG_NORM)} AS segment FROM posts""")
def segment_normalized(spark, sf):
    """Opt-in normalised lexicon (Q3): upper-case keywords (MVP, SME) are lowered so they can match."""
    p = posts_from_tables(spark, sf)
    return TG.classify(p, SEG_NORM, out="segment").select("seq", "segment")


BUDGET_RX = L.Lexicon(L.budget_lexicon().name, L.budget_lexicon().entries, is_regex=True, lower_keywords=False)


@register("budget_regex_mode", f"""WITH {G.posts_cte(with_counts=True)}
SELECT seq, array_to_string({G.tags('text', BUDGET_RX)}, '|') AS budget_hits FROM posts""")
def budget_regex_mode(spark, sf):
    """Opt-in regex mode for the budget lexicon (Q2): entries such as ``\\d+ EGP`` act as patterns."""
    p = posts_from_tables(spark, sf, with_counts=True)
    return TG.tag(p, BUDGET_RX, out="h").select("seq", F.array_join("h", "|").alias("budget_hits"))
