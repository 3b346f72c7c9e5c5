"""Author profiles and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadsift.plans import demographics as DM
from threadsift.plans import sqlgen as G
from threadsift.plans.registry import register
from threadsift.sources.adapter import posts_from_tables


def labeled(spark, sf):
    return DM.label_posts(posts_from_tables(spark, sf, with_counts=True))


def profiles(spark, sf):
    """One row per author.  Every query rolls the posts up itself; a report of several sections
    writes the profiles once (``report_sink``)."""
    return DM.profiles(labeled(spark, sf))


PROF = "WITH " + G.profiles_cte()


@register("budget_range", PROF + "\nSELECT seq, budget_range FROM lab")
def budget_range(spark, sf):
    """First amount with a currency, bucketed; else the budget lexicon."""
    return labeled(spark, sf).select("seq", "budget_range")


@register("author_profiles", PROF + """
SELECT author, post_count, total_engagement, business_stage, business_type, industry, target_market, tech_level,
  budget_range, array_to_string(pain_points, '|') AS pain_points, array_to_string(tool_preferences, '|') AS tool_preferences,
  first_seq FROM prof""")
def author_profiles(spark, sf):
    """one profile per author (post count, engagement, labels, ordered tag sets)."""
    p = profiles(spark, sf)
    return p.select("author", "post_count", "total_engagement", *DM.LABEL_COLS,
                    F.array_join("pain_points", "|").alias("pain_points"),
                    F.array_join("tool_preferences", "|").alias("tool_preferences"), "first_seq")


@register("first_label", PROF + "\nSELECT author, business_stage, industry, budget_range FROM prof")
def first_label(spark, sf):
    """first non-null label per author in input order."""
    return profiles(spark, sf).select("author", "business_stage", "industry", "budget_range")


@register("ordered_tag_union", PROF + """
SELECT author, array_to_string(pain_points, '|') AS pain_points, array_to_string(tool_preferences, '|') AS tool_preferences FROM prof""")
def ordered_tag_union(spark, sf):
    """ordered distinct union of each author's tags (first-seen order)."""
    p = profiles(spark, sf)
    return p.select("author", F.array_join("pain_points", "|").alias("pain_points"),
                    F.array_join("tool_preferences", "|").alias("tool_preferences"))


@register("team_size", PROF + "\nSELECT author, business_type, post_count, team_size FROM prof")
def team_size(spark, sf):
    """Team-size estimate from the business type (startup split on post_count > 5)."""
    return profiles(spark, sf).select("author", "business_type", "post_count", "team_size")


@register("readiness_score", PROF + """
SELECT author, budget_range, tech_level, business_stage, len(tool_preferences) AS n_tools, readiness_score FROM prof""")
def readiness_score(spark, sf):
    """Readiness score 0-100 with half-even rounding."""
    p = profiles(spark, sf)
    return p.select("author", "budget_range", "tech_level", "business_stage",
                    F.size("tool_preferences").cast("long").alias("n_tools"),
                    F.col("readiness_score").cast("long").alias("readiness_score"))
