"""Demographic roll-up: label every post, fold posts into one profile per
author, score readiness, and derive the statistics bundle.

Scale notes
-----------
* Per-post labelling is one narrow projection (no shuffle); the words of all lexicons are listed in one pass over a text.
* ``profiles`` is a single ``groupBy(author)`` whose aggregates all have
  fixed-width buffers: labels travel as small integer indexes
  (``min_by(idx, seq)``) and the ordered tag sets as one ``min(seq)`` per
  category.  Spark therefore uses hash aggregation with map-side partial
  aggregation: an author (e.g. the blank one) holding a third of all posts is
  combined inside each map task before the shuffle, and no task ever holds a
  list of one author's posts.
* The posts of an author (the reference keeps them inside the profile) stay a
  separate table keyed by author (``author_posts``), never a collected list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsift import lexicons as L
from threadsift.functions import lexicon as LX
from threadsift.functions import scoring as SC
from threadsift.functions.numbers import parse_count
from threadsift.operators import tagging as TG
from threadsift.schema import DEFAULTS_PROFILE
from threadsift.sources.readers import with_defaults

DIMENSIONS = L.demographic_lexicons()
BUDGET = L.budget_lexicon()
PAINS = L.pain_point_lexicon()
TOOLS = L.tool_lexicon()
LABEL_COLS = list(DIMENSIONS) + ["budget_range"]
SCALES = {
    "business_stage": L.BUSINESS_STAGES, "business_type": L.BUSINESS_TYPES,
    "industry": L.INDUSTRIES,
    "target_market": L.TARGET_MARKETS, "tech_level": L.TECH_LEVELS, "budget_range": L.BUDGET_RANGES,
}


def _dimensions(own: dict[str, L.Lexicon] | None) -> dict[str, L.Lexicon]:
    if unknown := set(own or {}) - set(DIMENSIONS):
        raise ValueError(f"no such label: {sorted(unknown)}; labels are {list(DIMENSIONS)}")
    return {**DIMENSIONS, **(own or {})}


def label_posts(posts: DataFrame, dimensions: dict[str, L.Lexicon] | None = None, budget: L.Lexicon = BUDGET,
                pains: L.Lexicon = PAINS, tools: L.Lexicon = TOOLS) -> DataFrame:
    """Per post: author (default 'Unknown'), engagement (likes + comments, digits mode),
    five D3 labels, the budget range (D5), pain-point and tool tags (D2).

    ``dimensions`` replaces the lexicons of the labels that it names, the others their list; give ``profiles`` the same ones."""
    dims = _dimensions(dimensions)
    p = with_defaults(posts, DEFAULTS_PROFILE).withColumn("_low", F.lower("text"))
    p = p.withColumn("_found", LX.found_words("_low", LX.asked_words(*dims.values(), budget, pains, tools)))
    p = TG.classify_many(p, {**dims, "_budget_kw": budget}, low="_low", found="_found")
    return p.select(
        "seq", "author", "text", "timestamp",
        (parse_count(F.col("likes"), "digits") + parse_count(F.col("comments"), "digits")).alias("engagement"),
        *dims,
        F.coalesce(LX.budget_amount_range(F.col("text")), F.col("_budget_kw")).alias("budget_range"),
        LX.tags("text", pains, "_low", "_found").alias("pain_points"),
        LX.tags("text", tools, "_low", "_found").alias("tool_preferences"),
    )


def _scales(dims: dict[str, L.Lexicon], budget: L.Lexicon) -> dict[str, list[str]]:
    """Every label that a lexicon can give has a place: the declared scale, then the lexicon's further categories."""
    lexicons = {**dims, "budget_range": budget}
    return {c: [*SCALES[c], *[x for x in lexicons[c].categories if x not in SCALES[c]]] for c in LABEL_COLS}


def _label(idx: Column, scale: list[str]) -> Column:
    # explicit NULL guard: element_at with a NULL index returns the last element in Spark 4.1
    return F.when(idx.isNotNull(), F.element_at(F.array(*[F.lit(x) for x in scale]), idx + 1))


def _ordered_set(first_seqs: dict[str, Column]) -> Column:
    """Categories sorted by (first seq seen, declared order), NULLs (never seen) dropped."""
    items = F.array(*[F.struct(s.alias("s"), F.lit(i).alias("r"), F.lit(c).alias("c"))
                      for i, (c, s) in enumerate(first_seqs.items())])
    return F.transform(F.array_sort(F.filter(items, lambda x: x["s"].isNotNull())), lambda x: x["c"])


def profiles(labeled: DataFrame, dimensions: dict[str, L.Lexicon] | None = None, budget: L.Lexicon = BUDGET,
             pains: L.Lexicon = PAINS, tools: L.Lexicon = TOOLS) -> DataFrame:
    """one row per author (+ D8 team size, D9 readiness), for the lexicons that labelled the posts.

    The readiness score counts a label outside its declared scale as the scale's first."""
    scales = _scales(_dimensions(dimensions), budget)
    aggs = [F.count(F.lit(1)).alias("post_count"),
            F.sum("engagement").cast("long").alias("total_engagement"),
            F.min("seq").alias("first_seq")]
    # first non-null label in input order (min_by skips rows whose ordering is NULL)
    aggs += [F.min_by(SC.scale_index(F.col(c), scales[c]), F.when(F.col(c).isNotNull(), F.col("seq"))).alias(f"_{c}") for c in LABEL_COLS]
    # first post (seq) in which each category appears
    aggs += [F.min(F.when(F.array_contains("pain_points", c), F.col("seq"))).alias(f"_pp{i}")
             for i, c in enumerate(pains.categories)]
    aggs += [F.min(F.when(F.array_contains("tool_preferences", c), F.col("seq"))).alias(f"_tp{i}")
             for i, c in enumerate(tools.categories)]
    g = labeled.groupBy("author").agg(*aggs)
    out = g.select(
        "author", "post_count", "total_engagement",
        *[_label(F.col(f"_{c}"), scales[c]).alias(c) for c in LABEL_COLS],
        _ordered_set({c: F.col(f"_pp{i}") for i, c in enumerate(pains.categories)}).alias("pain_points"),
        _ordered_set({c: F.col(f"_tp{i}") for i, c in enumerate(tools.categories)}).alias("tool_preferences"),
        "first_seq",
    )
    return out.withColumns({
        "team_size": SC.team_size(F.col("business_type"), F.col("post_count")),
        "readiness_score": SC.readiness_score(F.col("budget_range"), F.col("tech_level"),
                                              F.col("business_stage"), F.size("tool_preferences")),
    })


def author_posts(labeled: DataFrame) -> DataFrame:
    """The per-author post list of the reference, as a table keyed by author."""
    return labeled.select("author", "seq", "text", "engagement", "timestamp")
