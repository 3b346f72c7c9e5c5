"""Community statistics and report tables."""

from __future__ import annotations

from threadsift import lexicons as L
from threadsift.plans import statistics as ST
from threadsift.plans import sqlgen as G
from threadsift.plans.catalog_profiles import profiles
from threadsift.plans.demographics import LABEL_COLS
from threadsift.plans.pages import stored
from threadsift.plans.registry import register

PROF = "WITH " + G.profiles_cte()


def cells(spark, sf):
    """The report cube, written: whatever a section reads of it, profiles are built once."""
    return stored(ST.report_cells(profiles(spark, sf)), "report-cells")


def _vals(name: str, labels: list[str]) -> str:
    rows = ", ".join(f"({G.q(x)}, {i})" for i, x in enumerate(labels))
    return f"(SELECT * FROM (VALUES {rows}) v({name}, {name}_idx))"


LONG_LABELS = "\n UNION ALL ".join(
    f"SELECT '{c}' AS dimension, {c} AS label, first_seq FROM prof WHERE {c} IS NOT NULL" for c in LABEL_COLS)
LABEL_DIST = f"""ldist AS (SELECT dimension, label, count(*) AS count, min(first_seq) AS first_seq
  FROM ({LONG_LABELS}) GROUP BY dimension, label)"""
LIST_DIST = """{name} AS (SELECT label, count(*) AS count, min(first_seq * 1000 + pos) AS k
  FROM (SELECT first_seq, unnest({col}) AS label, generate_subscripts({col}, 1) - 1 AS pos FROM prof) GROUP BY label)"""


STAGE_LABELS = """, e AS (SELECT business_stage, first_seq, 'pain_point' AS kind, unnest(pain_points) AS label, generate_subscripts(pain_points, 1) - 1 AS pos FROM prof WHERE business_stage IS NOT NULL
  UNION ALL SELECT business_stage, first_seq, 'tool', unnest(tool_preferences), generate_subscripts(tool_preferences, 1) - 1 FROM prof WHERE business_stage IS NOT NULL
  UNION ALL SELECT business_stage, first_seq, 'budget', budget_range, 0 FROM prof WHERE business_stage IS NOT NULL AND budget_range IS NOT NULL),
c AS (SELECT business_stage, kind, label, count(*) AS count, min(first_seq * 1000 + pos) AS k FROM e GROUP BY ALL)"""


def _listdist(name, col):
    return LIST_DIST.format(name=name, col=col)


@register("community_totals", PROF + """
SELECT count(*) AS total_posters, CAST(coalesce(sum(post_count), 0) AS BIGINT) AS total_posts,
  CAST(coalesce(sum(total_engagement), 0) AS BIGINT) AS total_engagement,
  round(coalesce(sum(total_engagement), 0) / greatest(count(*), 1), 6) AS avg_engagement_per_poster,
  round(coalesce(sum(post_count), 0) / greatest(count(*), 1), 6) AS avg_posts_per_poster FROM prof""")
def community_totals(spark, sf):
    """Totals and per-poster averages."""
    return ST.community_totals(cells(spark, sf))


@register("label_distributions", PROF + f", {LABEL_DIST}\nSELECT dimension, label, count FROM ldist")
def label_distributions(spark, sf):
    """six label distributions over posters (NULL skipped)."""
    return ST.label_distributions(cells(spark, sf)).drop("first_seq")


@register("stage_by_type", PROF + """
SELECT business_type, business_stage, count(*) AS count FROM prof
WHERE business_stage IS NOT NULL AND business_type IS NOT NULL GROUP BY business_type, business_stage""")
def stage_by_type(spark, sf):
    """business type x stage cross-tab."""
    return ST.crosstab(cells(spark, sf), "business_type", "business_stage").drop("first_seq")


@register("market_by_stage", PROF + """
SELECT business_stage, target_market, count(*) AS count FROM prof
WHERE business_stage IS NOT NULL AND target_market IS NOT NULL GROUP BY business_stage, target_market""")
def market_by_stage(spark, sf):
    """stage x target market cross-tab."""
    return ST.crosstab(cells(spark, sf), "business_stage", "target_market").drop("first_seq")


@register("tag_tool_distribution", PROF + f", {_listdist('pd', 'pain_points')}, {_listdist('td', 'tool_preferences')}" + """
SELECT 'pain_points' AS kind, label, count FROM pd UNION ALL SELECT 'tool_preferences', label, count FROM td""")
def tag_tool_distribution(spark, sf):
    """posters per pain point and per tool."""
    p = cells(spark, sf)
    a = ST.list_distribution(p, "pain_points").selectExpr("'pain_points' AS kind", "label", "count")
    b = ST.list_distribution(p, "tool_preferences").selectExpr("'tool_preferences' AS kind", "label", "count")
    return a.unionByName(b)


@register("readiness_by_stage", PROF + """
SELECT business_stage, round(avg(readiness_score), 6) AS avg_score, min(readiness_score) AS min_score,
  max(readiness_score) AS max_score, count(*) AS posters FROM prof WHERE business_stage IS NOT NULL GROUP BY business_stage""")
def readiness_by_stage(spark, sf):
    """readiness average / min / max / posters per stage."""
    return ST.readiness_by_stage(cells(spark, sf)).drop("first_seq")


@register("engagement_by_type", PROF + """
SELECT business_type, CAST(sum(total_engagement) AS BIGINT) AS total_engagement, round(avg(total_engagement), 6) AS avg_engagement,
  count(*) AS posters FROM prof WHERE business_type IS NOT NULL GROUP BY business_type""")
def engagement_by_type(spark, sf):
    """engagement per business type."""
    return ST.engagement_by_type(cells(spark, sf))


@register("team_size_distribution", PROF + "\nSELECT team_size, count(*) AS count FROM prof GROUP BY team_size")
def team_size_distribution(spark, sf):
    """team-size distribution."""
    return ST.team_size_distribution(cells(spark, sf)).drop("first_seq")


@register("budget_stage_grid", PROF + f"""
SELECT g.business_stage, g.budget_range, CAST(coalesce(c.count, 0) AS BIGINT) AS count
FROM (SELECT s.business_stage, b.budget_range FROM {_vals('business_stage', L.BUSINESS_STAGES)} s
      CROSS JOIN {_vals('budget_range', L.BUDGET_RANGES)} b) g
LEFT JOIN (SELECT business_stage, budget_range, count(*) AS count FROM prof
  WHERE business_stage IS NOT NULL AND budget_range IS NOT NULL GROUP BY ALL) c
  ON c.business_stage = g.business_stage AND c.budget_range = g.budget_range""")
def budget_stage_grid(spark, sf):
    """F15 (+E8): stage x budget over the full scale grid, missing cells 0."""
    return ST.budget_stage_grid(cells(spark, sf))


@register("segment_profile", PROF + f"""
{STAGE_LABELS},
k AS (SELECT business_stage, {", ".join(f"coalesce(string_agg(label || '=' || count, ', ' ORDER BY count DESC, k) FILTER (kind = '{a}'), '') AS {b}" for a, b in (('pain_point', 'pain_points'), ('tool', 'tools'), ('budget', 'budgets')))}
  FROM c GROUP BY business_stage)
SELECT s.business_stage, CAST(coalesce(a.posters, 0) AS BIGINT) AS posters, a.avg_engagement,
  coalesce(k.pain_points, '') AS pain_points, coalesce(k.tools, '') AS tools, coalesce(k.budgets, '') AS budgets
FROM {_vals('business_stage', L.BUSINESS_STAGES)} s LEFT JOIN
 (SELECT business_stage, count(*) AS posters, round(avg(total_engagement), 6) AS avg_engagement FROM prof
  WHERE business_stage IS NOT NULL GROUP BY business_stage) a ON a.business_stage = s.business_stage
LEFT JOIN k ON k.business_stage = s.business_stage""")
def segment_profile(spark, sf):
    """F19 (+E7): posters and average engagement per stage of the scale."""
    return ST.segment_profile(cells(spark, sf))


@register("budget_by_stage", PROF + f"""
SELECT CAST(s.business_stage_idx AS BIGINT) AS position, s.business_stage, CAST({G.scale_index('budget_range', L.BUDGET_RANGES)} AS BIGINT) AS budget_position,
  budget_range, CAST(coalesce(count, 0) AS BIGINT) AS count, round(count * 100.0 / sum(count) OVER (PARTITION BY s.business_stage), 6) AS pct,
  CAST(floor(count * 100.0 / sum(count) OVER (PARTITION BY s.business_stage) / 5) AS BIGINT) AS bar
FROM {_vals('business_stage', L.BUSINESS_STAGES)} s LEFT JOIN (SELECT business_stage, budget_range, count(*) AS count FROM prof
      WHERE business_stage IS NOT NULL AND budget_range IS NOT NULL GROUP BY ALL) c ON c.business_stage = s.business_stage""")
def budget_by_stage(spark, sf):
    """budget distribution inside each stage (% of the stage's budget total)."""
    return ST.budget_by_stage(cells(spark, sf))


@register("budget_coverage", PROF + f"""
SELECT count(budget_range) AS with_budget, count(*) AS total_posters,
  round(CASE WHEN count(*) > 0 THEN count(budget_range) * 100.0 / count(*) END, 6) AS pct,
  round(avg({G.scale_index('budget_range', L.BUDGET_RANGES)} + 1), 6) AS avg_budget_index,
  CASE WHEN avg({G.scale_index('budget_range', L.BUDGET_RANGES)} + 1) IS NULL THEN NULL
       WHEN avg({G.scale_index('budget_range', L.BUDGET_RANGES)} + 1) < 1.5 THEN '$0-$500'
       WHEN avg({G.scale_index('budget_range', L.BUDGET_RANGES)} + 1) < 2.5 THEN '$500-$2K'
       WHEN avg({G.scale_index('budget_range', L.BUDGET_RANGES)} + 1) < 3.5 THEN '$2K-$10K' ELSE '$10K+' END AS avg_budget_range
FROM prof""")
def budget_coverage(spark, sf):
    """Budget coverage and average budget range."""
    return ST.budget_coverage(cells(spark, sf))


@register("overall_readiness", PROF + """
SELECT round(avg(readiness_score), 6) AS overall_readiness, count(*) AS scored_posters FROM prof WHERE business_stage IS NOT NULL""")
def overall_readiness(spark, sf):
    """mean readiness over scored posters."""
    return ST.overall_readiness(cells(spark, sf))


_MODES_SQL = PROF + f", {LABEL_DIST}, {_listdist('pd', 'pain_points')}, {_listdist('td', 'tool_preferences')}" + """
, allc AS (SELECT dimension, label, count, first_seq * 1000 AS k FROM ldist WHERE dimension IN ('business_type', 'business_stage', 'industry')
  UNION ALL SELECT 'pain_points', label, count, k FROM pd UNION ALL SELECT 'tool_preferences', label, count, k FROM td)
SELECT dimension, label, count FROM allc QUALIFY row_number() OVER (PARTITION BY dimension ORDER BY count DESC, k) = 1"""


@register("modes", _MODES_SQL)
def modes(spark, sf):
    """most common type / stage / industry / pain point / tool, first seen wins ties."""
    return ST.modes(cells(spark, sf))


@register("top3_per_stage", PROF + STAGE_LABELS + """
SELECT business_stage, kind, row_number() OVER (PARTITION BY business_stage, kind ORDER BY count DESC, k) AS rank, label, count,
  round(count * 100.0 / sum(count) OVER (PARTITION BY business_stage, kind), 6) AS pct
FROM c QUALIFY rank <= 3""")
def top3_per_stage(spark, sf):
    """Top-3 pain points / tools / budgets per stage with % inside the stage's counter."""
    return ST.top3_per_stage(cells(spark, sf))


@register("flow_top5", PROF + f", {LABEL_DIST}, {_listdist('pd', 'pain_points')}, {_listdist('td', 'tool_preferences')}" + """
, allc AS (SELECT 'segment' AS level, label, count, first_seq * 1000 AS k FROM ldist WHERE dimension = 'business_stage'
  UNION ALL SELECT 'pain_point', label, count, k FROM pd UNION ALL SELECT 'tool', label, count, k FROM td)
SELECT level, row_number() OVER (PARTITION BY level ORDER BY count DESC, k) AS rank, label, count FROM allc QUALIFY rank <= 5""")
def flow_top5(spark, sf):
    """The three top-5 flow lists (segments, pain points, tools)."""
    return ST.flow_top5(cells(spark, sf))


@register("stage_ranking", PROF + """
, s AS (SELECT business_stage, avg(readiness_score) AS avg_score, count(*) AS posters, min(first_seq) AS first_seq
  FROM prof WHERE business_stage IS NOT NULL GROUP BY business_stage)
SELECT row_number() OVER (ORDER BY avg_score DESC, first_seq) AS rank, business_stage, round(avg_score, 6) AS avg_score, posters,
  row_number() OVER (ORDER BY avg_score DESC, first_seq) = 1 AS most_ready,
  row_number() OVER (ORDER BY avg_score DESC, first_seq) = count(*) OVER () AS least_ready FROM s""")
def stage_ranking(spark, sf):
    """Stages ranked by average readiness; most / least ready."""
    return ST.stage_ranking(cells(spark, sf))


@register("breakdown_share", PROF + f", {LABEL_DIST}, {_listdist('pd', 'pain_points')}, {_listdist('td', 'tool_preferences')}" + """
, allc AS (SELECT dimension, label, count, first_seq * 1000 AS k, 0 AS lst FROM ldist
  UNION ALL SELECT 'pain_points', label, count, k, 1 FROM pd UNION ALL SELECT 'tool_preferences', label, count, k, 1 FROM td)
SELECT dimension, row_number() OVER (PARTITION BY dimension ORDER BY count DESC, k) AS rank, label, count,
  round(count * 100.0 / CASE WHEN lst = 1 THEN sum(count) OVER (PARTITION BY dimension) ELSE (SELECT count(*) FROM prof) END, 6) AS pct
FROM allc""")
def breakdown_share(spark, sf):
    """Breakdown tables (labels over posters, tags/tools over their distribution sum)."""
    return ST.breakdown_share(cells(spark, sf))


@register("bar_units", PROF + f", {LABEL_DIST}" + """
, u AS (SELECT 'business_stage' AS chart, label, count, 50 AS width FROM ldist WHERE dimension = 'business_stage'
  UNION ALL SELECT 'industry', label, count, 40 FROM ldist WHERE dimension = 'industry'
  UNION ALL SELECT 'team_size', team_size, count(*), 30 FROM prof GROUP BY team_size)
SELECT chart, label, count,
  CAST(floor(count * CASE WHEN max(count) OVER w > 0 THEN width / max(count) OVER w ELSE 1.0 END) AS BIGINT) AS bar,
  round(count / sum(count) OVER w * 100, 6) AS pct
FROM u WINDOW w AS (PARTITION BY chart)""")
def bar_units(spark, sf):
    """Bar lengths and % of sum for the stage, industry and team-size charts."""
    return ST.bar_units(cells(spark, sf))


@register("funnel", PROF + f", {LABEL_DIST}" + f"""
SELECT CAST({G.scale_index('label', L.TECH_LEVELS)} AS BIGINT) AS level_idx, label AS tech_level, count,
  CAST(floor(count / max(count) OVER () * 50) AS BIGINT) AS bar,
  CAST(floor((50 - floor(count / max(count) OVER () * 50)) / 2) AS BIGINT) AS pad,
  round(count / sum(count) OVER () * 100, 6) AS pct
FROM ldist WHERE dimension = 'tech_level'""")
def funnel(spark, sf):
    """Technical-level funnel in declared order."""
    return ST.funnel(cells(spark, sf))


@register("radar_norm", PROF + """
, s AS (SELECT business_stage, avg(readiness_score) AS a FROM prof WHERE business_stage IS NOT NULL GROUP BY business_stage)
SELECT business_stage, round(a, 6) AS avg_score, round(a / max(a) OVER () * 100, 6) AS normalized,
  CAST(floor(a / max(a) OVER () * 100 / 5) AS BIGINT) AS blocks FROM s""")
def radar_norm(spark, sf):
    """Readiness per stage normalised to best = 100."""
    return ST.radar_norm(cells(spark, sf))


@register("heatmap_bucket", PROF + f"""
, g AS (SELECT s.business_stage, m.target_market FROM {_vals('business_stage', L.BUSINESS_STAGES)} s CROSS JOIN {_vals('target_market', L.TARGET_MARKETS)} m),
c AS (SELECT business_stage, target_market, count(*) AS count FROM prof WHERE business_stage IS NOT NULL AND target_market IS NOT NULL GROUP BY ALL),
j AS (SELECT g.business_stage, g.target_market, coalesce(c.count, 0) AS count FROM g LEFT JOIN c USING (business_stage, target_market))
SELECT business_stage, target_market, CAST(count AS BIGINT) AS count,
  CASE WHEN count <= 0 THEN 'none' WHEN count / max(count) OVER () > 0.7 THEN 'high'
       WHEN count / max(count) OVER () > 0.4 THEN 'mid' ELSE 'low' END AS bucket FROM j""")
def heatmap_bucket(spark, sf):
    """Stage x market heat-map buckets over the full grid."""
    return ST.heatmap_bucket(cells(spark, sf))


@register("tree_drilldown", PROF + """
, st AS (SELECT business_stage, count(*) AS stage_count, min(first_seq) AS f FROM prof WHERE business_stage IS NOT NULL GROUP BY business_stage),
sr AS (SELECT *, row_number() OVER (ORDER BY stage_count DESC, f) AS stage_rank FROM st),
ty AS (SELECT business_stage, business_type, count(*) AS type_count, min(first_seq) AS f FROM prof WHERE business_stage IS NOT NULL AND business_type IS NOT NULL GROUP BY business_stage, business_type)
SELECT stage_rank, st.business_stage, st.stage_count, round(st.stage_count / (SELECT count(*) FROM prof) * 100, 6) AS stage_pct,
  CASE WHEN ty.business_type IS NOT NULL THEN row_number() OVER (PARTITION BY st.business_stage ORDER BY ty.type_count DESC, ty.f) END AS type_rank,
  ty.business_type, ty.type_count, round(ty.type_count / st.stage_count * 100, 6) AS type_pct
FROM sr st LEFT JOIN ty ON ty.business_stage = st.business_stage""")
def tree_drilldown(spark, sf):
    """Stage -> business type drill-down with shares."""
    return ST.tree_drilldown(cells(spark, sf))


@register("pie_units", PROF + """
, d AS (SELECT business_type, count(*) AS count FROM prof WHERE business_type IS NOT NULL GROUP BY ALL)
SELECT business_type, count, round(count / sum(count) OVER () * 100, 6) AS pct,
  CAST(floor(count / sum(count) OVER () * 100 / 5) AS BIGINT) AS slices FROM d""")
def pie_units(spark, sf):
    """Business-type pie slices."""
    return ST.pie_units(cells(spark, sf))


@register("composition", PROF + f"""
SELECT business_type, CAST({G.scale_index('business_stage', L.BUSINESS_STAGES)} AS BIGINT) AS position, business_stage, count(*) AS count
FROM prof WHERE business_stage IS NOT NULL AND business_type IS NOT NULL GROUP BY ALL""")
def composition(spark, sf):
    """Non-zero stage composition per business type in declared order."""
    return ST.composition(cells(spark, sf))
