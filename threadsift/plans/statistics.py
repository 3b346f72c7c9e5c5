"""Community statistics (F8-F24) and report tables (G4-G14) from one report cube.

``report_cells`` rolls the ``profiles`` table (one row per author) up by GROUPING SETS: one Expand and
one aggregation give every counter that any section needs, as one row per cell, told apart by
``grouping_id``.  The cells are bounded by the label scales and lexicons (some hundred rows) and are
written once; the sections read nothing else, so profiles are built and read once a report.

Tie order follows the reference's insertion order: posters are visited by
the seq of their first post, so a label's tie key is the smallest
``first_seq`` among posters carrying it; for tag lists it is
``(first_seq, position in the poster's list)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadsift import lexicons as L
from threadsift.functions import scoring as SC
from threadsift.operators.reports import heat_bucket, rank_by
from threadsift.plans.demographics import LABEL_COLS
from threadsift.plans.pages import stored

R6 = 6


def _r(c: Column) -> Column:
    return F.round(c, R6)


# ---------------------------------------------------------------- the cube
LISTS = ["pain_points", "tool_preferences"]
_AXES = ["kind", "label", *LABEL_COLS, "team_size"]
PAIRS = [("business_type", "business_stage"), ("business_stage", "target_market"), ("business_stage", "budget_range")]
#: name of a grouping set -> the columns it groups by
SETS = ({"all": ["kind"], "list": ["kind", "label"], "stage_list": ["kind", "label", "business_stage"]}
        | {c: ["kind", c] for c in [*LABEL_COLS, "team_size"]} | {f"{a}/{b}": ["kind", a, b] for a, b in PAIRS})
_PLACES = 1 << 10  # a list has fewer entries than this


def report_cells(prof: DataFrame) -> DataFrame:
    """(what, kind, the axes, count, posts, engagement, readiness, low, high, first_seq, pos): one row per cell of
    every grouping set.  A poster is a row of kind ``poster`` and one more for each entry of its lists."""
    entries = F.concat(F.array(F.struct(F.lit("poster").alias("kind"), F.lit(None).cast("string").alias("label"), F.lit(0).alias("pos"))),
                       *[F.expr(f"transform({c}, (x, i) -> struct('{c}' AS kind, x AS label, i AS pos))") for c in LISTS])
    rows = prof.select("first_seq", "post_count", "total_engagement", "readiness_score", *LABEL_COLS, "team_size", F.inline(entries))
    cube = rows.groupingSets([[F.col(c) for c in cols] for cols in SETS.values()], *_AXES).agg(
        F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("count"), F.sum("post_count").cast("long").alias("posts"),
        F.sum("total_engagement").cast("long").alias("engagement"), F.sum("readiness_score").cast("double").alias("readiness"),
        F.min("readiness_score").cast("long").alias("low"), F.max("readiness_score").cast("long").alias("high"),
        F.min(F.col("first_seq") * _PLACES + F.col("pos")).alias("k"))
    what = F.lit(None).cast("string")
    for name, cols in SETS.items():
        gid = sum(1 << (len(_AXES) - 1 - i) for i, c in enumerate(_AXES) if c not in cols)
        what = F.when(F.col("gid") == gid, F.lit(name)).otherwise(what)
    cells = cube.withColumn("what", what).filter((F.col("kind") == "poster") != F.col("what").isin("list", "stage_list"))
    return cells.select("what", *_AXES, "count", "posts", "engagement", "readiness", "low", "high",
                        F.expr(f"k div {_PLACES}").alias("first_seq"), (F.col("k") % _PLACES).cast("int").alias("pos"))


def _cells(cells: DataFrame, what: str) -> DataFrame:
    """The cells of one grouping set whose labels are all present."""
    d = cells.filter(F.col("what") == what)
    for c in SETS[what]:
        d = d.filter(F.col(c).isNotNull())
    return d


# ---------------------------------------------------------------- aggregates
def _posters(cells: DataFrame) -> DataFrame:
    """One row, also without any poster: posters, posts, engagement."""
    total = _cells(cells, "all")
    return total.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(n) for c, n in (("count", "total_posters"), ("posts", "total_posts"), ("engagement", "total_engagement"))])


def community_totals(cells: DataFrame) -> DataFrame:
    """F8 + F24: posters, posts, engagement, and per-poster averages with a zero guard."""
    return _posters(cells).select("*",
                             _r(F.col("total_engagement") / F.greatest(F.col("total_posters"), F.lit(1))).alias("avg_engagement_per_poster"),
                             _r(F.col("total_posts") / F.greatest(F.col("total_posters"), F.lit(1))).alias("avg_posts_per_poster"))


def label_distributions(cells: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(dimension, label, count, first_seq) for the six label columns; NULL skipped."""
    cols = cols or LABEL_COLS
    d = cells.filter(F.col("what").isin(cols)).select(F.col("what").alias("dimension"), F.coalesce(*[F.when(F.col("what") == c, F.col(c)) for c in cols]).alias("label"),
                                                      "count", "first_seq")
    return d.filter(F.col("label").isNotNull())


def crosstab(cells: DataFrame, a: str, b: str) -> DataFrame:
    """counts of (a, b) where both are non-null; one of ``PAIRS``, either way round."""
    what = f"{a}/{b}" if (a, b) in PAIRS else f"{b}/{a}"
    return _cells(cells, what).select(a, b, "count", "first_seq")


def list_distribution(cells: DataFrame, col: str) -> DataFrame:
    """how many posters carry each tag/tool; tie key (first_seq, position)."""
    return _cells(cells, "list").filter(F.col("kind") == col).select("label", "count", "first_seq", "pos")


def readiness_by_stage(cells: DataFrame) -> DataFrame:
    """average / min / max readiness and poster count per stage."""
    return _stage_scores(cells).withColumn("avg_score", _r(F.col("avg_score")))


def _stage_scores(cells: DataFrame) -> DataFrame:
    return _cells(cells, "business_stage").select("business_stage", (F.col("readiness") / F.col("count")).alias("avg_score"), F.col("low").alias("min_score"),
                                                  F.col("high").alias("max_score"), F.col("count").alias("posters"), "first_seq")


def engagement_by_type(cells: DataFrame) -> DataFrame:
    """engagement per business type (sum, average, posters)."""
    return _cells(cells, "business_type").select("business_type", F.col("engagement").alias("total_engagement"),
                                                 _r(F.col("engagement") / F.col("count")).alias("avg_engagement"), F.col("count").alias("posters"))


def team_size_distribution(cells: DataFrame) -> DataFrame:
    """F14."""
    return _cells(cells, "team_size").select("team_size", "count", "first_seq")


def scale_grid(spark, rows: tuple[str, list[str]], cols: tuple[str, list[str]]) -> DataFrame:
    """The fixed (row x col) domain with declared positions."""
    (rn, rv), (cn, cv) = rows, cols
    data = [(r, i, c, j) for i, r in enumerate(rv) for j, c in enumerate(cv)]
    return spark.createDataFrame(data, f"{rn} string, {rn}_idx int, {cn} string, {cn}_idx int")


def budget_stage_grid(cells: DataFrame) -> DataFrame:
    """stage x budget counts over the full 4 x 4 scale grid (missing cells 0)."""
    g = scale_grid(cells.sparkSession, ("business_stage", L.BUSINESS_STAGES), ("budget_range", L.BUDGET_RANGES))
    c = crosstab(cells, "business_stage", "budget_range").drop("first_seq")
    return (g.join(F.broadcast(c), ["business_stage", "budget_range"], "left")
            .select("business_stage", "budget_range", F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count")))


def _stages(cells: DataFrame) -> DataFrame:
    return cells.sparkSession.createDataFrame([(s, i) for i, s in enumerate(L.BUSINESS_STAGES)], "business_stage string, position long")


def _counters(cells: DataFrame) -> DataFrame:
    """(business_stage, pain_points, tools, budgets): ``label=count`` by falling count, then first seen."""
    c = _stage_labels(cells)
    c = c.groupBy("business_stage", "kind").agg(F.array_sort(F.collect_list(  # at most a label of the lexicon each
        F.struct((-F.col("count")).alias("n"), "first_seq", "pos", "label"))).alias("l"))
    said = F.array_join(F.transform("l", lambda x: F.concat(x["label"], F.lit("="), (-x["n"]).cast("string"))), ", ")
    return c.groupBy("business_stage").agg(*[F.max(F.when(F.col("kind") == k, said)).alias(n) for k, n in
                                             (("pain_point", "pain_points"), ("tool", "tools"), ("budget", "budgets"))])


def segment_profile(cells: DataFrame) -> DataFrame:
    """F19 (+E7): per stage of the scale: posters, average engagement (NULL when none) and the counters of
    pain points, tools and budgets ('' when none)."""
    agg = _cells(cells, "business_stage").select("business_stage", F.col("count").alias("posters"), _r(F.col("engagement") / F.col("count")).alias("avg_engagement"))
    return (_stages(cells).join(agg, "business_stage", "left").join(_counters(cells), "business_stage", "left")
            .select("business_stage", F.coalesce("posters", F.lit(0)).cast("long").alias("posters"), "avg_engagement",
                    *[F.coalesce(c, F.lit("")).alias(c) for c in ("pain_points", "tools", "budgets")]))


def budget_by_stage(cells: DataFrame) -> DataFrame:
    """budget ranges inside each stage (count > 0) with both scale positions, % of the stage's budget
    total and bar units; a stage without budget data has one row without a range."""
    c = crosstab(cells, "business_stage", "budget_range").drop("first_seq")
    w = Window.partitionBy("business_stage")
    pct = F.col("count") * 100.0 / F.sum("count").over(w)
    return (_stages(cells).join(c, "business_stage", "left")
            .select("position", "business_stage", SC.scale_index(F.col("budget_range"), L.BUDGET_RANGES).cast("long").alias("budget_position"),
                    "budget_range", F.coalesce("count", F.lit(0)).cast("long").alias("count"), _r(pct).alias("pct"), F.floor(pct / 5).cast("long").alias("bar")))


def budget_coverage(cells: DataFrame) -> DataFrame:
    """F21 + D10: posters with a budget, their share, and the average budget range."""
    b = _cells(cells, "budget_range").withColumn("i", SC.scale_index(F.col("budget_range"), L.BUDGET_RANGES) + 1)
    a = (b.agg(F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("with_budget"), (F.sum(F.col("i") * F.col("count")) / F.sum("count")).alias("_avg"))
         .crossJoin(_posters(cells)))  # one row each
    return a.select("with_budget", "total_posters",
                    _r(F.when(F.col("total_posters") > 0, F.col("with_budget") * 100.0 / F.col("total_posters"))).alias("pct"),
                    _r(F.col("_avg")).alias("avg_budget_index"),
                    SC.average_budget_label(F.col("_avg")).alias("avg_budget_range"))


def overall_readiness(cells: DataFrame) -> DataFrame:
    """mean readiness over posters that have a stage."""
    return _cells(cells, "business_stage").agg(_r(F.sum("readiness") / F.sum("count")).alias("overall_readiness"),
                                              F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("scored_posters"))


def modes(cells: DataFrame) -> DataFrame:
    """most common type, stage, industry, pain point and tool (first seen wins ties)."""
    lab = label_distributions(cells, ["business_type", "business_stage", "industry"]) \
        .withColumn("pos", F.lit(0))
    tg = [list_distribution(cells, c).withColumn("dimension", F.lit(c)) for c in ("pain_points", "tool_preferences")]
    allc = lab.unionByName(tg[0]).unionByName(tg[1])
    r = rank_by(allc, [F.col("count").desc(), F.col("first_seq"), F.col("pos")], 1, part=["dimension"])
    return r.select("dimension", "label", F.col("count").cast("long").alias("count"))


# ------------------------------------------------------------- report tables
def _ranked(df: DataFrame, part: list[str] | None, k: int | None, keys=("first_seq",)) -> DataFrame:
    order = [F.col("count").desc()] + [F.col(x) for x in keys]
    return rank_by(df, order, k, part=part).withColumn("rank", F.col("rank").cast("long"))


def _stage_labels(cells: DataFrame) -> DataFrame:
    """(business_stage, kind, label, count, first_seq, pos) of pain points, tools and budgets per stage."""
    named = F.when(F.col("kind") == LISTS[0], F.lit("pain_point")).otherwise(F.lit("tool"))
    tags = _cells(cells, "stage_list").select("business_stage", named.alias("kind"), "label", "count", "first_seq", "pos")
    bud = crosstab(cells, "business_stage", "budget_range").select("business_stage", F.lit("budget").alias("kind"), F.col("budget_range").alias("label"), "count", "first_seq", F.lit(0).alias("pos"))
    return tags.unionByName(bud)


def top3_per_stage(cells: DataFrame, k: int = 3) -> DataFrame:
    """Per stage, top-k pain points, tools and budgets with % of the stage's counter."""
    c = _stage_labels(cells)
    c = c.withColumn("pct", _r(F.col("count") * 100.0 / F.sum("count").over(Window.partitionBy("business_stage", "kind"))))
    r = _ranked(c, ["business_stage", "kind"], k, ("first_seq", "pos"))
    return r.select("business_stage", "kind", "rank", "label", F.col("count").cast("long").alias("count"), "pct")


def flow_top5(cells: DataFrame, k: int = 5) -> DataFrame:
    """Top-5 stages, pain points and tools (three ranked lists)."""
    st = label_distributions(cells, ["business_stage"]).select(F.lit("segment").alias("level"), "label", "count", "first_seq", F.lit(0).alias("pos"))
    pp = list_distribution(cells, "pain_points").select(F.lit("pain_point").alias("level"), "label", "count", "first_seq", "pos")
    tl = list_distribution(cells, "tool_preferences").select(F.lit("tool").alias("level"), "label", "count", "first_seq", "pos")
    r = _ranked(st.unionByName(pp).unionByName(tl), ["level"], k, ("first_seq", "pos"))
    return r.select("level", "rank", "label", F.col("count").cast("long").alias("count"))


def stage_ranking(cells: DataFrame) -> DataFrame:
    """Stages by average readiness (ties by first appearance), with most / least ready flags."""
    s = _stage_scores(cells)  # ranked on the exact average, rounded last
    w = Window.orderBy(F.col("avg_score").desc(), F.col("first_seq"))
    r = s.withColumn("rank", F.row_number().over(w).cast("long"))
    n = F.count(F.lit(1)).over(Window.partitionBy())
    return r.select("rank", "business_stage", _r(F.col("avg_score")).alias("avg_score"), "posters",
                    (F.col("rank") == 1).alias("most_ready"), (F.col("rank") == n).alias("least_ready"))


def breakdown_share(cells: DataFrame) -> DataFrame:
    """Count and % per label; labels over total posters, tags/tools over the distribution sum."""
    lab = label_distributions(cells).withColumn("pos", F.lit(0))
    tg = [list_distribution(cells, c).withColumn("dimension", F.lit(c)) for c in ("pain_points", "tool_preferences")]
    posters = _posters(cells).select(F.col("total_posters").alias("_posters"))
    allc = lab.unionByName(tg[0]).unionByName(tg[1]).crossJoin(posters)  # one-row side
    dist_sum = F.sum("count").over(Window.partitionBy("dimension"))
    denom = F.when(F.col("dimension").isin("pain_points", "tool_preferences"), dist_sum).otherwise(F.col("_posters"))
    r = allc.withColumn("pct", _r(F.col("count") * 100.0 / denom))
    r = _ranked(r, ["dimension"], None, ("first_seq", "pos"))
    return r.select("dimension", "rank", "label", F.col("count").cast("long").alias("count"), "pct")


def bar_units(cells: DataFrame) -> DataFrame:
    """Bar lengths int(value * width / max) and % of sum: stage (50), industry (40), team size (30)."""
    parts = []
    for chart, col, width in (("business_stage", "business_stage", 50), ("industry", "industry", 40), ("team_size", "team_size", 30)):
        if col == "team_size":
            d = team_size_distribution(cells).withColumnRenamed("team_size", "label")
        else:
            d = label_distributions(cells, [col]).drop("dimension")
        parts.append(d.withColumn("chart", F.lit(chart)).withColumn("width", F.lit(width)))
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    w = Window.partitionBy("chart")
    mx = F.max("count").over(w)
    scale = F.when(mx > 0, F.col("width") / mx).otherwise(F.lit(1.0))
    return u.select("chart", "label", F.col("count").cast("long").alias("count"),
                    F.floor(F.col("count") * scale).cast("long").alias("bar"),
                    _r(F.col("count") / F.sum("count").over(w) * 100).alias("pct"))


def funnel(cells: DataFrame, width: int = 50) -> DataFrame:
    """Tech levels in declared order (present ones), width vs max, centring pad, % of sum."""
    d = label_distributions(cells, ["tech_level"]).select(F.col("label").alias("tech_level"), "count")
    d = d.withColumn("level_idx", SC.scale_index(F.col("tech_level"), L.TECH_LEVELS).cast("long"))
    w = Window.partitionBy()
    bar = F.floor(F.col("count") / F.max("count").over(w) * width)
    return d.select("level_idx", "tech_level", F.col("count").cast("long").alias("count"),
                    bar.cast("long").alias("bar"), F.floor((F.lit(width) - bar) / 2).cast("long").alias("pad"),
                    _r(F.col("count") / F.sum("count").over(w) * 100).alias("pct"))


def radar_norm(cells: DataFrame) -> DataFrame:
    """Average readiness per stage normalised so the best stage is 100; 20-block bar."""
    s = _stage_scores(cells).select("business_stage", F.col("avg_score").alias("avg"))
    norm = F.col("avg") / F.max("avg").over(Window.partitionBy()) * 100
    return s.select("business_stage", _r(F.col("avg")).alias("avg_score"), _r(norm).alias("normalized"),
                    F.floor(norm / 5).cast("long").alias("blocks"))


def heatmap_bucket(cells: DataFrame) -> DataFrame:
    """Stage x market grid with high / mid / low / none buckets relative to the grid max."""
    g = scale_grid(cells.sparkSession, ("business_stage", L.BUSINESS_STAGES), ("target_market", L.TARGET_MARKETS))
    c = crosstab(cells, "business_stage", "target_market").drop("first_seq")
    j = g.join(F.broadcast(c), ["business_stage", "target_market"], "left").withColumn("count", F.coalesce("count", F.lit(0)))
    mx = F.max("count").over(Window.partitionBy())
    return j.select("business_stage", "target_market", F.col("count").cast("long").alias("count"),
                    heat_bucket(F.col("count"), mx).alias("bucket"))


def tree_drilldown(cells: DataFrame) -> DataFrame:
    """Stage (count, % of posters) -> business type (count, % of stage), both in falling count, then
    first seen; a stage without typed posters has one row without a type."""
    total = _posters(cells).select(F.col("total_posters").alias("_total"))
    st = _cells(cells, "business_stage").select("business_stage", F.col("count").alias("stage_count"), F.col("first_seq").alias("f"))
    st = st.withColumn("stage_rank", F.row_number().over(Window.orderBy(F.col("stage_count").desc(), "f")).cast("long"))
    ty = crosstab(cells, "business_stage", "business_type").withColumnRenamed("count", "type_count")
    ty = ty.withColumn("type_rank", F.row_number().over(Window.partitionBy("business_stage").orderBy(F.col("type_count").desc(), "first_seq")).cast("long"))
    j = st.join(ty, "business_stage", "left").crossJoin(total)  # one-row side
    return j.select("stage_rank", "business_stage", F.col("stage_count").cast("long").alias("stage_count"),
                    _r(F.col("stage_count") / F.col("_total") * 100).alias("stage_pct"),
                    "type_rank", "business_type", F.col("type_count").cast("long").alias("type_count"),
                    _r(F.col("type_count") / F.col("stage_count") * 100).alias("type_pct"))


def pie_units(cells: DataFrame) -> DataFrame:
    """Business-type pie: % of total and int(pct / 5) slices of 20."""
    d = label_distributions(cells, ["business_type"]).select(F.col("label").alias("business_type"), "count")
    pct = F.col("count") / F.sum("count").over(Window.partitionBy()) * 100
    return d.select("business_type", F.col("count").cast("long").alias("count"), _r(pct).alias("pct"),
                    F.floor(pct / 5).cast("long").alias("slices"))


def composition(cells: DataFrame) -> DataFrame:
    """Per business type, the non-zero stages in declared order with counts."""
    c = crosstab(cells, "business_type", "business_stage").drop("first_seq")
    return c.select("business_type", SC.scale_index(F.col("business_stage"), L.BUSINESS_STAGES).cast("long").alias("position"),
                    "business_stage", F.col("count").cast("long").alias("count"))


#: the sections of the demographic report, in order
SECTIONS = [
    "community_totals", "label_distributions", "stage_by_type", "market_by_stage", "pain_point_distribution",
    "tool_distribution", "readiness_by_stage", "engagement_by_type", "team_size_distribution", "budget_stage_grid",
    "segment_profile", "budget_by_stage", "budget_coverage", "overall_readiness", "modes",
    "top3_per_stage", "flow_top5", "stage_ranking", "breakdown_share", "bar_units",
    "funnel", "radar_norm", "heatmap_bucket", "tree_drilldown", "pie_units",
    "composition",
]


def report_sections(prof: DataFrame, names: list[str] | None = None) -> dict[str, DataFrame]:
    """Statistics and report tables of the demographic report, from one profiles table (A9 input).

    The profiles are read once, for the cells, which are written; sections are built from those, by name
    (plan construction has a driver cost), all 26 by default.
    """
    cells = stored(report_cells(prof), "report-cells")
    builders = {
        "community_totals": lambda: community_totals(cells),
        "label_distributions": lambda: label_distributions(cells),
        "stage_by_type": lambda: crosstab(cells, "business_type", "business_stage"),
        "market_by_stage": lambda: crosstab(cells, "business_stage", "target_market"),
        "pain_point_distribution": lambda: list_distribution(cells, "pain_points"),
        "tool_distribution": lambda: list_distribution(cells, "tool_preferences"),
        "readiness_by_stage": lambda: readiness_by_stage(cells),
        "engagement_by_type": lambda: engagement_by_type(cells),
        "team_size_distribution": lambda: team_size_distribution(cells),
        "budget_stage_grid": lambda: budget_stage_grid(cells),
        "segment_profile": lambda: segment_profile(cells),
        "budget_by_stage": lambda: budget_by_stage(cells),
        "budget_coverage": lambda: budget_coverage(cells),
        "overall_readiness": lambda: overall_readiness(cells),
        "modes": lambda: modes(cells),
        "top3_per_stage": lambda: top3_per_stage(cells),
        "flow_top5": lambda: flow_top5(cells),
        "stage_ranking": lambda: stage_ranking(cells),
        "breakdown_share": lambda: breakdown_share(cells),
        "bar_units": lambda: bar_units(cells),
        "funnel": lambda: funnel(cells),
        "radar_norm": lambda: radar_norm(cells),
        "heatmap_bucket": lambda: heatmap_bucket(cells),
        "tree_drilldown": lambda: tree_drilldown(cells),
        "pie_units": lambda: pie_units(cells),
        "composition": lambda: composition(cells),
    }
    return {n: builders[n]() for n in (names or list(builders))}
