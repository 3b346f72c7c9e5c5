"""Profile scoring: team size (D8), readiness score (D9), average ordinal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadsift import lexicons as L
from threadsift.functions.text import col_


def scale_index(c, scale: list[str]) -> Column:
    """0-based index of a label in an ordinal scale; NULL for NULL; 0 for an unknown label."""
    m = F.create_map(*[x for i, s in enumerate(scale) for x in (F.lit(s), F.lit(i))])
    x = col_(c)
    return F.when(x.isNotNull(), F.coalesce(m[x], F.lit(0)))


def team_size(business_type, post_count) -> Column:
    """Solo / startup split on post_count > 5 / SME / agency / Unknown (checked in this order)."""
    t = col_(business_type)
    ts = L.TEAM_SIZE
    return (F.when(t.isNull(), F.lit(ts["unknown"]))
            .when(t.contains("Freelancer/Solo") | F.lower(t).contains("solo"), F.lit(ts["solo"]))
            .when(t.contains("Startup"),
                  F.when(col_(post_count) > 5, F.lit(ts["startup_large"])).otherwise(F.lit(ts["startup_small"])))
            .when(t.contains("SME"), F.lit(ts["sme"]))
            .when(t.contains("Agency"), F.lit(ts["agency"]))
            .otherwise(F.lit(ts["unknown"])))


def readiness_raw(budget_range, tech_level, business_stage, n_tools) -> Column:
    """D9 before rounding: budget, tech, stage terms twice each (direct + inferred) plus tool adoption."""
    w = L.READINESS_WEIGHTS
    nb, nt, ns = len(L.BUDGET_RANGES), len(L.TECH_LEVELS), len(L.BUSINESS_STAGES)
    b = scale_index(budget_range, L.BUDGET_RANGES) + 1
    t = scale_index(tech_level, L.TECH_LEVELS) + 1
    s = scale_index(business_stage, L.BUSINESS_STAGES) + 1
    z = F.lit(0.0)
    terms = [
        F.coalesce(b * (w["budget"] / nb), z),
        F.coalesce(t * (w["tech_capability"] / nt), z),
        F.coalesce(s * (w["business_stage"] / ns), z),
        F.coalesce((t / nt) * w["implementation_capability"], z),
        F.coalesce((b / nb) * w["willingness_to_pay"], z),
        F.coalesce((s / ns) * w["pain_tolerance"], z),
        F.least(F.coalesce(col_(n_tools), F.lit(0)) / F.lit(3.0), F.lit(1.0)) * w["tool_adoption"],
    ]
    total = terms[0]
    for x in terms[1:]:
        total = total + x
    return total


def readiness_score(budget_range, tech_level, business_stage, n_tools) -> Column:
    """Half-even rounding (Python ``round``) capped at 100, as an integer."""
    raw = readiness_raw(budget_range, tech_level, business_stage, n_tools)
    # round the double to 9 places first so float noise (e.g. 7.499999999) cannot flip the half-even step
    return F.least(F.bround(F.round(raw, 9), 0), F.lit(100.0)).cast("int")


def average_budget_label(avg_index) -> Column:
    """Average 1-based budget index -> label by the 1.5 / 2.5 / 3.5 thresholds."""
    a = col_(avg_index)
    t1, t2, t3 = L.BUDGET_AVG_THRESHOLDS
    r = L.BUDGET_RANGES
    return (F.when(a.isNull(), F.lit(None).cast("string"))
            .when(a < t1, F.lit(r[0])).when(a < t2, F.lit(r[1])).when(a < t3, F.lit(r[2])).otherwise(F.lit(r[3])))
