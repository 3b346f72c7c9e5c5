"""Mergeable summaries of ingest rounds: distinct keys (HyperLogLog) and quantiles (KLL).

A round writes one sketch a group; a total over all rounds merges the sketches and reads no post again.
Both are estimates with stated bounds; the exact ways stay the default of the reports.

Defined cases: NULL keys and values are not counted; a round without posts has no row; no rounds give
an estimate of 0 distinct keys and no quantile rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2^16 registers, 64 KB a sketch: a standard error of 0.4%, so 2% is five of them
LG_REGISTERS, DISTINCT_BOUND = 16, 0.02
#: rank error about 0.14%, so 1% is far outside
KLL_K, RANK_BOUND = 2000, 0.01


def distinct_sketches(posts: DataFrame, by: list[str], key: Column) -> DataFrame:
    """(by, keys): one sketch of the distinct keys of each round."""
    return posts.groupBy(*by).agg(F.hll_sketch_agg(key, LG_REGISTERS).alias("keys"))


def distinct_total(sketches: DataFrame) -> DataFrame:
    """One row: estimated distinct keys over all sketches, within DISTINCT_BOUND."""
    return sketches.agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("keys")), F.lit(0)).cast("long").alias("estimate"))


def quantile_sketches(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, values): one sketch of a whole-number column for each group and round."""
    return rows.groupBy(*by).agg(F.kll_sketch_agg_bigint(F.col(value).cast("long"), F.lit(KLL_K)).alias("values"))


def quantiles(sketches: DataFrame, by: list[str], points: dict[str, float]) -> DataFrame:
    """(by, a column per point): quantiles of the merged sketches, each within RANK_BOUND of its rank."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_bigint("values").alias("values"))
    return merged.select(*by, *[F.kll_sketch_get_quantile_bigint("values", F.lit(p)).alias(n) for n, p in points.items()])
