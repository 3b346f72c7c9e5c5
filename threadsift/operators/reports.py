"""Ranking, top-k and share-of-total report tables.

All inputs here are *aggregated* tables (one row per label, per label pair,
or per segment x label), whose size is bounded by the lexicons and scales,
not by the number of posts.  Windows without a partition key therefore run on
a handful of rows; windows with a partition key partition by the segment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def rank_by(df: DataFrame, order: list[Column], k: int | None = None, part: list[str] | None = None,
            out: str = "rank") -> DataFrame:
    """``row_number`` over (optional partition) by ``order``; keep ``<= k`` when given."""
    w = Window.partitionBy(*part).orderBy(*order) if part else Window.orderBy(*order)
    r = df.withColumn(out, F.row_number().over(w))
    return r.filter(F.col(out) <= k) if k else r


def share(df: DataFrame, count: str = "count", part: list[str] | None = None, out: str = "pct",
          total: Column | None = None) -> DataFrame:
    """Count as % of the (partition) sum of counts, or of an explicit total."""
    denom = total if total is not None else F.sum(count).over(Window.partitionBy(*part) if part else Window.partitionBy())
    return df.withColumn(out, F.round(F.col(count) * 100.0 / denom, 6))


def scale_df(spark: SparkSession, name: str, labels: list[str]) -> DataFrame:
    """Ordinal scale as a tiny table ``(name, name_idx)``."""
    return spark.createDataFrame([(l, i) for i, l in enumerate(labels)], f"{name} string, {name}_idx int")


def bar_units(df: DataFrame, value: str, width: int, out: str = "bar") -> DataFrame:
    """``int(value * width / max(value))``; 1.0 scale when max is 0."""
    mx = F.max(value).over(Window.partitionBy())
    scale = F.when(mx > 0, F.lit(float(width)) / mx).otherwise(F.lit(1.0))
    return df.withColumn(out, F.floor(F.col(value) * scale).cast("int"))


def heat_bucket(count: Column, max_count: Column) -> Column:
    """>0.7 high, >0.4 mid, >0 low, 0 none (count relative to the grid max)."""
    x = count / max_count
    return (F.when(count <= 0, F.lit("none")).when(x > 0.7, F.lit("high"))
            .when(x > 0.4, F.lit("mid")).otherwise(F.lit("low")))


def rounds_from_counts(df: DataFrame, round_col: str = "round", new_col: str = "new_posts") -> DataFrame:
    """Running total and idle-run length over ingest rounds (gaps and islands).

    ``island`` counts rounds with new posts so far; inside an island the idle run is
    the position after its opening round.  Rounds are bounded by time/batches, not data.
    """
    w = Window.orderBy(round_col).rowsBetween(Window.unboundedPreceding, 0)
    r = (df.withColumn("total_posts", F.sum(new_col).over(w).cast("long"))
         .withColumn("__island", F.sum(F.when(F.col(new_col) > 0, 1).otherwise(0)).over(w)))
    pos = F.row_number().over(Window.partitionBy("__island").orderBy(round_col)) - F.when(F.col("__island") > 0, 1).otherwise(0)
    return r.withColumn("idle_run", F.when(F.col(new_col) > 0, F.lit(0)).otherwise(pos).cast("long")).drop("__island")


def stop_round(rounds: DataFrame, idle_limit: int = 10, round_col: str = "round") -> DataFrame:
    """H5: first round whose idle run reaches the limit (the bounded-run stop rule)."""
    return rounds.agg(F.min(F.when(F.col("idle_run") == idle_limit, F.col(round_col))).alias("stop_round"),
                      F.max("idle_run").alias("longest_idle_run"))
