"""Distributed running sums: range-sort, one total per partition, offsets from those totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadsift.llm.text import written


def running_sum(df: DataFrame, order: list[Column], value: Column, name: str, within: list[str] | None = None) -> DataFrame:
    """df with ``name``: the sum of ``value`` over the rows before a row in ``order`` (0 at first).

    ``within`` restarts the sum for each group; those columns must lead ``order``, so that a hot
    group spreads over as many range partitions as it needs.  Only one total per partition (and
    group) meets in the offsets; no task sees a whole group.  Rows that tie in all of ``order``
    may get either place.
    """
    within = within or []
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    v = f"__{name}_v"
    laid = written(df.withColumn(v, value).repartitionByRange(n, *order).withColumn("__pid", F.spark_partition_id()), "range")
    totals = laid.groupBy("__pid", *within).agg(F.sum(v).alias("__t"))
    # at most one row per partition and group boundary
    before = Window.partitionBy(*within).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1) if within \
        else Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = totals.select(F.col("__pid").alias("__p"), *[F.col(c).alias(f"__w{i}") for i, c in enumerate(within)],
                         F.coalesce(F.sum("__t").over(before), F.lit(0)).alias("__off"))
    own = Window.partitionBy("__pid", *within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = laid.withColumn("__own", F.coalesce(F.sum(v).over(own), F.lit(0)))
    on = F.col("__pid") == F.col("__p")
    for i, c in enumerate(within):
        on = on & F.col(c).eqNullSafe(F.col(f"__w{i}"))
    return (rows.join(offs, on, "left").withColumn(name, F.col("__off") + F.col("__own"))
            .drop("__pid", "__p", "__off", "__own", v, *[f"__w{i}" for i in range(len(within))]))
