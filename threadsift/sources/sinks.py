"""Sinks (A6-A9). All writes go through Spark's commit protocol, so a lost
executor or a killed job never leaves a half-written file visible."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_jsonl(df: DataFrame, path: str, max_records_per_file: int | None = None, rest: str | None = None) -> None:
    """Append one JSON object per line (atomic per task commit).  ``rest`` is a column of JSON objects whose
    fields stand beside the other columns (``readers.read_jsonl``)."""
    if rest:
        own = F.to_json(F.struct(*[F.col(c) for c in df.columns if c != rest]))
        inner = F.expr(f"substr({rest}, 2, length({rest}) - 2)")
        df = df.select(F.when(F.coalesce(inner, F.lit("")) == "", own).otherwise(F.concat(
            F.regexp_replace(own, r"\}$", ""),
            F.when(own == "{}", F.lit("")).otherwise(F.lit(",")), inner, F.lit("}"))).alias("value"))
    w = df.write.mode("append")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)  # the documented 30-per-file batching
    if rest:
        w.text(path)
    else:
        w.json(path)


def set_file_times(spark: SparkSession, paths: list[str], first: int, step: int = 1000) -> None:
    """Gives files modification times (milliseconds) that rise in the order of ``paths``, where the store can."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    for i, p in enumerate(paths):
        at = hadoop.Path(p)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).setTimes(at, first + i * step, -1)


def result_document(tag_stats: DataFrame, totals: DataFrame, samples: DataFrame) -> DataFrame:
    """One nested document ``{total_posts_analyzed, total_mentions, pain_points: [..], sample_posts: [..]}``;
    tags come in rank order, each with its counts by segment.

    Each input is already aggregated (bounded by the lexicon size / the sample size).
    """
    stats_map = tag_stats.agg(F.array_sort(F.collect_list(F.struct(*tag_stats.columns))).alias("pain_points"))
    sample_arr = samples.agg(F.array_sort(F.collect_list(F.struct(*samples.columns))).alias("sample_posts"))
    return totals.crossJoin(stats_map).crossJoin(sample_arr)


def write_document(doc: DataFrame, path: str) -> None:
    doc.coalesce(1).write.mode("overwrite").json(path)


def run_summary(posts: DataFrame, source: str, data_path: str) -> DataFrame:
    """One summary row (time, source, unique posts, data path)."""
    return posts.agg(F.count(F.lit(1)).alias("total_unique_posts")).select(
        F.current_timestamp().alias("timestamp"), F.lit(source).alias("group_url"),
        F.col("total_unique_posts"), F.lit(data_path).alias("data_file"))


def write_report(tables: dict[str, DataFrame], base: str, fmt: str = "parquet") -> dict[str, str]:
    """Every report section as a named output folder."""
    out = {}
    for name, df in tables.items():
        p = f"{base.rstrip('/')}/{name}"
        df.write.mode("overwrite").format(fmt).save(p)
        out[name] = p
    return out
