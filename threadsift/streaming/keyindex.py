"""Index of the dedup keys stored by earlier batches.

Keys lie in ``BUCKETS`` folders by a hash of the key, each batch in its own sub-folder.  Beside them
stands a Bloom filter per bucket, as rows (bucket, word, bits) that are united by ``bit_or``.  A batch
tests its keys against the filters first; only buckets that may hold one of them are opened, and only
keys that may be stored are joined.  A batch of new posts thus reads a few bytes a stored key, not the keys.

Everything is written under ``batch=<id>`` and read for smaller ids only, so a replayed batch finds what
it found before and writes the same again.  ``compacted`` merges the batches so far, which keeps the
number of files in proportion to the buckets and not to the batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
#: bits of a bucket's filter, and bits that a key sets; a fuller filter opens more buckets, never fewer keys
FILTER_BITS, HASHES = 1 << 22, 5
KEYS = "dedup_key string, batch long, bucket int"
FILTERS = "bucket int, word int, bits long, batch long"


def bucket_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(0)), F.lit(BUCKETS)).cast("int")


def _bits(df: DataFrame) -> DataFrame:
    """(bucket, dedup_key, word, mask) of the filter bits of every key."""
    at = F.array(*[F.pmod(F.xxhash64(F.col("dedup_key"), F.lit(k + 1)), F.lit(FILTER_BITS)) for k in range(HASHES)])
    return (df.select(bucket_of(F.col("dedup_key")).alias("bucket"), "dedup_key", F.explode(F.array_distinct(at)).alias("at"))
            .select("bucket", "dedup_key", F.shiftright("at", 6).cast("int").alias("word"), F.expr("shiftleft(1L, CAST(at % 64 AS INT))").alias("mask")))


def _stored(spark: SparkSession, path: str, schema: str, before: int) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path).filter(F.col("batch") < before)
    except Exception as e:  # noqa: BLE001 -- nothing stored yet
        if "PATH_NOT_FOUND" not in str(e) and "Path does not exist" not in str(e):
            raise
        return None


def add(fresh: DataFrame, batch_id: int, index: str) -> None:
    """The keys of ``fresh`` (dedup_key) as those of one batch."""
    keys = fresh.select("dedup_key", F.lit(batch_id).cast("long").alias("batch"), bucket_of(F.col("dedup_key")).alias("bucket"))
    # a file a bucket, of the keys alone
    base = index.rstrip("/")
    keys.drop("batch").repartition(BUCKETS, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{base}/keys/batch={batch_id}")
    (_bits(keys).groupBy("bucket", "word").agg(F.bit_or("mask").alias("bits"))
     .write.mode("overwrite").parquet(f"{base}/filters/batch={batch_id}"))


def may_be_stored(keys: DataFrame, index: str, before: int) -> DataFrame | None:
    """(bucket, dedup_key) of the keys whose bits are all set in the filters of batches before ``before``."""
    filters = _stored(keys.sparkSession, f"{index.rstrip('/')}/filters", FILTERS, before)
    if filters is None:
        return None
    united = filters.groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))
    bits = _bits(keys.select("dedup_key").distinct())
    # two bits of a key may share a word: one mask a word, then all words must agree
    need = bits.groupBy("bucket", "dedup_key", "word").agg(F.bit_or("mask").alias("mask"))
    return (need.join(united, ["bucket", "word"], "left")
            .groupBy("bucket", "dedup_key").agg(F.bool_and(F.coalesce(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"), F.lit(False))).alias("ok"))
            .filter("ok").select("bucket", "dedup_key"))


def stored_keys(spark: SparkSession, index: str, before: int, buckets: list[int]) -> DataFrame | None:
    """dedup_key of the given buckets, from batches before ``before``; other buckets' files are not opened."""
    keys = _stored(spark, f"{index.rstrip('/')}/keys", KEYS, before)
    return None if keys is None else keys.filter(F.col("bucket").isin(buckets)).select("dedup_key")


def unseen(df: DataFrame, batch_id: int, index: str) -> DataFrame:
    """The rows of ``df`` whose dedup_key no earlier batch stored."""
    maybe = may_be_stored(df, index, batch_id) if batch_id > 0 else None
    if maybe is None:
        return df
    buckets = [r["bucket"] for r in maybe.select("bucket").distinct().collect()]  # BUCKETS numbers at most
    if not buckets:
        return df
    return df.join(stored_keys(df.sparkSession, index, batch_id, buckets), "dedup_key", "left_anti")


def compacted(spark: SparkSession, index: str, target: str, before: int) -> None:
    """The index of the batches before ``before``, written to ``target`` as those of one batch 0."""
    keys = _stored(spark, f"{index.rstrip('/')}/keys", KEYS, before)
    if keys is not None:
        add(keys.select("dedup_key").distinct(), 0, target)
