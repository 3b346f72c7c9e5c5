"""Incremental ingest as Structured Streaming (H1-H6).

Each call processes what has landed since the last run (``availableNow``) and
stops, which is the streaming form of the reference's bounded rounds; the
checkpoint makes a restart resume without re-emitting (H3).  Three dedup plans:

* ``ingest_dedup``: ``dropDuplicates(["dedup_key"])`` -- state holds only the
  key column (H2); state grows with the number of distinct keys, exactly like
  the reference's in-memory set, and lives in the (RocksDB-capable) state store.
* ``ingest_first``: the smallest ``index`` per key as streaming state, for a defined survivor.
* ``ingest_anti_join``: ``foreachBatch`` that keeps the first row per key in
  the batch and leaves out the keys that earlier batches stored, by a bucketed key
  index with Bloom filters (``keyindex``), for very long histories where
  state-store size matters more than latency.

All paths (landing, sink, checkpoint) must be on shared storage; helpers
under ``threadsift.session.checkpoint_path`` derive them from
``spark.checkpoint.dir``.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from threadsift import schema as S
from threadsift.functions.identity import dedup_key
from threadsift.functions.text import content_ok, py_strip
from threadsift.operators.dedup import keep_first
from threadsift.streaming import keyindex as KI


def landing_stream(spark: SparkSession, landing: str, max_files: int | None = None, files: bool = False, bad: bool = False) -> DataFrame:
    """The posts of a JSON-lines landing folder as a stream; ``quarantine`` keeps its malformed lines.
    With ``files`` also file_time and file_name, with ``bad`` malformed lines too, told by _corrupt_record."""
    r = (spark.readStream.schema(S.POST_WITH_CORRUPT).option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", "_corrupt_record"))
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    posts = r.json(landing)
    if files:
        posts = posts.select("*", F.col("_metadata.file_modification_time").alias("file_time"), F.col("_metadata.file_name").alias("file_name"))
    return posts if bad else whole(posts)


def whole(posts: DataFrame) -> DataFrame:
    return posts.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def quarantine(spark: SparkSession, landing: str, path: str, checkpoint: str, max_files: int | None = None):
    """A3 on the stream: malformed lines of the landing folder, raw, into ``path``; blank lines are skipped."""
    r = spark.readStream
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    parsed = r.text(landing).filter(py_strip(F.col("value")) != "").select("value", F.from_json("value", S.POST_WITH_CORRUPT, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("r"))
    bad = parsed.filter(F.col("r").isNull() | F.col("r._corrupt_record").isNotNull()).select(F.col("value").alias("line"))
    q = (bad.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start(path))
    q.awaitTermination()
    return q


def prepared(stream: DataFrame) -> DataFrame:
    """B5 content filter + C16 key."""
    s = stream.withColumn("images", F.coalesce("images", F.array().cast("array<string>")))
    s = s.withColumns({"text": F.coalesce("text", F.lit("")), "url": F.coalesce("url", F.lit(""))})
    return s.filter(content_ok(F.col("text"), F.col("images"), F.col("url"))).withColumn(
        "dedup_key", dedup_key(F.col("url"), F.col("text")))


def ingest_dedup(spark: SparkSession, landing: str, sink: str, checkpoint: str, max_files: int | None = None,
                 event_time: str | None = None, watermark: str = "1 day"):
    """H1/H2/H3/H5: stateful dedup across rounds, parquet sink, bounded run.

    The reference has no event time, so by default the key state is unbounded (as
    its in-memory set).  A caller that has an event-time column can pass it: the
    dedup then uses ``dropDuplicatesWithinWatermark`` and state is evicted.
    """
    s = prepared(landing_stream(spark, landing, max_files))
    if event_time:
        return dedup_within(s.withColumn(event_time, F.col(event_time).cast("timestamp")), ["dedup_key"], event_time, watermark, sink, checkpoint)
    q = (s.dropDuplicates(["dedup_key"]).writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start(sink))
    q.awaitTermination()
    return q


def ingest_first(spark: SparkSession, landing: str, sink: str, checkpoint: str, max_files: int | None = None):
    """H2 with a defined survivor: the post of smallest ``index`` for each key, whatever the files'
    order.  State holds one key and one number per post; each batch writes the keys whose first
    post became smaller to its own folder (a replay writes the same again), ``first_posts`` reads them."""
    firsts = prepared(landing_stream(spark, landing, max_files)).groupBy("dedup_key").agg(F.min("index").alias("index"))

    def per_batch(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch={batch_id}")

    q = (firsts.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
         .foreachBatch(per_batch).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def first_posts(spark: SparkSession, sink: str) -> DataFrame:
    """(dedup_key, index) kept by ``ingest_first``."""
    return spark.read.parquet(sink).groupBy("dedup_key").agg(F.min("index").alias("index"))


ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]):
    """The settings within the block, the session's own after it."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def dedup_within(stream: DataFrame, keys: list[str], event_time: str, watermark: str, sink: str, checkpoint: str):
    """H2 with state that shrinks: one row per key within the watermark; rows later than the watermark go.

    A key leaves the state once the watermark has passed its row's time by ``watermark``, so state holds the keys of
    that span and not all of history.  It lives in RocksDB off the heap, and a batch uploads its changes, not whole
    snapshots.  Which of a key's rows stays is not defined, so ``keys`` should be all that readers use.
    """
    rows = stream.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark(keys)
    with session_conf(stream.sparkSession, ROCKSDB):
        q = (rows.writeStream.format("parquet").option("checkpointLocation", checkpoint)
             .outputMode("append").trigger(availableNow=True).start(sink))
        q.awaitTermination()
    return q


STORED = "dedup_key string, index long, batch long"


FILE_ORDER = {"mtime": ["file_time", "file_name"], "name": ["file_name"]}


def store_batch(df: DataFrame, batch_id: int, sink: str, index: str | None = None, order: str = "mtime",
                stored: Observation | None = None, files: bool = False) -> str:
    """H3: the batch's first post per key, without the keys stored by earlier batches, written over
    ``batch=<id>``; their keys go to the key index beside the sink.  Only earlier batches count as
    stored, so a replayed batch finds the same rows.

    First is by the order of the files (by time and name, or by name alone) and then by ``index``, where
    ``df`` names its files: the running index starts again at 0 with every run, so it alone orders nothing.
    ``stored`` observes new_posts, the rows written, on their way to the sink.  With ``files`` they name their files there.
    """
    spark, out = df.sparkSession, f"{sink.rstrip('/')}/batch={batch_id}"
    index = index or f"{sink.rstrip('/')}-keys"
    rows = df.withColumn("__at", F.struct(*[c for c in FILE_ORDER[order] if c in df.columns], "index"))
    first = keep_first(rows, "dedup_key", "__at").drop("__at")
    new = KI.unseen(first if files else first.drop("file_time", "file_name"), batch_id, index)
    if stored is not None:
        new = new.observe(stored, F.count(F.lit(1)).alias("new_posts"))
    new.write.mode("overwrite").parquet(out)
    KI.add(spark.read.schema(STORED).parquet(out), batch_id, index)
    return out


def rounds_by_file(raw: DataFrame, batch_id: int, sink: str, metrics: str, order: str) -> None:
    """H4: a progress row per landing file of the batch, in their order: the keys that it stored first.  Files without a
    line make no round.  Rounds count on from those of earlier batches, so a replayed batch writes the same again."""
    spark, at = raw.sparkSession, ["file_time", "file_name"]
    before = spark.read.schema("round long, new_posts long, batch long").parquet(metrics).filter(F.col("batch") < batch_id).count() if batch_id else 0
    new = spark.read.parquet(f"{sink.rstrip('/')}/batch={batch_id}").groupBy(*at).agg(F.count(F.lit(1)).alias("new_posts"))
    # a row a file of one trigger, so the window without a key stays small
    place = F.row_number().over(Window.orderBy(*FILE_ORDER[order], *at)) + F.lit(before - 1)
    (raw.select(*at).distinct().join(new, at, "left").select(place.cast("long").alias("round"), F.coalesce("new_posts", F.lit(0)).cast("long").alias("new_posts"))
     .write.mode("overwrite").parquet(f"{metrics.rstrip('/')}/batch={batch_id}"))


def ingest_anti_join(spark: SparkSession, landing: str, sink: str, checkpoint: str, max_files: int | None = None,
                     metrics: str | None = None, idle_limit: int | None = None, max_rounds: int | None = None, order: str = "mtime",
                     by_file: bool = False):
    """H3/H5: per micro-batch ``store_batch``; state lives in the sink and its key index, not in the stream.

    ``idle_limit`` ends the run after so many batches in a row without a new post, ``max_rounds``
    after so many batches; what has not been read stays for the next run.  With ``by_file`` the rounds of
    ``metrics`` are the landing files and not the batches: the rows of one file a batch, in far fewer batches.
    """
    idle, rounds, stopped = [0], [0], [False]

    def per_batch(df: DataFrame, batch_id: int) -> None:
        if (idle_limit and idle[0] >= idle_limit) or (max_rounds and rounds[0] >= max_rounds):
            stopped[0] = True
            raise RuntimeError("the run has reached its limit")  # this batch is not committed
        stored = Observation()  # H4: counted by the write itself, nothing is read again
        store_batch(prepared(whole(df)), batch_id, sink, order=order, stored=stored, files=by_file)
        n = stored.get["new_posts"]
        if metrics and by_file:
            rounds_by_file(df, batch_id, sink, metrics, order)
        elif metrics:  # H4: one progress row per round (new posts accepted in this micro-batch)
            df.sparkSession.createDataFrame([(batch_id, n)], "round long, new_posts long") \
                .write.mode("overwrite").parquet(f"{metrics.rstrip('/')}/batch={batch_id}")
        idle[0], rounds[0] = (0 if n else idle[0] + 1), rounds[0] + 1

    q = (landing_stream(spark, landing, max_files, files=True, bad=True).writeStream
         .option("checkpointLocation", checkpoint).foreachBatch(per_batch).trigger(availableNow=True).start())
    try:
        q.awaitTermination()
    except StreamingQueryException:
        if not stopped[0]:
            raise
    return q


def live_tag_counts(spark: SparkSession, stream: DataFrame, tags_col, sink: str, checkpoint: str):
    """H6: running tag counts kept live (complete mode): each trigger writes a folder of its own, and
    ``live_counts`` reads the newest, so that no reader meets a table half replaced."""
    counts = stream.select(F.explode(tags_col).alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("frequency"))

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch={batch_id}")

    q = (counts.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
         .foreachBatch(write).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def live_counts(spark: SparkSession, sink: str) -> DataFrame:
    """(tag, frequency) of the newest folder that ``live_tag_counts`` finished."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    base = hadoop.Path(sink)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    done = [int(d.getPath().getName()[6:]) for d in fs.listStatus(base)
            if d.getPath().getName().startswith("batch=") and fs.exists(hadoop.Path(d.getPath(), "_SUCCESS"))]
    return spark.read.schema("tag string, frequency long").parquet(f"{sink.rstrip('/')}/batch={max(done)}")
