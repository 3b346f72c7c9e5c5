"""File I/O round trips and streaming ingest.

Files are written under the session's shared ``spark.checkpoint.dir``; each
call uses fresh sub-folders, so reruns never read stale output.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from threadsift import lexicons as L
from threadsift.functions import lexicon as LX
from threadsift.operators import dedup as DD
from threadsift.operators.reports import rounds_from_counts
from threadsift.plans import catalog_reports  # noqa: F401 -- its SQL gives the row counts of the report sections
from threadsift.plans import catalog_tags as CT
from threadsift.plans import pain_points as PP
from threadsift.plans import sqlgen as G
from threadsift.plans import statistics as ST
from threadsift.plans.catalog_profiles import profiles
from threadsift.plans.registry import ORACLES, register
from threadsift.session import checkpoint_path
from threadsift.sources import readers as RD
from threadsift.sources import sinks as SK
from threadsift.sources.adapter import posts_from_tables, table
from threadsift.streaming import ingest as ING

POST_COLS = ["index", "text", "author", "timestamp", "url", "likes", "comments", "shares", "images", "is_video", "is_share"]
KEY_SQL = G.dedup_key()
POSTS_PER_FILE = 5000  # landing files hold at most so many posts
POSTS_PER_WRAPPER = 30
FILES_PER_TRIGGER = 32  # a trigger costs about the same for one file as for many


def land_wrappers(spark, sf):
    """Wrappers ``{"posts": [...]}`` of POSTS_PER_WRAPPER posts, many to a file, one on a line (A1)."""
    path = checkpoint_path(spark, "batched")
    p = posts_from_tables(spark, sf).select(*POST_COLS).withColumn("no", F.floor(F.col("index") / POSTS_PER_WRAPPER))
    w = p.groupBy("no").agg(F.array_sort(F.collect_list(F.struct(F.col("index").alias("_o"), *POST_COLS))).alias("posts"))
    w.select(F.transform("posts", lambda x: x.dropFields("_o")).alias("posts")).write.json(path)
    return path


def land_posts(spark, sf):
    """Write the derived posts as JSON lines into a fresh landing folder."""
    path = checkpoint_path(spark, "landing")
    SK.append_jsonl(posts_from_tables(spark, sf).select(*POST_COLS), path, POSTS_PER_FILE)
    return path


@register("json_roundtrip", "WITH " + G.posts_cte() + '\nSELECT "index", md5(text) AS text_md5 FROM posts')
def json_roundtrip(spark, sf):
    """A6 -> A2: append as JSON lines, read back with the explicit schema."""
    good, _ = RD.read_jsonl(spark, land_posts(spark, sf))
    return good.select("index", F.md5("text").alias("text_md5"))


@register("batched_roundtrip", "WITH " + G.posts_cte() + '\nSELECT "index", md5(text) AS text_md5 FROM posts')
def batched_roundtrip(spark, sf):
    """A1/A5: 30 posts per wrapper file ``{"posts": [...]}``, read back with posexplode (position kept)."""
    good, _ = RD.read_batched(spark, land_wrappers(spark, sf), lines=True)
    return good.select("index", F.md5("text").alias("text_md5"))


POSTS_IN_ORDERED = 100  # files of so many posts
FIRST_TIME = 1_700_000_000_000


@register("posts_in_order", "WITH " + G.posts_cte() + f"""
SELECT 'path' AS by, "index", CAST(row_number() OVER (ORDER BY "index") - 1 AS BIGINT) AS place FROM posts
UNION ALL SELECT 'mtime', "index", CAST(row_number() OVER (ORDER BY "index" // {POSTS_IN_ORDERED} DESC, "index") - 1 AS BIGINT) FROM posts""")
def posts_in_order(spark, sf):
    """A4/A5: posts of several files picked by a glob, in the order of their paths and of their times.

    Each file holds a stretch of the index; paths rise with it, times are set to fall, so the two orders differ."""
    path = checkpoint_path(spark, "ordered")
    part = F.lpad(F.floor(F.col("index") / POSTS_IN_ORDERED).cast("string"), 12, "0")
    p = posts_from_tables(spark, sf).select(*POST_COLS, part.alias("part")).repartition("part").sortWithinPartitions("part", "index")
    p.write.partitionBy("part").json(path)
    spark.createDataFrame([("not json",)], "value string").write.mode("append").text(path + "/part=other")
    files = [r.file_path for r in RD.file_order(spark, path, "*.json", "path").orderBy("place").collect()]
    SK.set_file_times(spark, files[::-1], FIRST_TIME)
    out = []
    for by in ("path", "mtime"):
        good, _ = RD.read_posts(spark, jsonl_path=path, glob="*.json", order=by)
        out.append(DD.running_index(good.select("seq", "index"), "seq", "place").select(F.lit(by).alias("by"), "index", "place"))
    return out[0].unionByName(out[1])


@register("extra_fields", "WITH " + G.posts_cte() + """
SELECT "index", md5(text) AS text_md5, CAST("index" AS BIGINT) AS n, source || ' "' || lang || '"' AS place, "index" % 3 = 0 AS bare
FROM posts JOIN (SELECT doc_id AS "index", source, lang FROM documents) USING ("index")""")
def extra_fields(spark, sf):
    """Fields outside the schema survive reading, writing and reading again, with their types; every third post has none."""
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("index"), F.concat("source", F.lit(' "'), "lang", F.lit('"')).alias("place"))
    posts = posts_from_tables(spark, sf).select(*POST_COLS).join(d, "index")
    extra = F.when(F.col("index") % 3 != 0, F.to_json(F.struct(F.struct(F.col("index").alias("n"), "place").alias("found at"), F.col("index").alias("rank"))))
    one, two = checkpoint_path(spark, "extra"), checkpoint_path(spark, "extra")
    SK.append_jsonl(posts.withColumn("rest", extra).drop("place"), one, rest="rest")
    good, _ = RD.read_jsonl(spark, one, rest="rest")
    SK.append_jsonl(good.drop("seq"), two, rest="rest")
    back, _ = RD.read_jsonl(spark, two, rest="rest")
    v = F.from_json("rest", "`found at` struct<n long, place string>, rank long")
    # a post without extra fields takes its values from the table, so that a field gained or lost shows
    return (back.join(d.withColumnRenamed("place", "own"), "index").withColumn("v", v)
            .select("index", F.md5("text").alias("text_md5"), F.when(F.col("rest").isNull(), F.col("index")).otherwise(F.col("v.rank") + F.col("v.found at.n") - F.col("index")).alias("n"),
                    F.when(F.col("rest").isNull(), F.col("own")).otherwise(F.col("v.found at.place")).alias("place"), F.col("rest").isNull().alias("bare")))


@register("quarantine_counts", f"""
SELECT 'good' AS kind, count(*) AS n FROM documents
UNION ALL SELECT 'bad', CAST(sum(len(list_filter(string_split(replace(text, chr(13), ''), chr(10)), lambda x: trim(x) <> ''))) AS BIGINT) FROM benchmark""")
def quarantine_counts(spark, sf):
    """A2/A3: good JSON lines load, non-JSON lines (benchmark text written raw) go to quarantine."""
    path = land_posts(spark, sf)
    raw = table(spark, sf, "benchmark").select(F.regexp_replace("text", "\r", "").alias("value"))
    raw.write.mode("append").text(path)
    good, bad = RD.read_jsonl(spark, path)
    g = good.agg(F.count(F.lit(1)).alias("n")).select(F.lit("good").alias("kind"), "n")
    b = bad.agg(F.count(F.lit(1)).alias("n")).select(F.lit("bad").alias("kind"), "n")
    return g.unionByName(b)


FIRST_SQL = "WITH " + G.posts_cte() + f"""
SELECT {KEY_SQL} AS dedup_key, min("index") AS "index" FROM posts WHERE NOT (length({G.strip('text')}) < 5 AND url = '') GROUP BY ALL"""


@register("stream_dedup", FIRST_SQL)
def stream_dedup(spark, sf):
    """H1/H2/H5: streaming ingest; the first post of every key survives."""
    landing = land_posts(spark, sf)
    sink, ck = checkpoint_path(spark, "sink"), checkpoint_path(spark, "ckpt")
    ING.ingest_first(spark, landing, sink, ck, max_files=4)
    return ING.first_posts(spark, sink)


@register("stream_keys", "WITH " + G.posts_cte() + f"\nSELECT DISTINCT {KEY_SQL} AS dedup_key FROM posts WHERE NOT (length({G.strip('text')}) < 5 AND url = '')")
def stream_keys(spark, sf):
    """H2: the stateful ``dropDuplicates`` plan; which post of a key survives is not defined there."""
    landing = land_posts(spark, sf)
    sink, ck = checkpoint_path(spark, "sink"), checkpoint_path(spark, "ckpt")
    ING.ingest_dedup(spark, landing, sink, ck, max_files=4)
    return spark.read.parquet(sink).select("dedup_key")


@register("stream_resume", "WITH " + G.posts_cte() + f"""
, r AS (SELECT {KEY_SQL} AS dedup_key, seq % 2 AS run, seq // 2 AS "index" FROM posts WHERE NOT (length({G.strip('text')}) < 5 AND url = ''))
SELECT dedup_key, run, "index" FROM r QUALIFY row_number() OVER (PARTITION BY dedup_key ORDER BY run, "index") = 1""")
def stream_resume(spark, sf):
    """H3: three runs over a growing landing folder, each numbering its posts from 0: even posts, odd posts,
    and the even ones once more; a key is stored once, by the run that first had it."""
    landing = checkpoint_path(spark, "landing")
    sink, ck = checkpoint_path(spark, "sink"), checkpoint_path(spark, "ckpt")
    for run in (0, 1, 0):
        posts = posts_from_tables(spark, sf).filter(F.col("seq") % 2 == run).withColumn("index", F.expr("seq div 2"))
        # files that hold a stretch of the run each; their names rise with it
        SK.append_jsonl(posts.withColumn("timestamp", F.lit(str(run))).select(*POST_COLS).repartitionByRange("index").sortWithinPartitions("index"), landing)
        ING.ingest_anti_join(spark, landing, sink, ck, order="name")
    return spark.read.parquet(sink).select("dedup_key", F.col("timestamp").cast("long").alias("run"), "index")


ROUND_DAYS = 3


def land_rounds(spark, sf):
    """Events in one file a round of ROUND_DAYS days.  A round also holds the rows of the round before once more, and rows
    of four rounds before under keys of their own, which come too late: a batch drops rows by the watermark of the
    batch before it, which has passed the start of the third round before.  File times rise with the rounds."""
    path = checkpoint_path(spark, "rounds")
    e = table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    first = e.agg(F.to_date(F.min("ts")).alias("d0"))
    e = e.crossJoin(F.broadcast(first)).withColumn("round", F.expr(f"datediff(to_date(ts), d0) div {ROUND_DAYS}").cast("long")).drop("d0")
    # a row per round, so the window without a key stays small
    ranks = e.select("round").distinct().withColumn("landed", F.row_number().over(Window.orderBy("round")).cast("long"))
    e = e.join(F.broadcast(ranks), "round")
    again = e.withColumn("landed", F.col("landed") + 1)
    late = e.withColumns({"landed": F.col("landed") + 4, "event_type": F.concat("event_type", F.lit(":late"))})
    rows = e.unionByName(again).unionByName(late).join(F.broadcast(ranks.select("landed")), "landed", "left_semi")
    rows.withColumn("part", F.lpad(F.col("landed").cast("string"), 8, "0")).drop("landed").repartition("part").write.partitionBy("part").parquet(path)
    files = [r.file_path for r in RD.file_order(spark, path, "*.parquet", "path").orderBy("place").collect()]
    SK.set_file_times(spark, files, FIRST_TIME)
    return path


def rounds_stream(spark, path):
    return (spark.readStream.schema("round long, ts timestamp, user_id long, event_type string").option("maxFilesPerTrigger", 1)
            .parquet(path).select("round", "ts", "user_id", "event_type"))


@register("stream_watermark", f"""
SELECT DISTINCT user_id, event_type, CAST(date_diff('day', (SELECT min(CAST(ts AS DATE)) FROM events), CAST(ts AS DATE)) // {ROUND_DAYS} AS BIGINT) AS round FROM events""")
def stream_watermark(spark, sf):
    """H2 with an event time: keys once each, repeats within the watermark and rows beyond it dropped, state evicted."""
    sink, ck = checkpoint_path(spark, "sink"), checkpoint_path(spark, "ckpt")
    ING.dedup_within(rounds_stream(spark, land_rounds(spark, sf)), ["user_id", "event_type", "round"], "ts", f"{ROUND_DAYS} days", sink, ck)
    return spark.read.parquet(sink).select("user_id", "event_type", "round")


@register("stream_quarantine", f"""
SELECT line AS bad, count(*) AS n FROM (SELECT unnest(string_split(replace(text, chr(13), ''), chr(10))) AS line FROM benchmark)
WHERE {G.strip('line')} <> '' GROUP BY line""")
def stream_quarantine(spark, sf):
    """A3/H1: malformed lines (benchmark text written raw) among landed posts, kept raw by the stream."""
    landing = land_posts(spark, sf)
    table(spark, sf, "benchmark").select(F.regexp_replace("text", "\r", "").alias("value")).write.mode("append").text(landing)
    path, ck = checkpoint_path(spark, "quarantine"), checkpoint_path(spark, "ckpt")
    ING.quarantine(spark, landing, path, ck)
    return spark.read.parquet(path).groupBy(F.col("line").alias("bad")).agg(F.count(F.lit(1)).alias("n"))


PROBE = L.probe_lexicon(regex=True)


@register("stream_tag_counts", "WITH " + G.posts_cte() + f"""
SELECT tag, count(*) AS frequency FROM (SELECT unnest({G.tags('text', PROBE)}) AS tag FROM posts WHERE text <> '') GROUP BY tag""")
def stream_tag_counts(spark, sf):
    """H6: live tag counts over the ingest stream (complete mode)."""
    landing = land_posts(spark, sf)
    s = ING.landing_stream(spark, landing, FILES_PER_TRIGGER).filter(F.coalesce("text", F.lit("")) != "").withColumn("_low", F.lower("text"))
    sink, ck = checkpoint_path(spark, "tags"), checkpoint_path(spark, "ckpt")
    ING.live_tag_counts(spark, s, LX.tags("text", PROBE, "_low"), sink, ck)
    return ING.live_counts(spark, sink)


ROUNDS_SQL = """WITH firsts AS (SELECT user_id, event_type, min(ts) AS t FROM events GROUP BY ALL),
hours AS (SELECT DISTINCT date_trunc('hour', ts) AS h FROM events),
r AS (SELECT h, CAST(row_number() OVER (ORDER BY h) AS BIGINT) AS round FROM hours),
n AS (SELECT date_trunc('hour', t) AS h, count(*) AS new_posts FROM firsts GROUP BY ALL),
j AS (SELECT r.round, CAST(coalesce(n.new_posts, 0) AS BIGINT) AS new_posts FROM r LEFT JOIN n USING (h)),
k AS (SELECT *, CAST(sum(new_posts) OVER (ORDER BY round) AS BIGINT) AS total_posts,
      sum(CASE WHEN new_posts > 0 THEN 1 ELSE 0 END) OVER (ORDER BY round) AS island FROM j)
SELECT round, new_posts, total_posts,
  CAST(CASE WHEN new_posts > 0 THEN 0 ELSE row_number() OVER (PARTITION BY island ORDER BY round) - CASE WHEN island > 0 THEN 1 ELSE 0 END END AS BIGINT) AS idle_run
FROM k"""


def _rounds(spark, sf):
    """F25/G15 over ingest rounds: one round per event hour; new = first-seen (user, type) keys."""
    ev = table(spark, sf, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    firsts = ev.groupBy("user_id", "event_type").agg(F.min("ts").alias("t"))
    hours = ev.select(F.date_trunc("hour", "ts").alias("h")).distinct()
    n = firsts.groupBy(F.date_trunc("hour", "t").alias("h")).agg(F.count(F.lit(1)).alias("new_posts"))
    # rounds are bounded by the time span (hours), not by the data volume
    r = hours.join(n, "h", "left").select("h", F.coalesce("new_posts", F.lit(0)).cast("long").alias("new_posts"))
    r = r.withColumn("round", F.row_number().over(Window.orderBy("h")).cast("long"))
    return rounds_from_counts(r)


@register("ingest_rounds", ROUNDS_SQL)
def ingest_rounds(spark, sf):
    """Per-round new and running total, with the idle-run length."""
    return _rounds(spark, sf).select("round", "new_posts", "total_posts", "idle_run")


@register("idle_runs", "WITH x AS (" + ROUNDS_SQL + """)
SELECT min(round) FILTER (WHERE idle_run = 10) AS stop_round, max(idle_run) AS longest_idle_run,
  CAST(sum(CASE WHEN new_posts = 0 THEN 1 ELSE 0 END) AS BIGINT) AS idle_rounds FROM x""")
def idle_runs(spark, sf):
    """First round where the idle run reaches 10 (the stop rule), longest run, idle rounds."""
    r = _rounds(spark, sf)
    return r.agg(F.min(F.when(F.col("idle_run") == 10, F.col("round"))).alias("stop_round"),
                 F.max("idle_run").alias("longest_idle_run"),
                 F.sum(F.when(F.col("new_posts") == 0, 1).otherwise(0)).cast("long").alias("idle_rounds"))


@register("legacy_union", "WITH " + G.posts_cte() + '''
SELECT "index", md5(text) AS text_md5 FROM posts UNION ALL SELECT "index", md5(text) FROM posts''')
def legacy_union(spark, sf):
    """JSON-lines output and legacy batched files read together (bag union by name)."""
    jl = land_posts(spark, sf)
    good, _ = RD.read_posts(spark, jsonl_path=jl, batched_path=land_wrappers(spark, sf), lines=True)
    return good.select("index", F.md5("text").alias("text_md5"))


@register("stream_progress")
def stream_progress(spark, sf):
    """H4/F25/G15 on a live stream: per round new posts, running total and idle run.

    A round is a landing file.  A trigger takes FILES_PER_TRIGGER of them; foreachBatch writes a row
    for each to a metrics table, the rows that one file per trigger would give, from which rounds are derived.
    """
    landing = land_posts(spark, sf)
    SK.append_jsonl(posts_from_tables(spark, sf).select(*POST_COLS), landing, POSTS_PER_FILE)  # repeats: idle rounds
    sink, ck, metrics = checkpoint_path(spark, "sink"), checkpoint_path(spark, "ckpt"), checkpoint_path(spark, "metrics")
    ING.ingest_anti_join(spark, landing, sink, ck, max_files=FILES_PER_TRIGGER, metrics=metrics, by_file=True)
    m = rounds_from_counts(spark.read.parquet(metrics).select("round", "new_posts"))
    return m.select("round", "new_posts", "total_posts", "idle_run")


@register("stream_totals", "WITH " + G.posts_cte() + f"""
SELECT count(DISTINCT {KEY_SQL}) AS total_posts, true AS had_idle_rounds FROM posts WHERE NOT (length({G.strip('text')}) < 5 AND url = '')""")
def stream_totals(spark, sf):
    """H4: the totals of ``stream_progress``, which do not depend on how the files fall into rounds."""
    return stream_progress(spark, sf).agg(F.sum("new_posts").cast("long").alias("total_posts"), (F.max("idle_run") > 0).alias("had_idle_rounds"))


def _result(spark, sf):
    a = PP.analyze(posts_from_tables(spark, sf), PROBE)
    stats = (PP.tag_ranking(PP.tag_stats(a, PROBE), len(PROBE.categories)).join(PP.tag_by_segment(PP.tag_stats(a, PROBE)), "tag")
             .select("rank", "tag", "frequency", "average_severity", "average_engagement", F.struct(*L.SEGMENTS).alias("by_segment")))
    return SK.result_document(stats, PP.totals(a), PP.sample_posts(a))


@register("result_document")
def result_document(spark, sf):
    """The nested pain-point result document (one row), also written as JSON."""
    doc = _result(spark, sf)
    SK.write_document(doc, checkpoint_path(spark, "result_doc"))
    return doc


@register("result_document_tags", CT.ANALYZED_SQL + f"""
SELECT row_number() OVER (ORDER BY frequency DESC, first_seq, cat_rank) AS place, tag, frequency, average_severity, average_engagement, {', '.join(L.SEGMENTS)},
  (SELECT count(*) FROM an) AS total_posts_analyzed, (SELECT least(count(*), {L.SAMPLE_POSTS}) FROM an) AS samples FROM st""")
def result_document_tags(spark, sf):
    """The written document read back, a row per tag in its order."""
    path = checkpoint_path(spark, "result_doc")
    doc = _result(spark, sf)
    SK.write_document(doc, path)
    back = spark.read.schema(doc.schema).json(path)
    return back.select(F.posexplode("pain_points").alias("pos", "p"), "total_posts_analyzed", F.size("sample_posts").cast("long").alias("samples")).select(
        (F.col("pos") + 1).cast("long").alias("place"), "p.tag", "p.frequency", "p.average_severity", "p.average_engagement",
        *[F.col(f"p.by_segment.{x}").alias(x) for x in L.SEGMENTS], "total_posts_analyzed", "samples")


@register("run_summary", "WITH " + G.posts_cte() + f"""
SELECT 'documents' AS group_url, count(DISTINCT {KEY_SQL}) AS total_unique_posts FROM posts WHERE NOT (length({G.strip('text')}) < 5 AND url = '')""")
def run_summary(spark, sf):
    """One summary row for an ingest run; time and data path, which differ by run, stay in the file."""
    landing = land_posts(spark, sf)
    sink, ck, out = checkpoint_path(spark, "sink"), checkpoint_path(spark, "ckpt"), checkpoint_path(spark, "summary")
    ING.ingest_dedup(spark, landing, sink, ck)
    SK.run_summary(spark.read.parquet(sink), "documents", sink).write.mode("overwrite").json(out)
    return spark.read.schema("timestamp timestamp, group_url string, total_unique_posts long, data_file string").json(out).select("group_url", "total_unique_posts")


def _section_sql() -> str:
    """The rows of every section from one materialised table of profiles."""
    prefix = "WITH " + G.profiles_cte()
    lists = {"pain_point_distribution": ("tag_tool_distribution", " WHERE kind = 'pain_points'"),
             "tool_distribution": ("tag_tool_distribution", " WHERE kind = 'tool_preferences'")}
    parts = []
    for n in ST.SECTIONS:
        q, where = lists.get(n, (n, ""))
        rest = ORACLES[q].removeprefix(prefix).strip()
        parts.append(f"SELECT '{n}' AS section, (SELECT count(*) FROM ({'WITH ' + rest[1:] if rest.startswith(',') else rest}) x{where}) AS rows")
    return prefix.replace("prof AS (", "prof AS MATERIALIZED (") + "\n" + "\nUNION ALL ".join(parts)


@register("report_sink", _section_sql())
def report_sink(spark, sf):
    """All report sections written as named outputs; returns (section, rows)."""
    paths = SK.write_report(ST.report_sections(profiles(spark, sf)), checkpoint_path(spark, "report"))
    parts = [spark.read.parquet(p).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("section"), "rows")
             for n, p in paths.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)
