"""Order semantics, readers, properties and plan checks."""

import json
import os

from pyspark.sql import functions as F

from threadsift import lexicons as L
from threadsift.operators import dedup as DD
from threadsift.operators import tagging as TG
from threadsift.plans import demographics as DM
from threadsift.sources import readers as RD
from tests.conftest import SF_SMALL


def posts_df(spark, rows):
    cols = "seq long, author string, text string, url string, likes string, comments string, timestamp string"
    return spark.createDataFrame(rows, cols)


def test_first_label_in_input_order(spark):
    p = posts_df(spark, [(1, "A", "hello", "", "", "", ""), (2, "A", "my idea", "", "", "", ""),
                         (3, "A", "growth investor", "", "", "", "")])
    prof = DM.profiles(DM.label_posts(p)).collect()
    assert prof[0].business_stage == "Idea Stage"


def test_blank_and_missing_authors(spark):
    p = posts_df(spark, [(1, "", "a", "", "", "", ""), (2, "", "b", "", "", "", ""), (3, None, "c", "", "", "", "")])
    prof = {r.author: r.post_count for r in DM.profiles(DM.label_posts(p)).collect()}
    assert prof == {"": 2, "Unknown": 1}


def test_ordered_tag_union(spark):
    p = posts_df(spark, [(1, "A", "whatsapp zoom", "", "", "", ""), (2, "A", "github fawry crm", "", "", "", "")])
    prof = DM.profiles(DM.label_posts(p)).first()
    assert prof.tool_preferences == ["CRM/WhatsApp", "Communication", "Payment Processing", "Development Tools"]


def test_text_dedup_keep_first(spark):
    df = spark.createDataFrame([(1, "a "), (2, "a"), (3, ""), (4, "b")], "seq long, text string")
    got = sorted((r.seq, r.text) for r in DD.distinct_text_first(df).collect())
    assert got == [(1, "a "), (4, "b")]


def test_dedup_idempotent_and_skewed_key(spark):
    # one key holds a third of all rows: keep-first must still return one row per key
    rows = [(i, "hot" if i % 3 == 0 else f"t{i}", "") for i in range(300)]
    df = spark.createDataFrame(rows, "seq long, text string, url string")
    once = DD.distinct_key_first(df)
    twice = DD.distinct_key_first(once)
    assert once.count() == 201 == twice.count()
    assert once.filter(F.col("text") == "hot").first().seq == 0


def test_running_index(spark):
    df = spark.createDataFrame([(s,) for s in [50, 3, 17, 99, 4]], "seq long")
    got = [(r["seq"], r["index"]) for r in DD.running_index(df).orderBy("seq").collect()]
    assert got == [(3, 0), (4, 1), (17, 2), (50, 3), (99, 4)]


def test_array_plan_equals_join_plan(spark):
    from threadsift.sources.adapter import posts_from_tables
    p = posts_from_tables(spark, SF_SMALL)
    lex = L.tool_lexicon()
    a = TG.tag(p, lex, out="t").select("seq", F.array_join("t", "|").alias("t"))
    b = TG.tag_join(p, lex, out="t").select("seq", F.array_join("t", "|").alias("t"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    seg = L.segment_lexicon()
    c = TG.classify(p, seg, out="s").select("seq", "s")
    d = TG.classify_join(p, seg, out="s").select("seq", "s")
    assert c.exceptAll(d).count() == 0


def test_non_matching_keyword_changes_nothing(spark):
    from threadsift.sources.adapter import posts_from_tables
    p = posts_from_tables(spark, SF_SMALL)
    lex = L.tool_lexicon()
    more = L.Lexicon(lex.name, tuple((c, k + ("zzqqxx-never",)) for c, k in lex.entries))
    a = TG.tag(p, lex, out="t").select("seq", "t")
    b = TG.tag(p, more, out="t").select("seq", "t")
    assert a.exceptAll(b).count() == 0


def test_jsonl_reader_quarantine(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "in.jsonl")
    with open(path, "w") as f:
        f.write(json.dumps({"text": "x", "likes": "1"}) + "\n\n{bad\n" + json.dumps({"text": "y"}) + "\n")
    good, bad = RD.read_jsonl(spark, path)
    assert sorted(r.text for r in good.collect()) == ["x", "y"]
    assert bad.count() == 1


def test_batched_reader(spark, tmpdir_path):
    with open(os.path.join(tmpdir_path, "a.json"), "w") as f:
        json.dump({"posts": [{"text": "x"}, {"text": "y", "likes": "3"}]}, f)
    with open(os.path.join(tmpdir_path, "b.json"), "w") as f:
        json.dump({"other": 1}, f)
    good, bad = RD.read_batched(spark, tmpdir_path)
    got = sorted((r.seq.pos, r.text, r.likes) for r in good.collect())
    assert got == [(0, "x", None), (1, "y", "3")]


def test_streaming_dedup_equals_batch(spark):
    import __spark_entry__ as E
    q = E.queries()
    s = q["stream_dedup"](spark, SF_SMALL)
    b = q["dedup_key_first"](spark, SF_SMALL).select("dedup_key", F.col("seq").alias("index"))
    assert s.exceptAll(b).count() == 0 and b.exceptAll(s).count() == 0


def test_no_python_udfs_in_plans(spark):
    import __spark_entry__ as E
    q = E.queries()
    for name in ["tag_ranking", "classify_dims", "author_profiles", "clean_text", "engagement_fallback", "dedup_key_first"]:
        plan = q[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_lexicon_join_has_no_cross_join(spark):
    from threadsift.sources.adapter import posts_from_tables
    p = posts_from_tables(spark, SF_SMALL).select("seq", "text")
    m = TG._matches(p, "seq", "text", L.tool_lexicon())
    # the one-row document count is the only loop join of the adapter
    assert m._jdf.queryExecution().executedPlan().toString().count("BroadcastNestedLoopJoin") <= 4
    assert "CartesianProduct" not in m._jdf.queryExecution().executedPlan().toString()


def test_adapter_counts_every_event_and_turn(spark):
    import duckdb
    from threadsift.functions.numbers import parse_count
    from threadsift.sources.adapter import posts_from_tables
    d = "/root/testdata/sf0.1"
    p = posts_from_tables(spark, d).filter("seq % 3 = 0 or (seq % 7 > 0 and seq % 11 > 0 and seq % 13 > 0)")
    got = p.agg(F.sum(parse_count(F.col("likes"), "strict")), F.sum(parse_count(F.col("comments"), "strict"))).first()
    ev = duckdb.sql(f"select count(*) filter (event_id % n % 3 = 0 or (event_id % n % 7 > 0 and event_id % n % 11 > 0 and event_id % n % 13 > 0)), count(*) "
                    f"from '{d}/events.parquet', (select max(doc_id) + 1 as n from '{d}/documents.parquet')").fetchall()[0]
    assert got[0] == ev[0]
    turns = posts_from_tables(spark, d).agg(F.sum(parse_count(F.col("comments"), "strict"))).first()[0]
    assert turns == duckdb.sql(f"select count(*) from '{d}/conversations.parquet'").fetchall()[0][0]


def test_keep_first_plans_are_hash_aggregations(spark):
    import __spark_entry__ as E
    q = E.queries()
    for name in ["dedup_text_first", "dedup_key_first", "running_index"]:
        plan = q[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan, name


def test_replayed_batch_keeps_its_rows(spark, tmpdir_path):
    from threadsift.streaming import ingest as ING
    sink = os.path.join(tmpdir_path, "sink")
    one = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "dedup_key string, index long")
    two = spark.createDataFrame([("b", 4), ("c", 5), ("c", 6)], "dedup_key string, index long")
    read = lambda: sorted((r.dedup_key, r["index"], r.batch) for r in spark.read.schema(ING.STORED).parquet(sink).collect())
    ING.store_batch(one, 0, sink)
    ING.store_batch(two, 1, sink)
    want = [("a", 1, 0), ("b", 2, 0), ("c", 5, 1)]
    assert read() == want
    for df, i in ((one, 0), (two, 1), (one, 0)):
        ING.store_batch(df, i, sink)
        assert read() == want


def test_bounded_runs_stop(spark, tmpdir_path):
    from threadsift.streaming import ingest as ING
    d = os.path.join(tmpdir_path, "land")
    os.makedirs(d)
    for i in range(6):  # a first text, a second one, and four repeats
        name = os.path.join(d, f"{i}.json")
        with open(name, "w") as f:
            f.write(json.dumps({"index": i, "text": "a long enough text" if i else "the first text", "url": ""}) + "\n")
        os.utime(name, (1_700_000_000 + 10 * i,) * 2)

    def rounds(name, **k):
        at = {x: os.path.join(tmpdir_path, f"{name}-{x}") for x in ("sink", "ck", "m")}
        ING.ingest_anti_join(spark, d, at["sink"], at["ck"], max_files=1, metrics=at["m"], **k)
        return [r.new_posts for r in spark.read.parquet(at["m"]).orderBy("round").collect()]
    assert rounds("idle", idle_limit=2) == [1, 1, 0, 0]
    assert rounds("few", max_rounds=1) == [1]
    assert rounds("few") == [1, 1, 0, 0, 0, 0]  # what was left comes with the next run


def test_checkpoint_folder_is_needed_on_clusters(monkeypatch):
    import pytest
    from threadsift import session as SS

    class Fake:
        class conf:  # noqa: N801
            get = staticmethod(lambda k, d=None: None)

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)
    with pytest.raises(RuntimeError):
        SS.ensure_checkpoint_dir(Fake)


def test_pseudonymized_profiles_keep_counts(spark):
    p = posts_df(spark, [(1, "A", "x", "", "", "", ""), (2, "A", "y", "", "", "", ""), (3, "B", "z", "", "", "", "")])
    prof = DM.profiles(DM.label_posts(DD.pseudonymize(p))).collect()
    assert sorted(r.post_count for r in prof) == [1, 2] and all(len(r.author) == 64 for r in prof)


def test_idle_runs_and_stop_round(spark):
    from threadsift.operators.reports import rounds_from_counts, stop_round
    new = [3, 0, 0, 1] + [0] * 10
    df = spark.createDataFrame([(i + 1, n) for i, n in enumerate(new)], "round long, new_posts long")
    r = rounds_from_counts(df)
    runs = [x.idle_run for x in r.orderBy("round").collect()]
    assert runs == [0, 1, 2, 0] + list(range(1, 11))
    s = stop_round(r).first()
    assert (s.stop_round, s.longest_idle_run) == (14, 10)


def test_malformed_wrapper_quarantined(spark, tmpdir_path):
    with open(os.path.join(tmpdir_path, "a.json"), "w") as f:
        json.dump({"posts": [{"text": "x"}]}, f)
    with open(os.path.join(tmpdir_path, "b.json"), "w") as f:
        f.write('{"posts": [{"text": ')
    good, bad = RD.read_batched(spark, tmpdir_path)
    assert [r.text for r in good.collect()] == ["x"]
    assert bad.cache().count() == 1
