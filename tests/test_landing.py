"""Order by listing, files named when left out, fields outside the schema, state that shrinks, observed counts."""

import gzip
import json
import os

from pyspark.sql import functions as F

from threadsift.plans import catalog_streaming as CS
from threadsift.session import checkpoint_path
from threadsift.sources import readers as RD
from threadsift.sources import sinks as SK
from threadsift.streaming import ingest as ING
from tests.conftest import SF_SMALL


def test_orders_of_several_files(spark, tmp_path):
    times = {"a.json": 3000, "b.json": 1000, "c.json": 2000, "d.json": 2000, "skipped.txt": 500}
    for n, t in times.items():
        (tmp_path / n).write_text("".join(json.dumps({"text": f"{n} {i}"}) + "\n" for i in range(3)))
        os.utime(tmp_path / n, (t, t))
    want = {"name": "abcd", "path": "abcd", "mtime": "bcda"}
    for by, names in want.items():
        listed = [r.file_name for r in RD.file_order(spark, str(tmp_path), "*.json", by).orderBy("place").collect()]
        assert listed == [f"{x}.json" for x in names]
        good, _ = RD.read_posts(spark, jsonl_path=str(tmp_path), glob="*.json", order=by)
        assert [r.text for r in good.orderBy("seq").collect()] == [f"{x}.json {i}" for x in names for i in range(3)]


def test_file_left_out_is_named(spark, tmp_path):
    body = json.dumps({"posts": [{"text": os.urandom(8).hex()} for _ in range(3000)]}).encode()
    (tmp_path / "whole.json.gz").write_bytes(gzip.compress(body))
    (tmp_path / "broken.json.gz").write_bytes(gzip.compress(body)[:-2000])
    (tmp_path / "bad.json").write_text("no json")
    (tmp_path / "empty.json").write_text("")
    for order in ("name", "mtime"):
        good, bad = RD.read_posts(spark, batched_path=str(tmp_path), order=order, skip_unreadable=True)
        assert good.count() == 3000
        assert {(r.file_name, r._corrupt_record) for r in bad.collect()} == {("broken.json.gz", None), ("bad.json", "no json")}


def test_rest_keeps_types_and_names(spark, tmp_path):
    lines = ['{"index": 1, "text": "a}", "score": 1.50, "tags": [1, "x", null], "in": {"a b": true}}', '{"index": 2, "text": "b"}',
             '{"index": 3, "likes": "4", "quote\\"d": "é \\\\ \\n", "none": null, "big": 123456789012345678901}', '{"only": 1}', "{}", "[1]", "no json"]
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(one)
    good, bad = RD.read_jsonl(spark, one, rest="rest")
    rows = {r["index"]: r["rest"] and json.loads(r["rest"]) for r in good.filter("index is not null").collect()}
    assert rows == {1: {"score": 1.5, "tags": [1, "x", None], "in": {"a b": True}}, 2: None,
                    3: {'quote"d': "é \\ \n", "none": None, "big": 123456789012345678901}}
    SK.append_jsonl(good.drop("seq"), two, rest="rest")
    again, bad2 = RD.read_jsonl(spark, two, rest="rest")
    assert sorted(map(str, again.drop("seq").collect())) == sorted(map(str, good.drop("seq").collect())) and bad2.count() == 0
    assert "no json" in [r._corrupt_record for r in bad.collect()]


def test_watermark_state_shrinks(spark):
    path = CS.land_rounds(spark, SF_SMALL)
    sink, ck = checkpoint_path(spark, "sink"), checkpoint_path(spark, "ckpt")
    keys = ["user_id", "event_type", "round"]
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    q = ING.dedup_within(CS.rounds_stream(spark, path), keys, "ts", "3 days", sink, ck)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    got = spark.read.parquet(sink).select(*keys)
    per_round = {r["round"]: r["count"] for r in got.groupBy("round").count().collect()}
    assert got.distinct().count() == got.count() == sum(per_round.values())
    assert got.filter(F.col("event_type").endswith("late")).count() == 0
    # late rows were read and dropped by the watermark, not missing from the files
    assert spark.read.parquet(path).filter(F.col("event_type").endswith("late")).count() > 0
    assert sum(o.numRowsDroppedByWatermark for p in q.recentProgress for o in p.stateOperators) > 0
    state = spark.read.format("statestore").load(ck).count()
    last = sorted(per_round)[-2:]
    assert 0 < state <= sum(per_round[r] for r in last) < got.count() / 2


def test_observed_counts_equal_the_stored_rows(spark):
    landing, sink, ck, metrics = (checkpoint_path(spark, x) for x in ("landing", "sink", "ckpt", "metrics"))
    for part in (range(0, 30), range(20, 50), range(0, 10)):
        rows = [(i, f"text number {i}", f"https://example.org/groups/1/posts/{i}/") for i in part]
        SK.append_jsonl(spark.createDataFrame(rows, "index long, text string, url string").coalesce(1), landing)
    ING.ingest_anti_join(spark, landing, sink, ck, max_files=1, metrics=metrics)
    seen = {r["round"]: r["new_posts"] for r in spark.read.parquet(metrics).collect()}
    stored = {r["batch"]: r["count"] for r in spark.read.parquet(sink).groupBy("batch").count().collect()}
    assert seen == {b: stored.get(b, 0) for b in seen} and sum(seen.values()) == 50 and min(seen.values()) == 0


def test_rounds_by_file_equal_one_file_a_batch(spark, tmpdir_path):
    """Two files a trigger, their rounds told apart; a file of malformed lines and a repeat are idle rounds."""
    d = os.path.join(tmpdir_path, "land")
    os.makedirs(d)
    for i, part in enumerate([range(0, 5), range(3, 9), range(0, 4), None, range(8, 10)]):
        lines = ["not json"] if part is None else [json.dumps({"index": j, "text": f"text number {j}", "url": f"https://example.org/groups/1/posts/{j}/"}) for j in part]
        name = os.path.join(d, f"{9 - i}.json")
        with open(name, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(name, (1_700_000_000 + 10 * i,) * 2)
    got, stored = {}, {}
    for n, by_file in ((1, False), (2, True), (9, True), (None, True)):
        sink, ck, metrics = (checkpoint_path(spark, x) for x in ("sink", "ckpt", "metrics"))
        ING.ingest_anti_join(spark, d, sink, ck, max_files=n, metrics=metrics, by_file=by_file)
        got[n] = [(r["round"], r["new_posts"]) for r in spark.read.parquet(metrics).orderBy("round").collect()]
        stored[n] = sorted(r["dedup_key"] for r in spark.read.parquet(sink).collect())
    assert got[1] == [(0, 5), (1, 4), (2, 0), (3, 0), (4, 1)]
    assert got[2] == got[9] == got[None] == got[1] and stored[2] == stored[9] == stored[None] == stored[1]


def test_triggers_take_many_files(spark, tmpdir_path, monkeypatch):
    """The live queries do not pay for a trigger per landing file."""
    asked = []
    plain = ING.landing_stream

    def seen(spark, landing, max_files=None, **k):
        asked.append(max_files)
        return plain(spark, landing, max_files, **k)
    monkeypatch.setattr(ING, "landing_stream", seen)
    rounds = CS.stream_progress(spark, SF_SMALL).collect()
    CS.stream_tag_counts(spark, SF_SMALL).collect()
    assert min(asked) >= 16
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    assert len(rounds) >= 2 and rounds[-1]["idle_run"] > 0 and sum(r["new_posts"] for r in rounds) <= docs
