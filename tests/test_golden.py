"""Golden micro-rows (FIXTURES.md section 2), computed with the Spark column builders."""

import pytest
from pyspark.sql import functions as F

from threadsift import lexicons as L
from threadsift.functions import html as H
from threadsift.functions import identity as ID
from threadsift.functions import lexicon as LX
from threadsift.functions import scoring as SC
from threadsift.functions import text as TX
from threadsift.functions.numbers import parse_count
from threadsift.operators import tagging as TG


def one_col(spark, values, expr_fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr_fn(F.col("v"))).collect()]


def test_count_parse_modes(spark):
    vals = ["", "12", "١٢", " 7 ", "1,234", "1.2K", "3M", "abc"]
    assert one_col(spark, vals, lambda c: parse_count(c, "strict")) == [0, 12, 12, 7, 0, 0, 0, 0]
    assert one_col(spark, vals, lambda c: parse_count(c, "digits")) == [0, 12, 12, 7, 1234, 12, 3, 0]
    assert one_col(spark, vals, lambda c: parse_count(c, "scaled")) == [0, 12, 12, 7, 1234, 1200, 3000000, 0]


def test_severity(spark):
    vals = ["hello", "please", "urgent help", "emergency", "critical problem issue", "disaster crisis severe major"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string").withColumn("low", F.lower("v"))
    got = [r[0] for r in df.orderBy("i").select(LX.severity("low", L.URGENCY_KEYWORDS, L.SEVERITY_KEYWORDS)).collect()]
    assert got == [3, 4, 6, 6, 8, 10]


def test_segment(spark):
    vals = ["I do freelance work", "startup company founder", "company venture", "MVP", "hello"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, text string")
    got = [r.segment for r in TG.classify(df, L.segment_lexicon(), out="segment").orderBy("i").collect()]
    assert got == ["freelancer", "startup", "startup", "unknown", "unknown"]


def test_classification_ties_and_confidence(spark):
    stage = L.demographic_lexicons()["business_stage"]
    market = L.demographic_lexicons()["target_market"]
    df = spark.createDataFrame([(0, "idea team"), (1, "global"), (2, "")], "i int, text string")
    r = TG.classify(df, stage, out="stage", score_col="s")
    r = TG.classify(r, market, out="market", score_col="ms").orderBy("i").collect()
    assert (r[0].stage, r[0].s) == ("Idea Stage", 1)
    assert LX_conf(r[0].s) == 0.2
    assert (r[1].market, r[1].ms) == ("International/Global", 2)  # duplicate keyword counts twice
    assert (r[2].stage, r[2].s) == (None, 0)


def LX_conf(score):
    return min(score / 5.0, 1.0)


def test_budget(spark):
    vals = ["Budget 400 EGP", "500 EGP", "2000 جنيه", "١٠٠٠٠ جنيه", "10,000 EGP", "$500", "1 million", "budget very low"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, text string").withColumn("low", F.lower("text"))
    df = TG.classify(df, L.budget_lexicon(), out="kw", low="low")
    got = [r[0] for r in df.orderBy("i").select(F.coalesce(LX.budget_amount_range(F.col("text")), F.col("kw"))).collect()]
    assert got == ["$0-$500", "$500-$2K", "$2K-$10K", "$10K+", "$0-$500", None, "$10K+", None]


@pytest.mark.parametrize("budget,tech,stage,tools,score", [
    (None, None, None, 0, 0), (None, None, "Idea Stage", 0, 8), (None, None, "Growth Stage", 0, 22),
    (None, "Technical", None, 0, 20), ("$0-$500", "Non-technical", None, 0, 18),
    ("$500-$2K", None, "MVP/Validation Stage", 0, 30), (None, None, "Idea Stage", 1, 11),
    ("$10K+", "Developer", "Established/SME", 3, 100)])
def test_readiness(spark, budget, tech, stage, tools, score):
    df = spark.createDataFrame([(budget, tech, stage, tools)], "b string, t string, s string, n int")
    assert df.select(SC.readiness_score(F.col("b"), F.col("t"), F.col("s"), F.col("n"))).first()[0] == score


def test_team_size(spark):
    rows = [("Freelancer/Solo", 1), ("Startup (Seed/Series A)", 5), ("Startup (Seed/Series A)", 6),
            ("SME (Established)", 1), ("Agency/Service Business", 1), (None, 1)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "i int, t string, n int")
    got = [r[0] for r in df.orderBy("i").select(SC.team_size(F.col("t"), F.col("n"))).collect()]
    assert got == ["1 person", "2-5 people", "5-10 people", "10-50 people", "5-20 people", "Unknown"]


def test_identity(spark):
    df = spark.createDataFrame([(" https://x/1 ", "t"), ("", "abc")], "url string, text string")
    got = [r[0] for r in df.select(ID.dedup_key(F.col("url"), F.col("text"))).collect()]
    assert got == ["https://x/1", "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"]
    ids = one_col(spark, ["/groups/9/posts/123/?x", "permalink.php?story_fbid=77&id=1", "https://x/"], ID.post_id_from_url)
    assert ids == ["123", "77", None]


def test_engagement_lines(spark):
    vals = ["12 comments\n3 shares", "1.2K comments 4 shares", "١٢ تعليقًا", "View 3 more comments", "3 more comments"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    c, s = H.engagement_from_lines(F.col("v"))
    got = [(r[0], r[1]) for r in df.orderBy("i").select(c, s).collect()]
    assert got == [("12", "3"), ("1.2K", "4"), ("12", ""), ("", ""), ("", "")]


def test_cleaning(spark):
    a = "Ahmed\n·  3h \nSee more about unlikely\n12\n٣٤\nعرض المزيد من التعليقات\nكلام · ٣ ساعة\nLike\nReply\nShare\n45"
    b = "· 2 days\nBody text · 5d\nShow more comments\nعرض  5\n·\nTop contributor Sam\nx"
    assert one_col(spark, [a, b], TX.clean_text) == ["Ahmed\nabout unly\nكلام اعة", "ays\nBody text s\nSam\nx"]


def test_post_or_comment(spark):
    big = "x" * 2990
    cases = [
        ('<a href="https://f/groups/1/posts/1/">t</a>' + big, False),
        ('<a href="https://f/groups/1/posts/1/?comment_id=2">t</a>' + big, True),
        ('<a href="https://f/groups/1/posts/1/?comment_id=2">t</a><a href="https://f/groups/1/posts/1/">u</a>' + big, False),
        ("y" * 2999, True),
        ("<p>Reply</p>" + "y" * 3990, True),
        ("<p>Comment</p>" + "y" * 5990, False),
        ("y" * 4000, False),
    ]
    got = one_col(spark, [c for c, _ in cases], H.is_comment)
    assert got == [e for _, e in cases]


def test_length_buckets(spark):
    got = one_col(spark, ["a" * 99, "a" * 100, "a" * 299, "a" * 300], TX.length_bucket)
    assert got == ["short", "medium", "medium", "long"]


def test_heat_bucket(spark):
    from threadsift.operators.reports import heat_bucket
    df = spark.createDataFrame([(c,) for c in [10, 7, 4, 1, 0]], "c int")
    got = [r[0] for r in df.select(heat_bucket(F.col("c"), F.lit(10))).collect()]
    assert got == ["high", "mid", "low", "low", "none"]


def test_budget_grouped_digits_mode(spark):
    vals = ["10,000 EGP", "1,500 جنيه", "400 EGP", "no amount"]
    got = one_col(spark, vals, lambda c: LX.budget_amount_range(c, grouped_digits=True))
    assert got == ["$10K+", "$500-$2K", "$0-$500", None]
    assert one_col(spark, ["10,000 EGP"], LX.budget_amount_range) == ["$0-$500"]  # reference mode


def test_join_plan_equals_array_plan_on_large_lexicons(spark):
    big = L.Lexicon("big", tuple((f"c{i}", tuple(f"kw{i}-{j}" for j in range(30))) for i in range(80))
                    + (("hit", ("the ",)), ("short", ("c", "og"))))
    df = spark.createDataFrame([(1, "the cat"), (2, "dog"), (3, None), (4, "x kw7-2 kw7-29 y"), (5, "")], "seq long, text string")
    got = {r.seq: r.tags for r in TG.tag_join(df, big).collect()}
    assert got == {1: ["hit", "short"], 2: ["short"], 3: [], 4: ["c7"], 5: []}
    assert got == {r.seq: r.tags for r in TG.tag(df.fillna(""), big).collect()}


def test_dedup_key_reads_whole_texts(spark):
    head = "x" * 500
    df = spark.createDataFrame([("", head + "a"), ("", head + "b"), ("", " " + head + "a ")], "url string, text string")
    assert df.select(ID.dedup_key(F.col("url"), F.col("text")).alias("k")).distinct().count() == 2


def html(spark, values, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, html string")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_units_and_nested_elements(spark):
    from threadsift.sources.readers import page_units
    page = ('<body><div role="feed"><div class="u">one<div>deep</div></div><p>x</p><div role="article">two<div role="article">reply</div></div></div>'
            '<div role="article">three<div>open</body>')
    got = sorted((r.kind, r.unit_pos, r.html) for r in page_units(spark.createDataFrame([(1, page), (2, ""), (3, None)], "page_id long, html string")).collect())
    assert got == [("article", 0, 'two<div role="article">reply</div>'), ("article", 1, "reply"), ("article", 2, "three<div>open</body>"),
                   ("feed", 0, "one<div>deep</div>"), ("feed", 1, 'two<div role="article">reply</div>')]


def test_body_text_blocks(spark):
    got = html(spark, [
        '<div dir="auto"><div>one</div><div>longer two</div></div>',
        '<div dir="auto">I <span>really</span> like <a href="#">this</a> thing</div>',
        '<div dir="auto">post body</div><div role="article"><div dir="auto">a longer reply than the post</div></div>',
        '<span dir="auto">span body</span>', '<div dir="auto">tiny</div><p>whole text</p>',
        '<div dir="auto">short1</div><div data-ad-preview="message">the message<br>itself</div>', "y" * 5000], H.body_text())
    assert got == ["one\nlonger two", "I really like this thing", "post body", "span body", "tiny\nwhole text", "the message\nitself", "y" * 5000]


def test_counts_of_whole_nodes(spark):
    units = ["<p>12 comments</p><span>8 comments</span>", "<span><b>8</b> comments</span>", '<div role="button"><span>1.2K</span> shares</div>',
             "<div>Hello there</div><div><span>8 comments</span></div>", '<div role="article"><span>9 comments</span></div>', "<span>8 comments and more of them</span>"]
    c, s = H.anchored_counts()
    assert html(spark, units, c) == ["8", "8", "", "8", "", ""] and html(spark, units, s) == ["", "", "1.2K", "", "", ""]


def test_reactions_authors_and_permalinks(spark):
    assert html(spark, ['<span aria-label="25 reactions"></span>', '<span aria-hidden="true">1.2K</span>', '<span aria-hidden="true">x 3</span>'],
                H.reaction_count(fallback=True)) == ["25", "1.2K", ""]
    many = "".join(f'<a href="https://www.facebook.com/u/{i}">reply {i}</a>' for i in range(40))
    assert html(spark, ['<h2><strong><span><a href="/x">Sam Doe</a></span></strong></h2>', '<div data-ad-rendering-role="profile_name"><b><a href="/y">Ann Lee</a></b></div>',
                        many + '<a href="https://www.facebook.com/z">Late Name</a>'], H.author_from_links()) == ["Sam Doe", "Ann Lee", "Late Name"]
    assert html(spark, ['<a href="https://f/posts/x?comment_id=1">a</a><a href="https://f/groups/1/posts/77/?comment_id=2">b</a>',
                        '<a href="/posts/55?comment_id=1">a</a>'], H.permalink(F.col("html"), "9")) == [
        "https://f/groups/1/posts/77/", "https://www.facebook.com/groups/9/posts/55/"]


def test_strip_equals_python(spark):
    """Every blank that Python strips, at both ends and within; a long run costs no more than its length."""
    import time
    blanks = [c for c in map(chr, range(0x3001)) if c.isspace()]
    rows = [f"{c}a{c}b{c}" for c in blanks] + ["".join(blanks), "", "\u200bx\u200b", " \u2067x "]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, t string")
    got = {r["i"]: r for r in df.select("i", TX.py_strip("t").alias("s"), TX.strip_bidi("t").alias("b")).collect()}
    assert all(got[i]["s"] == t.strip() for i, t in enumerate(rows))
    assert got[len(rows) - 2]["b"] == "x"  # marks at the ends go
    long = spark.createDataFrame([("a" + " " * 200_000 + "b\n" + " " * 200_000 + "c",)], "t string")
    long.select(TX.py_strip("t"), TX.normalize_whitespace("t")).collect()
    t0 = time.perf_counter()
    assert long.select(TX.normalize_whitespace("t").alias("t")).first()["t"] == "a" + " " * 200_000 + "b\nc"
    assert time.perf_counter() - t0 < 5
