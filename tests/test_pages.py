"""Saved pages written by hand: the link strategy and its containers."""

from pyspark.sql import functions as F

from threadsift.functions import html as H
from threadsift.plans import pages as PG
from threadsift.sources.readers import page_units

POST = "https://example.org/groups/1/posts/"
ARTICLE = ('<div role="article"><h2><a href="https://www.facebook.com/user/1">Ann Lee</a></h2><div><div>'
           f'<a href="{POST}7/?a=1&amp;b=2">3h</a></div></div><div dir="auto">The words of the post</div>'
           '<span aria-label="12 reactions"></span><span>4 comments</span><span>2 shares</span>'
           f'<img src="https://scontent.example.fbcdn.net/v/p.jpg"><a href="{POST}7/?c=3">again</a>{{pad}}</div>')
PAD = "<p>" + "x" * 5001 + "</p>"


def pages(spark, *html):
    return spark.createDataFrame([(i, h) for i, h in enumerate(html)], "page_id long, html string")


def test_link_posts_have_the_fields_of_their_container(spark):
    small = ARTICLE.format(pad="")
    p = pages(spark, small, f'<p><a href="{POST}9/">post</a></p>', small.replace("/7/", "/8/") + "<div>" + ARTICLE.format(pad=PAD).replace("/7/", "/6/") + "</div>")
    got = {(r["page_id"], r["unit_pos"]): r for r in PG.strategy_union(p, page_units(p)).collect()}
    assert {k: r["strategy"] for k, r in got.items()} == {(0, 0): 1, (2, 0): 1, (2, 1): 1}
    r = got[0, 0]
    assert (r["key"], r["url"], r["text"], r["author"], r["timestamp"]) == (POST + "7/?a=1&b=2",) * 2 + ("The words of the post", "Ann Lee", "3h")
    assert (r["likes"], r["comments"], r["shares"], r["images"]) == ("12", "4", "2", ["https://scontent.example.fbcdn.net/v/p.jpg"])
    assert all(r["text"] == "The words of the post" for r in got.values())


def test_bare_links_lose_to_posts(spark):
    p = pages(spark, f'<p><a href="{POST}7/">post</a></p>', ARTICLE.format(pad="").replace("/7/?a=1&amp;b=2", "/7/"), f'<a href="{POST}9/?x">a</a><a href="{POST}9/?y">b</a>')
    got = {r["key"]: (r["page_id"], r["text"]) for r in PG.strategy_union(p, page_units(p), bare_links=True).collect()}
    assert got == {POST + "7/": (1, "The words of the post"), POST + "9/?x": (2, "")}


def test_large_ancestors(spark):
    link = f'<a href="{POST}5/">1h</a>'

    def nest(depth, *at):
        """The link in so many divs; after the div at each of these levels, counted outwards, follows the padding."""
        out = link
        for i in range(1, depth + 1):
            out = f'<div id="{i}">{out}{PAD if i in at else ""}</div>'
        return out
    p = pages(spark, nest(3, 1), nest(4, 1), nest(7, 6), nest(8, 8), nest(5), "</div><div>gone</div>" + nest(4, 3), nest(9, 2, 7))
    got = {r["page_id"]: r["l"]["html"] for r in p.select("page_id", F.explode(F.expr(H.post_links())).alias("l")).collect()}
    level = {k: v and int(v[v.index('id="') + 4]) + 1 for k, v in got.items()}
    assert level == {0: None, 1: 4, 2: 6, 3: None, 4: None, 5: 4, 6: 4}


def test_the_query_counts_links_without_a_container(spark, tmpdir_path):
    """Pages with page_id % 5 = 4 hold a link alone; each gives a row of strategy 1."""
    from threadsift.plans import catalog_pages as CP
    rows = [(i, f"https://example.org/{i}", "<p>page</p>") for i in range(10)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmpdir_path}/pages.parquet")
    got = {(r["page_id"], r["key"]) for r in CP.strategy_union(spark, tmpdir_path).filter("strategy = 1").collect()}
    assert {(4, POST + "40/"), (9, POST + "90/")} <= got
