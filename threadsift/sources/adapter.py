"""Adapter: the driver's test tables -> the post and page shapes the operators expect.

The test tables hold no social posts, so post fields are derived row by row,
deterministically, from ``documents`` (text, source), ``events`` (likes) and
``conversations`` (comments).  Every document becomes one post, and every event
and every turn counts once: it belongs to one document, chosen by its id modulo
the number of documents.  ``threadsift.plans.sqlgen.posts_cte`` has the same
derivation in DuckDB SQL.

* ``seq = doc_id``; ``author = '' if doc_id % 17 == 0 else source + '/' + lang`` (~80 posters + a blank one)
* ``url = '' if doc_id % 5 == 0 else https://example.org/groups/1/posts/<doc_id % 400>/``
  (forces URL collisions for the de-duplication operators)
* ``likes`` = events with ``event_id % n_docs == doc_id`` as text, written with
  Arabic-Indic digits when ``doc_id % 3 == 0``, ``''`` when ``% 7``,
  ``'1.2K'`` when ``% 11``, ``'1,234'`` when ``% 13`` (first rule wins)
* ``comments`` = turns with ``(conv_id * 8 + turn) % n_docs == doc_id`` as text; ``shares = ''``
* a line of ``phrases`` follows the text: words of the lexicons, a category (or none) by
  ``doc_id`` for each of them, so that every scale and every tag has posts of several kinds
* ``with_counts=True`` appends ``\\n<doc_id%97> comments\\n<doc_id%13> shares\\n<doc_id*7> EGP``

The documents are joined with the counts on doc_id, tables that grow alike; Spark
chooses the join by their measured sizes.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadsift import lexicons as L
from threadsift.functions.text import ARABIC_DIGITS, ASCII_DIGITS, SHARE_MARKERS, VIDEO_MARKERS

#: how many documents in a row share a phrase, for each of ``phrases()`` in turn
STEPS = (1, 2, 3, 5, 7, 11, 13, 17, 19, 23, 29)


def _plain(words) -> str:
    """The first entry that stands for itself as a regular expression."""
    return next((w for w in words if not re.search(r"[\\^$.|?*+()\[{]", w)), "")


def phrases() -> list[list[str]]:
    """Lists of phrases: one word of each category of a lexicon, and the text markers."""
    out = [[_plain(lex.keywords(c)) for c in lex.categories] for lex in L.demographic_lexicons().values()]
    seg = L.segment_lexicon()
    out.append([next(k for k in seg.keywords(c) if k == k.lower()) for c in seg.categories])
    out.append([L.URGENCY_KEYWORDS[0], " ".join(L.URGENCY_KEYWORDS[:3]), " ".join(L.SEVERITY_KEYWORDS[:4])])
    for lex in (L.pain_lexicon(), L.pain_point_lexicon(), L.tool_lexicon()):
        out.append([_plain(lex.keywords(c)) for c in lex.categories])
    out.append([VIDEO_MARKERS[-1], SHARE_MARKERS[-1], L.TRUNCATION_MARKERS[0]])
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _by_document(rows: DataFrame, key, n_docs: DataFrame, out: str) -> DataFrame:
    """(doc_id, out): how many rows belong to each document; n_docs is one row."""
    return (rows.select(key.alias("__id")).crossJoin(F.broadcast(n_docs)).groupBy((F.col("__id") % F.col("n_docs")).alias("doc_id"))
            .agg(F.count(F.lit(1)).alias(out)))


def posts_from_tables(spark: SparkSession, sf_dir: str, with_counts: bool = False) -> DataFrame:
    # dealt by doc_id under a fixed rule: the joins on doc_id want it, and the work on texts uses all cores however the files are cut
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang").repartition("doc_id")
    n_docs = table(spark, sf_dir, "documents").agg((F.coalesce(F.max("doc_id"), F.lit(0)) + 1).alias("n_docs"))
    ev = _by_document(table(spark, sf_dir, "events"), F.col("event_id"), n_docs, "n_events")
    cv = _by_document(table(spark, sf_dir, "conversations"), F.col("conv_id") * 8 + F.col("turn"), n_docs, "n_turns")
    d = docs.join(ev, "doc_id", "left").join(cv, "doc_id", "left")
    n = F.coalesce(F.col("n_events"), F.lit(0)).cast("string")
    i = F.col("doc_id")
    likes = (F.when(i % 3 == 0, F.translate(n, ASCII_DIGITS, ARABIC_DIGITS))
             .when(i % 7 == 0, F.lit(""))
             .when(i % 11 == 0, F.lit("1.2K"))
             .when(i % 13 == 0, F.lit("1,234"))
             .otherwise(n))
    said = [F.element_at(F.array(*[F.lit(p) for p in [*ps, "", ""]]), (F.floor(i / s) % (len(ps) + 2) + 1).cast("int"))
            for ps, s in zip(phrases(), STEPS)]
    text = F.concat(F.col("text"), F.lit("\n"), F.concat_ws(" ", *said))
    if with_counts:
        text = F.concat(text, F.lit("\n"), (i % 97).cast("string"), F.lit(" comments\n"),
                        (i % 13).cast("string"), F.lit(" shares\n"), (i * 7).cast("string"), F.lit(" EGP"))
    return d.select(
        i.alias("seq"),
        i.alias("index"),
        text.alias("text"),
        F.when(i % 17 == 0, F.lit("")).otherwise(F.concat(F.col("source"), F.lit("/"), F.col("lang"))).alias("author"),
        F.lit("").alias("timestamp"),
        F.when(i % 5 == 0, F.lit("")).otherwise(
            F.concat(F.lit("https://example.org/groups/1/posts/"), (i % 400).cast("string"), F.lit("/"))).alias("url"),
        likes.alias("likes"),
        F.coalesce(F.col("n_turns"), F.lit(0)).cast("string").alias("comments"),
        F.lit("").alias("shares"),
        F.array().cast("array<string>").alias("images"),
        F.lit(False).alias("is_video"),
        F.lit(False).alias("is_share"),
    )


# ---------------------------------------------------------------- pages
# The markup below is SQL that Spark and DuckDB read alike, so that the oracle knows every unit by
# construction.  ``u`` numbers a unit: page_id * 10 + place.
def _s(x: str) -> str:
    return f"CAST({x} AS STRING)"


REPLY = ('<div dir="auto">A much longer reply, which must not be taken for the body of the post above it</div>'
         "<span>77 comments</span>")
LINK_KIND = "((u // 10 + u % 10) % 4)"


def unit_markup(article: bool) -> str:
    """SQL over ``u``: the inner markup of a unit.  Links by LINK_KIND: a clean post link, a useless comment link
    before a good one, permalink.php, none.  Bodies by u % 3: nested blocks, a span, a short block beside a message."""
    u, n = _s("u"), _s("u % 30")
    head = (f"""CASE WHEN u % 2 = 0 THEN '<h2><span><a href="https://example.org/user/' || {n} || '">Member ' || {n} || '</a></span></h2>' """
            f"""ELSE '<div data-ad-rendering-role="profile_name"><a href="https://www.facebook.com/user/' || {n} || '">Member ' || {n} || '</a></div>' END""")
    link = (f"""CASE {LINK_KIND} WHEN 0 THEN '<a href="https://example.org/groups/1/posts/' || {u} || '/">' || {_s("u % 23 + 1")} || 'h</a>' """
            f"""WHEN 1 THEN '<a href="https://example.org/posts/x?comment_id=1">r</a><a href="https://example.org/groups/1/posts/' || {u} || '/?comment_id=7">Reply</a>' """
            f"""WHEN 2 THEN '<a href="https://example.org/permalink.php?story_fbid=' || {u} || '&amp;id=1">2d</a>' ELSE '' END""")
    body = (f"""CASE u % 3 WHEN 0 THEN '<div dir="auto"><div>Body ' || {u} || ' first</div><div>second <b>bold</b> &amp; <i>wide</i></div></div><div dir="auto">short</div>' """
            f"""WHEN 1 THEN '<div><span dir="auto">Span body <b>' || {u} || '</b> here</span></div>' """
            f"""ELSE '<div dir="auto">short1</div><div data-ad-preview="message">Message body ' || {u} || '<br>line two</div>' END""")
    likes = f"""'<span aria-label="' || {_s("u % 50")} || ' reactions"></span>'"""
    if article:
        likes = f"""CASE WHEN u % 2 = 1 THEN '<div><span aria-hidden="true">' || {_s("u % 50")} || '</span></div>' ELSE {likes} END"""
    counts = f"""'<p>99 comments</p><span><b>' || {_s("u % 9")} || '</b> comments</span><div role="button"><span>' || {_s("u % 5")} || ' shares</span></div>'"""
    images = f"""'<img src="https://scontent.example.fbcdn.net/v/p' || {u} || '.jpg"><img src="https://static.example.fbcdn.net/rsrc.php/emoji.png">'"""
    tail = f"""'<div data-f="' || repeat('x', 2100) || '"></div>'""" if article else f"""'<div role="article">{REPLY}</div>'"""
    return " || ".join([head, link, body, likes, counts, images, tail])


SKELETON = f"""'<div class="s">Loading ' || {_s("u")} || '</div>'"""
#: by page_id % 5: 0 and 1 a feed of one or two units; 2 a feed whose second unit is a skeleton, and an article;
#: 3 an article that repeats the first unit of the feed three pages before; 4 a link alone
FEED_SIZE = "CASE WHEN page_id % 5 < 2 THEN 1 + page_id % 2 WHEN page_id % 5 = 2 THEN 2 ELSE 0 END"
ARTICLE_UNIT = "CASE page_id % 5 WHEN 2 THEN page_id * 10 + 9 WHEN 3 THEN (page_id - 3) * 10 END"


def decorated_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a feed, articles and links after their own markup, of shapes by page_id (see FEED_SIZE).
    Pages are dealt by page_id, since cutting markup is far more work than moving it."""
    p = table(spark, sf_dir, "pages").select("page_id", "url", "html").repartition("page_id")

    def sql(x: str) -> str:
        return x.replace("//", "div").replace("https:div", "https://")

    def at(markup: str, unit: str) -> str:
        return f"element_at(transform(array({unit}), u -> {markup}), 1)"
    unit = f"CASE WHEN page_id % 5 = 2 AND j = 1 THEN {at(SKELETON, 'page_id * 10 + j')} ELSE {at(unit_markup(False), 'page_id * 10 + j')} END"
    feed = (f"CASE WHEN ({FEED_SIZE}) > 0 THEN '<div role=\"feed\">' || array_join(transform(sequence(0, greatest(({FEED_SIZE}) - 1, 0)), "
            f"j -> '<div class=\"u\">' || {unit} || '</div>'), '') || '</div>' ELSE '' END")
    art = f"CASE WHEN page_id % 5 IN (2, 3) THEN '<div role=\"article\">' || {at(unit_markup(True), ARTICLE_UNIT)} || '</div>' ELSE '' END"
    link = f"CASE WHEN page_id % 5 = 4 THEN '<p>see <a href=\"https://example.org/groups/1/posts/' || {_s('page_id * 10')} || '/\">post</a></p>' ELSE '' END"
    return p.select("page_id", "url", F.expr(f"html || {sql(feed)} || {sql(art)} || {link}").alias("html"))
