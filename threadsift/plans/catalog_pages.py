"""Saved pages -> units, their single extractions, and posts.

The oracles do not read markup: they know each unit by construction (``adapter.unit_markup``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadsift.functions import html as H
from threadsift.functions.identity import DEFAULT_GROUP_ID
from threadsift.operators import dedup as DD
from threadsift.plans import pages as PG
from threadsift.plans import sqlgen as G
from threadsift.plans.registry import register
from threadsift.sources import adapter as AD
from threadsift.sources.adapter import decorated_pages, posts_from_tables
from threadsift.sources.readers import page_units as _units


def units(spark, sf):
    return _units(decorated_pages(spark, sf))


# ------------------------------------------------------------ the units by construction
U = f"""fu AS (SELECT page_id, unnest(range(0, {AD.FEED_SIZE})) AS j FROM pages),
feed AS (SELECT page_id, 'feed' AS kind, CAST(j AS INTEGER) AS unit_pos, CAST(page_id * 10 + j AS BIGINT) AS u, CASE WHEN page_id % 5 = 2 AND j = 1 THEN 'skeleton' ELSE 'post' END AS what FROM fu),
reply AS (SELECT page_id, 'article' AS kind, CAST(row_number() OVER (PARTITION BY page_id ORDER BY unit_pos) - 1 AS INTEGER) AS unit_pos, u, 'reply' AS what FROM feed WHERE what = 'post'),
art AS (SELECT page_id, 'article' AS kind, CAST((SELECT count(*) FROM reply r WHERE r.page_id = p.page_id) AS INTEGER) AS unit_pos, CAST({AD.ARTICLE_UNIT} AS BIGINT) AS u, 'article' AS what FROM pages p WHERE page_id % 5 IN (2, 3)),
un0 AS (SELECT * FROM feed UNION ALL SELECT * FROM reply UNION ALL SELECT * FROM art),
un AS (SELECT *, what IN ('post', 'article') AS full_, CASE WHEN what IN ('post', 'article') THEN {AD.LINK_KIND} END AS lk,
  CASE what WHEN 'post' THEN {AD.unit_markup(False)} WHEN 'article' THEN {AD.unit_markup(True)} WHEN 'skeleton' THEN {AD.SKELETON} ELSE '{AD.REPLY}' END AS html FROM un0)"""
WITH = "WITH " + U
ID = "page_id, kind, unit_pos"
S = "CAST(u AS VARCHAR)"
BODY = (f"CASE what WHEN 'skeleton' THEN 'Loading ' || {S} WHEN 'reply' THEN 'A much longer reply, which must not be taken for the body of the post above it' ELSE "
        f"CASE u % 3 WHEN 0 THEN 'Body ' || {S} || ' first' || chr(10) || 'second bold & wide' WHEN 1 THEN 'Span body ' || {S} || ' here' ELSE 'Message body ' || {S} || chr(10) || 'line two' END END")
MEMBER = "CASE WHEN full_ THEN 'Member ' || CAST(u % 30 AS VARCHAR) ELSE '' END"
# article units know links to the host or to profile.php only
AUTHOR = f"CASE WHEN kind = 'feed' OR u % 2 = 1 THEN {MEMBER} ELSE '' END"
POST_URL = f"'https://example.org/groups/1/posts/' || {S} || '/'"
URL = f"CASE WHEN lk IN (0, 1) THEN {POST_URL} WHEN lk = 2 THEN 'https://example.org/permalink.php?story_fbid=' || {S} || '&id=1' ELSE '' END"
TIME = "CASE lk WHEN 0 THEN CAST(u % 23 + 1 AS VARCHAR) || 'h' WHEN 2 THEN '2d' ELSE '' END"
LIKES = "CASE WHEN full_ THEN CAST(u % 50 AS VARCHAR) ELSE '' END"
COMMENTS = "CASE WHEN full_ THEN CAST(u % 9 AS VARCHAR) WHEN what = 'reply' THEN '77' ELSE '' END"
SHARES = "CASE WHEN full_ THEN CAST(u % 5 AS VARCHAR) ELSE '' END"
IMAGE = f"CASE WHEN full_ THEN 'https://scontent.example.fbcdn.net/v/p' || {S} || '.jpg' ELSE '' END"


def _one(name: str, sql: str, doc: str, *cols):
    """Register a query of one extraction per unit."""
    def run(spark, sf):
        return H.with_markup(units(spark, sf)).select("page_id", "kind", "unit_pos", *[c().alias(n) for n, c in cols])
    run.__doc__ = doc
    register(name, f"{WITH}\nSELECT {ID}, {sql} FROM un")(run)


_one("page_units", "CAST(length(html) AS BIGINT) AS html_len, md5(html) AS html_md5", "A10: feed units and article elements of a page, cut by depth.",
     ("html_len", lambda: F.length("html").cast("long")), ("html_md5", lambda: F.md5("html")))
_one("unit_filters", "NOT full_ AS skeleton, what = 'article' AS big_enough", "B6/B7: skeleton units (small and link-less) and the article size floor.",
     ("skeleton", lambda: H.is_skeleton(F.col("html"))), ("big_enough", lambda: H.big_enough(F.col("html"))))
_one("engagement_lines", f"CASE WHEN full_ THEN '99' WHEN what = 'reply' THEN '77' ELSE '' END AS comments, {SHARES} AS shares",
     "C7: counts from short number-leading lines of the unit's own text.",
     ("comments", lambda: H.line_counts(H.SHARED)[0]), ("shares", lambda: H.line_counts(H.SHARED)[1]))
_one("anchored_counts", f"{COMMENTS} AS comments, {SHARES} AS shares", "C8: whole-node count texts ('8 comments'), nested replies excluded.",
     ("comments", lambda: H.anchored_counts(H.SHARED)[0]), ("shares", lambda: H.anchored_counts(H.SHARED)[1]))
_one("engagement_fallback", f"{COMMENTS} AS comments, {SHARES} AS shares", "C9: anchored counts with the line parser as per-field fallback.",
     ("comments", lambda: H.engagement_counts(H.SHARED)[0]), ("shares", lambda: H.engagement_counts(H.SHARED)[1]))
_one("reaction_label", f"CASE WHEN what = 'article' AND u % 2 = 1 THEN '' ELSE {LIKES} END AS likes, {LIKES} AS likes_or_hidden",
     "C10: reaction count from like/react labels, and with the hidden bare number as fallback.",
     ("likes", lambda: H.reaction_count(H.SHARED)), ("likes_or_hidden", lambda: H.reaction_count(H.SHARED, fallback=True)))
_one("author_from_links", f"{MEMBER} AS author, CASE WHEN full_ AND u % 2 = 1 THEN {MEMBER} ELSE '' END AS article_author", "C13: author from profile name, heading or named link.",
     ("author", lambda: H.author_from_links(H.SHARED)), ("article_author", lambda: H.article_author()))
_one("permalink", f"{URL} AS url", "C17: permalink choice (clean link, first comment link with a base or id).",
     ("url", lambda: H.permalink(F.col("html"), DEFAULT_GROUP_ID)))
_one("time_label", f'{TIME} AS "timestamp"', "C18: visible time label of the post link.", ("timestamp", lambda: H.time_label(F.col("html"))))
_one("image_urls", f"{IMAGE} AS images", "C19: kept image URLs in order, distinct.", ("images", lambda: F.array_join(H.image_urls(F.col("html")), "|")))
_one("body_text", f"{BODY} AS text", "C20: body text of a unit (block, span, message or whole text).", ("text", lambda: H.body_text(H.SHARED)))
_one("post_or_comment", "NOT coalesce(lk IN (0, 2), false) AS is_comment", "C21: post-vs-comment classification.", ("is_comment", lambda: H.is_comment(F.col("html"))))


CLEAN_LINKS = f"""cl AS (SELECT page_id, u FROM un WHERE lk = 0 UNION ALL SELECT page_id, page_id * 10 FROM pages WHERE page_id % 5 = 4)"""


@register("permalink_harvest", f"{WITH}, {CLEAN_LINKS}\nSELECT DISTINCT page_id, {S} AS post_id FROM cl")
def permalink_harvest(spark, sf):
    """Distinct post ids per page from its clean post links."""
    p = decorated_pages(spark, sf)
    return p.select("page_id", F.explode(H.harvested_post_ids(F.col("html"))).alias("post_id")).distinct()


@register("id_pre_dedup", f"""WITH {G.posts_cte()}, {U}
, i AS (SELECT {ID}, CASE WHEN lk = 0 THEN {S} END AS post_id FROM un),
seen AS (SELECT DISTINCT nullif(regexp_extract(url, '/posts/([0-9]+)', 1), '') AS post_id FROM posts)
SELECT {ID}, post_id FROM i WHERE post_id IS NULL OR post_id NOT IN (SELECT post_id FROM seen WHERE post_id IS NOT NULL)""")
def id_pre_dedup(spark, sf):
    """Units whose clean post id is already stored are skipped before extraction."""
    u = units(spark, sf).select("page_id", "kind", "unit_pos", H.first(H.harvested_post_ids(F.col("html"))).alias("post_id"))
    return DD.not_seen_ids(u, posts_from_tables(spark, sf)).select("page_id", "kind", "unit_pos", "post_id")


GUESS = f"CASE WHEN {AUTHOR} <> '' THEN {AUTHOR} WHEN what = 'reply' THEN '' ELSE split_part({BODY}, chr(10), 1) END"
POSTS = f"""pp AS (SELECT {ID}, what, u, lk, {BODY} AS body, {GUESS} AS author, {TIME} AS "timestamp", {URL} AS url,
  CASE WHEN kind = 'feed' OR u % 2 = 1 OR what = 'article' THEN {LIKES} ELSE '' END AS likes, {COMMENTS} AS comments, {SHARES} AS shares, {IMAGE} AS images FROM un),
po AS (SELECT *, CASE WHEN author <> '' AND starts_with(body, author || chr(10)) THEN substr(body, length(author) + 2) ELSE body END AS text FROM pp)"""


@register("page_posts", f"""{WITH}, {POSTS}
SELECT {ID}, text, author, "timestamp", url, likes, comments, shares, images, false AS is_video, false AS is_share FROM po WHERE what IN ('post', 'article')""")
def page_posts(spark, sf):
    """From a page's units to posts: every extraction chained; skeletons and replies left out by B6 and B7."""
    h = F.col("html")
    u = PG.stored(units(spark, sf), "units").filter(F.when(F.col("kind") == "feed", ~H.is_skeleton(h)).otherwise(H.big_enough(h)))
    return PG.posts_from_units(u).withColumn("images", F.array_join("images", "|"))


@register("strategy_union", f"""{WITH}, {POSTS}, {CLEAN_LINKS},
nf AS (SELECT page_id FROM pages WHERE page_id NOT IN (SELECT page_id FROM un WHERE what = 'post')),
ln AS (SELECT page_id, u, CAST(row_number() OVER (PARTITION BY page_id ORDER BY u) - 1 AS INTEGER) AS unit_pos FROM cl JOIN nf USING (page_id)),
c AS (SELECT CASE WHEN what = 'post' THEN 0 ELSE 2 END AS strategy, page_id, unit_pos, {G.dedup_key('url', 'text')} AS key FROM po WHERE what = 'post' OR (what = 'article' AND lk IN (0, 2))
  UNION ALL SELECT 1, page_id, unit_pos, {POST_URL} FROM ln)
SELECT key, strategy, page_id, unit_pos FROM c QUALIFY row_number() OVER (PARTITION BY key ORDER BY strategy, page_id, unit_pos) = 1""")
def strategy_union(spark, sf):
    """E5: priority union of feed units, link-found posts (only for pages without feed units)
    and the article supplement without comments; first strategy wins per key.  A link without a
    container (the pages with page_id % 5 = 4) counts with its URL alone."""
    return PG.strategy_union(decorated_pages(spark, sf), units(spark, sf), bare_links=True).select("key", "strategy", "page_id", "unit_pos")
