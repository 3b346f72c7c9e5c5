"""From saved pages to posts: units, one post a unit, and the union of the three search strategies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsift.functions import html as H
from threadsift.functions import text as TX
from threadsift.functions.identity import DEFAULT_GROUP_ID, dedup_key
from threadsift.session import checkpoint_path

def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: units are cut and posts extracted once, whatever reads them."""
    path = checkpoint_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


POST_COLS = ["text", "author", "timestamp", "url", "likes", "comments", "shares", "images", "is_video", "is_share"]


def posts_from_units(units: DataFrame, group_id: str = DEFAULT_GROUP_ID) -> DataFrame:
    """page_id, kind, unit_pos and the fields of a post for every unit: body, cleaning, flags, author (links,
    else the first line), prefix strip, permalink, time label, counts and images."""
    feed = F.col("kind") == "feed"
    m = H.SHARED
    c, s = H.engagement_counts(m)
    d = H.with_markup(units).select("page_id", "kind", "unit_pos", TX.clean_text(H.body_text(m)).alias("text"),
                     F.when(feed, H.author_from_links(m)).otherwise(H.article_author()).alias("author"),
                     H.time_label(F.col("html")).alias("timestamp"), H.permalink(F.col("html"), group_id).alias("url"),
                     F.when(feed, H.reaction_count(m)).otherwise(H.reaction_count(m, fallback=True)).alias("likes"),
                     c.alias("comments"), s.alias("shares"), H.image_urls(F.col("html")).alias("images"))
    video, share = TX.media_flags(F.col("text"))
    d = d.withColumns({"is_video": video, "is_share": share,
                       "author": F.when(F.col("author") != "", F.col("author")).otherwise(TX.author_guess(F.col("text")))})
    return d.withColumn("text", TX.strip_author_prefix(F.col("text"), F.col("author"))).select("page_id", "kind", "unit_pos", *POST_COLS)


def strategy_posts(pages: DataFrame, units: DataFrame, bare_links: bool = False) -> DataFrame:
    """(strategy, bare, page_id, unit_pos, key and post fields) of all candidates: feed units that are no
    skeletons (0); the containers of clean links, one a post id, on pages without such units (1); articles that
    are large enough and no comments (2).  Candidates without text and media are gone (B5).  A link without
    a container gives no post, or with ``bare_links`` its URL alone."""
    h = F.col("html")
    units = stored(units, "units")
    chosen = units.filter(F.when(F.col("kind") == "feed", ~H.is_skeleton(h)).otherwise(H.big_enough(h) & ~H.is_comment(h)))
    with_feed = units.filter((F.col("kind") == "feed") & ~H.is_skeleton(h)).select("page_id").distinct()
    link = stored(pages.join(with_feed, "page_id", "left_anti").select("page_id", F.lit("link").alias("kind"), F.posexplode(F.expr(H.post_links())).alias("unit_pos", "l"))
                  .select("page_id", "kind", "unit_pos", "l.href", "l.html"), "links")
    held = link.filter(h.isNotNull())
    full = (stored(posts_from_units(chosen.unionByName(held.drop("href"))), "unit-posts")
            .withColumns({"strategy": F.when(F.col("kind") == "feed", F.lit(0)).when(F.col("kind") == "link", F.lit(1)).otherwise(F.lit(2)), "bare": F.lit(False)}))
    if bare_links:
        bare = (link.filter(h.isNull()).select("page_id", "kind", "unit_pos", H.decode_entities("href").alias("url"))
                .withColumns({"strategy": F.lit(1), "bare": F.lit(True), **{c: F.lit("") for c in POST_COLS if c not in ("url", "images", "is_video", "is_share")},
                              "images": F.array().cast("array<string>"), "is_video": F.lit(False), "is_share": F.lit(False)}))
        full = full.unionByName(bare)
    return full.filter(TX.content_ok(F.col("text"), F.col("images"), F.col("url"))).withColumn("key", dedup_key(F.col("url"), F.col("text")))


def strategy_union(pages: DataFrame, units: DataFrame, bare_links: bool = False) -> DataFrame:
    """E5: one post per key with its fields; a post wins over a bare link, then the first strategy, then page and place."""
    place = ["bare", "strategy", "page_id", "unit_pos"]
    posts = strategy_posts(pages, units, bare_links)
    win = posts.groupBy("key").agg(F.min(F.struct(*place)).alias("w")).select("key", "w.*")
    return posts.join(win, ["key", *place], "left_semi").select("key", "strategy", "page_id", "unit_pos", *POST_COLS)
