"""Base per-post columns and text cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadsift.functions import identity as ID
from threadsift.functions import text as TX
from threadsift.functions.numbers import engagement_total, parse_count
from threadsift.plans import sqlgen as G
from threadsift.plans.registry import register
from threadsift.schema import DEFAULTS_PAIN, DEFAULTS_PROFILE
from threadsift.sources.adapter import posts_from_tables, table
from threadsift.sources.readers import with_defaults

POSTS = "WITH " + G.posts_cte()


@register("posts_defaults", POSTS + """
, j AS (SELECT p.seq, CAST(l.quality AS VARCHAR) AS likes, CASE WHEN l.toxic = 1 THEN NULL ELSE p.author END AS author
  FROM posts p LEFT JOIN labels l ON l.doc_id = p.seq)
SELECT seq, coalesce(likes, '0') AS likes_pain, coalesce(likes, '') AS likes_profile, coalesce(author, 'Unknown') AS author FROM j""")
def posts_defaults(spark, sf):
    """B1: NULL (missing) fields take each consumer's default; labels give real gaps."""
    lab = table(spark, sf, "labels").select(F.col("doc_id").alias("seq"), "quality", "toxic")
    p = posts_from_tables(spark, sf).select("seq", "author").join(lab, "seq", "left")
    p = p.select("seq", F.col("quality").cast("string").alias("likes"),
                 F.when(F.col("toxic") == 1, F.lit(None).cast("string")).otherwise(F.col("author")).alias("author"))
    p = p.withColumns({"likes_pain": F.col("likes"), "likes_profile": F.col("likes")})
    return with_defaults(p, {"likes_pain": DEFAULTS_PAIN["likes"], "likes_profile": DEFAULTS_PROFILE["likes"],
                             "author": DEFAULTS_PROFILE["author"]}).drop("likes")


@register("count_parse_modes", POSTS + f"""
SELECT seq, likes, {G.parse_strict('likes')} AS strict, {G.parse_digits('likes')} AS digits, {G.parse_scaled('likes')} AS scaled FROM posts""")
def count_parse_modes(spark, sf):
    """Count strings parsed in strict, digits and scaled modes (Arabic-Indic digits first)."""
    p = posts_from_tables(spark, sf)
    return p.select("seq", "likes", *[parse_count(F.col("likes"), m).alias(m) for m in ("strict", "digits", "scaled")])


@register("engagement_total", POSTS + f"""
SELECT seq, {G.parse_strict('likes')} + {G.parse_strict('comments')} + {G.parse_strict('shares')} AS pain_engagement,
  {G.parse_digits('likes')} + {G.parse_digits('comments')} AS profile_engagement FROM posts""")
def engagement_totals(spark, sf):
    """likes+comments+shares (strict) and likes+comments (digits)."""
    p = posts_from_tables(spark, sf)
    return p.select("seq",
                    engagement_total(F.col("likes"), F.col("comments"), F.col("shares"), "strict").alias("pain_engagement"),
                    engagement_total(F.col("likes"), F.col("comments"), None, "digits").alias("profile_engagement"))


@register("dedup_key", POSTS + f"""
SELECT seq, {G.dedup_key()} AS dedup_key FROM posts""")
def dedup_key_q(spark, sf):
    """Stripped URL, else the SHA-256 of the whole stripped text."""
    p = posts_from_tables(spark, sf)
    return p.select("seq", ID.dedup_key(F.col("url"), F.col("text")).alias("dedup_key"))


@register("post_id_from_url", POSTS + f"""
SELECT seq, coalesce(nullif(regexp_extract(url, '/posts/([0-9]+)', 1), ''), nullif(regexp_extract(url, 'story_fbid=([0-9]+)', 1), '')) AS post_id,
  coalesce(nullif(regexp_extract(url, '/groups/([0-9]+)', 1), ''), {G.q(ID.DEFAULT_GROUP_ID)}) AS group_id FROM posts""")
def post_id_from_url(spark, sf):
    """Numeric post id and group id from the URL."""
    p = posts_from_tables(spark, sf)
    return p.select("seq", ID.post_id_from_url(F.col("url")).alias("post_id"), ID.group_id_from_url(F.col("url")).alias("group_id"))


@register("previews", POSTS + """
SELECT seq, CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END AS preview200,
  substr(text, 1, 400) AS preview400, CASE WHEN t = '' THEN '[media-only]' ELSE substr(t, 1, 60) END AS preview60
FROM (SELECT *, CASE WHEN seq % 9 = 0 THEN '' ELSE text END AS t FROM posts)""")
def previews(spark, sf):
    """200-char preview with ellipsis, the 400-char head, and the 60-char head that names a
    post without text (here every ninth one is shown as one) media-only."""
    p = posts_from_tables(spark, sf)
    t = F.when(F.col("seq") % 9 == 0, F.lit("")).otherwise(F.col("text"))
    return p.select("seq", TX.preview(F.col("text"), 200).alias("preview200"), F.substring("text", 1, 400).alias("preview400"),
                    TX.media_preview(t).alias("preview60"))


# ---------------------------------------------------------------- cleaning
def _clean_sql(x: str) -> str:
    out = x
    for pat in TX.UI_CLEANUP_PATTERNS:
        out = f"regexp_replace({out}, {G.q('(?im)' + pat)}, '', 'g')"
    out = f"regexp_replace({out}, '\\n{{2,}}', chr(10), 'g')"
    out = f"regexp_replace({out}, '(?m)^\\s+|\\s+$', '', 'g')"
    return G.strip(out)


CLEAN_CTE = POSTS + f", c AS (SELECT seq, author, url, {_clean_sql('text')} AS text FROM posts)"


@register("clean_text", CLEAN_CTE + "\nSELECT seq, text FROM c")
def clean_text(spark, sf):
    """Ordered removal of interface noise, then whitespace normalisation."""
    p = posts_from_tables(spark, sf)
    return p.select("seq", TX.clean_text(F.col("text")).alias("text"))


@register("media_flags", CLEAN_CTE + """
SELECT seq, contains(lower(text), 'shared a video') OR contains(lower(text), 'شارك فيديو') AS is_video,
  contains(lower(text), 'shared a post') OR contains(lower(text), 'شارك منشور') AS is_share FROM c""")
def media_flags(spark, sf):
    """C11: video / share flags from the cleaned text."""
    p = posts_from_tables(spark, sf).select("seq", TX.clean_text(F.col("text")).alias("text"))
    v, s = TX.media_flags(F.col("text"))
    return p.select("seq", v.alias("is_video"), s.alias("is_share"))


_BAD = " OR ".join(f"contains(lower(fl), {G.q(w)})" for w in TX.AUTHOR_FIRST_LINE_BAD_WORDS)
GUESS_CTE = CLEAN_CTE + f""", g0 AS (SELECT *, {G.strip("split_part(text, chr(10), 1)")} AS fl FROM c),
g AS (SELECT seq, author, url, text, CASE WHEN length(fl) > 2 AND length(fl) < 60 AND NOT ({_BAD})
  AND NOT regexp_matches(fl, '^[0-9٠-٩]+$') THEN fl ELSE '' END AS guess FROM g0)"""


@register("author_guess", GUESS_CTE + "\nSELECT seq, guess FROM g")
def author_guess(spark, sf):
    """First line as a tentative author name."""
    p = posts_from_tables(spark, sf).select("seq", TX.clean_text(F.col("text")).alias("text"))
    return p.select("seq", TX.author_guess(F.col("text")).alias("guess"))


@register("strip_author_prefix", GUESS_CTE + f"""
, a AS (SELECT seq, CASE WHEN author <> '' THEN author ELSE guess END AS author, text FROM g)
SELECT seq, author, CASE WHEN length(author) > 0 AND starts_with(text, author || chr(10))
  THEN {G.strip('substr(text, length(author) + 1)')} ELSE text END AS text FROM a""")
def strip_author_prefix(spark, sf):
    """C14: fall back to the guessed author; strip ``author + newline`` from the text start."""
    p = posts_from_tables(spark, sf).select("seq", "author", TX.clean_text(F.col("text")).alias("text"))
    p = p.withColumn("author", F.when(F.col("author") != "", F.col("author")).otherwise(TX.author_guess(F.col("text"))))
    return p.select("seq", "author", TX.strip_author_prefix(F.col("text"), F.col("author")).alias("text"))


@register("content_filter", POSTS + f"""
, l AS (SELECT seq, url, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM posts)
SELECT seq, pos FROM l WHERE NOT (length({G.strip('line')}) < 5 AND url = '')""")
def content_filter(spark, sf):
    """Drop posts with (almost) no text and no media/url; every line stands as a post here."""
    p = posts_from_tables(spark, sf).select("seq", "url", "images", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return p.filter(TX.content_ok(F.col("line"), F.col("images"), F.col("url"))).select("seq", F.col("pos").cast("long").alias("pos"))


@register("strip_bidi", POSTS + """
SELECT seq, regexp_replace(split_part(text, chr(10), 1), '^[‎‏‪‫‬‭‮​﻿]+|[‎‏‪‫‬‭‮​﻿]+$', '', 'g') AS first_line FROM posts""")
def strip_bidi(spark, sf):
    """Bidi / zero-width marks removed at line ends."""
    p = posts_from_tables(spark, sf)
    return p.select("seq", TX.strip_bidi(TX.first_line(F.col("text"))).alias("first_line"))
