"""Identity column builders: dedup key (C16), numeric post id (C15), group id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadsift.functions.text import col_, py_strip

# The default group id used when the group URL carries none, and the
# patterns of post and group ids.
DEFAULT_GROUP_ID = "1664454230462828"
POST_ID, STORY_ID, GROUP_ID = r"/posts/([0-9]+)", r"story_fbid=([0-9]+)", r"/groups/([0-9]+)"


def dedup_key(url, text) -> Column:
    """Stripped URL when present, else the SHA-256 of the whole stripped text (a prefix would
    make one of different posts that begin alike)."""
    u = py_strip(F.coalesce(col_(url), F.lit("")))
    t = F.coalesce(col_(text), F.lit(""))
    return F.when(u != "", u).otherwise(F.sha2(py_strip(t), 256))


def canonical_url(url) -> Column:
    """Optional canonical key: drop query string and fragment (tracking parameters)."""
    return F.regexp_replace(py_strip(F.coalesce(col_(url), F.lit(""))), r"[?#].*$", "")


def post_id_from_url(url) -> Column:
    """``/posts/(\\d+)`` else ``story_fbid=(\\d+)``; NULL when neither."""
    u = F.coalesce(col_(url), F.lit(""))
    a = F.regexp_extract(u, POST_ID, 1)
    b = F.regexp_extract(u, STORY_ID, 1)
    return F.coalesce(F.nullif(a, F.lit("")), F.nullif(b, F.lit("")))


def group_id_from_url(url, default: str = DEFAULT_GROUP_ID) -> Column:
    """``/groups/(\\d+)`` with a default."""
    g = F.regexp_extract(F.coalesce(col_(url), F.lit("")), GROUP_ID, 1)
    return F.coalesce(F.nullif(g, F.lit("")), F.lit(default))
