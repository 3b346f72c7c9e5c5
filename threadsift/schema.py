"""Explicit schemas. Inputs are never schema-inferred."""

from pyspark.sql import types as T

# One post record as written by the ingest job (JSON lines) and read by the analysers.
POST_FIELDS = [
    T.StructField("index", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("likes", T.StringType()),
    T.StructField("comments", T.StringType()),
    T.StructField("shares", T.StringType()),
    T.StructField("images", T.ArrayType(T.StringType())),
    T.StructField("is_video", T.BooleanType()),
    T.StructField("is_share", T.BooleanType()),
]
POST = T.StructType(POST_FIELDS)
POST_WITH_CORRUPT = T.StructType(POST_FIELDS + [T.StructField("_corrupt_record", T.StringType())])

# Batched file: one JSON object per file holding an array of posts.
WRAPPER = T.StructType([
    T.StructField("posts", T.ArrayType(POST)),
    T.StructField("_corrupt_record", T.StringType()),
])

PAGE = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])

UNIT = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("unit_pos", T.IntegerType()),
    T.StructField("kind", T.StringType()),
    T.StructField("html", T.StringType()),
])

# Defaults used when a field is missing (NULL after a schema'd read).
# Two consumers default differently; pick with ``defaults_for``.
DEFAULTS_PAIN = {"text": "", "likes": "0", "comments": "0", "shares": "0", "timestamp": "", "url": ""}
DEFAULTS_PROFILE = {"text": "", "author": "Unknown", "likes": "", "comments": "", "timestamp": ""}
DEFAULTS_QUALITY = {"text": "", "author": "", "url": "", "likes": "", "comments": ""}
