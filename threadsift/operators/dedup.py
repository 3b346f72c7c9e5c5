"""De-duplication and identity operators.

Keep-first is an aggregation of fixed width, not a window: ``groupBy(key)`` with
``min(order)`` is a hash aggregation whose partial step runs inside every map task,
so a key shared by a third of all rows (a viral text, a blank URL) is one row per
task before the shuffle.  Only when the other columns are wanted are the kept rows
fetched, by a semi join on key and order value; long texts never pass through a sort
of the aggregation.  An order value may repeat, within a key too: one row of a key stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadsift.functions.identity import dedup_key, post_id_from_url
from threadsift.functions.text import py_strip


def first_order(df: DataFrame, key: Column, order: str = "seq", out: str = "__key") -> DataFrame:
    """(out, order): the smallest ``order`` of every key; NULL keys are one group, as in a Python set."""
    return df.select(key.alias(out), F.col(order)).groupBy(out).agg(F.min(order).alias(order))


def keep_first(df: DataFrame, key: Column | str, order: str = "seq", null_key: bool = True, unique: bool = False) -> DataFrame:
    """First row (smallest ``order``, a value or a struct of values) per ``key``; of rows that tie in both, one.

    A NULL key is a key like any other, or with ``null_key=False`` leaves its rows out.  Rows without an
    order value come after all others of their key.  ``unique`` says that no two rows share an order
    value, as with a total input order: then no tie has to be looked for among the kept rows.
    """
    k = F.col(key) if isinstance(key, str) else key
    # never NULL: no filter is derived from it, which would compute a costly key once more
    rows = df.withColumn("__key", F.coalesce(F.concat(F.lit("k"), k.cast("string")), F.lit("")))
    first = rows.groupBy("__key").agg(F.min(order).alias("__order"), F.max((F.col("__key") != "").cast("int")).alias("__some"))
    if not null_key:
        first = first.filter("__some = 1")
    left, right = rows.alias("l"), first.alias("r")
    on = (F.col("l.__key") == F.col("r.__key")) & F.col(f"l.{order}").eqNullSafe(F.col("r.__order"))
    kept = left.join(right, on, "left_semi")
    return (kept if unique else kept.dropDuplicates(["__key", order])).select(*df.columns)


def text_key(text: str = "text") -> Column:
    """SHA-256 of the stripped text; NULL for an empty one."""
    t = py_strip(F.coalesce(F.col(text), F.lit("")))
    return F.when(t != "", F.sha2(t, 256))


def distinct_text_first(df: DataFrame, text: str = "text", order: str = "seq", unique: bool = False) -> DataFrame:
    """Unique posts by stripped text, first in input order; empty texts dropped.

    The grouping key is the SHA-256 of the stripped text (32 bytes) rather than the
    text itself; a collision has probability ~2^-128 even at trillions of posts.
    """
    return keep_first(df, text_key(text), order, null_key=False, unique=unique)


def distinct_key_first(df: DataFrame, order: str = "seq", unique: bool = False) -> DataFrame:
    """Unique posts by dedup key (URL, else a hash of the text), first wins."""
    return keep_first(df, dedup_key(F.col("url"), F.col("text")), order, unique=unique)


def not_seen(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Drop incoming posts whose dedup key is already stored (anti join on the key).

    Only the stored *keys* are shuffled (``select`` + ``distinct``), never the stored rows.
    """
    seen = stored.select(dedup_key(F.col("url"), F.col("text")).alias("__k")).distinct()
    return (incoming.withColumn("__k", dedup_key(F.col("url"), F.col("text")))
            .join(seen, "__k", "left_anti").drop("__k"))


def not_seen_ids(units: DataFrame, stored: DataFrame, id_col: str = "post_id") -> DataFrame:
    """Cheap pre-dedup by numeric post id, placed before any costly extraction."""
    ids = stored.select(post_id_from_url(F.col("url")).alias("__k")).filter("__k is not null").distinct()
    # a unit without id meets nothing: a value of its own keeps such units off one partition
    own = F.concat(F.lit("-"), F.monotonically_increasing_id().cast("string"))
    return units.withColumn("__k", F.coalesce(F.col(id_col), own)).join(ids, "__k", "left_anti").drop("__k")


def running_index(df: DataFrame, order: str = "seq", out: str = "index") -> DataFrame:
    """0-based running index in input order, without a single-partition window.

    Rows are range-partitioned and sorted by ``order``; ``monotonically_increasing_id``
    then encodes (partition, position).  The result is checkpointed (to the shared
    ``spark.checkpoint.dir``) so the per-partition counts and the rows come from
    one materialisation; the counts table has one row per partition, so its
    broadcast is bounded by the partition count, not by the data.
    """
    r = (df.repartitionByRange(order).sortWithinPartitions(order)
         .withColumn("__m", F.monotonically_increasing_id()).checkpoint())
    r = r.withColumn("__p", F.shiftright("__m", 33)).withColumn("__i", F.col("__m") - F.shiftleft(F.col("__p"), 33))
    counts = r.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    offs = counts.select("__p", F.sum("__n").over(
        Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)).alias("__off"))
    return (r.join(F.broadcast(offs), "__p")
            .withColumn(out, (F.coalesce(F.col("__off"), F.lit(0)) + F.col("__i")).cast("long"))
            .drop("__m", "__p", "__i", "__off"))


def pseudonymize(df: DataFrame, col: str = "author", salt: str = "") -> DataFrame:
    """Replace a person's name by ``sha2(salt || name, 256)``: profiles need a key, not the name."""
    return df.withColumn(col, F.when(F.col(col).isNotNull(), F.sha2(F.concat(F.lit(salt), F.col(col)), 256)))
