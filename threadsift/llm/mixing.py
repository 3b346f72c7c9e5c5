"""Mixing sources to target weights (operator 6).

Sources take their weights in code-point order (null last) and share ``factor`` times all words;
a target stops at ``cap`` times its source's size and the excess is reshared by weight.  That is
``min(level * weight, cap * size)`` for one water level, found from two distributed running sums
over the source table.  Documents get hash-random keys, are range-sorted within their source, and
a distributed prefix sum of their word counts cuts each source at its exact budget: whole epochs
first, then the documents in key order until the rest is used up (the last one in part).

A hot source spreads over as many range partitions as it needs; only one total per partition and
source meets in the offsets.

Defined cases: a null text has 0 words; rows that tie in key, doc_id, size and text are alike and
share their places in either order; a source without words has target 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsift.llm.order import running_sum
from threadsift.llm.text import WORD, written

WEIGHTS = (3, 1, 2)
FACTOR, CAP = 1.5, 2
SEED = "mix:"


def targets(sizes: DataFrame, weights=WEIGHTS, factor: float = FACTOR, cap: int = CAP) -> DataFrame:
    """(source, source_size, target) from rows (source, size)."""
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by = running_sum(by, [F.col("source").asc_nulls_last()], F.lit(1), "place")
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    by = by.select("source", "source_size", w.cast("long").alias("w")).withColumn("most", F.col("source_size") * cap)
    by = by.withColumn("ratio", F.col("most").cast("double") / F.col("w"))
    order = [F.col("ratio"), F.col("source").asc_nulls_last()]
    by = written(running_sum(running_sum(by, order, F.col("most"), "below"), order, F.col("w"), "w_below"), "sources")
    total = by.agg(F.sum("source_size").alias("s"), F.sum("w").alias("ws"))
    level = (F.lit(factor) * F.col("s") - F.col("below")) / (F.col("ws") - F.col("w_below"))
    # the total and the level are one row each
    lev = (by.join(F.broadcast(total)).withColumn("level", level).filter("level <= ratio").agg(F.max("level").alias("level")))
    return (by.join(F.broadcast(lev)).select("source", "source_size",
            F.least(F.coalesce("level", F.lit(0.0)) * F.col("w"), F.col("most").cast("double")).alias("target")))


def _keyed(docs: DataFrame) -> DataFrame:
    """The columns that order a source's documents: doc_id, source, size, key and tie."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").alias("doc_id"), F.col("source").alias("source"),
                       F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
                       F.md5(F.concat(F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))).alias("key"),
                       F.md5(text).alias("tie"), *[c for c in docs.columns if c.startswith("k_")])


def _placed(d: DataFrame, more: list[str], weights=WEIGHTS, factor: float = FACTOR, cap: int = CAP) -> DataFrame:
    """d with source_size, target, before (words of the source before the row), epochs (whole ones)
    and rest (words of the target beyond them)."""
    order = [F.col("source").asc_nulls_last(), *[F.col(c) for c in ("key", "doc_id", "size", "tie", *more)]]
    d = written(running_sum(d, order, F.col("size"), "before", ["source"]), "keyed")
    t = targets(d.select("source", "size"), weights, factor, cap).withColumnRenamed("source", "s")
    d = d.join(t, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    d = d.withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(F.lit(0)))
    return d.withColumn("rest", F.floor("target") - F.col("epochs") * F.col("source_size"))


def mix(docs: DataFrame, keep: list[str], **how) -> DataFrame:
    """``keep`` columns, size, source_size, target, taken: one row per row of ``docs``.  Options:
    ``weights``, ``factor`` and ``cap``."""
    d = _placed(_keyed(docs.select("doc_id", "source", "text", *[F.col(c).alias(f"k_{c}") for c in keep])), [], **how)
    taken = F.col("epochs") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))
    return d.select(*[F.col(f"k_{c}").alias(c) for c in keep], "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The documents of the mix, with the columns of ``docs``: a row per epoch, in whole, but for
    the one document of a source at which its budget ends, whose text stops at that word.

    Only the place where a source's budget ends (one row per source) is joined to the documents,
    which compare their own order with it: texts are neither written nor shuffled, unless there are
    so many sources that Spark must sort the join.  Alike rows (same doc_id and text) are told
    apart by their place in the scan.
    """
    cols = docs.columns
    rid = F.monotonically_increasing_id().alias("k_rid")
    d = _placed(_keyed(docs.select("doc_id", "source", "text", rid)), ["k_rid"], **how)
    end = d.filter("before <= rest AND rest < before + size")
    place = F.struct("key", "doc_id", "size", "tie", "k_rid")
    cuts = written(end.select(F.col("source").alias("s"), "epochs", place.alias("end"), (F.col("rest") - F.col("before")).alias("words")), "cuts")
    wide = _keyed(docs.select(*[F.col(c).alias(f"k_{c}") for c in cols], "doc_id", "source", "text", F.monotonically_increasing_id().alias("k_rid")))
    d = wide.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left")
    extra = F.when(place < F.col("end"), F.col("size")).when(place == F.col("end"), F.col("words")).otherwise(F.lit(0))
    d = d.withColumn("taken", F.coalesce("epochs", F.lit(0)) * F.col("size") + extra).filter("taken > 0")
    d = d.withColumn("epoch", F.explode(F.expr("sequence(0L, (taken - 1) div size)")))
    words = F.least(F.col("size"), F.col("taken") - F.col("epoch") * F.col("size"))
    part = F.array_join(F.slice(F.regexp_extract_all("k_text", F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0)), F.lit(1), words.cast("int")), "")
    d = d.withColumn("k_text", F.when(words < F.col("size"), part).otherwise(F.col("k_text")))
    if "n_chars" in cols:
        d = d.withColumn("k_n_chars", F.when(words < F.col("size"), F.length("k_text")).otherwise(F.col("k_n_chars")))
    return d.select(*[F.col(f"k_{c}").cast(docs.schema[c].dataType).alias(c) for c in cols])


ORACLE = f"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
  md5('{SEED}' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key, md5(coalesce(text, '')) AS tie FROM documents),
k AS (SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id NULLS FIRST, size, tie ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [3, 1, 2][1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER)] AS w FROM d GROUP BY source),
r AS (SELECT *, {CAP} * source_size AS most, CAST({CAP} * source_size AS DOUBLE) / w AS ratio FROM s),
a AS (SELECT *, coalesce(sum(most) OVER o, 0) AS below, coalesce(sum(w) OVER o, 0) AS w_below FROM r WINDOW o AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT max(v) AS level FROM (SELECT ratio, CAST({FACTOR}::DOUBLE * (SELECT sum(source_size) FROM s)::DOUBLE - below::DOUBLE AS DOUBLE) / CAST((SELECT sum(w) FROM s) - w_below AS DOUBLE) AS v FROM a) WHERE v <= ratio),
t AS (SELECT source, source_size, least(coalesce(level, 0) * w, CAST(most AS DOUBLE)) AS target FROM a, l),
x AS (SELECT k.*, source_size, target, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS f FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(f * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - f * source_size - before)) AS BIGINT) AS taken FROM x"""
