"""DataFrame-level tagging and classification.

Two plans give equal results; the caller chooses:

* **array plan** (``tag``, ``classify``): the lexicon is a literal inside the expression;
  one narrow projection, no shuffle.
* **join plan** (``tag_join``, ``classify_join``): the lexicon is a table, met by an equi-join on
  the three-character piece of each keyword that is rarest in the corpus; no limit on the keywords, no cross join.
  For lexicons of very many keywords.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsift.functions import lexicon as LX
from threadsift.functions.keywords import held
from threadsift.lexicons import Lexicon

PIECE = 3
SKETCH_ERROR = 0.0001  # of all pieces counted


def tag(df: DataFrame, lex: Lexicon, text: str = "text", out: str = "tags", low: str | None = None) -> DataFrame:
    if low:
        return df.withColumn(out, LX.tags(text, lex, low))
    return df.withColumn("__low", F.lower(F.col(text))).withColumn(out, LX.tags(text, lex, "__low")).drop("__low")


def classify(df: DataFrame, lex: Lexicon, text: str = "text", out: str = "label", low: str | None = None,
             score_col: str | None = None) -> DataFrame:
    """D3: best label column ``out`` (and optionally its hit count)."""
    return classify_many(df, {out: lex}, text, low, {out: score_col} if score_col else None)


def classify_many(df: DataFrame, lexicons: dict[str, Lexicon], text: str = "text", low: str | None = None,
                  score_cols: dict[str, str] | None = None, found: str | None = None) -> DataFrame:
    """Several best-label columns in one pass.  ``found`` names a column of ``LX.found_words`` of all their words.

    The per-dimension ``best`` structs are their own projection (each read
    twice below), so Catalyst keeps them as one evaluated value instead of
    duplicating hundreds of keyword tests into every branch.
    """
    if not low:
        df, low = df.withColumn("__low", F.lower(F.col(text))), "__low"
    tmp = {f"__best_{o}": LX.best_struct(low, lx, found) for o, lx in lexicons.items()}
    r = df.withColumns(tmp)
    outs = {o: LX.label_of(F.col(f"__best_{o}"), F.col(text), lx) for o, lx in lexicons.items()}
    for o, sc in (score_cols or {}).items():
        outs[sc] = LX.score_of(F.col(f"__best_{o}"), F.col(text))
    return r.withColumns(outs).drop(*tmp, "__low")


def keep_tagged(df: DataFrame, col: str = "tags") -> DataFrame:
    """Keep posts with at least one tag."""
    return df.filter(F.size(col) > 0)


def piece_counts(texts: DataFrame, low: str, pieces: list[str]) -> dict[str, int]:
    """About how many texts hold each of ``pieces``, from one count-min sketch over the pieces asked for in all texts:
    some hundred kB, whatever the corpus and however many pieces there are.  Counts are never too low."""
    row = (texts.select(held(F.col(low), pieces).alias("p")).select(F.explode("p").alias("p"))
           .agg(F.count_min_sketch(F.col("p"), F.lit(SKETCH_ERROR), F.lit(0.99), F.lit(7)).alias("s")).first())
    if row is None or row["s"] is None:
        return dict.fromkeys(pieces, 0)
    sketch = texts.sparkSession._jvm.org.apache.spark.util.sketch.CountMinSketch.readFrom(bytes(row["s"]))
    return {p: sketch.estimateCount(bytearray(p.encode())) for p in pieces}


def rarest_pieces(keywords: list[str], texts: DataFrame, low: str) -> dict[str, str]:
    """keyword -> the piece of it that the fewest texts hold (ties: the first); keywords of PIECE characters at least."""
    of = {k: [k[i:i + PIECE] for i in range(len(k) - PIECE + 1)] for k in keywords}
    n = piece_counts(texts, low, sorted({p for ps in of.values() for p in ps}))
    return {k: min(ps, key=n.__getitem__) for k, ps in of.items()}


def _matches(df: DataFrame, row: str, text: str, lex: Lexicon) -> DataFrame:
    """(row, category, cat_rank, kw_rank): a row for each keyword that a text holds.

    A keyword stands in a text only if each of its pieces does, so both sides meet on the piece that is
    rarest in the corpus.  The candidates of a text are gathered (at most one a keyword) before the text
    joins them, once, and are tested in one expression.  Shorter keywords and regular expressions are
    tested as literals of one expression.
    """
    spark = df.sparkSession
    p = df.select(F.col(row).alias("_k"), F.coalesce(F.col(text), F.lit("")).alias("_t"), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("_low"))
    rows = lex.to_rows()
    literal = [r for r in rows if lex.is_regex or len(r[4]) < PIECE]
    out = []
    if len(literal) < len(rows):
        keyed = [(r[1], r[2], r[3], r[4]) for r in rows if len(r[4]) >= PIECE]
        rare = rarest_pieces(sorted({r[3] for r in keyed}), p, "_low")
        lt = spark.createDataFrame([(rare[r[3]], *r) for r in keyed], "_p string, category string, cat_rank int, kw_rank int, keyword string")
        near = (p.select("_k", held(F.col("_low"), list(rare.values())).alias("_p")).select("_k", F.explode("_p").alias("_p")).join(lt, "_p").groupBy("_k")
                .agg(F.collect_list(F.struct("category", "cat_rank", "kw_rank", "keyword")).alias("c")))
        whole = F.filter("c", lambda x: F.contains(F.col("_low"), x["keyword"]))
        out.append(near.join(p.select("_k", "_low"), "_k").select("_k", F.inline(whole)).select("_k", "category", "cat_rank", "kw_rank"))
    if literal:
        hits = F.array(*[F.when(F.col("_t").rlike("(?iu)" + r[4]) if lex.is_regex else F.col("_low").contains(r[4]),
                                F.struct(F.lit(r[1]).alias("category"), F.lit(r[2]).alias("cat_rank"), F.lit(r[3]).alias("kw_rank"))) for r in literal])
        out.append(p.select("_k", F.inline(F.filter(hits, lambda h: h.isNotNull()))))
    return out[0] if len(out) == 1 else out[0].unionByName(out[1])


def _joined(df: DataFrame, row: str, found: DataFrame) -> DataFrame:
    return df.join(found.withColumnRenamed("_k", row), row, "left")


def tag_join(df: DataFrame, lex: Lexicon, key: str = "seq", text: str = "text", out: str = "tags") -> DataFrame:
    """Join plan of ``tag``: ordered distinct categories per post.  ``key`` tells the rows apart."""
    m = (_matches(df, key, text, lex).groupBy("_k", "category").agg(F.min("cat_rank").alias("r"))
         .groupBy("_k").agg(F.array_sort(F.collect_list(F.struct("r", "category"))).alias("_s"))
         .select("_k", F.transform("_s", lambda x: x["category"]).alias(out)))
    return _joined(df, key, m).withColumn(out, F.coalesce(F.col(out), F.array().cast("array<string>")))


def classify_join(df: DataFrame, lex: Lexicon, key: str = "seq", text: str = "text", out: str = "label") -> DataFrame:
    """Join plan of ``classify``: hits per (post, category), best by (score desc, declared order)."""
    m = (_matches(df, key, text, lex).groupBy("_k", "category", "cat_rank").agg(F.count(F.lit(1)).alias("score"))
         .groupBy("_k").agg(F.max(F.struct("score", (-F.col("cat_rank")).alias("o"), "category")).alias("b"))
         .select("_k", F.col("b.category").alias(out)))
    res = _joined(df, key, m)
    return res if lex.default is None else res.withColumn(out, F.coalesce(F.col(out), F.lit(lex.default)))
