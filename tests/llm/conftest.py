import pytest


@pytest.fixture()
def make(spark):
    """documents from (doc_id, text, lang, source) rows, with extra columns whose names clash with the operators' own."""
    def build(rows, extra=False):
        df = spark.createDataFrame([(i, t, la, s, len(t) if t is not None else None) for i, t, la, s in rows],
                                   "doc_id long, text string, lang string, source string, n_chars long")
        if extra:
            from pyspark.sql import functions as F
            for c in ("id", "key", "size", "score", "kept", "digest", "before", "place", "pid", "secrets", "pii", "target"):
                df = df.withColumn(c, F.lit("x"))
        return df
    return build


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
#: null and empty texts, blank ones, ties and repeated rows, null columns, a long text without spaces
EDGES = [(1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, None), (4, "one", "en", "b"), (5, "same text here", "en", "b"),
         (5, "same text here", "en", "b"), (6, "same text here", "de", None), (None, "no id at all", "en", "a"), (7, "x" * 120_000, "en", "c"),
         (8, " ".join(WORDS[i % 20] for i in range(30_000)), "en", "c"), (9, "é日😀 　 ’ end", "fr", "a")]
