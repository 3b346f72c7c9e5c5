"""The join plan of tagging with very many keywords: rarest pieces, one join of each text."""

import random

from pyspark.sql import functions as F

from threadsift.lexicons import Lexicon
from threadsift.operators import tagging as TG


def test_ten_thousand_keywords_equal_containment(spark):
    rnd = random.Random(4)
    parts = ["the", "ing", "ra", "qu", "zo", "mek", "lo", "xi", "ü", "عرض", " "]
    words = sorted({"".join(rnd.choice(parts) for _ in range(rnd.randrange(2, 7))).strip() for _ in range(16_000)} - {""})[:10_000]
    assert len(words) > 9_000
    lex = Lexicon.of("many", {f"c{i}": words[i::40] for i in range(40)})
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(0, 120))) for _ in range(60)] + ["", None, "th", "The THE the"]
    df = spark.createDataFrame(list(enumerate(texts)), "seq long, text string")
    got = {r["seq"]: r["tags"] for r in TG.tag_join(df, lex).collect()}
    want = {i: [c for c in lex.categories if any(k in (t or "").lower() for k in lex.keywords(c))] for i, t in enumerate(texts)}
    assert got == want and sum(map(len, want.values())) > 500


def test_rarest_piece(spark):
    df = spark.createDataFrame([("the thing",), ("the zone",), ("the other",), ("thexyz",)], "low string")
    assert TG.piece_counts(df, "low", ["the", "xyz", "zzz"]) == {"the": 4, "xyz": 1, "zzz": 0}
    assert TG.rarest_pieces(["thexyz", "the", "athe"], df, "low") == {"thexyz": "hex", "the": "the", "athe": "ath"}
    assert TG.piece_counts(df.filter(F.lit(False)), "low", ["the"]) == {"the": 0}


def test_a_text_is_joined_once(spark):
    df = spark.createDataFrame([(1, "abcdef")], "seq long, text string")
    plan = TG.tag_join(df, Lexicon.of("two", {"a": ["abc", "bcd"], "b": ["cdef"]}))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list") == 2 and "CartesianProduct" not in plan
