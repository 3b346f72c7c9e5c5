"""Many keywords found in one walk over a text, and regex categories put only to texts that may match."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from threadsift import lexicons as L
from threadsift.functions import lexicon as LX
from threadsift.functions.keywords import Finder, held

PARTS = ["the", "ing", "ra", "qu", "z", "عرض", "ü", " ", "a", "b"]


def words_and_texts():
    rnd = random.Random(1)
    words = sorted({"".join(rnd.choice(PARTS) for _ in range(rnd.randrange(0, 6))) for _ in range(250)})
    texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randrange(0, 100))) for _ in range(300)] + [None, "", "th", None]
    return words, texts


def test_finder_equals_containment():
    words, texts = words_and_texts()
    for a, b in ((0, len(texts)), (37, 211), (290, 304), (5, 5)):
        row, word = Finder(words).pairs(pa.array(texts, pa.string())[a:b])
        got = list(zip(row.tolist(), word.tolist()))
        want = {(i, j) for i, t in enumerate(texts[a:b]) if t is not None for j, w in enumerate(words) if w in t}
        assert set(got) == want and len(got) == len(want)


def test_held_words(spark):
    df = spark.createDataFrame([(0, "one two"), (1, ""), (2, None), (3, "twotwo")], "i long, low string")
    r = df.select("i", held(F.col("low"), ["two", "one"]).alias("h")).orderBy("i").collect()
    assert [sorted(x.h) if x.h is not None else None for x in r] == [["one", "two"], [], None, ["two"]]


def test_regex_categories_equal_the_pattern(spark):
    """Also where case folding is more than lower-casing, and for patterns that no fixed word stands for."""
    lex = L.Lexicon.of("rx", {"plain": ["(?:kiss|stripe)"], "gap": ["co.?founder", r"x\d+ egp"], "class": ["[ab&]it"], "none": [r"\d{3}|^$"],
                              "accent": ["ción"], "java": ["\\Qa.b\\E", "p[q&&[q]]r"], "ends": ["fine$", r"\bicy\b"]}, is_regex=True)
    texts = ["KISS", "Kiss", "kıss", "kisſ", "KİSS", "ſtripe", "CoFounder", "co-founder", "cofoıunder", "X12 EGP", "x egp", "Bit", "bıt", "12", "123",
             "CIÓN", "cion", "a.b", "acb", "pqr", "", None, "FINE", "fine.", "an icy way", "spicy", "İcy"]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    want = F.array_compact(F.array(*[F.when(F.col("text").rlike(LX.regex_alternation(lex.keywords(c))), F.lit(c)) for c in lex.categories]))
    for r in df.select("text", LX.tags("text", lex).alias("got"), want.alias("want")).collect():
        assert r.got == r.want, r
    assert df.select(F.explode(LX.tags("text", lex)).alias("t")).distinct().count() == len(lex.categories)


def test_patterns_are_run_on_few_texts():
    sure, maybe = LX.needed(tuple(L.pain_lexicon().keywords("Finding Technical Talent")))
    assert "developer" in sure and "cto" in sure and {"founder", "software"} <= set(maybe)
    assert LX.needed((r"(?i)x",)) == ([], None) and LX.needed(("a?b*",)) == ([], None)
    assert all(LX.needed(tuple(L.pain_lexicon().keywords(c)))[1] is not None for c in L.pain_lexicon().categories)


WORDS = ["store", "online store", "stores", "tor", "ai", "a", "متجر", "تجر", "متجر الكتروني", "c++", "[x]", "\\d+ egp", "ß", "😀b", "x" * 70, "x" * 64 + "y", "", "two\nlines"]


def test_found_words_are_those_that_contains_finds(spark):
    """One pass lists the words of a text: overlapping, one within the other, of signs, beyond the length that the pattern reads."""
    texts = [" ".join(WORDS), "online stores", "on line store", "storestor", "متجر الكترون", "c+", "[x", "12 egp \\d+ egp", "x" * 200, "x" * 66 + "y",
             "a\nb\nstore", "two lines", "two\nlines", "😀", "a😀b", "", None, "qqq"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, low string").withColumn("f", LX.found_words("low", WORDS))
    got = df.select("low", "f", *[F.expr(LX.has_sql("`low`", w, "`f`")).alias(f"w{k}") for k, w in enumerate(WORDS)]).collect()
    for r in got:
        assert [r[f"w{k}"] for k in range(len(WORDS))] == [None if r.low is None else w in r.low for w in WORDS], r.low
    # what is asked further is no longer than the words that stand in the text, however long that is
    assert max(len(r.f) for r in got if r.low and r.low not in (texts[0],)) < 200
    many = [a + b + c for a in "abcdefgh" for b in "ijklmnop" for c in "qrstuvwx"]
    row = spark.createDataFrame([("aiq bjr hpx" + "z" * 1000,)], "low string").select(LX.found_words("low", many).alias("f"), LX.found_words("low", []).alias("none")).first()
    assert row.f.split(LX.MARK) == ["", "aiq", "bjr", "hpx"] and row.none == LX.MARK


def test_labels_of_posts_read_the_text_once(spark):
    """The keywords of all lexicons are looked for in the listed words, not one by one in the text."""
    from threadsift.plans import demographics as DM
    words = sorted(LX.asked_words(*DM.DIMENSIONS.values(), DM.BUDGET, DM.PAINS, DM.TOOLS))
    rows = [(i, f"{a} {i}{b}{c.upper()}", "u", "1", "2") for i, (a, b, c) in enumerate(zip(words, words[7:] + words[:7], words[100:] + words[:100]))]
    posts = spark.createDataFrame(rows + [(9000, "", "u", "", ""), (9001, None, None, None, None)], "seq long, text string, author string, likes string, comments string").withColumn("timestamp", F.lit(""))
    got = DM.label_posts(posts)
    low = posts.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("low", F.lower("text"))
    want = low.select("seq", *[LX.label_of(LX.best_struct("low", x), "text", x).alias(c) for c, x in DM.DIMENSIONS.items()],
                      LX.tags("text", DM.PAINS, "low").alias("pain_points"), LX.tags("text", DM.TOOLS, "low").alias("tool_preferences"))
    assert {r.seq: r for r in got.select(want.columns).collect()} == {r.seq: r for r in want.collect()}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and "Contains(_low" not in plan and "contains(_low" not in plan.lower()
