"""The outline of a markup against a plain walk over its tags with a stack for each name."""

import random
import re

from pyspark.sql import functions as F

from threadsift.functions import html as H
from threadsift.plans import pages as PG
from threadsift.sources.readers import page_units


def walk(html):
    """(pos, name, depth, inner markup, whole element) of every element; names by themselves, closing tags without an opening one lower the depth."""
    out, stacks, depth = [], {}, {}
    for m in re.finditer(r"(?is)<(/?)(div|span|a|h2|h3)\b[^>]*>", html):
        name = m[2].lower()
        d = depth.get(name, 0)
        if m[1]:
            depth[name] = d - 1
            if stacks.get(name):
                pos, level, start = stacks[name].pop()
                out.append((pos, name, level, html[start:m.start()], html[pos:m.end()]))
        else:
            depth[name] = d + 1
            stacks.setdefault(name, []).append((m.start(), d + 1, m.end()))
    out += [(pos, name, level, html[start:], html[pos:]) for name, st in stacks.items() for pos, level, start in st]
    return sorted(out)


def markups(n=60):
    rnd = random.Random(7)
    bits = ["<div>", "</div>", '<div role="article">', "<DIV dir=\"auto\">", "</DIV>", "<span>", "</span>", "<a href='x'>", "</a>", "<h2>", "</h2>", "<h3 x>", "</h3>",
            "text", "é\U0001f600", "<br>", "<abbr>", "\n", "<", ""]
    return ["", "plain", "<div>" * 70 + "x" + "</div>" * 40, "</div>" * 3 + "<div>a</div>" + "</span>", *("".join(rnd.choices(bits, k=rnd.randrange(150))) for _ in range(n))]


def test_outline_equals_a_walk_with_stacks(spark):
    docs = markups()
    df = spark.createDataFrame(list(enumerate(docs)), "page_id long, html string")
    got = df.select("page_id", F.expr(H.outline("html")).alias("o"), F.expr(H.elements("html", "div", H.ARTICLE)).alias("e"), F.expr(H.own_markup()).alias("own")).collect()
    assert len(got) == len(docs)
    for r in got:
        h = docs[r["page_id"]]
        want = walk(h)
        assert [(x["pos"], x["n"], x["d"], h[x["s"]:x["e"]], h[x["pos"]:x["f"]]) for x in r["o"]] == want
        arts = [w for w in want if w[1] == "div" and h.startswith('<div role="article">', w[0])]
        assert [(x["pos"], x["html"]) for x in r["e"]] == [(w[0], w[3]) for w in arts]
        gone = {p for w in arts for p in range(w[0], w[0] + len(w[4]))}
        assert r["own"] == "".join(c for p, c in enumerate(h) if p not in gone)


def test_null_markup_has_no_units(spark):
    df = spark.createDataFrame([(1, None), (2, "")], "page_id long, html string")
    assert page_units(df).count() == 0
    assert df.select(F.expr(H.own_markup())).collect()[1][0] == ""


def test_extractions_of_a_unit_share_one_outline(spark):
    df = spark.createDataFrame([(1, "feed", 0, "<div>x</div>")], "page_id long, kind string, unit_pos int, html string")
    plan = PG.posts_from_units(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("</?(?:div|span|a|h2|h3)") <= 4  # tags and gaps, of the unit and of its own part
