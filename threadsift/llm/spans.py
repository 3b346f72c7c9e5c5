"""Spans of regular expressions as DataFrame expressions (no Python on the executors).

Every leftmost non-overlapping match gets its code-point offsets: the text is split at the pattern
and the matches are extracted; running sums of both lengths are the offsets.  The running sums go
by blocks of ``STEP``, so that a text with very many matches stays cheap.  Each step is a
projection of its own: Catalyst keeps them apart since later steps use the columns repeatedly, and
so no regular expression runs twice.

Patterns are written with possessive parts and look-behinds where a greedy search would try every
position of a long run again; they match the same spans as their plain forms.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STEP = 256
CONTEXT = 40
#: a match has two characters at least and a third parts it from the next of its kind, so the context reaches back over so many matches at most
BACK = CONTEXT // 3 + 1


@dataclass(frozen=True)
class Pattern:
    """A kind of span: regular expression (no single quote in it), and a cheap condition on the
    text column ``t`` that holds wherever it can match."""
    kind: str
    regex: str
    guard: str = "true"


def with_matches(df: DataFrame, patterns: list[Pattern], text: str, context: bool = False) -> DataFrame:
    """df with one column ``__<kind>`` per kind: array<struct<s int, e int, m string, c string>> ordered by s.

    s and e are code points (end exclusive), m the match, c the ``CONTEXT`` code points of the text
    before it (fewer at the text's start), earlier matches included; null without ``context``.  It is put together from the
    last pieces, since a substring by offset would count the text from its start for every match.
    With ``context`` a pattern's matches must take three characters each, the gap to the next included.
    """
    kinds = [f"__{p.kind}" for p in patterns]
    df = df.select("*", *[F.expr(f"CASE WHEN {p.guard.replace('{t}', text)} THEN regexp_extract_all({text}, r'{p.regex}', 0) ELSE array() END").alias(f"__{p.kind}__f")
                          for p in patterns])
    df = df.select("*", *[F.expr(f"CASE WHEN size(__{p.kind}__f) > 0 THEN transform(split({text}, r'{p.regex}', -1), x -> struct(length(x) AS n, right(x, {CONTEXT}) AS c)) END").alias(f"__{p.kind}__g")
                          for p in patterns])
    df = df.select("*", *[F.expr(f"transform({k}__f, (m, i) -> {k}__g[i].n + length(m))").alias(f"{k}__d") for k in kinds])
    ends = ("CASE WHEN size({k}__d) = 0 THEN array() ELSE flatten(transform(sequence(0, (size({k}__d) - 1) div {n}), b -> "
            "aggregate(slice({k}__d, b * {n} + 1, {n}), "
            "struct(aggregate(slice({k}__d, 1, b * {n}), 0, (a, x) -> a + x) AS t, CAST(array() AS array<int>) AS o), "
            "(a, x) -> struct(a.t + x AS t, concat(a.o, array(a.t + x)) AS o), a -> a.o))) END")
    df = df.select("*", *[F.expr(ends.format(k=k, n=STEP)).alias(f"{k}__e") for k in kinds])
    before = (f"CASE WHEN i = 0 OR length({{k}}__g[i].c) >= {CONTEXT} THEN {{k}}__g[i].c ELSE right(array_join(transform(sequence(greatest(0, i - {BACK}), i), "
              f"j -> concat({{k}}__g[j].c, CASE WHEN j < i THEN right({{k}}__f[j], {CONTEXT}) ELSE '' END)), ''), {CONTEXT}) END") if context else "CAST(NULL AS STRING)"
    df = df.select("*", *[F.expr(f"transform({k}__f, (m, i) -> struct({k}__e[i] - length(m) AS s, {k}__e[i] AS e, m AS m, {before.format(k=k)} AS c))").alias(k) for k in kinds])
    return df.drop(*[f"{k}__{x}" for k in kinds for x in "fgde"])
