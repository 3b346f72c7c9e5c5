"""Lexicon tagging and classification as column expressions (the "array plan").

A lexicon is a small ordered constant, so matching it is a per-row scalar
expression: no shuffle, no join, no Python.  Keyword tests are ``contains`` on
a lower-cased text column (computed once and reused), regex categories are one
``rlike`` with the category's alternation, run only on texts that hold a word without which it cannot
match and none that settles it.  Where many lexicons ask the same text, one pass of one pattern lists the
words that stand in it (``found_words``) and the tests read that short list.  For very large lexicons the table
form (``operators.tagging.tag_join``) is the alternative plan; both give equal
results (tested).
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import lru_cache, reduce
from itertools import groupby
from os.path import commonprefix
from re import _constants as RC
from re import _parser as RP

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadsift.functions.text import col_
from threadsift.lexicons import BUDGET_AMOUNT_PATTERN, BUDGET_EDGES, BUDGET_RANGES, Lexicon

REGEX_FLAGS = "(?iu)"  # case-insensitive, Unicode case folding (Python re.IGNORECASE on str)


def regex_alternation(patterns: list[str]) -> str:
    return REGEX_FLAGS + "|".join("(?:" + p + ")" for p in patterns)


# Large lexicons are emitted as one Spark SQL expression string per column
# (a single ``F.expr`` call) instead of thousands of py4j ``Column`` calls:
# plan construction stays in milliseconds and Catalyst sees a flat expression.


def sql_lit(s: str) -> str:
    """Spark SQL string literal (backslash escapes are on by default)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(c) -> str:
    if isinstance(c, str):
        return "`" + c.replace("`", "``") + "`"
    raise TypeError("SQL-text lexicon builders take column names")


MARK = "\n"  # stands before each word of ``found_words``
LONGEST = 64  # characters of a word that the pattern reads
FEW = 6  # alternatives tried one by one


def _longest(words: list[str]) -> str:
    """A pattern for the longest of ``words`` (sorted, distinct) that stands at a place.  Words share their beginnings, and
    among many next characters half are ruled out at a time."""
    end = words[0] == ""
    rest = words[1:] if end else words
    if not rest:
        return ""
    size = len(commonprefix(rest))
    if size:
        body = _escape(rest[0][:size]) + _longest([w[size:] for w in rest])
    else:
        body = _either([(c, list(ws)) for c, ws in groupby(rest, lambda w: w[0])])
    return f"(?:{body})?" if end else body


def _either(branches: list[tuple[str, list[str]]]) -> str:
    if len(branches) <= FEW:
        return "(?:" + "|".join(_longest(ws) for _, ws in branches) + ")"
    cut = len(branches) // 2
    return "(?:" + "|".join(f"(?=[{_escape(half[0][0])}-{_escape(half[-1][0])}]){_either(half)}" for half in (branches[:cut], branches[cut:])) + ")"


def _escape(text: str) -> str:
    return "".join(c if c.isalnum() else f"\\x{{{ord(c):x}}}" for c in text)


def found_words(low: str, words: Iterable[str]) -> Column:
    """The ``words`` that stand in the lower-cased column ``low``, by the longest one at each place: each once, with MARK before it.

    A word of ``words`` without MARK stands in the text exactly where MARK and the word stand in this string (of a word of
    more than LONGEST characters its beginning does).  Materialise it as a column of its own."""
    ws = sorted({w[:LONGEST] for w in words if w and MARK not in w})
    if not ws:
        return F.expr(f"IF({_name(low)} IS NULL, NULL, {sql_lit(MARK)})")
    # a lookahead takes no characters, so words that overlap are all found
    found = f"regexp_extract_all({_name(low)}, {sql_lit(f'(?=({_longest(ws)}))')}, 1)"
    return F.expr(f"concat({sql_lit(MARK)}, array_join(array_distinct({found}), {sql_lit(MARK)}))")


def has_sql(low: str, word: str, found: str | None = None) -> str:
    """Whether the text ``low`` contains ``word``; ``found``: its ``found_words`` of words among which this one is."""
    plain = f"contains({low}, {sql_lit(word)})"
    if not found or not word or MARK in word:
        return plain
    listed = f"contains({found}, {sql_lit(MARK + word[:LONGEST])})"
    return listed if len(word) <= LONGEST else f"({listed} AND {plain})"


def hits_sql(low: str, keywords: list[str], found: str | None = None) -> str:
    if not keywords:
        return "0"
    return "(" + " + ".join(f"CAST({has_sql(low, k, found)} AS INT)" for k in keywords) + ")"


def any_sql(low: str, keywords: list[str], found: str | None = None) -> str:
    return "(" + " OR ".join(has_sql(low, k, found) for k in keywords) + ")"


GAP = "\0"  # stands for a part of a pattern that is no fixed text
MANY = 500  # texts of one pattern
#: letters for which lower-casing finds all that (?iu) matches, but for the dotless i, the long s and the dotted capital I
#: (lower-cased: an i and a dot); a text with one of these is always put to the pattern
KNOWN = re.compile("[\\x01-\\x7f\\xe0-\\xf6\\xf8-\\xfe\\u0600-\\u06ff]")
ODD = ["\u0131", "\u017f", "\u0307"]
#: escapes, groups and classes that Java and Python read alike
PLAIN = re.compile(r"(?:[^\\(\[]|\\[sSdDwWb.+*?()\[\]{}|$^/-]|\((?!\?)|\(\?:|\[[^\[\]&\\]+\])*")


def _texts(nodes) -> list[str]:
    """The texts that a parsed pattern can match, with GAP for what is not fixed."""
    out = [""]
    for op, arg in nodes:
        if op is RC.LITERAL:
            c = chr(arg).lower()
            more = [c if KNOWN.fullmatch(c) else GAP]
        elif op is RC.SUBPATTERN:
            more = _texts(arg[-1])
        elif op is RC.BRANCH:
            more = [t for branch in arg[1] for t in _texts(branch)]
        elif op is RC.IN and all(o is RC.LITERAL for o, _ in arg):
            more = [t for x in arg for t in _texts([x])]
        else:
            more = [GAP]
        out = [a + b for a in out for b in more] if len(out) * len(more) <= MANY else [a + GAP for a in out]
    return out


@lru_cache(maxsize=4096)
def needed(patterns: tuple[str, ...]) -> tuple[list[str], list[str] | None]:
    """(sure, maybe) for the patterns of one category, all lower-case: a text with a word of ``sure`` matches;
    any other text matches only if it holds a word of ``maybe``; None: every text has to be put to the patterns."""
    sure, maybe = set(), set(ODD)
    for p in patterns:
        try:
            texts = _texts(RP.parse(p)) if PLAIN.fullmatch(p) and GAP not in p else [GAP]
        except re.error:
            texts = [GAP]
        for t in texts:
            if GAP not in t:
                sure.add(t)
            elif word := max(t.split(GAP), key=len):
                maybe.add(word)
            else:
                return sorted(sure), None
    return sorted(sure), sorted(maybe)


def match_sql(text: str, low: str, lex: Lexicon, category: str, found: str | None = None) -> str:
    if not lex.is_regex:
        return any_sql(low, lex.keywords(category), found)
    match = f"({text} RLIKE {sql_lit(regex_alternation(lex.keywords(category)))})"
    sure, maybe = needed(tuple(lex.keywords(category)))
    if maybe is not None:
        match = f"({any_sql(low, maybe, found)} AND {match})"
    return f"({any_sql(low, sure, found)} OR {match})" if sure else match


def asked_words(*lexicons: Lexicon) -> set[str]:
    """The words that ``tags`` and ``best_struct`` ask a text for."""
    out: set[str] = set()
    for lex in lexicons:
        for c in lex.categories:
            sure, maybe = needed(tuple(lex.keywords(c))) if lex.is_regex else (lex.keywords(c), None)
            out.update(sure, maybe or [])
    return out


def hit_count(low, keywords: list[str]) -> Column:
    """Number of keywords (a bag: duplicates count) contained in the lower-cased column ``low``."""
    if isinstance(low, str):
        return F.expr(hits_sql(_name(low), keywords))
    return reduce(lambda a, b: a + b, [col_(low).contains(k).cast("int") for k in keywords]) if keywords else F.lit(0)


def any_hit(low, keywords: list[str]) -> Column:
    """True when any keyword is contained (stops at the first hit)."""
    if isinstance(low, str):
        return F.expr(any_sql(_name(low), keywords))
    return reduce(lambda a, b: a | b, [col_(low).contains(k) for k in keywords])


def tags(text: str, lex: Lexicon, low: str | None = None, found: str | None = None) -> Column:
    """Ordered array of categories with at least one hit (declared order, each once).

    ``text``/``low`` are column names; ``low`` is the lower-cased text, to be at hand where it is asked often,
    ``found`` the ``found_words`` of the lexicon's ``asked_words`` (and others).
    """
    t = _name(text)
    lw = _name(low) if low else f"lower({t})"
    fd = _name(found) if found else None
    items = ", ".join(f"CASE WHEN {match_sql(t, lw, lex, c, fd)} THEN {sql_lit(c)} END" for c in lex.categories)
    return F.expr(f"array_compact(array({items}))")


def best_struct(low: str, lex: Lexicon, found: str | None = None) -> Column:
    """D3 core: ``array_max`` of ``struct(score, order, label)`` over the categories.

    The maximum is the highest hit count; among equal counts the earliest
    declared category wins (``order`` = n - position).  Materialise it as its
    own column (``operators.tagging.classify``) before reading score and label
    from it, so the keyword tests are evaluated once.
    """
    lw = _name(low)
    fd = _name(found) if found else None
    n = len(lex.categories)
    items = ", ".join(f"named_struct('score', {hits_sql(lw, lex.keywords(c), fd)}, 'order', {n - i}, 'label', {sql_lit(c)})"
                      for i, c in enumerate(lex.categories))
    return F.expr(f"array_max(array({items}))")


def label_of(best, text, lex: Lexicon) -> Column:
    """Label from a ``best_struct`` column: NULL (or the default) for empty text or zero hits."""
    empty = F.coalesce(col_(text), F.lit("")) == ""
    label = F.when(~empty & (col_(best)["score"] > 0), col_(best)["label"])
    if lex.default is not None:
        label = F.coalesce(label, F.lit(lex.default))
    return label


def score_of(best, text) -> Column:
    empty = F.coalesce(col_(text), F.lit("")) == ""
    return F.when(~empty, col_(best)["score"]).otherwise(F.lit(0))


def confidence(score) -> Column:
    return F.least(col_(score) / F.lit(5.0), F.lit(1.0))


def severity(low: str, urgency: list[str], severe: list[str], base=3.0, wu=1.5, ws=2.0, cap=10) -> Column:
    """``min(int(base + wu*urgency_hits + ws*severity_hits), cap)`` on the lower-cased text column ``low``."""
    lw = _name(low)
    return F.expr(f"CAST(least(floor({base} + {wu} * {hits_sql(lw, urgency)} + {ws} * {hits_sql(lw, severe)}), {cap}) AS INT)")


GROUPED_AMOUNT_PATTERN = r"(\d{1,3}(?:,\d{3})+|\d+)\s*(جنيه|EGP|egp|\$)"


def budget_amount_range(text, grouped_digits: bool = False) -> Column:
    """D5 first rule: first ``<digits> <currency>`` amount, bucketed; NULL when no amount.

    ``grouped_digits=True`` (opt-in, Q8) reads ``10,000 EGP`` as 10000 instead of
    the reference's ``000``.
    """
    pat = GROUPED_AMOUNT_PATTERN if grouped_digits else BUDGET_AMOUNT_PATTERN
    amt = F.regexp_replace(F.regexp_extract(col_(text), "(?U)" + pat, 1), ",", "")
    ascii_amt = F.translate(amt, "٠١٢٣٤٥٦٧٨٩", "0123456789")
    digits = F.regexp_replace(ascii_amt, r"^0+(?=[0-9])", "")
    # more than 9 significant digits is certainly >= the top edge (Python ints are unbounded)
    big = F.length(digits) > 9
    v = digits.try_cast("bigint")
    e0, e1, e2 = BUDGET_EDGES
    bucket = (F.when(big, F.lit(BUDGET_RANGES[3]))
              .when(v < e0, F.lit(BUDGET_RANGES[0]))
              .when(v < e1, F.lit(BUDGET_RANGES[1]))
              .when(v < e2, F.lit(BUDGET_RANGES[2]))
              .when(v.isNotNull(), F.lit(BUDGET_RANGES[3])))
    return F.when(amt != "", bucket)


def budget_range(text, budget_lex: Lexicon, best) -> Column:
    """Amount rule first, else the best label over the budget lexicon (keywords as literals)."""
    return F.coalesce(budget_amount_range(text), label_of(best, text, budget_lex))
