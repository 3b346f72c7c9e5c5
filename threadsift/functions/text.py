"""Text column builders: cleaning fold, whitespace, previews, flags, buckets.

Everything here returns a ``Column`` built from JVM-side SQL functions, so the
work stays inside whole-stage codegen and runs wherever Spark places the rows.
Regex flags: Java needs ``(?U)`` for Unicode ``\\d``/``\\s``/``\\b`` (Python's
default for ``str`` patterns), ``(?u)`` for Unicode case folding and ``(?d)``
so that only ``\\n`` ends a line, as in Python.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadsift import lexicons as L

# ---------------------------------------------------------------------------
# Interface-noise patterns removed from post text, applied in
# this order (earlier short patterns shadow later long ones, by design of the
# reference), and the author-name disqualifier words.
# ---------------------------------------------------------------------------
UI_CLEANUP_PATTERNS = [
    # Arabic UI elements
    r"عرض المزيد(?: من التعليقات| من الإجابات| من)?",
    r"عرض كل الردود",
    r"عرض  واحد",
    r"عرض  \d+",
    r"عرض كل الردود \(\d+\)",
    r"أعجبني", r"ردّ?", r"مشاركة",
    r"عرض الترجمة", r"تقييم هذه الترجمة", r"عرض الأصل",
    r"اكتب تعليقًا عامًا", r"اكتب إجابة",
    r"مهتم", r"متابعة", r"إلغاء المتابعة",
    r"مساهم صاعد", r"مساهم بارز", r"مشرف", r"خبير مجموعة",
    r"خبير مجموعة في[^$]*",
    # English UI elements
    r"See more", r"See More", r"Show more", r"Show more comments",
    r"Show all replies", r"Read more",
    r"Like", r"Reply", r"Share", r"Comment",
    r"Show translation", r"View original",
    r"Write a comment", r"Write an answer",
    r"Follow", r"Following", r"Unfollow",
    r"Group expert", r"Top contributor", r"Rising contributor",
    r"Interested", r"Going", r"Invite",
    # contributor badges
    r"Rising contributor[^$]*",
    r"Top contributor[^$]*",
    # time patterns
    r"·\s*[٠-٩]+\s*[دسسحhmd][\s\n]*",
    r"·\s*\d+\s*[dhmsy][\s\n]*",
    r"·\s*\d+\s*(?:hour|hours|hr|hrs|minute|min|minutes|day|days|week|weeks|month|months|year|years|just now|now|yesterday)[\s\n]*",
    r"·\s*[٠-٩]+\s*(?:ساعة|ساعات|دقيقة|دقائق|يوم|أيام|أسبوع|شهر|سنة|منذ)[\s\n]*",
    # standalone numbers (reaction counts)
    r"^[\d٠-٩]+\s*[\n\s]+$",
    r"^\s*[\d٠-٩]+\s*\n",
    r"\n[\d٠-٩]+\s*$",
    # "·" separator on its own line
    r"^\s*·\s*$",
]

# Words that disqualify a first text line as an author name.
AUTHOR_FIRST_LINE_BAD_WORDS = [
    "عرض", "see", "like", "share", "comment", "more", "http",
    "منذ", "ago", "ساعة", "دقيقة", "يوم", "hour", "min",
]

# Bidi / zero-width marks (LRM, RLM, LRE, RLE, PDF, LRO, RLO, ZWSP, BOM).
BIDI_MARKS = "‎‏‪‫‬‭‮​﻿"

# Arabic-Indic digits and their ASCII equivalents.
ARABIC_DIGITS = "٠١٢٣٤٥٦٧٨٩"
ASCII_DIGITS = "0123456789"

# Media-flag phrases (lower-cased text).
VIDEO_MARKERS = ["shared a video", "شارك فيديو"]
SHARE_MARKERS = ["shared a post", "شارك منشور"]
# End of fixed values.
# ---------------------------------------------------------------------------

CLEAN_FLAGS = "(?iumdU)"  # IGNORECASE|MULTILINE with Python-equivalent Unicode and line rules


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: the characters that Python's ``str.strip`` removes
PY_BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
#: a run of blanks that holds a line end, from its first blank on; possessive, so a long run is read once
_LINE_GAP = r"(?U)(?<![\s\x1c-\x1f])[\s\x1c-\x1f&&[^\n]]*+\n[\s\x1c-\x1f]*+"


def py_strip(c) -> Column:
    """Python ``str.strip()``: leading and trailing Unicode whitespace removed, in one pass over the ends."""
    return F.btrim(col_(c), F.lit(PY_BLANKS))


def _folded(c: Column) -> Column:
    """Lower case, with the letters that meet an ASCII letter only when case is ignored."""
    return F.lower(F.translate(c, "ſİı", "sii"))


def _needed(pattern: str) -> str | None:
    """Lower-case characters that every match of a noise pattern holds; None for the patterns of bare numbers."""
    if "·" in pattern:
        return "·"
    plain = re.split(r"[\\(\[^]", pattern)[0]
    if plain.endswith("?"):
        plain = plain[:-2]  # the last letter may be missing
    return plain.strip().lower() or None


#: a line of digits only, which every pattern of bare numbers needs
_NUMBER_LINE = r"(?mdU)^[\s&&[^\n]]*+[\d٠-٩]++[\s&&[^\n]]*+$"


def ui_noise_removed(c, patterns: list[str] | None = None) -> Column:
    """Ordered fold of ``regexp_replace`` over the interface-noise patterns (order preserved).  A
    pattern runs only where the text so far holds the characters that it needs."""
    pats = UI_CLEANUP_PATTERNS if patterns is None else patterns

    def state(y: Column) -> Column:
        return F.struct(y.alias("text"), _folded(y).alias("low"))

    def once(value: Column, body) -> Column:
        return F.element_at(F.transform(F.array(value), body), 1)  # the value, made once, under a name

    def step(acc: Column, p: str) -> Column:
        need = _needed(p)

        def one(s: Column) -> Column:
            may = s["text"].rlike(_NUMBER_LINE) if need is None else s["low"].contains(need)
            return F.when(may, state(F.regexp_replace(s["text"], CLEAN_FLAGS + p, ""))).otherwise(s)
        return once(acc, one)
    return reduce(step, pats, once(col_(c), state))["text"]


def may_hold_noise(c, patterns: list[str] | None = None) -> Column:
    """Whether any noise pattern can match; where none can, the fold changes nothing."""
    pats = UI_CLEANUP_PATTERNS if patterns is None else patterns
    need = {_needed(p) for p in pats}
    words = sorted(w for w in need if w and not any(o and o != w and o in w for o in need))
    x = col_(c)
    found = F.exists(F.array(_folded(x)), lambda y: contains_any(y, words)) if words else F.lit(False)
    return found | x.rlike(_NUMBER_LINE) if None in need else found


def normalize_whitespace(c) -> Column:
    """Newline runs collapsed, each line trimmed, then the ends: a run of blanks within the text that holds
    a line end becomes one newline, any other stays."""
    return py_strip(F.regexp_replace(col_(c), _LINE_GAP, "\n"))


def clean_text(c) -> Column:
    """C1 + C2: full body-text cleaning; a text that no noise pattern can match skips the fold."""
    x = col_(c)
    return normalize_whitespace(F.when(may_hold_noise(x), ui_noise_removed(x)).otherwise(x))


def strip_bidi(c, everywhere: bool = False) -> Column:
    """Drop bidi/zero-width marks at both ends (or everywhere)."""
    if everywhere:
        return F.translate(col_(c), BIDI_MARKS, "")
    cls = "[" + BIDI_MARKS + "]+"
    return F.regexp_replace(col_(c), "^" + cls + "|" + cls + "$", "")


def ascii_digits(c) -> Column:
    """Arabic-Indic to ASCII digits."""
    return F.translate(col_(c), ARABIC_DIGITS, ASCII_DIGITS)


def preview(c, n: int = 200, suffix: str = "...") -> Column:
    """First ``n`` characters, plus ``suffix`` when longer."""
    x = col_(c)
    return F.when(F.length(x) > n, F.concat(F.substring(x, 1, n), F.lit(suffix))).otherwise(x)


def media_preview(c, n: int = 60, placeholder: str = "[media-only]") -> Column:
    """The first ``n`` characters; a post without text is named by the placeholder."""
    return F.when(col_(c) == "", F.lit(placeholder)).otherwise(F.substring(col_(c), 1, n))


def contains_any(c, needles: list[str]) -> Column:
    x = col_(c)
    return reduce(lambda a, b: a | b, [x.contains(n) for n in needles])


def media_flags(c) -> tuple[Column, Column]:
    """C11: (is_video, is_share) from the lower-cased text."""
    low = F.lower(col_(c))
    return contains_any(low, VIDEO_MARKERS), contains_any(low, SHARE_MARKERS)


def first_line(c) -> Column:
    return F.substring_index(col_(c), "\n", 1)


def author_guess(c) -> Column:
    """First line as a tentative author: 3..59 chars, no bad word, not digits-only; else ''."""
    line = py_strip(first_line(c))
    low = F.lower(line)
    ok = ((F.length(line) > 2) & (F.length(line) < 60)
          & ~contains_any(low, AUTHOR_FIRST_LINE_BAD_WORDS)
          & ~line.rlike(r"^[\d٠-٩]+$"))
    return F.when(ok, line).otherwise(F.lit(""))


def strip_author_prefix(text, author) -> Column:
    """C14: drop ``author + '\\n'`` from the start of the text, then strip."""
    t, a = col_(text), col_(author)
    starts = (F.length(a) > 0) & t.startswith(F.concat(a, F.lit("\n")))
    rest = F.substring(t, F.length(a) + 1, F.lit(1 << 30))
    return F.when(starts, py_strip(rest)).otherwise(t)


def truncated(c) -> Column:
    """Text still carries a 'see more' marker."""
    return contains_any(col_(c), L.TRUNCATION_MARKERS)


def length_bucket(c) -> Column:
    """Short (<100) / medium (100..299) / long (>=300) by code points."""
    n = F.length(col_(c))
    return (F.when(n < L.LENGTH_SHORT_BELOW, "short")
            .when(n < L.LENGTH_LONG_FROM, "medium").otherwise("long"))


def content_ok(text, images, url) -> Column:
    """Keep unless (blank or < 5 chars after strip) and no images and no url."""
    t = py_strip(col_(text))
    empty = (F.length(t) < 5)
    no_media = (F.coalesce(F.size(col_(images)), F.lit(0)) <= 0) & (F.coalesce(col_(url), F.lit("")) == "")
    return ~(empty & no_media)
