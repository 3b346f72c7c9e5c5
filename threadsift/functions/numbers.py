"""Count parsing (C4) and engagement totals.

Counts arrive as strings (ASCII or Arabic-Indic digits, maybe ``,`` ``.``
``K`` ``M``).  Three modes:

* ``strict``  -- the whole (stripped) string must be an integer, else 0.
* ``digits``  -- drop every non-digit; empty -> 0 (so ``1.2K`` -> 12).
* ``scaled``  -- honour thousands separators, decimals and ``K``/``M``.

Python ints are unbounded; a value over 18 digits becomes 0 here (``try_cast``
gives NULL) -- a documented deviation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadsift.functions.text import ascii_digits, col_, py_strip


def parse_count(c, mode: str = "strict") -> Column:
    s = ascii_digits(F.coalesce(col_(c), F.lit("")))
    if mode == "strict":
        s = py_strip(s)
        ok = s.rlike(r"^[+-]?[0-9]+$")
        return F.coalesce(F.when(ok, s.try_cast("bigint")), F.lit(0).cast("bigint"))
    if mode == "digits":
        d = F.regexp_replace(s, r"[^0-9]", "")
        return F.coalesce(F.when(d != "", d.try_cast("bigint")), F.lit(0).cast("bigint"))
    if mode == "scaled":
        s = py_strip(s)
        num = F.regexp_extract(s, r"^([0-9][0-9.,]*)\s*([KkMm]?)$", 1)
        unit = F.upper(F.regexp_extract(s, r"^([0-9][0-9.,]*)\s*([KkMm]?)$", 2))
        body = F.regexp_replace(num, ",", "")
        val = F.when(body.rlike(r"^[0-9]+(\.[0-9]+)?\.?$"),
                     F.regexp_replace(body, r"\.$", "").try_cast("decimal(38,6)"))
        mult = F.when(unit == "K", F.lit(1000)).when(unit == "M", F.lit(1000000)).otherwise(F.lit(1))
        return F.coalesce((val * mult).try_cast("bigint"), F.lit(0).cast("bigint"))
    raise ValueError(f"unknown count mode {mode!r}")


def engagement_total(likes, comments, shares=None, mode: str = "strict") -> Column:
    """Likes + comments (+ shares) after parsing."""
    total = parse_count(likes, mode) + parse_count(comments, mode)
    if shares is not None:
        total = total + parse_count(shares, mode)
    return total
