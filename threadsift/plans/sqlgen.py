"""Helpers that write the DuckDB oracle SQL for the same semantics as the Spark
column builders (the correctness gate compares the two engines).

DuckDB uses RE2: ``\\d`` is ASCII and look-arounds are absent, so digits are
translated first and patterns kept to the common subset.
"""

from __future__ import annotations

from threadsift import lexicons as L
from threadsift.sources.adapter import STEPS, phrases


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def hits(low: str, keywords: list[str]) -> str:
    if not keywords:
        return "0"
    return "(" + " + ".join(f"(CASE WHEN contains({low}, {q(k)}) THEN 1 ELSE 0 END)" for k in keywords) + ")"


def any_hit(low: str, keywords: list[str]) -> str:
    return "(" + " OR ".join(f"contains({low}, {q(k)})" for k in keywords) + ")"


def cat_match(text: str, low: str, lex: L.Lexicon, cat: str) -> str:
    if lex.is_regex:
        pat = "|".join("(?:" + p + ")" for p in lex.keywords(cat))
        return f"regexp_matches({text}, {q(pat)}, 'i')"
    return any_hit(low, lex.keywords(cat))


def tags(text: str, lex: L.Lexicon, low: str | None = None) -> str:
    low = low or f"lower({text})"
    items = ", ".join(f"CASE WHEN {cat_match(text, low, lex, c)} THEN {q(c)} END" for c in lex.categories)
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


def best_label(text: str, lex: L.Lexicon, low: str | None = None) -> str:
    low = low or f"lower({text})"
    n = len(lex.categories)
    items = ", ".join(
        "{'s': " + hits(low, lex.keywords(c)) + f", 'o': {n - i}, 'l': {q(c)}" + "}"
        for i, c in enumerate(lex.categories))
    best = f"list_max([{items}])"
    dflt = q(lex.default) if lex.default is not None else "NULL"
    return f"(CASE WHEN coalesce({text}, '') = '' THEN {dflt} WHEN ({best}).s > 0 THEN ({best}).l ELSE {dflt} END)"


def best_score(text: str, lex: L.Lexicon, low: str | None = None) -> str:
    low = low or f"lower({text})"
    parts = ", ".join(hits(low, lex.keywords(c)) for c in lex.categories)
    return f"(CASE WHEN coalesce({text}, '') = '' THEN 0 ELSE greatest({parts}) END)"


def ascii_digits(x: str) -> str:
    return f"translate({x}, '٠١٢٣٤٥٦٧٨٩', '0123456789')"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def parse_strict(x: str) -> str:
    s = strip(ascii_digits(f"coalesce({x}, '')"))
    return f"(CASE WHEN regexp_matches({s}, '^[+-]?[0-9]+$') THEN CAST({s} AS BIGINT) ELSE 0 END)"


def parse_digits(x: str) -> str:
    src = ascii_digits(f"coalesce({x}, '')")
    d = f"regexp_replace({src}, '[^0-9]', '', 'g')"
    return f"(CASE WHEN {d} <> '' THEN CAST({d} AS BIGINT) ELSE 0 END)"


def parse_scaled(x: str) -> str:
    s = strip(ascii_digits(f"coalesce({x}, '')"))
    num = f"regexp_extract({s}, '^([0-9][0-9.,]*)\\s*([KkMm]?)$', 1)"
    unit = f"upper(regexp_extract({s}, '^([0-9][0-9.,]*)\\s*([KkMm]?)$', 2))"
    body = f"replace({num}, ',', '')"
    val = (f"(CASE WHEN regexp_matches({body}, '^[0-9]+(\\.[0-9]+)?\\.?$') "
           f"THEN CAST(regexp_replace({body}, '\\.$', '') AS DECIMAL(38,6)) END)")
    mult = f"(CASE WHEN {unit} = 'K' THEN 1000 WHEN {unit} = 'M' THEN 1000000 ELSE 1 END)"
    return f"coalesce(CAST(trunc({val} * {mult}) AS BIGINT), 0)"


def severity(text: str) -> str:
    low = f"lower({text})"
    raw = (f"({L.SEVERITY_BASE} + {L.SEVERITY_URGENCY_W} * {hits(low, L.URGENCY_KEYWORDS)} "
           f"+ {L.SEVERITY_SEVERITY_W} * {hits(low, L.SEVERITY_KEYWORDS)})")
    return f"CAST(least(floor({raw}), {L.SEVERITY_CAP}) AS BIGINT)"


def cat_rank(col: str, lex: L.Lexicon) -> str:
    whens = " ".join(f"WHEN {col} = {q(c)} THEN {i}" for i, c in enumerate(lex.categories))
    return f"(CASE {whens} END)"


def scale_index(col: str, scale: list[str]) -> str:
    whens = " ".join(f"WHEN {col} = {q(c)} THEN {i}" for i, c in enumerate(scale))
    return f"(CASE WHEN {col} IS NULL THEN NULL {whens} ELSE 0 END)"


# The posts adapter in SQL (mirror of threadsift.sources.adapter.posts_from_tables).
def posts_cte(with_counts: bool = False, name: str = "posts") -> str:
    said = [f"[{', '.join(q(p) for p in [*ps, '', ''])}][1 + d.doc_id // {s} % {len(ps) + 2}]" for ps, s in zip(phrases(), STEPS)]
    text = f"d.text || chr(10) || concat_ws(' ', {', '.join(said)})"
    if with_counts:
        text = (text + " || chr(10) || CAST(d.doc_id % 97 AS VARCHAR) || ' comments' || chr(10) || "
                "CAST(d.doc_id % 13 AS VARCHAR) || ' shares' || chr(10) || CAST(d.doc_id * 7 AS VARCHAR) || ' EGP'")
    return f"""_nd AS (SELECT max(doc_id) + 1 AS nd FROM documents),
_ev AS (SELECT event_id % nd AS k, count(*) AS n FROM events, _nd GROUP BY k),
_cv AS (SELECT (conv_id * 8 + turn) % nd AS k, count(*) AS n FROM conversations, _nd GROUP BY k),
{name} AS (
  SELECT d.doc_id AS seq, d.doc_id AS "index", {text} AS text,
    CASE WHEN d.doc_id % 17 = 0 THEN '' ELSE d.source || '/' || d.lang END AS author,
    '' AS "timestamp",
    CASE WHEN d.doc_id % 5 = 0 THEN '' ELSE 'https://example.org/groups/1/posts/' || CAST(d.doc_id % 400 AS VARCHAR) || '/' END AS url,
    CASE WHEN d.doc_id % 3 = 0 THEN translate(CAST(coalesce(_ev.n, 0) AS VARCHAR), '0123456789', '٠١٢٣٤٥٦٧٨٩')
         WHEN d.doc_id % 7 = 0 THEN ''
         WHEN d.doc_id % 11 = 0 THEN '1.2K'
         WHEN d.doc_id % 13 = 0 THEN '1,234'
         ELSE CAST(coalesce(_ev.n, 0) AS VARCHAR) END AS likes,
    CAST(coalesce(_cv.n, 0) AS VARCHAR) AS comments,
    '' AS shares
  FROM documents d
  LEFT JOIN _ev ON _ev.k = d.doc_id
  LEFT JOIN _cv ON _cv.k = d.doc_id)"""


# ---------------------------------------------------------------- profiles
def budget_amount(text: str) -> str:
    amt = f"regexp_extract({text}, '([0-9٠-٩]+)\\s*(جنيه|EGP|egp|\\$)', 1)"
    digits = f"regexp_replace({ascii_digits(amt)}, '^0+([0-9])', '\\1')"
    v = f"TRY_CAST({digits} AS BIGINT)"
    r = L.BUDGET_RANGES
    e0, e1, e2 = L.BUDGET_EDGES
    return (f"(CASE WHEN {amt} = '' THEN NULL WHEN length({digits}) > 9 THEN {q(r[3])} "
            f"WHEN {v} < {e0} THEN {q(r[0])} WHEN {v} < {e1} THEN {q(r[1])} WHEN {v} < {e2} THEN {q(r[2])} "
            f"WHEN {v} IS NOT NULL THEN {q(r[3])} END)")


def team_size(t: str, n: str) -> str:
    ts = L.TEAM_SIZE
    return (f"(CASE WHEN {t} IS NULL THEN {q(ts['unknown'])} "
            f"WHEN contains({t}, 'Freelancer/Solo') OR contains(lower({t}), 'solo') THEN {q(ts['solo'])} "
            f"WHEN contains({t}, 'Startup') THEN (CASE WHEN {n} > 5 THEN {q(ts['startup_large'])} ELSE {q(ts['startup_small'])} END) "
            f"WHEN contains({t}, 'SME') THEN {q(ts['sme'])} WHEN contains({t}, 'Agency') THEN {q(ts['agency'])} "
            f"ELSE {q(ts['unknown'])} END)")


def readiness(budget: str, tech: str, stage: str, ntools: str) -> str:
    w = L.READINESS_WEIGHTS
    nb, nt, ns = len(L.BUDGET_RANGES), len(L.TECH_LEVELS), len(L.BUSINESS_STAGES)
    b = f"({scale_index(budget, L.BUDGET_RANGES)} + 1)"
    t = f"({scale_index(tech, L.TECH_LEVELS)} + 1)"
    s = f"({scale_index(stage, L.BUSINESS_STAGES)} + 1)"
    terms = [
        f"coalesce({b} * {w['budget'] / nb!r}, 0.0)",
        f"coalesce({t} * {w['tech_capability'] / nt!r}, 0.0)",
        f"coalesce({s} * {w['business_stage'] / ns!r}, 0.0)",
        f"coalesce(({t} / {nt}) * {w['implementation_capability']}, 0.0)",
        f"coalesce(({b} / {nb}) * {w['willingness_to_pay']}, 0.0)",
        f"coalesce(({s} / {ns}) * {w['pain_tolerance']}, 0.0)",
        f"least(coalesce({ntools}, 0) / 3.0, 1.0) * {w['tool_adoption']}",
    ]
    raw = "(" + " + ".join(terms) + ")"
    return f"CAST(least(round_even(round({raw}, 9), 0), 100.0) AS BIGINT)"


def ordered_set(col: str, lex: L.Lexicon) -> str:
    items = ", ".join("{'s': min(seq) FILTER (WHERE list_contains(" + col + f", {q(c)})), 'r': {i}, 'c': {q(c)}" + "}"
                      for i, c in enumerate(lex.categories))
    return f"list_transform(list_sort(list_filter([{items}], lambda x: x.s IS NOT NULL)), lambda x: x.c)"


def profiles_cte() -> str:
    """WITH-list items ``posts``, ``lab`` (labelled posts) and ``prof`` (one row per author)."""
    dims = L.demographic_lexicons()
    bud, pains, tools = L.budget_lexicon(), L.pain_point_lexicon(), L.tool_lexicon()
    label_cols = list(dims) + ["budget_range"]
    lab_cols = ",\n    ".join(f"{best_label('text', lx, 'low')} AS {d}" for d, lx in dims.items())
    firsts = ",\n    ".join(f"arg_min({c}, seq) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in label_cols)
    return f"""{posts_cte(with_counts=True)},
_lab0 AS (SELECT *, lower(text) AS low FROM posts),
lab AS (
  SELECT seq, coalesce(author, 'Unknown') AS author, text, "timestamp",
    {parse_digits('likes')} + {parse_digits('comments')} AS engagement,
    {lab_cols},
    coalesce({budget_amount('text')}, {best_label('text', bud, 'low')}) AS budget_range,
    {tags('text', pains, 'low')} AS pain_points,
    {tags('text', tools, 'low')} AS tool_preferences
  FROM _lab0),
_prof0 AS (
  SELECT author, count(*) AS post_count, CAST(sum(engagement) AS BIGINT) AS total_engagement, min(seq) AS first_seq,
    {firsts},
    {ordered_set('pain_points', pains)} AS pain_points,
    {ordered_set('tool_preferences', tools)} AS tool_preferences
  FROM lab GROUP BY author),
prof AS (
  SELECT *, {team_size('business_type', 'post_count')} AS team_size,
    {readiness('budget_range', 'tech_level', 'business_stage', 'len(tool_preferences)')} AS readiness_score
  FROM _prof0)"""


def dedup_key(url: str = "url", text: str = "text") -> str:
    """The stripped URL, else the SHA-256 of the whole stripped text."""
    return f"CASE WHEN {strip(url)} <> '' THEN {strip(url)} ELSE sha256({strip(text)}) END"
