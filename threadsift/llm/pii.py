"""Personal data (operator 1), with DataFrame expressions only.

Regular expressions propose spans, validators confirm them (parts of an address, Luhn for cards,
mod-97 for bank accounts, digit counts for telephone numbers), and words in the ``CONTEXT`` code
points before a span move its score.  Base kinds (email, ip, card, phone) stay whatever their
score; the added kinds (iban, ssn, tel) stay from ``MIN_SCORE`` on.

The context is read from the text itself: all matches of a list after one label have it.

Defined cases: a null text is empty; an empty text has no spans; an empty table gives none; rows are
independent, so repeated rows repeat and a row without doc_id is scanned like any other.  A very long
text is scanned whole, in time linear in its length and matches.  Extra columns of any name pass
through ``find_pii`` and ``redacted`` (names starting with ``__`` are the operator's own); ``digest`` reads doc_id and text alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsift.llm.spans import Pattern, with_matches

MIN_SCORE = 0.5
PATTERNS = [
    Pattern("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "contains({t}, '@')"),
    Pattern("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    Pattern("card", r"[0-9](?:[\x20-]?[0-9])++"),
    Pattern("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "contains({t}, '+')"),
    Pattern("iban", r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)"),
    Pattern("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "contains({t}, '-')"),
    Pattern("tel", r"\([0-9]{3}\)\x20?[0-9]{3}-[0-9]{4}", "contains({t}, ')')"),
]
KINDS = [p.kind for p in PATTERNS]
BASE = KINDS[:4]

#: what a match must pass to be a span at all (SQL over x.m)
VALID = {
    "email": "true",
    "ip": "forall(split(x.m, '[.]'), p -> length(trim(LEADING '0' FROM p)) <= 3 AND coalesce(try_cast(p AS DECIMAL(38, 0)), 0) <= 255)",
    "card": "luhn(x.m)",
    "phone": "length(regexp_replace(x.m, '[^0-9]', '')) BETWEEN 9 AND 15",
    "iban": "iban(x.m)",
    "ssn": "substr(x.m, 1, 3) NOT IN ('000', '666') AND substr(x.m, 1, 1) <> '9' AND substr(x.m, 5, 2) <> '00' AND substr(x.m, 8, 4) <> '0000'",
    "tel": "true",
}
#: (score without context, words, change of the score where one of them stands before the span)
SCORES = {
    "email": (0.9, "mail|contact|write", 0.1),
    "ip": (0.6, "version|release|section", -0.3),
    "card": (0.7, "card|visa|master|amex|pay", 0.2),
    "phone": (0.7, "phone|tel|call|fax|mobile", 0.2),
    "iban": (0.8, "iban|account|bank|konto", 0.2),
    "ssn": (0.3, "ssn|social|security", 0.5),
    "tel": (0.3, "phone|tel|call|fax|mobile", 0.4),
}


def _luhn(d: str) -> str:
    digit = f"CAST(substr({d}, length({d}) - i, 1) AS INT)"
    return (f"(aggregate(sequence(0, length({d}) - 1), 0, (a, i) -> a + CASE WHEN i % 2 = 0 THEN {digit} "
            f"WHEN {digit} > 4 THEN 2 * {digit} - 9 ELSE 2 * {digit} END) % 10 = 0)")


def _valid(kind: str) -> str:
    if kind == "card":
        d = "regexp_replace(x.m, '[^0-9]', '')"
        return f"length({d}) BETWEEN 13 AND 19 AND {_luhn(d)}"
    if kind == "iban":
        d = "replace(x.m, ' ', '')"
        # letters count 10..35; the first four characters go to the end
        return (f"length({d}) BETWEEN 15 AND 34 AND aggregate(split(concat(substr({d}, 5), substr({d}, 1, 4)), ''), 0, (a, h) -> "
                "CASE WHEN h = '' THEN a WHEN h >= 'A' THEN (a * 100 + ascii(h) - 55) % 97 ELSE (a * 10 + ascii(h) - 48) % 97 END) = 1")
    return VALID[kind]


def find_pii(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """docs with ``out``: array<struct<kind, start, end, value, score, base>> by kind, then start."""
    body = "__pii_text"
    d = with_matches(docs.withColumn(body, F.coalesce(F.col(text), F.lit(""))), PATTERNS, body, context=True)
    parts = []
    for k in KINDS:
        score, words, change = SCORES[k]
        parts.append(f"transform(filter(__{k}, x -> {_valid(k)}), x -> struct('{k}' AS kind, x.s AS start, x.e AS end, x.m AS value, "
                     f"CAST({score} AS DOUBLE) + CASE WHEN lower(x.c) RLIKE '{words}' THEN CAST({change} AS DOUBLE) ELSE 0D END AS score, {str(k in BASE).lower()} AS base))")
    d = d.withColumn(out, F.expr(f"filter(concat({', '.join(parts)}), p -> p.base OR p.score >= {MIN_SCORE})"))
    return d.drop(body, *[f"__{k}" for k in KINDS])


def redacted(docs: DataFrame, text: str = "text", mark: str = "[PII]") -> DataFrame:
    """docs with every span of ``find_pii`` in ``text`` replaced; overlapping spans merge."""
    d = find_pii(docs, text, "__pii").withColumn("__pii", F.expr("array_sort(__pii, (a, b) -> CASE WHEN a.start <> b.start THEN a.start - b.start ELSE a.end - b.end END)"))
    fold = (f"aggregate(__pii, struct(0 AS at, CAST(array() AS array<string>) AS o), (a, p) -> struct(greatest(a.at, p.end) AS at, "
            f"CASE WHEN p.start >= a.at THEN concat(a.o, array(substr({text}, a.at + 1, p.start - a.at), '{mark}')) ELSE a.o END AS o), "
            f"a -> array_join(concat(a.o, array(substr({text}, a.at + 1))), ''))")
    return d.withColumn(text, F.expr(f"CASE WHEN size(__pii) > 0 THEN {fold} ELSE {text} END")).drop("__pii")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added."""
    d = find_pii(docs.select("doc_id", "text")).drop("text")
    listed = "array_join(transform({a}, p -> concat_ws(':', p.kind, p.start, p.end)), ',')"
    return d.select("doc_id", *[F.expr(f"CAST(size(filter(pii, p -> p.kind = '{k}')) AS LONG)").alias(f"n_{k}") for k in BASE],
                    F.sha2(F.expr(listed.format(a="filter(pii, p -> p.base)")), 256).alias("base_sha256"),
                    F.expr(listed.format(a="pii")).alias("spans"),
                    F.expr("CAST(size(filter(pii, p -> NOT p.base)) AS LONG)").alias("n_added"))


def _oracle() -> str:
    """The same result in DuckDB SQL, from the plain patterns."""
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "iban": PATTERNS[4].regex, "ssn": PATTERNS[5].regex, "tel": PATTERNS[6].regex,
    }
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    ok = {
        "email": "true",
        "ip": "len(list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) > 3 OR coalesce(try_cast(ltrim(p, '0') AS INTEGER), 0) > 255)) = 0",
        "card": (f"length({digits}) BETWEEN 13 AND 19 AND list_sum(list_transform(range(length({digits})), lambda i: CASE WHEN i % 2 = 0 THEN CAST(substr({digits}, CAST(length({digits}) - i AS BIGINT), 1) AS INTEGER) "
                 f"ELSE CAST(substr('0246813579', 1 + CAST(substr({digits}, CAST(length({digits}) - i AS BIGINT), 1) AS INTEGER), 1) AS INTEGER) END)) % 10 = 0"),
        "phone": f"length({digits}) BETWEEN 9 AND 15",
        "iban": ("length(replace(m, ' ', '')) BETWEEN 15 AND 34 AND list_reduce(list_concat([0::BIGINT], list_transform(string_split(concat(substr(replace(m, ' ', ''), 5), substr(m, 1, 4)), ''), "
                 "lambda h: CAST(CASE WHEN h >= 'A' THEN ascii(h) - 55 ELSE ascii(h) - 48 END AS BIGINT))), lambda a, v: CASE WHEN v > 9 THEN (a * 100 + v) % 97 ELSE (a * 10 + v) % 97 END) = 1"),
        "ssn": VALID["ssn"].replace("x.m", "m"),
        "tel": "true",
    }
    per = []
    for i, k in enumerate(KINDS):
        score, words, change = SCORES[k]
        per.append(f"""
  SELECT rid, {i} AS o, '{k}' AS kind, e - length(m) AS s, e, {str(k in BASE).lower()} AS base FROM (
    SELECT rid, m, e, substr(t, greatest(1, e - length(m) - 39), least(40, e - length(m))) AS c FROM (
    SELECT rid, m, CAST(sum(n + length(m)) OVER (PARTITION BY rid ORDER BY i) AS BIGINT) AS e FROM (
      SELECT rid, i, f[i] AS m, length(g[i]) AS n
      FROM (SELECT rid, f, g, unnest(range(1, len(f) + 1)) AS i FROM (SELECT rid, regexp_extract_all(t, '{plain[k]}') AS f, string_split_regex(t, '{plain[k]}') AS g FROM d) WHERE len(f) > 0))) JOIN d USING (rid))
  WHERE {ok[k]} AND ({str(k in BASE).lower()} OR {score} + CASE WHEN regexp_matches(lower(c), '{words}') THEN {change} ELSE 0 END >= {MIN_SCORE})""")
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
p AS ({' UNION ALL '.join(per)})
SELECT d.doc_id, {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE)},
  sha256(coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY o, s) FILTER (base), '')) AS base_sha256,
  coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY o, s), '') AS spans,
  count(*) FILTER (NOT base) AS n_added
FROM d LEFT JOIN p USING (rid) GROUP BY rid, doc_id"""


ORACLE = _oracle()
