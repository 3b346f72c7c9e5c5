"""Secret scans with corpus-wide ownership (operator 9), with DataFrame expressions only.

Regular expressions propose candidates.  The hash of each candidate's value is aggregated over the
corpus by distinct owners and distinct repositories: a value in ``MIN_OWNERS`` owners or more, or in
``MIN_REPOS`` repositories or more of fewer owners, is a widely copied example (documentation, licence
text, sample code, a template), one held by fewer looks live.  Base kinds (assign, access, hex) are spans whatever the verdict; the added vendor kind is
a span only where it looks live.

Distinct (hash, owner, repository) rows are combined map-side before any shuffle, so a value that
stands in a third of all documents shrinks to one row per owner and task; the verdict table is
written and joined back on the hash, where AQE splits a hot hash.

Defined cases: a null text is empty; null owners and repositories count as one owner; rows are
told apart by a row id, so repeated rows and null doc_ids keep rows of their own; an empty table gives an
empty result; a very long text is scanned whole; extra columns are left out by name or kept untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadsift.llm.spans import Pattern, with_matches
from threadsift.llm.text import written

MIN_OWNERS, MIN_REPOS = 3, 6
_WORD = r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
_SIGN = r'["\x27]?\x20*[:=]\x20*["\x27]?'
ASSIGN = _WORD + _SIGN + r"[A-Za-z0-9+/_.=-]+"
ASSIGN_HEAD = _WORD + _SIGN
PATTERNS = [
    Pattern("assign", ASSIGN, "(contains({t}, '=') OR contains({t}, ':'))"),
    Pattern("access", r"AKIA[A-Z0-9]++", "contains({t}, 'AKIA')"),
    # runs of 32 and more are just the runs that a greedy search finds and the length test keeps
    Pattern("hex", r"(?<![0-9a-f])[0-9a-f]{32,}+"),
    Pattern("vendor", r"gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35,}"
                      r"|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}|-----BEGIN\x20[A-Z\x20]{0,30}PRIVATE\x20KEY-----",
            "({t} RLIKE 'gh[pousr]_|xox[abprs]-|sk_live_|AIza|eyJ|-----BEGIN')"),
]
KINDS = [p.kind for p in PATTERNS]
BASE = KINDS[:3]
_VALUE = {"assign": f"regexp_replace(x.m, r'^{ASSIGN_HEAD}', '')"}
_VALID = {"assign": "length({v}) >= 8", "access": "length(x.m) >= 16", "hex": "true", "vendor": "true"}


def candidates(docs: DataFrame, text: str = "text", out: str = "secrets") -> DataFrame:
    """docs with ``out``: array<struct<start, kind_no, end, kind, vhash, base>> by start, then kind."""
    body = "__secret_text"
    d = with_matches(docs.withColumn(body, F.coalesce(F.col(text), F.lit(""))), PATTERNS, body)
    parts = []
    for i, k in enumerate(KINDS):
        v = _VALUE.get(k, "x.m")
        parts.append(f"transform(filter(__{k}, x -> {_VALID[k].format(v=v)}), x -> struct(x.s AS start, {i} AS kind_no, x.e AS end, '{k}' AS kind, "
                     f"sha2({v}, 256) AS vhash, {str(k in BASE).lower()} AS base))")
    return d.withColumn(out, F.expr(f"array_sort(concat({', '.join(parts)}))")).drop(body, *[f"__{k}" for k in KINDS])


def ownership(found: DataFrame) -> DataFrame:
    """(vhash, n_owners, n_repos) over exploded candidates with owner and repo columns."""
    one = found.select("vhash", "owner", "repo").distinct()
    by_owner = one.groupBy("vhash", "owner").agg(F.count("*").alias("r"))
    return by_owner.groupBy("vhash").agg(F.count("*").alias("n_owners"), F.sum("r").alias("n_repos"))


def _owned(docs: DataFrame, owner: Column, repo: Column, keep: list[str], text: str) -> DataFrame:
    """The ``keep`` columns as k_<name>, secrets (all candidates), __owner and __repo."""
    nul = F.lit("\u0000")
    src = docs.select(*[F.col(c).alias(f"k_{c}") for c in keep], F.col(text).alias("__t"), F.coalesce(owner.cast("string"), nul).alias("__owner"),
                      F.coalesce(repo.cast("string"), nul).alias("__repo"))
    return candidates(src, "__t").drop("__t")


def _judged(rows: DataFrame, keep: list[str], min_owners: int, min_repos: int, out: str) -> DataFrame:
    """``rows`` (written, with __rid): the ``keep`` columns and ``out`` with the verdicts."""
    found = rows.filter("size(secrets) > 0").select("__rid", F.col("__owner").alias("owner"), F.col("__repo").alias("repo"), F.inline("secrets"))
    wide = written(ownership(found), "ownership")
    judged = (found.select("__rid", "start", "kind_no", "end", "kind", "base", "vhash")
              .join(wide, "vhash").withColumn("live", (F.col("n_owners") < min_owners) & (F.col("n_repos") < min_repos))
              .filter("base OR live"))
    # a group holds the spans of one document
    spans = judged.groupBy("__rid").agg(F.array_sort(F.collect_list(F.struct("start", "kind_no", "end", "kind", "base", "live", "n_owners", "n_repos"))).alias("spans"))
    none = F.expr("CAST(array() AS array<struct<start:int,kind_no:int,end:int,kind:string,base:boolean,live:boolean,n_owners:bigint,n_repos:bigint>>)")
    both = rows.drop("secrets", "__owner", "__repo").join(spans, "__rid", "left")
    return both.select(*[F.col(f"k_{c}").alias(c) for c in keep], F.coalesce("spans", none).alias(out))


def scan(docs: DataFrame, owner: Column, repo: Column, keep: list[str], text: str = "text", min_owners: int = MIN_OWNERS,
         min_repos: int = MIN_REPOS, out: str = "secrets") -> DataFrame:
    """The ``keep`` columns and ``out``: array<struct<start, kind_no, end, kind, base, live, n_owners,
    n_repos>> by start, then kind; one row per row of ``docs``.  Vendor spans of widely copied values are gone."""
    rows = _owned(docs, owner, repo, keep, text).withColumn("__rid", F.monotonically_increasing_id())
    return _judged(written(rows, "secret-rows"), keep, min_owners, min_repos, out)


def redacted(docs: DataFrame, owner: Column, repo: Column, mark: str = "[SECRET]", text: str = "text", min_owners: int = MIN_OWNERS,
             min_repos: int = MIN_REPOS) -> DataFrame:
    """docs with every live-looking span of ``text`` replaced by ``mark``; overlapping spans merge.

    Documents without a candidate pass as they are; only the others, with their texts, are written
    and joined with the verdicts.
    """
    cols = docs.columns
    rows = _owned(docs, owner, repo, cols, text)
    clean = rows.filter("size(secrets) = 0").select(*[F.col(f"k_{c}").alias(c) for c in cols])
    held = written(rows.filter("size(secrets) > 0").withColumn("__rid", F.monotonically_increasing_id()), "secret-rows")
    d = _judged(held, cols, min_owners, min_repos, "__secrets").withColumn("__live", F.expr("filter(__secrets, s -> s.live)"))
    fold = (f"aggregate(__live, struct(0 AS at, CAST(array() AS array<string>) AS o), (a, p) -> struct(greatest(a.at, p.end) AS at, "
            f"CASE WHEN p.start >= a.at THEN concat(a.o, array(substr(`{text}`, a.at + 1, p.start - a.at), '{mark}')) ELSE a.o END AS o), "
            f"a -> array_join(concat(a.o, array(substr(`{text}`, a.at + 1))), ''))")
    masked = d.withColumn(text, F.expr(f"CASE WHEN size(__live) > 0 THEN {fold} ELSE `{text}` END")).select(*cols)
    return clean.unionByName(masked)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example, owned (owners/repositories of each span) (owner: source; repository: source and lang)."""
    repo = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")))
    d = scan(docs, F.col("source"), repo, ["doc_id"])
    listed = "array_join(transform({a}, p -> concat_ws(':', p.kind, p.start, p.end)), ',')"
    return d.select("doc_id", *[F.expr(f"CAST(size(filter(secrets, p -> p.kind = '{k}')) AS LONG)").alias(f"n_{k}") for k in BASE],
                    F.sha2(F.expr(listed.format(a="filter(secrets, p -> p.base)")), 256).alias("base_sha256"),
                    F.expr(listed.format(a="secrets")).alias("spans"),
                    F.expr("CAST(size(filter(secrets, p -> p.live)) AS LONG)").alias("n_live"),
                    F.expr("CAST(size(filter(secrets, p -> NOT p.live)) AS LONG)").alias("n_example"),
                    F.expr("array_join(transform(secrets, p -> concat_ws('/', p.n_owners, p.n_repos)), ',')").alias("owned"))


def _oracle() -> str:
    """The same result in DuckDB SQL, from the plain patterns."""
    plain = {"assign": ASSIGN, "access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]{32,}", "vendor": PATTERNS[3].regex}
    value = {"assign": f"regexp_replace(m, '^{ASSIGN_HEAD}', '')"}
    ok = {"assign": f"length({value['assign']}) >= 8", "access": "length(m) >= 16", "hex": "true", "vendor": "true"}
    per = [f"""
  SELECT rid, owner, repo, {i} AS o, '{k}' AS kind, e - length(m) AS s, e, {str(k in BASE).lower()} AS base, {value.get(k, 'm')} AS v FROM (
    SELECT rid, owner, repo, m, CAST(sum(n + length(m)) OVER (PARTITION BY rid ORDER BY i) AS BIGINT) AS e FROM (
      SELECT rid, owner, repo, i, f[i] AS m, length(g[i]) AS n
      FROM (SELECT rid, owner, repo, f, g, unnest(range(1, len(f) + 1)) AS i FROM (SELECT rid, owner, repo, regexp_extract_all(t, '{plain[k]}') AS f, string_split_regex(t, '{plain[k]}') AS g FROM d) WHERE len(f) > 0)))
  WHERE {ok[k]}""" for i, k in enumerate(KINDS)]
    one = "kind || ':' || s || ':' || e"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, chr(1)) AS owner, coalesce(source, '') || '/' || coalesce(lang, '') AS repo, coalesce(text, '') AS t FROM documents),
p AS ({' UNION ALL '.join(per)}),
w AS (SELECT v, count(DISTINCT owner) AS n_owners, count(DISTINCT owner || chr(2) || repo) AS n_repos FROM p GROUP BY v),
j AS (SELECT p.*, n_owners, n_repos, n_owners < {MIN_OWNERS} AND n_repos < {MIN_REPOS} AS live FROM p JOIN w USING (v) WHERE base OR (n_owners < {MIN_OWNERS} AND n_repos < {MIN_REPOS}))
SELECT d.doc_id, {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE)},
  sha256(coalesce(string_agg({one}, ',' ORDER BY s, o) FILTER (base), '')) AS base_sha256,
  coalesce(string_agg({one}, ',' ORDER BY s, o), '') AS spans,
  count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example,
  coalesce(string_agg(n_owners || '/' || n_repos, ',' ORDER BY s, o), '') AS owned
FROM d LEFT JOIN j USING (rid) GROUP BY rid, doc_id"""


ORACLE = _oracle()
