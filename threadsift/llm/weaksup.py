"""Quality rules as weak supervision (operator 5).

One pass over the text counts words, symbols, repeated lines and repeated passages.  Each rule
votes good (1), bad (0) or abstains (2) on those counts.  Expectation-maximisation on the
counts of the distinct vote patterns (at most 3 ** len(RULES) rows, whatever the corpus) estimates
the prior and each rule's two accuracies; the posterior probability of good text replaces
all-must-pass filtering.

Lines and passages count as equal when two independent 64-bit hashes agree.

Defined cases: a null text has no words and fails the base test; with no documents at all the
result is empty; repeated rows get equal results; a very long text is counted whole, in memory in
proportion to it; extra columns are left out by name and never reach the counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsift.llm.text import SPACE, column_bytes, mix, slices, span_hashes, word_spans, written

WINDOW = 8
ROUNDS = 60
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER, _LOWER, _DIGIT = (np.isin(np.arange(256), list(x)) for x in (range(65, 91), range(97, 123), range(48, 58)))
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_digits", "n_stutter"]

#: rule: (votes good when, votes bad when); otherwise it abstains
RULES = {
    "length": ("false", "n_words < 20"),
    "word_length": ("false", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    "symbols": ("false", "100 * n_symbols > 20 * n_words"),
    "dup_lines": ("n_lines >= 3 AND n_dup_lines = 0", "100 * n_dup_lines > 50 * n_lines"),
    "repeats": ("false", "100 * n_repeat_words > 30 * n_words"),
    "capitals": ("false", "100 * n_upper > 50 * n_letters"),
    "stutter": ("false", "100 * n_stutter > 30 * n_words"),
    "digits": ("false", "100 * n_digits > 30 * word_chars"),
    "prose": ("n_words >= 20 AND 100 * n_symbols <= 10 * n_words AND 100 * n_repeat_words <= 15 * n_words "
              "AND 100 * n_stutter <= 15 * n_words AND 100 * n_upper <= 30 * n_letters AND 100 * n_digits <= 15 * word_chars", "false"),
}


def _per_row(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    c = np.r_[0, np.cumsum(flags, dtype=np.int64)]
    return c[offs[1:]] - c[offs[:-1]]


def _windows(h: np.ndarray, m: int) -> np.ndarray:
    """Hash of the WINDOW words from each of the first m words on."""
    acc = h[:m].copy()
    for j in range(1, WINDOW):
        acc = mix(acc * np.uint64(0x94D049BB133111EB) + h[j:j + m])
    return acc


def _counts(data: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    n = offs.size - 1
    ink = ~SPACE[data]
    chars = ink & ((data & 0xC0) != 0x80)
    starts, ends, rows = word_spans(data, offs)
    words = np.bincount(rows, minlength=n)
    # lines: cut at \n and at document ends; those with a word, by hash within the document
    edge = np.zeros(data.size + 1, bool)
    edge[np.flatnonzero(data == 10) + 1] = True
    edge[offs] = True
    begin = np.flatnonzero(edge[:-1]) if data.size else np.zeros(0, np.int64)
    end = np.r_[begin[1:], data.size] if begin.size else begin
    has_nl = data[end - 1] == 10 if begin.size else np.zeros(0, bool)
    total = np.r_[0, np.cumsum(ink)]
    inked = total[end] > total[begin] if begin.size else np.zeros(0, bool)
    begin, end = begin[inked], (end - has_nl)[inked]
    line_row = np.searchsorted(offs, begin, "right") - 1
    lines = np.bincount(line_row, minlength=n)
    one, two = (span_hashes(data, begin, end, salt=k) for k in (0, 1))
    order = np.lexsort((two, one, line_row))
    again = (line_row[order][1:] == line_row[order][:-1]) & (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
    dup = np.bincount(line_row[order][1:][again], minlength=n)
    # windows of WINDOW words that stand in the document twice or more; every word they cover
    repeat = np.zeros(n, np.int64)
    h, g = (span_hashes(data, starts, ends, salt=k) for k in (0, 1))
    m = h.size - WINDOW + 1
    if m > 0:
        at = np.flatnonzero(rows[:m] == rows[WINDOW - 1:])
        acc, check = _windows(h, m)[at] ^ mix(rows[at].astype(np.uint64) + np.uint64(1)), _windows(g, m)[at]
        order = np.argsort(acc, kind="stable")
        s, c = acc[order], check[order]
        if ((s[1:] == s[:-1]) & (c[1:] != c[:-1])).any():  # different passages of one hash
            order = np.lexsort((check, acc))
            s, c = acc[order], check[order]
        same = np.zeros(s.size + 1, bool)
        same[1:-1] = (s[1:] == s[:-1]) & (c[1:] == c[:-1])
        twice = at[order[same[1:] | same[:-1]]]
        d = np.zeros(h.size + 1, np.int64)
        np.add.at(d, twice, 1)
        np.add.at(d, twice + WINDOW, -1)
        repeat = np.bincount(rows[np.cumsum(d)[:-1] > 0], minlength=n)
    again = (h[1:] == h[:-1]) & (g[1:] == g[:-1]) & (rows[1:] == rows[:-1])
    stutter = np.bincount(rows[1:][again], minlength=n)
    up, low = _per_row(_UPPER[data], offs), _per_row(_LOWER[data], offs)
    return [words, _per_row(chars, offs), _per_row(_SYMBOL[data], offs), dup, repeat, lines, up, up + low, _per_row(_DIGIT[data], offs), stutter]


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id and COUNTS of every row."""
    def run(batches):
        for b in batches:
            data, offs = column_bytes(b.column(1))
            got = [_counts(d, o) for _, _, d, o in slices(data, offs)]
            cols = [np.concatenate(c) for c in zip(*got)] if got else [np.zeros(0, np.int64)] * len(COUNTS)
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.int64()) for c in cols]], ["doc_id", *COUNTS])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS))


def fit(votes: np.ndarray, weight: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, float]:
    """EM over vote patterns (0 = bad, 1 = good, 2 = abstain) with their counts: (posterior of good
    per pattern, rates [rule, class (bad, good), vote], prior of good).

    A rule's accuracy is how often each class draws each vote from it, abstaining included: most
    rules notice one kind of bad text and are silent on the rest.  Ten votes at the starting rates
    keep rare rules steady and the classes on their sides.
    """
    start = np.array([[0.25, 0.05, 0.70], [0.01, 0.60, 0.39]])
    rate, prior = np.tile(start, (votes.shape[1], 1, 1)), 0.8
    seen = np.stack([votes == v for v in range(3)], 2).astype(float)
    post = np.zeros(len(votes))
    for _ in range(rounds):
        ll = np.einsum("pjv,jcv->pc", seen, np.log(rate)) + np.log([1 - prior, prior])
        post = 1 / (1 + np.exp(np.clip(ll[:, 0] - ll[:, 1], -700, 700)))
        w = np.stack([1 - post, post]) * weight
        rate = np.einsum("cp,pjv->jcv", w, seen) + 10 * start
        rate /= rate.sum(2, keepdims=True)
        prior = float(np.clip(w[1].sum() / max(weight.sum(), 1e-9), 0.01, 0.99))
    return post, rate, prior


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, COUNTS, base_failed, quality (posterior probability), kept."""
    spark = docs.sparkSession
    vote = [F.expr(f"CAST(CASE WHEN {bad} THEN 0 WHEN {good} THEN 1 ELSE 2 END AS INT)").alias(f"v_{r}") for r, (good, bad) in RULES.items()]
    names = [f"v_{r}" for r in RULES]
    rows = written(text_counts(docs).select("*", *vote), "votes")
    # at most 3 ** len(RULES) patterns
    patterns = rows.groupBy(*names).agg(F.count("*").alias("n")).orderBy(*names).toPandas()
    post, _, _ = fit(patterns[names].to_numpy(), patterns["n"].to_numpy(float))
    table = spark.createDataFrame([(*map(int, v), float(p)) for v, p in zip(patterns[names].to_numpy(), post)], ", ".join(f"{v} int" for v in names) + ", quality double")
    failed = F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words")
    return (rows.join(F.broadcast(table), names, "left").withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5)).drop(*names))


def digest(docs: DataFrame) -> DataFrame:
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")
