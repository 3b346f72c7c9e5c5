"""corpus_pipeline against a brute-force version, stage by stage, and the registered queries."""

import collections
import hashlib
import re

import duckdb
import numpy as np
import public_tokenizers as P
import pytest

import __spark_entry__ as E
import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm.test_documents import groups_by_force, mix_by_force
from threadsift.llm import bpe, queries, secret_scan
from threadsift.llm.text import written
from tools.check import TABLES, digest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark):
    docs = queries.table(spark, SF_SMALL, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF_SMALL), f"test-{name}"))
    return [[r.asDict() for r in d.collect()] for d in out], [d.columns for d in out]


def test_stages(stages):
    rows, cols = stages
    docs, clean, deduped, masked, mixed, ids = rows
    assert all(c == cols[0] for c in cols[:-1])
    lab = dict(duckdb.sql(f"select doc_id, toxic from '{SF_SMALL}/labels.parquet'").fetchall())
    by = {r["doc_id"]: r for r in docs}
    assert all(by[r["doc_id"]] == r for r in clean)
    gone = {r["doc_id"] for r in docs} - {r["doc_id"] for r in clean}
    assert gone and not any(lab.get(i) == 0 for i in gone)
    comp, _ = groups_by_force([(r["doc_id"], r["text"]) for r in clean], 5)
    assert {r["doc_id"] for r in deduped} == {i for i, c in comp.items() if c == i} and len(deduped) < len(clean)
    # masks stand where a live base secret stood, and nowhere else
    find = {k: re.compile(p) for k, p in (("assign", secret_scan.ASSIGN), ("access", "AKIA[A-Z0-9]{12,}"), ("hex", "[0-9a-f]{32,}"))}
    value = re.compile("^" + secret_scan.ASSIGN_HEAD)
    owners, repos = collections.defaultdict(set), collections.defaultdict(set)
    spans = collections.defaultdict(list)
    for r in deduped:
        for k, p in find.items():
            for m in p.finditer(r["text"]):
                v = value.sub("", m.group()) if k == "assign" else m.group()
                if k != "assign" or len(v) >= 8:
                    owners[v].add(r["source"])
                    repos[v].add((r["source"], r["lang"]))
                    spans[r["doc_id"]].append((m.start(), m.end(), v))
    for r, m in zip(sorted(deduped, key=lambda r: r["doc_id"]), sorted(masked, key=lambda r: r["doc_id"])):
        live = sorted((a, b) for a, b, v in spans[r["doc_id"]] if len(owners[v]) < secret_scan.MIN_OWNERS and len(repos[v]) < secret_scan.MIN_REPOS)
        t, at, parts = r["text"], 0, []
        for a, b in live:
            if a >= at:
                parts += [t[at:a], "[SECRET]"]
            at = max(at, b)
        assert m["text"] == "".join(parts) + t[at:] and m["n_chars"] == len(m["text"])
    sizes, target = mix_by_force([(r["doc_id"], r["text"], None, r["source"]) for r in masked])
    took = collections.Counter()
    before = {r["doc_id"]: r["text"] for r in masked}
    for r in mixed:
        took[r["source"]] += len(WORD.findall(r["text"]))
        assert before[r["doc_id"]].startswith(r["text"])
    assert all(took[s] == int(target[s] + 1e-9) for s in sizes)
    assert max(collections.Counter(r["doc_id"] for r in mixed).values()) <= 2
    import tiktoken
    ranks = bpe.tables(P.path("byte_bpe_multi_50k.tiktoken"))[1].ids
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = collections.Counter()
    for r in mixed:
        x = np.array(enc.encode_ordinary(r["text"]), "<u4").tobytes()
        want[r["doc_id"], x, hashlib.sha256(r["text"].encode()).hexdigest()] += 1
    assert collections.Counter((r["doc_id"], bytes(r["ids"]), r["decoded_sha256"]) for r in ids) == want


def test_run_equals_its_stages(spark, stages):
    got = collections.Counter((r["doc_id"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, SF_SMALL).collect())
    assert got == collections.Counter((r["doc_id"], r["ids_sha256"]) for r in stages[0][-1])


def test_pipeline_on_edges(spark, make, tmp_path):
    from tests.llm.conftest import EDGES
    for name, rows in (("edges", EDGES), ("none", [])):
        d = f"{tmp_path}/{name}"
        make(rows).write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame([(1, 1, 1), (4, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
        assert corpus_pipeline.run(spark, d).count() >= 0


def test_registered_queries(spark):
    qs, sql = E.queries(), E.oracle_sql()
    assert {re.match(r"op(\d+)_", q)[1] for q in qs if q.startswith("op")} == {str(n) for n in range(1, 14)} and "pipeline" in qs
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    n = con.sql("select count(*) from documents").fetchall()[0][0]
    for q in sorted(queries.QUERIES):
        got = qs[q](spark, SF_SMALL).toPandas()
        assert len(got) == n or q == "op12_sliced_search" and len(got) == 10 * con.sql("select count(distinct item_id) from benchmark").fetchall()[0][0], q
        if q in sql:
            assert digest(got) == digest(con.sql(sql[q]).df()), q
