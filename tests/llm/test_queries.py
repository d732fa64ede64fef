"""The registered queries against their SQL, and the pipeline against its stages."""

import importlib.util
import sys

import duckdb
import pytest

import __spark_entry__ as E
from tidemark.llm import queries as Q

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    names = list(E.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(Q.ORACLE_SQL) <= set(names)


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.sql(Q.ORACLE_SQL[name])
    df = Q.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(rel.columns)
    order = [rel.columns.index(c) for c in df.columns]
    show = lambda r: tuple(round(x, 9) if isinstance(x, float) else x for x in r)
    assert sorted(map(str, map(show, df.collect()))) == sorted(str(show(r[i] for i in order)) for r in rel.fetchall())


def test_pipeline_stages(spark):
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in P.STAGES]
    assert len(names) == 5 and P.ORACLE_SQL is None
    kept = {}
    for name, stage in P.STAGES:
        docs = P.written(stage(spark, docs, SF), "test-stage").cache()
        kept[name] = docs
        if name != names[-1]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    all_docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    accepted = {r.doc_id: r for r in kept[names[0]].collect()}
    predicted = {r.doc_id: r.predicted for r in Q.op1_quality(spark, SF).collect()}
    assert set(accepted) == {d for d, p in predicted.items() if p} < set(all_docs)
    from test_text_dedup import slow_lines
    clean = {r.doc_id: r for r in kept[names[1]].collect()}
    want = slow_lines({d: r.text for d, r in accepted.items()})
    assert {d: r.text for d, r in clean.items()} == want and all(r.n_chars == len(r.text) for r in clean.values())
    from test_simhash import roots, slow_print
    prints = {d: slow_print(t, 4) for d, t in want.items()}
    groups = roots(sorted(prints), lambda a, b: bin(prints[a] ^ prints[b]).count("1") <= 4)
    unique = {r.doc_id for r in kept[names[2]].collect()}
    assert unique == set(groups.values())
    mixed = [r.doc_id for r in kept[names[3]].collect()]
    assert set(mixed) <= unique
    pieces = kept[names[4]].collect()
    assert sorted(r.doc_id for r in pieces if r.start == 0) == sorted(mixed)


def test_other_queries_stand_without_the_subpackage(monkeypatch):
    for name in [m for m in sys.modules if m == "tidemark.llm" or m.startswith("tidemark.llm.")]:
        monkeypatch.delitem(sys.modules, name)
    real = importlib.util.find_spec
    import tidemark
    monkeypatch.delattr(tidemark, "llm", raising=False)
    monkeypatch.setitem(sys.modules, "tidemark.llm", None)
    monkeypatch.setattr(importlib.util, "find_spec", lambda n, *a: None if n == "tidemark.llm" else real(n, *a))
    assert not any(x.startswith("op1_") or x == "pipeline" for x in E.queries())
    assert E.queries() and E.oracle_sql()
