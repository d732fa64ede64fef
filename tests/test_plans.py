"""Plan shape of every registered query: no cartesian or nested-loop join,
no Python evaluation, pruned scans."""

import re

import pytest

from tidemark.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow")


_PLANS: dict[str, str] = {}


def _plan(spark, name):
    """The query's plan, built once: some queries write tables while they are built."""
    if name not in _PLANS:
        _PLANS[name] = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    return _PLANS[name]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_cross_join_or_python(spark, name):
    plan = _plan(spark, name)
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"


def test_every_query_reads_a_table(spark):
    for name in sorted(QUERIES):
        plan = _plan(spark, name)
        assert "FileScan parquet" in plan or "BatchScan parquet" in plan, name


def test_scans_are_pruned(spark):
    plan = _plan(spark, "row_counts")
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert len(schemas) == 14 and set(schemas) == {"struct<>"} and "Join" not in plan
    keys = {"r_regionkey", "n_nationkey", "n_regionkey", "c_custkey", "c_nationkey", "s_suppkey", "s_nationkey",
            "p_partkey", "o_orderkey", "o_custkey", "l_orderkey", "l_partkey", "l_suppkey", "event_id", "user_id",
            "doc_id", "quality", "toxic", "conv_id", "turn", "page_id", "item_id", "vec_id"}
    read = {c.split(":")[0] for s in re.findall(r"ReadSchema: struct<([^>]*)>", _plan(spark, "null_counts"))
            for c in s.split(",") if c}
    assert read == keys
    lines = _plan(spark, "range_violation_rows")
    assert "IsNotNull(c_acctbal)" in lines


def test_scan_counts(spark):
    assert _plan(spark, "fk_orphans").count("l_orderkey") > 0
    files = re.findall(r"FileScan parquet \[([^\]]*)\]", _plan(spark, "fk_orphans"))
    assert sum("l_suppkey" in f for f in files) == 1
    assert _plan(spark, "bundle_hash").count("FileScan parquet") == 1
    assert _plan(spark, "keyed_columns").count("FileScan parquet") == 2
    assert _plan(spark, "version_gaps").count("FileScan parquet") <= 4
