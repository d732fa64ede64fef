import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.names import unused
from tidemark.operators.integrity import version_gaps
from tidemark.operators.ordering import numbered_in_order, with_previous


def test_unused_names():
    assert unused(["A", "b_"], "a", "b", "b", "c") == ["a_", "b", "b__", "c"]


def test_numbers_follow_the_order(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["x", None, "y", "Z"]), rnd.randint(-5, 5), i) for i in range(500)]
    df = spark.createDataFrame(rows, "part string, v int, at int")  # names that the operator uses itself
    out = numbered_in_order(df, [F.col("part").asc_nulls_last(), F.col("v").desc(), "at"], "n").collect()
    assert [f for f in out[0].asDict()] == ["part", "v", "at", "n"]
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or "", -r[1], r[2]))
    assert [tuple(r)[:3] for r in sorted(out, key=lambda r: r.n)] == want
    assert sorted(r.n for r in out) == list(range(1, 501))


def test_ties_and_empty_tables(spark):
    df = spark.createDataFrame([(7,)] * 40, "v int")
    assert sorted(r.n for r in numbered_in_order(df, ["v"], "n", 0).collect()) == list(range(40))
    assert numbered_in_order(df.limit(0), ["v"], "n").count() == 0
    assert with_previous(df.limit(0), "v", "before").count() == 0


def test_previous_value_across_ranges(spark):
    values = sorted(random.Random(4).sample(range(10 ** 12), 300))
    rows = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = sorted((r.v, r.before) for r in with_previous(rows, "v", "before").collect())
    assert got == list(zip(values, [None, *values]))


@pytest.mark.parametrize("versions", [[], [1], [5], [3, 1, 7, 7, 2, 10 ** 15], list(range(2, 400, 2))])
def test_gaps(spark, versions):
    df = spark.createDataFrame([(v,) for v in [*versions, 0, None]], "version bigint")
    want, last = [], 0
    for v in sorted(set(versions)):
        if v > last + 1:
            want.append((last + 1, v - 1))
        last = v
    gaps = version_gaps(df)
    assert sorted(tuple(r) for r in gaps.collect()) == want
    assert "Window [" not in gaps._jdf.queryExecution().toString() or "SinglePartition" not in gaps._jdf.queryExecution().toString()
