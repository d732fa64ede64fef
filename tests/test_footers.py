import pytest
from pyspark.sql import functions as F

from tidemark.operators import footers


@pytest.fixture()
def path(spark, scratch_dir):
    rows = [(i, i % 7 - 3, None, float("nan") if i == 5 else 1.0, "x" * i) for i in range(100)]
    spark.createDataFrame(rows, "a long, b int, c int, d double, e string").repartition(3).write.parquet(f"{scratch_dir}/t")
    return f"{scratch_dir}/t"


def test_counts_and_bounds_come_from_footers(spark, path):
    session = footers.footer_session(spark)
    df = footers.footer_bounds(session, path, ["a", "b"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(a), MAX(a), MIN(b), MAX(b)]" in plan
    assert tuple(df.first()) == (100, 0, 99, -3, 3)
    assert footers.footer_counts(spark, {"t": path}).first().row_count == 100
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's session is as it was


def test_settled_ranges(spark, path):
    ranges = [("t", "a", 0, 99), ("t", "a", 0, 98), ("t", "b", -3, 3), ("t", "b", -2, 9), ("t", "c", 5, 6), ("t", "d", 0, 2),
              ("t", "e", 0, 1), ("t", "gone", 0, 1)]
    got = {(r.column_name, r.low, r.high): r.settled for r in footers.settled_ranges(spark, {"t": path}, ranges).collect()}
    assert got == {("a", 0, 99): True, ("a", 0, 98): False, ("b", -3, 3): True, ("b", -2, 9): False, ("c", 5, 6): True,
                   ("d", 0, 2): False, ("e", 0, 1): False, ("gone", 0, 1): False}
    whole = spark.read.parquet(path)
    for (c, low, high), settled in got.items():
        if settled:
            assert whole.filter(F.col(c).isNotNull() & ~F.col(c).between(low, high)).count() == 0


def test_files_without_statistics_are_scanned(spark, scratch_dir):
    import pyarrow as pa
    import pyarrow.parquet as pq
    pq.write_table(pa.table({"a": pa.array([3, 4, 5], pa.int64())}), f"{scratch_dir}/plain.parquet", write_statistics=False)
    row = footers.settled_ranges(spark, {"t": f"{scratch_dir}/plain.parquet"}, [("t", "a", 3, 5)]).first()
    assert (row.least, row.most, row.settled) == (3, 5, True)


def test_empty_table(spark, scratch_dir):
    spark.createDataFrame([], "a long").write.parquet(f"{scratch_dir}/none")
    row = footers.settled_ranges(spark, {"t": f"{scratch_dir}/none"}, [("t", "a", 3, 5)]).first()
    assert (row.least, row.settled) == (None, True)
    assert footers.footer_counts(spark, {"t": f"{scratch_dir}/none"}).first().row_count == 0
