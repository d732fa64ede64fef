import math

from tidemark.operators import checks
from tidemark.operators.checks import RangeRule, TableRules


def _rows(df):
    return {(r.check_name, r.subject): r for r in df.collect()}


def test_range_is_closed_null_passes_nan_fails(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,), (0.99,), (3.01,), (float("nan"),), (2.0,)], "pue double")
    r = _rows(checks.table_checks(df, TableRules("p", (), (RangeRule("pue", 1.0, 3.0),))))
    rng = r[("range [1, 3]", "pue")]
    assert rng.observed == 3 and not rng.passed and rng.severity == "error"
    assert rng.message == "`p.pue` range [1, 3] -> 3 invalid rows"


def test_nulls_and_row_count(spark):
    df = spark.createDataFrame([("a", None), (None, "x"), ("c", "y")], "id string, fk string")
    r = _rows(checks.table_checks(df, TableRules("t", ("ID", "fk", "absent"))))
    assert r[("row_count", "t")].observed == 3 and r[("row_count", "t")].passed
    assert r[("null_key", "id")].observed == 1
    assert r[("null_key", "fk")].observed == 1
    assert ("null_key", "absent") not in r  # absent key column: skipped, not failed


def test_empty_table_is_warning_not_failure(spark):
    df = spark.createDataFrame([], "id string")
    r = _rows(checks.table_checks(df, TableRules("t", ("id",))))
    assert r[("row_count", "t")].severity == "warning" and r[("row_count", "t")].passed
    v = checks.verdict(checks.table_checks(df, TableRules("t", ("id",)))).first()
    assert v.result == "PASS" and v.warnings == 1


def test_one_scan_per_table(spark, scratch_dir):
    spark.range(100).selectExpr("id", "id % 7 AS v").write.parquet(f"{scratch_dir}/a")
    spark.range(50).selectExpr("id", "CAST(id AS DOUBLE) AS w").write.parquet(f"{scratch_dir}/b")
    a, b = spark.read.parquet(f"{scratch_dir}/a"), spark.read.parquet(f"{scratch_dir}/b")
    res = checks.fused_checks({"a": a, "b": b}, [
        TableRules("a", ("id", "v"), (RangeRule("v", 0, 5),)),
        TableRules("b", ("id",), (RangeRule("w", 0, 10), RangeRule("id", None, 40)))])
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
    got = {(r.table_name, r.check_name, r.subject): r.observed for r in res.collect()}
    assert got[("a", "range [0, 5]", "v")] == 14
    assert got[("b", "range [0, 10]", "w")] == 39
    assert got[("b", "range [-inf, 40]", "id")] == 9


def test_summary_and_verdict(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "k int, v int")
    res = checks.table_checks(df, TableRules("t", ("k", "v"), (RangeRule("v", 0, 4),)))
    s = {r.category: r for r in checks.check_summary(res).collect()}
    assert s["data"].total == 3 and s["data"].passed == 1
    assert s["data"].failures == ("`t.v` null check -> 1 null rows; `t.v` range [0, 4] -> 1 invalid rows")
    v = checks.verdict(res).first()
    assert v.result == "FAIL" and v.failed == 2
    try:
        checks.assert_passed(res, "Dev")
        raise AssertionError("expected failure")
    except checks.ValidationFailed as e:
        assert "Dev" in str(e) and "null check" in str(e)


def test_violation_rows(spark):
    df = spark.createDataFrame([(1, -1.0), (2, 5.0), (3, None), (4, 11.0)], "id int, x double")
    rows = checks.range_violation_rows(df, "t", [RangeRule("x", 0.0, 10.0)], ["id"]).collect()
    assert sorted((r.id, r.reason) for r in rows) == [(1, "below"), (4, "above")]
    assert not any(math.isnan(r.value) for r in rows)


def test_conformance_extra_alias_and_case(spark):
    from tidemark.operators import contracts
    from tidemark.sources.catalog import actual_columns, available_tables
    t = {"Sites": spark.createDataFrame([(1, "a", True, 2.0)], "ID int, Name string, Active boolean, Extra double")}
    contract = contracts.contract_frame(spark, [("SITES", "id", "INTEGER", 1), ("sites", "NAME", "string", 1),
                                                ("sites", "active", "bool", 1), ("sites", "missing_col", "date", 1),
                                                ("gone", "x", "int", 1)])
    res = contracts.column_conformance(contract, actual_columns(spark, t), available_tables(spark, t))
    got = {r.subject: (r.passed, r.message) for r in res.collect()}
    assert got["id"][0] and got["name"][0] and got["active"][0]
    assert got["missing_col"] == (False, "`sites.missing_col` -> expected date, found missing")
    assert "extra" not in got and "x" not in got  # extra column ignored; missing table skipped
    pres = {r.subject: r.passed for r in contracts.table_presence(contract, available_tables(spark, t)).collect()}
    assert pres == {"sites": True, "gone": False}
