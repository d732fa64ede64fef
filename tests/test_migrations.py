import datetime as dt
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import migrations as MG
from tidemark.plans import datacenter as DC
from tidemark.plans.migration_plan import plan, record
from tidemark.plans.validation import report, validate_catalog

FILES = "file_name string"


def test_parse_order_and_twins(spark):
    names = ["v10_late.sql", "v9_early.sql", "v2_add-cols.sql", "v2_add-cols.py", "notes.sql", "V3_bad.sql",
             "v4_x.txt", "v0011_padded.sql", "v99999999999999999999_far.sql"]
    df = spark.createDataFrame([(n,) for n in names], FILES)
    found = MG.run_order(MG.discover(df, "sql")).collect()
    assert [r.file_name for r in found] == ["v2_add-cols.sql", "v9_early.sql", "v10_late.sql", "v0011_padded.sql"]
    assert found[0].migration_id == "v2_add-cols" and found[-1].version == 11
    py = MG.discover(df, "pyspark").collect()
    assert [r.migration_id for r in py] == ["v2_add-cols"]  # twin of the .sql file: same id
    # a version beyond a bigint is reported, not lost
    assert sorted(r.file_name for r in MG.skipped(df, "sql").collect()) == [
        "V3_bad.sql", "notes.sql", "v99999999999999999999_far.sql"]


def test_pending_ignores_failed_runs(spark):
    files = MG.discover(spark.createDataFrame([("v1_a.sql",), ("v2_b.sql",), ("v3_c.sql",)], FILES), "sql")
    hist = spark.createDataFrame([("v1_a", "success"), ("v2_b", "failed"), ("v2_b", "failed"), ("v1_a", "success")],
                                 "migration_id string, status string")
    assert sorted(r.migration_id for r in MG.pending(files, hist).collect()) == ["v2_b", "v3_c"]
    assert MG.pending(files, None).count() == 3


def test_evolve_is_additive_and_idempotent(spark):
    df = spark.createDataFrame([(1, "a")], "id int, Name string")
    target = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()),
                           T.StructField("extra", T.DoubleType())])
    once = MG.evolve(df, target)
    twice = MG.evolve(once, target)
    assert once.columns == ["id", "Name", "extra"] and twice.columns == once.columns
    assert once.schema["extra"].dataType == T.DoubleType() and once.first().extra is None


def test_seed_missing(spark):
    target = spark.createDataFrame([(1, "x")], "k int, v string")
    seed = spark.createDataFrame([(1, "y"), (2, "z")], "k int, v string")
    assert [r.k for r in MG.seed_missing(target, seed, ["k"]).collect()] == [2]


def test_domain_end_to_end(spark, scratch_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS dc_e2e")
    spark.catalog.setCurrentDatabase("dc_e2e")
    try:
        at = dt.datetime(2026, 3, 12, 9, 0)
        scripts = os.path.join(scratch_dir, "migrations")
        os.makedirs(scripts)
        for name in ("v001_baseline_tables.sql", "v002_capacity.sql"):
            with open(os.path.join(scripts, name), "w") as fh:
                fh.write("CREATE TABLE IF NOT EXISTS x (a INT);\n")
        todo = plan(spark, scripts)
        assert [r.migration_id for r in todo.collect()] == ["v001_baseline_tables", "v002_capacity"]

        DC.apply_version(spark, 1)
        record(spark, todo.filter(F.col("version") == 1), "success", "tester", at)
        res = validate_catalog(spark, DC.contract_rows(), DC.RULES, "v001")
        summary = {r.category: (r.passed, r.total) for r in report(res)[0].collect()}
        assert summary["tables"] == (3, 3) and summary["columns"] == (25, 25)
        assert summary["migration"] == (2, 2)
        assert summary["rows"] == (3, 3)

        # failed run of v002 is logged, stays pending
        record(spark, todo.filter(F.col("version") == 2), "failed", "tester", at)
        assert [r.migration_id for r in plan(spark, scripts).collect()] == ["v002_capacity"]

        DC.apply_version(spark, 2)
        DC.apply_version(spark, 2)  # idempotent
        record(spark, plan(spark, scripts), "success", "tester", at)
        assert plan(spark, scripts).count() == 0
        res = validate_catalog(spark, DC.contract_rows(), DC.RULES, "v002")
        summary, verdict = report(res)
        s = {r.category: (r.passed, r.total) for r in summary.collect()}
        assert s["tables"] == (5, 5) and s["columns"] == (45, 45) and s["migration"] == (3, 3)
        assert verdict.first().result == "PASS"
        # old power rows read the new columns as NULL; seed counts are unchanged
        p = spark.table("power_consumption")
        assert p.count() == 5 and p.filter(F.col("renewable_pct").isNull()).count() == 5
        # at v001 only the three tables of v001 are read, though five exist
        old = {r.category: r.total for r in report(validate_catalog(spark, DC.contract_rows(), DC.RULES, "v001"))[0]
               .collect()}
        assert old["rows"] == 3 and old["data"] == 7 and old["tables"] == 3
        # strict history: only successful ids count
        strict = validate_catalog(spark, DC.contract_rows(), DC.RULES, "v002", strict_history=True)
        assert report(strict)[1].first().result == "PASS"
        # the seed's last power row does not add up (a cross-column rule catches it)
        from tidemark.operators.integrity import expression_agreement
        got = {r.rule: r.violations for r in
               expression_agreement(p, "power_consumption", DC.AGREEMENT["power_consumption"]).collect()}
        assert got["parts_sum_to_total"] == 1
        inc = expression_agreement(spark.table("sla_incidents"), "sla_incidents", DC.AGREEMENT["sla_incidents"])
        assert inc.first().violations == 0 and inc.first().checked_rows == 4
    finally:
        spark.catalog.setCurrentDatabase("default")


def test_comments_and_qualified_names_are_quoted(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS odd_db")
    name = "odd_db.quoted"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    first = T.StructType([T.StructField("a", T.IntegerType(), True, {"comment": "it's \\ here"})])
    MG.ensure_table(spark, name, first, comment="the owner's")
    wider = T.StructType(first.fields + [T.StructField("b`c", T.StringType(), True, {"comment": "don't"})])
    assert MG.add_missing_columns_table(spark, name, wider) == ["b`c"]
    assert MG.add_missing_columns_table(spark, name, wider) == []
    comments = {c.name: c.description for c in spark.catalog.listColumns(name)}
    assert comments == {"a": "it's \\ here", "b`c": "don't"}
    rows = spark.createDataFrame([("v1_a", "v1_a.sql", "sql")], "migration_id string, file_name string, migration_type string")
    who = MG.history_rows(rows, "success", None, dt.datetime(2026, 1, 1)).first().applied_by
    assert who == spark.sql("SELECT current_user()").first()[0]


def test_validation_reports_missing_table_and_column(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS dc_bad")
    spark.catalog.setCurrentDatabase("dc_bad")
    try:
        DC.apply_version(spark, 1)
        res = validate_catalog(spark, DC.contract_rows(), DC.RULES, "v002")
        summary, verdict = report(res)
        s = {r.category: r for r in summary.collect()}
        assert (s["tables"].passed, s["tables"].total) == (3, 5)
        # missing tables skip their column checks; two v002 columns of power are missing
        assert (s["columns"].passed, s["columns"].total) == (25, 27)
        assert "found missing" in s["columns"].failures
        assert s["migration"].passed == 0
        v = verdict.first()
        assert v.result == "FAIL"
    finally:
        spark.catalog.setCurrentDatabase("default")


def outcomes(spark, rows):
    return spark.createDataFrame([(*r, "f") for r in rows], "version long, migration_id string, status string, file_name string")


def test_a_run_stops_at_its_first_failure(spark):
    rows = [(2, "v2_b", "success"), (10, "v10_x", "failed"), (9, "v9_a", "failed"), (9, "v9_b", "success"), (1, "v1", "success"),
            (10, "v10_a", "success")]
    got = {r.migration_id: r.state for r in MG.until_first_failure(outcomes(spark, rows)).collect()}
    assert got == {"v1": "success", "v2_b": "success", "v9_a": "failed", "v9_b": "pending", "v10_x": "pending",
                   "v10_a": "pending"}
    fine = outcomes(spark, rows[:1] + rows[3:])
    assert {r.state for r in MG.until_first_failure(fine).collect()} == {"success"}
    assert MG.until_first_failure(outcomes(spark, [])).count() == 0
    plan = MG.until_first_failure(outcomes(spark, rows))._jdf.queryExecution().toString()
    assert "Sort [" not in plan.split("== Physical Plan ==")[1]


def test_append_of_a_run_twice_leaves_one_row_a_script(spark, scratch_dir):
    folder = os.path.join(scratch_dir, "runs")
    runs = spark.createDataFrame([("v1_a", "v1_a.sql", "sql"), ("v2_b", "v2_b.sql", "sql")],
                                 "migration_id string, file_name string, migration_type string")
    rows = MG.history_rows(runs, "success", "me", dt.datetime(2030, 1, 2))
    MG.append_run(rows, "r1", folder)
    MG.append_run(rows, "r1", folder)
    MG.append_run(rows.limit(1), "r2", folder)
    got = sorted((r.run_id, r.migration_id) for r in MG.read_runs(spark, folder).collect())
    assert got[:2] == [("r1", "v1_a"), ("r1", "v2_b")] and len(got) == 3
    # a run repeated with another outcome replaces its own rows only
    MG.append_run(MG.history_rows(runs, "failed", "me", dt.datetime(2030, 1, 2)), "r1", folder)
    assert {r.status for r in MG.read_runs(spark, folder).filter("run_id = 'r1'").collect()} == {"failed"}
    assert MG.read_runs(spark, folder).filter("run_id = 'r2'").first().status == "success"
    assert MG.applied_ids(MG.read_runs(spark, folder)).count() == 1


def test_run_rank(spark):
    rows = [(10, "v10_a"), (9, "v9_b"), (9, "v9_a"), (0, "v0")]
    df = spark.createDataFrame(rows, "version long, migration_id string")
    got = {r.migration_id: r.run_rank for r in MG.with_run_rank(df).collect()}
    assert got == {"v0": 1, "v9_a": 2, "v9_b": 3, "v10_a": 4}
    assert [r.migration_id for r in MG.run_order(df).collect()] == sorted(got, key=got.get)
