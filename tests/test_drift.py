from pyspark.sql import functions as F

from tidemark.operators import drift
from tidemark.plans.drift_report import drift_report

OBJ = "category string, name string, definition string, relative_path string"
COLS = "name string, column_name string, ordinal bigint, type_sql string, definition string"


def _objs(spark, rows):
    return spark.createDataFrame(rows, OBJ)


def _status(df):
    return {(r.category, r.name): r.status for r in df.collect()}


BASE = [("tables", "dbo.a", "CREATE TABLE a (x INT)", "tables/dbo.a.sql"),
        ("tables", "dbo.b", "CREATE TABLE b (y INT)", "tables/dbo.b.sql"),
        ("views", "dbo.v", "CREATE VIEW v AS SELECT 1", "views/dbo.v.sql"),
        ("views", "dbo.n", None, "views/dbo.n.sql")]


def test_self_drift_is_empty(spark):
    a = _objs(spark, BASE)
    s = _status(drift.object_drift(a, a))
    assert set(s.values()) == {"unchanged"}


def test_added_removed_modified_and_swap(spark):
    left = _objs(spark, BASE)
    right = _objs(spark, [
        ("tables", "dbo.a", "create   table a (x INT) -- reviewed\n/* note */", "tables/dbo.a.sql"),
        ("tables", "dbo.c", "CREATE TABLE c (z INT)", "tables/dbo.c.sql"),
        ("views", "dbo.v", "CREATE VIEW v AS SELECT 2", "views/dbo.v.sql"),
        ("views", "dbo.n", None, "views/dbo.n.sql")])
    s = _status(drift.object_drift(left, right))
    assert s == {("tables", "dbo.a"): "unchanged", ("tables", "dbo.b"): "removed",
                 ("tables", "dbo.c"): "added", ("views", "dbo.v"): "modified",
                 ("views", "dbo.n"): "unchanged"}
    swapped = _status(drift.object_drift(right, left))
    flip = {"added": "removed", "removed": "added"}
    assert swapped == {k: flip.get(v, v) for k, v in s.items()}


def test_summary_zero_fill_verdict_and_recommendations(spark):
    left = _objs(spark, BASE)
    right = _objs(spark, BASE[:1] + [("tables", "dbo.b", "CREATE TABLE b (y BIGINT)", None)])
    d = drift.object_drift(left, right)
    summ = {r.category: r for r in drift.drift_summary(d, ["tables", "views", "procedures"]).collect()}
    assert (summ["tables"].modified, summ["tables"].unchanged) == (1, 1)
    assert summ["views"].removed == 2 and summ["procedures"].drifted == 0
    v = drift.drift_verdict(d).first()
    assert v.has_drift and v.total_drifted == 3
    recs = [(r.action, r.objects) for r in drift.recommendations(d).orderBy("seq").collect()]
    assert recs == [("update_baseline", 3), ("migrate_live", 3), ("review_table_text", 1)]
    same = drift.object_drift(left, left)
    assert [r.action for r in drift.recommendations(same).collect()] == ["aligned"]


def test_unlisted_category_is_counted(spark):
    left = _objs(spark, [("functions", "f", "a", None)])
    right = _objs(spark, [("functions", "f", "b", None)])
    d = drift.object_drift(left, right)
    summary = {r.category: r.drifted for r in drift.drift_summary(d, ["tables", "views"]).collect()}
    assert summary == {"functions": 1, "tables": 0, "views": 0}
    assert drift.drift_verdict(d).first().has_drift
    rep = drift_report(left, right)
    assert rep["verdict"].first().has_drift
    assert {r.category: r.drifted for r in rep["summary"].collect()}["functions"] == 1


def test_column_and_table_drift(spark):
    lc = spark.createDataFrame([
        ("t1", "a", 1, "INT", "INT NOT NULL"), ("t1", "b", 2, "NVARCHAR(10)", "NVARCHAR(10) NULL"),
        ("t2", "a", 1, "INT", "INT NOT NULL"), ("t3", "a", 1, "INT", "INT NULL"),
        ("t4", "a", 1, "INT", "INT NULL")], COLS)
    rc = spark.createDataFrame([
        ("t1", "a", 1, "BIGINT", "BIGINT NOT NULL"), ("t1", "c", 3, "DATE", "DATE NULL"),
        ("t2", "a", 1, "int", "int NULL"), ("t3", "a", 1, "INT", "INT NULL"),
        ("t5", "a", 1, "INT", "INT NULL")], COLS)
    tables = drift.table_drift(lc, rc)
    col_drift = drift.column_drift(lc, rc, tables.filter("status = 'modified'"))
    cd = {(r.name, r.column_name): (r.status, r.left_type, r.right_type) for r in col_drift.collect()}
    # t4 is only removed and t5 only added: they have no column differences
    assert cd == {("t1", "a"): ("type_changed", "INT", "BIGINT"), ("t1", "b"): ("removed", "NVARCHAR(10)", None),
                  ("t1", "c"): ("added", None, "DATE")}
    objects = tables.select(F.lit("tables").alias("category"), "name", "status")
    listed = {r.name: [(c.column_name, c.status) for c in r.column_differences]
              for r in drift.with_column_differences(objects, col_drift).collect()}
    assert listed["t1"] == [("a", "type_changed"), ("b", "removed"), ("c", "added")] and listed["t4"] == []
    td = {r.name: r for r in tables.collect()}
    assert td["t1"].status == "modified" and td["t1"].n_column_differences == 3
    # nullability only: modified without a column difference, second detail line
    assert td["t2"].status == "modified" and td["t2"].n_column_differences == 0
    assert td["t2"].details.endswith(drift.SAME_COLUMNS)
    assert td["t3"].status == "unchanged" and td["t4"].status == "removed" and td["t5"].status == "added"


def test_ignore_patterns_four_spellings(spark):
    objs = _objs(spark, BASE)
    for pats, expect in [(["dbo.a"], {"dbo.a"}), (["TABLES:dbo.b"], {"dbo.b"}),
                         (["view:*"], {"dbo.v", "dbo.n"}), (["tables/dbo.?.sql"], {"dbo.a", "dbo.b"}),
                         (["[!t]*:dbo.v"], {"dbo.v"})]:
        kept, ignored = drift.split_ignored(objs, pats)
        assert {r.name for r in ignored.collect()} == expect
        assert kept.count() + ignored.count() == 4


def test_raw_hash_diff_sees_comment_changes(spark):
    left = _objs(spark, BASE).withColumn("sha256", F.sha2("definition", 256))
    right = _objs(spark, [BASE[0][:2] + (BASE[0][2] + " -- c", None)]).withColumn("sha256", F.sha2("definition", 256))
    got = {(r.name, r.status) for r in drift.raw_hash_diff(left, right).collect()}
    assert got == {("dbo.a", "modified"), ("dbo.b", "removed"), ("dbo.v", "removed"), ("dbo.n", "removed")}


def test_report_plan(spark):
    left = _objs(spark, BASE)
    right = _objs(spark, BASE[:2] + [("views", "dbo.v", "CREATE VIEW v AS SELECT 3", None)])
    lc = spark.createDataFrame([("dbo.a", "x", 1, "INT", "INT NULL")], COLS)
    rc = spark.createDataFrame([("dbo.a", "x", 1, "INT", "INT NULL")], COLS)
    rep = drift_report(left, right, lc, rc, ignore="views:dbo.n")
    assert {r.name for r in rep["ignored"].collect()} == {"dbo.n"}
    assert rep["verdict"].first().total_drifted == 1
    assert rep["columns"].count() == 0


def test_ignore_globs_as_a_table(spark):
    import random
    rnd = random.Random(12)
    cats = ["tables", "views", "procedures", "odd"]
    word = lambda chars, a, b: "".join(rnd.choice(chars) for _ in range(rnd.randint(a, b)))
    objs = [(rnd.choice(cats), word("abAB.[]", 1, 6), rnd.choice([None, "tables\\\\a.sql", "views/" + word("ab", 1, 3)]))
            for _ in range(120)]
    objs = list({(c, n): (c, n, p) for c, n, p in objs}.values())
    globs = [word("abAB.*?[]!-:", 1, 6) for _ in range(150)] + ["table:a*", "VIEWS:*b", "*", "  a* ", "", "tables/a.*", "*a*",
                                                                  "tables:aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa*"]
    df = spark.createDataFrame(objs, "category string, name string, relative_path string")
    for some in (globs, [g for g in globs if "*" not in g], globs[:40], []):
        table = spark.createDataFrame([(g,) for g in some], "pattern string")
        _, ignored = drift.split_ignored(df, [g.strip() for g in some if g.strip()])
        want = {(r.category, r.name) for r in ignored.collect()}
        assert {(r.category, r.name) for r in drift.ignored_by(df, table).collect()} == want
    plan = drift.ignored_by(df, spark.createDataFrame([("a*",)], "pattern string"))._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_report_rank(spark):
    df = spark.createDataFrame([("t", 1, "b"), ("t", 0, "z"), ("t", 1, "A"), ("s", 3, "q")],
                               "category string, status_rank int, name string")
    got = [r.name for r in drift.with_report_rank(df).orderBy("report_rank").collect()]
    assert got == [r.name for r in drift.report_order(df).collect()] == ["q", "z", "A", "b"]


def test_columns_digest_decides_the_second_detail(spark):
    schema = "category string, name string, definition string, relative_path string, columns_sha256 string"
    left = spark.createDataFrame([("tables", "a", "x NULL", None, "1"), ("tables", "b", "y", None, "2"),
                                  ("views", "c", "z", None, "3")], schema)
    right = spark.createDataFrame([("tables", "a", "x", None, "1"), ("tables", "b", "yy", None, "9"),
                                   ("views", "c", "zz", None, "3")], schema)
    got = {r.name: r.details for r in drift.object_drift(left, right).collect()}
    assert got == {"a": "changed_text; same_columns", "b": "changed_text", "c": "changed_text"}


def test_column_drift_needs_one_join_and_two_scans_a_side(spark):
    from tidemark.plans import queries as Q
    from tidemark.plans.mapping import baseline_columns, live_columns
    sf = "/root/testdata/sf0.001"
    df = drift.column_drift(baseline_columns(spark, sf), live_columns(spark, sf))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FullOuter") == 1 and plan.count("LeftSemi") == 1
    assert plan.count("Location") <= 6  # the live side is made of two tables
    whole = Q.QUERIES["catalog_drift"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert whole.count("FullOuter") == 1 and whole.count("Location") == 2 and "LeftSemi" not in whole
