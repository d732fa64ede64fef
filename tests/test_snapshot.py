import os

import pytest

from pyspark.sql import types as T

from tidemark.operators import assembly, render
from tidemark.operators.migrations import ensure_table
from tidemark.plans import snapshot
from tidemark.sources import catalog, corpus


def test_export_and_compare_catalog(spark, scratch_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS snap_cat")
    spark.catalog.setCurrentDatabase("snap_cat")
    try:
        spark.sql("CREATE TABLE t1 (a INT NOT NULL, b STRING) USING parquet")
        spark.sql("CREATE TABLE t2 (x DECIMAL(10,2), y TIMESTAMP) USING parquet")
        spark.sql("CREATE VIEW v1 AS SELECT a FROM t1")
        left = os.path.join(scratch_dir, "left")
        arts = snapshot.artifacts_of(spark, "snap_cat")
        snapshot.write(arts, left)
        rep = snapshot.compare(spark, left, left)
        assert rep["verdict"].first().total_drifted == 0

        spark.sql("ALTER TABLE t1 ADD COLUMNS (c DOUBLE)")
        spark.sql("DROP TABLE t2")
        spark.sql("CREATE TABLE t3 (z INT) USING parquet")
        spark.sql("CREATE OR REPLACE VIEW v1 AS SELECT a, b FROM t1")
        right = os.path.join(scratch_dir, "right")
        snapshot.write(snapshot.artifacts_of(spark, "snap_cat"), right)
        rep = snapshot.compare(spark, left, right)
        status = {(r.category, r.name): r.status for r in rep["objects"].collect()}
        assert status == {("tables", "snap_cat.t1"): "modified", ("tables", "snap_cat.t2"): "removed",
                          ("tables", "snap_cat.t3"): "added", ("views", "snap_cat.v1"): "modified"}
        cols = {(r.name, r.column_name, r.status) for r in rep["columns"].collect()}
        assert cols == {("snap_cat.t1", "c", "added")}
        summary = {r.category: r.drifted for r in rep["summary"].collect()}
        assert summary == {"tables": 3, "views": 1, "procedures": 0}
        files = {r.object_type: r for r in spark.read.json(os.path.join(corpus.current_export(spark, right), "summary")).collect()}
        assert files["table"].artifact_count == 2 and files["view"].artifact_count == 1
        assert len(files["*"].bundle_sha256) == 64 and files["*"].schemas == 1
    finally:
        spark.catalog.setCurrentDatabase("default")


def test_lengths_nullability_and_keys_survive(spark, scratch_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS snap_len")
    spark.sql("DROP TABLE IF EXISTS snap_len.sized")
    ensure_table(spark, "snap_len.sized", T.StructType([
        T.StructField("a", T.VarcharType(10), False), T.StructField("b", T.CharType(3)),
        T.StructField("c", T.StringType())]))
    spark.sql("ALTER TABLE snap_len.sized SET TBLPROPERTIES ('tidemark.key.pk_sized' = 'PRIMARY KEY (a, `b`)')")
    cols = {r.column_name: (r.data_type, r.character_maximum_length, r.is_nullable)
            for r in catalog.catalog_columns(spark, "snap_len").collect()}
    assert cols == {"a": ("varchar", 10, False), "b": ("char", 3, True), "c": ("string", -1, True)}
    arts = snapshot.artifacts_of(spark, "snap_len")
    text = arts.first().content
    assert "[a] VARCHAR(10) NOT NULL" in text and "[b] CHAR(3) NULL" in text
    assert "CONSTRAINT [pk_sized] PRIMARY KEY ([a], [b])" in text
    left, right = os.path.join(scratch_dir, "l"), os.path.join(scratch_dir, "r")
    snapshot.write(arts, left, "2026-05-01", "host", "token", "snap_len")
    spark.sql("DROP TABLE snap_len.sized")
    spark.sql("CREATE TABLE snap_len.sized (a VARCHAR(99), b CHAR(3), c STRING) USING parquet")
    snapshot.write(snapshot.artifacts_of(spark, "snap_len"), right)
    rep = snapshot.compare(spark, left, right)
    row = rep["objects"].first()
    assert row.status == "modified" and [(d.column_name, d.status) for d in row.column_differences] == [
        ("a", "type_changed")]
    told = spark.read.json(os.path.join(corpus.current_export(spark, left), "summary")).first()
    assert (told.endpoint, told.auth_method, told.database) == ("host", "token", "snap_len")


def test_colliding_paths_raise_before_writing(spark, scratch_dir):
    objs = spark.createDataFrame([("dbo.a:b", "x"), ("dbo.a|b", "y")], "q string, c string")
    out = os.path.join(scratch_dir, "never")
    with pytest.raises(snapshot.CollidingPaths, match="tables/dbo.a_b.sql"):
        snapshot.write(render.artifacts(objs, "table", "q", "c"), out)
    assert not os.path.exists(out)


def exported(spark, texts):
    return render.artifacts(spark.createDataFrame(list(texts.items()), "q string, c string"), "table", "q", "c")


def read_back(spark, folder):
    return {r.name: r.definition for r in corpus.read_snapshot(spark, folder)[1].collect()}


@pytest.mark.parametrize("step", ["manifest_files", "bundle_hash_tree", "local_frame"])
def test_a_failed_export_leaves_the_old_one_readable(spark, scratch_dir, monkeypatch, step):
    folder = os.path.join(scratch_dir, "export")
    old, new = {"dbo.a": "one", "dbo.b": "two"}, {"dbo.a": "three"}
    with pytest.raises(corpus.IncompleteSnapshot, match="nothing was published"):
        corpus.read_snapshot(spark, folder)
    snapshot.write(exported(spark, old), folder)

    def fails(*a, **k):
        raise OSError("disk full")

    with monkeypatch.context() as m:
        m.setattr(render if step == "manifest_files" else snapshot, step, fails)
        with pytest.raises(OSError):
            snapshot.write(exported(spark, new), folder)
    assert read_back(spark, folder) == old
    snapshot.write(exported(spark, new), folder)
    assert read_back(spark, folder) == new
    assert [p.sequence for p in sorted(corpus.published_versions(spark, folder))] == [1, 2]


def test_tables_schemas_and_existence(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS snap_list")
    spark.sql("CREATE TABLE IF NOT EXISTS snap_list.here (a INT) USING parquet")
    spark.sql("CREATE OR REPLACE VIEW snap_list.seen AS SELECT 1 AS one")
    kinds = {r.table_name: r.table_type for r in catalog.available_tables(spark, database="snap_list").collect()}
    assert kinds["here"] == "MANAGED" and kinds["seen"] == "VIEW"
    assert catalog.table_exists(spark, "snap_list.here") and not catalog.table_exists(spark, "snap_list.gone")
    assert "snap_list" in {r.schema_name for r in catalog.schemata(spark).collect()}


def test_assembly(spark):
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    key = "constraint_catalog string, constraint_schema string, constraint_name string, schema_name string, table_name string"
    cons = frame([("c", "s", "k1", "s", "t", "PRIMARY KEY"), ("c", "s", "k2", "s", "t", "CHECK"),
                  ("c", "sys", "k3", "sys", "t", "UNIQUE"), ("other", "s", "k1", "s", "t", "UNIQUE")],
                 key + ", constraint_type string")
    usage = frame([("c", "s", "k1", "s", "t", "b", 2), ("c", "s", "k1", "s", "t", "a", 1), ("c", "s", "k2", "s", "t", "x", 1),
                   ("c", "sys", "k3", "sys", "t", "x", 1)], key + ", column_name string, ordinal_position int")
    keys = assembly.key_columns(cons, usage)
    assert sorted((r.constraint_name, r.column_name) for r in keys.collect()) == [("k1", "a"), ("k1", "b")]
    assert render.constraint_columns_ordered(keys).first().columns == ["a", "b"]
    mods = assembly.module_texts(
        frame([(1, "x"), (2, None), (3, "z"), (9, "lost")], "object_id int, definition string"),
        frame([(1, 10, "v", "V"), (2, 10, "p", "P"), (3, 11, "q", "V"), (4, 10, "u", "U"), (9, 12, "n", "V")],
              "object_id int, schema_id int, object_name string, object_type string"),
        frame([(10, "dbo"), (11, "sys"), (12, None)], "schema_id int, schema_name string"))
    assert sorted((r.object_name, r.definition) for r in mods.collect()) == [("p", None), ("v", "x")]
    views = frame([("dbo", "v"), ("dbo", "w")], "schema_name string, object_name string")
    assert [tuple(r) for r in assembly.views_without_text(views, mods).collect()] == [("dbo", "w", "view without text")]
    tables = frame([("dbo", "b"), ("dbo", "a")], "schema_name string, table_name string")
    cols = frame([("dbo", "a", "x"), ("dbo", "gone", "y")], "schema_name string, table_name string, c string")
    assert [r.table_name for r in assembly.tables_without_columns(tables, cols).collect()] == ["b"]
    assert [r.c for r in assembly.children_of(cols, tables, ["schema_name", "table_name"]).collect()] == ["x"]
    assert [r.table_name for r in assembly.catalog_order(tables, "schema_name", "table_name").collect()] == ["a", "b"]


def test_module_join_takes_every_schema_but_the_system_s(spark, scratch_dir):
    from tidemark.plans.queries import q_module_join
    regions = [(0, "AFRICA"), (2, "ASIA"), (4, "MIDDLE EAST"), (5, None)]
    nations = [(n, f"N{n}", r) for n, r in ((0, 0), (1, 2), (2, 2), (3, 4), (6, 2), (9, 5))]
    customers = [(k, f"C{n}", n) for k, n in enumerate((0, 1, 2, 3, 6, 9, 77, None))]
    for name, rows, schema in (("region", regions, "r_regionkey int, r_name string"),
                               ("nation", nations, "n_nationkey int, n_name string, n_regionkey int"),
                               ("customer", customers, "c_custkey long, c_name string, c_nationkey int")):
        spark.createDataFrame(rows, schema).write.parquet(f"{scratch_dir}/{name}.parquet")
    got = {tuple(r) for r in q_module_join(spark, scratch_dir).collect()}
    assert got == {("AFRICA", "N0", "V", "C0"), ("ASIA", "N1", "P", "C1"), ("ASIA", "N6", "V", "C6")}
