import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.functions.hashing import bundle_hash_exact, bundle_hash_tree
from tidemark.operators import render
from tidemark.sources.corpus import IncompleteSnapshot, read_snapshot, resolve_paths

COLS = [("dbo", "sites", "id", 1, "nvarchar", 20, None, None, None, False, None),
        ("dbo", "sites", "cap", 3, "decimal", None, 10, 2, None, True, "((0))"),
        ("dbo", "sites", "opened", 2, "datetime2", None, None, None, 3, True, None)]
COL_SCHEMA = ("schema_name string, table_name string, column_name string, ordinal_position int, data_type string, "
              "character_maximum_length int, numeric_precision int, numeric_scale int, datetime_precision int, "
              "is_nullable boolean, column_default string")
KEYS = [("dbo", "sites", "uq_sites", "UNIQUE", "cap", 2), ("dbo", "sites", "uq_sites", "UNIQUE", "id", 1),
        ("dbo", "sites", "pk_sites", "PRIMARY KEY", "id", 1)]
KEY_SCHEMA = ("schema_name string, table_name string, constraint_name string, constraint_type string, "
              "column_name string, ordinal_position int")
EXPECTED = ("CREATE TABLE [dbo].[sites] (\n"
            "    [id] NVARCHAR(20) NOT NULL,\n"
            "    [opened] DATETIME2(3) NULL,\n"
            "    [cap] DECIMAL(10,2) DEFAULT ((0)) NULL,\n"
            "    CONSTRAINT [pk_sites] PRIMARY KEY ([id]),\n"
            "    CONSTRAINT [uq_sites] UNIQUE ([id], [cap])\n"
            ");\n")


def test_render_text_and_lines(spark):
    cols = spark.createDataFrame(COLS, COL_SCHEMA)
    keys = spark.createDataFrame(KEYS, KEY_SCHEMA)
    tables = render.collect_table_arrays(cols, keys)
    text = render.render_table_text(tables).first()
    assert text.definition == EXPECTED
    lines = render.definition_lines(cols, render.constraint_columns_ordered(keys)).collect()
    ordered = [r.line for r in sorted(lines, key=lambda r: (r.section, r.position, r.sort_key))]
    body = ",\n".join(ordered[1:-1])
    assert ordered[0] + "\n" + body + "\n" + ordered[-1] + "\n" == EXPECTED


def test_parse_round_trip(spark):
    cols = spark.createDataFrame(COLS, COL_SCHEMA)
    defs = render.render_table_text(render.collect_table_arrays(cols))
    parsed = {r.column_name: (r.ordinal, r.type_sql) for r in render.parse_definition_columns(defs).collect()}
    assert parsed == {"id": (1, "NVARCHAR(20)"), "opened": (2, "DATETIME2(3)"), "cap": (3, "DECIMAL(10,2)")}


def test_normalize_module(spark):
    rows = [("dbo", "v1", "V", "  ALTER VIEW dbo.v1 AS SELECT 1"), ("dbo", "p1", "P", "alter procedure p1 as x"),
            ("dbo", "v2", "V", "create view v2 as y"), ("dbo", "v3", "V", "SELECT 3"),
            ("dbo", "p2", "PC", "BEGIN END"), ("dbo", "e", "V", "   ")]
    df = spark.createDataFrame(rows, "schema_name string, object_name string, object_type string, definition string")
    got = {r.object_name: (r.definition, r.error) for r in render.normalize_module(df).collect()}
    assert got["v1"][0] == "CREATE OR ALTER VIEW dbo.v1 AS SELECT 1"
    assert got["p1"][0] == "CREATE OR ALTER procedure p1 as x"
    assert got["v2"][0] == "create view v2 as y"
    assert got["v3"][0] == "CREATE VIEW [dbo].[v3] AS\nSELECT 3"
    assert got["p2"][0] == "CREATE PROCEDURE [dbo].[p2]\nAS\nBEGIN END"
    assert got["e"] == (None, "empty_text")


def _arts(spark, n=50):
    rows = [("table" if i % 2 else "view", f"dbo.o{i}", f"text {i}\nline") for i in range(n)]
    return render.artifacts(spark.createDataFrame(rows, "t string, q string, c string"), F.col("t"), "q", "c")


def test_exact_bundle_hash_matches_sequential_digest(spark):
    arts = _arts(spark)
    got = bundle_hash_exact(arts).first()
    digest = hashlib.sha256()
    for r in sorted(arts.collect(), key=lambda r: r.relative_path):
        digest.update(r.content.encode())
        digest.update(b"\n")
    assert got.bundle_sha256 == digest.hexdigest() and got.artifact_count == 50
    with pytest.raises(ValueError, match="too many"):
        bundle_hash_exact(arts, most_bytes=10)


def test_tree_hash_is_partitioning_independent(spark):
    arts = _arts(spark, 200)
    a = {r.object_type: r.bundle_sha256 for r in bundle_hash_tree(arts, ["object_type"]).collect()}
    b = {r.object_type: r.bundle_sha256 for r in bundle_hash_tree(arts.repartition(7), ["object_type"]).collect()}
    assert a == b
    changed = arts.withColumn("content", F.when(F.col("qualified_name") == "dbo.o3", F.lit("x"))
                              .otherwise(F.col("content")))
    c = {r.object_type: r.bundle_sha256 for r in bundle_hash_tree(changed, ["object_type"]).collect()}
    assert c["table"] != a["table"] and c["view"] == a["view"]


def test_plain_snapshot_names_come_from_the_manifest(spark, scratch_dir):
    arts = render.artifacts(spark.createDataFrame(
        [("table", "dbo.a b", "x"), ("table", "dbo.c+d", "y\n"), ("view", "dbo.e:f", "z")], "t string, q string, c string"),
        F.col("t"), "q", "c")
    assert {r.object_type: r.object_count for r in render.manifest_counts(arts).collect()} == {"table": 2, "view": 1}
    export = os.path.join(scratch_dir, "export")
    for r in arts.collect():
        path = os.path.join(export, r.relative_path)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as fh:
            fh.write(r.content)
    files = {r.relative_path: {"object_type": r.object_type, "qualified_name": r.qualified_name,
                               "sha256": r.sha256} for r in render.manifest_files(arts).collect()}
    with open(os.path.join(export, "manifest.json"), "w") as fh:
        json.dump({"files": files}, fh)
    mf, objs = read_snapshot(spark, export)
    assert {(r.category, r.name): r.definition for r in objs.collect()} == {
        ("tables", "dbo.a b"): "x", ("tables", "dbo.c+d"): "y\n", ("views", "dbo.e:f"): "z"}
    assert {r.sha256 for r in objs.collect()} == {f["sha256"] for f in files.values()} and mf.count() == 3
    os.remove(os.path.join(export, "tables/dbo.a b.sql"))
    with pytest.raises(IncompleteSnapshot, match="tables/dbo.a b.sql"):
        read_snapshot(spark, export)


def test_resolve_paths_with_duplicates_and_lost_files(spark):
    objs = spark.createDataFrame([("tables", "a"), ("tables", "b"), ("views", "a"), ("tables", "c")],
                                 "category string, name string")
    listed = spark.createDataFrame([("z/a.sql", "table", "a"), ("m/a.sql", "table", "a"), ("m/b.sql", "table", "b")],
                                   "relative_path string, object_type string, qualified_name string")
    present = spark.createDataFrame([("m/a.sql",), ("m/a.sql",), ("views/a.sql",)], "relative_path string")
    got = {(r.category, r.name): (r.resolved_path, r.from_manifest, r.found)
           for r in resolve_paths(objs, listed, present).collect()}
    assert got == {("tables", "a"): ("m/a.sql", True, True), ("tables", "b"): ("m/b.sql", True, False),
                   ("views", "a"): ("views/a.sql", False, True), ("tables", "c"): ("tables/c.sql", False, False)}
    assert resolve_paths(objs, listed, present).count() == 4


def test_parse_odd_definitions(spark):
    texts = {"paren": "CREATE TABLE [dbo].[b(c)] (\n    [x] INT NULL,\n    [y] DECIMAL(10,2) NOT NULL\n);\n",
             "one line": "CREATE TABLE [dbo].[t] ([u] INT NOT NULL, [v] DECIMAL(10,2) DEFAULT ((0)) NULL, "
                         "CONSTRAINT [pk] PRIMARY KEY ([u], [v]))",
             "bare": "CREATE TABLE [t] ([d] DATETIME2(3))", "none": "SELECT 1", "null": None,
             "cut": "CREATE TABLE [dbo].[t]\n [u] INT"}
    df = spark.createDataFrame(list(texts.items()), "qualified_name string, definition string")
    got = {}
    for r in render.parse_definition_columns(df).collect():
        got.setdefault(r.qualified_name, {})[r.column_name] = (r.ordinal, r.type_sql, r.column_definition)
    assert got == {
        "paren": {"x": (1, "INT", "INT NULL"), "y": (2, "DECIMAL(10,2)", "DECIMAL(10,2) NOT NULL")},
        "one line": {"u": (1, "INT", "INT NOT NULL"),
                     "v": (2, "DECIMAL(10,2)", "DECIMAL(10,2) DEFAULT ((0)) NULL")},
        "bare": {"d": (1, "DATETIME2(3)", "DATETIME2(3)")}}
    assert {r.qualified_name: r.error for r in render.unparsed_definitions(df).collect()} == {
        "none": "no CREATE TABLE", "null": "no CREATE TABLE", "cut": "no list of columns after the table name"}


def test_one_pass_for_group_and_total_bundles(spark):
    arts = _arts(spark, 60)
    apart = {r.object_type: r.bundle_sha256 for r in bundle_hash_tree(arts, ["object_type"]).collect()}
    apart["*"] = bundle_hash_tree(arts.withColumn("object_type", F.lit("*")), ["object_type"]).first().bundle_sha256
    both = bundle_hash_tree(arts, ["object_type"], total="*")
    assert {r.object_type: r.bundle_sha256 for r in both.collect()} == apart


def test_bracket_names_round_trip(spark):
    rows = [("dbo", "odd]table", "we]ird", 1, "int", None, None, None, None, True, None),
            ("dbo", "odd]table", "plain", 2, "varchar", 10, None, None, None, False, " 'x' ")]
    cols = spark.createDataFrame(rows, COL_SCHEMA)
    text = render.render_table_text(render.collect_table_arrays(cols)).first().definition
    assert "CREATE TABLE [dbo].[odd]]table] (" in text and "[we]]ird] INT NULL" in text
    assert "[plain] VARCHAR(10) DEFAULT 'x' NOT NULL" in text
    parsed = {r.column_name: r.type_sql for r in
              render.parse_definition_columns(render.render_table_text(render.collect_table_arrays(cols))).collect()}
    assert parsed == {"we]ird": "INT", "plain": "VARCHAR(10)"}


def test_static_and_array_rendering_agree(spark):
    from tidemark.plans import mapping as M
    sf = "/root/testdata/sf0.001"
    for live in (False, True):
        a = render.render_table_text(M.order_tables(spark, sf, live=live)).select("qualified_name", "definition")
        b = M.order_table_texts(spark, sf, live=live).select("qualified_name", "definition")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() > 0


def test_tree_hash_splits_a_hot_group(spark):
    # every artifact in one group: the first tree level still spreads them over
    # chunks keyed by the path digest, so no chunk holds more than a few
    arts = _arts(spark, 2000).withColumn("object_type", F.lit("one"))
    digest = F.sha2("relative_path", 256)
    chunks = arts.groupBy(F.substring(digest, 1, 4), F.substring(digest, 5, 4)).count()
    assert chunks.count() > 1900 and chunks.agg(F.max("count")).first()[0] <= 2
    got = bundle_hash_tree(arts, ["object_type"]).first()
    assert got.artifact_count == 2000 and len(got.bundle_sha256) == 64


def parsed(spark, *items):
    text = "CREATE TABLE [s].[t] (\n    " + ",\n    ".join(items) + "\n);\n"
    df = spark.createDataFrame([("s.t", text)], "qualified_name string, definition string")
    rows = [(r.ordinal, r.column_name, r.type_sql, r.column_definition) for r in render.parse_definition_columns(df).collect()]
    return rows, [r.error for r in render.unparsed_definitions(df).collect()]


@pytest.mark.parametrize("default", [
    "'x, [b] INT'", "'it''s, CONSTRAINT [c] ('", "(('a,b'))", "(f([x], [y] , ')', g((1,2),(3))))", "']'", "'\u0001'",
    "([odd]]name, [z] INT)", "'" + "(" * 40 + "'"])
def test_commas_inside_a_default_split_nothing(spark, default):
    rows, errors = parsed(spark, f"[a] NVARCHAR(9) DEFAULT {default} NULL", "CONSTRAINT [k] PRIMARY KEY ([a], [b])",
                          "[b,]]] DECIMAL(10, 2) NOT NULL")
    assert rows == [(1, "a", "NVARCHAR(9)", f"NVARCHAR(9) DEFAULT {default} NULL"),
                    (3, "b,]", "DECIMAL(10, 2)", "DECIMAL(10, 2) NOT NULL")]
    assert errors == []


@pytest.mark.parametrize("default", ["'open", "(1", "1)", "x]", "(" * 12 + "1" + ")" * 12])
def test_parts_without_their_pair_are_errors(spark, default):
    rows, errors = parsed(spark, f"[a] INT DEFAULT {default} NULL", "[b] INT NULL")
    assert rows == [] and errors == ["quotes, brackets or parentheses without their pair"]


def test_long_definitions_parse(spark):
    items = [f"[c{i}] NVARCHAR({i}) DEFAULT ('v, {i}') NULL" for i in range(5000)]
    rows, errors = parsed(spark, *items)
    assert errors == [] and [r[1] for r in rows] == [f"c{i}" for i in range(5000)]


def test_wide_table_is_written_without_a_row_that_holds_it(spark, scratch_dir):
    wide = 20000
    cols = spark.range(wide).selectExpr(
        "'dbo' AS schema_name", "'wide' AS table_name", "concat('c', id) AS column_name",
        "cast(id * 7919 % 20011 AS int) AS ordinal_position", "'int' AS data_type", "cast(null AS int) AS character_maximum_length",
        "cast(null AS int) AS numeric_precision", "cast(null AS int) AS numeric_scale",
        "cast(null AS int) AS datetime_precision", "id % 2 = 0 AS is_nullable", "cast(null AS string) AS column_default")
    both = cols.unionByName(spark.createDataFrame(COLS, COL_SCHEMA))
    keys = render.constraint_columns_ordered(spark.createDataFrame(KEYS, KEY_SCHEMA))
    folder = os.path.join(scratch_dir, "definitions")
    lines = render.definition_lines(both, keys)
    render.write_definitions(lines, folder)
    assert "collect_list" not in render.definition_lines(both)._jdf.queryExecution().toString()
    files = spark.read.text(folder, wholetext=True).collect()
    texts = {(r.schema_name, r.table_name): r.value for r in files}
    assert len(files) == 2 and texts["dbo", "sites"] == EXPECTED
    got = texts["dbo", "wide"].splitlines()
    assert len(got) == wide + 2 and got[0] == "CREATE TABLE [dbo].[wide] (" and got[-1] == ");"
    names = [r.column_name for r in cols.orderBy("ordinal_position").collect()]
    assert [x.strip().split("]")[0][1:] for x in got[1:-1]] == names
    assert all(x.endswith("NULL,") for x in got[1:-2]) and got[-2].endswith("NULL")


def test_names_in_order(spark):
    arts = spark.createDataFrame([("table", "b"), ("view", "z"), ("table", "a"), ("table", "B")],
                                 "object_type string, qualified_name string")
    got = [tuple(r) for r in render.names_in_order(arts).orderBy("object_type", "position").collect()]
    assert got == [("table", "B", 1, 3), ("table", "a", 2, 3), ("table", "b", 3, 3), ("view", "z", 1, 1)]


def test_columns_digest(spark):
    fields = dict(zip(render.COLUMN_STRUCT_FIELDS, ["'a'", "1", "'int'", "null", "null", "null", "null", "true", "null"]))

    def digest(*changes):
        structs = []
        for change in changes:
            f = {**fields, **change}
            structs.append("named_struct(" + ", ".join(f"'{k}', {v}" for k, v in f.items()) + ")")
        names = [f"c{i}" for i in range(len(structs))]
        row = spark.range(1).selectExpr(*[f"{s} AS {n}" for s, n in zip(structs, names)])
        return row.selectExpr(render.columns_digest_sql(names)).first()[0]

    b = {"column_name": "'b'"}
    assert digest({}, b) == digest(b, {}) == digest({"is_nullable": "false", "column_default": "'1'"}, b)
    assert len({digest({}, b), digest({}), digest({"data_type": "'bigint'"}, b), digest({"column_name": "'c'"}, b)}) == 4
