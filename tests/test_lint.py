import os

from tidemark.operators import lint
from tidemark.sources.corpus import read_scripts

FILES = "file_name string, content string"


def _findings(df):
    return {(r.file_name, r.rule) for r in df.collect()}


def test_rules(spark):
    rows = [("v001_base.sql", "CREATE TABLE t (a INT);"),
            ("v002_add.sql", "ALTER TABLE t ADD COLUMNS (b INT"),
            ("v003_twin.sql", "create table u (x int)"), ("v003_twin.py", "def upgrade(spark):\n    pass\n"),
            ("v004_a.sql", "CREATE TABLE a (x INT)"), ("v004_b.sql", "CREATE TABLE b (x INT)"),
            ("v004_c.sql", "CREATE TABLE c (x INT)"),
            ("v005_empty.sql", "  \n\t "), ("v006_script.py", "print('hello')"),
            ("v007_prose.sql", "just words"), ("v008_drop.sql", "CREATE TABLE x (a int); drop  schema s;"),
            ("V9_Upper-name.sql", "CREATE TABLE y (a int)"), (".hidden", "x"), ("__pycache__", ""),
            ("v010_split.sql", "CREATE\nTABLE t (a int)")]
    f = _findings(lint.lint(spark.createDataFrame(rows, FILES)))
    assert ("v002_add.sql", "parentheses") in f
    assert ("v004_b.sql", "duplicate_version") in f and ("v004_c.sql", "duplicate_version") in f
    assert ("v004_a.sql", "duplicate_version") not in f
    assert ("v003_twin.py", "duplicate_version") not in f and ("v003_twin.sql", "duplicate_version") not in f
    assert ("v005_empty.sql", "empty") in f and ("v005_empty.sql", "keywords") not in f
    assert ("v006_script.py", "entry_point") in f and ("v003_twin.py", "entry_point") not in f
    assert ("v007_prose.sql", "keywords") in f and ("v007_prose.sql", "create_or_alter") in f
    assert ("v008_drop.sql", "forbidden_drop") in f
    assert ("V9_Upper-name.sql", "naming") in f and ("V9_Upper-name.sql", "naming_ci") in f
    assert ("V9_Upper-name.sql", "naming_runner") in f and ("v010_split.sql", "naming_runner") not in f
    assert (".hidden", "naming") not in f and ("__pycache__", "naming") not in f
    assert ("v010_split.sql", "create_or_alter") in f  # keywords must be on one line
    s = lint.lint_summary(lint.lint(spark.createDataFrame(rows, FILES))).first()
    assert not s.passed and s.errors > 0 and s.warnings >= 2


def test_read_scripts_folder(spark, scratch_dir):
    d = os.path.join(scratch_dir, "scripts")
    os.makedirs(d)
    for name, text in [("v001_a.sql", "CREATE TABLE a (x INT);\nSELECT 1;\n"), ("v002_b.py", "def run(s):\n  pass\n")]:
        with open(os.path.join(d, name), "w") as fh:
            fh.write(text)
    df = read_scripts(spark, d)
    got = {r.file_name: r.content for r in df.collect()}
    assert got["v001_a.sql"].count("\n") == 2  # one row per file, not per line
    assert lint.lint(df.select("file_name", "content")).count() == 0
