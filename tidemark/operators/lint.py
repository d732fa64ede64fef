"""Lint a corpus of migration scripts: one row per finding.

Input is a DataFrame ``(file_name, content)`` - one row per script, any
number of scripts.  Every rule but the duplicate-version rule is a row-level
predicate; the duplicate rule is a partially aggregated ``groupBy`` on
(version, extension) joined back to the files (adaptive execution broadcasts
the aggregated side when it is small and splits a hot key otherwise).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import WHITESPACE_CLASS, count_char
from tidemark.operators.migrations import NAME_RULES, parse_valid

FINDING_SCHEMA = "file_name string, rule string, severity string, message string"

# SQL keywords of which at least one must occur (as a
# substring of the upper-cased text) in a .sql script.
SQL_KEYWORDS = ("CREATE", "ALTER", "DROP", "INSERT", "UPDATE", "DELETE",
                "ADD", "COLUMN", "TABLE", "INDEX", "VIEW", "IF")
# Required entry points of a .py script.
PY_ENTRY_POINTS = ("def upgrade(", "def run(")
# Whitespace inside one line, as grep's [[:space:]] sees it per line.
_LINE_SPACE = r"[ \t\x{0B}\f\r]+"
REQUIRED_DDL = rf"(?i)(CREATE{_LINE_SPACE}TABLE|ALTER{_LINE_SPACE}TABLE)"
FORBIDDEN_DDL = rf"(?i)(DROP{_LINE_SPACE}DATABASE|DROP{_LINE_SPACE}SCHEMA)"
# Any character that is not whitespace (a script without one is empty).
NON_WHITESPACE = "[^" + WHITESPACE_CLASS[1:]

# Finding messages, worded as the original tools print them so
# existing log searches keep working.
MSG_NAMING_RUNNER = "skipped: the name does not match the runner's pattern"
MSG_NAMING = "Invalid naming convention. Expected: vNNN_description.sql or vNNN_description.py"
MSG_NAMING_CI = "does not follow the vNNN_description.sql naming convention."
MSG_EMPTY = "Empty migration file"
MSG_PARENS = "Unbalanced parentheses detected"
MSG_KEYWORDS = "No recognized SQL keywords found"
MSG_ENTRY = "Missing required upgrade() or run() function"
MSG_REQUIRED = "must contain CREATE TABLE or ALTER TABLE statements."
MSG_FORBIDDEN = "contains a forbidden DROP DATABASE or DROP SCHEMA statement."


def _not_listed(name: Column) -> Column:
    return name.startswith(".") | (name == F.lit("__pycache__"))


def _row_rules(files: DataFrame, profiles: tuple[str, ...]) -> DataFrame:
    """Every per-file rule in one projection over one scan: the flags are
    computed once per script, then one row per finding is generated."""
    name = F.col("file_name")
    content = F.coalesce(F.col("content"), F.lit(""))
    upper = F.upper(content)
    flags = files.select(
        "file_name",
        name.endswith(".sql").alias("_sql"),
        name.endswith(".py").alias("_py"),
        (~content.rlike(NON_WHITESPACE)).alias("_empty"),
        _not_listed(name).alias("_hidden"),
        name.rlike(NAME_RULES["validator"]).alias("_name_ok"),
        name.rlike(NAME_RULES["ci"]).alias("_name_ci_ok"),
        parse_valid(name).alias("_name_run_ok"),
        (count_char(content, "(") != count_char(content, ")")).alias("_parens"),
        reduce(lambda a, b: a | b, [upper.contains(k) for k in SQL_KEYWORDS]).alias("_kw"),
        reduce(lambda a, b: a | b, [content.contains(k) for k in PY_ENTRY_POINTS]).alias("_entry"),
        content.rlike(REQUIRED_DDL).alias("_ddl"),
        content.rlike(FORBIDDEN_DDL).alias("_drop"),
    )
    c = F.col
    rules = []
    if "validator" in profiles:
        rules += [
            (~c("_hidden") & ~c("_name_ok"), "naming", "ERROR", F.lit(MSG_NAMING)),
            ((c("_sql") | c("_py")) & c("_empty"), "empty", "ERROR", F.lit(MSG_EMPTY)),
            (c("_sql") & ~c("_empty") & c("_parens"), "parentheses", "ERROR", F.lit(MSG_PARENS)),
            (c("_sql") & ~c("_empty") & ~c("_kw"), "keywords", "WARNING", F.lit(MSG_KEYWORDS)),
            (c("_py") & ~c("_empty") & ~c("_entry"), "entry_point", "WARNING", F.lit(MSG_ENTRY)),
        ]
    if "runner" in profiles:
        rules.append(((c("_sql") | c("_py")) & ~c("_name_run_ok"), "naming_runner", "WARNING", F.lit(MSG_NAMING_RUNNER)))
    if "ci" in profiles:
        rules += [
            (c("_sql") & ~c("_name_ci_ok"), "naming_ci", "ERROR",
             F.concat(c("file_name"), F.lit(" " + MSG_NAMING_CI))),
            (c("_sql") & ~c("_ddl"), "create_or_alter", "ERROR", F.concat(c("file_name"), F.lit(" " + MSG_REQUIRED))),
            (c("_sql") & c("_drop"), "forbidden_drop", "ERROR", F.concat(c("file_name"), F.lit(" " + MSG_FORBIDDEN))),
        ]
    found = F.array(*[F.when(cond, F.struct(F.lit(rule).alias("rule"), F.lit(sev).alias("severity"),
                                            msg.alias("message")))
                      for cond, rule, sev, msg in rules])
    return (flags.select("file_name", F.explode(found).alias("_f"))
            .filter(F.col("_f").isNotNull())
            .select("file_name", "_f.rule", "_f.severity", "_f.message"))


def duplicate_versions(files: DataFrame) -> DataFrame:
    """Files repeating a version already used by a file of the same
    extension; each is reported against the first such file by name.
    (A .sql and a .py of one version are twins, not duplicates.)

    Each file is joined to its version's first file; the first files are one row
    per version, so a version that most files share is split by adaptive
    execution's skew join."""
    rule = NAME_RULES["validator"]
    named = files.select("file_name").filter(F.col("file_name").rlike(rule)).select(
        "file_name",
        F.regexp_extract("file_name", rule, 1).cast("int").alias("_v"),
        F.regexp_extract("file_name", rule, 2).alias("_ext"))
    firsts = named.groupBy("_v", "_ext").agg(F.min("file_name").alias("_first"),
                                             F.count(F.lit(1)).alias("_n"))
    dups = named.join(firsts.filter(F.col("_n") > 1), ["_v", "_ext"]).filter(
        F.col("file_name") != F.col("_first"))
    msg = F.concat(F.lit("Duplicate version number "), F.format_string("v%03d", F.col("_v")),
                   F.lit(" (also in "), F.col("_first"), F.lit(")"))
    return dups.select("file_name", F.lit("duplicate_version").alias("rule"),
                       F.lit("ERROR").alias("severity"), msg.alias("message"))


def lint(files: DataFrame, profiles: tuple[str, ...] = ("runner", "validator", "ci")) -> DataFrame:
    """All findings of the chosen rule profiles (``runner``: names that a run
    skips; ``validator``: naming, duplicate versions, empty, parentheses,
    keywords, entry point; ``ci``: lower-case naming, CREATE/ALTER TABLE
    required, no DROP DATABASE/SCHEMA)."""
    out = _row_rules(files, profiles)
    if "validator" in profiles:
        out = out.unionByName(duplicate_versions(files))
    return out


def lint_summary(findings: DataFrame) -> DataFrame:
    """One row: error and warning counts; ``passed`` iff no ERROR."""
    return findings.agg(
        F.count_if(F.col("severity") == "ERROR").cast("bigint").alias("errors"),
        F.count_if(F.col("severity") == "WARNING").cast("bigint").alias("warnings"),
    ).withColumn("passed", F.col("errors") == 0)
