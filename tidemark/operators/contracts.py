"""Versioned table contracts as DataFrames.

A contract is a long table ``(table_name, column_name, expected_type,
since_version)``; the tables that actually exist and their columns are long
tables too (:mod:`tidemark.sources.catalog`).  Every check is then a join:

* presence   - contract tables left-joined to the existing tables,
* columns    - contract columns left-joined to actual columns, only for
  tables that exist (a missing table skips its column checks),
* version    - the items a given version introduced, same joins,
* history    - expected version labels searched in a history table.

All produce rows of the check schema of :mod:`tidemark.operators.checks`.
Contract and catalog tables are local relations of known size, so Spark's
broadcast threshold decides how they are joined.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.types import normalize_type, normalize_type_name, version_number, version_number_of
from tidemark.session import local_frame

# Message formats ("Table `t` exists", "`t.c` -> expected X, found Y",
# "Migration history contains `v`") are fixed values: worded as the original
# validation prints them.
CONTRACT_SCHEMA = ("table_name string, column_name string, expected_type string, since_version bigint, "
                   "table_since bigint, first_of_table boolean")


def contract_frame(spark: SparkSession,
                   spec: Mapping[str, Mapping[str, str]] | Iterable[tuple],
                   since_version: int = 1) -> DataFrame:
    """Contract DataFrame from ``{table: {column: type}}`` (all at one version)
    or from ``(table, column, type, since_version)`` tuples.

    Each row also tells the version its table came with, and whether it is the
    one row that stands for its table."""
    if isinstance(spec, Mapping):
        spec = [(t, c, typ, since_version) for t, columns in spec.items() for c, typ in columns.items()]
    rows = [(t.lower(), c.lower(), normalize_type_name(typ), int(since)) for t, c, typ, since in spec]
    table_since: dict[str, int] = {}
    for t, _, _, since in rows:
        table_since[t] = min(since, table_since.get(t, since))
    out, seen = [], set()
    for row in rows:
        first = row[3] == table_since[row[0]] and row[0] not in seen
        if first:
            seen.add(row[0])
        out.append((*row, table_since[row[0]], first))
    return local_frame(spark, out, CONTRACT_SCHEMA)


def gate(contract: DataFrame, expected_version: str) -> DataFrame:
    """Contract rows required at ``expected_version`` (``v002`` -> since <= 2)."""
    return contract.filter(F.col("since_version") <= version_number(F.lit(expected_version)))


def tables_of(contract_rows: Iterable[tuple], expected_version: str) -> set[str]:
    """Names of the tables that ``expected_version`` requires."""
    return {t.lower() for t, _, _, since in contract_rows if since <= version_number_of(expected_version)}


def required_per_version(contract: DataFrame, versions: DataFrame, version_col: str = "version") -> DataFrame:
    """For every version in ``versions`` (e.g. the versions a history
    recorded): how many contract tables and columns that version requires;
    none for a version before the contract's first.

    The contract is expanded to one row per (version it applies to, item) up
    to its highest ``since_version`` and counted per version (contract-sized);
    the data versions join it on ``least(version, highest since)``."""
    top = contract.select(F.coalesce(F.max("since_version"), F.lit(0)).cast("bigint")).scalar()
    expanded = contract.select(
        F.explode(F.sequence(F.col("since_version"), top)).alias("_k"),
        "table_name", "column_name")
    per_k = expanded.groupBy("_k").agg(
        F.count_distinct("table_name").cast("bigint").alias("_tables"),
        F.count(F.lit(1)).cast("bigint").alias("_columns"))
    v = versions.select(F.col(version_col).cast("bigint").alias("version")).filter(F.col("version").isNotNull())
    return v.distinct().withColumn("_k", F.least(F.col("version"), top)).join(per_k, "_k", "left").select(
        "version", F.coalesce("_tables", F.lit(0)).cast("bigint").alias("required_tables"),
        F.coalesce("_columns", F.lit(0)).cast("bigint").alias("required_columns"))


def contract_checks(contract: DataFrame, actual: DataFrame, available: DataFrame,
                    expected_version: str | None = None) -> DataFrame:
    """Every check of a contract against a catalog, from one join.

    * ``tables``: each required table exists (case-insensitive);
    * ``columns``: each required column of an existing table is there with its
      type (after :func:`normalize_type`); extra columns are ignored, a missing
      one reads as ``missing``;
    * ``version``: what exactly ``expected_version`` introduced (from v2 on):
      new tables exist, new columns of older tables exist with their type.

    Without ``expected_version`` the whole contract is required and there are
    no ``version`` rows.
    """
    tables = available.select(F.lower("table_name").alias("table_name")).distinct().withColumn("_there", F.lit(True))
    columns = actual.select(F.lower("table_name").alias("table_name"), F.lower("column_name").alias("column_name"),
                            normalize_type(F.col("data_type")).alias("_found"))
    j = contract.select("*", normalize_type(F.col("expected_type")).alias("_wanted")).join(
        tables, "table_name", "left").join(columns, ["table_name", "column_name"], "left")
    c = F.col
    there = F.coalesce(c("_there"), F.lit(False))
    typed = F.coalesce(c("_found") == c("_wanted"), F.lit(False))
    number = None if expected_version is None else version_number_of(expected_version)
    required = F.lit(True) if number is None else c("since_version") <= number

    def row(when, category, check, subject, passed, *message):
        return F.when(when, F.struct(
            F.lit(category).alias("category"), c("table_name"), F.lit(check).alias("check_name"),
            subject.alias("subject"), passed.cast("bigint").alias("observed"), passed.alias("passed"),
            F.when(passed, F.lit("info")).otherwise(F.lit("error")).alias("severity"),
            F.concat(*message).alias("message")))

    rows = [
        row(required & c("first_of_table"), "tables", "exists", c("table_name"), there,
            F.lit("Table `"), c("table_name"), F.lit("` exists")),
        row(required & there, "columns", "column_type", c("column_name"), typed,
            F.lit("`"), c("table_name"), F.lit("."), c("column_name"), F.lit("` -> expected "), c("_wanted"),
            F.lit(", found "), F.coalesce(c("_found"), F.lit("missing"))),
    ]
    if number is not None and number >= 2:
        new = c("since_version") == number
        rows += [
            row(new & c("first_of_table"), "version", "introduced_table", c("table_name"), there,
                F.lit("Table `"), c("table_name"), F.lit("` exists for "), F.lit(expected_version)),
            row(new & (c("table_since") < number), "version", "introduced_column", c("column_name"), typed,
                c("table_name"), F.lit(" includes `"), c("column_name"), F.lit("` ("), F.upper(c("_wanted")),
                F.lit(")")),
        ]
    return (j.select(F.explode(F.array(*rows)).alias("_r")).filter(c("_r").isNotNull()).select("_r.*"))


def table_presence(contract: DataFrame, available: DataFrame) -> DataFrame:
    """One check row per contract table: does it exist?"""
    nothing = available.select("table_name", F.lit(None).cast("string").alias("column_name"),
                               F.lit(None).cast("string").alias("data_type"))
    return contract_checks(contract, nothing, available).filter(F.col("category") == "tables")


def column_conformance(contract: DataFrame, actual: DataFrame, available: DataFrame) -> DataFrame:
    """One check row per contract column of an existing table."""
    return contract_checks(contract, actual, available).filter(F.col("category") == "columns")


def version_block(contract: DataFrame, actual: DataFrame, available: DataFrame, expected_version: str) -> DataFrame:
    """Checks for exactly the items ``expected_version`` introduced."""
    return contract_checks(contract, actual, available, expected_version).filter(F.col("category") == "version")


def expected_version_labels(expected_version: str, width: int = 3) -> list[str]:
    """``v002`` -> ``["v001", "v002"]``: every version up to the expected one."""
    return [f"v{i:0{width}d}" for i in range(1, version_number_of(expected_version) + 1)]


def history_checks(history: DataFrame | None, labels: Sequence[str], strict: bool = False,
                   spark: SparkSession | None = None) -> DataFrame:
    """Migration-history checks: the table exists, and each label is found.

    Loose form (the reference's): a label is found when it occurs in the text
    of any column of any row, any status.  Strict form: some row with
    ``status = 'success'`` has a ``migration_id`` starting with the label.
    """
    from tidemark.operators.search import search_presence, strict_presence
    spark = spark or SparkSession.getActiveSession()
    exists = history is not None
    head = local_frame(spark, 
        [("migration", "_migration_history", "exists", "_migration_history", int(exists), exists,
          "info" if exists else "error", "Table `_migration_history` exists")],
        "category string, table_name string, check_name string, subject string, observed bigint, "
        "passed boolean, severity string, message string")
    if not exists:
        return head
    found = strict_presence(history, labels) if strict else search_presence(history, labels)
    rows = found.select(
        F.lit("migration").alias("category"),
        F.lit("_migration_history").alias("table_name"),
        F.lit("version_recorded").alias("check_name"),
        F.col("needle").alias("subject"),
        F.col("found").cast("bigint").alias("observed"),
        F.col("found").alias("passed"),
        F.when(F.col("found"), F.lit("info")).otherwise(F.lit("error")).alias("severity"),
        F.concat(F.lit("Migration history contains `"), F.col("needle"), F.lit("`")).alias("message"),
    )
    return head.unionByName(rows)


def history_checks_both_modes(history: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Loose and strict history checks from one aggregate over the history:
    check rows with a ``mode`` column."""
    from tidemark.operators.search import presence_modes
    spark = history.sparkSession
    head = local_frame(spark, [(m, "exists", "_migration_history", True, "Table `_migration_history` exists")
                               for m in ("loose", "strict")],
                       "mode string, check_name string, subject string, passed boolean, message string")
    found = presence_modes(history, labels).select(
        "needle", F.explode(F.array(
            F.struct(F.lit("loose").alias("mode"), F.col("loose_found").alias("passed")),
            F.struct(F.lit("strict").alias("mode"), F.col("strict_found").alias("passed")))).alias("m"))
    rows = found.select(
        "m.mode", F.lit("version_recorded").alias("check_name"), F.col("needle").alias("subject"), "m.passed",
        F.concat(F.lit("Migration history contains `"), F.col("needle"), F.lit("`")).alias("message"))
    return head.unionByName(rows)
