"""Migration files, history, pending set, schema evolution, seeding.

Planning is declarative: the pending set is one anti join of the parsed file
list against the *distinct* successful ids of the history (deduplicated with
partial aggregation before the shuffle, so many retries of one migration do
not pile up on one task).  Table effects (create, add columns, append a
history row, seed) are the only actions and live in the ``*_table``
functions.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import spark_identifier, spark_string, spark_table
from tidemark.operators.ordering import numbered_in_order

# File-name rules of the three tools that read migration names.
#   runner    - v<digits>_<letters, digits, _ or ->.<ext>; id is the stem
#   validator - v<3 digits>_<word chars>.sql|.py
#   ci        - v<3 digits>_<lower-case letters, digits, _>.sql
NAME_RULES = {
    "runner": r"^(v([0-9]+)_([A-Za-z0-9_\-]+))\.(sql|py)$",
    "validator": r"(?U)^v([0-9]{3})_\w+\.(sql|py)$",
    "ci": r"^v[0-9]{3}_[a-z0-9_]+\.sql$",
}
# Migration type -> file extension.
EXTENSIONS = {"sql": ".sql", "pyspark": ".py"}

HISTORY_SCHEMA = T.StructType([
    T.StructField("migration_id", T.StringType()),
    T.StructField("migration_name", T.StringType()),
    T.StructField("applied_at", T.TimestampType()),
    T.StructField("applied_by", T.StringType()),
    T.StructField("migration_type", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("duration_seconds", T.DoubleType()),
])


def extension_of(migration_type: str) -> str:
    t = migration_type.strip().lower()
    if t not in EXTENSIONS:
        raise ValueError(f"unknown migration type {migration_type!r}; known: {', '.join(EXTENSIONS)}")
    return EXTENSIONS[t]


def _version(name: Column) -> Column:
    return F.regexp_extract(name, NAME_RULES["runner"], 2).try_cast("bigint")


def parse_valid(name: Column) -> Column:
    """The runner can run a file of this name."""
    return F.coalesce(name.rlike(NAME_RULES["runner"]) & _version(name).isNotNull(), F.lit(False))


def parse_names(files: DataFrame, name_col: str = "file_name") -> DataFrame:
    """Add ``migration_id`` (stem), ``version`` (bigint), ``extension`` and
    ``valid`` (runner rule) to a file list.  A version beyond a bigint is no
    valid name, so such a file is reported as skipped and not lost."""
    rule = NAME_RULES["runner"]
    name = F.col(name_col)
    valid = parse_valid(name)
    return files.select(
        "*",
        F.when(valid, F.regexp_extract(name, rule, 1)).alias("migration_id"),
        F.when(valid, _version(name)).alias("version"),
        F.regexp_extract(name, r"(\.[^.]*)$", 1).alias("extension"),
        valid.alias("valid"),
    )


def discover(files: DataFrame, migration_type: str = "sql", name_col: str = "file_name") -> DataFrame:
    """Files of one type whose name follows the runner rule."""
    ext = extension_of(migration_type)
    parsed = parse_names(files, name_col)
    return (parsed.filter(F.col(name_col).endswith(ext) & F.col("valid"))
            .withColumn("migration_type", F.lit(migration_type.lower())))


def skipped(files: DataFrame, migration_type: str = "sql", name_col: str = "file_name") -> DataFrame:
    """Files of the type whose name breaks the rule (reported, not run)."""
    ext = extension_of(migration_type)
    parsed = parse_names(files, name_col)
    return parsed.filter(F.col(name_col).endswith(ext) & ~F.col("valid")).select(name_col)


def applied_ids(history: DataFrame) -> DataFrame:
    """Distinct ids with a successful run; failed runs do not count."""
    return history.filter(F.col("status") == F.lit("success")).select("migration_id").distinct()


def pending(files: DataFrame, history: DataFrame | None) -> DataFrame:
    """Discovered files minus successful history (anti join on the id)."""
    if history is None:
        return files
    return files.join(applied_ids(history), "migration_id", "left_anti")


def run_order(df: DataFrame) -> DataFrame:
    """Execution order: numeric version, then id (``v10`` after ``v9``).  Edge only."""
    return df.orderBy("version", "migration_id")


def with_run_rank(df: DataFrame, *ties: str, name: str = "run_rank") -> DataFrame:
    """The place of every script in :func:`run_order`, from 1, as a column;
    ``ties`` order scripts of one id."""
    return numbered_in_order(df, ["version", "migration_id", *ties], name)


def timestamp_literal(value: _dt.datetime, timestamp_type: str = "timestamp"):
    """A timestamp constant.  ``timestamp_ntz`` is written as a SQL literal,
    so its value does not depend on the Python or session time zone."""
    if timestamp_type == "timestamp_ntz":
        return F.expr(f"TIMESTAMP_NTZ '{value.replace(tzinfo=None).isoformat(sep=' ')}'")
    return F.lit(value).cast(timestamp_type)


def history_rows(runs: DataFrame, status: str | None, applied_by: str | None,
                 applied_at: _dt.datetime, duration_col: str | None = None,
                 timestamp_type: str = "timestamp") -> DataFrame:
    """Typed history rows for a set of runs (status from a column if None; the
    session's user if no one is named)."""
    st = F.col("status") if status is None else F.lit(status)
    dur = F.col(duration_col).cast("double") if duration_col else F.lit(0.0)
    return runs.select(
        F.col("migration_id").cast("string"),
        F.col("file_name").alias("migration_name").cast("string"),
        timestamp_literal(applied_at, timestamp_type).alias("applied_at"),
        (F.current_user() if applied_by is None else F.lit(applied_by)).alias("applied_by"),
        F.col("migration_type").cast("string"),
        st.alias("status"),
        dur.alias("duration_seconds"),
    )


def until_first_failure(outcomes: DataFrame, *ties: str, status_col: str = "status") -> DataFrame:
    """``outcomes`` with ``state``: what the history knows of each script after a
    run that stops at the first failure.

    ``outcomes`` has what became, or would become, of every script (``version,
    migration_id, status``).  Scripts before the first failure in run order keep
    their status (``success``), the first failure is ``failed``, and all later
    ones stay ``pending``, whatever their status; ``ties`` order scripts of one
    id.  The first failing key is one aggregate; no task sorts the scripts."""
    key = F.struct("version", "migration_id", *ties)
    first = outcomes.filter(F.col(status_col) != F.lit("success")).agg(F.min(key)).scalar()
    state = (F.when(first.isNull() | (key < first), F.lit("success")).when(key == first, F.lit("failed"))
             .otherwise(F.lit("pending")))
    return outcomes.withColumn("state", state)


def history_totals(history: DataFrame) -> DataFrame:
    """Per status: runs, distinct ids, total duration."""
    return history.groupBy("status").agg(
        F.count(F.lit(1)).cast("bigint").alias("runs"),
        F.count_distinct("migration_id").cast("bigint").alias("migrations"),
        F.round(F.coalesce(F.sum("duration_seconds"), F.lit(0.0)), 3).alias("total_seconds"),
    )


# --------------------------------------------------------------------------
# Schema evolution
# --------------------------------------------------------------------------

def missing_columns(current: T.StructType, target: T.StructType) -> list[T.StructField]:
    """Target fields absent from the current schema (case-insensitive)."""
    have = {f.name.lower() for f in current.fields}
    return [f for f in target.fields if f.name.lower() not in have]


def evolve(df: DataFrame, target: T.StructType) -> DataFrame:
    """Bring a DataFrame up to a wider schema: existing columns untouched and
    in place, missing ones appended as typed NULLs.  Idempotent."""
    add = {f.name: F.lit(None).cast(f.dataType) for f in missing_columns(df.schema, target)}
    return df.withColumns(add) if add else df


# Table property with the names (a JSON list) of the columns that must not be null.
NOT_NULL_PROPERTY = "tidemark.not_null"


def _column_ddl(f: T.StructField) -> str:
    comment = f" COMMENT {spark_string(f.metadata['comment'])}" if "comment" in f.metadata else ""
    return f"{spark_identifier(f.name)} {f.dataType.simpleString()}{comment}"


def add_missing_columns_table(spark: SparkSession, table: str, target: T.StructType) -> list[str]:
    """``ALTER TABLE ... ADD COLUMNS`` for only the missing columns.  Errors if
    the table is absent.  Returns the added names."""
    if not spark.catalog.tableExists(table):
        raise ValueError(f"cannot add columns: no table {table}")
    add = missing_columns(spark.table(table).schema, target)
    if add:
        spark.sql(f"ALTER TABLE {spark_table(table)} ADD COLUMNS ({', '.join(map(_column_ddl, add))})")
    return [f.name for f in add]


def create_table_sql(table: str, schema: T.StructType, comment: str | None = None,
                     using: str = "parquet", location: str | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS`` DDL from a StructType (column comments
    from field metadata)."""
    columns = ", ".join(map(_column_ddl, schema.fields))
    ddl = f"CREATE TABLE IF NOT EXISTS {spark_table(table)} ({columns}) USING {using}"
    if location:
        ddl += f" LOCATION {spark_string(location)}"
    if comment:
        ddl += f" COMMENT {spark_string(comment)}"
    required = [f.name for f in schema.fields if not f.nullable]
    if required:
        ddl += f" TBLPROPERTIES ({spark_string(NOT_NULL_PROPERTY)} = {spark_string(json.dumps(required))})"
    return ddl


def ensure_table(spark: SparkSession, table: str, schema: T.StructType,
                 comment: str | None = None, using: str = "parquet", location: str | None = None) -> None:
    spark.sql(create_table_sql(table, schema, comment, using, location))


def insert_by_name(df: DataFrame, table: str) -> None:
    """Append aligning columns by name (positional inserts break after
    ``ADD COLUMNS``); columns the rows lack are written as NULL."""
    target = df.sparkSession.table(table).schema
    aligned = evolve(df, target).select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in target.fields])
    aligned.write.mode("append").insertInto(table)


def seed_if_empty(spark: SparkSession, table: str, rows: DataFrame) -> bool:
    """Insert ``rows`` only when the table has no row.  Returns whether it did."""
    if not spark.table(table).isEmpty():
        return False
    insert_by_name(rows, table)
    return True


def seed_missing(target: DataFrame, seed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Set form of seeding: seed rows whose key is not in the target yet."""
    present = target.select(*keys).distinct()
    return seed.join(present, list(keys), "left_anti")


def append_run(rows: DataFrame, run_id: str, folder: str) -> None:
    """Write the history rows of one run, as that run's partition of ``folder``
    (a table of :data:`HISTORY_SCHEMA` partitioned by ``run_id``).

    The partition is replaced whole, so a retried or repeated append of a run
    leaves one row per script, and other runs' rows are not touched."""
    typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in HISTORY_SCHEMA.fields], F.lit(run_id).alias("run_id"))
    (typed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id").parquet(folder))


def read_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The history that :func:`append_run` wrote, with ``run_id``."""
    schema = T.StructType([*HISTORY_SCHEMA.fields, T.StructField("run_id", T.StringType())])
    return spark.read.schema(schema).parquet(folder)


def append_history(spark: SparkSession, rows: DataFrame, table: str = "_migration_history") -> None:
    """Create the history table if needed and append rows by name."""
    ensure_table(spark, table, HISTORY_SCHEMA)
    insert_by_name(rows, table)
