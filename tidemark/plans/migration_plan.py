"""Migration planning over a folder of scripts and a history table.

What runs next is a DataFrame (the pending scripts in version order); the
outcome of a run is recorded with one typed append to the history table.
Executing the scripts themselves is the caller's business.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import migrations
from tidemark.sources.corpus import read_scripts


def plan(spark: SparkSession, scripts_path: str, migration_type: str = "sql",
         history_table: str = "_migration_history") -> DataFrame:
    """Pending scripts of one type, in run order."""
    files = migrations.discover(read_scripts(spark, scripts_path), migration_type)
    history = spark.table(history_table) if spark.catalog.tableExists(history_table) else None
    return migrations.run_order(migrations.pending(files, history))


def record(spark: SparkSession, runs: DataFrame, status: str, applied_by: str,
           applied_at: dt.datetime, duration_col: str | None = None,
           history_table: str = "_migration_history") -> None:
    """Append one history row per run (the table is created if missing)."""
    rows = migrations.history_rows(runs, status, applied_by, applied_at, duration_col)
    migrations.append_history(spark, rows, history_table)
