"""Whole contract validation of the session catalog (the post-deploy check).

Existence, column types, the version's own additions, row counts, null keys,
ranges and migration history, all as check rows, then folded per category
and into one verdict.  Row-level work is one aggregate per table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import checks, contracts
from tidemark.operators.checks import TableRules
from tidemark.sources.catalog import actual_columns, available_tables


def validate_catalog(spark: SparkSession, contract_rows: Sequence[tuple], rules: Sequence[TableRules],
                     expected_version: str, history_table: str = "_migration_history",
                     strict_history: bool = False) -> DataFrame:
    """Check rows for the current database against a versioned contract; only
    the tables that ``expected_version`` requires are read."""
    contract = contracts.contract_frame(spark, contract_rows)
    existing = {t.name.lower() for t in spark.catalog.listTables()}
    wanted = contracts.tables_of(contract_rows, expected_version)
    tables = {name: spark.table(name) for name in sorted(wanted & existing)}
    avail = available_tables(spark)
    actual = actual_columns(spark, tables)
    history = spark.table(history_table) if history_table.lower() in existing else None
    parts = [
        contracts.contract_checks(contract, actual, avail, expected_version),
        checks.fused_checks(tables, rules),
        contracts.history_checks(history, contracts.expected_version_labels(expected_version),
                                 strict=strict_history, spark=spark),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def report(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(per-category summary, one-row verdict)."""
    return checks.check_summary(results), checks.verdict(results)
