"""Fused data checks: row counts, null keys, value ranges, in one pass per table.

The reference issues one Spark action per check (a count per table, per key
column, per range).  Here every counter for a table is one aggregate
expression of a single ``agg``: one scan of the table, partial aggregation on
every task, a one-row final result.  The rows are then turned into one check
row each and all tables are unioned, so a whole validation is one job.

Check rows have a fixed schema (:data:`CHECK_SCHEMA`) and are what
:func:`check_summary` and :func:`verdict` fold.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import spark_identifier, spark_string

CHECK_COLUMNS = ["category", "table_name", "check_name", "subject", "observed",
                 "passed", "severity", "message"]
CHECK_SCHEMA = ("category string, table_name string, check_name string, subject string, "
                "observed bigint, passed boolean, severity string, message string")


@dataclass(frozen=True)
class RangeRule:
    """Closed interval ``[low, high]``; NULL passes; either bound may be open."""

    column: str
    low: float | None = None
    high: float | None = None

    def below(self, c: str) -> str:
        """SQL: the value of the SQL expression ``c`` is under the interval."""
        return "false" if self.low is None else f"{c} < {float(self.low)!r}D"

    def violated(self, c: str) -> str:
        """SQL: the value is known and outside the interval."""
        above = "false" if self.high is None else f"{c} > {float(self.high)!r}D"
        return f"({c} IS NOT NULL AND ({self.below(c)} OR {above}))"

    def label(self) -> str:
        lo = "-inf" if self.low is None else _num(self.low)
        hi = "+inf" if self.high is None else _num(self.high)
        return f"[{lo}, {hi}]"


@dataclass(frozen=True)
class TableRules:
    """Checks for one table: key columns must not be NULL, ranges must hold."""

    table: str
    key_columns: tuple[str, ...] = ()
    ranges: tuple[RangeRule, ...] = ()
    row_count: bool = True


def _num(x: float) -> str:
    x = float(x)
    return str(int(x)) if x.is_integer() and abs(x) < 1e15 else repr(x)


def _resolve(df: DataFrame | list[str], name: str) -> str | None:
    """Case-insensitive column lookup; None when absent (check is skipped)."""
    lowered = name.lower()
    for c in (df if isinstance(df, list) else df.columns):
        if c.lower() == lowered:
            return c
    return None


#: Kinds of counters.
ROWS, NULLS, RANGES = "row_count", "null_key", "range"


def table_counters(df: DataFrame, rules: TableRules, kinds: Sequence[str] = (ROWS, NULLS, RANGES)) -> DataFrame:
    """One scan, one aggregate: the table's counters of the asked kinds, as
    long rows ``(table_name, check_name, subject, observed)``.  Only the columns
    those need are read; the row count needs none.

    Expressions are passed as SQL text so that building the plan costs one
    call per expression, not one per sub-expression.
    """
    specs = []  # (check_name, subject, aggregate SQL)
    columns = df.columns
    if rules.row_count and ROWS in kinds:
        specs.append(("row_count", rules.table, "count(1)"))
    for key in rules.key_columns if NULLS in kinds else ():
        actual = _resolve(columns, key)
        if actual is None:
            continue  # key column absent: null check skipped, not failed
        specs.append(("null_key", key.lower(), f"count_if({spark_identifier(actual)} IS NULL)"))
    for rng in rules.ranges if RANGES in kinds else ():
        actual = _resolve(columns, rng.column)
        if actual is None:
            continue
        specs.append((f"range {rng.label()}", rng.column.lower(),
                      f"count_if({rng.violated(spark_identifier(actual))})"))
    if not specs:
        return df.sparkSession.createDataFrame(
            [], "table_name string, check_name string, subject string, observed bigint")
    # aggregate expressions in a projection make it a global aggregate
    aggregated = df.selectExpr(*[f"CAST({e} AS BIGINT) AS c{i}" for i, (_, _, e) in enumerate(specs)])
    structs = ", ".join(
        f"named_struct('table_name', {spark_string(rules.table)}, 'check_name', {spark_string(n)}, "
        f"'subject', {spark_string(sub)}, 'observed', c{i})"
        for i, (n, sub, _) in enumerate(specs))
    return aggregated.selectExpr(f"inline(array({structs}))")


# Check message formats ("`t` row count: n", "`t.c` null check ->
# n null rows", "`t.c` range [lo, hi] -> n invalid rows"), as the original
# validation prints them.
_FINISH = [
    "CASE WHEN check_name = 'row_count' THEN 'rows' ELSE 'data' END AS category",
    "table_name", "check_name", "subject", "observed",
    "CASE WHEN check_name = 'row_count' THEN true ELSE observed = 0 END AS passed",
    "CASE WHEN check_name = 'row_count' AND observed = 0 THEN 'warning' "
    "WHEN check_name = 'row_count' THEN 'info' WHEN observed = 0 THEN 'info' ELSE 'error' END AS severity",
    "CASE WHEN check_name = 'row_count' THEN concat('`', table_name, '` row count: ', observed) "
    "WHEN check_name = 'null_key' THEN concat('`', table_name, '.', subject, '` null check -> ', observed, "
    "' null rows') "
    "ELSE concat('`', table_name, '.', subject, '` ', check_name, ' -> ', observed, ' invalid rows') END AS message",
]


def finish_checks(counters: DataFrame) -> DataFrame:
    """Counter rows to check rows: pass/fail, severity, message."""
    return counters.selectExpr(*_FINISH)


def table_checks(df: DataFrame, rules: TableRules) -> DataFrame:
    """All checks of one table from a single aggregate over one scan."""
    return finish_checks(table_counters(df, rules))


def _asks(r: TableRules, kinds: Sequence[str]) -> bool:
    return ((r.row_count and ROWS in kinds) or (bool(r.key_columns) and NULLS in kinds)
            or (bool(r.ranges) and RANGES in kinds))


def fused_checks(tables: Mapping[str, DataFrame], rules: Sequence[TableRules],
                 kinds: Sequence[str] = (ROWS, NULLS, RANGES)) -> DataFrame:
    """Check rows of the asked kinds for every table that exists; missing
    tables are skipped here (their absence is reported by the presence check),
    and so are tables without a check of those kinds.  One aggregate per table,
    one union, one projection."""
    parts = [table_counters(tables[r.table], r, kinds) for r in rules if r.table in tables and _asks(r, kinds)]
    if not parts:
        spark = SparkSession.getActiveSession()
        return spark.createDataFrame([], CHECK_SCHEMA)
    return finish_checks(reduce(lambda a, b: a.union(b), parts))


def range_violation_rows(df: DataFrame, table: str, rules: Sequence[RangeRule],
                         id_columns: Sequence[str]) -> DataFrame:
    """The offending rows themselves, one output row per (row, broken rule).

    One scan and one projection for all rules of the table: each row yields
    an array with an entry per rule it breaks (NULL otherwise), exploded and
    filtered.  The rule predicates are also pushed to the scan as a filter."""
    columns = df.columns
    entries, any_broken = [], None
    for rng in rules:
        actual = _resolve(columns, rng.column)
        if actual is None:
            continue
        c, broken = F.col(actual), F.expr(rng.violated(spark_identifier(actual)))
        below = F.expr(rng.below(spark_identifier(actual)))
        entries.append(F.when(broken, F.struct(
            F.lit(rng.column.lower()).alias("column_name"), c.cast("double").alias("value"),
            F.lit(rng.low).cast("double").alias("low"), F.lit(rng.high).cast("double").alias("high"),
            F.when(below, F.lit("below")).otherwise(F.lit("above")).alias("reason"))))
        any_broken = broken if any_broken is None else (any_broken | broken)
    if not entries:
        return df.sparkSession.createDataFrame(
            [], "table_name string, column_name string, value double, low double, high double, reason string")
    exploded = df.filter(any_broken).select(*[F.col(i) for i in id_columns], F.explode(F.array(*entries)).alias("_v"))
    return exploded.filter(F.col("_v").isNotNull()).select(
        F.lit(table).alias("table_name"), *[F.col(i) for i in id_columns],
        "_v.column_name", "_v.value", "_v.low", "_v.high", "_v.reason")


def check_summary(results: DataFrame) -> DataFrame:
    """Per category: passed, total, and the failure messages joined by ``; ``.

    Input is one row per check (a contract-sized table), so the failure list
    per category is bounded by the contract, not by the data.
    """
    return results.groupBy("category").agg(
        F.count_if(F.col("passed")).cast("bigint").alias("passed"),
        F.count(F.lit(1)).cast("bigint").alias("total"),
        F.count_if(F.col("severity") == F.lit("warning")).cast("bigint").alias("warnings"),
        F.array_join(F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("message")))), "; ")
        .alias("failures"),
    )


def verdict(results: DataFrame) -> DataFrame:
    """One row: overall PASS/FAIL over every check row."""
    return results.agg(
        F.coalesce(F.bool_and(F.col("passed")), F.lit(True)).alias("passed"),
        F.count(F.lit(1)).cast("bigint").alias("checks"),
        F.count_if(~F.col("passed")).cast("bigint").alias("failed"),
        F.count_if(F.col("severity") == F.lit("warning")).cast("bigint").alias("warnings"),
        F.array_join(F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("message")))), "; ")
        .alias("failures"),
    ).select(
        F.when(F.col("passed"), F.lit("PASS")).otherwise(F.lit("FAIL")).alias("result"),
        "passed", "checks", "failed", "warnings", "failures",
    )


class ValidationFailed(Exception):
    """Raised by :func:`assert_passed` with every failure message."""


def assert_passed(results: DataFrame, context: str = "") -> None:
    """The one action of a validation: fold to a verdict and raise on FAIL."""
    row = verdict(results).collect()[0]
    if not row["passed"]:
        where = f" for {context}" if context else ""
        raise ValidationFailed(f"Schema validation failed{where}. Issues: {row['failures']}")
