"""Row-level rules the domain declares but the reference never checks:
unique keys, foreign keys, accepted values, cross-column agreement and gaps
in version numbers.

Every rule aggregates before it joins: keys are counted per value with
partial aggregation, so a key that holds a third of all rows reaches the
shuffle as one partial count per task, not as a third of the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import spark_identifier
from tidemark.operators.ordering import with_previous
from tidemark.session import local_frame


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with their row count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("copies"))
            .filter(F.col("copies") > 1))


def foreign_key_orphans(tables: Mapping[str, DataFrame],
                        relations: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Per (child, column) -> (parent, column): rows and distinct keys whose
    value has no parent row (NULL keys are not orphans; keys are compared as
    numbers if all are integers, else as text).

    Each child and each parent table is scanned once for all its relations: a
    row yields one (relation, key) pair per relation, and pairs are counted
    before the anti join."""
    spark = next(iter(tables.values())).sparkSession

    whole = {"tinyint", "smallint", "int", "bigint"}
    kinds = {dict(tables[r[side]].dtypes)[r[side + 1]] for r in relations for side in (0, 2)}
    key_type = "BIGINT" if kinds <= whole else "STRING"

    def pairs(side: int) -> DataFrame:
        parts = []
        for table in dict.fromkeys(r[side] for r in relations):
            mine = ", ".join(f"named_struct('relation', {i}, '_k', CAST({spark_identifier(r[side + 1])} AS {key_type}))"
                             for i, r in enumerate(relations) if r[side] == table)
            parts.append(tables[table].selectExpr(f"inline(array({mine}))").filter("_k IS NOT NULL"))
        return reduce(lambda a, b: a.unionByName(b), parts)

    keys = pairs(0).groupBy("relation", "_k").agg(F.count(F.lit(1)).alias("_n"))
    orphans = (keys.join(pairs(2).distinct(), ["relation", "_k"], "left_anti").groupBy("relation")
               .agg(F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_keys")))
    named = local_frame(spark, [(i, *r) for i, r in enumerate(relations)],
                        "relation int, child_table string, child_column string, parent_table string, "
                        "parent_column string")
    return named.join(orphans, "relation", "left").select(
        "child_table", "child_column", "parent_table", "parent_column",
        F.coalesce("_rows", F.lit(0)).cast("bigint").alias("orphan_rows"),
        F.coalesce("_keys", F.lit(0)).cast("bigint").alias("orphan_keys"))


def accepted_values(tables: Mapping[str, DataFrame],
                    rules: Sequence[tuple[str, str, Sequence[str]]]) -> DataFrame:
    """Values outside an accepted list, with their row counts."""
    parts = []
    for table, column, accepted in rules:
        c = F.col(column)
        parts.append(tables[table].filter(c.isNotNull() & ~c.cast("string").isin(*accepted))
                     .groupBy(c.cast("string").alias("value"))
                     .agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
                     .select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
                             "value", "rows"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def total_agreement(parents: DataFrame, parent_key: str, total: str, children: DataFrame, child_key: str,
                    part: str, rule: str, tolerance: str) -> DataFrame:
    """A parent's ``total`` must equal the sum of its children's ``part`` within
    ``tolerance``: ``(rule, checked_rows, without_children, violations)``.

    ``total`` and ``part`` are SQL expressions, taken as ``decimal(38,6)`` so
    that the sum does not depend on the order of its terms.  Parents without
    children are counted and not compared."""
    sums = children.groupBy(F.col(child_key).alias("_k")).agg(
        F.sum(F.expr(part).cast("decimal(28,6)")).alias("_sum"))
    j = parents.select(F.col(parent_key).alias("_k"), F.expr(total).cast("decimal(28,6)").alias("_total")).join(
        sums, "_k", "left")
    off = F.abs(F.col("_total") - F.col("_sum")) > F.lit(tolerance).cast("decimal(28,6)")
    return j.agg(
        F.count_if(F.col("_sum").isNotNull()).cast("bigint").alias("checked_rows"),
        F.count_if(F.col("_sum").isNull()).cast("bigint").alias("without_children"),
        F.count_if(off).cast("bigint").alias("violations"),
    ).select(F.lit(rule).alias("rule"), "checked_rows", "without_children", "violations")


def version_gaps(versions: DataFrame, col: str = "version", start: int = 1) -> DataFrame:
    """``(gap_from, gap_to)``: every range of numbers from ``start`` on that no
    version has, up to the highest version.

    Distinct versions are compared with the one before in ranges of their order
    (see :mod:`tidemark.operators.ordering`), so sparse versions such as
    timestamps are no task's whole input."""
    v = F.col(col).cast("bigint")
    have = versions.select(v.alias("v")).filter(F.col("v") >= start).distinct()
    before = F.coalesce(F.col("before"), F.lit(start - 1).cast("bigint"))
    return (with_previous(have, "v", "before")
            .select((before + 1).alias("gap_from"), (F.col("v") - 1).alias("gap_to"))
            .filter(F.col("gap_from") <= F.col("gap_to")))


def expression_agreement(df: DataFrame, table: str,
                         rules: Sequence[tuple[str, str, str, float]]) -> DataFrame:
    """Cross-column rules ``(name, left SQL, right SQL, tolerance)``: rows
    where both sides are known and differ by more than the tolerance.  All
    rules of a table are counted in one aggregate over one scan; rows with a
    NULL side are not counted (as in the range checks)."""
    exprs = []
    for i, (_, lhs, rhs, tol) in enumerate(rules):
        exprs.append(f"CAST(count_if(({lhs}) IS NOT NULL AND ({rhs}) IS NOT NULL "
                     f"AND abs(({lhs}) - ({rhs})) > {float(tol)!r}D) AS BIGINT) AS v{i}")
    agg = df.selectExpr("CAST(count(1) AS BIGINT) AS n", *exprs)
    structs = ", ".join(
        f"named_struct('rule', '{name}', 'violations', v{i})" for i, (name, _, _, _) in enumerate(rules))
    return agg.selectExpr(f"'{table}' AS table_name", "n AS checked_rows", f"inline(array({structs}))")
