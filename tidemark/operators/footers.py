"""Counts and value ranges from Parquet footers, without reading a column.

Spark's second Parquet reader answers ``count``, ``min`` and ``max`` from the
footers when aggregates are pushed down to it.  That takes two session settings,
which a sibling session has (same context, own settings), so the caller's
session stays as it is.  The frames returned belong to the sibling; what they
give is one row per table or range.

A footer's bounds settle a closed range for whole numbers: if they lie inside it,
no value violates it and the column need not be scanned.  Floating-point columns
are left to the scan, as a footer does not tell whether there are NaNs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import spark_identifier

WHOLE = ("tinyint", "smallint", "int", "bigint")


def footer_session(spark: SparkSession) -> SparkSession:
    """A session that reads Parquet with aggregates pushed down."""
    sibling = spark.newSession()
    sibling.conf.set("spark.sql.sources.useV1SourceList", "")
    sibling.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return sibling


def footer_bounds(footers: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """One row: ``n``, and the least and greatest value ``lo<i>, hi<i>`` of each
    column.  ``footers`` is a :func:`footer_session`."""
    aggs = [f(spark_identifier(c)).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("lo", F.min), ("hi", F.max))]
    return footers.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), *aggs)


def footer_counts(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """``table_name, row_count`` of Parquet tables, from their footers."""
    footers = footer_session(spark)
    return reduce(DataFrame.unionByName, [
        footer_bounds(footers, path, ()).select(
            F.lit(name).alias("table_name"),
            F.greatest("n", F.lit(0)).alias("row_count"))  # a folder without files has no footer to count
        for name, path in paths.items()])


def settled_ranges(spark: SparkSession, paths: Mapping[str, str],
                   ranges: Sequence[tuple[str, str, int, int]]) -> DataFrame:
    """``table_name, column_name, low, high, least, most, settled`` of every
    closed range ``(table, column, low, high)`` over a whole-number column.

    ``settled``: the footers' bounds lie inside, so no row violates the range; an
    empty or all-null column is settled.  A range over another kind of column
    comes back unsettled, without bounds.  The reader fails on a footer without
    bounds, so each table is tried first; one with such a footer is scanned."""
    footers, parts = footer_session(spark), []
    for table in dict.fromkeys(r[0] for r in ranges):
        kinds = dict(spark.read.parquet(paths[table]).dtypes)
        mine = [r for r in ranges if r[0] == table]
        whole = list(dict.fromkeys(r[1] for r in mine if kinds.get(r[1]) in WHOLE))
        found = footer_bounds(footers, paths[table], whole)
        try:
            found.first()
        except (PySparkException, Py4JJavaError):
            found = footer_bounds(spark, paths[table], whole)
        rows = []
        for _, column, low, high in mine:
            least, most = ((F.col(f"{n}{whole.index(column)}").cast("bigint") if column in whole else
                            F.lit(None).cast("bigint")) for n in ("lo", "hi"))
            inside = F.coalesce((least >= low) & (most <= high), F.lit(True)) if column in whole else F.lit(False)
            rows.append(F.struct(
                F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
                F.lit(low).cast("bigint").alias("low"), F.lit(high).cast("bigint").alias("high"),
                least.alias("least"), most.alias("most"), inside.alias("settled")))
        parts.append(found.select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, parts)
