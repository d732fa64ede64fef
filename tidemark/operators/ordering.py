"""One order over all rows without one task that sees them all.

Rows are dealt to ranges of the order (one shuffle), sorted within their range
and written with the range's number and their place in it.  What remains for
the driver is one entry per range: its row count or its last value.  The ranges
are as many as the session's shuffle partitions, whatever the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.names import unused
from tidemark.session import local_frame, written

_IN_RANGE = (1 << 33) - 1  # Spark's documented layout: partition above 33 bits, row number below


def in_ranges(df: DataFrame, order: Sequence[str | Column], part: str, at: str) -> DataFrame:
    """``df`` with the number of its range and its place in it (from 0), as a
    written table: reading it again gives the same ranges."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(ranged.select("*", F.spark_partition_id().alias(part),
                                 F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_RANGE)).alias(at)), "in-order")


def numbered_in_order(df: DataFrame, order: Sequence[str | Column], name: str, first: int = 1) -> DataFrame:
    """Add ``name``: the row's number in ``order`` over all rows, without gaps.

    Rows that agree in ``order`` are numbered in any order among themselves."""
    part, at, start = unused([*df.columns, name], "part", "at", "start")
    held = in_ranges(df, order, part, at)
    counts = sorted((r[0], r[1]) for r in held.groupBy(part).count().collect())  # one row per range
    starts = accumulate((n for _, n in counts), initial=first)
    of_part = local_frame(df.sparkSession, [(p, s) for (p, _), s in zip(counts, starts)], f"{part} int, {start} bigint")
    return (held.join(F.broadcast(of_part), part)  # one row per range
            .select(*df.columns, (F.col(start) + F.col(at)).alias(name)))


def with_previous(df: DataFrame, column: str, name: str) -> DataFrame:
    """Add ``name``: the greatest smaller-or-equal value of ``column`` (a number
    that is not null) on another row, null on the first row."""
    part, at, ends = unused([*df.columns, name], "part", "at", "ends")
    held = in_ranges(df, [column], part, at)
    kind = dict(df.dtypes)[column]
    last = sorted((r[0], r[1]) for r in held.groupBy(part).agg(F.max(column)).collect())  # one row per range
    of_part = local_frame(df.sparkSession, [(p, v) for (p, _), (_, v) in zip(last[1:], last)],
                          f"{part} int, {ends} {kind}")
    inside = F.lag(column).over(Window.partitionBy(part).orderBy(at))
    return (held.withColumn(name, inside).join(F.broadcast(of_part), part, "left")
            .select(*df.columns, F.when(F.col(at) == 0, F.col(ends)).otherwise(F.col(name)).alias(name)))
