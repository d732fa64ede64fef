"""Drift report between two snapshots: objects, columns, summary, verdict,
recommendations and the ignored objects, as DataFrames.

The object comparison feeds the summary, the verdict and the
recommendations.  With ``checkpoint`` it is computed once, at once, into the
session's checkpoint folder, so those outputs do not recompute the join;
without it every output is lazy.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import split_patterns
from tidemark.operators import drift
from tidemark.session import materialize

MANAGED_CATEGORIES = ("tables", "views", "procedures")


def drift_report(left: DataFrame, right: DataFrame, left_columns: DataFrame | None = None,
                 right_columns: DataFrame | None = None, ignore: Sequence[str] | str | None = None,
                 categories: Sequence[str] = MANAGED_CATEGORIES,
                 singular_map: Mapping[str, str] | None = None,
                 checkpoint: bool = False) -> dict[str, DataFrame]:
    patterns = split_patterns(ignore)
    left_kept, left_ignored = drift.split_ignored(left, patterns, singular_map)
    right_kept, right_ignored = drift.split_ignored(right, patterns, singular_map)
    col_changes = None
    column_drift = None
    if left_columns is not None and right_columns is not None:
        tables = drift.table_drift(left_columns, right_columns)
        col_changes = tables.select("name", "n_column_differences")
    objects = drift.object_drift(left_kept, right_kept, col_changes)
    if checkpoint:
        objects = materialize(objects)
    if col_changes is not None:
        modified = objects.filter((F.col("category") == "tables") & (F.col("status") == "modified"))
        column_drift = drift.column_drift(left_columns, right_columns, modified)
        objects = drift.with_column_differences(objects, column_drift)
    summary = drift.drift_summary(objects, categories)
    out = {
        "objects": drift.report_order(objects),
        "summary": summary,
        "verdict": drift.drift_verdict(objects),
        "recommendations": drift.recommendations(objects),
        "ignored": drift.ignored_union(left_ignored, right_ignored),
    }
    if column_drift is not None:
        out["columns"] = column_drift
    return out
