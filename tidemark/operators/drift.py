"""Schema drift between two snapshots, at object and at column level.

A snapshot is a long DataFrame of objects ``(category, name, definition,
relative_path)``; for tables, a long DataFrame of columns ``(name,
column_name, ordinal, type_sql, definition)`` as well.

Object drift is one full outer join on ``(category, name)``.  Definitions are
normalized and hashed *before* the join, so only 64-character digests are
shuffled, never the definition text.  Names are unique per category, so the
join key has no hot value even when one category holds most objects.
Column drift is one full outer join on ``(name, column_name)``; the per-table
roll-up is a partially aggregated ``groupBy``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import glob_regexes, matches_any_glob, normalize_definition
from tidemark.operators.ordering import numbered_in_order
from tidemark.session import local_frame

# Drift statuses in report order, and their text symbols.
STATUS_ORDER = {"modified": 0, "added": 1, "removed": 2, "unchanged": 3}
STATUS_SYMBOL = {"modified": "~", "added": "!", "removed": "!", "unchanged": "="}
STATUSES = ("added", "removed", "modified", "unchanged")

# What a row of the report says, as codes; several are joined by "; ".
ONLY_COMPARED, ONLY_BASELINE = "only_compared", "only_baseline"
SAME_TEXT, CHANGED_TEXT, SAME_COLUMNS = "same_text", "changed_text", "same_columns"


def objects(df: DataFrame, category: Column | str, name: Column | str,
            definition: Column | str, relative_path: Column | str | None = None) -> DataFrame:
    """Standard object snapshot columns from any DataFrame."""
    def c(x):
        return F.col(x) if isinstance(x, str) else x
    path = F.lit(None).cast("string") if relative_path is None else c(relative_path)
    return df.select(c(category).alias("category"), c(name).alias("name"),
                     c(definition).alias("definition"), path.alias("relative_path"))


def status_rank(status: Column) -> Column:
    expr = F.lit(None).cast("int")
    for s, r in STATUS_ORDER.items():
        expr = F.when(status == F.lit(s), F.lit(r)).otherwise(expr)
    return expr


def status_symbol(status: Column) -> Column:
    expr = F.lit("=")
    for s, sym in STATUS_SYMBOL.items():
        expr = F.when(status == F.lit(s), F.lit(sym)).otherwise(expr)
    return expr


# --------------------------------------------------------------------------
# Ignore patterns
# --------------------------------------------------------------------------

def singular(category: Column, mapping: Mapping[str, str] | None = None) -> Column:
    """``tables`` -> ``table``; other categories via ``mapping`` or unchanged."""
    mapping = dict(mapping or {"tables": "table", "views": "view", "procedures": "procedure"})
    expr = category
    for plural, single in mapping.items():
        expr = F.when(category == F.lit(plural), F.lit(single)).otherwise(expr)
    return expr


def ignore_mask(objs: DataFrame, patterns: Sequence[str],
                singular_map: Mapping[str, str] | None = None) -> Column:
    """True for objects any glob matches; four candidate spellings, all
    lower-cased: ``name``, ``category:name``, ``singular:name``, path."""
    return matches_any_glob(_spellings(objs, singular_map), patterns)


#: Characters of a glob's literal start or end by which it is joined to names.
ANCHOR = 16


def _spellings(objs: DataFrame, singular_map: Mapping[str, str] | None) -> list[Column]:
    """The four spellings of an object that globs are matched with, lower-cased."""
    name, cat = F.col("name"), F.col("category")
    return [F.lower(name), F.lower(F.concat(cat, F.lit(":"), name)),
            F.lower(F.concat(singular(cat, singular_map), F.lit(":"), name)),
            F.lower(F.replace(F.coalesce(F.col("relative_path"), F.lit("")), F.lit("\\"), F.lit("/")))]


def ignored_by(objs: DataFrame, globs: DataFrame, singular_map: Mapping[str, str] | None = None) -> DataFrame:
    """``category, name`` of the objects that a glob of the table ``globs``
    (``pattern``) matches.

    A glob meets only the spellings that have its literal start or end, the
    longer of the two and up to ``ANCHOR`` characters, by an equi join; the match
    follows.  A glob with neither (``*a*``) meets all of them."""
    pattern = F.lower(F.trim("pattern"))
    start, end = (F.regexp_extract("glob", r, 0) for r in (r"^[^*?\[]*", r"[^*?\[\]]*$"))
    kept = globs.select(pattern.alias("glob")).filter("glob <> ''").distinct()
    anchored = (kept.withColumns({"start": start, "end": end})
                .withColumn("at_start", F.length("start") >= F.length("end"))
                .withColumn("size", F.least(F.greatest(F.length("start"), F.length("end")), F.lit(ANCHOR)))
                .select(glob_regexes("glob").alias("regex"), "at_start", "size",
                        F.when(F.col("at_start"), F.substr("start", F.lit(1), F.col("size")))
                        .otherwise(F.substr("end", F.length("end") - F.col("size") + 1, F.col("size"))).alias("anchor")))
    used = anchored.select("at_start", "size").distinct().collect()  # 2 * (ANCHOR + 1) at most
    names = objs.select("category", "name", F.explode(F.array_distinct(F.array(*_spellings(objs, singular_map)))).alias("spelling"))
    keys = [F.when(F.length("spelling") >= r.size, F.struct(
        F.lit(r.at_start).alias("at_start"), F.lit(r.size).alias("size"),
        (F.substr("spelling", F.lit(1), F.lit(r.size)) if r.at_start else
         F.substr("spelling", F.length("spelling") - r.size + 1, F.lit(r.size))).alias("anchor"))) for r in used]
    if not keys:
        return objs.select("category", "name").limit(0)
    met = names.select("category", "name", "spelling", F.inline(F.filter(F.array(*keys), lambda k: k.isNotNull())))
    return (met.join(anchored, ["at_start", "size", "anchor"]).filter(F.expr("spelling RLIKE regex"))
            .select("category", "name").distinct())


def split_ignored(objs: DataFrame, patterns: Sequence[str],
                  singular_map: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept, ignored) objects; one expression, two filters over the same plan."""
    if not patterns:
        return objs, objs.filter(F.lit(False))
    flagged = objs.withColumn("_ignored", ignore_mask(objs, patterns, singular_map))
    return (flagged.filter(~F.col("_ignored")).drop("_ignored"),
            flagged.filter(F.col("_ignored")).drop("_ignored"))


def ignored_union(left_ignored: DataFrame, right_ignored: DataFrame) -> DataFrame:
    """Distinct (category, name) ignored on either side."""
    return (left_ignored.select("category", "name")
            .union(right_ignored.select("category", "name")).distinct())


# --------------------------------------------------------------------------
# Object drift
# --------------------------------------------------------------------------

#: A digest of an object's columns (names and types), where a snapshot brings it along.
COLUMNS_DIGEST = "columns_sha256"


def _side(objs: DataFrame, tag: str) -> DataFrame:
    columns = F.col(COLUMNS_DIGEST) if COLUMNS_DIGEST in objs.columns else F.lit(None).cast("string")
    return objs.select(
        "category", "name",
        F.sha2(normalize_definition(F.col("definition")), 256).alias(f"{tag}_norm"),
        columns.alias(f"{tag}_columns"),
        F.col("relative_path").alias(f"{tag}_path"),
        F.lit(True).alias(f"in_{tag}"),
    )


def object_drift(left: DataFrame, right: DataFrame,
                 column_changes: DataFrame | None = None,
                 column_categories: Sequence[str] = ("tables",)) -> DataFrame:
    """Status per object: added (right only), removed (left only), unchanged
    (equal normalized definition), modified.

    A modified object of ``column_categories`` whose columns agree in name and
    type gets a second detail.  Whether they agree comes from the digest
    ``columns_sha256``, if both sides bring it (no further join), or from
    ``column_changes`` (``name``, ``n_column_differences``).
    """
    j = _side(left, "left").join(_side(right, "right"), ["category", "name"], "full_outer")
    in_l = F.coalesce(F.col("in_left"), F.lit(False))
    in_r = F.coalesce(F.col("in_right"), F.lit(False))
    status = (F.when(~in_l, F.lit("added"))
              .when(~in_r, F.lit("removed"))
              .when(F.col("left_norm").eqNullSafe(F.col("right_norm")), F.lit("unchanged"))
              .otherwise(F.lit("modified")))
    j = j.withColumn("status", status)
    if column_changes is not None:
        changes = column_changes.select("name", F.col("n_column_differences").alias("_ncd"))
        j = j.join(changes, "name", "left")
        no_cols = (F.col("category").isin(*column_categories)
                   & (F.coalesce(F.col("_ncd"), F.lit(0)) == 0))
    else:
        no_cols = F.col("category").isin(*column_categories) & (F.col("left_columns") == F.col("right_columns"))
    st = F.col("status")
    return j.select(
        "category", "name", "status",
        status_rank(st).alias("status_rank"),
        status_symbol(st).alias("symbol"),
        _details(st, no_cols).alias("details"),
        "left_path", "right_path",
    )


def _details(status: Column, same_columns: Column) -> Column:
    return (F.when(status == "added", F.lit(ONLY_COMPARED))
            .when(status == "removed", F.lit(ONLY_BASELINE))
            .when(status == "unchanged", F.lit(SAME_TEXT))
            .when(same_columns, F.lit(f"{CHANGED_TEXT}; {SAME_COLUMNS}"))
            .otherwise(F.lit(CHANGED_TEXT)))


def report_order(drift: DataFrame) -> DataFrame:
    """Presentation order: modified, added, removed, unchanged; then name
    case-insensitively.  Call at the edge only."""
    return drift.orderBy("category", "status_rank", F.lower("name"), "name")


def with_report_rank(drift: DataFrame, name: str = "report_rank") -> DataFrame:
    """The place of every row in :func:`report_order`, from 1, as a column."""
    return numbered_in_order(drift, ["category", "status_rank", F.lower("name"), "name"], name)


# --------------------------------------------------------------------------
# Column drift
# --------------------------------------------------------------------------

def _col_side(cols: DataFrame, tag: str) -> DataFrame:
    return cols.select(
        "name", "column_name",
        F.col("type_sql").alias(f"{tag}_type"),
        normalize_definition(F.col("type_sql")).alias(f"{tag}_ntype"),
        F.sha2(F.concat_ws("\u0001", F.col("ordinal").cast("string"),
                           normalize_definition(F.col("definition"))), 256).alias(f"{tag}_ndef"),
        F.lit(True).alias(f"in_{tag}"),
    )


def _column_join(left_cols: DataFrame, right_cols: DataFrame) -> DataFrame:
    j = _col_side(left_cols, "left").join(_col_side(right_cols, "right"),
                                          ["name", "column_name"], "full_outer")
    in_l = F.coalesce(F.col("in_left"), F.lit(False))
    in_r = F.coalesce(F.col("in_right"), F.lit(False))
    status = (F.when(~in_l, F.lit("added"))
              .when(~in_r, F.lit("removed"))
              .when(~F.col("left_ntype").eqNullSafe(F.col("right_ntype")), F.lit("type_changed"))
              .when(~F.col("left_ndef").eqNullSafe(F.col("right_ndef")), F.lit("definition_changed"))
              .otherwise(F.lit("same")))
    return j.withColumn("col_status", status).withColumn("_in_l", in_l).withColumn("_in_r", in_r)


def column_drift(left_cols: DataFrame, right_cols: DataFrame, modified: DataFrame | None = None) -> DataFrame:
    """Column differences of the tables on both sides: added, removed,
    type_changed (type compared after normalization; nullability and default
    ignored).

    A table that is only added or removed has no column differences.  A column
    that differs makes its table a modified one, so the differences themselves
    need no list of modified tables: one full outer join gives them, and of
    those only the ones stay whose table both sides have.  ``modified``
    (``name``) cuts them down further, where what counts as modified was decided
    elsewhere."""
    j = _column_join(left_cols, right_cols)
    if modified is not None:
        j = j.join(modified.select("name").distinct(), "name", "left_semi")
    differ = j.filter(F.col("col_status").isin("added", "removed", "type_changed")).select(
        "name", "column_name", F.col("col_status").alias("status"),
        F.when(F.col("col_status") != "added", F.col("left_type")).alias("left_type"),
        F.when(F.col("col_status") != "removed", F.col("right_type")).alias("right_type"),
    )
    # which sides have the table, asked for in one aggregate over both
    sides = (left_cols.select("name", F.lit(1).alias("side")).unionByName(right_cols.select("name", F.lit(2).alias("side")))
             .groupBy("name").agg(F.min("side").alias("first"), F.max("side").alias("last")))
    return differ.join(sides.filter("first < last").select("name"), "name", "left_semi")


def table_drift(left_cols: DataFrame, right_cols: DataFrame) -> DataFrame:
    """Table-level drift computed from the long column form, without ever
    assembling a table's definition text.

    A table is modified when any column was added, removed, retyped, or its
    full definition (ordinal, default, nullability) changed; the counters are
    partial aggregates per table, so a table with very many columns does not
    concentrate in one task before the final merge.
    """
    j = _column_join(left_cols, right_cols)
    per_table = j.groupBy("name").agg(
        F.bool_or("_in_l").alias("in_left"),
        F.bool_or("_in_r").alias("in_right"),
        F.count_if(F.col("col_status") == "added").cast("bigint").alias("columns_added"),
        F.count_if(F.col("col_status") == "removed").cast("bigint").alias("columns_removed"),
        F.count_if(F.col("col_status") == "type_changed").cast("bigint").alias("columns_retyped"),
        F.count_if(F.col("col_status") == "definition_changed").cast("bigint").alias("columns_redefined"),
    )
    ncd = F.col("columns_added") + F.col("columns_removed") + F.col("columns_retyped")
    status = (F.when(~F.col("in_left"), F.lit("added"))
              .when(~F.col("in_right"), F.lit("removed"))
              .when((ncd + F.col("columns_redefined")) > 0, F.lit("modified"))
              .otherwise(F.lit("unchanged")))
    st = F.col("status")
    return (per_table.withColumn("status", status)
            .withColumn("n_column_differences", F.when(st == "modified", ncd).otherwise(F.lit(0)).cast("bigint"))
            .select("name", "status", status_rank(st).alias("status_rank"),
                    "n_column_differences", "columns_added", "columns_removed", "columns_retyped",
                    _details(st, F.col("n_column_differences") == 0).alias("details")))


def column_differences_per_object(col_drift: DataFrame) -> DataFrame:
    """Column differences rolled up to one sorted list per table.

    A table's column count is bounded by the catalog (SQL engines cap it in
    the thousands), so the list per table is bounded too.
    """
    return col_drift.groupBy("name").agg(
        F.array_sort(F.collect_list(F.struct(
            F.lower("column_name").alias("sort_key"), "column_name", "status", "left_type",
            "right_type"))).alias("column_differences"))


# --------------------------------------------------------------------------
# Summary, verdict, recommendations
# --------------------------------------------------------------------------

def with_column_differences(drift: DataFrame, col_drift: DataFrame, table_category: str = "tables") -> DataFrame:
    """Object drift rows with ``column_differences``: the sorted list of a
    table's column differences (empty for other objects)."""
    lists = column_differences_per_object(col_drift).withColumn("category", F.lit(table_category))
    j = drift.join(lists, ["category", "name"], "left")
    empty = F.array().cast(lists.schema["column_differences"].dataType)
    return j.withColumn("column_differences", F.coalesce("column_differences", empty))


def is_drift(status: Column) -> Column:
    return status.isin("added", "removed", "modified")


def drift_summary(drift: DataFrame, categories: Sequence[str] | None = None) -> DataFrame:
    """Per category: counts of each status (zero-filled) and ``drifted``.

    ``categories`` are listed even without an object; a category that occurs is
    listed whether it is among them or not.  One aggregate of conditional
    counts over the drift rows and an empty row per listed category."""
    rows = drift.select("category", "status")
    if categories:
        listed = local_frame(drift.sparkSession, [(c, None) for c in categories], "category string, status string")
        rows = rows.unionByName(listed)
    counts = rows.groupBy("category").agg(
        *[F.count_if(F.col("status") == F.lit(s)).cast("bigint").alias(s) for s in STATUSES])
    return counts.withColumn("drifted", F.col("added") + F.col("removed") + F.col("modified"))


def drift_verdict(drift: DataFrame) -> DataFrame:
    """One row, counted from the drift rows: drifted objects and ``has_drift``."""
    return drift.agg(F.count_if(is_drift(F.col("status"))).cast("bigint").alias("total_drifted")) \
        .withColumn("has_drift", F.col("total_drifted") > 0)


# What to do about a comparison, in report order.
ALIGNED, UPDATE_BASELINE, MIGRATE_LIVE = "aligned", "update_baseline", "migrate_live"
REVIEW_TABLE_TEXT, REVIEW_TABLE_SET = "review_table_text", "review_table_set"


def recommendations(drift: DataFrame, table_category: str = "tables") -> DataFrame:
    """``(seq, action, objects)``: what applies and to how many objects.

    Nothing drifted: ``aligned``.  Otherwise the two ways out (update the
    baseline, or migrate the live side), then what to look at first: tables
    whose text changed, tables that came or went."""
    st, table = F.col("status"), F.col("category") == F.lit(table_category)
    totals = drift.agg(
        F.count_if(is_drift(st)).alias("drifted"),
        F.count_if(table & (st == "modified")).alias("changed"),
        F.count_if(table & st.isin("added", "removed")).alias("moved"))
    rules = [(ALIGNED, F.col("drifted") == 0, "drifted"), (UPDATE_BASELINE, F.col("drifted") > 0, "drifted"),
             (MIGRATE_LIVE, F.col("drifted") > 0, "drifted"), (REVIEW_TABLE_TEXT, F.col("changed") > 0, "changed"),
             (REVIEW_TABLE_SET, F.col("moved") > 0, "moved")]
    items = F.array(*[F.when(cond, F.struct(F.lit(i).alias("seq"), F.lit(action).alias("action"),
                                            F.col(n).cast("bigint").alias("objects")))
                      for i, (action, cond, n) in enumerate(rules)])
    return totals.select(F.inline(F.filter(items, lambda x: x.isNotNull())))


# --------------------------------------------------------------------------
# Raw-hash diff (manifest path)
# --------------------------------------------------------------------------

def raw_hash_diff(left: DataFrame, right: DataFrame, hash_col: str = "sha256") -> DataFrame:
    """added / removed / modified keys by comparing stored content hashes
    (no normalization: any byte change is a modification)."""
    l = left.select("category", "name", F.col(hash_col).alias("_lh"), F.lit(True).alias("_l"))
    r = right.select("category", "name", F.col(hash_col).alias("_rh"), F.lit(True).alias("_r"))
    j = l.join(r, ["category", "name"], "full_outer")
    status = (F.when(F.col("_l").isNull(), F.lit("added"))
              .when(F.col("_r").isNull(), F.lit("removed"))
              .when(~F.col("_lh").eqNullSafe(F.col("_rh")), F.lit("modified")))
    return j.select("category", "name", status.alias("status")).filter(F.col("status").isNotNull())
