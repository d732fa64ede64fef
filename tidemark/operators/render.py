"""Catalog snapshot: render definitions, parse them back, artifacts, manifest.

Two shapes of a table definition:

* *long form* - one row per definition line ``(schema_name, table_name,
  section, sort_key, line)``.  Pure row-level projections plus a union; a
  table with any number of columns is spread over all tasks.  This is the
  form for data-sized catalogs, and what a writer turns into files
  (``sortWithinPartitions`` + ``partitionBy`` writes each object's lines in
  order without gathering them).
* *text form* - one string per table, built from an array of column structs
  with ``array_sort`` + ``transform`` + ``array_join`` inside one row.  The
  array comes either from the row itself or from grouping a catalog's
  columns per table (bounded by the engine's column limit).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import (WHITESPACE_CLASS, col_, export_path, quote_identifier,
                                     strip_surrounding_whitespace)
from tidemark.functions.types import format_data_type_sql
from tidemark.operators.ordering import numbered_in_order

COLUMN_STRUCT_FIELDS = ("column_name", "ordinal_position", "data_type", "character_maximum_length",
                        "numeric_precision", "numeric_scale", "datetime_precision", "is_nullable",
                        "column_default")

# Sections of a rendered table definition, in file order.
SECTION_HEADER, SECTION_CREATE, SECTION_COLUMN, SECTION_CONSTRAINT, SECTION_CLOSE = 0, 1, 2, 3, 4


def header_text(extracted_at: str | None, endpoint: str | None, database: str | None) -> str:
    """Comment header of an exported file; empty when no extraction time is given."""
    if extracted_at is None:
        return ""
    # The lines of the exported files' header.
    return (f"-- Extracted on {extracted_at}\n"
            f"-- Source endpoint: {endpoint}\n"
            f"-- Source database: {database}\n")


def _qi_sql(x: str) -> str:
    return f"concat('[', replace({x}, ']', ']]'), ']')"


def column_line_sql(c: str) -> str:
    """SQL text of ``    [name] TYPE[ DEFAULT x] NULL|NOT NULL`` for a struct
    ``c``; any non-empty default is rendered, stripped."""
    typ = _type_sql(c)
    strip = f"regexp_replace({c}.column_default, r'^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+$', '')"
    default = f"if(coalesce({c}.column_default, '') = '', '', concat(' DEFAULT ', {strip}))"
    null = f"if({c}.is_nullable, 'NULL', 'NOT NULL')"
    return f"rtrim(concat('    ', {_qi_sql(c + '.column_name')}, ' ', {typ}, {default}, ' ', {null}))"


def columns_digest_sql(structs: Sequence[str]) -> str:
    """SQL text of the digest of the columns' names and types, apart from their
    order, nullability and defaults: equal digests mean no column difference."""
    pairs = ", ".join(f"concat(sha2({c}.column_name, 256), upper({_type_sql(c)}))" for c in structs)
    return f"sha2(array_join(array_sort(array({pairs})), ';'), 256)"


def _type_sql(c: str) -> str:
    return format_data_type_sql(*(f"{c}.{f}" for f in (
        "data_type", "character_maximum_length", "numeric_precision", "numeric_scale", "datetime_precision")))


def constraint_line_sql(k: str) -> str:
    """SQL text of ``    CONSTRAINT [name] TYPE ([c1], [c2])`` for a struct ``k``."""
    cols = f"array_join(transform({k}.columns, x -> {_qi_sql('x')}), ', ')"
    return (f"concat('    CONSTRAINT ', {_qi_sql(k + '.constraint_name')}, ' ', {k}.constraint_type, "
            f"' (', {cols}, ')')")


def constraint_rank(ctype: Column) -> Column:
    """PRIMARY KEY before everything else."""
    return F.when(ctype == F.lit("PRIMARY KEY"), F.lit(0)).otherwise(F.lit(1))


def create_line(schema_name: Column, table_name: Column) -> Column:
    return F.concat(F.lit("CREATE TABLE "), quote_identifier(schema_name), F.lit("."),
                    quote_identifier(table_name), F.lit(" ("))


def render_table_text(tables: DataFrame, header: str = "") -> DataFrame:
    """Text form.  Input: ``schema_name``, ``table_name``, ``columns``
    (array of column structs) and optional ``constraints`` (array of
    ``constraint_name, constraint_type, columns``).  Output adds
    ``qualified_name`` and ``definition``."""
    lines = ("transform(array_sort(transform(columns, "
             f"c -> struct(c.ordinal_position AS k, {column_line_sql('c')} AS line))), x -> x.line)")
    if "constraints" in tables.columns:
        rank = "if(k.constraint_type = 'PRIMARY KEY', 0, 1)"
        keys = ("transform(array_sort(transform(constraints, "
                f"k -> struct({rank} AS r, k.constraint_name AS n, {constraint_line_sql('k')} AS line))), x -> x.line)")
        lines = f"concat({lines}, coalesce({keys}, array()))"
    all_lines = F.expr(lines)
    body = F.array_join(all_lines, ",\n")
    definition = F.concat(F.lit(header), create_line(F.col("schema_name"), F.col("table_name")),
                          F.lit("\n"), body, F.lit("\n);\n"))
    return tables.select(
        "schema_name", "table_name",
        F.concat(F.col("schema_name"), F.lit("."), F.col("table_name")).alias("qualified_name"),
        definition.alias("definition"))


def render_rows(df: DataFrame, schema_name: Column, table_name: Column, columns: Sequence[Column],
                constraints: Sequence[Column] = (), header: str = "", digest: str | None = None) -> DataFrame:
    """Text form for tables whose column and constraint lists are fixed
    expressions of the row, given already in definition order (ordinal;
    PRIMARY KEY before the rest).  Same text as :func:`render_table_text`,
    but every line is a plain expression (no higher-order function over the
    columns), built as SQL text in one projection.  ``digest`` names a column
    for the digest of the table's columns (:func:`columns_digest_sql`)."""
    staged = df.select(schema_name.alias("schema_name"), table_name.alias("table_name"),
                       F.lit(header).alias("_header"),
                       *[c.alias(f"_c{i}") for i, c in enumerate(columns)],
                       *[k.alias(f"_k{i}") for i, k in enumerate(constraints)])
    lines = ([column_line_sql(f"_c{i}") for i in range(len(columns))]
             + [constraint_line_sql(f"_k{i}") for i in range(len(constraints))])
    create = f"concat('CREATE TABLE ', {_qi_sql('schema_name')}, '.', {_qi_sql('table_name')}, ' (')"
    # newlines as char(10): independent of the session's string-escape setting
    definition = (f"concat(_header, {create}, char(10), concat_ws(concat(',', char(10)), {', '.join(lines)}), "
                  f"char(10), ');', char(10)) AS definition")
    more = [f"{columns_digest_sql([f'_c{i}' for i in range(len(columns))])} AS `{digest}`"] if digest else []
    return staged.selectExpr("schema_name", "table_name",
                             "concat(schema_name, '.', table_name) AS qualified_name", definition, *more)


def collect_table_arrays(columns: DataFrame, constraints: DataFrame | None = None) -> DataFrame:
    """Long catalog columns (and constraint key columns) grouped per table.

    Bounded per table by the catalog's column limit; use :func:`definition_lines`
    when objects are data-sized."""
    cols = columns.groupBy("schema_name", "table_name").agg(
        F.collect_list(F.struct(*[F.col(f) for f in COLUMN_STRUCT_FIELDS])).alias("columns"))
    if constraints is None:
        return cols
    keyed = constraint_columns_ordered(constraints)
    ks = keyed.groupBy("schema_name", "table_name").agg(
        F.collect_list(F.struct("constraint_name", "constraint_type", "columns")).alias("constraints"))
    return cols.join(ks, ["schema_name", "table_name"], "left")


def constraint_columns_ordered(key_columns: DataFrame) -> DataFrame:
    """``(schema, table, constraint, type, column, position)`` rows to one
    row per constraint with its columns ordered by position (bounded: a key
    has at most a few dozen columns)."""
    return key_columns.groupBy("schema_name", "table_name", "constraint_name", "constraint_type").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("ordinal_position", "column_name"))),
                    lambda x: x["column_name"]).alias("columns"))


def definition_lines(columns: DataFrame, constraints: DataFrame | None = None,
                     tables: DataFrame | None = None, header: str = "") -> DataFrame:
    """Long form: one row per line of each table's definition.

    ``position`` and ``sort_key`` order lines inside a section (a column's
    ordinal; a constraint's rank and name).  The file text is the lines ordered
    by (section, position, sort_key), joined by ``,\\n`` inside the column/constraint
    sections.  ``constraints`` is already one row per constraint with an
    ordered ``columns`` array.  Without ``tables`` the tables are those that
    have columns.
    """
    if tables is None:
        tables = columns.select("schema_name", "table_name").distinct()
    col_rows = columns.select(
        "schema_name", "table_name", F.lit(SECTION_COLUMN).alias("section"),
        F.col("ordinal_position").cast("bigint").alias("position"), F.lit("").alias("sort_key"),
        F.struct(*[F.col(f) for f in COLUMN_STRUCT_FIELDS]).alias("_c"))
    parts = [col_rows.withColumn("line", F.expr(column_line_sql("_c"))).drop("_c")]
    if constraints is not None:
        parts.append(constraints.select(
            "schema_name", "table_name", F.lit(SECTION_CONSTRAINT).alias("section"),
            constraint_rank(F.col("constraint_type")).cast("bigint").alias("position"),
            F.col("constraint_name").alias("sort_key"),
            F.struct("constraint_name", "constraint_type", "columns").alias("_k"))
            .withColumn("line", F.expr(constraint_line_sql("_k"))).drop("_k"))
    def edge(section: int, line: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), F.lit(0).cast("bigint").alias("position"),
                        F.lit("").alias("sort_key"), line.alias("line"))

    head = F.concat(F.lit(header), create_line(F.col("schema_name"), F.col("table_name")))
    parts.append(tables.select("schema_name", "table_name", F.inline(F.array(
        edge(SECTION_CREATE, head), edge(SECTION_CLOSE, F.lit(");"))))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_definitions(lines: DataFrame, folder: str) -> None:
    """Write every table of ``lines`` (from :func:`definition_lines`) as one text
    file, ``folder/schema_name=<schema>/table_name=<table>/``.

    A table's lines meet in one task, are sorted there (on disk, if need be) and
    written as they come, so no row holds a table, however many columns it has."""
    items = F.col("section").isin(SECTION_COLUMN, SECTION_CONSTRAINT)
    order = ["section", "position", "sort_key"]
    last = lines.filter(items).groupBy("schema_name", "table_name").agg(F.max(F.struct(*order)).alias("last"))
    ended = lines.join(last, ["schema_name", "table_name"], "left").select(
        "schema_name", "table_name", *order,
        F.when(items & (F.struct(*order) < F.col("last")), F.concat("line", F.lit(","))).otherwise(F.col("line")).alias("value"))
    (ended.repartition("schema_name", "table_name").sortWithinPartitions("schema_name", "table_name", *order)
     .select("value", "schema_name", "table_name")
     .write.mode("overwrite").partitionBy("schema_name", "table_name").text(folder))


# --------------------------------------------------------------------------
# Parse definitions back into columns (line-based)
# --------------------------------------------------------------------------

_NAME = r"\[(?:[^\]]++|\]\])++\]"  # ]] stands for a bracket
# The exported text: CREATE TABLE [schema].[table] ( items );
_TABLE = rf"(?is)CREATE\s+TABLE\s+(?:{_NAME}\s*\.\s*)?{_NAME}\s*\((.*)\)\s*;?\s*$"
# What commas do not split: quoted text ('' stands for a quote), a bracketed name, and parentheses, which
# hold such parts and further parentheses down to NESTING levels.
_QUOTED = r"'(?:[^']++|'')*+'"
NESTING = 8


def _parenthesized(levels: int) -> str:
    inner = rf"[^()'\[\]]++|{_QUOTED}|{_NAME}"
    return rf"\((?:{inner}{'|' + _parenthesized(levels - 1) if levels > 1 else ''})*+\)"


_ITEM = rf"(?:[^,'()\[\]]++|{_QUOTED}|{_NAME}|{_parenthesized(NESTING)})++"
_PAIRED = rf"^(?:{_ITEM}|,)*+\z"
# The exported line: [name] TYPE [DEFAULT value] [NULL or NOT NULL].
_COLUMN = (r"(?is)^\s*\[((?:[^\]]++|\]\])++)\]\s+"
           r"((\S+(?:\s+(?!DEFAULT\s|NOT\s+NULL|NULL\b)[^\s,]+)*)(?:\s+DEFAULT\s.+?)?(?:\s+(?:NOT\s+)?NULL)?)[\s,]*$")


def parse_definition_columns(definitions: DataFrame, text_col: str = "definition",
                             key_cols: Sequence[str] = ("qualified_name",)) -> DataFrame:
    """Columns of exported ``CREATE TABLE`` texts: one row per column with
    its 1-based item position (constraint items count but are skipped).

    Items are split at commas outside quotes, brackets and parentheses.  Reads
    the exporter's own layout and is no SQL parser.  A text that is no such
    table, or whose quotes, brackets or parentheses do not pair up, gives no row
    here and one in :func:`unparsed_definitions`.
    """
    body = F.regexp_extract(F.col(text_col), _TABLE, 1)
    items = definitions.select(*key_cols, body.alias("body")).filter(F.col("body").rlike(_PAIRED)).select(
        *key_cols, F.posexplode(F.regexp_extract_all("body", F.lit(_ITEM), F.lit(0))).alias("pos", "item"))
    return items.withColumn("column_name", F.regexp_extract("item", _COLUMN, 1)).filter("column_name <> ''").select(
        *key_cols,
        F.replace(F.col("column_name"), F.lit("]]"), F.lit("]")).alias("column_name"),
        (F.col("pos") + 1).cast("int").alias("ordinal"),
        F.regexp_extract("item", _COLUMN, 3).alias("type_sql"),
        F.regexp_extract("item", _COLUMN, 2).alias("column_definition"),
    )


def unparsed_definitions(definitions: DataFrame, text_col: str = "definition",
                         key_cols: Sequence[str] = ("qualified_name",)) -> DataFrame:
    """Table definitions that cannot be read back, with the reason."""
    text = F.col(text_col)
    reason = (F.when(text.isNull() | ~text.rlike(r"(?i)CREATE\s+TABLE"), F.lit("no CREATE TABLE"))
              .when(~text.rlike(_TABLE), F.lit("no list of columns after the table name"))
              .when(~F.regexp_extract(text, _TABLE, 1).rlike(_PAIRED),
                    F.lit("quotes, brackets or parentheses without their pair")))
    return definitions.select(*key_cols, reason.alias("error")).filter(F.col("error").isNotNull())


# --------------------------------------------------------------------------
# Modules (views, procedures)
# --------------------------------------------------------------------------

# What a body without a verb of its own gets before and after its name, by kind of object.
MODULE_HEADS = {"V": ("CREATE VIEW ", " AS\n"), "P": ("CREATE PROCEDURE ", "\nAS\n"), "PC": ("CREATE PROCEDURE ", "\nAS\n")}
EMPTY_TEXT = "empty_text"
# The verb of a text that can be run as it is, or once more.
_VERB = r"(?i)^(?:(ALTER)\s+(?:VIEW|PROC|PROCEDURE)\b|(CREATE)\s)"


def normalize_module(modules: DataFrame) -> DataFrame:
    """Make module text re-runnable: the verb of an ``ALTER`` of a view or
    procedure becomes ``CREATE OR ALTER``, a ``CREATE`` stays, and a bare body
    gets the head of its kind (``MODULE_HEADS``; other kinds have none).  A text
    of white space has no definition and the ``error`` code ``empty_text``."""
    name = F.concat(quote_identifier(F.col("schema_name")), F.lit("."), quote_identifier(F.col("object_name")))
    before, after = (F.create_map(*[F.lit(x) for kind, head in MODULE_HEADS.items() for x in (kind, head[i])])[
        F.col("object_type")] for i in (0, 1))
    text = F.col("_text")
    read = modules.withColumn("_text", strip_surrounding_whitespace(F.col("definition")))
    again, as_is = (F.regexp_extract(text, _VERB, group) != "" for group in (1, 2))
    whole = (F.when(again, F.concat(F.lit("CREATE OR ALTER"), F.substr(text, F.lit(len("ALTER") + 1))))
             .when(as_is | before.isNull(), text)
             .otherwise(F.concat(before, name, after, text)))
    return read.select("schema_name", "object_name", "object_type", F.when(text != "", whole).alias("definition"),
                       F.when(text == "", F.lit(EMPTY_TEXT)).alias("error"))


# --------------------------------------------------------------------------
# Artifacts and manifest
# --------------------------------------------------------------------------

# Export folder per object type.
FOLDER_OF = {"table": "tables", "view": "views", "procedure": "procedures"}


def artifacts(objs: DataFrame, object_type: Column | str, qualified_name: Column | str,
              content: Column | str, folder: Column | str | None = None) -> DataFrame:
    """``(object_type, qualified_name, relative_path, content, sha256)``."""
    ot = col_(object_type) if not isinstance(object_type, str) or object_type in objs.columns \
        else F.lit(object_type)
    fold = folder if folder is not None else _folder(ot)
    return objs.select(
        ot.alias("object_type"),
        col_(qualified_name).alias("qualified_name"),
        export_path(fold if not isinstance(fold, str) else F.lit(fold), col_(qualified_name))
        .alias("relative_path"),
        col_(content).alias("content"),
        F.sha2(col_(content), 256).alias("sha256"),
    )


def _folder(object_type: Column) -> Column:
    expr = F.concat(object_type, F.lit("s"))
    for t, f in FOLDER_OF.items():
        expr = F.when(object_type == F.lit(t), F.lit(f)).otherwise(expr)
    return expr


def manifest_counts(arts: DataFrame) -> DataFrame:
    """Object count per type (one partial aggregate)."""
    return arts.groupBy("object_type").agg(F.count(F.lit(1)).cast("bigint").alias("object_count"))


def names_in_order(arts: DataFrame) -> DataFrame:
    """The names of each object type in order: ``object_type, qualified_name,
    position`` (from 1 within the type) and the type's ``object_count``.

    One order over all artifacts gives the places (see
    :mod:`tidemark.operators.ordering`); a type's list is never gathered."""
    listed = numbered_in_order(arts.select("object_type", "qualified_name"), ["object_type", "qualified_name"], "place")
    types = listed.groupBy("object_type").agg(F.min("place").alias("first"),
                                              F.count(F.lit(1)).cast("bigint").alias("object_count"))
    return listed.join(types, "object_type").select(
        "object_type", "qualified_name", (F.col("place") - F.col("first") + 1).alias("position"), "object_count")


def manifest_files(arts: DataFrame) -> DataFrame:
    """The manifest's file map in long form: path -> (type, name, sha256)."""
    return arts.select("relative_path", "object_type", "qualified_name", "sha256")
