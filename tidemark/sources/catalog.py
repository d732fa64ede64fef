"""Catalog metadata as DataFrames.

Table lists and column lists are metadata: their size is the number of tables
and columns, not rows.  They are read from the session catalog or from the
schemas of DataFrames and turned into small long-form DataFrames that the
contract joins use.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import spark_identifier
from tidemark.functions.types import spark_type_name
from tidemark.operators import assembly
from tidemark.operators.assembly import user_schemas
from tidemark.operators.migrations import NOT_NULL_PROPERTY
from tidemark.session import local_frame

TABLES_SCHEMA = "table_name string, table_type string"
COLUMNS_SCHEMA = "table_name string, column_name string, ordinal bigint, data_type string, nullable boolean"


def available_tables(spark: SparkSession, tables: Mapping[str, DataFrame] | None = None,
                     database: str | None = None) -> DataFrame:
    """Existing tables, lower-cased: from a name -> DataFrame mapping when
    given, else from the session catalog (``SHOW TABLES``)."""
    if tables is not None:
        rows = [(name.lower(), "TABLE") for name in tables]
    else:
        rows = [(t.name.lower(), (t.tableType or "").upper())
                for t in spark.catalog.listTables(database)]
    return local_frame(spark, rows, TABLES_SCHEMA)


def actual_columns(spark: SparkSession, tables: Mapping[str, DataFrame] | None = None,
                   names: list[str] | None = None) -> DataFrame:
    """``(table_name, column_name, ordinal, data_type, nullable)`` as
    ``DESCRIBE TABLE`` reports them (names lower-cased, types as Spark
    prints them)."""
    rows = []
    if tables is None:
        names = names if names is not None else [t.name for t in spark.catalog.listTables()]
        tables = {n: spark.table(n) for n in names}
    for name, df in tables.items():
        for i, f in enumerate(df.schema.fields, start=1):
            declared = f.metadata.get("__CHAR_VARCHAR_TYPE_STRING") or spark_type_name(f.dataType)
            rows.append((name.lower(), f.name.lower(), i, declared, bool(f.nullable)))
    return local_frame(spark, rows, COLUMNS_SCHEMA)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


CATALOG_COLUMNS_SCHEMA = (
    "schema_name string, table_name string, column_name string, ordinal_position int, data_type string, "
    "is_nullable boolean, column_default string, character_maximum_length int, numeric_precision int, "
    "numeric_scale int, datetime_precision int, comment string")


_LENGTH_TYPE = re.compile(r"(char|varchar)\((\d+)\)")


def _type_attributes(type_text: str, dt) -> tuple:
    """(base type name, char length, precision, scale, datetime precision) of
    a catalog type, in the catalog's terms."""
    from pyspark.sql import types as T
    sized = _LENGTH_TYPE.fullmatch(type_text)
    if sized:
        return (sized[1], int(sized[2]), None, None, None)
    if isinstance(dt, T.StringType):
        return ("string", -1, None, None, None)
    if isinstance(dt, T.DecimalType):
        return ("decimal", None, dt.precision, dt.scale, None)
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return (type_text, None, None, None, 6)
    return (type_text, None, None, None, None)


def _user_tables(spark: SparkSession, database: str, views: bool) -> list:
    return [t for t in spark.catalog.listTables(database)
            if not t.isTemporary and ((t.tableType or "").upper() == "VIEW") == views]


def _qualified(database: str, name: str) -> str:
    return f"{spark_identifier(database)}.{spark_identifier(name)}"


def _properties(spark: SparkSession, database: str, name: str) -> dict[str, str]:
    return {p["key"]: p["value"] for p in spark.sql(f"SHOW TBLPROPERTIES {_qualified(database, name)}").collect()}


def catalog_columns(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Columns of every table of a database with the attributes a table
    definition needs (type, length, precision, scale, nullability, default,
    comment).

    Lengths of ``char`` and ``varchar`` come from the field's metadata.  Spark's
    session catalog does not store NOT NULL of file tables; those columns are
    declared in the table property ``NOT_NULL_PROPERTY``, which
    :func:`tidemark.operators.migrations.ensure_table` writes.  Spark's catalog
    is served by the driver; the list is as long as the catalog's columns."""
    db = database or spark.catalog.currentDatabase()
    rows = []
    for t in _user_tables(spark, db, views=False):
        declared = json.loads(_properties(spark, db, t.name).get(NOT_NULL_PROPERTY, "[]"))
        for i, f in enumerate(spark.table(_qualified(db, t.name)).schema.fields, start=1):
            text = f.metadata.get("__CHAR_VARCHAR_TYPE_STRING") or f.dataType.simpleString()
            base, length, prec, scale, dtp = _type_attributes(text, f.dataType)
            rows.append((db, t.name, f.name, i, base, bool(f.nullable) and f.name not in declared,
                         f.metadata.get("CURRENT_DEFAULT"), length, prec, scale, dtp, f.metadata.get("comment")))
    return local_frame(spark, rows, CATALOG_COLUMNS_SCHEMA)


# A key constraint as a table property: tidemark.key.<name> = 'PRIMARY KEY (a, b)'.
KEY_PROPERTY = "tidemark.key."
_KEY_TEXT = re.compile(r"(?i)\s*(PRIMARY KEY|UNIQUE)\s*\((.*)\)\s*")
KEY_COLUMNS_SCHEMA = ("schema_name string, table_name string, constraint_name string, constraint_type string, "
                      "column_name string, ordinal_position int")


def catalog_keys(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Key columns of a database's tables, one row each.  The session catalog
    stores no constraints, so they are declared as table properties
    (``KEY_PROPERTY``); a property of another form is an error."""
    db = database or spark.catalog.currentDatabase()
    rows = []
    for t in _user_tables(spark, db, views=False):
        for name, text in _properties(spark, db, t.name).items():
            if name.startswith(KEY_PROPERTY):
                found = _KEY_TEXT.fullmatch(text)
                if not found:
                    raise ValueError(f"{db}.{t.name}: {name} is no key: {text!r}")
                name = name.removeprefix(KEY_PROPERTY)
                rows += [(db, t.name, name, found[1].upper(), c.strip().strip("`"), i)
                         for i, c in enumerate(found[2].split(","), start=1)]
    return local_frame(spark, rows, KEY_COLUMNS_SCHEMA)


def catalog_views(spark: SparkSession, database: str | None = None) -> DataFrame:
    """``(schema_name, object_name, object_type, definition)`` for the
    persistent views of a database (their stored query text)."""
    db = database or spark.catalog.currentDatabase()
    rows = []
    for t in _user_tables(spark, db, views=True):
        info = spark.sql(f"DESCRIBE TABLE EXTENDED {_qualified(db, t.name)}").collect()
        text = next((r["data_type"] for r in info if (r["col_name"] or "").strip() == "View Text"), "")
        rows.append((db, t.name, "V", text or ""))
    return local_frame(spark, rows, "schema_name string, object_name string, object_type string, "
                                       "definition string")


def schemata(spark: SparkSession) -> DataFrame:
    """Databases of the session catalog, without system ones."""
    names = local_frame(spark, [(d.name,) for d in spark.catalog.listDatabases()], "schema_name string")
    return user_schemas(names)


@dataclass
class CatalogViews:
    """A catalog put together from its views: user tables and views, the columns
    and keys of the tables, the texts of views and procedures, and what lacks
    its parts (``schema_name, object_name, error``)."""

    tables: DataFrame
    columns: DataFrame
    keys: DataFrame
    modules: DataFrame
    errors: DataFrame


def from_views(schemata: DataFrame, tables: DataFrame, columns: DataFrame, constraints: DataFrame, usage: DataFrame,
               modules: DataFrame, objects: DataFrame, schemas: DataFrame) -> CatalogViews:
    """The catalog whose views are these DataFrames (read over JDBC, or from an
    export): nothing of it passes through the driver.

    ``schemata`` has ``schema_name``; ``tables`` ``schema_name, table_name,
    table_type`` (``BASE TABLE`` or ``VIEW``); ``columns`` ``schema_name,
    table_name`` and the attributes of a column with ``is_nullable`` as ``YES`` or
    ``NO``; the others are as :func:`tidemark.operators.assembly.key_columns` and
    ``module_texts`` take them.  System schemas, schemas that ``schemata`` does not
    have, and parts of unknown tables are left out."""
    known = user_schemas(schemata).select("schema_name").distinct()
    mine = user_schemas(tables).join(known, "schema_name", "left_semi")
    base = assembly.of_kinds(mine, "table_type", ("BASE TABLE",))
    views = assembly.of_kinds(mine, "table_type", ("VIEW",))
    at = ["schema_name", "table_name"]
    typed = assembly.children_of(columns, base, at).withColumn("is_nullable", F.col("is_nullable") == F.lit("YES"))
    keys = assembly.children_of(assembly.key_columns(constraints, usage), base, at)
    texts = assembly.module_texts(modules, objects, schemas)
    lone = assembly.tables_without_columns(base, typed).withColumnRenamed("table_name", "object_name")
    blank = assembly.views_without_text(views.withColumnRenamed("table_name", "object_name"), texts)
    return CatalogViews(mine, typed, keys, texts, lone.unionByName(blank))
