"""Putting catalog result sets together: filters, joins, and what is missing.

Inputs are long DataFrames as a catalog's views give them (tables, columns,
constraints and their key columns, modules, objects, schemas).  Joins are equi
joins on names or ids; nothing is gathered per schema or per table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Schemas that hold the catalog itself; the module kinds view,
# procedure and compiled procedure; the key constraints.
SYSTEM_SCHEMAS = ("INFORMATION_SCHEMA", "sys")
MODULE_KINDS = ("V", "P", "PC")
KEY_KINDS = ("PRIMARY KEY", "UNIQUE")

# What identifies a constraint on a table.
CONSTRAINT_KEY = ("constraint_catalog", "constraint_schema", "constraint_name", "schema_name", "table_name")


def user_schemas(df: DataFrame, schema_col: str = "schema_name",
                 system: Sequence[str] = SYSTEM_SCHEMAS) -> DataFrame:
    """Rows whose schema is known and outside the system schemas (as with SQL's
    ``NOT IN``, a null schema is left out)."""
    return df.filter(~F.col(schema_col).isin(*system))


def of_kinds(df: DataFrame, kind_col: str, kinds: Sequence[str]) -> DataFrame:
    return df.filter(F.col(kind_col).isin(*kinds))


def key_columns(constraints: DataFrame, usage: DataFrame, kinds: Sequence[str] = KEY_KINDS) -> DataFrame:
    """Key constraints joined to the columns they use, one row per key column:
    ``schema_name, table_name, constraint_name, constraint_type, column_name,
    ordinal_position``."""
    kept = of_kinds(user_schemas(constraints), "constraint_type", kinds)
    return kept.join(usage, list(CONSTRAINT_KEY)).select(
        "schema_name", "table_name", "constraint_name", "constraint_type", "column_name", "ordinal_position")


def module_texts(modules: DataFrame, objects: DataFrame, schemas: DataFrame,
                 kinds: Sequence[str] = MODULE_KINDS, system: Sequence[str] = SYSTEM_SCHEMAS) -> DataFrame:
    """Modules with the names of their object and schema: ``modules`` has
    ``object_id, definition``; ``objects`` has ``object_id, schema_id,
    object_name, object_type``; ``schemas`` has ``schema_id, schema_name``."""
    named = of_kinds(objects, "object_type", kinds).join(user_schemas(schemas, system=system), "schema_id")
    return modules.join(named, "object_id").select("schema_name", "object_name", "object_type", "definition")


def children_of(children: DataFrame, parents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Children whose parent is known; others are left out, not reported."""
    return children.join(parents.select(*keys).distinct(), list(keys), "left_semi")


def missing_parts(parents: DataFrame, parts: DataFrame, keys: Sequence[str], error: str) -> DataFrame:
    """One error row per parent without any part: its keys and ``error``."""
    lone = parents.select(*keys).join(parts.select(*keys).distinct(), list(keys), "left_anti")
    return lone.withColumn("error", F.lit(error))


def views_without_text(views: DataFrame, modules: DataFrame) -> DataFrame:
    """Views of the catalog that no module defines."""
    texts = of_kinds(modules, "object_type", ("V",))
    return missing_parts(views, texts, ("schema_name", "object_name"), "view without text")


def tables_without_columns(tables: DataFrame, columns: DataFrame) -> DataFrame:
    return missing_parts(tables, columns, ("schema_name", "table_name"), "table without columns")


def catalog_order(df: DataFrame, *by: str) -> DataFrame:
    """Presentation order of a catalog listing.  Call at the edge only."""
    return df.orderBy(*by)
