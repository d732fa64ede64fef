"""Type names and version numbers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import col_, strip_surrounding_whitespace

# Type-name aliases folded before comparing a contract type with
# an actual type.  Everything else is only trimmed and lower-cased.
TYPE_ALIASES = {
    "integer": "int",
    "bool": "boolean",
}


def normalize_type(type_name: Column | str) -> Column:
    """Trim, lower-case, fold aliases."""
    t = F.lower(strip_surrounding_whitespace(type_name))
    expr = t
    for alias, canonical in TYPE_ALIASES.items():
        expr = F.when(t == F.lit(alias), F.lit(canonical)).otherwise(expr)
    return expr


def normalize_type_name(type_name: str) -> str:
    """Driver-side twin of :func:`normalize_type` for contract literals."""
    t = str(type_name).strip().lower()
    return TYPE_ALIASES.get(t, t)


def version_number(text: Column | str) -> Column:
    """Digits of a version label as a number; no digits -> 0 (``v002`` -> 2).

    A decimal of 38 digits; a label of more digits has no number (null)."""
    digits = F.coalesce(F.regexp_replace(col_(text), "[^0-9]", ""), F.lit(""))
    return F.when(digits == "", F.lit(0)).otherwise(digits.try_cast("decimal(38,0)"))


def version_number_of(text: str) -> int:
    """Driver-side twin of :func:`version_number`."""
    digits = "".join(ch for ch in str(text) if "0" <= ch <= "9")
    return int(digits) if digits else 0


def spark_type_name(data_type: T.DataType) -> str:
    """Type name as ``DESCRIBE TABLE`` prints it (``bigint``, ``array<float>``)."""
    return data_type.simpleString()


# SQL Server type families rendered with a length, with a
# precision and scale, with a fractional-second precision, or with a float
# precision.
LENGTH_TYPES = ("CHAR", "NCHAR", "VARCHAR", "NVARCHAR", "BINARY", "VARBINARY")
DECIMAL_TYPES = ("DECIMAL", "NUMERIC")
TIME_PRECISION_TYPES = ("TIME", "DATETIME2", "DATETIMEOFFSET")


def format_data_type_sql(data_type: str, char_length: str, numeric_precision: str, numeric_scale: str,
                         datetime_precision: str) -> str:
    """SQL text that renders a catalog type with its length / precision / scale
    (arguments are SQL expressions).

    ``-1`` length renders as ``MAX``; a missing length or precision renders the
    bare name; a missing scale is 0.
    """
    def one_of(names):
        return f"upper({data_type}) IN (" + ", ".join(f"'{n}'" for n in names) + ")"

    arguments = (f"CASE WHEN {one_of(LENGTH_TYPES)} "
                 f"THEN if({char_length} = -1, 'MAX', CAST({char_length} AS STRING)) "
                 f"WHEN {one_of(DECIMAL_TYPES)} THEN concat({numeric_precision}, ',', coalesce({numeric_scale}, 0)) "
                 f"WHEN {one_of(TIME_PRECISION_TYPES)} THEN CAST({datetime_precision} AS STRING) "
                 f"WHEN {one_of(('FLOAT',))} THEN CAST({numeric_precision} AS STRING) END")
    return f"concat(upper({data_type}), coalesce(concat('(', {arguments}, ')'), ''))"


def format_data_type(data_type: str, char_length: str, numeric_precision: str, numeric_scale: str,
                     datetime_precision: str) -> Column:
    """:func:`format_data_type_sql` as a column."""
    return F.expr(format_data_type_sql(data_type, char_length, numeric_precision, numeric_scale, datetime_precision))
