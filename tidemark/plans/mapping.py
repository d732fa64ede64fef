"""How the driver's tables stand in for the domain's inputs.

The reference works on a catalog of tables, a folder of migration scripts, a
migration history and two schema snapshots.  The driver ships TPC-H-like
tables plus text corpora, so each domain input is *derived* from them with
row-level rules (no id subsets, no sampling); every derived input grows with
the tables it comes from.

* snapshot objects   - one object per document: category = ``lang``,
  name = ``<source>.doc<doc_id>``, definition = ``text``.  The compared
  ("live") snapshot drops documents labelled toxic, rewrites documents
  labelled low quality, re-cases and comments documents labelled high quality
  (a change drift must *not* see), and adds one view per web page.
* table columns      - one table per conversation, one column per turn, the
  column type decided by the role; the live side drops system turns, widens
  long user turns, relaxes nullability of long assistant turns, adds a note
  column after short user turns and adds one table per benchmark item.
* migration scripts  - one script per document, file name from a version, the
  source and the language; see ``script_content``.
* migration history  - one run per labelled document, ``success`` when the
  label says quality 1.
* catalog            - one table per order whose columns are the order's own
  fields, with types derived from the values; one module per conversation
  turn.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed parameters of the derived history and run.
APPLIED_AT = _dt.datetime(2031, 5, 6, 7, 8, 9)
RUN_BY = "tidemark"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the driver's folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Session setting: deal the inputs of text work to so many partitions.
SPLIT_SETTING = "spark.tidemark.input.partitions"


def load_split(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """:func:`load` for inputs of text work.  The driver writes a table as one
    row group, which no reader setting can split; a session that wants such a
    table on many cores says so in ``SPLIT_SETTING``.  Unset, as it should be
    for tables of many files, the scan is left as it is."""
    parts = spark.conf.get(SPLIT_SETTING, None)
    df = load(spark, sf_dir, name)
    return df.repartition(int(parts)) if parts else df


class Tables(Mapping):
    """The driver's tables by name, each loaded when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._loaded = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._loaded:
            if name not in TABLES:
                raise KeyError(name)
            self._loaded[name] = load(self.spark, self.sf_dir, name)
        return self._loaded[name]

    def __iter__(self):
        return iter(TABLES)

    def __len__(self) -> int:
        return len(TABLES)

    def __contains__(self, name: object) -> bool:
        return name in TABLES


def load_all(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


# --------------------------------------------------------------------------
# Snapshot objects
# --------------------------------------------------------------------------

def doc_name() -> Column:
    return F.concat(F.col("source"), F.lit(".doc"), F.col("doc_id").cast("string"))


def baseline_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.functions.text import export_path
    d = load_split(spark, sf_dir, "documents")
    return d.select(F.col("lang").alias("category"), doc_name().alias("name"),
                    F.col("text").alias("definition"),
                    export_path(F.col("lang"), doc_name()).alias("relative_path"))


def live_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.functions.text import export_path
    d = load_split(spark, sf_dir, "documents")
    lab = load(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    j = d.join(lab, "doc_id", "left").filter(F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    definition = (F.when(F.col("quality") == 0, F.concat(F.col("text"), F.lit("\nREVISED")))
                  .when(F.col("quality") == 1, F.concat(F.lower(F.col("text")), F.lit("  -- reviewed")))
                  .otherwise(F.col("text")))
    docs = j.select(F.col("lang").alias("category"), doc_name().alias("name"),
                    definition.alias("definition"),
                    export_path(F.col("lang"), doc_name()).alias("relative_path"))
    p = load_split(spark, sf_dir, "pages")
    page_name = F.concat(F.lit("page"), F.col("page_id").cast("string"))
    pages = p.select(F.lit("views").alias("category"), page_name.alias("name"),
                     F.col("html").alias("definition"),
                     export_path(F.lit("views"), page_name).alias("relative_path"))
    return docs.unionByName(pages)


# --------------------------------------------------------------------------
# Table columns (conversations)
# --------------------------------------------------------------------------

def _conv_columns(c: DataFrame, live: bool) -> DataFrame:
    role = F.col("role")
    long_text = F.length("text")
    typ = F.when(role == "user", F.lit("NVARCHAR(4000)")).otherwise(F.lit("NVARCHAR(MAX)"))
    nullability = F.lit(" NOT NULL")
    if live:
        c = c.filter(role != "system")
        typ = F.when((role == "user") & (long_text > 200), F.lit("NVARCHAR(MAX)")).otherwise(typ)
        nullability = F.when((role == "assistant") & (long_text > 1500), F.lit(" NULL")).otherwise(nullability)
    turn = F.concat(F.lit("turn_"), F.col("turn").cast("string"))
    column = F.struct(turn.alias("column_name"), F.col("turn").cast("bigint").alias("ordinal"),
                      typ.alias("type_sql"), F.concat(typ, nullability).alias("definition"))
    note = F.struct(F.concat(turn, F.lit("_note")).alias("column_name"),
                    (F.col("turn") + 100).cast("bigint").alias("ordinal"),
                    F.lit("NVARCHAR(200)").alias("type_sql"), F.lit("NVARCHAR(200) NULL").alias("definition"))
    columns = F.array(column)
    if live:
        columns = F.when((role == "user") & (long_text < 60), F.array(column, note)).otherwise(columns)
    return c.select(F.concat(F.lit("conv"), F.col("conv_id").cast("string")).alias("name"), F.inline(columns))


def baseline_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conv_columns(load(spark, sf_dir, "conversations"), live=False)


def live_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = _conv_columns(load(spark, sf_dir, "conversations"), live=True)
    b = load(spark, sf_dir, "benchmark")
    bench = b.select(F.concat(F.lit("bench"), F.col("item_id").cast("string")).alias("name"),
                     F.lit("body").alias("column_name"), F.lit(1).cast("bigint").alias("ordinal"),
                     F.lit("NVARCHAR(MAX)").alias("type_sql"), F.lit("NVARCHAR(MAX) NOT NULL").alias("definition"))
    return cols.unionByName(bench)


# --------------------------------------------------------------------------
# Migration scripts and history
# --------------------------------------------------------------------------

def script_name(numbers: int | None = None) -> Column:
    """File name of the script a document stands for.  Versions grow with the
    documents and leave gaps: a first one of 1 to 5, then one of every three
    numbers; some scripts have version 0 and some one beyond a bigint.
    ``numbers`` keeps versions below that many steps, for rules that take names
    of three digits only."""
    step = F.floor(F.col("doc_id") / 2)
    n = (step if numbers is None else step % numbers) * 3 + 6 + F.col("n_chars") % 2
    version = (F.when(F.col("n_chars") % 29 == 0, F.lit("000"))
               .when(F.col("n_chars") % 31 == 0, F.lit("99999999999999999999"))
               .otherwise(F.format_string("%03d", n.cast("bigint"))))
    lang = F.col("lang")
    stem = F.concat(F.lit("v"), version, F.lit("_"), F.col("source"))
    name = (F.when(lang == "en", F.concat(stem, F.lit(".sql")))
            .when(lang == "de", F.concat(stem, F.lit("_de.sql")))
            .when(lang == "fr", F.concat(stem, F.lit(".py")))
            .otherwise(F.concat(stem, F.lit("-ES.sql"))))
    return F.when(F.col("n_chars") < 200, F.concat(F.lit("draft_"), name)).otherwise(name)


def script_content() -> Column:
    """Text of the script: the document's, with a statement before it or blank
    for some lengths, so that every lint rule has scripts that keep and scripts
    that break it."""
    kind, text = F.col("n_chars") % 17, F.col("text")
    return (F.when(kind == 3, F.lit(" \n\t"))
            .when(kind == 5, F.concat(F.lit("ALTER TABLE t ADD (a INT; "), text))
            .when(kind == 7, F.concat(F.lit("CREATE TABLE t (a INT); DROP SCHEMA old; "), text))
            .when(kind == 9, F.concat(F.lit("CREATE TABLE t (a INT) -- def run(x)\n"), text))
            .otherwise(text))


def script_files(spark: SparkSession, sf_dir: str, numbers: int | None = None) -> DataFrame:
    """``(doc_id, file_name, content, n_chars)`` - the script corpus."""
    return load_split(spark, sf_dir, "documents").select(
        "doc_id", script_name(numbers).alias("file_name"), script_content().alias("content"), "n_chars", "source", "lang")


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed migration history: one run per labelled document."""
    from tidemark.operators.migrations import parse_names, timestamp_literal
    files = parse_names(script_files(spark, sf_dir))
    lab = load(spark, sf_dir, "labels").select("doc_id", "quality")
    j = files.join(lab, "doc_id")
    return j.select(
        F.coalesce(F.col("migration_id"), F.col("file_name")).alias("migration_id"),
        F.col("file_name").alias("migration_name"),
        timestamp_literal(APPLIED_AT, "timestamp_ntz").alias("applied_at"),
        F.col("source").alias("applied_by"),
        F.when(F.col("file_name").endswith(".py"), F.lit("pyspark")).otherwise(F.lit("sql")).alias("migration_type"),
        F.when(F.col("quality") == 1, F.lit("success")).otherwise(F.lit("failed")).alias("status"),
        (F.col("n_chars") / F.lit(1000.0)).alias("duration_seconds"),
    )


# --------------------------------------------------------------------------
# Catalog: orders as tables, conversation turns as modules
# --------------------------------------------------------------------------

def _order_parts(spark: SparkSession, sf_dir: str, live: bool):
    """(orders, schema, table, column structs in ordinal order, constraint
    structs with the primary key first) for the per-order catalog tables.

    ``live`` is the compared catalog: pending orders' tables are gone,
    finished orders' price column is two digits wider (a type change), and
    high-priority orders' customer column became NOT NULL (a nullability-only
    change)."""
    o = load_split(spark, sf_dir, "orders")
    if live:
        o = o.filter(F.col("o_orderstatus") != "P")

    def col(name, ordinal, data_type, length=None, precision=None, scale=None, dtp=None,
            nullable=F.lit(True), default=None):
        def lit_or(x, t):
            return F.lit(None).cast(t) if x is None else x.cast(t)
        return F.struct(F.lit(name).alias("column_name"), F.lit(ordinal).alias("ordinal_position"),
                        F.lit(data_type).alias("data_type") if isinstance(data_type, str) else data_type.alias("data_type"),
                        lit_or(length, "int").alias("character_maximum_length"),
                        lit_or(precision, "int").alias("numeric_precision"),
                        lit_or(scale, "int").alias("numeric_scale"),
                        lit_or(dtp, "int").alias("datetime_precision"),
                        nullable.alias("is_nullable"),
                        lit_or(default, "string").alias("column_default"))

    price_digits = F.length(F.floor(F.col("o_totalprice")).cast("string")) + 2
    custkey_nullable = F.lit(True)
    if live:
        price_digits = price_digits + F.when(F.col("o_orderstatus") == "F", F.lit(2)).otherwise(F.lit(0))
        custkey_nullable = ~F.col("o_orderpriority").startswith("2")
    columns = [
        col("o_orderkey", 1, "bigint", nullable=F.lit(False)),
        col("o_custkey", 2, "bigint", nullable=custkey_nullable),
        col("o_orderstatus", 3, "nchar", length=F.lit(1), nullable=F.lit(False),
            default=F.concat(F.lit("('"), F.col("o_orderstatus"), F.lit(", [b] INT, CONSTRAINT [c] (it''s')"))),
        col("o_totalprice", 4, "decimal", precision=price_digits, scale=F.lit(2)),
        col("o_orderdate", 5, "datetime2", dtp=F.month("o_orderdate") % 8),
        col("o_orderpriority", 6, F.when(F.col("o_orderpriority").startswith("1"), F.lit("nvarchar"))
            .otherwise(F.lit("varchar")),
            length=F.when(F.col("o_orderpriority").startswith("5"), F.lit(-1))
            .otherwise(F.length("o_orderpriority"))),
    ]
    key = F.col("o_orderkey").cast("string")
    constraints = [
        F.struct(F.concat(F.lit("pk_order"), key).alias("constraint_name"),
                 F.lit("PRIMARY KEY").alias("constraint_type"),
                 F.array(F.lit("o_orderkey")).alias("columns")),
        F.struct(F.concat(F.lit("uq_order"), key).alias("constraint_name"),
                 F.lit("UNIQUE").alias("constraint_type"),
                 F.array(F.lit("o_custkey"), F.lit("o_orderdate")).alias("columns")),
    ]
    schema = F.concat(F.lit("c"), F.col("o_custkey").cast("string"))
    table = F.concat(F.lit("order"), key)
    return o, schema, table, columns, constraints


def order_tables(spark: SparkSession, sf_dir: str, live: bool = False) -> DataFrame:
    """One catalog table per order with its columns and constraints as
    arrays of structs (the generic input of ``render_table_text``)."""
    o, schema, table, columns, constraints = _order_parts(spark, sf_dir, live)
    return o.select(schema.alias("schema_name"), table.alias("table_name"),
                    F.array(*columns).alias("columns"), F.array(*constraints).alias("constraints"))


def order_table_texts(spark: SparkSession, sf_dir: str, live: bool = False,
                      digest: str | None = None) -> DataFrame:
    """The rendered definition of every per-order table, with the ``digest`` of
    its columns if a name for it is given.  The column and constraint lists are
    fixed per row, so the lines are plain expressions (``render_rows``); same
    text as rendering :func:`order_tables`."""
    from tidemark.operators.render import render_rows
    o, schema, table, columns, constraints = _order_parts(spark, sf_dir, live)
    return render_rows(o, schema, table, columns, constraints, digest=digest)


def modules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One module per conversation turn: system turns arrive as ``ALTER
    VIEW`` text, long user turns as ``CREATE VIEW``, short ones blank, the rest
    as bare bodies (assistant turns are procedures)."""
    c = load_split(spark, sf_dir, "conversations")
    role = F.col("role")
    obj = F.concat(F.lit("conv"), F.col("conv_id").cast("string"), F.lit("_t"), F.col("turn").cast("string"))
    definition = (F.when(role == "system", F.concat(F.lit("ALTER VIEW "), obj, F.lit(" AS\n"), F.col("text")))
                  .when((role == "user") & (F.length("text") > 200),
                        F.concat(F.lit("create view "), obj, F.lit(" as "), F.col("text")))
                  .when((role == "user") & (F.length("text") < 60), F.lit(" \n "))
                  .otherwise(F.col("text")))
    return c.select(role.alias("schema_name"), obj.alias("object_name"),
                    F.when(role == "assistant", F.lit("P")).otherwise(F.lit("V")).alias("object_type"),
                    definition.alias("definition"))


# --------------------------------------------------------------------------
# Artifacts
# --------------------------------------------------------------------------

def doc_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One export artifact per document; the object type follows the language."""
    from tidemark.operators.render import artifacts
    d = load_split(spark, sf_dir, "documents")
    ot = (F.when(F.col("lang") == "en", F.lit("table"))
          .when(F.col("lang") == "fr", F.lit("view")).otherwise(F.lit("procedure")))
    qn = F.concat(F.lit("dbo."), F.col("source"), F.lit(":doc"), F.col("doc_id").cast("string"))
    return artifacts(d, ot, qn, F.col("text"))
