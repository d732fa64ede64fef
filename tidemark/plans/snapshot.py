"""Export a Spark catalog as a snapshot folder and compare two snapshots.

``artifacts_of`` renders every table of a database as a ``CREATE TABLE`` text
(columns and declared keys) and every view from its stored query; ``write``
exports them as tables with a manifest and a summary.  ``compare`` loads two
exports and returns the drift report DataFrames, with column drift parsed back
from the table definitions.

Spark's catalog is served by the driver, so its table and column lists are read
there; the per-object work (render, hash, write) runs on Spark.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.hashing import bundle_hash_tree
from tidemark.operators import render
from tidemark.plans.drift_report import drift_report
from tidemark.sources.catalog import catalog_columns, catalog_keys, catalog_views
from tidemark.session import local_frame
from tidemark.sources.corpus import OBJECTS_SCHEMA, PUBLISHED_SCHEMA, published_versions, read_snapshot


def artifacts_of(spark: SparkSession, database: str | None = None, extracted_at: str | None = None,
                 endpoint: str | None = None) -> DataFrame:
    """Rendered artifacts of a database's tables and views; a view without text
    is an error."""
    db = database or spark.catalog.currentDatabase()
    header = render.header_text(extracted_at, endpoint, db)
    cols = catalog_columns(spark, db)
    tables = render.render_table_text(render.collect_table_arrays(cols, catalog_keys(spark, db)), header)
    table_arts = render.artifacts(tables, "table", "qualified_name", "definition")
    modules = render.normalize_module(catalog_views(spark, db))
    empty = [r.error for r in modules.filter("error IS NOT NULL").select("error").orderBy("error").limit(20).collect()]
    if empty:
        raise ValueError("; ".join(empty))
    views = modules.select(
        F.concat(F.col("schema_name"), F.lit("."), F.col("object_name")).alias("qualified_name"),
        F.concat(F.lit(header), F.col("definition"), F.lit("\n")).alias("definition"))
    view_arts = render.artifacts(views, "view", "qualified_name", "definition")
    return table_arts.unionByName(view_arts)


class CollidingPaths(Exception):
    """Objects that would be exported under the same path."""


def write(arts: DataFrame, export_dir: str, extracted_at: str | None = None, endpoint: str | None = None,
          auth_method: str | None = None, database: str | None = None) -> None:
    """Export artifacts: the table ``objects``, the ``manifest`` in long form (a
    JSON row per object) and ``summary`` (counts per type and the bundle hash,
    with where and how the catalog was read).

    Paths are compared before anything is written (letter case aside), and
    colliding ones raise.  The artifacts are planned once more for the export
    itself; manifest and summary come from what was written.

    Everything goes to a new folder under ``versions``, and only then one row in
    ``published`` (one file, so it is there or not) makes that folder the
    export's current one.  Readers follow the newest row: until it is written,
    and if a step fails, they see the previous export whole.  Older versions
    stay until their owner deletes them."""
    clash = (arts.groupBy(F.lower("relative_path").alias("path")).agg(F.count(F.lit(1)).alias("n"))
             .filter("n > 1").orderBy("path").limit(20).collect())
    if clash:
        raise CollidingPaths(", ".join(r.path for r in clash))
    spark = arts.sparkSession
    version = uuid.uuid4().hex
    staged = f"{export_dir}/versions/{version}"
    arts.select("relative_path", "object_type", "qualified_name", "sha256", "content").write.parquet(f"{staged}/objects")
    objects = spark.read.schema(OBJECTS_SCHEMA).parquet(f"{staged}/objects")
    bundles = bundle_hash_tree(objects, ["object_type"], content_col="sha256", content_is_digest=True, total="*")
    schema = F.regexp_extract("qualified_name", r"^([^.]*)\.", 1)
    schemas = objects.groupBy(F.lit("*").alias("object_type")).agg(F.count_distinct(schema).alias("schemas"))
    bundles.join(schemas, "object_type", "left").select(
        "object_type", "artifact_count", "bundle_sha256", "schemas", F.lit(extracted_at).alias("extraction_timestamp"),
        F.lit(endpoint).alias("endpoint"), F.lit(auth_method).alias("auth_method"), F.lit(database).alias("database"),
    ).write.json(f"{staged}/summary")
    render.manifest_files(objects).write.json(f"{staged}/manifest")  # after all that it describes
    last = max((p.sequence for p in published_versions(spark, export_dir)), default=0)
    local_frame(spark, [(last + 1, version)], PUBLISHED_SCHEMA).coalesce(1).write.mode("append") \
        .json(f"{export_dir}/published")


def compare(spark: SparkSession, left_dir: str, right_dir: str, ignore=None) -> dict[str, DataFrame]:
    """Drift report between two exported snapshots.  An incomplete snapshot, or
    a table definition that cannot be read back, raises."""
    _, left = read_snapshot(spark, left_dir)
    _, right = read_snapshot(spark, right_dir)
    return drift_report(left, right, _columns(left), _columns(right), ignore=ignore)


def _columns(objs: DataFrame) -> DataFrame:
    defs = objs.filter(F.col("category") == "tables").select("name", "definition")
    bad = render.unparsed_definitions(defs, key_cols=("name",)).orderBy("name").limit(20).collect()
    if bad:
        raise ValueError("; ".join(f"{r.name}: {r.error}" for r in bad))
    cols = render.parse_definition_columns(defs, key_cols=("name",))
    return cols.select("name", "column_name", F.col("ordinal").cast("bigint").alias("ordinal"), "type_sql",
                       F.col("column_definition").alias("definition"))
