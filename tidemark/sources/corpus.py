"""Script corpora and snapshot folders as DataFrames.

A folder of scripts is read with ``wholetext=True`` (one row per file - note
that ``option("wholetext", True)`` is silently ignored by ``text()``) and the
file name comes from the hidden ``_metadata`` column, so no listing happens
on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import export_path
from tidemark.operators.drift import singular

def read_scripts(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``(file_name, file_path, content)``, one row per file under ``path``."""
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.text(path, wholetext=True)
    return df.select(F.col("_metadata.file_name").alias("file_name"),
                     F.col("_metadata.file_path").alias("file_path"),
                     F.col("value").alias("content"))


# The manifest of a plain snapshot folder.
MANIFEST_SCHEMA = ("extraction_timestamp string, endpoint string, auth_method string, database string, "
                   "schemas array<string>, files map<string, struct<object_type: string, qualified_name: string, "
                   "sha256: string>>, ddl_sha256 string")
FILES_SCHEMA = "relative_path string, object_type string, qualified_name string, sha256 string"
OBJECTS_SCHEMA = FILES_SCHEMA + ", content string"
PUBLISHED_SCHEMA = "sequence bigint, version string"


class IncompleteSnapshot(Exception):
    """A manifest lists objects that the snapshot does not hold."""


def read_snapshot(spark: SparkSession, export_dir: str, check: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(manifest files, objects)`` of an exported snapshot folder.

    Two layouts: the one :func:`tidemark.plans.snapshot.write` makes (tables
    ``objects`` and ``manifest`` in the version published last), and a plain one
    (``manifest.json`` with a file map, and a ``.sql`` file per object).  Objects are ``(category, name,
    relative_path, definition, sha256)``; names and types are the manifest's,
    never the file's.  With ``check`` (an action) a listed object that is not
    there raises :class:`IncompleteSnapshot`; files that the manifest does not
    list are no objects.
    """
    if _exists(spark, f"{export_dir}/manifest.json"):
        manifest = spark.read.option("multiLine", True).schema(MANIFEST_SCHEMA).json(f"{export_dir}/manifest.json")
        files = manifest.select(F.explode(F.col("files")).alias("relative_path", "meta")).select(
            "relative_path", "meta.object_type", "meta.qualified_name", "meta.sha256")
        scripts = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.sql")
                   .text(export_dir, wholetext=True))
        # file_path is a URL: a plus sign stands for itself
        path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        texts = scripts.select(F.regexp_extract(path, r"([^/]+/[^/]+)$", 1).alias("relative_path"),
                               F.col("value").alias("content"))
    else:
        folder = current_export(spark, export_dir)
        files = spark.read.schema(FILES_SCHEMA).json(f"{folder}/manifest")
        texts = (spark.read.schema(OBJECTS_SCHEMA).parquet(f"{folder}/objects")
                 .select("relative_path", "content"))
    if check:
        lost = files.join(texts.select("relative_path"), "relative_path", "left_anti")
        named = [r.relative_path for r in lost.select("relative_path").orderBy("relative_path").limit(20).collect()]
        if named:
            raise IncompleteSnapshot(f"{export_dir}: listed but not there: {', '.join(named)}")
    objs = files.join(texts, "relative_path").select(
        F.concat(F.col("object_type"), F.lit("s")).alias("category"), F.col("qualified_name").alias("name"),
        "relative_path", F.col("content").alias("definition"), F.sha2("content", 256).alias("sha256"))
    return files, objs


def published_versions(spark: SparkSession, export_dir: str) -> list[Row]:
    """``(sequence, version)`` of every published export, a row per publishing."""
    if not _exists(spark, f"{export_dir}/published"):
        return []
    return spark.read.schema(PUBLISHED_SCHEMA).json(f"{export_dir}/published").collect()


def current_export(spark: SparkSession, export_dir: str) -> str:
    """The folder of the version published last."""
    current = max(published_versions(spark, export_dir), default=None)
    if current is None:
        raise IncompleteSnapshot(f"{export_dir}: nothing was published")
    return f"{export_dir}/versions/{current.version}"


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def resolve_paths(objs: DataFrame, manifest_files: DataFrame, present: DataFrame,
                  singular_map: dict | None = None) -> DataFrame:
    """``objs`` with ``resolved_path, from_manifest, found``: the manifest entry
    with the same name and type first (the smallest path, if it has several),
    else the conventional ``<category>/<name>.sql``; ``found`` tells whether
    ``present`` (``relative_path``) has that file."""
    by_manifest = manifest_files.groupBy(
        F.col("qualified_name").alias("name"), F.col("object_type").alias("_type")).agg(
        F.min("relative_path").alias("_mpath"))
    o = objs.withColumn("_type", singular(F.col("category"), singular_map))
    conventional = export_path(F.col("category"), F.col("name"))
    resolved = o.join(by_manifest, ["name", "_type"], "left").select(
        *objs.columns, F.coalesce(F.col("_mpath"), conventional).alias("resolved_path"),
        F.col("_mpath").isNotNull().alias("from_manifest"))
    there = present.select(F.col("relative_path").alias("resolved_path")).distinct().withColumn("_found", F.lit(True))
    return (resolved.join(there, "resolved_path", "left")
            .withColumn("found", F.coalesce("_found", F.lit(False))).drop("_found"))
