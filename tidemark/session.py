"""Spark session defaults and lineage helpers.

Everything in the library takes a ``SparkSession`` from the caller.  The
helpers here only exist so tests, the bench and the driver entry build the
session the same way: adaptive execution on (runtime broadcast decisions are
taken on measured shuffle sizes, skewed sort-merge partitions are split), the
Spark UI off, UTC session time zone.
"""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Session settings every entry point applies.  AQE is what turns a sort-merge
# join against a small aggregated side into a broadcast join *after* measuring
# it, and what splits a hot key's partition in a skewed join.
SESSION_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # PySpark 4 records a Python call site for every Column call (for error
    # messages); building a plan of many expressions pays that per call.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "tidemark",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder (``spark.checkpoint.dir`` or the one set
    on the context).  There is no default: the caller names a folder that all
    executors share."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir()


def scratch_dir(spark: SparkSession) -> str:
    """:func:`checkpoint_dir`; a session without one gets a temporary folder in
    local mode only.  On a cluster every executor must see the folder, so there
    a missing one is an error."""
    if spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None):
        return checkpoint_dir(spark)
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-scratch-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path in the shared folder."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage: what is read later survives the loss of any executor and
    is the same at every reading.  The folder is scratch space of the job and
    is emptied with it."""
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of a result that several outputs reuse.

    An action: writes a reliable checkpoint in the session's checkpoint folder,
    so the saved partitions survive the loss of the executor that computed them.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def local_frame(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A driver-side list (a contract, catalog metadata, parameters) as a
    DataFrame that Catalyst sees as a local relation of known size, so Spark's
    own broadcast threshold decides how joins against it run."""
    fields = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(fields)
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    table = pa.table([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)
    return spark.createDataFrame(table, schema=fields)
