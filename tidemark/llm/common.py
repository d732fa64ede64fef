"""Helpers shared by the corpus operators."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of the session (``spark.checkpoint.dir``).

    A session without one gets a temporary folder in local mode only; on a
    cluster every executor must see the folder, so there it is an error.
    """
    current = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-scratch-"))
    return spark.sparkContext.getCheckpointDir()


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage: what is read later survives the loss of any executor.
    The folder is scratch space of the job and is emptied with it.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed_rows(df: DataFrame, *without: str) -> Column:
    """The columns of ``df`` but ``without`` as one struct, so that no helper
    column beside it can clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in without])


def unpacked(df: DataFrame, row: str, changed: dict[str, Column] | None = None) -> list[Column]:
    """The columns of ``df`` out of the struct ``row``, but those ``changed``."""
    changed = changed or {}
    return [changed[c].alias(c) if c in changed else F.col(f"`{row}`.`{c}`").alias(c) for c in df.columns]


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slots(spark: SparkSession, rows: int, rows_per_slot: int = 65536) -> int:
    """How many hash slots split a group: one per task of a shuffle at least,
    and more as the rows grow, so that no slot outgrows a task."""
    return max(tasks(spark), math.ceil(rows / rows_per_slot), 1)


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str, n_slots: int) -> DataFrame:
    """Add ``name``: a gapless number from 0 within each group of ``keys``.

    A group is never sorted as a whole.  Its rows are dealt to hash slots, each
    slot is numbered by itself, and the slots' row counts (at most ``n_slots``
    a group) give where each slot starts.  ``keys`` must not be null; rows that
    agree in ``order`` are interchangeable.
    """
    slot, start, at = "__slot", "__start", "__at"
    dealt = df.withColumn(slot, F.pmod(F.xxhash64(*order), F.lit(n_slots)).cast("int"))
    before = Window.partitionBy(*keys).orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    starts = (dealt.groupBy(*keys, slot).agg(F.count(F.lit(1)).alias(at))
              .select(*keys, slot, F.coalesce(F.sum(at).over(before), F.lit(0)).alias(start)))
    inside = dealt.withColumn(at, F.row_number().over(Window.partitionBy(*keys, slot).orderBy(*order)) - 1)
    return (inside.join(starts, [*keys, slot])
            .withColumn(name, (F.col(start) + F.col(at)).cast("long"))
            .drop(slot, start, at))


def utf8(col: Column) -> Column:
    """The text's bytes; a null text has none."""
    return F.encode(F.coalesce(col, F.lit("")), "UTF-8")
