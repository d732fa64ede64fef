"""Drift between two stored snapshots by descending a tree of digests.

A snapshot's objects are dealt to ``2^8`` branches and ``2^16`` blocks a branch
by the hash of (category, name).  Stored are the leaves (category, name,
digest), in a folder per 16 branches and sorted by branch and block, the digest
of every block, and the digest of every branch.  Two trees are compared from the top: branches
whose digests agree are not opened, blocks whose digests agree are not joined,
and only the leaves of differing blocks meet in a full outer join.  After a
small change the cost is that of the change's branches, whatever the snapshot's
size.

The tree has a fixed shape, so the lists that are hashed are bounded: a branch
has at most ``2^16`` blocks, and the driver sees at most ``2^8`` branches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.hashing import NL

LEAVES_SCHEMA = "branch string, block string, category string, name string, digest string, folder string"
BLOCKS_SCHEMA = "block string, block_digest string, objects bigint, branch string"
BRANCHES_SCHEMA = "branch string, branch_digest string, objects bigint"


def _place() -> Column:
    return F.sha2(F.concat(F.coalesce(F.col("category"), F.lit("")), F.lit(NL), F.coalesce(F.col("name"), F.lit(""))), 256)


def _digest_of(values: Column) -> Column:
    return F.sha2(F.array_join(F.array_sort(F.collect_list(values)), NL), 256)


def write_tree(objects: DataFrame, folder: str, digest_col: str = "sha256") -> None:
    """Store the tree of ``objects`` (``category, name`` and a digest) under
    ``folder``: ``leaves``, ``blocks`` and ``branches``.  A null digest counts as
    a text without bytes.  The branches are written last."""
    spark = objects.sparkSession
    leaves = objects.select("category", "name", F.coalesce(F.col(digest_col), F.lit("")).alias("digest"),
                            _place().alias("place")).select(
        F.substring("place", 1, 2).alias("branch"), F.substring("place", 3, 4).alias("block"), "category", "name", "digest",
        F.substring("place", 1, 1).alias("folder"))
    # ranges of (branch, block): a task writes few folders, and row groups hold few branches
    (leaves.repartitionByRange("branch", "block").sortWithinPartitions("folder", "branch", "block")
     .write.mode("overwrite").partitionBy("folder").parquet(f"{folder}/leaves"))
    stored = spark.read.schema(LEAVES_SCHEMA).parquet(f"{folder}/leaves")
    leaf = F.sha2(F.concat_ws(NL, F.coalesce(F.col("category"), F.lit("")), F.coalesce(F.col("name"), F.lit("")),
                              F.col("digest")), 256)
    blocks = stored.groupBy("branch", "block").agg(_digest_of(leaf).alias("block_digest"),
                                                   F.count(F.lit(1)).alias("objects"))
    # sorted by branch, so that row groups without a branch asked for are skipped
    (blocks.select("block", "block_digest", "objects", "branch").repartitionByRange("branch", "block")
     .sortWithinPartitions("branch", "block").write.mode("overwrite").parquet(f"{folder}/blocks"))
    branches = spark.read.schema(BLOCKS_SCHEMA).parquet(f"{folder}/blocks").groupBy("branch").agg(
        _digest_of(F.concat_ws(":", "block", "block_digest")).alias("branch_digest"),
        F.sum("objects").cast("bigint").alias("objects"))
    branches.coalesce(1).write.mode("overwrite").parquet(f"{folder}/branches")  # at most 2^8 rows


def differing_branches(spark: SparkSession, left: str, right: str) -> list[str]:
    """The branches whose digests differ or that one side lacks (at most 2^8)."""
    l, r = (spark.read.schema(BRANCHES_SCHEMA).parquet(f"{f}/branches").select(
        "branch", F.col("branch_digest").alias(side)) for f, side in ((left, "l"), (right, "r")))
    rows = l.join(r, "branch", "full_outer").filter(~F.col("l").eqNullSafe(F.col("r"))).select("branch").collect()
    return sorted(x.branch for x in rows)


def tree_drift(spark: SparkSession, left: str, right: str) -> DataFrame:
    """``category, name, status`` (added, removed, modified) between two stored
    trees; an object with the same digest on both sides gives no row.

    The branches are compared when this is called; what is returned reads the
    differing branches only."""
    branches = differing_branches(spark, left, right)

    def side(folder: str, kind: str, schema: str) -> DataFrame:
        stored = spark.read.schema(schema).parquet(f"{folder}/{kind}")
        if kind == "leaves":  # folders are not opened without need, and in them row groups
            stored = stored.filter(F.col("folder").isin(sorted({b[0] for b in branches})))
        return stored.filter(F.col("branch").isin(branches))

    l, r = (side(f, "blocks", BLOCKS_SCHEMA).select("branch", "block", F.col("block_digest").alias(n))
            for f, n in ((left, "l"), (right, "r")))
    blocks = l.join(r, ["branch", "block"], "full_outer").filter(~F.col("l").eqNullSafe(F.col("r"))).select("branch", "block")

    def leaves(folder: str, name: str) -> DataFrame:
        found = side(folder, "leaves", LEAVES_SCHEMA).join(blocks, ["branch", "block"], "left_semi")
        return found.select("category", "name", F.col("digest").alias(name))

    j = leaves(left, "l").join(leaves(right, "r"), ["category", "name"], "full_outer")
    status = (F.when(F.col("l").isNull(), F.lit("added")).when(F.col("r").isNull(), F.lit("removed"))
              .when(F.col("l") != F.col("r"), F.lit("modified")))
    return j.select("category", "name", status.alias("status")).filter("status IS NOT NULL")


def tree_root(spark: SparkSession, folder: str) -> DataFrame:
    """One row: the digest of the whole snapshot, from its branches, and its
    number of objects.  Snapshots with the same root hold the same objects."""
    return spark.read.schema(BRANCHES_SCHEMA).parquet(f"{folder}/branches").agg(
        _digest_of(F.concat_ws(":", "branch", "branch_digest")).alias("root_digest"),
        F.coalesce(F.sum("objects"), F.lit(0)).cast("bigint").alias("objects"))
