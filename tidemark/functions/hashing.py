"""Content hashes and bundle hashes.

``sha256`` per artifact is a row-level expression.  A *bundle* hash covers
many artifacts; SHA-256 over one ordered concatenation cannot be split across
tasks, so there are two forms:

* :func:`bundle_hash_exact` - digest of all contents in path order, a newline
  after each.  Byte-for-byte the digest a sequential exporter computes; as it
  needs the whole bundle in one task, the bundle's size is checked first.
* :func:`bundle_hash_tree` - a fixed three-level hash tree.  Artifacts are
  spread over 2**32 chunks by the first 8 hex digits of ``sha256(path)``;
  chunk digests roll up into 65,536 mid digests per group, then into one
  digest per group.  Every aggregation step holds at most 65,536 short hex
  strings per group, whatever the number of artifacts, so a group holding a
  third of all rows is still spread over all tasks.  Deterministic, order
  independent of partitioning, and reproducible in plain SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import col_

NL = "\n"


def sha256(c: Column | str) -> Column:
    return F.sha2(col_(c), 256)


def _ordered_digest(values: Column) -> Column:
    """sha256 of the lexicographically sorted values joined by newlines."""
    return F.sha2(F.array_join(F.array_sort(F.collect_list(values)), NL), 256)


def bundle_hash_tree(artifacts: DataFrame, group_cols: Sequence[str] = (),
                     path_col: str = "relative_path", content_col: str = "content",
                     content_is_digest: bool = False, total: str | None = None) -> DataFrame:
    """One row per group: ``artifact_count`` and ``bundle_sha256``.

    ``total`` (for one group column) adds a bundle of that name over all
    artifacts; each text is hashed once for both.

    Leaf digest = sha256(path || '\\n' || sha256(content)).  If
    ``content_is_digest`` the content column already holds sha256 hex.
    """
    g = list(group_cols)
    path = F.col(path_col)
    content_digest = F.col(content_col) if content_is_digest else sha256(content_col)
    path_digest = sha256(path)
    leaves = artifacts.select(
        *g,
        F.substring(path_digest, 1, 4).alias("_b1"),
        F.substring(path_digest, 5, 4).alias("_b2"),
        sha256(F.concat(path, F.lit(NL), content_digest)).alias("_leaf"),
    )
    if total is not None:
        (group,) = g
        leaves = leaves.withColumn(group, F.explode(F.array(F.col(group), F.lit(total))))
    chunks = leaves.groupBy(*g, "_b1", "_b2").agg(
        _ordered_digest(F.col("_leaf")).alias("_h"), F.count(F.lit(1)).alias("_n"))
    mids = chunks.groupBy(*g, "_b1").agg(
        _ordered_digest(F.concat(F.col("_b2"), F.lit(":"), F.col("_h"))).alias("_h"),
        F.sum("_n").alias("_n"))
    return mids.groupBy(*g).agg(
        F.sum("_n").cast("bigint").alias("artifact_count"),
        _ordered_digest(F.concat(F.col("_b1"), F.lit(":"), F.col("_h"))).alias("bundle_sha256"),
    )


#: The most bytes of text that the sequential digest takes.
EXACT_BYTES = 64 << 20


def bundle_hash_exact(artifacts: DataFrame, group_cols: Sequence[str] = (),
                      path_col: str = "relative_path", content_col: str = "content",
                      most_bytes: int = EXACT_BYTES) -> DataFrame:
    """Digest of all contents in path order, a newline after each, per group.

    One digest is one task's work, so the size is checked first (an action):
    over ``most_bytes`` in all it raises, and :func:`bundle_hash_tree` is the
    way."""
    size = artifacts.agg(F.coalesce(F.sum(F.octet_length(F.col(content_col))), F.lit(0))).first()[0]
    if size > most_bytes:
        raise ValueError(f"{size} bytes are too many for a sequential digest (at most {most_bytes})")
    ordered = F.array_sort(F.collect_list(F.struct(F.col(path_col).alias("p"), F.col(content_col).alias("c"))))
    body = F.array_join(F.transform(ordered, lambda x: F.concat(x["c"], F.lit(NL))), "")
    return artifacts.groupBy(*group_cols).agg(
        F.count(F.lit(1)).cast("bigint").alias("artifact_count"),
        F.sha2(body, 256).alias("bundle_sha256"),
    )
