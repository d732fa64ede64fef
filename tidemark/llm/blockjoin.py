"""Nearest neighbours by a block matrix join over int8 products.

Queries and candidates are dealt to blocks by a hash of their ids, and each
pair of blocks is one tile.  A tile multiplies int8 roundings of the vectors;
the rounding errors' norms bound how far each product is from the inner
product.  A pair survives if its upper bound reaches the query's k-th best
lower bound in the tile; survivors are computed again from the original
vectors in double precision.  A tile returns at most k entries a query, and the
tiles' lists are merged by heaps.  The bounds are safe, so nothing is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written
from tidemark.llm.vectors import (best_of, block_counts, every_block, few_per_copy, in_block, matrix, merge_heaps,
                                  ranked, stripes, valid_vectors)

SLACK = 1e-9  # of the norms' product; covers the bounds' own rounding


def rounded(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, their scale, the rounded vectors' norms and the errors' norms."""
    scale = np.abs(m).max(axis=1) / 127
    q = np.rint(m / scale[:, None]).astype(np.int8)
    back = q * scale[:, None]
    return q, scale, np.linalg.norm(back, axis=1), np.linalg.norm(m - back, axis=1)


def tile(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray,
         k: int) -> tuple[list[int], list[int], list[float]]:
    """Each query's k best of the tile's rows; ``ids`` ascend."""
    qi, qs, qn, qe = rounded(queries)
    ri, rs, _, re = rounded(rows)
    whole = np.linalg.norm(rows, axis=1)
    # small integers are exact in float32 products up to 2**24, in float64 beyond
    kind = np.float32 if queries.shape[1] * 127 * 127 < 1 << 24 else np.float64
    right = ri.T.astype(kind)
    out_q, out_id, out_score = [], [], []
    for part in stripes(len(queries), len(rows)):
        near = (qi[part].astype(kind) @ right).astype(np.float64) * qs[part, None] * rs
        off = qe[part, None] * whole + qn[part, None] * re + SLACK * (qn[part, None] + qe[part, None]) * whole
        own = np.searchsorted(ids, query_ids[part])
        is_in = np.flatnonzero((own < len(ids)) & (ids[np.minimum(own, len(ids) - 1)] == query_ids[part]))
        near[is_in, own[is_in]] = -np.inf
        low = near - off
        cut = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k] if low.shape[1] > k else np.full(len(low), -np.inf)
        alive = (near + off >= cut[:, None]) & (near > -np.inf)
        for i in range(len(near)):
            j = np.flatnonzero(alive[i])
            exact = np.cumsum(rows[j] * queries[part.start + i], axis=1)[:, -1]  # summed from left to right, as SQL does
            best = best_of(exact, k)
            out_q += [int(query_ids[part.start + i])] * len(best)
            out_id += ids[j[best]].tolist()
            out_score += exact[best].tolist()
    return out_q, out_id, out_score


def nearest(embeddings: DataFrame, is_query: Column, k: int, id_col: str = "vec_id",
            vector_col: str = "embedding", query_block: int | None = None, row_block: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k rows of largest inner
    product but itself, all if there are fewer.

    ``is_query`` is a condition on ``vec_id``.  Vectors that are null, empty,
    zero or hold null or non-finite components take no part; rows of another
    length than the query's are no candidates.  Ties go to the smaller id; of
    an id that repeats, the smallest vector counts.
    """
    vectors = written(valid_vectors(embeddings, id_col, vector_col, zero=False), "vectors")
    queries = vectors.filter(is_query)
    rows = written(few_per_copy(vectors, k + 1, F.col("vec")), "distinct-vectors")
    q_blocks, r_blocks = block_counts(queries, rows, query_block, row_block)
    left = queries.select("vec_id", "vec", F.size("vec").alias("dim"), in_block(q_blocks).alias("qb"),
                          every_block(r_blocks).alias("rb"))
    right = rows.select("vec_id", "vec", F.size("vec").alias("dim"), in_block(r_blocks).alias("rb"),
                        every_block(q_blocks).alias("qb"))

    def run(q: pa.Table, r: pa.Table) -> pa.Table:
        found = ([], [], [])
        if len(q) and len(r):
            r = r.sort_by("vec_id")
            found = tile(q["vec_id"].to_numpy(), matrix(q["vec"]), r["vec_id"].to_numpy(), matrix(r["vec"]), k)
        return pa.table({"query_id": pa.array(found[0], pa.int64()), "vec_id": pa.array(found[1], pa.int64()),
                         "score": pa.array(found[2], pa.float64())})

    keys = ["dim", "qb", "rb"]
    tiles = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, "query_id long, vec_id long, score double")
    return ranked(merge_heaps(tiles, ["query_id"], k))
