"""Exact top-k inner products by a three-phase uniform threshold.

The dimensions are dealt to ``lists`` slices; a slice's holder knows only its
part of every score.

1. Each slice gives each query's ``DEPTH * k`` best local scores.  The entries
   met are scored exactly, and a query's k-th best, t, is a safe cutoff: an
   answer scores at least t, so one of its local scores is at least t / lists.
2. Each slice collects all its entries of at least t / lists.
3. Entries collected by every slice are summed; those that lack a slice, and
   could still reach t with what the slice can hide, are scored exactly from
   the vectors.

Scores are integers, so cutoffs and ties are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import written
from tidemark.llm.vectors import (best_of, block_counts, every_block, few_per_copy, in_block, matrix, merge_heaps,
                                  ranked, stripes, valid_vectors)

LISTS = 2
DEPTH = 4  # deeper lists raise the cutoff, so that phase 2 collects less
SCALE = 256.0
LONG_MAX = (1 << 63) - 1


def whole(m: np.ndarray, scale: float) -> np.ndarray:
    return np.floor(m * scale)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` of whole numbers as int64.

    float64 products are exact below 2**53 and int64 ones below 2**63; beyond
    that they are done in unbounded integers and the nearest long is taken.
    """
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 1 << 53:
        return (a @ b.T).astype(np.int64)
    if most < 1 << 63:
        return a.astype(np.int64) @ b.T.astype(np.int64)
    big = np.array([[int(x) for x in row] for row in a], object) @ np.array([[int(x) for x in row] for row in b], object).T
    return np.array([[max(-LONG_MAX, min(LONG_MAX, x)) for x in row] for row in big], np.int64)


def _own(query_ids: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns where a query meets itself; ``ids`` ascend."""
    at = np.searchsorted(ids, query_ids)
    i = np.flatnonzero((at < len(ids)) & (ids[np.minimum(at, len(ids) - 1)] == query_ids))
    return i, at[i]


def _tiles(queries: DataFrame, rows: DataFrame, blocks: tuple[int, int], lists: int, entries, schema: str) -> DataFrame:
    """``entries(query table, their whole slice, row ids, whole slice)`` of every
    slice of every pair of blocks.  A vector shorter than ``lists`` has empty slices."""
    def sliced(df: DataFrame, own: Column, other: Column, names: tuple[str, str]) -> DataFrame:
        more = [c for c in df.columns if c not in ("vec_id", "vec")]
        dealt = df.select("vec_id", "vec", *more, own.alias(names[0]), F.explode(F.sequence(F.lit(0), F.lit(lists - 1))).alias("list"))
        return dealt.select("vec_id", *more, F.size("vec").alias("dim"), "list", names[0], other.alias(names[1]), F.expr(
            f"slice(vec, 1 + size(vec) * list div {lists}, size(vec) * (list + 1) div {lists} - size(vec) * list div {lists})")
            .alias("part"))

    left = sliced(queries, in_block(blocks[0]), every_block(blocks[1]), ("qb", "rb"))
    right = sliced(rows, in_block(blocks[1]), every_block(blocks[0]), ("rb", "qb"))

    def run(q: pa.Table, r: pa.Table) -> pa.Table:
        found = {"query_id": [], "list": [], "vec_id": [], "score": []}
        if len(q) and len(r):
            r = r.sort_by("vec_id")
            a, b = whole(matrix(q["part"]), SCALE), whole(matrix(r["part"]), SCALE)
            for at in stripes(len(q), len(r)):
                part = q.slice(at.start, at.stop - at.start)
                i, j, score = entries(part, products(a[at], b), r["vec_id"].to_numpy())
                found["query_id"].append(part["vec_id"].to_numpy()[i])
                found["vec_id"].append(r["vec_id"].to_numpy()[j])
                found["score"].append(score)
                found["list"].append(np.full(len(i), q["list"][0].as_py(), np.int32))
        kinds = {"query_id": np.int64, "list": np.int32, "vec_id": np.int64, "score": np.int64}
        return pa.table({n: np.concatenate(x) if x else np.zeros(0, kinds[n]) for n, x in found.items()})

    keys = ["dim", "list", "qb", "rb"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)


def _scored(pairs: DataFrame, queries: DataFrame, rows: DataFrame) -> DataFrame:
    """Exact scores of ``query_id, vec_id`` from the whole vectors."""
    both = (pairs.join(queries.select(F.col("vec_id").alias("query_id"), F.col("vec").alias("qv")), "query_id")
            .join(rows.select("vec_id", F.col("vec").alias("rv")), "vec_id").select("query_id", "vec_id", "qv", "rv"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = pa.compute.list_value_length(batch["qv"]).to_numpy()
            score = np.zeros(len(dims), np.int64)
            for d in np.unique(dims):  # a pair's vectors have the same length
                at = pa.array(np.flatnonzero(dims == d))
                a, b = (whole(matrix(pa.chunked_array([batch[c].take(at)])), SCALE) for c in ("qv", "rv"))
                if int(np.abs(a).max()) * int(np.abs(b).max()) * int(d) < 1 << 53:
                    score[at.to_numpy()] = (a * b).sum(axis=1).astype(np.int64)
                else:
                    score[at.to_numpy()] = [products(x[None], y[None])[0, 0] for x, y in zip(a, b)]
            yield pa.RecordBatch.from_arrays([batch["query_id"], batch["vec_id"], pa.array(score)], ["query_id", "vec_id", "score"])

    return both.mapInArrow(run, "query_id long, vec_id long, score long")


def top_k(embeddings: DataFrame, is_query: Column, k: int, lists: int = LISTS, id_col: str = "vec_id",
          vector_col: str = "embedding", query_block: int | None = None, row_block: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k highest scores but its
    own, all if there are fewer.

    A score is the inner product of ``floor(256 x)``.  Vectors that are null,
    empty or hold null or non-finite components take no part (zero vectors
    do); rows of another length than the query's are no candidates.  Ties go to
    the smaller id; of an id that repeats, the smallest vector counts.
    """
    vectors = written(valid_vectors(embeddings, id_col, vector_col, zero=True), "vectors")
    queries = vectors.filter(is_query)
    same = F.expr("transform(vec, x -> floor(256D * x))")
    rows = written(few_per_copy(vectors, k + 1, same), "distinct-vectors")
    blocks = block_counts(queries, rows, query_block, row_block)
    schema = "query_id long, list int, vec_id long, score long"
    depth = DEPTH * k

    def local_best(q: pa.Table, scores: np.ndarray, ids: np.ndarray):
        i, j = _own(q["vec_id"].to_numpy(), ids)
        skip = dict(zip(i.tolist(), j.tolist()))
        rows_i, rows_j = [], []
        for n in range(len(scores)):
            best = best_of(scores[n], depth + 1)
            best = best[best != skip.get(n, -1)][:depth]
            rows_i.append(np.full(len(best), n))
            rows_j.append(best)
        at, to = np.concatenate(rows_i), np.concatenate(rows_j)
        return at, to, scores[at, to]

    local = merge_heaps(_tiles(queries, rows, blocks, lists, local_best, schema), ["query_id", "list"], depth)
    met = written(_scored(local.select("query_id", "vec_id").distinct(), queries, rows), "met")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    cutoffs = (met.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k)
               .groupBy("query_id").agg(F.min("score").alias("t"), F.count(F.lit(1)).alias("n"))
               # with fewer than k candidates every one was met and each is an answer
               .select(F.col("query_id").alias("vec_id"), F.when(F.col("n") == k, F.col("t")).alias("t")))

    def enough(q: pa.Table, scores: np.ndarray, ids: np.ndarray):
        least = np.array([-LONG_MAX if t is None else -(-t // lists) for t in q["t"].to_pylist()], np.int64)
        keep = scores >= least[:, None]
        i, j = _own(q["vec_id"].to_numpy(), ids)
        keep[i, j] = False
        i, j = np.nonzero(keep)
        return i, j, scores[i, j]

    asked = written(queries.join(cutoffs, "vec_id"), "cutoffs")
    entries = _tiles(asked, rows, blocks, lists, enough, schema)
    known = (entries.groupBy("query_id", "vec_id").agg(F.sum("score").alias("score"), F.count(F.lit(1)).alias("n")))
    known = written(known.join(asked.select(F.col("vec_id").alias("query_id"), "t"), "query_id"), "collected")
    full = known.filter(F.col("n") == lists).select("query_id", "vec_id", "score")
    # the most that a slice without the entry can add: the next whole number below t / lists
    hidden = F.expr(f"CASE WHEN t > 0 THEN (t + {lists - 1}) div {lists} ELSE t div {lists} END - 1")
    open_pairs = known.filter((F.col("n") < lists)
                              & (F.col("t").isNull() | (F.col("score") + (lists - F.col("n")) * hidden >= F.col("t"))))
    answers = full.unionByName(_scored(open_pairs.select("query_id", "vec_id"), queries, rows))
    return ranked(merge_heaps(answers, ["query_id"], k))
