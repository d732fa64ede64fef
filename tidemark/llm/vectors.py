"""Vector helpers of the two searches: clean rows, blocks, tiles and heaps."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import tasks


def valid_vectors(rows: DataFrame, id_col: str, vector_col: str, zero: bool) -> DataFrame:
    """``vec_id, vec``: rows with an id and a vector of finite components.

    Null and empty vectors, vectors with a null or non-finite component and,
    unless ``zero``, all-zero vectors take no part.  Of an id that repeats, the
    smallest vector counts.
    """
    vec = F.col(vector_col)
    good = F.expr(f"forall(`{vector_col}`, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")
    kept = rows.filter(F.col(id_col).isNotNull() & vec.isNotNull() & (F.size(vec) > 0) & good)
    if not zero:
        kept = kept.filter(F.expr(f"exists(`{vector_col}`, x -> x <> 0)"))
    return kept.groupBy(F.col(id_col).cast("long").alias("vec_id")).agg(F.min(vec).alias("vec"))


def few_per_copy(vectors: DataFrame, most: int, same: Column) -> DataFrame:
    """The ``most`` smallest ids of each group of equal vectors.

    Equal vectors have equal scores, so no query's ``most - 1`` best (its own
    row left out) ever need more; the limit is applied before the shuffle too.
    """
    ranked = vectors.withColumn("__same", same)
    ranked = ranked.withColumn("__n", F.row_number().over(Window.partitionBy("__same").orderBy("vec_id")))
    return ranked.filter(F.col("__n") <= most).drop("__n", "__same")


BLOCK_BYTES = 32 << 20    # a block's vectors as doubles
LEAST_BLOCK = 1024
STRIPE = 1 << 22          # scores that a tile holds at a time


def block_counts(queries: DataFrame, rows: DataFrame, query_block: int | None, row_block: int | None) -> tuple[int, int]:
    """Into how many blocks queries and rows are dealt.

    Every query meets every row block and the other way round, so blocks are as
    large as a task's memory lets them be, unless there would be fewer pairs of
    blocks than tasks."""
    n_queries = queries.count()
    n_rows, dims = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vec")), F.lit(1))).first()
    most = max(1, BLOCK_BYTES // (8 * dims))
    q_blocks = max(1, math.ceil(n_queries / (query_block or most)))
    if row_block:
        return q_blocks, max(1, math.ceil(n_rows / row_block))
    spread = min(math.ceil(tasks(rows.sparkSession) / q_blocks), math.ceil(n_rows / LEAST_BLOCK))
    return q_blocks, max(1, math.ceil(n_rows / most), spread)


def stripes(queries: int, rows: int) -> Iterator[slice]:
    """Queries of a tile, as many at a time as ``STRIPE`` scores allow."""
    step = max(1, STRIPE // max(1, rows))
    return (slice(at, at + step) for at in range(0, queries, step))


def in_block(blocks: int) -> Column:
    """The block of a row by its id's hash."""
    return F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")


def every_block(blocks: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of one length as a float64 matrix."""
    flat = column.combine_chunks()
    if isinstance(flat, pa.ChunkedArray):
        flat = flat.chunk(0)
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), len(values) // max(1, len(column)))


def best_of(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest, ties to the smaller position, best first."""
    if len(scores) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= cut)
        return at[np.argsort(-scores[at], kind="stable")[:k]]
    return np.argsort(-scores, kind="stable")[:k]


def merge_heaps(lists: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best ``(score, vec_id)`` of each key: larger scores first, ties to
    the smaller id.  Rows of a key meet in one task, which keeps a heap of k
    entries for each of its keys."""
    fields = {f.name: f.dataType.simpleString() for f in lists.schema}
    names = [*keys, "vec_id", "score"]
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[tuple, list] = {}
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in names]
            for *key, vec_id, score in zip(*columns):
                heap = heaps.setdefault(tuple(key), [])
                entry = (score, -vec_id)
                if len(heap) < k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
        rows = [(*key, -neg, score) for key, heap in heaps.items() for score, neg in heap]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, kinds[fields[n]]) for n, c in zip(names, zip(*rows))], names)

    schema = ", ".join(f"{n} {fields[n]}" for n in names)
    return lists.select(*names).repartition(*keys).mapInArrow(run, schema)


def ranked(best: DataFrame) -> DataFrame:
    """Add ``rank`` (from 1) to each query's few entries."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).select("query_id", "rank", "vec_id", "score")
