import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import blockjoin, topk

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank string"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "x", "y") for i, v in vectors], SCHEMA)


def awkward_vectors(seed, n, dim):
    rnd = random.Random(seed)
    rows = [(i, [rnd.gauss(0, 0.2) for _ in range(dim)]) for i in range(n)]
    common = [0.25] * dim
    rows = [(i, common if i % 3 == 0 else v) for i, v in rows]      # one vector holds a third of the rows
    rows += [(n, None), (n + 1, [0.0] * dim), (n + 2, [float("nan")] * dim), (n + 3, [float("inf")] + [0.0] * (dim - 1)),
             (n + 4, [None] + [1.0] * (dim - 1)), (n + 5, []), (n + 6, [1.0, 2.0]), (None, common),
             (3, common), (-20, [-x for x in common])]
    return rows


def usable(rows, zero):
    out = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or (not zero and not any(v)):
            continue
        out[i] = min(out.get(i, v), v)
    return out


def brute(rows, every, k, score, zero):
    vectors = {i: np.array(v, np.float32).astype(np.float64) for i, v in usable(rows, zero).items()}
    out = {}
    for q, a in vectors.items():
        if q % every == 0:
            near = sorted((-score(a, b), i) for i, b in vectors.items() if i != q and len(a) == len(b))[:k]
            out.update({(q, n + 1): (i, -s) for n, (s, i) in enumerate(near)})
    return out


def whole_score(a, b):
    return int((np.floor(a * 256) * np.floor(b * 256)).sum())


@pytest.mark.parametrize("blocks", [(2048, 4096), (7, 11)])
def test_nearest_equals_brute_force(spark, blocks):
    rows = awkward_vectors(1, 120, 16)
    got = blockjoin.nearest(table(spark, rows), F.col("vec_id") % 20 == 0, 20, query_block=blocks[0], row_block=blocks[1])
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    want = brute(rows, 20, 20, lambda a, b: float(np.cumsum(a * b)[-1]), False)
    have = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got.collect()}
    assert have == want  # to the last bit: both sum from left to right


@pytest.mark.parametrize("lists,blocks", [(2, (2048, 4096)), (3, (5, 17)), (1, (9, 30))])
def test_top_k_equals_brute_force(spark, lists, blocks):
    rows = awkward_vectors(2, 150, 12)
    got = topk.top_k(table(spark, rows), F.col("vec_id") % 50 == 0, 5, lists=lists, query_block=blocks[0], row_block=blocks[1])
    want = brute(rows, 50, 5, whole_score, True)
    assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got.collect()} == want


def test_fewer_candidates_than_k(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, -1.0]), (2, [-3.0, 4.0])]
    for found in (blockjoin.nearest(table(spark, rows), F.col("vec_id") == 0, 20),
                  topk.top_k(table(spark, rows), F.col("vec_id") == 0, 5)):
        assert [(r["rank"], r.vec_id) for r in found.orderBy("rank").collect()] == [(1, 2), (2, 1)]


def test_empty_tables(spark):
    assert blockjoin.nearest(table(spark, []), F.col("vec_id") % 20 == 0, 20).count() == 0
    assert topk.top_k(table(spark, []), F.col("vec_id") % 50 == 0, 5).count() == 0


def test_tile_bounds_lose_nothing():
    rng = np.random.default_rng(4)
    queries, rows = rng.normal(size=(50, 64)), rng.normal(size=(700, 64)) * rng.lognormal(0, 2, (700, 1))
    ids = np.arange(1000, 1700)
    q, r, s = blockjoin.tile(np.arange(50), queries, ids, rows, 10)
    exact = queries @ rows.T
    assert len(s) == 500
    for i in range(50):
        mine = [x for x, y in zip(r, q) if y == i]
        assert mine == ids[np.argsort(-exact[i], kind="stable")[:10]].tolist()


def test_products_are_exact_at_every_size():
    for scale in (1, 1 << 20, 1 << 30, 1 << 40):
        a = np.array([[3.0, -5.0], [7.0, 11.0]]) * scale
        want = [[max(-topk.LONG_MAX, min(topk.LONG_MAX, sum(int(x) * int(y) for x, y in zip(p, q)))) for q in a] for p in a]
        assert topk.products(a, a).tolist() == want


def test_blocks_grow_with_the_rows_and_not_with_their_square(spark, monkeypatch):
    from tidemark.llm import vectors
    rows = spark.range(5000).selectExpr("id AS vec_id", "array_repeat(1D, 8) AS vec")
    queries = rows.filter("vec_id % 10 = 0")
    assert vectors.block_counts(queries, rows, 100, 1000) == (5, 5)
    assert vectors.block_counts(queries, rows, None, None) == (1, 4)      # a pair of blocks per task
    monkeypatch.setattr(vectors, "BLOCK_BYTES", 8 * 8 * 250)
    assert vectors.block_counts(queries, rows, None, None) == (2, 20)     # blocks of 250 vectors
    assert vectors.block_counts(queries.limit(0), rows.limit(0), None, None) == (1, 1)
    monkeypatch.setattr(vectors, "STRIPE", 30)
    assert [(s.start, s.stop) for s in vectors.stripes(7, 10)] == [(0, 3), (3, 6), (6, 9)]
