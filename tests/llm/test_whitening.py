"""Whitening against numpy on the expanded rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries as Q
from tidemark.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, component string, n string, x string"


def frame(spark, vectors, first=0):
    return spark.createDataFrame([(first + i, v, "clash", "clash", "clash") for i, v in enumerate(vectors)], SCHEMA)


def quantize(rows):
    x, fits = whitening.quantized("embedding", 64, 1_000_000)
    return rows.filter(fits).select("vec_id", x.alias("x"))


def as_longs(v):
    return [int(np.floor(64 * c)) + 1_000_000 for c in v]


def check(rows, ids, x, weights, components):
    """``rows`` against the definition; ``x`` are the fit list's distinct vectors."""
    x, w = np.array(x, np.int64), np.array(weights, np.int64)
    n, s = int(w.sum()), (x * w[:, None]).sum(axis=0)
    centred = (x - s / n)
    v = (centred * w[:, None]).T @ centred / n
    e = np.linalg.eigvalsh(v)[::-1][:components]
    got = {}
    for r in rows:
        assert r.n == n and abs(r.explained - e[r.component - 1] / np.trace(v)) < 1e-9 and r.identity_error < 1e-8
        got.setdefault(r.vec_id, {})[r.component] = r
    assert set(got) == set(ids)
    white = {}
    for vec_id, vector in ids.items():
        assert sorted(got[vec_id]) == list(range(1, len(e) + 1))
        deviation = sum((n * int(a) - int(b)) ** 2 for a, b in zip(vector, s))
        assert {r.deviation for r in got[vec_id].values()} == {deviation}
        white[vec_id] = [got[vec_id][k].whitened for k in sorted(got[vec_id])]
    # the projections give back unit vectors that diagonalize the covariance
    y = np.array([white[i] for i in ids])
    c = np.array([ids[i] for i in ids]) - s / n
    basis = np.linalg.lstsq(c, y * np.sqrt(e), rcond=None)[0] if len(ids) > c.shape[1] else None
    if basis is not None:
        assert np.allclose(basis.T @ basis, np.eye(len(e)), atol=1e-6)
        assert np.allclose(v @ basis, basis * e, atol=1e-4 * max(1.0, e[0]))


@pytest.mark.parametrize("weights", ["count", "one"])
def test_equals_numpy(spark, weights):
    rnd = np.random.default_rng(3)
    vectors = [list(map(float, rnd.normal(size=6) * [3, 2, 1, .5, .3, .2])) for _ in range(80)]
    vectors += [vectors[0]] * 40 + [vectors[1]] * 7
    base = frame(spark, vectors)
    rows = whitening.whiten(quantize(base), 4, "vec_id", "x", weights).collect()
    ids = {i: as_longs(v) for i, v in enumerate(vectors)}
    distinct = {}
    for v in ids.values():
        distinct[tuple(v)] = distinct.get(tuple(v), 0) + 1
    check(rows, ids, list(distinct), list(distinct.values()) if weights == "count" else [1] * len(distinct), 4)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = [[1.0, 2.0], [2.0, 1.0], [0.0, 0.5], [-1.0, 3.0]]
    base = frame(spark, [*good, None, [nan, 1.0], [1.0, inf], [None, 1.0], [1e300, 0.0]])
    base = base.unionByName(base.filter("vec_id = 0")).unionByName(
        base.filter("vec_id = 1").withColumn("vec_id", F.lit(None).cast("long")))
    rows = whitening.whiten(quantize(base), 32, "vec_id", "x").collect()
    assert sorted((r.vec_id is None, r.vec_id or 0, r.component) for r in rows) == sorted(
        [(False, i, k) for i in (0, 0, 1, 2, 3) for k in (1, 2)] + [(True, 0, 1), (True, 0, 2)])
    assert {r.n for r in rows} == {6}
    assert all(r.identity_error < 1e-8 for r in rows)


def test_lengths_without_variance_and_empty_tables(spark):
    base = frame(spark, [[1.0, 2.0], [3.0, 1.0], [2.0, 2.5], [1.0], [4.0], [], [7.0, 7.0, 7.0]])
    rows = whitening.whiten(quantize(base), 32, "vec_id", "x").collect()
    assert sorted((r.vec_id, r.component, r.n) for r in rows) == [(0, 1, 3), (0, 2, 3), (1, 1, 3), (1, 2, 3), (2, 1, 3),
                                                                   (2, 2, 3), (3, 1, 2), (4, 1, 2)]
    assert whitening.whiten(quantize(frame(spark, [[1.0, 2.0]] * 5)), 32, "vec_id", "x").count() == 0
    out = whitening.whiten(quantize(base.limit(0)), 32, "vec_id", "x")
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert out.count() == 0


def test_numbers_beyond_a_long(spark):
    big = 1 << 52
    rows = spark.createDataFrame([(0, [big, 0]), (1, [-big, 5]), (2, [3, 7])], "vec_id long, x array<long>")
    got = {r.vec_id: r.deviation for r in whitening.whiten(rows, 2, "vec_id", "x").collect()}
    assert got[0] is None and got[1] is None and got[2] == (9 - 3) ** 2 + (21 - 12) ** 2


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = Q.op11_whitening(spark, sf).collect()
    ids = {r.vec_id: as_longs([float(np.float32(c)) for c in r.embedding])
           for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    check(rows, ids, list(ids.values()), [1] * len(ids), 32)
