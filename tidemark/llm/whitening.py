"""Whitening of vectors by a covariance weighted with their multiplicity.

Identical vectors are grouped first.  The fit works on the distinct ones with
their counts (or one) as weights: exact integer sums, then a weighted GEMM of
the vectors centred on the mean.  Each distinct vector is whitened once and the
result is joined back to the rows that hold it.

The driver sees the sums and the covariance: numbers by dimension, never rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

ROWS = 4096                    # vectors a matrix product takes
WHOLE = float(1 << 53)         # a double holds all integers below
_LONG = (1 << 63) - 1


def quantized(vector: str, scale: int, shift: int) -> tuple[Column, Column]:
    """``(x, fits)``: the vector as longs ``floor(scale * c) + shift``, and
    whether it is there, all entries are finite, and each x is below 2^53."""
    entry = f"transform(`{vector}`, c -> floor({scale} * double(c)) + {shift})"
    fits = (f"`{vector}` IS NOT NULL AND forall(`{vector}`, c -> c IS NOT NULL AND NOT isnan(c) "
            f"AND abs({scale} * double(c)) < {WHOLE - abs(shift) - 1!r}D)")
    return F.expr(f"CASE WHEN {fits} THEN {entry} END"), F.coalesce(F.expr(fits), F.lit(False))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """The rows by length of their vector: ``(rows, vectors, weights)``."""
    for batch in batches:
        lengths = pc.list_value_length(batch.column("x")).to_numpy(zero_copy_only=False)
        for d in np.unique(lengths):
            of = batch.take(pa.array(np.flatnonzero(lengths == d)))
            for at in range(0, of.num_rows, ROWS):
                rows = of.slice(at, ROWS)
                flat = rows.column("x").flatten().to_numpy(zero_copy_only=False)
                yield rows, flat.reshape(rows.num_rows, d), rows.column("weight").to_numpy()


def _sums(distinct: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """By length: the sum of weights and the exact sum of every dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, np.ndarray]] = {}
        for _, x, w in _groups(batches):
            if int(w.sum()) * (int(np.abs(x).max(initial=0)) + 1) >= 1 << 62:
                x = x.astype(object)
            n, s = held.get(x.shape[1], (0, np.zeros(x.shape[1], object)))
            held[x.shape[1]] = n + int(w.sum()), s + (w[:, None] * x).sum(axis=0)
        rows = [(d, -1, str(n)) for d, (n, _) in held.items()]
        rows += [(d, i, str(v)) for d, (_, s) in held.items() for i, v in enumerate(s)]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.int32(), pa.string()))], ["d", "i", "s"])

    total = (distinct.mapInArrow(run, "d int, i int, s string").groupBy("d", "i")
             .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())  # a number per dimension
    out: dict[int, tuple[int, list[int]]] = {}
    for d in {r.d for r in total}:
        mine = {r.i: int(r.s) for r in total if r.d == d}
        out[d] = mine[-1], [mine[i] for i in range(d)]
    return out


def _centred(x: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """``n * x - s``, exact: as int64 where that holds it, else as Python numbers."""
    if n * (int(np.abs(x).max(initial=0)) + 1) < 1 << 61:
        return n * x - np.array(s, np.int64)
    return n * x.astype(object) - np.array(s, object)


def _covariance(rows: DataFrame, vectors, fields: dict[int, int]) -> dict[int, np.ndarray]:
    """By length: the sum over rows of weight times the outer product.
    ``vectors(x, rows)`` gives the centred vectors; ``fields`` their lengths."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for of, x, w in _groups(batches):
            c = vectors(x, of)
            held[x.shape[1]] = held.get(x.shape[1], 0.0) + (c * w[:, None]).T @ c
        for d, m in held.items():
            if len(m):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d] * len(m), pa.int32()), pa.array(range(len(m)), pa.int32()),
                     pa.array(list(m), pa.list_(pa.float64()))], ["d", "i", "row"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for d, i, row in zip(batch["d"].to_pylist(), batch["i"].to_pylist(), batch["row"]):
                held[d, i] = held.get((d, i), 0.0) + row.values.to_numpy()
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in held], pa.int32()), pa.array([k[1] for k in held], pa.int32()),
                 pa.array(list(held.values()), pa.list_(pa.float64()))], ["d", "i", "row"])

    kind = "d int, i int, row array<double>"
    total = rows.mapInArrow(partial, kind).repartition("d", "i").mapInArrow(added, kind).collect()  # one matrix a length
    out = {d: np.zeros((k, k)) for d, k in fields.items()}
    for r in total:
        out[r.d][r.i] = r.row
    return out


def _components(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors as columns;
    those that are zero but for rounding are left out."""
    if not len(v):
        return np.zeros(0), np.zeros((0, 0))
    e, u = np.linalg.eigh((v + v.T) / 2)
    e, u = e[::-1][:most], u[:, ::-1][:, :most]
    real = e > max(e[0], 0.0) * len(v) * np.finfo(float).eps
    e, u = e[real], u[:, real]
    sign = np.sign(u[np.abs(u).argmax(axis=0), np.arange(u.shape[1])]) if u.size else np.ones(u.shape[1])
    return e, u * sign


def whiten(rows: DataFrame, components: int, id_col: str, vector_col: str, weights: str = "count") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``:
    a row per row of ``rows`` and component, from vectors of longs (below 2^53).

    The fit list has every row (``weights="count"``) or every distinct vector
    once (``"one"``); ``n`` is its size.  ``deviation`` is the exact sum of
    ``(n x - S)^2``, null where a long cannot hold it; ``whitened`` is ``x - S/n``
    on the unit eigenvector over the root of its eigenvalue, ``explained`` the
    eigenvalue's share of the covariance's trace, and ``identity_error`` the
    largest absolute entry of the whitened fit list's covariance minus the
    identity.  Signs make the entry of an eigenvector that is largest in
    absolute value positive.

    Rows whose vector is null are left out; a null id stays.  Repeated rows
    come out as often as they come in.  Vectors of another length have a fit
    list of their own.  A component without variance has no root to divide by
    and is left out, so one vector, or copies of one, give no rows; nor does an
    empty table.  Other columns are not read.
    """
    if weights not in ("count", "one"):
        raise ValueError("weights: count or one")
    spark = rows.sparkSession
    known = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("x")).filter("x is not null")
    many = F.count(F.lit(1)) if weights == "count" else F.lit(1)
    distinct = written(known.groupBy("x").agg(many.cast("long").alias("weight")), "distinct-vectors")
    sums = _sums(distinct)
    centre = spark.sparkContext.broadcast(sums)  # numbers by dimension

    def deviations(x: np.ndarray) -> np.ndarray:
        n, s = centre.value[x.shape[1]]
        return _centred(x, n, s)

    cov = _covariance(distinct, lambda x, _: (deviations(x) / float(centre.value[x.shape[1]][0])).astype(float),
                      {d: d for d in sums})
    fit = {d: _components(cov[d] / sums[d][0], components) for d in sums}
    trace = {d: float(np.trace(cov[d])) / sums[d][0] for d in sums}
    basis = spark.sparkContext.broadcast({d: u / np.sqrt(e) for d, (e, u) in fit.items()})  # a matrix by length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for of, x, w in _groups(batches):
            dev = deviations(x)
            n = centre.value[x.shape[1]][0]
            if dev.dtype == object or float(np.abs(dev).max(initial=0)) ** 2 * max(1, x.shape[1]) >= 2.0 ** 62:
                total = [int((r * r).sum()) for r in dev.astype(object)]
                total = [t if t <= _LONG else None for t in total]
            else:
                total = (dev * dev).sum(axis=1)
            y = (dev / float(n)).astype(float) @ basis.value[x.shape[1]]
            yield pa.RecordBatch.from_arrays(
                [of.column("x"), of.column("weight"), pa.array(total, pa.int64()),
                 pa.array(list(y), pa.list_(pa.float64()))], ["x", "weight", "deviation", "whitened"])

    done = written(distinct.mapInArrow(run, "x array<long>, weight long, deviation long, whitened array<double>"),
                   "whitened-vectors")
    error = _identity_error(done, sums, {d: len(e) for d, (e, _) in fit.items()})
    model = [(d, k + 1, sums[d][0], float(e[k]) / trace[d], error[d]) for d, (e, _) in fit.items() for k in range(len(e))]
    named = spark.createDataFrame(model, "d int, component int, n long, explained double, identity_error double")
    return (known.join(done.select("x", "deviation", "whitened"), "x")
            .select("vec_id", F.size("x").alias("d"), "deviation", F.posexplode("whitened").alias("k", "whitened"))
            .withColumn("component", F.col("k") + 1)
            .join(F.broadcast(named), ["d", "component"])  # at most `components` rows a length
            .select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"))


def _identity_error(done: DataFrame, sums: dict[int, tuple[int, list[int]]], kept: dict[int, int]) -> dict[int, float]:
    """By length: how far the covariance of the whitened fit list is from the identity."""
    mean = {d: np.zeros(k) for d, k in kept.items()}
    for r in (done.select(F.size("x").alias("d"), "weight", F.posexplode("whitened").alias("i", "y"))
              .groupBy("d", "i").agg(F.sum(F.col("y") * F.col("weight")).alias("s")).collect()):  # a number a component
        mean[r.d][r.i] = r.s / sums[r.d][0]

    def centred(x: np.ndarray, of: pa.RecordBatch) -> np.ndarray:
        y = of.column("whitened").flatten().to_numpy(zero_copy_only=False)
        return y.reshape(of.num_rows, -1) - mean[x.shape[1]]

    cov = _covariance(done, centred, kept)
    return {d: float(np.abs(cov[d] / sums[d][0] - np.eye(k)).max(initial=0.0)) for d, k in kept.items()}
