"""Embedding whitening from polarised sums of squares.

Entries become the integers x = floor(256 c). The fit list is every distinct x
vector once (a grouped table, stored). Two passes over it:

1. n and the sum S of every dimension, exact;
2. with D = n x - S, the sum of D_i^2 for every dimension and of
   (D_i + D_j)^2 for every pair of dimensions, exact.

Polarisation gives every cross-covariance from the second pass:
2 sum D_i D_j = sum (D_i + D_j)^2 - sum D_i^2 - sum D_j^2. The covariance
matrix, exact integers over n^3 rounded once, goes to ``eigh`` on the driver;
a third pass projects all rows.

Tasks send their sums as limbs of 30 bits, added as longs by Spark; the driver
holds d (d + 1) / 2 numbers for d dimensions, whatever the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odpanel.llm.common import stored

SCALE = 256
COMPONENTS = 4
LIMB = 30                        # bits of a limb of a partial sum
LIMBS = 12                       # 360 bits and a sign: any sum of squares of longs
BLOCK = 1 << 16                  # pair sums that a task squares at once, at most
LONG = 1 << 63
SUM_SCHEMA = "cell long, " + ", ".join(f"l{k} long" for k in range(LIMBS))


def usable(vector: Column) -> Column:
    """Not null, and every entry set and finite."""
    c = vector.cast("array<double>")
    return vector.isNotNull() & F.forall(
        c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))


def integers(vector: Column) -> Column:
    """x = floor(256 c) as longs; beyond the range of a long, its end."""
    return F.transform(vector.cast("array<double>"), lambda v: F.floor(v * SCALE))


def _matrix(column: pa.Array, dims: int, fill=0, kind=np.int64) -> np.ndarray:
    """A list column as rows of ``dims`` numbers, short lists padded."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == dims).all():
        return values.reshape(-1, dims).astype(kind, copy=False)
    out = np.full((len(lengths), dims), fill, kind)
    out[np.arange(dims) < lengths[:, None]] = values
    return out


def _sums(values: np.ndarray) -> list[int]:
    """Exact column sums of a long matrix of fewer than 2^31 rows."""
    low = (values & 0xFFFFFFFF).sum(axis=0)
    high = (values >> 32).sum(axis=0)
    return [(int(h) << 32) + int(v) for h, v in zip(high, low, strict=True)]


def _square_sums(values: np.ndarray) -> list[int]:
    """Exact column sums of the squares, of longs below 2^62 or of objects."""
    if values.dtype == object:
        return [int(x) for x in (values * values).sum(axis=0)]
    if not values.size or int(np.abs(values).max()) < 1 << 23:
        if len(values) < 1 << 16:
            return (values * values).sum(axis=0).tolist()
    a, b = values >> 31, values & 0x7FFFFFFF
    parts = [_sums(a * a), _sums(a * b), _sums(b * b)]
    return [(x << 62) + (y << 32) + z for x, y, z in zip(*parts, strict=True)]


def _limbs(total: int) -> list[int]:
    """The number in base 2^30, the sign on every limb."""
    sign, rest, out = (-1 if total < 0 else 1), abs(total), []
    for _ in range(LIMBS):
        out.append(sign * (rest & ((1 << LIMB) - 1)))
        rest >>= LIMB
    return out


def _sum_rows(totals: dict[int, int]) -> pa.RecordBatch:
    limbs = np.array([_limbs(t) for t in totals.values()], np.int64).reshape(-1, LIMBS)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(totals), pa.int64()), *(pa.array(limbs[:, k]) for k in range(LIMBS))],
        ["cell", *(f"l{k}" for k in range(LIMBS))])


def _totals(parts: DataFrame) -> dict[int, int]:
    """Exact totals by cell; one row per cell reaches the driver."""
    got = parts.groupBy("cell").agg(*(F.sum(f"l{k}").alias(f"l{k}") for k in range(LIMBS)))
    return {r.cell: sum(r[f"l{k}"] << (LIMB * k) for k in range(LIMBS)) for r in got.collect()}


def _centred(x: np.ndarray, n: int, sums: list[int], reach: int) -> np.ndarray:
    """n x - S: longs where twice the largest is below 2^62, else objects."""
    if 2 * reach < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def first_sums(fit: DataFrame, dims: int) -> tuple[int, list[int], int]:
    """n, S and the largest absolute entry of n x - S over the fit list."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, int] = {}
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            totals[-1] = totals.get(-1, 0) + len(x)
            for i, s in enumerate(_sums(x)):
                totals[i] = totals.get(i, 0) + s
        if totals:
            yield _sum_rows(totals)

    totals = _totals(fit.mapInArrow(run, SUM_SCHEMA))
    n, sums = totals.get(-1, 0), [totals.get(i, 0) for i in range(dims)]
    ends = fit.select(F.max(F.array_max("x")).alias("hi"), F.min(F.array_min("x")).alias("lo"))
    hi, lo = ends.first()
    most = max([abs(n * v - s) for v in (hi or 0, lo or 0, 0) for s in sums], default=0)
    return n, sums, most


def square_sums(fit: DataFrame, dims: int, n: int, sums: list[int], reach: int) -> dict:
    """Exact sums over the fit list by cell i * d + j: of D_i^2 for i = j and
    of (D_i + D_j)^2 for i < j."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, int] = {}
        step = max(1, BLOCK // dims)
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            for k in range(0, len(x), step):
                d = _centred(x[k:k + step], n, sums, reach)
                for i in range(dims):
                    pair = d[:, i:].copy()
                    pair[:, 1:] += d[:, i:i + 1]
                    for j, s in enumerate(_square_sums(pair), i):
                        totals[i * dims + j] = totals.get(i * dims + j, 0) + s
        if totals:
            yield _sum_rows(totals)

    return _totals(fit.mapInArrow(run, SUM_SCHEMA))


def covariance(squares: dict, dims: int, n: int) -> np.ndarray:
    """The covariance matrix of x from the sums of ``square_sums``: each entry
    an exact ratio, rounded once."""
    v = np.zeros((dims, dims))
    for i in range(dims):
        v[i, i] = squares[i * dims + i] / n ** 3
        for j in range(i + 1, dims):
            cross = squares[i * dims + j] - squares[i * dims + i] - squares[j * dims + j]
            v[i, j] = v[j, i] = cross / (2 * n ** 3)
    return v


def _project(x: pa.Array, dims: int, n: int, sums: list[int], reach: int,
             axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = _centred(_matrix(x, dims), n, sums, reach)
    return d, (d / n).astype(np.float64) @ axes


def whiten(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error,
    deviation_exact) for each usable row and its first ``components``
    components, by falling eigenvalue.

    Rows whose vector is null or holds a null or non-finite entry are left
    out. A vector shorter than the longest counts as padded with zeros. A null
    or repeated vec_id, equal vectors: a row each. Without a usable row, or
    with empty vectors only, the result is empty. ``deviation`` is null where
    it is beyond a long (``deviation_exact``, a decimal, holds 38 digits). A
    component without variance has ``whitened`` null (and is no part of
    identity_error, which is null without any other). Other columns are not
    read."""
    spark = rows.sparkSession
    v = F.col(vector)
    src = rows.select(F.col(vec_id).cast("long").alias("vec_id"),
                      F.when(usable(v), integers(v)).alias("x")).filter(F.col("x").isNotNull())
    fit = stored(spark, src.select("x").distinct(), "fit")
    dims = fit.select(F.max(F.size("x"))).first()[0] or 0
    schema = ("vec_id long, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double, deviation_exact decimal(38,0)")
    if not dims:
        return spark.createDataFrame([], schema)
    n, sums, reach = first_sums(fit, dims)
    values, vectors = np.linalg.eigh(
        covariance(square_sums(fit, dims, n, sums, reach), dims, n))
    count = min(components, dims)
    values, vectors = values[::-1], vectors[:, ::-1][:, :count]
    total = float(values.sum())
    least = abs(float(values[0])) * dims * np.finfo(float).eps
    whole = [bool(e > least) for e in values[:count]]
    roots = np.sqrt(np.where(whole, values[:count], 1.0))
    axes = vectors / roots
    share = [float(e / total) if total > 0 else 0.0 for e in values[:count]]
    used = [k for k in range(count) if whole[k]]

    def weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, w = _project(batch.column(0), dims, n, sums, reach, axes)
            yield pa.RecordBatch.from_arrays([pa.array(w[:, k]) for k in used],
                                             [f"w{k}" for k in used])

    error = None
    if used:
        fitted = fit.mapInArrow(weights, ", ".join(f"w{k} double" for k in used))
        got = fitted.agg(*(F.covar_pop(f"w{a}", f"w{b}").alias(f"c{a}_{b}")
                           for a in used for b in used if a <= b)).first()
        error = max(abs(got[f"c{a}_{b}"] - (a == b)) for a in used for b in used if a <= b)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, w = _project(batch.column(1), dims, n, sums, reach, axes)
            spread = (d * d).sum(axis=1) if d.dtype == object or dims * reach ** 2 < LONG else \
                (d.astype(object) ** 2).sum(axis=1)
            m = len(d)
            for k in range(count):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.full(m, k + 1, np.int32)),
                     pa.array(np.full(m, n, np.int64)),
                     pa.array([int(s) if s < LONG else None for s in spread], pa.int64()),
                     pa.array(w[:, k]) if whole[k] else pa.nulls(m, pa.float64()),
                     pa.array(np.full(m, share[k])),
                     pa.array([error] * m, pa.float64()),
                     pa.array([str(s) if s < 10 ** 38 else None for s in spread], pa.string())],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained",
                     "identity_error", "exact"])

    out = src.mapInArrow(project, "vec_id long, component int, n long, deviation long, "
                         "whitened double, explained double, identity_error double, exact string")
    return out.withColumn("deviation_exact", F.col("exact").cast("decimal(38,0)")).drop("exact")
