"""Embedding whitening: distributed centred scatter, cyclic Jacobi rotations, one broadcast matrix."""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._vectors import Profile, components, profile, usable, whole

#: Components returned.
COMPONENTS = 32
#: Longest vectors: the driver holds a few matrices of this order.
MOST_WIDTH = 4096
#: Whole components are held within this, so that all sums of products stay exact.
LIMIT = 1 << 46
_LONG = 2**63 - 1
SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def jacobi(matrix: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (as rows) of a symmetric matrix.

    Pairs of places are taken row by row, again and again, and each off-diagonal entry is rotated to zero, until in a
    whole sweep none is larger than rounding beside its two diagonal entries; judging by those, not by the largest
    entry, is what keeps small eigenvalues accurate."""
    a = np.array(matrix, float)
    d, eps, tiny = len(a), np.finfo(float).eps, np.finfo(float).tiny
    v = np.eye(d)
    for _ in range(sweeps):
        still = True
        for p in range(d - 1):
            for q in range(p + 1, d):
                app, aqq, apq = float(a[p, p]), float(a[q, q]), float(a[p, q])
                if abs(apq) <= max(tiny, eps * math.sqrt(abs(app)) * math.sqrt(abs(aqq))):
                    continue
                still = False
                theta = (aqq - app) / (2 * apq)
                t = math.copysign(1.0, theta) / (abs(theta) + math.hypot(theta, 1.0))
                c = 1 / math.hypot(t, 1.0)
                s = t * c
                for m in (a, v):
                    rp, rq = m[p].copy(), m[q].copy()
                    m[p], m[q] = c * rp - s * rq, s * rp + c * rq
                a[:, p], a[:, q] = a[p], a[q]
                a[p, p], a[q, q] = app - t * apq, aqq + t * apq
                a[p, q] = a[q, p] = 0.0
        if still:
            break
    order = np.argsort(-np.diag(a), kind="stable")
    return np.diag(a)[order], v[order]


def _sums(width: int, scale: int):
    schema = pa.schema([("i", pa.int32()), ("s", pa.decimal128(38, 0))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * width
        for batch in batches:
            for at in range(0, batch.num_rows, 1 << 16):  # so many longs within LIMIT add up to a long
                x = whole(components(batch.slice(at, 1 << 16).column("v"), width), scale, LIMIT)
                total = [t + int(s) for t, s in zip(total, x.sum(0), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([Decimal(t) for t in total], schema[1].type)], schema=schema)

    return run


def products(y: np.ndarray, bound: int) -> np.ndarray:
    """y'y of whole numbers of at most `bound`, exactly, as whole numbers of any size."""
    step = 2**53 // max(bound * bound, 1)  # so many products add up exactly in doubles
    if not step:
        z = y.astype(object)
        return z.T @ z
    out = np.zeros((y.shape[1],) * 2, object)
    for at in range(0, len(y), min(step, 1 << 20)):
        z = y[at : at + min(step, 1 << 20)].astype(float)
        out = out + (z.T @ z).astype(np.int64).astype(object)
    return out


def _scatter(width: int, scale: int, middle: np.ndarray, bound: int):
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("s", pa.decimal128(38, 0))])
    at_i, at_j = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width), object)
        for batch in batches:
            total = total + products(whole(components(batch.column("v"), width), scale, LIMIT) - middle, bound)
        yield pa.RecordBatch.from_arrays([pa.array(at_i.astype(np.int32)), pa.array(at_j.astype(np.int32)), pa.array([Decimal(int(t)) for t in total[at_i, at_j]], schema[2].type)], schema=schema)

    return run


def covariance(rows: DataFrame, shape: Profile, scale: int) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Sums of the dimensions, their rounded means, and the covariance, correctly rounded.

    Two passes: sums, then products of what is left of each whole component beyond the rounded mean. Both are exact, so
    no order of tasks changes them; the rest of the mean, below one half, is taken off in whole numbers."""
    n, width = shape.n, shape.width
    sums = {r["i"]: int(r["s"]) for r in rows.select("v").mapInArrow(_sums(width, scale), "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()}
    total = [sums[i] for i in range(width)]
    middle = [(2 * t + n) // (2 * n) for t in total]
    rest = [t - n * m for t, m in zip(total, middle, strict=True)]
    bound = 2 * int(min(shape.most * scale + 1, LIMIT)) + 1
    found = rows.select("v").mapInArrow(_scatter(width, scale, np.array(middle, np.int64), bound), "i int, j int, s decimal(38,0)").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    v = np.zeros((width, width))
    for r in found:
        i, j = r["i"], r["j"]
        v[i, j] = v[j, i] = (n * int(r["s"]) - rest[i] * rest[j]) / (n * n)
    return total, np.array(middle, np.int64), v


def _identity(width: int, scale: int, middle: np.ndarray, off: np.ndarray, matrix: np.ndarray):
    size = matrix.shape[1]
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("s", pa.float64())])
    at_i, at_j = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(size), np.zeros((size, size))
        for batch in batches:
            w = ((whole(components(batch.column("v"), width), scale, LIMIT) - middle) - off) @ matrix
            first, second = first + w.sum(0), second + w.T @ w
        i, j = np.concatenate([np.full(size, -1), at_i]), np.concatenate([np.arange(size), at_j])
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(np.concatenate([first, second[at_i, at_j]]))], schema=schema)

    return run


def deviations(y: np.ndarray, rest: list[int], n: int, bound: int) -> list[int]:
    """Sums over the dimensions of (n * y - rest)^2, exactly; beyond a long, the largest long."""
    if y.shape[1] * (n * (bound + 1)) ** 2 < 2**63:
        z = n * y - np.array(rest, np.int64)
        return (z * z).sum(1).tolist()
    z = n * y.astype(object) - np.array(rest, object)
    return [min(int(s), _LONG) for s in (z * z).sum(1)]


def _whitened(width: int, scale: int, middle: np.ndarray, rest: list[int], n: int, bound: int, matrix: np.ndarray, explained: np.ndarray, flat: int, error: float):
    schema = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])
    off, k = np.array([r / n for r in rest]), matrix.shape[1] + flat

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                m = part.num_rows
                y = whole(components(part.column("v"), width), scale, LIMIT) - middle
                w = np.concatenate([(y - off) @ matrix, np.full((m, flat), np.nan)], 1)
                ids = part.column("id").take(pa.array(np.repeat(np.arange(m), k)))
                columns = [np.tile(np.arange(1, k + 1, dtype=np.int32), m), np.full(m * k, n), np.repeat(np.array(deviations(y, rest, n, bound), np.int64), k), w.ravel(), np.tile(explained, m), np.full(m * k, error)]
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, f.type, from_pandas=True) for c, f in zip(columns, list(schema)[1:], strict=True))], schema=schema)

    return run


def whiten(vectors: DataFrame, most: int = COMPONENTS, scale: int = 64, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for each remaining row and component from 1 up
    to `most`: the row's entries as whole numbers x = floor(scale * c), less their means, projected on the component and
    divided by the root of its eigenvalue; a constant added to all x would change nothing. `deviation` is the exact sum of (n * x - S)^2; beyond a long it
    is the largest long. `identity_error` is measured over all rows in a further pass.

    Rows whose vector is null or empty, or has null or non-finite entries, take no part; nor do those of another length
    than the most frequent one (of equally frequent ones, the longest). Entries beyond 2^46 when scaled count as 2^46.
    Rows with a null or repeated id each stay. A component without variance (one vector only, equal rows, copied
    dimensions) has null `whitened`, explained 0.0, and no part in `identity_error`. An empty table gives an empty
    result. Other columns are ignored.

    The driver gets sums and a matrix of the vectors' length only, and sends out one of that length by `most`."""
    rows = usable(vectors, vec_col, F.col(id_col).cast("long").alias("id"))
    shape = profile(rows)
    if shape is None:
        return vectors.sparkSession.createDataFrame([], SCHEMA)
    width, n = shape.width, shape.n
    if width > MOST_WIDTH:
        raise ValueError(f"vectors of more than {MOST_WIDTH} entries make a matrix too large for the driver")
    rows = rows.where(F.size("v") == width)
    total, middle, v = covariance(rows, shape, scale)
    rest = [t - n * int(m) for t, m in zip(total, middle, strict=True)]
    e, vectors_of = jacobi(v)
    k = min(most, width)
    real = int((e[:k] > width * np.finfo(float).eps * max(e[0], 0.0)).sum()) if e[0] > 0 else 0
    matrix = (vectors_of[:real] / np.sqrt(e[:real])[:, None]).T
    trace = math.fsum(np.diag(v))
    explained = np.concatenate([e[:real] / trace if real else [], np.zeros(k - real)])
    off, error = np.array([r / n for r in rest]), 0.0
    if real:
        cov, mean = np.zeros((real, real)), np.zeros(real)
        for r in rows.select("v").mapInArrow(_identity(width, scale, middle, off, matrix), "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
            if r["i"] < 0:
                mean[r["j"]] = r["s"] / n
            else:
                cov[r["i"], r["j"]] = cov[r["j"], r["i"]] = r["s"] / n
        error = float(np.abs(cov - np.outer(mean, mean) - np.eye(real)).max())
    bound = 2 * int(min(shape.most * scale + 1, LIMIT)) + 1
    return rows.mapInArrow(_whitened(width, scale, middle, rest, n, bound, matrix, explained, k - real, error), SCHEMA)
