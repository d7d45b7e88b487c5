"""Whitening of embeddings by FEAST: eigenvalue intervals of the covariance, each solved by contour integration.

Two passes over the distinct vectors add up their sums and their centred products, in tasks and then by cell; only d sums and d * d
products come to the driver, whatever the rows. There the largest eigenvalues are cut into intervals by inertia counts (a symmetric
indefinite factorisation of V - s*I has as many positive pivots as V has eigenvalues above s). In each interval, Gauss-Legendre
quadrature over a circle sums the complex shifted solves (z*I - V)^-1 Y, which projects Y onto the interval's eigenvectors;
Rayleigh-Ritz extracts them, and this repeats until the residuals are those of double precision. An interval whose inertia count is
not reached starts again with a larger subspace. A last Rayleigh-Ritz over all intervals makes their vectors orthogonal.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textkit import checkpointed

COMPONENTS = 16
NODES = 16  # of the quadrature, on a half circle; the other half is conjugate
PER_INTERVAL = 8  # eigenvalues that an interval holds, unless they are equal
SCALE, OFFSET = 64, 1_000_000
_ZERO = 1e-12  # of the trace: eigenvalues up to this share are zero
_EXACT = 2**62


def inertia_above(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix are above the shift: positive pivots of a factorisation with 1x1 and 2x2 pivots (Bunch and Parlett)."""
    a = v - shift * np.eye(len(v))
    above = 0
    while len(a):
        size, diagonal = np.abs(a), np.abs(np.diag(a))
        one = int(diagonal.argmax())
        i, j = np.unravel_index(int((size - np.diag(diagonal)).argmax()), a.shape)
        if size[i, j] == 0 and diagonal[one] == 0:
            break
        pivot = [one] if diagonal[one] >= 0.64 * size[i, j] or i == j else [i, j]
        rest = np.setdiff1d(np.arange(len(a)), pivot)
        block, side = a[np.ix_(pivot, pivot)], a[np.ix_(rest, pivot)]
        above += int(block[0, 0] > 0) if len(pivot) == 1 else 1  # a 2x2 pivot has one eigenvalue of each sign
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(block, side.T)
        a = (a + a.T) / 2
    return above


def _cut(v: np.ndarray, want: int, low: float, high: float) -> float:
    """A shift with just `want` eigenvalues above it; with more where they are equal to double precision."""
    tight = 1e-14 * max(abs(low), abs(high))
    while high - low > tight:
        middle = (low + high) / 2
        found = inertia_above(v, middle)
        if found == want:
            return middle
        low, high = (middle, high) if found > want else (low, middle)
    return low


def _rayleigh_ritz(v: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u, size, _ = np.linalg.svd(y, full_matrices=False)
    q = u[:, size > 1e-13 * size[0]]
    values, vectors = np.linalg.eigh(q.T @ v @ q)
    return values, q @ vectors


def feast(v: np.ndarray, low: float, high: float, count: int, turns: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """The `count` eigenvalues of v in (low, high] and their vectors."""
    d = len(v)
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    middle, radius = (low + high) / 2, (high - low) / 2
    circle = radius * np.exp(1j * np.pi * (nodes + 1) / 2)
    tight = 2e-15 * d * np.abs(v).sum(1).max()
    rng = np.random.default_rng(7)
    width = min(d, 2 * count + 8)
    while True:
        y = rng.standard_normal((d, width))
        for _ in range(turns):
            solves = np.linalg.solve((middle + circle)[:, None, None] * np.eye(d) - v, np.broadcast_to(y.astype(complex), (NODES, d, y.shape[1])))
            projected = (np.real(circle[:, None, None] * solves) * (weights / 2)[:, None, None]).sum(0)
            values, vectors = _rayleigh_ritz(v, projected)
            inside = (values > low) & (values <= high)
            residual = np.linalg.norm(v @ vectors[:, inside] - vectors[:, inside] * values[inside], axis=0)
            if inside.sum() == count and (residual < tight).all():
                return values[inside], vectors[:, inside]
            y = vectors
        if width == d:  # the whole space: Rayleigh-Ritz is exact
            keep = np.argsort(-values)[:count] if inside.sum() != count else np.flatnonzero(inside)
            return values[keep], vectors[:, keep]
        width = min(d, 2 * width)


def top_components(v: np.ndarray, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The k largest positive eigenvalues of a covariance, falling, and their unit vectors; fewer where its rank is less."""
    trace = float(np.trace(v))
    if not trace > 0:
        return np.empty(0), np.empty((len(v), 0))
    zero, bound = _ZERO * trace, float(np.abs(v).sum(1).max()) * (1 + 1e-9)  # no eigenvalue is above the largest sum of a row
    wanted = min(k, inertia_above(v, zero))
    high, above, values, vectors = bound, 0, [], []
    while above < wanted:
        low = _cut(v, min(above + PER_INTERVAL, wanted), zero, high)
        total = inertia_above(v, low)
        found = feast(v, low, high, total - above)
        values.append(found[0])
        vectors.append(found[1])
        high, above = low, total
    values, vectors = _rayleigh_ritz(v, np.concatenate(vectors, 1))
    order = np.argsort(-values)[:wanted]
    return values[order], vectors[:, order]


def usable(vector: Column, length: int) -> Column:
    """Whether a vector has this length and only finite entries."""
    fine = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce((F.size(vector) == length) & fine, F.lit(False))


def common_length(rows: DataFrame, vector: str) -> int:
    """The most frequent length of vectors with finite entries only, the larger of equally frequent ones; 0 if there is none."""
    fine = rows.filter(F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False))))
    found = fine.groupBy(F.size(vector).alias("d")).agg(F.count("*").alias("n")).filter("d > 0").orderBy(F.desc("n"), F.desc("d")).first()
    return found.d if found else 0


def _matrix(column: pa.ListArray, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _sums(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[pa.RecordBatch]:
    """cell, value: the sum in each dimension, and under -1 the number of vectors."""
    total = np.zeros(d + 1, object)
    for batch in batches:
        x = _matrix(batch.column(0), d)
        total += np.array([len(x), *(int(s) for s in (x.sum(0) if np.abs(x).max(initial=0) < _EXACT // max(1, len(x)) else x.astype(object).sum(0)))], object)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, d)), pa.array([str(t) for t in total])], ["cell", "value"])


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, exact: as longs where they hold it, else as integers of any size."""
    if n * int(np.abs(x).max(initial=0)) + int(np.abs(sums).max(initial=0)) < _EXACT:
        return x * n - sums.astype(np.int64)
    return x.astype(object) * n - sums


def _products(batches: Iterator[pa.RecordBatch], d: int, n: int, sums: np.ndarray, project: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """cell, value: sums of products of the centred vectors, or of their projections."""
    k = d if project is None else project.shape[1]
    total = np.zeros((k, k))
    for batch in batches:
        y = _centred(_matrix(batch.column(0), d), n, sums).astype(float) / n
        y = y if project is None else y @ project
        total += y.T @ y
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k)), pa.array(total.ravel())], ["cell", "value"])


def _cells(frame: DataFrame, k: int) -> np.ndarray:
    """k * k products, added up over all tasks."""
    out = np.zeros(k * k)
    for r in frame.groupBy("cell").agg(F.sum("value").alias("value")).collect():
        out[r.cell] = r.value
    return out.reshape(k, k)


def _whitened(batches: Iterator[pa.RecordBatch], d: int, n: int, sums: np.ndarray, project: np.ndarray) -> Iterator[pa.RecordBatch]:
    k = project.shape[1]
    for batch in batches:
        y = _centred(_matrix(batch.column(1), d), n, sums)
        if y.dtype != object and d * int(np.abs(y).max(initial=0)) ** 2 < _EXACT:
            deviation = pa.array((y * y).sum(1)).cast(pa.decimal128(38, 0))
        else:
            exact = [sum(int(c) ** 2 for c in row) for row in y]
            deviation = pa.array([e if e < 10**38 else None for e in exact], pa.decimal128(38, 0))
        rows = pa.array(np.repeat(np.arange(len(y)), k))
        component = pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(y)))
        projected = pa.array((y.astype(float) / n @ project).ravel())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), component, deviation.take(rows), projected], ["vec_id", "component", "deviation", "whitened"])


def whiten(rows: DataFrame, vector: str = "embedding", key: str = "vec_id", k: int = COMPONENTS) -> DataFrame:
    """rows (key, vector) -> vec_id, component, n, deviation, whitened, explained, identity_error, deviation_wide; a row per row and component.

    Vectors that are null, hold null or non-finite entries, or have another length than most of the others take no part. A repeated vector
    counts once in the fit, and each of its rows has its results. There are as many components as eigenvalues above zero: none for an empty
    table or a single vector. deviation is null where a long does not hold it; deviation_wide holds 38 digits. Other columns are not read.
    """
    rows = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    d = common_length(rows, "vector")
    x = F.transform("vector", lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")).cast("long") + OFFSET)
    rows = rows.filter(usable(F.col("vector"), d)).select("vec_id", x.alias("x"))
    fit = checkpointed(rows.select("x").distinct())
    found = fit.mapInArrow(partial(_sums, d=d), "cell long, value string").groupBy("cell").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect() if d else []
    total = {r.cell: int(r.value) for r in found}
    n, sums = total.get(-1, 0), np.array([total.get(c, 0) for c in range(d)], object)
    known = {"d": d, "n": n, "sums": sums}
    kind = "cell long, value double"
    v = _cells(fit.mapInArrow(partial(_products, **known), kind), d) / n if n else np.zeros((0, 0))
    values, vectors = top_components(v, k)
    if not len(values):
        return rows.select(*_empty()).limit(0)
    project = vectors / np.sqrt(values)
    error = float(np.abs(_cells(fit.mapInArrow(partial(_products, **known, project=project), kind), len(values)) / n - np.eye(len(values))).max())
    explained = F.element_at(F.array(*[F.lit(float(e)) for e in values / np.trace(v)]), F.col("component"))
    out = rows.mapInArrow(partial(_whitened, **known, project=project), "vec_id long, component int, deviation decimal(38,0), whitened double")
    narrow = F.col("deviation").between(0, (1 << 63) - 1)
    return out.select(
        "vec_id", "component", F.lit(n).cast("long").alias("n"), F.when(narrow, F.col("deviation").cast("long")).alias("deviation"), "whitened",
        explained.alias("explained"), F.lit(error).alias("identity_error"), F.col("deviation").alias("deviation_wide"),
    )


def _empty() -> list[Column]:
    kinds = {"vec_id": "long", "component": "int", "n": "long", "deviation": "long", "whitened": "double", "explained": "double", "identity_error": "double", "deviation_wide": "decimal(38,0)"}
    return [F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()]
