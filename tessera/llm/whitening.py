"""Embedding whitening with eigenvectors refined in mixed precision.

The covariance is added up over the table in whole numbers, centred before
anything is multiplied, so it is exact and does not depend on how the rows are
dealt.  On the driver only matrices of dimension x dimension are held: the
eigenvectors of the covariance in float32 are the start, and each refinement
of Ogita and Aishima corrects all of them by a few matrix products in extended
precision, doubling the right digits.  Where eigenvalues lie too close for the
correction to tell their vectors apart, the vectors of the cluster are turned
by the eigenvectors of the small problem that they span, shifted by the
cluster's own eigenvalue.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: An entry c becomes the whole number floor(SCALE * c) + SHIFT; beyond +-LARGEST it stays there.
SCALE, SHIFT, LARGEST = 1024.0, 100000, 2.0**40
#: Rows handled at once, and the largest number up to which doubles hold every whole number.
ROWS, EXACT = 4096, float(2**53)
#: Refinements at most; each doubles the right digits, so three or four are used.
STEPS = 40

_DECIMAL = pa.decimal128(38, 0)
_LONG = np.longdouble


# -- whole numbers from vectors -------------------------------------------------
def whole_numbers(column: pa.Array, dims: int | None = None) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For every length of vectors that occurs, or for ``dims`` alone: row
    numbers, and a matrix of doubles that are whole numbers (without SHIFT, which
    centring takes away again), of the vectors without null or non-finite entries."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.asarray(pc.list_value_length(column).fill_null(-1))
    flat = pc.list_flatten(column)
    value = flat.cast(pa.float64()).to_numpy(zero_copy_only=False) if len(flat) else np.zeros(0)  # a null is NaN
    begin = np.concatenate([[0], np.cumsum(np.maximum(size, 0))])[:-1]
    out = {}
    for d in [dims] if dims is not None else np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero(size == d)
        x = value[begin[rows][:, None] + np.arange(d)]
        whole = np.isfinite(x).all(1)
        out[d] = rows[whole], np.floor(SCALE * np.clip(x[whole], -LARGEST / SCALE, LARGEST / SCALE))
    return out


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Array]:
    for b in batches:
        for i in range(0, b.num_rows, ROWS):
            yield b.slice(i, ROWS)


def exact_products(x: np.ndarray) -> np.ndarray:
    """x transposed times x as Python integers; ``x`` holds whole numbers."""
    most = np.abs(x).max(initial=0.0)
    if most * most * len(x) <= EXACT:  # every partial sum is a whole number that a double holds
        return (x.T @ x).astype(np.int64).astype(object)
    whole = x.astype(np.int64).astype(object)
    return whole.T.dot(whole)


# -- eigenvectors -----------------------------------------------------------------
def _clusters(value: np.ndarray, gap: float) -> list[np.ndarray]:
    """Runs of two or more sorted eigenvalues, each within ``gap`` of the next."""
    order = np.argsort(value, kind="stable")
    cuts = np.flatnonzero(np.diff(value[order]) > gap) + 1
    return [run for run in np.split(order, cuts) if len(run) > 1]


def _refined(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One correction of approximate eigenvectors ``x`` of ``a``: new vectors,
    eigenvalues, size of the correction, and the distance under which
    eigenvalues could not be told apart."""
    r = np.eye(len(a), dtype=_LONG) - x.T @ x
    s = x.T @ (a @ x)
    value = np.diag(s) / (1 - np.diag(r))
    norm = lambda m: np.sqrt((m * m).sum())
    gap = 2 * (norm(s - np.diag(value)) + norm(a) * norm(r)) + 16 * len(a) * np.finfo(_LONG).eps * norm(a)
    apart = value[None, :] - value[:, None]
    far = np.abs(apart) > gap
    e = np.where(far, (s + value[None, :] * r) / np.where(far, apart, 1), r / 2)
    return x + x @ e, value, float(np.abs(e).max()), float(gap)


def eigenvectors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues from the largest down and the unit eigenvectors (columns)
    of a symmetric matrix, both in extended precision.

    The start is float32.  Each step corrects all vectors at once; clusters
    that the step cannot separate are solved within their own span.  It ends
    when corrections are below the last bit of a double or stop getting
    smaller (a multiple eigenvalue has no single vector to come nearer to)."""
    a = np.asarray(a, _LONG)
    scale = np.abs(a).max(initial=_LONG(0))
    if not scale:
        return np.zeros(len(a), _LONG), np.eye(len(a), dtype=_LONG)
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(_LONG)
    last = np.inf
    for step in range(STEPS):
        x, value, moved, gap = _refined(a, x)
        if step > 2 and (moved < 2.0**-58 or (moved < 2.0**-50 and moved >= last / 2)):
            break
        last = moved
        for run in _clusters(value, gap):
            own = x[:, run]
            middle = value[run].mean()
            small = own.T @ (a @ own - middle * own)
            small = (small + small.T) / 2
            size = np.abs(small).max()
            if size:
                x[:, run] = own @ np.linalg.eigh((small / size).astype(np.float64))[1].astype(_LONG)
    x = x + x @ (np.eye(len(a), dtype=_LONG) - x.T @ x) / 2
    x = x / np.sqrt((x * x).sum(0))
    value = (x * (a @ x)).sum(0)
    order = np.argsort(-value, kind="stable")
    return value[order] * scale, x[:, order]


# -- on a table -------------------------------------------------------------------
def _sums(vectors: DataFrame) -> tuple[int, int, list[int]]:
    """Length of the vectors, their number, and the exact sum of every place."""
    schema = pa.schema([("dims", pa.int32()), ("place", pa.int32()), ("n", pa.int64()), ("total", _DECIMAL)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for b in _parts(batches):
            for d, (_, x) in whole_numbers(b.column("embedding")).items():
                one = held.setdefault(d, [0, np.zeros(d, object)])
                one[0] += len(x)
                one[1] = one[1] + x.astype(np.int64).sum(0).astype(object)
            if sum(held) > 1 << 20:
                yield from out(held)
                held = {}
        yield from out(held)

    def out(held: dict[int, list]) -> Iterator[pa.RecordBatch]:
        for d, (n, total) in held.items():
            if n:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(d, d, np.int32)), pa.array(np.arange(d, dtype=np.int32)), pa.array(np.full(d, n)),
                                                  pa.array([int(t) for t in total], _DECIMAL)], schema=schema)

    found = vectors.mapInArrow(run, "dims int, place int, n long, total decimal(38,0)").groupBy("dims", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    best = found.groupBy("dims").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("place", "total"))).alias("t")).orderBy(F.desc("n"), F.desc("dims")).limit(1).collect()
    return (best[0].dims, best[0].n, [int(t.total) for t in best[0].t]) if best else (0, 0, [])


def _products(vectors: DataFrame, dims: int, centre: np.ndarray) -> np.ndarray:
    """Exact sums of products of the centred whole numbers, dims x dims."""
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("total", _DECIMAL)])
    upper = np.triu_indices(dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims), object)
        for b in _parts(batches):
            total = total + exact_products(whole_numbers(b.column("embedding"), dims)[dims][1] - centre)
        yield pa.RecordBatch.from_arrays([pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)), pa.array([int(t) for t in total[upper]], _DECIMAL)], schema=schema)

    out = np.zeros((dims, dims), object)
    for r in vectors.mapInArrow(run, "i int, j int, total decimal(38,0)").groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        out[r.i, r.j] = out[r.j, r.i] = int(r.total)
    return out


def _identity_error(vectors: DataFrame, dims: int, centre: np.ndarray, offset: np.ndarray, turn: np.ndarray) -> float:
    """Largest absolute entry of the whitened vectors' covariance, measured
    over the table, minus the identity."""
    k = turn.shape[1]
    places = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("total", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for b in _parts(batches):
            x = whole_numbers(b.column("embedding"), dims)[dims][1]
            y = np.concatenate([np.ones((len(x), 1)), (x - centre - offset) @ turn], 1)
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in places], pa.int32()), pa.array([p[1] for p in places], pa.int32()), pa.array([total[p] for p in places])], schema=schema)

    out = np.zeros((k + 1, k + 1))
    for r in vectors.mapInArrow(run, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        out[r.i, r.j] = out[r.j, r.i] = r.total
    mean = out[0, 1:] / out[0, 0]
    return float(np.abs(out[1:, 1:] / out[0, 0] - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def whiten(embeddings: DataFrame, components: int = 8) -> DataFrame:
    """Vectors projected on the leading components of their covariance and
    scaled to unit variance.

    One row per remaining vector and component: ``vec_id, component`` (1 for
    the largest eigenvalue), ``n`` (remaining vectors), ``deviation``
    (decimal(38,0): sum over places of (n*x - S)^2, exact, null beyond 38
    digits), ``whitened``, ``explained`` (eigenvalue by trace) and
    ``identity_error`` (of the components that vary, measured on the table).

    Rows whose vector is null, or holds null, NaN or infinite entries, are
    left out, and so are vectors of another length than most have (of equally
    many the longer).  Entries beyond +-2^40 / 1024 count as that.  There are
    at most as many components as places.  A component without variance (a
    constant table, one row) is whitened to 0 and explains 0.  Rows that
    repeat count each time; a null vec_id is a row like any other; other
    columns are ignored; an empty table gives no rows.
    """
    vectors = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    dims, n, sums = _sums(vectors.select("embedding"))
    out = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if not n:
        return embeddings.sparkSession.createDataFrame([], out)
    centre = np.array([float(round(Fraction(s, n))) for s in sums])
    rest = [s - n * int(c) for s, c in zip(sums, centre)]  # what the rounding of the centre left, times n
    products = _products(vectors.select("embedding"), dims, centre)
    exact = n * products - np.outer(np.array(rest, object), np.array(rest, object))
    covariance = np.array([[_LONG(int(v)) for v in row] for row in exact]) / _LONG(n) / _LONG(n)
    value, vector = eigenvectors(covariance)
    k, trace = min(components, dims), np.trace(covariance)
    varies = value[:k] > dims * 2.0**-52 * max(value[0], _LONG(0))
    turn = (np.where(varies, vector[:, :k] / np.sqrt(np.where(varies, value[:k], 1)), 0)).astype(np.float64)
    offset = np.array([_LONG(r) / _LONG(n) for r in rest]).astype(np.float64)
    error = _identity_error(vectors.select("embedding"), dims, centre, offset, turn[:, varies])
    explained = np.where(varies, value[:k] / (trace if trace else 1), 0).astype(np.float64)
    schema = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", _DECIMAL), ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])
    left = np.array(rest, object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _parts(batches):
            rows, x = whole_numbers(b.column("embedding"), dims)[dims]
            y = x - centre
            far = [int(v) for v in ((n * y.astype(np.int64).astype(object) - left) ** 2).sum(1)] if len(y) else []
            m = len(rows)
            yield pa.RecordBatch.from_arrays([
                b.column("vec_id").take(pa.array(np.repeat(rows, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                pa.array([v if v < 10**38 else None for v in far], _DECIMAL).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(((y - offset) @ turn).reshape(-1)), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))], schema=schema)

    return vectors.mapInArrow(run, out)
