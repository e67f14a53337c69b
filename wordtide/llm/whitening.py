"""Whitening of embeddings by leading principal components.

Tasks sum vectors, then products of centred vectors; only sums of the size of one vector, or of one matrix of
dimension x dimension, reach the driver. There the covariance is reduced to a tridiagonal matrix by Householder
reflections, its largest eigenvalues are found by bisection on Sturm counts, their vectors by inverse iteration
with reorthogonalisation inside clusters, and the reflections are undone. The projection, dimension x components
numbers, is sent to the tasks.

A vector's entries c become whole numbers ``floor(64 c) + 1000000``, so sums and deviations are exact.

Defined results: rows whose vector is null, is empty or holds null or non-finite entries are left out; where vectors
differ in length, those of the most frequent length (ties: the longer) are the fit list and the others are left
out; a null or repeated ``vec_id`` is an ordinary row; extra columns are not read. Directions without variance
(eigenvalues within rounding of zero) give no component, so equal vectors, one vector or an empty table give no
rows. An entry or a deviation beyond what 64 bits hold exactly raises an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

SCALE, SHIFT, MOST = 64.0, 1_000_000, 32
_EPS = float(np.finfo(np.float64).eps)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding array<double>): finite vectors of the most frequent length."""
    x = F.col("embedding").cast("array<double>")
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    fine = vectors.where(F.col("embedding").isNotNull()).select("vec_id", x.alias("embedding")).where((F.size("embedding") > 0) & ~F.coalesce(odd, F.lit(True)))
    sizes = fine.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return fine.where(F.size("embedding") == (sizes[0]["d"] if sizes else -1))


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of a column of equally long lists."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _whole(column: pa.Array) -> np.ndarray:
    x = np.floor(SCALE * _matrix(column))
    if x.size and np.abs(x).max() >= 2.0**52:
        raise ValueError("an entry is too large to be a whole number of 52 bits")
    return x.astype(np.int64) + SHIFT


def _sums(read):
    """A task's number of rows and sums by dimension, as one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                x = read(batch.column(0))
                n, total = n + len(x), x.sum(0) if total is None else total + x.sum(0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.tolist()])], names=["n", "sums"])

    return run


def _products(read, mean: np.ndarray):
    """A task's sums of products of centred entries: the upper triangle, row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                c = read(batch.column(0)) - mean
                total = c.T @ c if total is None else total + c.T @ c
        if total is not None:
            rows = [total[i, i:].tolist() for i in range(len(total))]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(rows, pa.list_(pa.float64()))], names=["i", "products"])

    return run


def totals(vectors: DataFrame, column: str, read, kind: str) -> tuple[int, np.ndarray]:
    """Number of rows and sums by dimension; tasks' sums are added by dimension in Spark."""
    parts = vectors.select(column).mapInArrow(_sums(read), f"n bigint, sums array<{kind}>")
    rows = parts.select("n", F.posexplode("sums").alias("i", "s")).groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    rows.sort(key=lambda r: r["i"])
    return (rows[0]["n"] if rows else 0), np.array([r["s"] for r in rows], np.int64 if kind == "bigint" else np.float64)


def covariance(vectors: DataFrame, column: str, read, mean: np.ndarray, n: int) -> np.ndarray:
    """Covariance with divisor n, centred before multiplying; tasks' sums are added by entry in Spark."""
    parts = vectors.select(column).mapInArrow(_products(read, mean), "i int, products array<double>")
    cells = parts.select("i", F.posexplode("products").alias("j", "p")).groupBy("i", "j").agg(F.sum("p").alias("p"))
    out = np.zeros((len(mean), len(mean)))
    for r in cells.groupBy("i").agg(F.array_sort(F.collect_list(F.struct("j", "p")))["p"].alias("p")).toLocalIterator():
        out[r["i"], r["i"] :] = out[r["i"] :, r["i"]] = np.array(r["p"]) / n
    return out


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and Householder vectors of a symmetric matrix; the k-th vector acts on the rows after k."""
    a, n, mirrors = matrix.copy(), len(matrix), []
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        x[0] += np.copysign(np.linalg.norm(x), x[0])
        norm = np.linalg.norm(x)
        v = x / norm if norm > 0 else x
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = p - (p @ v) * v
        rest -= 2.0 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1 :, k] -= 2.0 * v * (v @ a[k + 1 :, k])
        mirrors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def sturm_count(diagonal: np.ndarray, squares: np.ndarray, at: np.ndarray, least: float) -> np.ndarray:
    """How many eigenvalues lie below each point: the negative pivots of the shifted matrix."""
    pivot = np.ones_like(at)
    below = np.zeros(len(at), np.int64)
    for d, s in zip(diagonal, np.concatenate([[0.0], squares]), strict=True):
        pivot = d - at - s / pivot
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        below += pivot < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, each bisected until no double lies between its bounds."""
    n, squares = len(diagonal), off**2
    reach = np.concatenate([[0.0], np.abs(off)]) + np.concatenate([np.abs(off), [0.0]])
    least = max(float(np.finfo(np.float64).tiny) * max(1.0, float(squares.max(initial=0.0))), 1e-290)
    margin = 2 * n * _EPS * float((np.abs(diagonal) + reach).max()) + least
    low = np.full(k, float((diagonal - reach).min()) - margin)
    high = np.full(k, float((diagonal + reach).max()) + margin)
    rank = n - np.arange(k)  # of the k-th largest, that many lie at or below it
    while True:
        middle = low + (high - low) / 2
        open_ = (middle > low) & (middle < high)
        if not open_.any():
            return middle
        over = sturm_count(diagonal, squares, middle, least) >= rank
        high, low = np.where(open_ & over, middle, high), np.where(open_ & ~over, middle, low)


def _solver(diagonal: np.ndarray, off: np.ndarray, value: float, least: float):
    """Elimination of T - value with row exchanges; gives the function that solves for a right side."""
    n = len(diagonal)
    d, upper, second = (diagonal - value).tolist(), [*off.tolist(), 0.0], [0.0] * n
    lower, factor, swapped = off.tolist(), [0.0] * n, [False] * n
    for i in range(n - 1):
        if abs(lower[i]) > abs(d[i]):
            swapped[i] = True
            d[i], upper[i], second[i], below = lower[i], d[i + 1], upper[i + 1], (d[i], upper[i], 0.0)
        else:
            below = (lower[i], d[i + 1], upper[i + 1])
        d[i] = d[i] if abs(d[i]) >= least else np.copysign(least, d[i])
        factor[i] = below[0] / d[i]
        d[i + 1], upper[i + 1] = below[1] - factor[i] * upper[i], below[2] - factor[i] * second[i]
    d[-1] = d[-1] if abs(d[-1]) >= least else np.copysign(least, d[-1])

    def solve(right: np.ndarray) -> np.ndarray:
        x = right.tolist()
        for i in range(n - 1):
            if swapped[i]:
                x[i], x[i + 1] = x[i + 1], x[i] - factor[i] * x[i + 1]
            else:
                x[i + 1] -= factor[i] * x[i]
        for i in range(n - 1, -1, -1):
            ahead = (upper[i] * x[i + 1] if i + 1 < n else 0.0) + (second[i] * x[i + 2] if i + 2 < n else 0.0)
            x[i] = (x[i] - ahead) / d[i]
        return np.array(x)

    return solve


def vectors_of(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, rounds: int = 6) -> np.ndarray:
    """Unit eigenvectors as columns, by inverse iteration; inside a cluster each is kept orthogonal to those before it."""
    n = len(diagonal)
    norm = float(np.abs(diagonal).max() + 2 * np.abs(off).max(initial=0.0)) or 1.0
    starts = np.random.default_rng(13).standard_normal((len(values), n))
    out = np.zeros((n, len(values)))
    cluster, shift = 0, np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * norm:
            cluster = k
        shift = min(float(value), shift - 10 * _EPS * norm) if k > cluster else float(value)
        solve = _solver(diagonal, off, shift, _EPS * norm)
        x = starts[k] / np.linalg.norm(starts[k])
        for _ in range(rounds):
            y = solve(x)
            y /= np.abs(y).max()
            for _ in range(2):
                y -= out[:, cluster:k] @ (out[:, cluster:k].T @ y)
            y /= np.linalg.norm(y)
            moved, x = min(np.abs(y - x).max(), np.abs(y + x).max()), y
            if moved < 4 * _EPS:
                break
        out[:, k] = x
    return out


def leading(matrix: np.ndarray, most: int = MOST) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors as columns; none within rounding of zero."""
    scale = float(np.abs(matrix).max(initial=0.0))
    if not scale:
        return np.zeros(0), np.zeros((len(matrix), 0))
    diagonal, off, mirrors = tridiagonal(matrix / scale)
    values = leading_values(diagonal, off, min(most, len(matrix)))
    values = values[values > 64 * len(matrix) * _EPS * values[0]]
    vectors = vectors_of(diagonal, off, values)
    for k in range(len(mirrors) - 1, -1, -1):
        v = mirrors[k]
        vectors[k + 1 :] -= 2.0 * np.outer(v, v @ vectors[k + 1 :])
    return values * scale, vectors / np.linalg.norm(vectors, axis=0)


def _project(sums: np.ndarray, n: int, directions: np.ndarray):
    """Deviations and whitened components of a batch of vectors."""
    mean = sums / n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _whole(batch.column(1))
            if float(n) * float(np.abs(x).max()) >= 2.0**62 or ((float(n) * x - sums) ** 2).sum(1).max() >= 2.0**62:
                raise OverflowError("a deviation is beyond 64 bits")
            deviation = ((n * x - sums) ** 2).sum(1)
            white = (x - mean) @ directions
            flat = pa.array(white.ravel(), pa.float64())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, white.size + 1, max(1, white.shape[1])), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviation, pa.int64()), lists], names=["vec_id", "deviation", "white"])

    return run


def whiten(vectors: DataFrame, most: int = MOST) -> DataFrame:
    """``vectors(vec_id, embedding)`` -> one row a vector and component: (vec_id, component, n, deviation, whitened,
    explained, identity_error). Four passes over the vectors; the whitened ones are written once and read back."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    fine = usable(vectors)
    n, sums = totals(fine, "embedding", _whole, "bigint")
    matrix = covariance(fine, "embedding", _whole, sums / max(n, 1), n) if n else np.zeros((0, 0))
    values, directions = leading(matrix, most)
    schema = f"vec_id {kind}, deviation bigint, white array<double>"
    if not len(values):
        white, error, explained = fine.sparkSession.createDataFrame([], schema), 0.0, [0.0]
    else:
        white = materialise(fine.select("vec_id", "embedding").mapInArrow(_project(sums, n, directions / np.sqrt(values)), schema), "whitened")
        _, total = totals(white, "white", _matrix, "double")
        error = float(np.abs(covariance(white, "white", _matrix, total / n, n) - np.eye(len(values))).max())
        explained = (values / np.trace(matrix)).tolist()
    shares = F.array(*[F.lit(float(x)) for x in explained])
    return white.select("vec_id", "deviation", F.posexplode("white").alias("i", "whitened")).select(
        "vec_id",
        (F.col("i") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("i") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
