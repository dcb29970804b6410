"""Whitening of embeddings by the principal axes of their covariance.

Entries are turned into whole numbers, so that equal vectors are equal and sums are exact. Spark finds the distinct vectors and
sums them; tasks multiply centred rows into scatter matrices, which further tasks add up. Only one, of dim * (dim + 1) / 2 sums,
reaches the driver, which factors it: a Cholesky factor with pivots, then one-sided Jacobi rotations of the factor's
columns. The squared norms of the rotated columns are the eigenvalues, the columns themselves, normed, the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkfold.llm.common import cut

SCALE = 256
#: A component whose eigenvalue is under so much of the largest one is not told from rounding and not returned.
RANK = 1e-13
#: Tasks' sums that one task adds up.
FAN = 64
#: Rows whose products are formed at once.
_BLOCK = 4096


@dataclass(frozen=True)
class Whitening:
    """n distinct vectors with the sums of their entries, and the components (rows, unit length) by falling eigenvalue."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([float(s) / self.n for s in self.sums])

    def whitened(self, x: np.ndarray, k: int) -> np.ndarray:
        """Rows of x, centred, along the first k components, each with variance one over the distinct vectors."""
        return (x - self.mean) @ (self.components[:k] / np.sqrt(self.eigenvalues[:k, None])).T


def pivoted_cholesky(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """L (dim, rank) and the order of pivots with matrix[order][:, order] = L @ L.T; the largest diagonal entry left goes first."""
    dim = len(matrix)
    order, factor, left = np.arange(dim), np.zeros((dim, dim)), matrix.diagonal().astype(float).copy()
    least = max(left.max(initial=0.0), 0.0) * dim * np.finfo(float).eps
    for k in range(dim):
        pivot = k + int(np.argmax(left[order[k:]]))
        if left[order[pivot]] <= least:
            return factor[:, :k], order
        order[[k, pivot]] = order[[pivot, k]]
        factor[[k, pivot], :k] = factor[[pivot, k], :k]
        head = np.sqrt(left[order[k]])
        factor[k, k] = head
        below = order[k + 1 :]
        factor[k + 1 :, k] = (matrix[below, order[k]] - factor[k + 1 :, :k] @ factor[k, :k]) / head
        left[below] -= factor[k + 1 :, k] ** 2
    return factor, order


def _rounds(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of n columns, in rounds of pairs that share no column (a round-robin tournament)."""
    players = list(range(n + n % 2))
    half = len(players) // 2
    for _ in range(len(players) - 1):
        pairs = [(a, b) for a, b in zip(players[:half], reversed(players[half:]), strict=True) if max(a, b) < n]
        yield np.array([min(p) for p in pairs], int), np.array([max(p) for p in pairs], int)
        players = [players[0], players[-1], *players[1:-1]]


def jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor times rotations that make its columns orthogonal: plane rotations of pairs of columns until none is needed."""
    columns = factor.T.copy()
    tolerance = np.finfo(float).eps * max(factor.shape)
    for _ in range(sweeps):
        turned = False
        for p, q in _rounds(len(columns)):
            a, b = columns[p], columns[q]
            aa, bb, ab = (a * a).sum(1), (b * b).sum(1), (a * b).sum(1)
            turn = np.abs(ab) > tolerance * np.sqrt(aa * bb)
            if not turn.any():
                continue
            turned = True
            p, q, a, b, aa, bb, ab = p[turn], q[turn], a[turn], b[turn], aa[turn], bb[turn], ab[turn]
            with np.errstate(over="ignore"):
                zeta = (bb - aa) / (2 * ab)
                tangent = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            cosine = 1 / np.hypot(1.0, tangent)
            sine = (cosine * tangent)[:, None]
            columns[p], columns[q] = cosine[:, None] * a - sine * b, sine * a + cosine[:, None] * b
        if not turned:
            break
    else:
        raise ArithmeticError(f"columns are not orthogonal after {sweeps} sweeps")
    return columns.T


def principal_axes(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as rows; as many as the covariance has rank. Of a vector and its negative
    that whose largest entry (the first of equals) is positive is taken."""
    factor, order = pivoted_cholesky(covariance)
    rotated = jacobi(factor) if factor.shape[1] else factor
    norms = np.sqrt((rotated * rotated).sum(0))
    by_size = np.argsort(-norms, kind="stable")
    by_size = by_size[norms[by_size] ** 2 > RANK * norms.max(initial=0.0) ** 2]
    axes = np.zeros((len(by_size), len(covariance)))
    axes[:, order] = (rotated[:, by_size] / norms[by_size]).T
    lead = axes[np.arange(len(axes)), np.argmax(np.abs(axes) > np.abs(axes).max(1, keepdims=True, initial=0) * (1 - 1e-9), axis=1)] if len(axes) else np.ones(0)
    return norms[by_size] ** 2, axes * np.where(lead < 0, -1.0, 1.0)[:, None]


def quantized(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> tuple[DataFrame, int]:
    """(id, x) of the rows that take part, x = floor(scale * entry) as longs, and the length of x (0 where no row takes part).

    Rows with a null or empty vector, with null or non-finite entries, or not of the usual length (the most frequent one, ties to
    the shorter) are left out, rows with a null id are not. Products beyond the longs become the nearest long.
    """
    sound = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & sound)

    def whole(c):
        # floor() of what lies beyond the longs would fail in a strict session
        inside = F.floor(c * scale).cast("long")
        return F.when(c * scale >= 2.0**63, F.lit(2**63 - 1)).when(c * scale < -(2.0**63), F.lit(-(2**63))).otherwise(inside)

    rows = rows.select("id", F.transform("v", whole).alias("x"))
    sizes = rows.groupBy(F.size("x").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").limit(1).collect()
    dim = sizes[0][0] if sizes else 0
    return rows.where(F.size("x") == dim), dim


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _exact_sums(distinct: DataFrame, dim: int) -> tuple[int, list[int]]:
    """The number of rows and the sum of each entry, as whole numbers of any size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * dim
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            for at in range(0, len(x), _BLOCK):
                high, low = x[at : at + _BLOCK] >> 32, x[at : at + _BLOCK] & 0xFFFFFFFF
                sums = [s + (int(a) << 32) + int(b) for s, a, b in zip(sums, high.sum(0), low.sum(0), strict=True)]
            n += len(x)
        if n:
            made = [pa.array(range(dim), pa.int32()), pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0)), pa.array([n] * dim, pa.int64())]
            yield pa.record_batch(made, ["pos", "total", "n"])

    found = distinct.mapInArrow(run, "pos int, total decimal(38,0), n long").groupBy("pos").agg(F.sum("total"), F.sum("n")).orderBy("pos").collect()
    return (found[0][2], [int(r[1]) for r in found]) if found else (0, [])


def _totals(distinct: DataFrame, dim: int, block, width: int) -> np.ndarray:
    """The sum over blocks of rows of block(rows), which gives width doubles.

    A task adds up its own rows, then tasks the sums of FAN others, until one is left: no task holds more than two sums at once,
    and their number does not grow with that of the tasks.
    """

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            for at in range(0, len(x), _BLOCK):
                yield block(x[at : at + _BLOCK].astype(float))

    def later(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield batch.column(0)[i].values.to_numpy()

    def adding(parts):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for part in parts(batches):
                total = part + 0.0 if total is None else total + part
            if total is not None:
                yield pa.record_batch([pa.array([total], pa.list_(pa.float64()))], ["totals"])

        return run

    left, found = distinct.rdd.getNumPartitions(), distinct.mapInArrow(adding(first), "totals array<double>")
    while left > 1:
        left = -(-left // FAN)
        found = found.repartition(left).mapInArrow(adding(later), "totals array<double>")
    rows = found.toArrow()["totals"]
    return rows[0].values.to_numpy() if len(rows) else np.zeros(width)


def fit(distinct: DataFrame, dim: int) -> Whitening | None:
    """The whitening of a frame of distinct vectors (x: array of dim longs), or None if it has no row."""
    n, sums = _exact_sums(distinct, dim)
    if not n:
        return None
    mean = np.array([float(s) / n for s in sums])
    upper = np.triu_indices(dim)

    def scatter(x: np.ndarray) -> np.ndarray:
        centred = x - mean
        return (centred.T @ centred)[upper]

    covariance = np.zeros((dim, dim))
    covariance[upper] = _totals(distinct, dim, scatter, len(upper[0])) / n
    covariance = covariance + np.triu(covariance, 1).T
    eigenvalues, components = principal_axes(covariance)
    return Whitening(n, sums, components, eigenvalues, float(np.trace(covariance)))


def identity_error(distinct: DataFrame, dim: int, model: Whitening, k: int) -> float:
    """The largest absolute entry of the covariance of the first k whitened columns minus the identity, over the distinct vectors."""
    if not k:
        return 0.0
    mean = _totals(distinct, dim, lambda x: model.whitened(x, k).sum(0), k) / model.n

    def products(x: np.ndarray) -> np.ndarray:
        centred = model.whitened(x, k) - mean
        return (centred.T @ centred).ravel()

    covariance = _totals(distinct, dim, products, k * k).reshape(k, k) / model.n
    return float(np.abs(covariance - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """For each row the exact sum over its entries of (n * entry - sum) squared."""
    dim, largest = x.shape[1], max(int(x.max(initial=0)), -int(x.min(initial=0)))
    bound = n * largest + max(map(abs, sums))
    if dim * bound * bound < 1 << 63:
        away = n * x - np.array(sums, np.int64)
        return (away * away).sum(1).tolist()
    if dim * largest * largest < 1 << 63 and (dim * largest) << 32 < 1 << 63 and max(map(abs, sums)) < 1 << 62:
        # n² Σx² - 2n Σxs + Σs², the sums s in two halves, so that every product of columns fits a long
        s = np.array(sums, np.int64)
        squares, high, low = (x * x).sum(1).tolist(), (x @ (s >> 32)).tolist(), (x @ (s & 0xFFFFFFFF)).tolist()
        rest = sum(v * v for v in sums)
        return [n * n * a - 2 * n * ((h << 32) + b) + rest for a, h, b in zip(squares, high, low, strict=True)]
    return [sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()]


def whiten(vectors: DataFrame, k: int = 4, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """One row for each row that takes part (see quantized()) and each of the first k components: id, component (from 1), n,
    deviation (decimal(38,0), NULL beyond 38 digits), whitened, eigenvalue, explained, identity_error.

    Means and covariances are those of the distinct vectors, each once: n of them. Fewer than k components come back where the
    vectors vary along fewer directions; vectors that are all alike have none, so no row comes back, nor for an empty table. Repeated
    rows stay repeated. Equal eigenvalues leave the choice of their components open; it is the same for all rows. Other columns
    are not read. The driver holds dim * dim doubles.
    """
    schema = "id long, component int, n long, deviation decimal(38,0), whitened double, eigenvalue double, explained double, identity_error double"
    session = vectors.sparkSession
    rows, dim = quantized(vectors, id_col, vector_col, scale)
    distinct = cut(rows.select("x").distinct()) if dim else None
    model = fit(distinct, dim) if dim else None
    k = min(k, len(model.eigenvalues)) if model else 0
    if not k:
        return session.createDataFrame([], schema)
    error = identity_error(distinct, dim, model, k)
    shared = session.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x, m = _matrix(batch.column(1), dim), batch.num_rows
            far = [Decimal(d) if d < 10**38 else None for d in deviations(x, model.n, model.sums)]
            again = np.repeat(np.arange(m), k)
            made = [
                batch.column(0).take(pa.array(again)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, model.n)),
                pa.array(far, pa.decimal128(38, 0)).take(pa.array(again)),
                pa.array(model.whitened(x.astype(float), k).ravel()),
                pa.array(np.tile(model.eigenvalues[:k], m)),
                pa.array(np.tile(model.eigenvalues[:k] / model.trace, m)),
                pa.array(np.full(m * k, error)),
            ]
            yield pa.record_batch(made, ["id", "component", "n", "deviation", "whitened", "eigenvalue", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
