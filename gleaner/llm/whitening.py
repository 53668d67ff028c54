"""Whitening of vectors: distributed covariance, own symmetric eigensolver, broadcast projection."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import finite_vector, saved

COMPONENTS = 16
ROWS = 4096
EPS = float(np.finfo(float).eps)
LONG = 1 << 63


def integer_rows(df: DataFrame, id_column: str, vector: str, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """``id`` and ``x``, ``floor(scale * c) + shift`` of each component c as a double, for rows with a finite vector.

    A null id stays; rows without a vector, or with a null or a non-finite component, go.
    """
    c = F.col(vector).cast("array<double>")
    x = F.transform(c, lambda e: (F.floor(e * scale) + shift).cast("long"))
    return df.select(F.col(id_column).cast("long").alias("id"), F.when(finite_vector(c), x).alias("x")).dropna(subset=["x"])


@dataclass(frozen=True)
class Fit:
    """What is broadcast to project: all of it is of the size of the vectors' dimension."""

    n: int
    sums: list[int]
    components: np.ndarray  # one row a component
    values: np.ndarray
    trace: float
    identity_error: float

    @property
    def dim(self) -> int:
        return len(self.sums)

    def centre(self, x: np.ndarray) -> np.ndarray:
        """x - S / n: the whole part is taken off exactly, the rest in floating point."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - whole).astype(np.float64) - rest

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centre(x) @ self.components.T / np.sqrt(self.values)


def _matrices(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            piece = batch.slice(start, ROWS)
            piece = piece.filter(pc.equal(pc.list_value_length(piece.column("x")), dim))
            if piece.num_rows:
                flat = pc.list_flatten(piece.column("x")).to_numpy(zero_copy_only=False).astype(np.int64)
                yield piece, flat.reshape(piece.num_rows, dim)


def common_length(rows: DataFrame) -> int:
    """The commonest vector length, the greater of equally common ones; 0 without rows."""
    counts = rows.groupBy(F.size("x").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    best = counts.agg(F.max_by("dim", F.struct("n", "dim")).alias("dim")).first()
    return best["dim"] or 0


def _sums(distinct: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Number of rows and exact sums by dimension; the two halves of a component are summed apart."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, x in _matrices(batches, dim):
            halves = [(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)]
            columns = [np.arange(dim), *halves, np.full(dim, len(x))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["i", "high", "low", "n"])

    wide = "decimal(38,0)"
    parts = distinct.mapInArrow(part, "i long, high long, low long, n long").groupBy("i")
    found = parts.agg(*[F.sum(F.col(c).cast(wide)).alias(c) for c in ("high", "low", "n")]).orderBy("i").collect()
    return (int(found[0]["n"]) if found else 0), [(int(r["high"]) << 32) + int(r["low"]) for r in found]


def _added(parts: DataFrame, dim: int) -> np.ndarray:
    """Sum of square matrices given by rows (i, row), summed apart for each i; in rising order, so that reruns agree."""

    def total(table: pa.Table) -> pa.Table:
        rows = np.array(table.column("row").to_pylist(), float).reshape(table.num_rows, dim)
        return pa.table({"i": table.column("i").slice(0, 1), "row": [np.sort(rows, axis=0).sum(axis=0).tolist()]})

    out = np.zeros((dim, dim))
    for row in parts.groupBy("i").applyInArrow(total, "i long, row array<double>").collect():
        out[row["i"]] = row["row"]
    return out


def _rows_of(matrix: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(matrix))), pa.array(list(matrix))], ["i", "row"])


def covariance(distinct: DataFrame, centred: Fit) -> np.ndarray:
    """Covariance over the rows of ``distinct``, divisor n; each row is centred before it is multiplied."""
    dim = centred.dim

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for _, x in _matrices(batches, dim):
            y = centred.centre(x)
            total += y.T @ y
        yield _rows_of(total)

    both = _added(distinct.mapInArrow(part, "i long, row array<double>"), dim) / centred.n
    return (both + both.T) / 2


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Householder reduction of a symmetric matrix: diagonal, subdiagonal and the unit reflectors, in order."""
    a, n = matrix.astype(float).copy(), len(matrix)
    reflectors = []
    for k in range(n - 2):
        column = a[k + 1 :, k]
        length = np.sqrt((column / (np.abs(column).max() or 1)) ** 2 @ np.ones(len(column))) * np.abs(column).max()
        v = column.copy()
        v[0] += length if v[0] >= 0 else -length
        size = np.sqrt(v @ v)
        v = v / size if size > 0 else np.zeros_like(v)
        reflectors.append(v)
        block = a[k + 1 :, k + 1 :]
        p = block @ v
        w = p - (v @ p) * v
        block -= 2 * (np.outer(v, w) + np.outer(w, v))
        rest = column - 2 * v * (v @ column)
        a[k + 1 :, k], a[k, k + 1 :] = rest, rest
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def count_below(diagonal: np.ndarray, off: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Sturm count: how many eigenvalues of the tridiagonal matrix are less than each of the points."""
    tiny = np.finfo(float).tiny + EPS * EPS * float(np.abs(off).max(initial=0)) ** 2
    q, below = np.ones(len(points)), np.zeros(len(points), int)
    for d, e in zip(diagonal, np.append(0.0, off)):
        q = d - points - e * e / q
        q = np.where(np.abs(q) < tiny, -tiny, q)
        below += q < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` greatest eigenvalues, falling, each halved down to neighbouring floating-point numbers."""
    n = len(diagonal)
    reach = np.abs(np.concatenate([[0], off])) + np.abs(np.concatenate([off, [0]]))
    low = np.full(min(most, n), (diagonal - reach).min())
    high = np.full(min(most, n), (diagonal + reach).max())
    slack = EPS * max(abs(low[0]), abs(high[0])) + np.finfo(float).tiny
    low, high = low - slack, high + slack
    wanted = n - 1 - np.arange(len(low))  # eigenvalues below the one sought
    while True:
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            return middle
        under = count_below(diagonal, off, middle) <= wanted
        low, high = np.where(under, middle, low), np.where(under, high, middle)


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray, tiny: float) -> np.ndarray:
    """x with (T - shift) x = b, by elimination with row exchanges in the band."""
    n = len(diagonal)
    d, up, far = diagonal - shift, np.append(off, 0.0), np.zeros(n)
    x, low = b.copy(), np.append(off, 0.0)
    for i in range(n - 1):
        if abs(low[i]) > abs(d[i]):
            below = (low[i], d[i + 1], up[i + 1])
            factor = d[i] / low[i]
            d[i + 1], up[i + 1] = up[i] - factor * below[1], far[i] - factor * below[2]
            d[i], up[i], far[i] = below
            x[i], x[i + 1] = x[i + 1], x[i] - factor * x[i + 1]
        else:
            factor = low[i] / d[i] if d[i] else 0.0
            d[i + 1] -= factor * up[i]
            up[i + 1] -= factor * far[i]
            x[i + 1] -= factor * x[i]
    for i in range(n - 1, -1, -1):
        right = x[i] - (up[i] * x[i + 1] if i + 1 < n else 0) - (far[i] * x[i + 2] if i + 2 < n else 0)
        x[i] = right / (d[i] if abs(d[i]) > tiny else tiny)
    return x


def tridiagonal_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors by inverse iteration, one row a value; inside a cluster of values each is made orthogonal
    to those before it."""
    n = len(diagonal)
    norm = max(float(np.abs(diagonal).max(initial=0)), float(np.abs(off).max(initial=0))) or 1.0
    random = np.random.default_rng(0)
    vectors: list[np.ndarray] = []
    cluster = 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * norm:
            cluster = k
        # values that bisection cannot tell apart still get shifts of their own
        shift = value - 4 * EPS * norm * (k - cluster)
        x = random.standard_normal(n)
        for _ in range(6):
            for other in vectors[cluster:] * 2:
                x = x - (other @ x) * other
            x = x / np.sqrt(x @ x)
            x = _solve(diagonal, off, shift, x, EPS * norm)
            x = x / np.abs(x).max()
        for other in vectors[cluster:] * 2:
            x = x - (other @ x) * other
        vectors.append(x / np.sqrt(x @ x))
    return np.array(vectors).reshape(len(values), n)


def leading_components(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors, one row each.

    The largest entry of a vector is positive.
    """
    scale = float(np.abs(matrix).max(initial=0)) or 1.0
    diagonal, off, reflectors = tridiagonal(matrix / scale)
    values = leading_values(diagonal, off, most)
    vectors = tridiagonal_vectors(diagonal, off, values)
    for k in range(len(reflectors) - 1, -1, -1):
        v = reflectors[k]
        vectors[:, k + 1 :] -= 2 * np.outer(vectors[:, k + 1 :] @ v, v)
    peak = vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)]
    return values * scale, vectors * np.where(peak < 0, -1, 1)[:, None]


def fit(rows: DataFrame, most: int = COMPONENTS) -> Fit | None:
    """Means, leading components and eigenvalues over the distinct vectors of ``rows``; None without any.

    Vectors of another length than the commonest take no part.  Components whose eigenvalue is nothing but rounding
    (under 1e-12 of the greatest) cannot be scaled to one and are left out: fewer than ``most`` come out.

    Equal vectors are reduced in the task before they are shuffled.  Three passes over the stored distinct vectors
    give exact sums, the centred covariance and a check of the whitened one; a task sends one matrix.  The matrix of
    the vectors' dimension is solved on the driver, and all that is broadcast is of its size.
    """
    dim = common_length(rows)
    if not dim:
        return None
    distinct = saved(rows.where(F.size("x") == dim).select("x").distinct())
    n, sums = _sums(distinct, dim)
    blank = Fit(n, sums, np.zeros((0, dim)), np.zeros(0), 0.0, 0.0)
    matrix = covariance(distinct, blank)
    values, vectors = leading_components(matrix, most)
    real = values > 1e-12 * max(values[0], 0)
    found = Fit(n, sums, vectors[real], values[real], float(np.trace(matrix)), 0.0)
    return Fit(n, sums, found.components, found.values, found.trace, identity_error(distinct, found))


def identity_error(distinct: DataFrame, model: Fit) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity."""
    k = len(model.values)
    if not k:
        return 0.0

    def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1, k))
        for _, x in _matrices(batches, model.dim):
            total += model.whiten(x).sum(axis=0)
        yield _rows_of(total)

    parts = distinct.mapInArrow(means, "i long, row array<double>").collect()
    mean = np.sort(np.array([r["row"] for r in parts]), axis=0).sum(axis=0) / model.n

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for _, x in _matrices(batches, model.dim):
            z = model.whiten(x) - mean
            total += z.T @ z
        yield _rows_of(total)

    both = _added(distinct.mapInArrow(squares, "i long, row array<double>"), k) / model.n
    return float(np.abs(both - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Exact sum over dimensions of (n * x - S) squared for every row."""
    whole = np.array([s // n for s in sums], np.int64)
    top = n * (int(np.abs(x - whole).max(initial=0)) + 1)
    if top * top * max(len(sums), 1) < LONG:
        rest = np.array([s % n for s in sums], np.int64)
        return ((n * (x - whole) - rest) ** 2).sum(axis=1).tolist()
    exact = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(axis=1).tolist()
    if exact and max(exact) >= LONG:
        raise ValueError("a deviation leaves 64 bits")
    return exact


def whiten(rows: DataFrame, model: Fit | None) -> DataFrame:
    """One row for each row of ``rows`` and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    ``rows`` has id and x.  Rows that repeat, with or without an id, all come out; vectors of another length than the
    fitted ones do not.  Without a fit, or where all vectors are equal, there are no rows.  A deviation of more than
    64 bits is an error.
    """
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], schema)
    k = len(model.values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, x in _matrices(batches, model.dim):
            m = len(x)
            ids = piece.column("id").take(pa.array(np.repeat(np.arange(m), k)))
            spread = np.repeat(np.array(deviations(x, model.n, model.sums), np.int64), k)
            columns = [
                ids,
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, model.n)),
                pa.array(spread),
                pa.array(model.whiten(x).ravel()),
                pa.array(np.tile(model.values / model.trace, m)),
                pa.array(np.full(m * k, model.identity_error)),
            ]
            names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.select("id", "x").mapInArrow(project, schema)
