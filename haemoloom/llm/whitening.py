"""Whitening of embeddings with refined eigenvectors.

Vectors are rounded to integers, so that sums and distances are exact. Each task
adds up the outer products of its centred vectors, and the tasks' sums make the
covariance. Its eigenvectors are found in single precision and corrected by
Ogita-Aishima iterations, which are matrix multiplications in higher precision;
where eigenvalues are too close for the correction, the covariance is solved again
inside the space of the cluster.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haemoloom.llm.common import lists, stored

COMPONENTS = 16

#: Steps of a unit, and what is added to a vector's entries after that.
STEPS = 64
SHIFT = 1_000_000

#: Greatest size of an entry in steps; above it doubles have no whole numbers.
MOST = 1 << 52

#: Iterations at most; three or four are enough, since each squares the error.
ITERATIONS = 20

#: What the corrections are computed in: more digits than doubles, where the machine has them.
PRECISE = np.longdouble

_LOW = (1 << 26) - 1


def _usable(vector: Column) -> Column:
    """Whether an array has entries, all of them finite numbers that whole steps can express."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) * STEPS >= float(MOST)))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True))


def rounded(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id`` and the integers ``x`` of the usable vectors, of the length that most of them have.

    Of lengths that equally many have, it is the largest.
    """
    doubles = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    vectors = rows.select(F.col(id_col).cast("long").alias("vec_id"), doubles.alias("vector")).filter(_usable(F.col("vector")))
    lengths = vectors.groupBy(F.size("vector").alias("length")).count()
    length = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    x = F.transform("vector", lambda c: F.floor(c * STEPS).cast("long") + SHIFT)
    return vectors.filter(F.size("vector") == (length["length"] if length else 0)).select("vec_id", x.alias("x"))


def _matrix(column: pa.ListArray, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """The number of vectors and the exact sum of each dimension."""

    def add(batches):
        # In two halves, so that sums of large entries fit as well.
        n, high, low = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), d)
            n, high, low = n + len(x), high + (x >> 26).sum(axis=0), low + (x & _LOW).sum(axis=0)
        columns = [pa.array(np.full(d, n)), pa.array(np.arange(d)), pa.array(high), pa.array(low)]
        yield pa.RecordBatch.from_arrays(columns, ["n", "place", "high", "low"])

    exact = "decimal(38,0)"
    parts = fit.select("x").mapInArrow(add, "n long, place long, high long, low long")
    sums = parts.groupBy("place").agg(F.sum("n").alias("n"), *[F.sum(F.col(c).cast(exact)).cast(exact).alias(c) for c in ("high", "low")])
    found = sorted(sums.collect())  # one row per dimension
    return found[0]["n"], [(int(r["high"]) << 26) + int(r["low"]) for r in found]


def _added(parts: DataFrame, d: int) -> np.ndarray:
    """The sum of rows (place, values) by place, as ``d`` rows of doubles."""
    spread = parts.select("place", F.posexplode("values").alias("column", "value"))
    sums = spread.groupBy("place", "column").agg(F.sum("value").alias("value")).collect()  # dimensions squared
    out = np.zeros((d, max((r["column"] for r in sums), default=-1) + 1))
    for r in sums:
        out[r["place"], r["column"]] = r["value"]
    return out


class _Centre:
    """The mean of the fitted vectors in whole numbers: ``S`` divided by ``n``."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S / n`` in doubles; the whole numbers are subtracted first, so nothing is lost."""
        return (x - self.whole) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum of the squares of ``n * x - S``; NULL where that is no long."""
        y = x - self.whole
        most = self.n * (int(np.abs(y).max(initial=0)) + 1)
        if x.shape[1] * most * most < 1 << 63:
            apart = self.n * y - self.rest
            return (apart * apart).sum(axis=1).tolist()
        found = [sum((self.n * a - b) ** 2 for a, b in zip(row, self.rest.tolist())) for row in y.tolist()]
        return [f if f < 1 << 63 else None for f in found]


def _gram(rows: DataFrame, values, d: int) -> np.ndarray:
    """The sum over all rows of the outer product of ``values`` (of a matrix of rows) with itself."""

    def add(batches):
        total = None
        for batch in batches:
            v = values(batch)
            total = v.T @ v if total is None else total + v.T @ v
        if total is not None:
            columns = [pa.array(np.arange(len(total))), lists(list(total), pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["place", "values"])

    return _added(rows.mapInArrow(add, "place long, values array<double>"), d)


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Places of eigenvalues that follow one another by no more than ``gap``, where there are several."""
    order = np.argsort(values)
    groups = np.split(order, np.flatnonzero(np.diff(values[order]) > gap) + 1)
    return [g for g in groups if len(g) > 1]


def refined_eigenvectors(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns, in double precision.

    From eigenvectors in single precision. With ``R = I - X'X`` and ``S = X'AX`` the
    correction of a pair of vectors is ``(S_ij + l_j R_ij) / (l_j - l_i)``; of a pair
    whose values are too close to be told apart it is ``R_ij / 2``, which only makes
    them orthogonal. Such a cluster is then solved by its own small matrix, taken
    about its mean value.
    """
    scale = float(np.abs(matrix).max(initial=0))
    if not scale:
        return np.zeros(len(matrix)), np.eye(len(matrix))
    plain = (matrix + matrix.T) / (2 * scale)
    x = np.linalg.eigh(plain.astype(np.float32))[1].astype(PRECISE)
    a, one = plain.astype(PRECISE), np.eye(len(plain), dtype=PRECISE)
    spread, last = np.linalg.norm(plain, 2), np.inf
    # Values that are closer than doubles can say are never told apart.
    least = len(plain) * np.finfo(float).eps * spread
    for _ in range(ITERATIONS):
        r, s = one - x.T @ x, x.T @ (a @ x)
        values = np.diag(s) / (1 - np.diag(r))
        near = max(least, 2 * (_norm(s - np.diag(values)) + spread * _norm(r)))
        apart = values[None, :] - values[:, None]
        told = np.abs(apart) > near
        new = x + x @ np.where(told, (s + values[None, :] * r) / np.where(told, apart, 1), r / 2)
        for group in _clusters(values, near):
            part = new[:, group]
            inner = part.T @ (a @ part - values[group].mean() * part)
            new[:, group] = part @ np.linalg.eigh(((inner + inner.T) / 2).astype(float))[1]
        new = new + new @ (one - new.T @ new) / 2
        # Vectors may still turn inside a cluster, so they are judged by how far they are from solving it.
        moved = a @ new
        left = float(np.abs(moved - new * (new * moved).sum(axis=0)).max() + np.abs(one - new.T @ new).max())
        if left >= last:
            break
        x, last = new, left
    values = (x * (a @ x)).sum(axis=0).astype(float)
    x = x.astype(float)
    order = np.argsort(-values, kind="stable")
    return values[order] * scale, (x / np.linalg.norm(x, axis=0))[:, order]


def _norm(matrix: np.ndarray) -> float:
    return float(np.linalg.norm(matrix.astype(float), 2))


def whitened_components(
    rows: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``vec_id``, ``component`` from 1, ``n``, ``deviation``, ``whitened``, ``explained`` and ``identity_error``.

    One row for each usable vector and each of its first ``components`` components.
    Left out are vectors that are NULL or empty, hold an entry that is NULL or not
    finite (or above ``MOST`` steps), or are of another length than most. The
    covariance is that of the distinct rounded vectors, ``n`` of them, so copies do
    not weigh; all rows are projected, repeated ones and NULL ids too. Components
    without variance have NULL ``whitened``; ``explained`` is NULL if no component
    has any. A ``deviation`` that is no long is NULL. ``identity_error`` is over the
    components with variance. Other columns are not looked at, and a table without
    usable vectors gives an empty result.

    The driver and each task hold matrices of the vectors' length squared.
    """
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    spark = rows.sparkSession
    x = stored(rounded(rows, id_col, vector_col), "whitening-rounded")
    first = x.first()
    if first is None:
        return spark.createDataFrame([], schema)
    d = len(first["x"])
    fit = stored(x.select("x").distinct(), "whitening-fit")
    centre = _Centre(*_sums(fit, d))
    n = centre.n
    covariance = _gram(fit, lambda batch: centre.centred(_matrix(batch.column(0), d)), d) / n
    values, vectors = refined_eigenvectors(covariance)
    k = min(components, d)
    trace = float(np.trace(covariance))
    varied = values[:k] > d * np.finfo(float).eps * max(values[0], 0)
    scaled = vectors[:, :k] / np.sqrt(np.where(varied, values[:k], 1))
    error = _identity_error(fit, centre, scaled[:, varied], d) if varied.any() else None
    explained = [float(v) / trace if trace else None for v in values[:k]]

    def project(batches):
        for batch in batches:
            held = _matrix(batch.column(1), d)
            z = centre.centred(held) @ scaled
            m = len(held)
            white = pa.array(z.ravel(), pa.float64(), mask=np.tile(~varied, m))
            columns = [
                batch.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n)),
                pa.array(centre.deviations(held), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                white,
                pa.array(explained * m, pa.float64()),
                pa.array([error] * (m * k), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return x.select("vec_id", "x").mapInArrow(project, schema)


def _identity_error(fit: DataFrame, centre: _Centre, scaled: np.ndarray, d: int) -> float:
    """The largest entry of the whitened vectors' covariance minus the identity, over the fitted vectors."""
    n, k = centre.n, scaled.shape[1]

    def whitened(batch):
        return centre.centred(_matrix(batch.column(0), d)) @ scaled

    def add(batches):
        total = np.zeros(k)
        for batch in batches:
            total += whitened(batch).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.zeros(1, np.int64)), lists([total], pa.float64())], ["place", "values"])

    mean = _added(fit.mapInArrow(add, "place long, values array<double>"), 1)[0] / n
    covariance = _gram(fit, lambda batch: whitened(batch) - mean, k) / n
    return float(np.abs(covariance - np.eye(k)).max())
