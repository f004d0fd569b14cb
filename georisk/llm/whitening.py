"""Whitening of embeddings along their leading principal components.

Entries become integers, so counts and sums of a column are exact and every
entry can be centred without rounding: n * x - S is an integer.  Two passes of
the tasks give the column sums and then the centred second moments, added up
by Spark cell by cell.  The driver holds only the covariance matrix, whose
size depends on the number of dimensions, and takes it apart:

* Householder reflections make it tridiagonal,
* bisection on Sturm counts finds the leading eigenvalues to the last digit,
* inverse iteration finds their vectors, made orthogonal again inside clusters
  of close eigenvalues, and the reflections carry them back.

Mean and components are broadcast (dimensions x components numbers) and every
vector is projected where it lies.  A last pass measures the covariance of the
projected values against the identity.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared

EPS = float(np.finfo(float).eps)
CLUSTER = 1e-3    # eigenvalues closer than this share of the norm are made orthogonal to each other
LARGEST = 2 ** 40  # of the integer entries: sums of a batch and n * x stay exact


@dataclass(frozen=True)
class Params:
    components: int = 8
    scale: int = 1024
    offset: int = 100_000


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
    """Diagonal, off-diagonal and the Householder vectors that reduce the symmetric matrix."""
    a, size, reflections = np.array(a, float), len(a), []
    for k in range(size - 2):
        x = a[k + 1:, k]
        length = np.linalg.norm(x)
        if not np.abs(x[1:]).any():
            reflections.append(None)
            continue
        v = x.copy()
        head = -np.copysign(length, x[0])
        v[0] -= head
        v /= np.linalg.norm(v)
        rest = a[k + 1:, k + 1:]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1, k], a[k + 2:, k] = head, 0.0
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def sturm_counts(d: np.ndarray, e: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For every number in ``at``: how many eigenvalues of the tridiagonal matrix are smaller."""
    tiny = np.finfo(float).tiny / EPS
    q = d[0] - at
    below = (q < 0).astype(np.int64)
    for i in range(1, len(d)):
        q = np.where(np.abs(q) < tiny, -tiny, q)
        q = d[i] - at - e[i - 1] * (e[i - 1] / q)
        below += q < 0
    return below


def leading_eigenvalues(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest, falling, by bisection until no double lies between the bounds."""
    beside = np.abs(np.concatenate([[0.0], e])) + np.abs(np.concatenate([e, [0.0]]))
    span = max(np.abs(d).max() + beside.max(), np.finfo(float).tiny / EPS)
    rank = len(d) - 1 - np.arange(k)   # as many eigenvalues lie below
    low = np.full(k, (d - beside).min() - 2 * EPS * span)
    high = np.full(k, (d + beside).max() + 2 * EPS * span)
    while True:
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            return high
        above = sturm_counts(d, e, middle) <= rank   # the eigenvalue is not below the middle
        low, high = np.where(above, middle, low), np.where(above, high, middle)


def _solve(d: np.ndarray, e: np.ndarray, shift: float, b: np.ndarray, least: float) -> np.ndarray:
    """(T - shift) y = b by elimination with row exchanges; pivots are at least ``least``."""
    n = len(d)
    main, up, up2, y = d - shift, np.append(e, 0.0), np.zeros(n), b.copy()
    for i in range(n - 1):
        sub = e[i]
        if abs(sub) > abs(main[i]):  # exchange rows i and i + 1
            factor = main[i] / sub
            main[i], up[i], up2[i], main[i + 1], up[i + 1] = (
                sub, main[i + 1], up[i + 1], up[i] - factor * main[i + 1], -factor * up[i + 1])
            y[i], y[i + 1] = y[i + 1], y[i] - factor * y[i + 1]
        else:
            if abs(main[i]) < least:
                main[i] = least
            factor = sub / main[i]
            main[i + 1] -= factor * up[i]
            y[i + 1] -= factor * y[i]
    if abs(main[-1]) < least:
        main[-1] = least
    for i in range(n - 1, -1, -1):
        if i + 1 < n:
            y[i] -= up[i] * y[i + 1]
        if i + 2 < n:
            y[i] -= up2[i] * y[i + 2]
        y[i] /= main[i]
    return y


def tridiagonal_vectors(d: np.ndarray, e: np.ndarray, values: np.ndarray, rounds: int = 5) -> np.ndarray:
    """Unit vectors of the falling ``values``, by inverse iteration; column i belongs to value i."""
    norm = max(np.abs(d).max() + 2 * np.abs(e).max(initial=0.0), np.finfo(float).tiny / EPS)
    draw = np.random.default_rng(len(d))
    out, cluster, shift = np.zeros((len(d), len(values))), 0, np.inf
    for i, value in enumerate(values):
        if i and values[i - 1] - value > CLUSTER * norm:
            cluster = i
        shift = min(value, shift - EPS * norm) if i > cluster else value  # equal values are told apart
        y = draw.standard_normal(len(d))
        for _ in range(rounds):
            near = out[:, cluster:i]
            for _ in range(2):
                y -= near @ (near.T @ y)
            y = _solve(d, e, shift, y / np.linalg.norm(y), EPS * norm)
        for _ in range(2):
            y -= near @ (near.T @ y)
        out[:, i] = y / np.linalg.norm(y)
    return out


def leading_components(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of the symmetric matrix ``v``."""
    size = np.abs(v).max()
    if len(v) == 1 or size == 0:
        return np.diag(v)[:k].astype(float), np.eye(len(v))[:, :k]
    d, e, reflections = tridiagonal(v / size)
    values = leading_eigenvalues(d, e, k)
    vectors = tridiagonal_vectors(d, e, values)
    for at in range(len(reflections) - 1, -1, -1):
        if (r := reflections[at]) is not None:
            vectors[at + 1:] -= 2 * np.outer(r, r @ vectors[at + 1:])
    return values * size, vectors / np.linalg.norm(vectors, axis=0)


def _integers(b: pa.RecordBatch, dims: int, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of the batch hold finite numbers only, and their integer entries."""
    flat = b.column("vector").flatten()
    c = flat.to_numpy(zero_copy_only=False).astype(float).reshape(-1, dims)  # null entries are NaN
    good = np.isfinite(c).all(axis=1)
    x = np.floor(c[good] * p.scale) + p.offset
    if len(x) and np.abs(x).max() > LARGEST:
        raise ValueError(f"an entry times {p.scale} lies beyond 2^40")
    return good, x.astype(np.int64)


@dataclass
class Fit:
    """What the tasks need: exact count and sums, components with their eigenvalues."""
    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    total: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact; as Python integers where it could leave 64 bits."""
        if self.n < 2 ** 63 // LARGEST // 2:
            return self.n * x - self.sums.astype(np.int64)
        return self.n * x.astype(object) - self.sums

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened values; NaN along components without variance."""
        scaled = self.vectors / np.sqrt(np.where(self.values > 0, self.values, np.nan))
        return (self.centred(x).astype(float) / self.n) @ scaled

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of squares of n * x - S, exact; None where it is no long."""
        y = self.centred(x)
        if not len(y) or y.shape[1] * float(np.abs(y).max()) ** 2 < 2.0 ** 62:
            return (y * y).sum(axis=1).tolist()
        whole = (y.astype(object) ** 2).sum(axis=1)
        return [v if v < 2 ** 63 else None for v in whole]


def _sums_task(dims: int, p: Params):
    schema = pa.schema([("i", pa.int32()), ("value", pa.decimal128(38, 0))])

    def run(batches):
        n, sums = 0, [0] * dims
        for b in batches:
            _, x = _integers(b, dims, p)
            n += len(x)
            sums = [a + s for a, s in zip(sums, x.sum(axis=0).tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, dims), pa.int32()), pa.array([n, *sums], schema[1].type)],
                                         schema=schema)

    return run


def _moments_task(dims: int, p: Params, sent: Shared, rows_of):
    """Sums of products of the columns that ``rows_of`` makes of a batch, upper triangle."""
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("value", pa.float64())])

    def run(batches):
        fit, total = sent.value, None
        for b in batches:
            y = rows_of(fit, _integers(b, dims, p)[1])
            total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])],
                                             schema=schema)

    return run


def _matrix(vectors: DataFrame, dims: int, size: int, p: Params, fit: Fit, rows_of) -> np.ndarray:
    sent = Shared(vectors.sparkSession, fit)
    cells = (vectors.mapInArrow(_moments_task(dims, p, sent, rows_of), "i int, j int, value double")
             .groupBy("i", "j").agg(F.sum("value").alias("value")).collect())  # size * (size + 1) / 2 rows
    out = np.zeros((size, size))
    for i, j, value in cells:
        out[i, j] = out[j, i] = value
    return out / fit.n


def fit_vectors(vectors: DataFrame, dims: int, p: Params) -> Fit | None:
    """Two passes over ``vector``: exact sums, then centred second moments; None without a finite row."""
    cells = dict(vectors.mapInArrow(_sums_task(dims, p), "i int, value decimal(38,0)")
                 .groupBy("i").agg(F.sum("value").cast("decimal(38,0)").alias("value")).collect())
    n = int(cells.get(-1) or 0)
    if not n:
        return None
    sums = np.array([int(cells[i]) for i in range(dims)], object)
    k = min(p.components, dims)
    fit = Fit(n, sums, np.zeros(k), np.zeros((dims, k)), 0.0)
    cov = _matrix(vectors, dims, dims, p, fit, lambda f, x: f.centred(x).astype(float) / f.n)
    values, comps = leading_components(cov, k)
    total = float(np.trace(cov))
    values = np.where(values > dims * EPS * max(total, 0.0), values, 0.0)  # what is left of rounding is no variance
    return Fit(n, sums, values, comps, total)


def _project_task(dims: int, p: Params, sent: Shared, error: float | None, id_type: pa.DataType):
    schema = pa.schema([("vec_id", id_type), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                        ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])

    def run(batches):
        fit = sent.value
        k = len(fit.values)
        share = fit.values / fit.total if fit.total > 0 else np.full(k, np.nan)
        for b in batches:
            good, x = _integers(b, dims, p)
            m = len(x)
            if not m:
                continue
            ids = b.column("vec_id").filter(pa.array(good)).take(pa.array(np.repeat(np.arange(m), k)))
            deviation = np.repeat(np.array(fit.deviation(x), object), k).tolist()
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array([fit.n] * (m * k), pa.int64()),
                 pa.array(deviation, pa.int64()), pa.array(fit.project(x).ravel(), from_pandas=True),
                 pa.array(np.tile(share, m), from_pandas=True), pa.array([error] * (m * k), pa.float64())],
                schema=schema)

    return run


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           p: Params = Params()) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``: a row per vector and component.

    Other columns are left out.  Rows whose vector is null, empty or holds a
    null or non-finite entry give no row; neither do vectors of another length
    than the most frequent one (ties: the longer), which lack entries.
    Repeated rows and null ids count and give rows like others.  An empty table gives
    an empty result, vectors of fewer than eight dimensions as many components
    as dimensions.  Along a component without variance ``whitened`` is null;
    ``explained`` is null if nothing varies.  ``deviation`` is null where the
    exact number is no long.  An entry beyond 2^30 raises an error.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vector_col).cast("array<double>").alias("vector"))
    result = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    lengths = (rows.filter(F.size("vector") > 0).groupBy(F.size("vector").alias("d")).count()
               .orderBy(F.desc("count"), F.desc("d")).limit(1).collect())
    if not lengths:
        return spark.createDataFrame([], result)
    dims = lengths[0]["d"]
    rows = rows.filter(F.size("vector") == dims)
    fit = fit_vectors(rows, dims, p)
    if fit is None:
        return spark.createDataFrame([], result)
    some = fit.values > 0
    error = None
    if some.any():
        k = len(fit.values)
        found = _matrix(rows, dims, k, p, fit, lambda f, x: np.nan_to_num(f.project(x)))
        error = float(np.abs(found - np.eye(k))[np.ix_(some, some)].max())
    return rows.mapInArrow(_project_task(dims, p, Shared(spark, fit), error, pa.int64()), result)
