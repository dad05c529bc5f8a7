"""Embedding whitening: leading principal components by a block Jacobi-Davidson iteration.

The covariance is never formed. Spark multiplies it with a block of vectors in one pass over the
fit list (``x`` centred exactly in integers, then multiplied); the driver holds only vectors of
the embedding's dimension, a few dozen of them.

* Rayleigh-Ritz in a subspace gives the wanted pairs and their residuals.
* A pair whose residual has reached double precision is locked: it leaves the search, and
  what is left stays orthogonal to it.
* For every other wanted pair the correction equation, projected against the locked vectors and
  the pair's own, is solved roughly by MINRES. The pairs' MINRES runs go in step, so that one pass
  over the data serves them all. The corrections extend the subspace.
* A full subspace is restarted from its best Ritz vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import materialise

# --- fixed values: the contract's integer grid ---
SCALE, OFFSET = 64, 1_000_000
# --- end of fixed values ---
COMPONENTS = 16
#: MINRES steps for a correction; each is a pass over the data.
INNER = 6
#: Passes after which an iteration that does not settle raises.
MAX_OUTER = 200
#: Tasks that add up the other tasks' sums.
FOLDS = 4
SEED = 17

Product = Callable[[np.ndarray], np.ndarray]


# ------------------------------------------------------------------ Jacobi-Davidson


def _orthonormal(block: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """Orthonormal columns for what ``block`` adds to the given orthonormal columns."""
    keep = [a for a in against if a.size]
    for _ in range(2):
        for a in keep:
            block = block - a @ (a.T @ block)
        norms = np.linalg.norm(block, axis=0)
        block = block[:, norms > 0] / norms[norms > 0]
    out = np.zeros((len(block), 0))
    for col in block.T:
        for _ in range(2):
            col = col - out @ (out.T @ col)
            for a in keep:
                col = col - a @ (a.T @ col)
            size = np.linalg.norm(col)
            if size < 1e-8:  # nothing new in it
                break
            col = col / size
        else:
            out = np.column_stack([out, col])
    return out


def minres(product: Product, shifts: np.ndarray, project: Product, rhs: np.ndarray, steps: int) -> np.ndarray:
    """MINRES for ``project (A - shift_i) project t_i = rhs_i``, all columns in step: each step
    asks ``product`` once for the whole block. Stops early when every column has nothing left."""
    d, k = rhs.shape
    x, v_old, v = np.zeros((d, k)), np.zeros((d, k)), project(rhs)
    beta = np.linalg.norm(v, axis=0)
    scale = beta.copy()
    eta = beta.copy()
    v = v / np.where(beta > 0, beta, 1)
    w_old, w = np.zeros((d, k)), np.zeros((d, k))
    c_old, c, s_old, s = np.ones(k), np.ones(k), np.zeros(k), np.zeros(k)
    beta = np.zeros(k)
    live = scale > 0
    for _ in range(steps):
        if not live.any():
            break
        av = project(product(v) - v * shifts)
        alpha = (v * av).sum(axis=0)
        av = av - v * alpha - v_old * beta
        av = project(av)
        beta_new = np.linalg.norm(av, axis=0)
        # the two last rotations on the new column of the tridiagonal matrix, then its own
        delta = c * alpha - c_old * s * beta
        rho1 = np.hypot(delta, beta_new)
        rho2 = s * alpha + c_old * c * beta
        rho3 = s_old * beta
        safe = np.where(rho1 > 0, rho1, 1)
        c_new, s_new = np.where(rho1 > 0, delta / safe, 1.0), np.where(rho1 > 0, beta_new / safe, 0.0)
        w_new = (v - w_old * rho3 - w * rho2) / safe
        x = x + np.where(live & (rho1 > 0), c_new * eta, 0.0) * w_new
        eta = -s_new * eta
        live = live & (rho1 > 0) & (beta_new > 1e-14 * scale)
        v_old, v = v, av / np.where(beta_new > 0, beta_new, 1)
        w_old, w = w, w_new
        c_old, c, s_old, s, beta = c, c_new, s, s_new, beta_new
    return x


def jacobi_davidson(product: Product, d: int, wanted: int, inner: int = INNER) -> tuple[np.ndarray, np.ndarray]:
    """(values falling, unit vectors as columns) of the ``wanted`` largest eigenpairs of the
    symmetric positive semidefinite operator ``product`` of dimension ``d``.

    Every returned pair's residual norm is at most ``4 d`` units of rounding of the largest
    value. The start is a seeded random block, so runs over equal products agree.
    """
    wanted = min(wanted, d)
    if not wanted:
        return np.zeros(0), np.zeros((d, 0))
    guard = min(d, wanted + wanted // 2 + 2)
    most = max(guard + wanted, 3 * wanted)
    locked, values = np.zeros((d, 0)), np.zeros(0)
    basis = _orthonormal(np.random.default_rng(SEED).standard_normal((d, guard)))
    image = product(basis)
    for _ in range(MAX_OUTER):
        small = basis.T @ image
        theta, y = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-theta)
        theta, y = theta[order], y[:, order]
        ritz, r_image = basis @ y, image @ y
        left = min(wanted - len(values), len(theta))
        resid = r_image[:, :left] - ritz[:, :left] * theta[:left]
        resid = resid - locked @ (locked.T @ resid)
        top = max([theta[0] if len(theta) else 0.0, *values[:1]])
        done = np.linalg.norm(resid, axis=0) <= 4 * d * np.finfo(float).eps * top
        # only the leading ones are locked: a pair may yet be overtaken by one not seen so far
        n_done = int(np.argmin(done)) if not done.all() else left
        if n_done:
            locked = np.column_stack([locked, ritz[:, :n_done]])
            values = np.append(values, theta[:n_done])
            ritz, r_image, theta, resid = ritz[:, n_done:], r_image[:, n_done:], theta[n_done:], resid[:, n_done:]
        if len(values) >= wanted or len(locked.T) == d:
            break
        basis, image = ritz, r_image
        if basis.shape[1] + resid.shape[1] > most - len(values):
            basis, image = basis[:, : max(guard - len(values), 1)], image[:, : max(guard - len(values), 1)]
        near, shift = ritz[:, : resid.shape[1]], theta[: resid.shape[1]]

        def project(b: np.ndarray, own: np.ndarray = near) -> np.ndarray:
            b = b - locked @ (locked.T @ b)
            return b - own * (own * b).sum(axis=0)

        more = minres(product, shift, project, -resid, inner)
        more = _orthonormal(more, locked, basis)
        if not more.shape[1]:
            more = _orthonormal(np.random.default_rng(len(values) + 1).standard_normal((d, 1)), locked, basis)
            if not more.shape[1]:  # the subspace is the whole space: its Ritz pairs are all there is
                left = wanted - len(values)
                locked, values = np.column_stack([locked, basis[:, :left]]), np.append(values, theta[:left])
                break
        basis, image = np.column_stack([basis, more]), np.column_stack([image, product(more)])
    else:
        raise RuntimeError(f"the residuals did not reach double precision in {MAX_OUTER} iterations")
    order = np.argsort(-values, kind="stable")
    return values[order], locked[:, order]


# ------------------------------------------------------------------ distributed products


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def _summed(rows: DataFrame, d: int, shape: tuple[int, ...], kind: type, kernel: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all vectors of ``kernel(block of vectors)``: one array a task, which FOLDS tasks
    add up (an array at a time), and the driver the FOLDS sums."""

    def summed(arrays: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        total = None
        for part in arrays:
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.astype(kind).tobytes()], pa.binary())], ["part"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return summed(kernel(_matrix(b.column(0), d)) for b in batches if b.num_rows)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return summed(np.frombuffer(raw, kind) for b in batches for raw in b.column(0).to_pylist())

    parts = rows.mapInArrow(each, "part binary").repartition(FOLDS).mapInArrow(fold, "part binary")
    return sum((np.frombuffer(r[0], kind) for r in parts.collect()), np.zeros(shape, kind).reshape(-1)).reshape(shape)


class Fit:
    """Integer vectors once each, with what whitening needs to know about them."""

    def __init__(self, grid: DataFrame, components: int = COMPONENTS):
        self.rows = materialise(grid.select("x").distinct(), "whitening-fit")
        sizes = self.rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy("d").limit(2).collect()
        if len(sizes) > 1:
            raise ValueError(f"embeddings of unequal length: {sizes[0]['d']}, {sizes[1]['d']} entries")
        self.d, self.n = (sizes[0]["d"], sizes[0]["n"]) if sizes else (0, 0)
        self.sums = np.zeros(self.d, np.int64)
        self.values, self.vectors, self.trace, self.identity_error = np.zeros(0), np.zeros((self.d, 0)), 0.0, 0.0
        if not self.d:
            return
        self.sums = _summed(self.rows, self.d, (self.d,), np.int64, lambda x: x.sum(axis=0))
        if self.n * (abs(int(self.sums.max())) + OFFSET) >= 1 << 63:
            raise ValueError("n * x does not fit a long")
        n, centred = self.n, self.centred()
        self.trace = float(_summed(self.rows, self.d, (1,), float, lambda x: (centred(x) ** 2).sum().reshape(1))[0]) / n
        if self.trace == 0:
            return
        values, vectors = jacobi_davidson(self.product, self.d, components)
        real = values > self.d * np.finfo(float).eps * self.trace  # a direction without spread has no scale
        self.values, self.vectors = values[real], vectors[:, real]
        k, to = len(self.values), self.vectors / np.sqrt(self.values)
        cov = _summed(self.rows, self.d, (k, k), float, lambda x: (centred(x) @ to).T @ (centred(x) @ to)) / n
        self.identity_error = float(np.abs(cov - np.eye(k)).max())

    def centred(self) -> Callable[[np.ndarray], np.ndarray]:
        n, sums = self.n, self.sums
        return lambda x: (n * x - sums) / n  # the difference is exact, so nothing cancels

    def product(self, block: np.ndarray) -> np.ndarray:
        """Covariance times ``block``, in one pass."""
        centred = self.centred()

        def kernel(x: np.ndarray) -> np.ndarray:
            c = centred(x)
            return c.T @ (c @ block)

        return _summed(self.rows, self.d, block.shape, float, kernel) / self.n


def grid(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x): the rows that count, entries on the integer grid."""
    entry = F.col("embedding")
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    rows = embeddings.select("vec_id", entry.cast("array<double>").alias("embedding")).where(
        entry.isNotNull() & F.forall("embedding", finite)
    )
    x = F.transform("embedding", lambda c: F.floor(c * SCALE).cast("long") + F.lit(OFFSET).cast("long"))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``: one row per row
    of ``embeddings(vec_id, embedding, ...)`` that counts and per component, from 1.

    Rows whose vector is null or holds a null or non-finite entry are left out; a null or repeated
    vec_id is kept, with rows of its own. Equal grid vectors are fitted once. There are as many
    components as asked for, the vectors have entries, or have directions with any spread, whichever
    is least: equal vectors only, empty vectors and an empty table give no row. Vectors of unequal
    length, and deviations beyond a long, raise an error. Extra columns are ignored.
    """
    rows = materialise(grid(embeddings), "whitening-grid")
    fit = Fit(rows, components)
    n, d, k, sums = fit.n, fit.d, len(fit.values), fit.sums
    to = fit.vectors / np.sqrt(fit.values) if k else fit.vectors
    explained, error = fit.values / fit.trace if k else fit.values, fit.identity_error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not k or not b.num_rows:
                continue
            off = n * _matrix(b.column(1), d) - sums
            if (np.abs(off).astype(float) ** 2).sum(axis=1).max() >= 2.0**63:
                raise OverflowError("a deviation does not fit a long")
            m = b.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n)),
                    pa.array(np.repeat((off * off).sum(axis=1), k)),
                    pa.array(((off / n) @ to).reshape(-1)),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(
        run, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
