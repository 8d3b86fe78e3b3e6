"""Whitening of embeddings along the leading principal components, found by a
block Jacobi-Davidson method.

The covariance is never formed: every product with it is a pass over the
distributed centred rows, X'(X u), for a few vectors u at once. Corrections of
the Ritz vectors come from the projected equations
(I - QQ')(V - theta I)(I - QQ') t = -r, solved by MINRES (in lock step for all
wanted pairs, so one pass serves them all); Rayleigh-Ritz over the subspace
follows, and converged pairs are locked in falling order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flurry.session import staged_table

COMPONENTS = 4
SCALE = 256
BLOCK_BYTES = 4 << 20   # of a block of rows, as doubles
INNER = 6               # MINRES steps of a correction
INNER_TOL = 1e-3
OUTER = 200
BASIS = 32              # vectors of the subspace before it is collapsed


def quantised(rows: DataFrame, vec: str, scale: int = SCALE) -> DataFrame:
    """``rows`` with ``x``: floor(scale * c) as long per entry c. Rows whose vector is null or holds
    null or non-finite entries go."""
    x = F.transform(vec, lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.filter(F.col(vec).isNotNull() & ~F.coalesce(bad, F.lit(False))).withColumn(
        "x", F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("long")))


def stacked(col: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as an int64 matrix, short ones filled with zeros."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat, off = col.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.append(0, np.cumsum(col.value_lengths().to_numpy(zero_copy_only=False)))
    if len(col) and (np.diff(off) == dim).all():
        return flat.reshape(len(col), dim)
    out = np.zeros((len(col), dim), np.int64)
    at = np.repeat(np.arange(len(col)), np.diff(off))
    out[at, np.arange(len(flat)) - off[:-1][at]] = flat
    return out


@dataclass
class Whitening:
    """Fitted model: ``n`` distinct rows with sums ``total`` (exact), unit eigenvectors (columns), their eigenvalues."""
    n: int
    dim: int
    total: list
    trace: float
    vectors: np.ndarray
    values: np.ndarray
    identity_error: float
    residual: float   # largest residual over the largest eigenvalue
    passes: int


class CentredRows:
    """Distinct x-vectors in blocks, and passes over them."""

    def __init__(self, rows: DataFrame):
        fit = staged_table(rows.select("x").distinct(), "whitening-fit")
        shape = (F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d"), F.min(F.size("x")).alias("least"))
        r = fit.agg(*shape).first()
        if r["n"] and r["least"] < r["d"]:  # shorter vectors count as filled up: some may be equal now
            filled = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(r["d"]) - F.size("x")))
            fit = staged_table(fit.select(filled.alias("x")).distinct(), "whitening-fit")
            r = fit.agg(*shape).first()
        self.n, self.dim = r["n"], r["d"] or 0
        dim, height = self.dim, max(1, BLOCK_BYTES // (8 * max(1, self.dim)))

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for at in range(0, b.num_rows, height):
                    m = stacked(b.column(0).slice(at, height), dim)
                    yield pa.RecordBatch.from_arrays([pa.array([m.tobytes()], pa.binary())], ["m"])

        # few partitions a core: every pass ends with one partial sum of each
        width = 2 * fit.sparkSession.sparkContext.defaultParallelism
        self.blocks = fit.coalesce(width).mapInArrow(pack, "m binary").persist(StorageLevel.MEMORY_AND_DISK)
        self.width, self.passes = width, 0
        self.total = [int(v) for v in self._sum(lambda m: m.sum(0), np.int64)] if self.n and self.dim else []

    def close(self) -> None:
        self.blocks.unpersist()

    def _sum(self, of, kind=np.float64) -> np.ndarray:
        """Sum of ``of(block)`` over all blocks: partial sums by partition, then in groups, then on the driver."""
        dim = self.dim

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            acc = None
            for b in batches:
                for raw in b.column(0):
                    part = of(np.frombuffer(raw.as_buffer(), np.int64).reshape(-1, dim))
                    acc = part if acc is None else acc + part
            if acc is not None:
                yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(acc, kind).tobytes()], pa.binary())], ["v"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            acc = None
            for b in batches:
                for raw in b.column(0):
                    part = np.frombuffer(raw.as_buffer(), kind)
                    acc = part if acc is None else acc + part
            if acc is not None:
                yield pa.RecordBatch.from_arrays([pa.array([acc.tobytes()], pa.binary())], ["v"])

        parts = self.blocks.mapInArrow(partial, "v binary")
        if self.width > 64:
            parts = parts.repartition(int(self.width ** 0.5)).mapInArrow(add, "v binary")
        self.passes += 1
        return np.sum([np.frombuffer(r[0], kind) for r in parts.collect()], axis=0)

    def times(self, u: np.ndarray) -> np.ndarray:
        """V u for the columns of u: one pass over the centred rows."""
        n, total = self.n, np.array(self.total, object)
        centre = _centring(n, total)

        def of(m: np.ndarray) -> np.ndarray:
            c = centre(m)
            return c.T @ (c @ u)

        return self._sum(of).reshape(u.shape) / n

    def spread(self) -> float:
        """Trace of the covariance."""
        centre = _centring(self.n, np.array(self.total, object))
        return float(self._sum(lambda m: np.array([(centre(m) ** 2).sum()]))[0]) / self.n

    def gram(self, w: np.ndarray) -> np.ndarray:
        """Covariance of the rows projected on the columns of w."""
        centre, k = _centring(self.n, np.array(self.total, object)), w.shape[1]

        def of(m: np.ndarray) -> np.ndarray:
            y = centre(m) @ w
            return y.T @ y
        return self._sum(of).reshape(k, k) / self.n


def _centring(n: int, total: np.ndarray):
    """x -> (n x - S) / n; exact before the division where n x fits 62 bits."""
    if not len(total):
        return lambda m: m.astype(np.float64)
    top = max(abs(int(v)) for v in total)

    def centre(m: np.ndarray) -> np.ndarray:
        if max(int(np.abs(m).max(initial=0)) * n, top) < 1 << 62:
            return (m * n - total.astype(np.int64)) / n
        return ((m.astype(object) * n - total) / n).astype(np.float64)
    return centre


def _minres(times, q: list[np.ndarray], theta: np.ndarray, r: np.ndarray, steps: int, tol: float) -> np.ndarray:
    """Approximate solutions t_j of the projected equations with right sides -r_j, in lock step.

    ``q[j]``: orthonormal columns that t_j stays orthogonal to. One product with the
    covariance a step serves all columns that still run.
    """
    def project(x):
        for j in range(x.shape[1]):
            for _ in range(2):
                x[:, j] -= q[j] @ (q[j].T @ x[:, j])
        return x

    m = r.shape[1]
    v, before = project(-r.copy()), np.zeros_like(r)
    beta = np.linalg.norm(v, axis=0)
    start, beta_old = beta.copy(), np.zeros(m)
    t, w, w_old = np.zeros_like(r), np.zeros_like(r), np.zeros_like(r)
    eta, c, c_old, s, s_old = beta.copy(), np.ones(m), np.ones(m), np.zeros(m), np.zeros(m)
    live = beta > 0
    v[:, live] /= beta[live]
    for _ in range(steps):
        if not live.any():
            break
        on = np.flatnonzero(live)
        p = np.zeros_like(r)
        p[:, on] = times(v[:, on]) - v[:, on] * theta[on]
        p = project(p)
        for j in on:
            alpha = v[:, j] @ p[:, j]
            nxt = p[:, j] - alpha * v[:, j] - (beta_old[j] * before[:, j])
            beta_new = np.linalg.norm(nxt)
            # rotations of the Lanczos matrix
            rho3, up = s_old[j] * beta_old[j], c_old[j] * beta_old[j]
            rho2 = c[j] * up + s[j] * alpha
            low = c[j] * alpha - s[j] * up
            rho1 = np.hypot(low, beta_new)
            if rho1 == 0:
                live[j] = False
                continue
            c_old[j], s_old[j] = c[j], s[j]
            c[j], s[j] = low / rho1, beta_new / rho1
            step = (v[:, j] - rho3 * w_old[:, j] - rho2 * w[:, j]) / rho1
            t[:, j] += c[j] * eta[j] * step
            w_old[:, j], w[:, j] = w[:, j], step
            eta[j] = -s[j] * eta[j]
            before[:, j] = v[:, j]
            beta_old[j] = beta_new
            if abs(eta[j]) <= tol * start[j] or beta_new <= 1e-14 * abs(theta[j]):
                live[j] = False
            else:
                v[:, j] = nxt / beta_new
    return project(t)


def _orthonormal(new: np.ndarray, basis: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Unit columns of ``new`` orthogonal to ``basis`` and to each other; dependent ones are replaced by random ones."""
    out = basis
    for j in range(new.shape[1]):
        if out.shape[1] >= len(new):
            break
        x = new[:, j].copy()
        for _ in range(4):
            size = np.linalg.norm(x)
            if size > 0:
                x /= size
            y = x - out @ (out.T @ x)
            left = np.linalg.norm(y)
            if left > 0.5:
                x = y / left
                break
            x = y if left > 1e-8 else rng.standard_normal(len(new))
        x -= out @ (out.T @ x)
        out = np.column_stack([out, x / np.linalg.norm(x)])
    return out[:, basis.shape[1]:]


def leading_pairs(times, dim: int, k: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray, float]:
    """The k largest eigenvalues and unit eigenvectors of the symmetric positive operator ``times`` by
    block Jacobi-Davidson, and the largest residual over the largest eigenvalue.

    Pairs are locked from the largest on, once the residual is at rounding level
    (or, where rounding of the products holds it above, cannot be lowered any more).
    """
    rng = np.random.default_rng(seed)
    k = min(k, dim)
    keep = min(dim, 2 * k + 2)
    size = max(BASIS, keep + 2 * k)
    basis = _orthonormal(rng.standard_normal((dim, keep)), np.zeros((dim, 0)), rng)
    image = times(basis)
    floor, best, stale = 16 * np.finfo(float).eps, np.full(k, np.inf), 0
    for _ in range(OUTER):
        small = basis.T @ image
        value, coef = np.linalg.eigh((small + small.T) / 2)
        value, coef = value[::-1], coef[:, ::-1]
        ritz, ritz_image = basis @ coef, image @ coef
        top = max(value[0], 0.0)
        if top <= 0:
            break
        r = ritz_image[:, :k] - ritz[:, :k] * value[:k]
        gap = np.linalg.norm(r, axis=0) / top
        stale = stale + 1 if (gap > 0.5 * best).all() else 0
        best = np.minimum(best, gap)
        locked = int(np.argmax(np.append(gap, 1.0) > floor))  # pairs before the first open one
        if locked == k or basis.shape[1] == dim or (stale >= 3 and gap.max() < 1e-11):
            break
        if basis.shape[1] + k > size:
            basis, image = ritz[:, :keep], ritz_image[:, :keep]
        wanted = np.arange(locked, k)
        others = [np.column_stack([ritz[:, :locked], ritz[:, j]]) for j in wanted]
        t = _minres(times, others, value[wanted], r[:, wanted], INNER, INNER_TOL)
        new = _orthonormal(t, basis, rng)
        if not new.shape[1]:
            break
        basis, image = np.column_stack([basis, new]), np.column_stack([image, times(new)])
    vectors = ritz[:, :k] / np.linalg.norm(ritz[:, :k], axis=0)
    return value[:k], vectors, float(gap.max()) if top > 0 else 0.0


def fit_whitening(rows: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Fit on the distinct ``x`` vectors of ``rows`` (see ``quantised``)."""
    data = CentredRows(rows)
    try:
        trace = data.spread() if data.n and data.dim else 0.0
        if trace <= 0:
            return Whitening(data.n, data.dim, data.total, trace, np.zeros((data.dim, 0)), np.zeros(0), 0.0, 0.0, data.passes)
        value, vectors, residual = leading_pairs(data.times, data.dim, components)
        real = value > 1e-12 * trace  # a component without variance has no whitened value
        value, vectors = value[real], vectors[:, real]
        cov = data.gram(vectors / np.sqrt(value))
        return Whitening(data.n, data.dim, data.total, trace, vectors, value, float(np.abs(cov - np.eye(len(value))).max()),
                         residual, data.passes)
    finally:
        data.close()


def whiten(rows: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE) -> DataFrame:
    """Per row with a whole, finite vector and per component (numbered from 1 by falling eigenvalue):
    ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    x = floor(scale * entry); the fit list is each distinct x once (n vectors,
    sums S). ``deviation``: sum of (n x - S)^2, exact (null beyond 64 bits).
    ``whitened``: (x - S/n) projected on the component over the root of its
    eigenvalue. ``explained``: eigenvalue over the trace. ``identity_error``:
    largest entry of the whitened fit list's covariance less the identity.

    Rows with a null vector, null or non-finite entries are left out. Repeated
    rows each get their values but count once in the fit. Shorter vectors count
    as filled up with zeros. Null ids stay. Components without variance (fewer
    distinct vectors than components, constant data) give no rows; so do empty
    tables. Other columns are not read. The driver holds only vectors of the
    dimension's length.
    """
    data = quantised(rows.select(F.col(vec_id).alias("vec_id"), F.col(vec).alias("__v")), "__v", scale).select("vec_id", "x")
    m = fit_whitening(data, components)
    total, n, dim = np.array(m.total, object), m.n, m.dim
    centre, root, share = _centring(n, total), np.sqrt(m.values), m.values / m.trace if m.trace > 0 else m.values
    k = len(m.values)

    def deviations(x: np.ndarray) -> list:
        if not len(x):
            return []
        widest = int(np.abs(x).max(initial=0)) * n + max(abs(int(v)) for v in m.total)
        if widest * widest * dim < 1 << 62:
            d = x * n - total.astype(np.int64)
            return (d * d).sum(1).tolist()
        exact = ((x.astype(object) * n - total) ** 2).sum(1)
        return [int(v) if v < 1 << 63 else None for v in exact]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not k or not b.num_rows:
                continue
            x = stacked(b.column(1), dim)
            w = centre(x) @ m.vectors / root
            rows, c = np.repeat(np.arange(len(x)), k), np.tile(np.arange(k), len(x))
            dev = pa.array(deviations(x), pa.int64()).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows)), pa.array((c + 1).astype(np.int32)), pa.array(np.full(len(c), n, np.int64)), dev,
                 pa.array(w.ravel()), pa.array(share[c]), pa.array(np.full(len(c), m.identity_error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = data.schema["vec_id"].dataType.simpleString()
    return data.mapInArrow(run, f"vec_id {kind}, component int, n long, deviation long, whitened double, "
                                "explained double, identity_error double")
