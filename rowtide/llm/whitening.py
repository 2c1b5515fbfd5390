"""Embedding whitening: leading principal components by a matrix-free block Jacobi-Davidson method.

The covariance is never formed. All it is asked for is its product with a block
of vectors, one pass over the stored fit list: every task centres its rows and
sums ``centred.T @ (centred @ block)``, the tasks' sums are added in two levels,
and the driver gets a few blocks of (dimensions x columns) numbers.

The method itself works on such blocks alone. A search subspace gives Ritz
pairs (Rayleigh-Ritz); the leading pairs whose residual has reached double
precision are locked, and for each open one the correction equation, projected
against the locked and the current vectors, is solved by some steps of MINRES.
The equations of all open pairs take their MINRES steps together, so a step is
one pass whatever their number. The corrections widen the subspace, which is
restarted from its best Ritz vectors when it is large.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import store

EPS = float(np.finfo(float).eps)
# Entries this large have no grid value of their own in a long.
LARGEST = float(1 << 62)
# Rows worked on at once.
ROWS = 2048

Product = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Eigenpairs:
    """Unit eigenvectors as columns, by falling eigenvalue, and the largest residual relative to the first eigenvalue."""

    values: np.ndarray
    vectors: np.ndarray
    residual: float
    passes: int


def orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns add to the orthonormal columns of ``against``."""
    kept: list[np.ndarray] = []
    for column in block.T:
        norm = np.linalg.norm(column)
        if not norm > 0:
            continue
        column = column / norm
        # Twice is enough for orthogonality to rounding; what nearly vanishes adds nothing.
        for _ in range(2):
            column = column - against @ (against.T @ column)
            for q in kept:
                column = column - q * (q @ column)
            rest = np.linalg.norm(column)
            if rest < 1e-10:
                break
            column = column / rest
        else:
            kept.append(column)
    return np.column_stack(kept) if kept else np.zeros((len(block), 0))


def minres(apply: Product, b: np.ndarray, steps: int, reduction: float) -> np.ndarray:
    """Approximate solutions of a symmetric system for each column of ``b``, all columns step by step together.

    ``apply`` maps a block to the operators' products, column j by the operator
    of equation j. Stops early once every residual is reduced by ``reduction``.
    """
    beta = np.linalg.norm(b, axis=0)
    start = np.where(beta > 0, beta, 1.0)
    v, v_old = b / start, np.zeros_like(b)
    x, w, w_old = np.zeros_like(b), np.zeros_like(b), np.zeros_like(b)
    eta, c, c_old = beta.copy(), np.ones(b.shape[1]), np.ones(b.shape[1])
    s, s_old, beta_k = np.zeros(b.shape[1]), np.zeros(b.shape[1]), np.zeros(b.shape[1])
    for _ in range(steps):
        p = apply(v)
        alpha = np.einsum("ij,ij->j", v, p)
        p = p - v * alpha - v_old * beta_k
        beta_next = np.linalg.norm(p, axis=0)
        # Givens rotations of the Lanczos matrix, a column for each equation.
        delta = c * alpha - c_old * s * beta_k
        rho2 = s * alpha + c_old * c * beta_k
        rho3 = s_old * beta_k
        rho1 = np.hypot(delta, beta_next)
        live = (rho1 > 0) & (np.abs(eta) > reduction * beta)
        safe = np.where(live, rho1, 1.0)
        c_new, s_new = delta / safe, beta_next / safe
        direction = np.where(live, (v - w_old * rho3 - w * rho2) / safe, 0.0)
        x = x + direction * (c_new * eta)
        eta = np.where(live, -s_new * eta, eta)
        w_old, w = w, direction
        c_old, c, s_old, s = c, np.where(live, c_new, c), s, np.where(live, s_new, s)
        v_old, v = v, np.where(beta_next > 0, p / np.where(beta_next > 0, beta_next, 1.0), 0.0)
        beta_k = beta_next
        if not (live & (beta_next > EPS * start) & (np.abs(eta) > reduction * beta)).any():
            break
    return x


def jacobi_davidson(
    product: Product,
    dims: int,
    wanted: int,
    *,
    inner_steps: int = 4,
    guard: int = 4,
    largest_subspace: int = 96,
    most_rounds: int = 200,
    seed: int = 5,
) -> Eigenpairs:
    """The ``wanted`` leading eigenpairs of a symmetric positive semidefinite operator given by its products.

    A pair is locked while its residual is at most ``8 * sqrt(dims) * eps`` of the
    largest eigenvalue. Pairs that stop getting better
    below 1e-12 of it are as good as the products are and count as well.
    """
    wanted = min(wanted, dims)
    passes = 0

    def counted(block: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        return product(block)

    rng = np.random.default_rng(seed)
    basis = orthonormal(rng.standard_normal((dims, min(dims, wanted + guard))), np.zeros((dims, 0)))
    images = counted(basis)
    before, stalled = math.inf, 0
    for _ in range(most_rounds):
        projected = basis.T @ images
        theta, turn = np.linalg.eigh((projected + projected.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        ritz, image = basis @ turn, images @ turn
        top = max(float(theta[0]), 0.0)
        rest = image[:, :wanted] - ritz[:, :wanted] * theta[:wanted]
        size = np.linalg.norm(rest, axis=0)
        open_ = np.flatnonzero(size > 8 * math.sqrt(dims) * EPS * top)
        now = float(size[open_].max(initial=0.0))
        stalled = stalled + 1 if now > before / 4 else 0
        before = min(before, now)
        full = basis.shape[1] == dims
        if not len(open_) or (now <= 1e-12 * top and (stalled >= 2 or full)):
            return Eigenpairs(theta[:wanted], ritz[:, :wanted], float(size.max()) / top if top else 0.0, passes)
        if full:
            # The subspace is everything, so only rounding is left: products of the Ritz vectors themselves.
            basis = ritz
            images = counted(basis)
            continue
        locked = np.delete(ritz[:, :wanted], open_, axis=1)
        current, shift = ritz[:, open_], theta[open_]

        def project(block: np.ndarray) -> np.ndarray:
            """Column j loses its part along the locked vectors and along its own current vector."""
            block = block - locked @ (locked.T @ block)
            return block - current * np.einsum("ij,ij->j", current, block)

        def corrected(block: np.ndarray) -> np.ndarray:
            block = project(block)
            return project(counted(block) - block * shift)

        steps = minres(corrected, -project(rest[:, open_]), inner_steps, 1e-3)
        if basis.shape[1] + len(open_) > max(largest_subspace, 2 * (wanted + guard)):
            keep = wanted + guard
            basis, images = ritz[:, :keep], image[:, :keep]
        else:
            basis, images = ritz, image
        new = orthonormal(project(steps), basis)
        if not new.shape[1]:
            new = orthonormal(rng.standard_normal((dims, 1)), basis)
        basis, images = np.column_stack([basis, new]), np.column_stack([images, counted(new)])
    raise ArithmeticError(f"no convergence in {most_rounds} rounds: residual {before / top if top else before}")


def grid_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id and x, the grid vector floor(64 * c) + 1000000 as the bytes of its longs.

    Rows whose vector is null, empty, or has an entry that is null, not finite,
    or without such a long are left out.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                lists = batch.column(1)
                length = pc.list_value_length(lists).fill_null(0).to_numpy()
                # A null entry is NaN here.
                scaled = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False) * 64.0
                row = np.repeat(np.arange(batch.num_rows), length)
                usable = length > 0
                usable[row[~(np.abs(scaled) < LARGEST)]] = False
                x = np.floor(scaled[usable[row]]).astype(np.int64) + 1_000_000
                ends = np.concatenate([[0], np.cumsum(8 * length[usable])]).astype(np.int32)
                packed = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(x)])
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(usable)), packed], names=["vec_id", "x"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.select("vec_id", "embedding").mapInArrow(scan, f"vec_id {kind}, x binary")


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, dims)


@dataclass(frozen=True)
class Scale:
    """Count and sums of the fit list, and rows centred by them."""

    n: int
    sums: tuple[int, ...]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: as longs where they surely fit, else as Python integers."""
        largest = max(int(np.abs(x).max(initial=0)) * self.n, max(map(abs, self.sums)))
        if largest < 1 << 61:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x).astype(float) / self.n


def squared_length(deviation: np.ndarray) -> list[int | None]:
    """The exact sum of squares of each row; null where it does not fit a long."""
    if deviation.dtype != object:
        widest = float(np.abs(deviation).max(initial=0))
        if widest * widest * deviation.shape[1] < float(1 << 62):
            return np.einsum("ij,ij->i", deviation, deviation).tolist()
        deviation = deviation.astype(object)
    return [d if d < 1 << 63 else None for d in (deviation * deviation).sum(axis=1).tolist()]


def added(fit: DataFrame, dims: int, task: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over the fit list of ``task(rows)``, a flat array of one length and type for all rows.

    One pass. Each task adds up its own rows, about sqrt(tasks) groups of tasks
    are added on the executors, and the driver adds those.
    """
    fan = max(1, math.isqrt(fit.rdd.getNumPartitions()))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = task(matrix(batch.column(0).slice(at, ROWS), dims))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"kind": [total.dtype.char], "sums": [total.tobytes()]})

    def summed(kinds: list[str], sums: list[bytes]) -> np.ndarray:
        # In an order of their own, so that the sum does not depend on which task ended first.
        return np.sum([np.frombuffer(s, k) for k, s in zip(kinds, sorted(map(bytes, sums)))], axis=0)

    def merged(group: pa.Table) -> pa.Table:
        total = summed(group.column("kind").to_pylist(), group.column("sums").to_pylist())
        return pa.table({"kind": [total.dtype.char], "sums": [total.tobytes()]})

    parts = fit.mapInArrow(partial, "kind string, sums binary").withColumn("node", F.pmod(F.spark_partition_id(), F.lit(fan)))
    rows = parts.groupBy("node").applyInArrow(merged, "kind string, sums binary").collect()
    return summed([r.kind for r in rows], [r.sums for r in rows])


def scale_of(fit: DataFrame, dims: int) -> Scale:
    """Count and exact sums of the fit list. The halves of a long are added apart, so that no sum overflows."""

    def halves(x: np.ndarray) -> np.ndarray:
        return np.concatenate([(x >> 31).sum(axis=0), (x & ((1 << 31) - 1)).sum(axis=0), [len(x)]])

    *sums, n = added(fit, dims, halves).tolist()
    return Scale(n, tuple((high << 31) + low for high, low in zip(sums[:dims], sums[dims:])))


def whitened(vectors: DataFrame, *, components: int = 16, **settings) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each vector and component.

    Vectors (``embedding``) are brought to the grid ``floor(64 * c) + 1000000``;
    the covariance is that of the distinct grid vectors, divisor n. Components
    are its unit eigenvectors by falling eigenvalue, numbered from 1, at most
    ``components`` and the dimensions. ``settings`` go to ``jacobi_davidson``.

    Vectors that are null, empty, or hold a null or non-finite entry or one
    beyond the range of the grid give no rows. If vectors differ in length, those
    of the most frequent length count (the longest of several), the others give
    no rows. A component without variance (eigenvalue zero to rounding) has no
    whitened values and no rows, so equal vectors or a single one give none.
    Repeated rows and vec_ids give repeated rows; a null vec_id is kept. A
    deviation that does not fit a long is null. An empty table gives no rows.
    Other columns are ignored.
    """
    spark = vectors.sparkSession
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    gridded = grid_vectors(vectors)
    lengths = gridded.groupBy(F.octet_length("x").alias("bytes")).agg(F.count(F.lit(1)).alias("rows"))
    # Of the row counts by length only the largest comes to the driver.
    common = lengths.agg(F.max(F.struct("rows", "bytes")).alias("top")).first().top
    if common is None:
        return spark.createDataFrame([], schema)
    dims = common.bytes // 8
    gridded = gridded.where(F.octet_length("x") == common.bytes)
    fit = store(gridded.select("x").distinct(), "whitening-fit")
    scale = scale_of(fit, dims)
    n = scale.n

    def product(block: np.ndarray) -> np.ndarray:
        def task(x: np.ndarray) -> np.ndarray:
            centred = scale.centred(x)
            return (centred.T @ (centred @ block)).ravel()

        return added(fit, dims, task).reshape(block.shape) / n

    trace = float(added(fit, dims, lambda x: np.array([np.square(scale.centred(x)).sum()]))[0]) / n
    if not trace > 0:
        return spark.createDataFrame([], schema)
    found = jacobi_davidson(product, dims, components, **settings)
    real = int((found.values > dims * EPS * trace * 8).sum())
    turn = found.vectors[:, :real] / np.sqrt(found.values[:real])
    explained = found.values[:real] / trace

    def moments(x: np.ndarray) -> np.ndarray:
        z = scale.centred(x) @ turn
        return np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])

    sums = added(fit, dims, moments) / n
    # The mean is zero but for rounding; taking its square off leaves the centred products.
    spread = sums[real:].reshape(real, real) - np.outer(sums[:real], sums[:real])
    error = float(np.abs(spread - np.eye(real)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                deviation = scale.deviations(matrix(batch.column(1), dims))
                z = (deviation.astype(float) / n) @ turn
                rows = batch.num_rows
                source = pa.array(np.repeat(np.arange(rows), real))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(source),
                        pa.array(np.tile(np.arange(1, real + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * real, n, np.int64)),
                        pa.array(squared_length(deviation), pa.int64()).take(source),
                        pa.array(z.ravel()),
                        pa.array(np.tile(explained, rows)),
                        pa.array(np.full(rows * real, error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return gridded.mapInArrow(project, schema)
