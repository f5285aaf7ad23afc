"""Embedding whitening on the leading eigenvectors of the covariance, found by a block Jacobi-Davidson method.

**Products.** The covariance is never formed. A product of it with a block of vectors is one distributed pass: each task
centres its rows of the fit list (every distinct scaled vector once, a kept table), multiplies them with the block and
again with the outcome, and Spark sums the tasks' partial blocks by place. The driver holds blocks of a few vectors
of one embedding's length, whatever the number of rows.
**Jacobi-Davidson.** Rayleigh-Ritz on a small subspace gives the Ritz pairs. For each wanted pair that has not
converged, the correction equation ``(I - QQ')(V - theta I)(I - QQ') t = -r``, Q being the locked vectors and the Ritz
vectors, is solved by some steps of MINRES; the equations of all wanted pairs share each pass. Corrections widen
the subspace, which restarts from its best vectors when it is full. A pair whose residual is at the rounding of a
product, ``PRECISION * largest eigenvalue``, is locked. When all are locked, a last Rayleigh-Ritz step on them and
the subspace orders them; a pair that was passed over would stand out there, and the search would go on.

Defined results: rows whose vector is null or empty, or holds null or non-finite entries, and rows with another number of
entries than most rows have (of equally many, the larger number) are dropped. Scaled entries are floor(256 * c), held to
+-2^62. Repeated rows give rows each; a null id stays null. Components with no variance (one distinct vector, or
fewer distinct vectors than components) are left out, so a table with one vector gives no rows. ``deviation`` is exact,
and null where it is beyond 64 bits. Columns besides id and vector play no part.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Scratch, record_batch

SCALE, COMPONENTS = 256, 4
PRECISION = 1e-15  # of a residual, against the largest eigenvalue and the root of the number of entries
INNER, SUBSPACE, OUTER = 3, 32, 200  # MINRES steps, vectors of the subspace, Rayleigh-Ritz steps
MOST_PARTS = 64  # partial sums that reach the driver


class Whitening(NamedTuple):
    """Of the fit list: rows, sums, total variance; eigenvalues, eigenvectors (columns), their residuals; the identity error."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    identity_error: float
    passes: int


def matrix_of(column: pa.Array, kind: type = np.float64) -> np.ndarray:
    """A list column whose lists are of one length, as rows."""
    if not len(column):
        return np.zeros((0, 0), kind)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(kind, copy=False)


def scaled(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, x) of the rows that take part, x being the scaled entries."""
    df = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    df = df.where("v IS NOT NULL AND size(v) > 0").where(finite)
    lengths = df.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).agg(F.max(F.struct("n", "d"))["d"]).first()[0] or 0

    def run(batches):
        for batch in batches:
            x = np.floor(matrix_of(batch.column(1)) * scale)
            x = np.clip(x, -(2.0**62), 2.0**62).astype(np.int64)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * lengths)
            yield record_batch(vec_id=batch.column(0), x=pa.ListArray.from_arrays(offsets, pa.array(x.ravel())))

    return df.where(F.size("v") == F.lit(lengths)).mapInArrow(run, "vec_id long, x array<long>")


def summed(fit: DataFrame, partial, kind: str = "double") -> np.ndarray | None:
    """One pass over the fit list: the sum of ``partial(x)`` over all batches as one row of numbers, None without rows.

    Each task sends one row; with many tasks the rows are summed in groups first, so the driver gets a bounded number.
    """
    schema, number = f"p array<{kind}>", {"double": np.float64, "long": np.int64}[kind]

    def total_of(rows):
        total = None
        for own in rows:
            total = own if total is None else total + own
        if total is not None:
            yield record_batch(p=pa.ListArray.from_arrays(pa.array([0, len(total)], pa.int32()), pa.array(total)))

    def local(batches):
        yield from total_of(partial(matrix_of(b.column(0), np.int64)).ravel().astype(number) for b in batches if b.num_rows)

    def merged(batches):
        yield from total_of(row for b in batches if b.num_rows for row in matrix_of(b.column(0), number))

    parts = fit.select("x").mapInArrow(local, schema)
    if parts.rdd.getNumPartitions() > MOST_PARTS:
        parts = parts.repartition(MOST_PARTS).mapInArrow(merged, schema)
    rows = [np.array(row.p, dtype=number) for row in parts.collect()]
    return np.sum(rows, axis=0) if rows else None


def moments(fit: DataFrame) -> tuple[int, list[int]]:
    """Rows and exact sums by entry; entries are summed in pieces of 21 bits, so 64 bits hold the sums of 2^42 rows."""
    low = np.int64((1 << 21) - 1)

    def partial(rows):
        pieces = [rows & low, (rows >> np.int64(21)) & low, rows >> np.int64(42)]
        return np.concatenate([[len(rows)], *(p.sum(axis=0) for p in pieces)])

    found = summed(fit, partial, "long")
    if found is None:
        return 0, []
    parts = found[1:].reshape(3, -1).tolist()
    return int(found[0]), [a + (b << 21) + (c << 42) for a, b, c in zip(*parts)]


def _orthonormal(t: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Columns of ``t`` made orthonormal to ``against`` and each other; what vanishes is left out."""
    kept = []
    for column in t.T:
        norm = np.linalg.norm(column)
        if not norm > 0:
            continue
        column = column / norm
        for _ in range(3):
            column = column - against @ (against.T @ column)
            for k in kept:
                column = column - k * (k @ column)
        size = np.linalg.norm(column)
        if size > 1e-8:
            kept.append(column / size)
    return np.column_stack(kept) if kept else np.zeros((len(t), 0))


def minres(apply, right: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """``steps`` steps of MINRES for the columns of ``right`` side by side; ``apply`` is one pass for all of them."""
    x, beta = np.zeros_like(right), np.linalg.norm(right, axis=0)
    safe = lambda a: np.where(np.abs(a) > 1e-300, a, 1.0)
    goal, eta = tolerance * beta, beta.copy()
    v_old, v = np.zeros_like(right), right / safe(beta)
    w_old, w = np.zeros_like(right), np.zeros_like(right)
    c_old = c = np.ones(right.shape[1])
    s_old = s = np.zeros(right.shape[1])
    last = np.zeros(right.shape[1])
    for _ in range(steps):
        y = apply(v)
        alpha = (v * y).sum(axis=0)
        y = y - alpha * v - last * v_old
        following = np.linalg.norm(y, axis=0)
        r1 = s_old * last
        r2 = s * alpha + c_old * c * last
        r3 = c * alpha - s * c_old * last
        length = np.hypot(r3, following)
        c_old, s_old = c, s
        c, s = r3 / safe(length), following / safe(length)
        w_old, w = w, (v - r2 * w - r1 * w_old) / safe(length)
        active = np.abs(eta) > goal
        x = x + np.where(active, c * eta, 0.0) * w
        eta = np.where(active, -s * eta, eta)
        v_old, v, last = v, y / safe(following), following
        if not (np.abs(eta) > goal).any():
            break
    return x


def jacobi_davidson(apply, size: int, wanted: int, inner: int = INNER, subspace: int = SUBSPACE, outer: int = OUTER, seed: int = 5):
    """The ``wanted`` largest eigenvalues of a symmetric operator, their vectors and residuals.

    ``apply`` takes a block of columns. Raises ArithmeticError when residuals stay above the goal for ``outer`` steps.
    """
    wanted = min(wanted, size)
    subspace = min(size, max(subspace, 3 * wanted))
    random = np.random.default_rng(seed)
    locked, locked_image = np.zeros((size, 0)), np.zeros((size, 0))
    basis = _orthonormal(random.standard_normal((size, min(size, 2 * wanted))), locked)
    image = apply(basis)
    history: list[float] = []
    for step in range(outer):
        # Rayleigh-Ritz on what is not locked.
        small = basis.T @ image
        theta, rotation = np.linalg.eigh((small + small.T) / 2)
        theta, rotation = theta[::-1], rotation[:, ::-1]
        basis, image = basis @ rotation, image @ rotation
        open_ = wanted - locked.shape[1]
        largest = max([theta[0], *(locked * locked_image).sum(axis=0)])
        goal = PRECISION * max(largest, 0) * np.sqrt(size)
        residual = image[:, :open_] - basis[:, :open_] * theta[:open_]
        residual -= locked @ (locked.T @ residual)
        norms = np.linalg.norm(residual, axis=0)
        whole = basis.shape[1] + locked.shape[1] == size
        done = 0
        while done < len(norms) and (norms[done] <= goal or whole):
            done += 1
        if done:
            locked = np.column_stack([locked, basis[:, :done]])
            locked_image = np.column_stack([locked_image, image[:, :done]])
            basis, image, theta = basis[:, done:], image[:, done:], theta[done:]
            residual, norms = residual[:, done:], norms[done:]
            history = []
        if locked.shape[1] >= wanted:
            least = (locked * locked_image).sum(axis=0).min()
            if not len(theta) or theta[0] <= least + goal:
                break
            # A larger one turned up after a smaller was locked: the smallest goes back.
            back = int(np.argmin((locked * locked_image).sum(axis=0)))
            basis, image = np.column_stack([basis, locked[:, back]]), np.column_stack([image, locked_image[:, back]])
            locked, locked_image = np.delete(locked, back, axis=1), np.delete(locked_image, back, axis=1)
            continue
        open_ = wanted - locked.shape[1]
        history.append(float(norms[0]) if len(norms) else 0.0)
        if len(history) > 12 and min(history[-6:]) > 0.5 * min(history[:-6]) and norms[0] > 1e3 * goal:
            raise ArithmeticError(f"The residual stays at {norms[0]:.3g}; the goal is {goal:.3g}.")
        if len(history) > 6 and min(history[-3:]) > 0.5 * min(history[:-3]) and norms[0] <= 1e3 * goal:
            # No product is more exact than its rounding: this is double precision.
            locked, locked_image = np.column_stack([locked, basis[:, :1]]), np.column_stack([locked_image, image[:, :1]])
            basis, image, history = basis[:, 1:], image[:, 1:], []
            continue
        if basis.shape[1] + open_ > subspace:  # restart from the best
            keep = max(2 * open_, subspace // 2)
            basis, image, theta = basis[:, :keep], image[:, :keep], theta[:keep]
        ritz, shift = basis[:, : len(norms)], theta[: len(norms)]
        unconverged = norms > goal
        frame = np.column_stack([locked, ritz])
        project = lambda t: t - frame @ (frame.T @ t)
        corrections = minres(
            lambda t: project(apply(project(t)) - shift[unconverged] * project(t)), -project(residual[:, unconverged]), inner, max(2.0 ** -(step + 2), 1e-4)
        )
        grown = _orthonormal(corrections, np.column_stack([locked, basis]))
        if not grown.shape[1] and basis.shape[1] + locked.shape[1] < size:
            grown = _orthonormal(random.standard_normal((size, 1)), np.column_stack([locked, basis]))
        if grown.shape[1]:
            basis, image = np.column_stack([basis, grown]), np.column_stack([image, apply(grown)])
    else:
        raise ArithmeticError(f"{locked.shape[1]} of {wanted} eigenvectors converged in {outer} steps.")
    # Once more on all that is known, with fresh products of the result.
    both, images = np.column_stack([locked, basis]), np.column_stack([locked_image, image])
    small = both.T @ images
    _, rotation = np.linalg.eigh((small + small.T) / 2)
    vectors = both @ rotation[:, ::-1][:, :wanted]
    vectors /= np.linalg.norm(vectors, axis=0)
    images = apply(vectors)
    values = (vectors * images).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    vectors, images, values = vectors[:, order], images[:, order], values[order]
    return values, vectors, np.linalg.norm(images - vectors * values, axis=0)


def fit(x: DataFrame, components: int = COMPONENTS, scratch: Scratch | None = None) -> Whitening:
    """Learn from a frame with scaled vectors ``x``, each distinct one once."""
    scratch = scratch or Scratch(x.sparkSession)
    distinct = scratch.keep(x.select("x").distinct())
    try:
        n, sums = moments(distinct)
        size = len(sums)
        if n < 2 or not size:
            return Whitening(n, sums, 0.0, np.zeros(0), np.zeros((size, 0)), np.zeros(0), 0.0, 0)
        centre, passes = _centre(n, sums), [0]
        trace = float(summed(distinct, lambda rows: np.square(centre(rows)).sum(keepdims=True))[0]) / n

        def apply(block: np.ndarray) -> np.ndarray:
            passes[0] += 1

            def partial(rows):
                z = centre(rows)
                return z.T @ (z @ block)

            return summed(distinct, partial).reshape(block.shape) / n

        values, vectors, residuals = jacobi_davidson(apply, size, components)
        real = values > 1e-13 * max(trace, 1e-300) * size
        values, vectors, residuals = values[real], vectors[:, real], residuals[real]
        weights = vectors / np.sqrt(values)

        def covariance(rows):
            w = centre(rows) @ weights
            return np.concatenate([w.T @ w, w.sum(axis=0, keepdims=True)])

        k = len(values)
        if not k:
            return Whitening(n, sums, trace, values, vectors, residuals, 0.0, passes[0])
        moment = summed(distinct, covariance).reshape(k + 1, k) / n
        error = moment[:k] - np.outer(moment[k], moment[k]) - np.eye(k)
        return Whitening(n, sums, trace, values, vectors, residuals, float(np.abs(error).max()), passes[0])
    finally:
        scratch.drop(distinct)


def _centre(n: int, sums: list[int]):
    """Rows less their mean; the whole part of the mean is taken off in integers, so nothing is lost to its size."""
    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return lambda rows: (rows - whole).astype(np.float64) - rest


def deviations(rows: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Of each row, the sum over its entries of (n * x - S)^2, exactly; null where it is beyond 64 bits."""
    most = max((n * max(abs(int(rows.min())), abs(int(rows.max()))) + max(map(abs, sums))) if rows.size else 0, 1)
    if most**2 * rows.shape[1] < 1 << 63:
        apart = n * rows - np.array(sums, dtype=np.int64)
        return pa.array((apart * apart).sum(axis=1))
    exact = [sum((n * x - s) ** 2 for x, s in zip(row, sums)) for row in rows.tolist()]
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, eigenvalue double, residual double"


def whiten(x: DataFrame, model: Whitening) -> DataFrame:
    """A row for each row of ``x`` (vec_id, x) and component."""
    k = len(model.values)
    centre = _centre(model.n, model.sums) if k else None

    def run(batches):
        for batch in batches:
            if not k or not batch.num_rows:
                continue
            rows = matrix_of(batch.column(1), np.int64)
            white = (centre(rows) @ model.vectors) / np.sqrt(model.values)
            place = np.repeat(np.arange(len(rows)), k)
            tiled = lambda values: pa.array(np.tile(values, len(rows)))
            yield record_batch(
                vec_id=batch.column(0).take(pa.array(place)), component=tiled(np.arange(1, k + 1, dtype=np.int32)), n=tiled(np.full(k, model.n)),
                deviation=deviations(rows, model.n, model.sums).take(pa.array(place)), whitened=pa.array(white.ravel()),
                explained=tiled(model.values / model.trace), identity_error=tiled(np.full(k, model.identity_error)),
                eigenvalue=tiled(model.values), residual=tiled(model.residuals),
            )

    return x.select("vec_id", "x").mapInArrow(run, OUT)


def whitened(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Fit on all rows and whiten all rows."""
    scratch = Scratch(vectors.sparkSession)
    x = scratch.keep(scaled(vectors, id_col, vec_col, scale))
    return whiten(x, fit(x, components, scratch))
