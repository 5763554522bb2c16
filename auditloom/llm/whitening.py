"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi.

Vectors become whole numbers, so that counts, sums and deviations are exact. Three passes
run over the fit list, each different vector once: sums per dimension, the centred scatter,
and the covariance of the whitened vectors, which is measured, not assumed. Each task adds up
its own rows and sends one row of the matrix at a time; Spark adds those up by row. Only sums
and matrices of the dimension reach the driver, whatever the number of vectors.

The scatter is factored as P L Lt Pt by Cholesky with diagonal pivoting. Plane rotations
from the right then make the columns of L orthogonal: with L J = U D the scatter is
U D^2 Ut, so that squared column norms are its eigenvalues and normalised columns, put back
in their order, its eigenvectors (Veselic and Hari, A note on a one-sided Jacobi algorithm,
Numer. Math. 56, 1989). Working on the factor keeps small eigenvalues accurate.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditloom.session import materialise

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
# entries from this size on have no exact whole number
LARGEST = float(1 << 46)
# eigenvalues below this share of the largest are no spread, only rounding
LEAST_SHARE = 1e-13
MOST_SWEEPS = 60
# rows that a task turns into a matrix at a time
_ROWS = 4096


@dataclass(frozen=True)
class Whitening:
    """Components as rows, their eigenvalues, and what the fit list held."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``x`` of the rows that take part.

    Left out: null and empty vectors, vectors that hold null, NaN, infinite components or
    ones beyond ``LARGEST``, and vectors that are not of the most frequent length (the shorter
    of equally frequent ones). A null vec_id takes part.
    """
    v = F.col("v")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.filter(v.isNotNull() & (F.size(v) > 0) & fine)
    sizes = rows.groupBy(F.size(v).alias("size")).agg(F.count(F.lit(1)).alias("n"))
    common = sizes.orderBy(F.desc("n"), "size").limit(1).select("size")
    x = F.transform(v, lambda c: F.floor(c * F.lit(float(SCALE))) + F.lit(SHIFT).cast("long"))
    # common has one row
    return rows.join(F.broadcast(common), F.size(v) == F.col("size"), "left_semi").select("vec_id", x.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _blocks(batches) -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield _matrix(batch.column("x").slice(at, _ROWS))


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n from the whole number n * x - S, which is rounded once."""
    return _scaled(x, n, sums).astype(np.float64) / n


def _scaled(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, in Python numbers where 64 bits may not do."""
    largest = max(int(np.abs(x).max(initial=0)), int(max(map(abs, sums.tolist()), default=0)) // max(n, 1) + 1)
    if 2 * n * largest < 1 << 63:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


def _matrix_sums(fit: DataFrame, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of the matrices that ``part`` makes of blocks of vectors, added up row by row."""

    def add(batches):
        total = None
        for x in _blocks(batches):
            own = part(x)
            total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_pydict(
                {"i": pa.array(range(len(total)), pa.int32()), "row": pa.array(list(total), pa.list_(pa.float64()))}
            )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        i, total = None, 0.0
        for batch in batches:
            i = batch.column("i")[0]
            total = total + _matrix(batch.column("row")).sum(axis=0)
        yield pa.RecordBatch.from_pydict(
            {"i": pa.array([i.as_py()], pa.int32()), "row": pa.array([total], pa.list_(pa.float64()))}
        )

    parts = fit.select("x").mapInArrow(add, "i int, row array<double>")
    merged = parts.groupBy("i").applyInArrow(merge, "i int, row array<double>")
    return np.array([r.row for r in merged.orderBy("i").collect()])


def _sums(fit: DataFrame) -> tuple[int, np.ndarray]:
    """The number of vectors and their exact sums per dimension."""

    def add(batches):
        n, total = 0, None
        for x in _blocks(batches):
            n += len(x)
            # in Python numbers, which do not overflow
            own = (x >> 31).sum(axis=0).astype(object) * (1 << 31) + (x & (1 << 31) - 1).sum(axis=0).astype(object)
            total = own if total is None else total + own
        if n:
            yield pa.RecordBatch.from_pydict(
                {
                    "i": pa.array(range(len(total)), pa.int32()),
                    "n": pa.array([n] * len(total), pa.int64()),
                    "s": pa.array([str(t) for t in total], pa.string()),
                }
            )

    parts = fit.select("x").mapInArrow(add, "i int, n long, s string")
    whole = F.sum(F.col("s").cast("decimal(38,0)")).alias("s")
    found = parts.groupBy("i").agg(F.sum("n").alias("n"), whole).orderBy("i").collect()
    return (found[0].n if found else 0), np.array([int(r.s) for r in found], dtype=object)


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """``f`` with a = f @ f.T, rows in the order of ``a``, a column per pivot above rounding.

    In the order of the pivots f is lower triangular with a falling diagonal.
    """
    size = len(a)
    rest, order = a.astype(np.float64).copy(), np.arange(size)
    factor = np.zeros((size, size))
    limit = size * np.finfo(np.float64).eps * max(np.diag(a).max(initial=0.0), 0.0)
    for k in range(size):
        best = k + int(np.argmax(np.diag(rest)[k:]))
        if not rest[best, best] > limit:
            factor = factor[:, :k]
            break
        if best != k:
            swap, back = [k, best], [best, k]
            rest[swap] = rest[back]
            rest[:, swap] = rest[:, back]
            factor[swap] = factor[back]
            order[swap] = order[back]
        factor[k, k] = np.sqrt(rest[k, k])
        factor[k + 1 :, k] = rest[k + 1 :, k] / factor[k, k]
        rest[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    unpivoted = np.empty_like(factor)
    unpivoted[order] = factor
    return unpivoted


def _rounds(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Every pair of n columns once, in rounds of pairs that share no column."""
    ring = list(range(n + n % 2))
    found = []
    for _ in range(len(ring) - 1):
        half = len(ring) // 2
        pairs = [(a, b) for a, b in zip(ring[:half], reversed(ring[half:])) if max(a, b) < n]
        found.append((np.array([p[0] for p in pairs], dtype=int), np.array([p[1] for p in pairs], dtype=int)))
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return found


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """``factor`` with its columns rotated until they are orthogonal to rounding."""
    f = factor.copy()
    if f.shape[1] < 2:
        return f
    tolerance = f.shape[0] * np.finfo(np.float64).eps
    rounds = _rounds(f.shape[1])
    for _ in range(MOST_SWEEPS):
        worst = 0.0
        for p, q in rounds:
            a, b = f[:, p], f[:, q]
            alpha, beta, gamma = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
            angle = np.abs(gamma) / np.sqrt(np.maximum(alpha * beta, np.finfo(np.float64).tiny))
            worst = max(worst, float(angle.max(initial=0.0)))
            turn = angle > tolerance
            if not turn.any():
                continue
            zeta = (beta - alpha)[turn] / (2.0 * gamma[turn])
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = 1.0 / np.hypot(1.0, t)
            s = c * t
            a, b = a[:, turn], b[:, turn]
            f[:, p[turn]], f[:, q[turn]] = c * a - s * b, s * a + c * b
        if worst <= tolerance:
            return f
    raise RuntimeError("the rotations did not settle")


def eigen(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues above rounding, falling, and their unit eigenvectors as rows."""
    rotated = one_sided_jacobi(pivoted_cholesky((scatter + scatter.T) / 2))
    values = (rotated * rotated).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    order = order[values[order] > LEAST_SHARE * values.max(initial=0.0)]
    return values[order], (rotated[:, order] / np.sqrt(values[order])).T


def _whitened(x: np.ndarray, n: int, sums: np.ndarray, components: np.ndarray, values: np.ndarray) -> np.ndarray:
    return centred(x, n, sums) @ components.T / np.sqrt(values)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the different vectors ``x`` of ``rows``; None without any spread."""
    different = materialise(rows.select("x").distinct())
    n, sums = _sums(different)
    if n == 0:
        return None

    def scatter(x):
        c = centred(x, n, sums)
        return c.T @ c

    covariance = _matrix_sums(different, scatter) / n
    values, vectors = eigen(covariance)
    values, vectors = values[:components], vectors[:components]
    if not len(values):
        return None

    def gram(x):
        w = _whitened(x, n, sums, vectors, values)
        return w.T @ w

    error = np.abs(_matrix_sums(different, gram) / n - np.eye(len(values))).max()
    return Whitening(n, tuple(sums.tolist()), vectors, values, float(np.trace(covariance)), float(error))


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per vector that takes part and component, see the module and ``whole_numbers``.

    Equal vectors count once in the fit and all get their rows, as do repeated rows. There
    are at most ``components`` components and no more than the vectors span: none, and so
    no rows, for an empty table or if all vectors are equal. ``deviation`` is null where it
    exceeds 64 bits. Eigenvalues that tie are numbered in the order in which they were found,
    alike for all rows. Columns other than vec_id and embedding are left out.
    """
    rows = whole_numbers(vectors)
    model = fit(rows, components)
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double"
    )
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    # bounded by the dimension and the number of components
    values = (model.n, model.sums, model.components, model.eigenvalues, model.trace, model.identity_error)
    shared = vectors.sparkSession.sparkContext.broadcast(values)

    def apply(batches):
        n, sums, axes, eigenvalues, trace, error = shared.value
        sums, k = np.array(sums, dtype=object), len(eigenvalues)
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                x = _matrix(batch.column("x"))
                d = _scaled(x, n, sums)
                if d.dtype != object and len(sums) * int(np.abs(d).max(initial=0)) ** 2 >= 1 << 63:
                    d = d.astype(object)
                deviation = [int(v) if v < 1 << 63 else None for v in (d * d).sum(axis=1)]
                w = d.astype(np.float64) / n @ axes.T / np.sqrt(eigenvalues)
                rows = len(x)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(np.repeat(np.arange(rows), k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * k, n)),
                        pa.array([v for v in deviation for _ in range(k)], pa.int64()),
                        pa.array(w.ravel()),
                        pa.array(np.tile(eigenvalues / trace, rows)),
                        pa.array(np.full(rows * k, error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(apply, schema)
