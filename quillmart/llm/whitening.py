"""Embedding whitening by Jacobi-Davidson (operator 12).

A vector's entry c becomes the whole number x = floor(1024 * c) + 100000. The
sums of x are exact. The covariance matrix is never built: a product of it
with a few columns is one Spark job in which every task centres its own rows,
multiplies them twice and hands on one partial sum per entry of the result
(dimension times columns, whatever the number of rows).

The leading eigenvectors come from a block Jacobi-Davidson iteration: Rayleigh-
Ritz in a growing subspace gives the wanted pairs; a pair whose residual is at
double precision is locked and gets no more work; for each other pair the
correction equation, projected off all wanted pairs, is solved approximately by
MINRES, whose steps share one distributed product; the corrections extend the
subspace, which restarts from its leading Ritz vectors when it is full. The
driver holds (dimension x subspace) numbers only.

Defined results: a null vector, or one with a null, NaN, infinite or (after
scaling) not representable entry, is left out. Vectors of another length than
the most common one (ties: the longest) have no place in one covariance matrix
and are left out too. A null id is carried as null; repeated rows count and are
returned each; an empty table gives an empty result; other columns are ignored.
Directions without variance can't be whitened and are no components.
``deviation`` is null where it does not fit a long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quillmart.llm.common import cut, ship

SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double"
SCALE, SHIFT = 1024, 100_000
ROWS_PER_BLOCK = 4096
LARGEST = 2.0 ** 40  # of an entry: its sums over all rows must fit a long


@dataclass
class Fit:
    """Number of rows, exact sums per dimension, unit eigenvectors (columns),
    their eigenvalues, and the trace of the covariance matrix."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return self.sums / max(self.n, 1)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.vectors / np.sqrt(self.values)


def blocks(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The valid rows as blocks (``ids``, ``x`` as little-endian longs, one row
    of the block after the other), checkpointed, as every product reads them."""
    v = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull())
    rows = rows.where(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST)))
    length = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    rows = rows.where(F.size("v") == (length["d"] if length else 0))
    x = F.transform("v", lambda c: (F.floor(c * SCALE) + SHIFT).cast("long"))
    out = StructType.fromDDL("ids array<long>, x binary")
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_PER_BLOCK):
                part = batch.slice(at, ROWS_PER_BLOCK)
                flat = part.column(1).flatten().to_numpy(zero_copy_only=False).astype("<i8")
                yield pa.RecordBatch.from_arrays([pa.array([part.column(0).to_pylist()], arrow.field(0).type),
                                                  pa.array([flat.tobytes()], pa.binary())], schema=arrow)

    return cut(rows.select("vec_id", x.alias("x")).mapInArrow(run, out))


def total(found: DataFrame, partial: Callable[[np.ndarray], np.ndarray], size: int, kind: str = "double") -> np.ndarray:
    """Sum over all rows of ``partial(rows of a block)``, ``size`` numbers: each
    task adds up its own blocks, one number per entry and task is shuffled."""
    ship(found.sparkSession)
    out = StructType.fromDDL(f"pos int, value {kind}")
    arrow = to_arrow_schema(out)
    dtype = np.float64 if kind == "double" else np.int64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size, dtype)
        for batch in batches:
            for ids, raw in zip(batch.column(0), batch.column(1)):
                sums += partial(np.frombuffer(raw.as_buffer(), "<i8").reshape(len(ids), -1)).reshape(-1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(sums, arrow.field(1).type)], schema=arrow)

    got = found.select("ids", "x").mapInArrow(run, out).groupBy("pos").agg(F.sum("value")).collect()
    sums = np.zeros(size, dtype)
    for pos, value in got:
        sums[pos] = value
    return sums


def minres(product: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int, enough: float) -> np.ndarray:
    """Approximate solutions of ``product(t) = b``, a symmetric, possibly
    indefinite system per column; the columns share each product."""
    tiny = np.finfo(float).tiny
    beta = np.linalg.norm(b, axis=0)
    scale = beta.copy()
    v, v_old, w, w_old, t = b / np.maximum(beta, tiny), np.zeros_like(b), np.zeros_like(b), np.zeros_like(b), np.zeros_like(b)
    c = c_old = np.ones_like(beta)
    s = s_old = np.zeros_like(beta)
    left, before = beta.copy(), beta
    for _ in range(steps):
        p = product(v)
        alpha = np.sum(v * p, axis=0)
        p = p - alpha * v - before * v_old
        after = np.linalg.norm(p, axis=0)
        delta = c * alpha - c_old * s * before
        r1 = np.maximum(np.hypot(delta, after), tiny)
        r2, r3 = s * alpha + c_old * c * before, s_old * before
        w, w_old = (v - r3 * w_old - r2 * w) / r1, w
        c, c_old, s, s_old = delta / r1, c, after / r1, s
        t = t + c * left * w
        left = -s * left
        v, v_old, before = p / np.maximum(after, tiny), v, after
        if np.all((np.abs(left) <= enough * scale) | (after <= 1e-14 * np.abs(alpha))):
            break
    return t


def orthonormal(t: np.ndarray, against: np.ndarray) -> np.ndarray:
    """The part of the columns outside ``against``, orthonormal; columns that
    lie inside are left out."""
    kept = against
    for col in t.T:
        size = np.linalg.norm(col)
        if not size:
            continue
        col = col / size
        for _ in range(3):
            col = col - kept @ (kept.T @ col)
            size = np.linalg.norm(col)
            if size < 1e-10:
                break
            col = col / size
        if size >= 1e-10:
            kept = np.column_stack((kept, col))
    return kept[:, against.shape[1]:]


def leading_pairs(product: Callable[[np.ndarray], np.ndarray], d: int, k: int, steps: int = 6,
                  rounds: int = 200, precision: float = 64 * np.finfo(float).eps) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues and unit eigenvectors of a symmetric
    matrix known by its products, until every residual is below ``precision``
    times the largest eigenvalue. Rounding may keep a residual just above it:
    when three rounds bring no better one, the best found is taken if it is
    within 100 times that bound, else it is an error."""
    full = min(d, max(6 * k, k + 24))
    u = np.linalg.qr(np.random.default_rng(12).standard_normal((d, min(d, 2 * k))))[0]
    au = product(u)
    best, stale = np.inf, 0
    for _ in range(rounds):
        h = u.T @ au
        value, turn = np.linalg.eigh((h + h.T) / 2)
        turn = turn[:, ::-1]
        value, x, ax = value[::-1][:k], u @ turn[:, :k], au @ turn[:, :k]
        r = ax - x * value
        size = np.linalg.norm(r, axis=0) / max(value[0], np.finfo(float).tiny)
        worst = float(size.max()) if value[0] > 0 else 0.0
        stale = stale + 1 if worst >= best / 2 else 0
        best = min(best, worst)
        if worst <= precision or (stale >= 3 and worst <= 100 * precision):
            return value, np.linalg.qr(x)[0] * np.sign(np.sum(np.linalg.qr(x)[0] * x, axis=0))
        active = size > precision  # the others are locked

        def projected(t: np.ndarray) -> np.ndarray:
            t = t - x @ (x.T @ t)
            y = product(t) - t * value[active]
            return y - x @ (x.T @ y)

        t = minres(projected, -(r - x @ (x.T @ r))[:, active], steps, 1e-2)
        if u.shape[1] + active.sum() > full and u.shape[1] < d:
            keep = min(u.shape[1], 3 * k)
            u = np.linalg.qr(u @ turn[:, :keep])[0]
            au = product(u)
        t = orthonormal(t if u.shape[1] < d else np.zeros((d, 0)), u)
        if t.shape[1]:
            u, au = np.column_stack((u, t)), np.column_stack((au, product(t)))
        else:
            u = np.linalg.qr(u @ turn)[0]
            au = product(u)
    raise ArithmeticError(f"residuals stay at {best:.1e} of the largest eigenvalue")


def fit(found: DataFrame, k: int = 8) -> Fit:
    """Sums, trace and leading ``k`` eigenpairs of the covariance matrix of the
    blocks, by products only."""
    head = found.select(F.sum(F.size("ids")).alias("n"), F.max(F.octet_length("x") / F.size("ids") / 8).alias("d")).first()
    n, d = int(head["n"] or 0), int(head["d"] or 0)
    if not n or not d:
        return Fit(n, np.zeros(d, np.int64), np.zeros((d, 0)), np.zeros(0), 0.0)
    sums = total(found, lambda x: x.sum(0), d, "long")
    mean = sums / n

    def product(q: np.ndarray) -> np.ndarray:
        def partial(x: np.ndarray) -> np.ndarray:
            y = x - mean
            return y.T @ (y @ q)

        return total(found, partial, q.size).reshape(q.shape) / n if q.size else q

    trace = float(total(found, lambda x: np.array([((x - mean) ** 2).sum()]), 1)[0]) / n
    if not trace:
        return Fit(n, sums, np.zeros((d, 0)), np.zeros(0), 0.0)
    value, vector = leading_pairs(product, d, min(k, d))
    real = value > 1e-12 * value[0]
    return Fit(n, sums, vector[:, real], value[real], trace)


def identity_error(found: DataFrame, model: Fit) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the
    identity matrix."""
    k = len(model.values)
    if not k:
        return 0.0
    middle = total(found, lambda x: model.whiten(x).sum(0), k) / model.n

    def partial(x: np.ndarray) -> np.ndarray:
        z = model.whiten(x) - middle
        return z.T @ z

    return float(np.abs(total(found, partial, k * k).reshape(k, k) / model.n - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum over the dimensions of (n * x - sum) squared, exactly."""
    y = n * x - sums
    rough = (y.astype(float) ** 2).sum(1)
    exact = (y * y).sum(1)
    out: list[int | None] = exact.tolist()
    for i in np.flatnonzero(rough > 2.0 ** 62).tolist():
        whole = sum(v * v for v in y[i].tolist())
        out[i] = whole if whole < 2 ** 63 else None
    return out


def whitened(found: DataFrame, model: Fit) -> DataFrame:
    """Per row and component (SCHEMA): the row's squared deviation and its
    coordinate on the component in units of that component's spread."""
    ship(found.sparkSession)
    out = StructType.fromDDL(SCHEMA)
    arrow = to_arrow_schema(out)
    k = len(model.values)
    explained = model.values / model.trace if k else model.values

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = np.frombuffer(raw.as_buffer(), "<i8").reshape(len(ids), -1)
                rows = np.repeat(np.arange(len(ids)), k)
                part = np.tile(np.arange(k), len(ids))
                cols = [pa.array(ids, pa.int64()).take(pa.array(rows)), pa.array(part + 1, pa.int32()),
                        pa.array(np.full(len(rows), model.n), pa.int64()),
                        pa.array(deviations(x, model.n, model.sums), pa.int64()).take(pa.array(rows)),
                        pa.array(model.whiten(x).reshape(-1)), pa.array(explained[part])]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, arrow)], schema=arrow)

    return (found if k else found.limit(0)).mapInArrow(run, out)
