"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its triangular factor."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from millwatch.llm.common import table
from millwatch.session import ship

#: A component c counts as the whole number floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Rows multiplied at once.
ROWS = 4096
#: Sweeps over all pairs of columns at most; convergence is quadratic, so a handful do.
SWEEPS = 60


def usable(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there and holds finite numbers only."""
    return df.where(F.col(vector).isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))))


def whole(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of whole numbers; a shorter one ends as if in zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype("float64")).astype("int64")
    out = np.zeros((len(column), width), "int64")
    out[np.arange(width) < sizes[:, None]] = flat
    return out + SHIFT


def _sums(df: DataFrame, vector: str, emit: Callable[[pa.Array], dict[int, int] | np.ndarray], size: int, kind: str) -> list:
    """Sums over all rows of ``size`` figures, one row a task and figure."""
    exact = kind != "double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, object if exact else "float64")
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                total = total + emit(batch.column(0).slice(at, ROWS))
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(list(total), pa.decimal128(38, 0) if exact else pa.float64())], names=["i", "x"])

    sums = df.select(F.col(vector).alias("v")).mapInArrow(run, f"i int, x {kind}").groupBy("i").agg(F.sum("x").alias("x")).collect()
    out = [0] * size
    for row in sums:
        out[row["i"]] = float(row["x"]) if not exact else int(row["x"])
    return out


def _products(x: np.ndarray) -> np.ndarray:
    """x'x of whole numbers, exact: in doubles while sums stay below 2**53, else in fewer rows, at last as Python's integers."""
    most = int(np.abs(x).max(initial=0))
    if most * most * len(x) < 1 << 53:
        y = x.astype("float64")
        return (y.T @ y).astype("int64").astype(object)
    if len(x) > 1:
        half = len(x) // 2
        return _products(x[:half]) + _products(x[half:])
    return np.outer(x[0].astype(object), x[0].astype(object))


def pivoted_cholesky(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower trapezoidal L and the order of rows p with v[p][:, p] = L L', as many columns as ``v`` has rank."""
    n = len(v)
    order, left, factor, k = np.arange(n), np.diag(v).copy(), np.zeros((n, n)), 0
    least = n * np.finfo(float).eps * left.max(initial=0.0)
    while k < n:
        pivot = k + int(left[k:].argmax())
        if left[pivot] <= least:
            break
        for a in (order, left, factor):
            a[[k, pivot]] = a[[pivot, k]]
        root = np.sqrt(left[k])
        factor[k, k] = root
        factor[k + 1:, k] = (v[order[k + 1:], order[k]] - factor[k + 1:, :k] @ factor[k, :k]) / root
        left[k + 1:] -= factor[k + 1:, k] ** 2
        k += 1
    return factor[:, :k], order


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """The columns of ``factor`` rotated in pairs until all are orthogonal.

    Each round of a sweep rotates disjoint pairs at once, dealt like the games of a tournament.
    """
    a = factor.copy()
    n = a.shape[1]
    ring = list(range(n)) + [-1] * (n % 2)
    for _ in range(SWEEPS):
        worst = 0.0
        for _ in range(len(ring) - 1):
            games = [(min(p, q), max(p, q)) for p, q in zip(ring[:len(ring) // 2], ring[:len(ring) // 2 - 1:-1]) if p >= 0 and q >= 0]
            ring = [ring[0], ring[-1], *ring[1:-1]]
            p, q = (np.array(c) for c in zip(*games))
            x, y = a[:, p], a[:, q]
            alpha, beta, gamma = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            size = np.sqrt(alpha * beta)
            off = np.divide(np.abs(gamma), size, out=np.zeros_like(size), where=size > 0)
            worst = max(worst, off.max(initial=0.0))
            turn = off > 1e-17
            zeta = np.divide(beta - alpha, 2 * gamma, out=np.zeros_like(size), where=turn)
            tan = np.where(turn, np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            cos = 1 / np.hypot(1.0, tan)
            sin = cos * tan
            a[:, p], a[:, q] = cos * x - sin * y, sin * x + cos * y
        if worst < 1e-15:
            break
    return a


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues above rounding error, falling, and their unit eigenvectors as columns, the largest entry of each positive."""
    factor, order = pivoted_cholesky(v)
    if not factor.shape[1]:
        return np.zeros(0), np.zeros((len(v), 0))
    rotated = one_sided_jacobi(factor) if factor.shape[1] > 1 else factor
    norms = np.sqrt((rotated * rotated).sum(0))
    by = np.argsort(-norms, kind="stable")
    by = by[norms[by] ** 2 > len(v) * np.finfo(float).eps * norms.max() ** 2]
    vectors = np.empty((len(v), len(by)))
    vectors[order] = rotated[:, by] / norms[by]
    sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(len(by))])
    return norms[by] ** 2, vectors * sign


@dataclass(frozen=True)
class Whitening:
    """``n`` vectors with sums ``sums`` (whole numbers): components as columns by falling eigenvalue, and the trace of the covariance."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @property
    def middle(self) -> np.ndarray:
        """The mean, rounded to whole numbers: subtracting it is exact."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], "int64")

    @property
    def rest(self) -> np.ndarray:
        """The mean less ``middle``."""
        return np.array([(s - self.n * int(m)) / self.n for s, m in zip(self.sums, self.middle)])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.middle) - self.rest) @ self.components / np.sqrt(self.eigenvalues)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - sum)**2, exact; more than 64 bits are an error."""
        gap, shift = x - self.middle, [s - self.n * int(m) for s, m in zip(self.sums, self.middle)]
        most = int(np.abs(gap).max(initial=0)) * self.n + max(map(abs, shift), default=0)
        kind = "int64" if most * most * len(shift) < 1 << 63 else object
        gap = gap.astype(kind) * self.n - np.array(shift, kind)
        return [int(d) for d in (gap * gap).sum(1)]


def fit(df: DataFrame, vector: str = "embedding", k: int = 32) -> Whitening | None:
    """Mean, components and eigenvalues of all usable vectors; None without any.

    Two goes over the rows: one sums, one multiplies what is left after the rounded mean is taken off. Both are
    sums of whole numbers, so order and partitions change nothing; the driver holds a square of the width.
    """
    ship(df.sparkSession)
    rows = usable(df, vector)
    n, width = rows.agg(F.count("*"), F.max(F.size(vector))).first()
    if not n:
        return None
    sums = _sums(rows, vector, lambda v: np.array([int(s) for s in whole(v, width).sum(0)], object), width, "decimal(38,0)") if width else []
    model = Whitening(n, sums, np.zeros((width, 0)), np.zeros(0), 0.0)
    middle = model.middle
    above = np.triu_indices(width)
    scatter = _sums(rows, vector, lambda v: _products(whole(v, width) - middle)[above], len(above[0]), "decimal(38,0)") if width else []
    shift = [s - n * int(m) for s, m in zip(sums, middle)]
    v = np.zeros((width, width))
    for i, j, s in zip(*(a.tolist() for a in above), scatter):
        v[i, j] = v[j, i] = (n * s - shift[i] * shift[j]) / (n * n)
    values, vectors = eigen(v) if width else (np.zeros(0), np.zeros((0, 0)))
    return Whitening(n, sums, vectors[:, :k], values[:k], float(np.trace(v)))


def transform(df: DataFrame, model: Whitening, vector: str = "embedding") -> DataFrame:
    """Usable rows with ``deviation`` (from the mean, times n, squared; exact) and ``whitened`` (one number for each component).

    Other columns pass unchanged; only those called ``deviation`` or ``whitened`` are replaced. Vectors that
    are null or hold null or non-finite entries are dropped with their rows; a shorter vector counts as ending in zeros, a
    longer one than the fit had is an error.
    """
    ship(df.sparkSession)
    width = len(model.sums)
    rows = usable(df, vector)
    own = [c for c in df.columns if c not in ("deviation", "whitened")]
    rows = rows.select(F.struct(*(F.col(f"`{c}`") for c in own)).alias("row"), F.col(vector).alias("v"))
    schema = T.StructType([rows.schema["row"], T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for all_rows in batches:
            for at in range(0, all_rows.num_rows, ROWS):
                batch = all_rows.slice(at, ROWS)
                x = whole(batch.column("v"), width)
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(model.deviations(x), pa.int64()), pa.array(list(model.whitened(x)), pa.list_(pa.float64()))],
                                                 names=["row", "deviation", "whitened"])

    out = rows.mapInArrow(run, schema)
    return out.select(*(F.col("row")[c].alias(c) for c in own), "deviation", "whitened")


def identity_error(df: DataFrame, model: Whitening, vector: str = "embedding") -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity, measured on all rows."""
    ship(df.sparkSession)
    width, k = len(model.sums), len(model.eigenvalues)
    if not k:
        return 0.0

    def moments(v: pa.Array) -> np.ndarray:
        w = model.whitened(whole(v, width))
        return np.concatenate([w.sum(0), (w.T @ w).ravel()])

    sums = np.array(_sums(usable(df, vector), vector, moments, k + k * k, "double")) / model.n
    return float(np.abs(sums[k:].reshape(k, k) - np.outer(sums[:k], sums[:k]) - np.eye(k)).max())


def whiten(df: DataFrame, vector: str = "embedding", k: int = 32) -> tuple[DataFrame | None, Whitening | None, float]:
    """Whitened rows, the model fitted on them, and how far their covariance is from the identity.

    All rows with a usable vector count, also repeated ones and those without id. Components are as many as the
    covariance has rank, ``k`` at most: equal vectors alone, or a single one, give none. No rows, no model.
    """
    model = fit(df, vector, k)
    if model is None:
        return None, None, 0.0
    return transform(df, model, vector), model, identity_error(df, model, vector)


def op13_whitening(spark, sf_dir):
    rows, model, error = whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if rows is None:
        return spark.createDataFrame([], schema)
    explained = F.array(*(F.lit(float(e / model.trace)) for e in model.eigenvalues)) if len(model.eigenvalues) else F.lit(None).cast("array<double>")
    one = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return one.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                      F.element_at(explained, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"))
