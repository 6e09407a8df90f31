"""Whitening of embeddings by shifted CholeskyQR.

Each entry c becomes the whole number floor(scale * c) + shift. The fit list is
each distinct whole-number vector once. Centred rows A are made orthogonal by
passes over the fit list: tasks solve with the triangular factors found so far
and sum the Gram matrix of what comes out; the driver factors it, the first time
with a shift that keeps it positive definite. After a few passes A = Q R with an
orthogonal Q and R the product of the factors; the singular value decomposition
of R gives the components and their eigenvalues. One more pass measures the
covariance of the whitened rows.

The driver holds matrices of dim x dim, whatever the number of rows. Means are
exact: sums are kept as whole numbers, and rows are centred on whole numbers
before anything is multiplied. Partial matrices are added by matrix row and group
of tasks, in task order.

Stated cases. Vectors that are NULL, empty, or hold NULL or non-finite entries,
or entries beyond 2**53 after scaling, take no part, nor do those of another
length than the commonest (the longest of equally common ones). Repeated vectors
count once in the fit and each gets its row. Constant dimensions have weight 0.
Components whose eigenvalue is 0 up to rounding are left out, so there may be
fewer than asked for, none at all for a table with one distinct vector or none.
Ties of eigenvalues come in either order. ``deviation`` is NULL where it is
beyond 64 bits. Given columns with the names of the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm.common import fresh, written

UNIT = np.finfo(float).eps / 2


@dataclass
class Whitening:
    """A fitted transform: whole-number means ``floor`` + ``rest`` / n, weights (dim x components), and figures."""

    n: int
    scale: int
    shift: int
    floor: np.ndarray
    rest: np.ndarray
    weights: np.ndarray
    eigenvalues: np.ndarray
    explained: list[float] = field(default_factory=list)
    identity_error: float = 0.0
    passes: int = 0

    @property
    def dim(self) -> int:
        return len(self.floor)


def whole_vector(vector: str | Column, scale: int, shift: int) -> Column:
    """floor(scale * entry) + shift of each entry; NULL for a vector that takes no part."""
    v = (F.col(vector) if isinstance(vector, str) else vector).cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= F.lit(2.0 ** 53 / scale)))
    return F.when(fine & (F.size(v) > 0), F.transform(v, lambda c: F.floor(c * scale) + F.lit(shift).cast("long")))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, high, low = 0, None, None
    for batch in batches:
        x = _matrix(batch.column(0))
        if len(x):
            h, l = (x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)
            n, high, low = n + len(x), h if high is None else high + h, l if low is None else low + l
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(high), dtype=np.int32)), pa.array(high), pa.array(low),
                                          pa.array(np.full(len(high), n))], ["dim", "high", "low", "n"])


def solve(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Q with Q r = rows, for an upper triangular r."""
    q = np.ascontiguousarray(rows.T)
    for j in range(len(r)):
        if j:
            q[j] -= r[:j, j] @ q[:j]
        q[j] /= r[j, j]
    return q.T


def _centred(x: np.ndarray, model: Whitening) -> np.ndarray:
    return (x - model.floor).astype(float) - model.rest / model.n


def _partial_gram(model: Whitening, kept: np.ndarray, factors: list, weights, batches) -> Iterator[pa.RecordBatch]:
    """A task's share of the Gram matrix, one matrix row a row."""
    gram = 0.0
    for batch in batches:
        x = _matrix(batch.column(0))
        for at in range(0, len(x), 4096):
            rows = _centred(x[at:at + 4096], model)[:, kept]
            for r in factors:
                rows = solve(rows, r)
            if weights is not None:
                rows = rows @ weights
            gram = gram + rows.T @ rows
    if not np.isscalar(gram):
        task, size = TaskContext.get().partitionId(), len(gram)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(np.full(size, task, dtype=np.int32)),
                                          pa.array(list(gram))], ["i", "task", "part"])


def _add(table: pa.Table) -> pa.Table:
    """The sum of one matrix row's partial rows, in task order."""
    table = table.sort_by("task")
    total = 0.0
    for part in table.column("part").to_pylist():
        total = total + np.asarray(part)
    return pa.table({"i": table.column("i")[:1], "task": table.column("task")[:1], "part": pa.array([total])})


def _gram(fit_list: DataFrame, model: Whitening, kept, factors, weights=None) -> np.ndarray:
    form = "i int, task int, part array<double>"
    parts = fit_list.mapInArrow(lambda it: _partial_gram(model, kept, factors, weights, it), form)
    some = parts.groupBy("i", F.expr("task div 64")).applyInArrow(_add, form)
    rows = some.groupBy("i").applyInArrow(_add, form).orderBy("i").collect()
    return np.array([r["part"] for r in rows])


def fit(df: DataFrame, vector: str = "embedding", components: int = 16, scale: int = 64, shift: int = 1_000_000,
        most_passes: int = 8) -> Whitening | None:
    """The whitening transform of ``df``'s distinct vectors; None where no vector takes part."""
    vectors = df.select(whole_vector(vector, scale, shift).alias("x")).filter("x IS NOT NULL")
    common = vectors.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if common is None:
        return None
    fit_list = written(vectors.filter(F.size("x") == common["dim"]).distinct(), "whiten-fit")
    sums = (fit_list.mapInArrow(_sums, "dim int, high long, low long, n long").groupBy("dim")
            .agg(F.sum("high").alias("high"), F.sum("low").alias("low"), F.sum("n").alias("n")).orderBy("dim").collect())
    n, totals = sums[0]["n"], [(r["high"] << 32) + r["low"] for r in sums]
    model = Whitening(n, scale, shift, np.array([s // n for s in totals]), np.array([s % n for s in totals]),
                      np.zeros((len(totals), 0)), np.zeros(0))
    every = np.ones(len(totals), dtype=bool)
    gram = _gram(fit_list, model, every, [])
    trace = float(np.trace(gram))
    kept = np.diag(gram) > 0
    if not kept.any():
        return model
    gram, size = gram[np.ix_(kept, kept)], int(kept.sum())
    slack = 11 * (n * size + size * (size + 1)) * UNIT
    factors = [np.linalg.cholesky(gram + slack * np.linalg.eigvalsh(gram)[-1] * np.eye(size)).T]
    before = np.inf
    while True:
        gram = _gram(fit_list, model, kept, factors)
        error = np.abs(gram - np.eye(size)).max()
        if error < 64 * size * UNIT or len(factors) >= most_passes or error > before / 2:
            break
        before = error
        try:
            factors.append(np.linalg.cholesky(gram).T)
        except np.linalg.LinAlgError:  # still too close to singular: shift again
            factors.append(np.linalg.cholesky(gram + slack * np.linalg.eigvalsh(gram)[-1] * np.eye(size)).T)
    r = factors[0]
    for f in factors[1:]:
        r = f @ r
    if error >= 1e-8:  # dependent columns never become orthonormal: what is left of them goes into R
        values, vectors_ = np.linalg.eigh(gram)
        r = (vectors_ * np.sqrt(np.maximum(values, 0))) @ vectors_.T @ r
    _, sigma, v = np.linalg.svd(r)
    count = min(components, int((sigma > sigma[0] * np.sqrt(size) * 1e-8).sum()))
    model.eigenvalues = sigma[:count] ** 2 / n
    model.weights = np.zeros((len(totals), count))
    model.weights[kept] = v[:count].T / np.sqrt(model.eigenvalues)
    model.explained = [float(e / (trace / n)) for e in model.eigenvalues]
    model.passes = len(factors)
    covariance = _gram(fit_list, model, every, [], model.weights) / n
    model.identity_error = float(np.abs(covariance - np.eye(count)).max())
    return model


def _deviations(x: np.ndarray, model: Whitening) -> list:
    """The sum over dimensions of (n x - S)^2 of each row; None beyond 64 bits."""
    off = x - model.floor
    reach = (int(np.abs(off).max(initial=0)) + 1) * model.n
    if reach * reach * model.dim < 2 ** 63:
        y = off * model.n - model.rest
        return (y * y).sum(1).tolist()
    rest = [int(r) for r in model.rest]
    sums = [sum((int(o) * model.n - r) ** 2 for o, r in zip(row, rest)) for row in off]
    return [s if s < 2 ** 63 else None for s in sums]


def _apply(model: Whitening, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = _matrix(batch.column(batch.num_columns - 1))
        if not len(x):
            continue
        white = _centred(x, model) @ model.weights
        offsets = np.arange(len(x) + 1, dtype=np.int32) * white.shape[1]
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(white.ravel()))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(_deviations(x, model), pa.int64()), lists],
                                         [*batch.schema.names[:-1], "deviation", "whitened"])


def transform(df: DataFrame, model: Whitening | None, vector: str = "embedding") -> DataFrame:
    """The rows of ``df`` that take part, with ``deviation`` and ``whitened`` (one number a component)."""
    given = df.drop("deviation", "whitened")
    x = fresh(given, "x")
    out = T.StructType([*given.schema.fields, T.StructField("deviation", T.LongType()),
                        T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    if model is None:
        return df.sparkSession.createDataFrame([], out)
    rows = df.withColumn(x, whole_vector(vector, model.scale, model.shift)).select(*given.columns, x)
    rows = rows.filter(F.col(x).isNotNull() & (F.size(x) == model.dim))
    return rows.mapInArrow(lambda it: _apply(model, it), out)
