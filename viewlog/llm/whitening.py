"""Whitening of vectors by their covariance, found by polarisation from squared sums alone.

Var(a + b) = Var(a) + Var(b) + 2 Cov(a, b): so the sums of squares of every dimension and of every sum
of two dimensions give all covariances as differences of variances. Components are whole numbers, so
the sums are exact whatever the order and however often a task is retried, and the differences lose
nothing. Values are centred before they are squared. With n rows and a sum S of a dimension, a centred
value is n*x - S; as S = n*m + r with a whole m and 0 <= r < n, that is n*(x - m) - r, and

    sum of (n*(x - m) - r)**2  =  n**2 * sum of (x - m)**2  -  n * r**2

since the values x - m add up to r. Tasks square and add x - m, small numbers; the rest is done with
whole numbers of any length on the d * (d + 1) / 2 totals. Their matrix goes through ``eigh``.

Three scans of the stored vectors: sums, squares, and the check that whitened rows have a unit covariance.
Each task sends one row per total, and those are added by a shuffle; nothing grows with the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from viewlog.llm.tables import stored
from viewlog.llm.whole_vectors import whole_vectors

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 32
MOST = 1 << 40  # a component's size before the offset
SAFE = 1 << 62
LONGEST = (1 << 63) - 1
EXACT = pa.decimal128(38, 0)
VALUES = T.StructType([
    T.StructField("component", T.IntegerType()),
    T.StructField("n", T.LongType()),
    T.StructField("deviation", T.LongType()),
    T.StructField("whitened", T.DoubleType()),
    T.StructField("explained", T.DoubleType()),
    T.StructField("identity_error", T.DoubleType()),
])


@dataclass(frozen=True)
class Model:
    """What whitening a row needs; ``vectors`` holds a unit eigenvector per row."""

    rows: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def whole(self) -> np.ndarray:
        return np.array([total // self.rows for total in self.sums], dtype=np.int64)

    @property
    def rest(self) -> list[int]:
        return [total % self.rows for total in self.sums]


def _matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index("x"))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _totals(rows: DataFrame, size: int, count: int, add: Callable[[np.ndarray], np.ndarray], exact: bool) -> list:
    """Sums over all rows of the ``count`` totals that ``add`` gives for a block of rows."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(count, dtype=object if exact else np.float64)
        for batch in batches:
            if batch.num_rows:
                total = total + add(_matrix(batch, size))
        values = pa.array([Decimal(int(value)) for value in total], EXACT) if exact else pa.array(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(count, dtype=np.int32)), values], ["at", "value"])

    kind = "decimal(38,0)" if exact else "double"
    found = rows.select("x").mapInArrow(partial, f"at int, value {kind}").groupBy("at").agg(F.sum("value").alias("value"))
    out = [0] * count
    for at, value in found.collect():  # one row per total
        out[at] = int(value) if exact else value
    return out


def _peak(block: np.ndarray) -> int:
    return max(abs(int(block.max())), abs(int(block.min())))


def plain_sums(block: np.ndarray) -> np.ndarray:
    if _peak(block) * len(block) >= SAFE:
        block = block.astype(object)
    return block.sum(axis=0).astype(object)


def squared_sums(block: np.ndarray) -> np.ndarray:
    """Sums over the rows of the squares of every column, then of the sum of every pair of columns."""
    columns = np.ascontiguousarray(block.T)
    if 4 * _peak(block) ** 2 * len(block) >= SAFE:  # whole numbers of any length where 64 bits might not do
        columns = columns.astype(object)
    out = [(columns * columns).sum(axis=1)]
    for n in range(len(columns) - 1):
        pairs = columns[n + 1:] + columns[n]
        out.append((pairs * pairs).sum(axis=1))
    return np.concatenate(out).astype(object)


def covariance(rows: int, rest: list[int], squares: list[int]) -> np.ndarray:
    """Covariances from the sums of squares of centred values; each is rounded once, at the end."""
    size = len(rest)
    own = [rows * squares[n] - rest[n] ** 2 for n in range(size)]
    out, at = np.zeros((size, size)), size
    for n in range(size):
        out[n, n] = own[n] / rows**2
        for other in range(n + 1, size):
            both = rows * squares[at] - (rest[n] + rest[other]) ** 2
            out[n, other] = out[other, n] = (both - own[n] - own[other]) / (2 * rows**2)
            at += 1
    return out


def fit(rows: DataFrame, size: int) -> Model:
    """The model of stored whole vectors ``x``, all of ``size`` components."""

    def counted(block: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(block)], plain_sums(block)])

    count, *sums = _totals(rows, size, size + 1, counted, exact=True)
    whole = np.array([total // count for total in sums], dtype=np.int64)
    squares = _totals(rows, size, size * (size + 1) // 2, lambda block: squared_sums(block - whole), exact=True)
    matrix = covariance(count, [total % count for total in sums], squares)
    values, vectors = np.linalg.eigh(matrix)
    return Model(count, sums, values[::-1].copy(), vectors.T[::-1].copy(), float(np.trace(matrix)))


def centred(block: np.ndarray, model: Model) -> np.ndarray:
    """n*x - S of every component, exact."""
    apart = block - model.whole
    if model.rows * (_peak(apart) + 1) >= SAFE:
        apart = apart.astype(object)
    return apart * model.rows - np.array(model.rest, dtype=apart.dtype)


def deviations(exact: np.ndarray) -> list[int | None]:
    """Sums of squares of every row, None where they do not fit a long."""
    if _peak(exact) ** 2 * exact.shape[1] >= SAFE:
        exact = exact.astype(object)
    return [value if value <= LONGEST else None for value in map(int, (exact * exact).sum(axis=1))]


def projected(exact: np.ndarray, model: Model, components: int) -> np.ndarray:
    """Whitened rows; a component without variance is NaN."""
    values, vectors = model.values[:components], model.vectors[:components]
    varies = values > len(model.values) * np.finfo(float).eps * max(model.values[0], 0.0)
    scale = np.where(varies, 1 / np.sqrt(np.where(varies, values, 1.0)), np.nan)
    return (exact / model.rows).astype(np.float64) @ vectors.T * scale


def identity_error(rows: DataFrame, size: int, model: Model, components: int) -> float | None:
    """The largest entry by which the covariance of the whitened rows differs from the identity."""

    def moments(block: np.ndarray) -> np.ndarray:
        white = projected(centred(block, model), model, components)
        return np.concatenate([white.sum(axis=0), (white.T @ white).ravel()])

    totals = np.array(_totals(rows, size, components * (components + 1), moments, exact=False)) / model.rows
    mean, products = totals[:components], totals[components:].reshape(components, components)
    apart = np.abs(products - np.outer(mean, mean) - np.eye(components))
    return float(np.nanmax(apart)) if not np.isnan(apart).all() else None


def whiten(
    vectors: DataFrame, column: str = "embedding", scale: int = SCALE, offset: int = OFFSET, components: int = COMPONENTS,
) -> DataFrame:
    """A row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Vectors that are NULL or empty or have a component that is NULL or not finite have no rows. A
    component ``c`` becomes floor(scale * c) + offset; beyond 2**40 in size floor(scale * c) counts as
    2**40. Only vectors of one length can be compared: those of the most frequent length are fitted and
    returned, of the greater one on a tie. Shorter vectors than ``components`` have as many as they are
    long. A component without variance, as of a table with one row, has a NULL ``whitened``; without any
    variance ``explained`` and ``identity_error`` are NULL as well. A ``deviation`` that does not fit
    a long is NULL. Rows that share an id, or have none, are whitened one by one. No rows give no rows;
    other columns are ignored.
    """
    kept = whole_vectors(vectors, column, scale, MOST).where(F.size("x") > 0)
    kept = stored(kept.withColumn("x", F.transform("x", lambda value: value + offset)), "whole-vectors")
    kind = kept.schema["vec_id"].dataType
    layout = T.StructType([T.StructField("vec_id", kind), *VALUES.fields])
    lengths = kept.groupBy(F.size("x").alias("size")).count()
    longest = lengths.orderBy(F.col("count").desc(), F.col("size").desc()).first()
    if longest is None:
        return vectors.sparkSession.createDataFrame([], layout)
    size, components = longest["size"], min(components, longest["size"])
    rows = kept.where(F.size("x") == size)
    model = fit(rows, size)
    error = identity_error(rows, size, model, components)
    explained = [float(value) / model.trace if model.trace > 0 else None for value in model.values[:components]]
    arrow = to_arrow_schema(layout)

    def whitened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            exact = centred(_matrix(batch, size), model)
            white = projected(exact, model, components).ravel()
            row = np.repeat(np.arange(batch.num_rows), components)
            number = np.tile(np.arange(components, dtype=np.int32), batch.num_rows)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(row)), pa.array(number + 1), pa.array(np.full(len(row), model.rows)),
                pa.array(deviations(exact), pa.int64()).take(pa.array(row)), pa.array(white, mask=np.isnan(white)),
                pa.array(explained, pa.float64()).take(pa.array(number)),
                pa.array([error], pa.float64()).take(pa.array(np.zeros(len(row), dtype=np.int32))),
            ], schema=arrow)

    return rows.select("vec_id", "x").mapInArrow(whitened, layout)
