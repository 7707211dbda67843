"""Whitening of embeddings by the leading components of their covariance.

Entries become whole numbers, so counts and sums are exact whatever the order of adding
up.  The covariance is summed by tasks from vectors that are already centred, over each
distinct vector once; equal vectors collapse map-side before they are exchanged.  Only
the square matrix of the dimensions reaches the driver.

Defined results: a row whose vector is null, or holds a null or an entry that is not
finite, is dropped, as is one whose length is not that of most rows (of the longer, if
tied).  A null or repeated ``vec_id`` is a row like any other.  Components whose share of
the variance is no more than rounding (``LEAST_SHARE`` of the first) don't exist, so an empty
table, a single vector or only equal ones give no rows, and fewer than 16 dimensions give
fewer components.  An entry of 2^53 or more, or a deviation beyond 64 bits, is an error.
Other columns are left out, whatever their names; texts don't occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import eigen
from tidemark.session import staged

COMPONENTS = 16
SCALE, SHIFT = 64.0, 1_000_000
LEAST_SHARE = 1e-10
_LARGEST = float(1 << 53)


@dataclass
class Whitening:
    """What a projection needs; its size follows from the dimensions alone."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        return self.n * x - self.sums

    def whitened(self, exact: np.ndarray) -> np.ndarray:
        return (exact / self.n) @ self.vectors / np.sqrt(self.values)


def whole_numbers(df: DataFrame, vector: str, keep: list[Column]) -> DataFrame:
    """``keep`` and ``x`` (array<long>) of the rows with a usable vector."""
    entries = F.col(f"`{vector}`").cast("array<double>")
    usable = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    ok = F.coalesce(usable, F.lit(False))
    whole = F.transform(
        entries,
        lambda c: F.when(F.abs(c * SCALE) < _LARGEST, F.floor(c * SCALE) + SHIFT).otherwise(
            F.raise_error(F.lit("an entry is too large to be whitened exactly")).cast("bigint")
        ),
    )
    rows = df.where(ok).select(*keep, whole.alias("x"))
    common = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("x") == (common["d"] if common else 0))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of equally long lists as a matrix."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per dimension: how many vectors and their sum."""
    n, total = 0, None
    for batch in batches:
        x = _matrix(batch.column(0))
        if len(x):
            n += len(x)
            total = x.sum(0) if total is None else total + x.sum(0)
    if n:
        yield pa.RecordBatch.from_pydict(
            {"i": np.arange(len(total), dtype=np.int32), "n": np.full(len(total), n, np.int64), "total": total}
        )


def _products(rows_of):
    """Per task the matrix of products of ``rows_of(x)``, a row of it per record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = None
        for batch in batches:
            x = _matrix(batch.column(0))
            if len(x):
                y = rows_of(x)
                gram = y.T @ y if gram is None else gram + y.T @ y
        if gram is not None:
            yield pa.RecordBatch.from_pydict(
                {
                    "i": pa.array(np.arange(len(gram)), pa.int32()),
                    "products": pa.array(list(gram), pa.list_(pa.float64())),
                }
            )

    return run


def _added(table: pa.Table) -> pa.Table:
    products = _matrix(table["products"].combine_chunks()).sum(0)
    return pa.table({"i": table["i"][:1], "products": pa.array([products], pa.list_(pa.float64()))})


def _covariance(fit: DataFrame, n: int, rows_of) -> np.ndarray:
    """Second moments of centred rows; rows of the matrix are added up by Spark tasks."""
    parts = fit.mapInArrow(_products(rows_of), "i int, products array<double>")
    rows = parts.groupBy("i").applyInArrow(_added, "i int, products array<double>").collect()
    matrix = np.array([r["products"] for r in sorted(rows, key=lambda r: r["i"])])
    return (matrix + matrix.T) / (2 * n)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening learned from the distinct ``x`` of ``rows``; None without variance."""
    spark = rows.sparkSession
    distinct = staged(rows.select("x").distinct(), "fit-list")
    # a matrix comes from every task, so there need be no more tasks than cores
    distinct = distinct.coalesce(max(1, 2 * spark.sparkContext.defaultParallelism))
    sums = distinct.mapInArrow(_sums, "i int, n long, total long").groupBy("i")
    sums = sorted(sums.agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect(), key=lambda r: r["i"])
    if not sums:
        return None
    n = sums[0]["n"]
    learned = Whitening(n, np.array([r["total"] for r in sums], np.int64), np.ones(0), np.ones((0, 0)), 0.0)
    covariance = _covariance(distinct, n, lambda x: learned.centred(x) / n)
    learned.trace = float(np.trace(covariance))
    if not learned.trace:
        return None
    values, vectors = eigen.leading(covariance, components)
    real = values > LEAST_SHARE * values[0]
    learned.values, learned.vectors = values[real], vectors[:, real]
    again = _covariance(distinct, n, lambda x: learned.whitened(learned.centred(x)))
    learned.identity_error = float(np.max(np.abs(again - np.eye(len(learned.values)))))
    return learned


def _squared(exact: np.ndarray) -> np.ndarray:
    """Sums of squares per row, exact in 64 bits."""
    largest = int(np.abs(exact).max(initial=0))
    if exact.shape[1] * largest * largest < 1 << 63:
        return (exact * exact).sum(1)
    sums = [sum(int(v) * int(v) for v in row) for row in exact]
    if max(sums) >= 1 << 63:
        raise OverflowError("a deviation does not fit into 64 bits")
    return np.array(sums, np.int64)


def _projection(model: Whitening):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                exact = model.centred(_matrix(part.column(1)))
                m = len(exact)
                picked = pa.array(np.repeat(np.arange(m), k))
                columns = {
                    part.schema.names[0]: part.column(0).take(picked),
                    "component": np.tile(np.arange(1, k + 1, dtype=np.int32), m),
                    "n": np.full(m * k, model.n, np.int64),
                    "deviation": np.repeat(_squared(exact), k),
                    "whitened": model.whitened(exact).ravel(),
                    "explained": np.tile(model.values / model.trace, m),
                    "identity_error": np.full(m * k, model.identity_error),
                }
                yield pa.RecordBatch.from_pydict(columns)

    return run


def project(rows: DataFrame, model: Whitening) -> DataFrame:
    """A row per row of ``rows`` (an id and ``x``) and component."""
    schema = (
        f"vec_id {rows.schema[0].dataType.simpleString()}, component int, n long, deviation long, "
        "whitened double, explained double, identity_error double"
    )
    return rows.mapInArrow(_projection(model), schema)


def whitened(df: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    rows = whole_numbers(df, vector, [F.col(f"`{vec_id}`").alias("vec_id")])
    model = fit(rows, components)
    if model is None:
        nothing = Whitening(1, np.zeros(1, np.int64), np.ones(0), np.ones((1, 0)), 1.0)
        return project(rows.where("false"), nothing)
    return project(rows, model)
