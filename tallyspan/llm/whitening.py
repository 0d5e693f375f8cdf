"""Embedding whitening with distributed block matrices.

1. Components are integers; their count and sums per dimension are exact, and so is each row's deviation.
2. Centred rows get consecutive numbers and become blocks of a ``BlockMatrix``. Its transpose times itself is the
   scatter matrix; the product is split along the rows, so that a task multiplies a few blocks only and the sums
   meet in one matrix of dimension squared.
3. That matrix alone comes to the driver, where ``eigh`` takes it apart.
4. The blocks times the whitening matrix are the projected rows; their own transposed product says how far their
   covariance is from the identity.

A block matrix numbers its rows with 32 bits, so more rows are worked on in panels; the scatter matrices of panels
add up. Rows stay in the JVM: neither blocks nor products pass through Python.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, functions as F

from tallyspan.llm.numbered import numbered
from tallyspan.session import materialise

ROWS_PER_BLOCK = 4096
COLUMNS_PER_BLOCK = 1024
BLOCKS_PER_TASK = 8
PANEL_ROWS = 1 << 30


@dataclass
class Whitening:
    """What was fitted on ``n`` rows: sums of the integers, and eigenvalues and unit eigenvectors of their covariance.

    ``vectors`` has a column per component, in falling order of eigenvalues; a component without variance has no
    direction of its own and projects to null. ``identity_error`` is measured on the projected rows.
    """

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if self.trace > 0 else np.full(len(self.values), np.nan)


def integers(vectors: DataFrame, scale: int, offset: int) -> DataFrame:
    """(vec_id, x): floor(scale * c) + offset of all vectors without null or non-finite entries; empty ones have no components."""
    c = F.col("embedding").cast("array<double>")
    fine = (F.size(c) > 0) & F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.where(fine).select(F.col("vec_id"), F.transform(c, lambda v: F.floor(v * scale).cast("long") + offset).alias("x"))


def _task_sums(batches):
    """(dims, d, n, s): rows and exact sums per dimension of a task."""
    held: dict[int, list] = {}
    for batch in batches:
        sizes = np.array(batch.column(0).value_lengths())
        for dims in np.unique(sizes):
            own = batch.column(0).filter(pa.array(sizes == dims))
            total = own.flatten().to_numpy(zero_copy_only=False).reshape(len(own), -1).sum(axis=0)
            before = held.setdefault(int(dims), [0, np.zeros(int(dims), np.int64)])
            before[0] += len(own)
            before[1] += total
    for dims, (n, s) in held.items():
        yield pa.RecordBatch.from_pydict(
            {"dims": pa.array([dims] * dims, pa.int64()), "d": pa.array(np.arange(dims)), "n": pa.array([n] * dims, pa.int64()), "s": pa.array(s)}
        )


def _blocks(rows: DataFrame, n: int, dims: int) -> BlockMatrix:
    """Blocks of the rows (number, v) with numbers below ``n``."""
    indexed = MLUtils.convertVectorColumnsFromML(rows.select(F.col("number").alias("index"), array_to_vector("v").alias("vector")), "vector")
    return IndexedRowMatrix(indexed, n, dims).toBlockMatrix(ROWS_PER_BLOCK, min(dims, COLUMNS_PER_BLOCK))


def _gram(m: BlockMatrix, n: int) -> np.ndarray:
    """The transpose of ``m`` times ``m``; the rows are cut so that a task holds a few blocks of each side."""
    splits = max(1, math.ceil(n / (ROWS_PER_BLOCK * BLOCKS_PER_TASK)))
    product = m.transpose()._java_matrix_wrapper.call("multiply", m._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, m.colsPerBlock, m.colsPerBlock).toLocalMatrix().toArray()


def _local(spark, matrix: np.ndarray, rows_per_block: int) -> BlockMatrix:
    """A small matrix as blocks."""
    width = min(matrix.shape[1], COLUMNS_PER_BLOCK)
    parts = []
    for i in range(0, matrix.shape[0], rows_per_block):
        for j in range(0, matrix.shape[1], width):
            part = matrix[i : i + rows_per_block, j : j + width]
            parts.append(((i // rows_per_block, j // width), Matrices.dense(*part.shape, part.ravel(order="F"))))
    return BlockMatrix(spark.sparkContext.parallelize(parts, 1), rows_per_block, width, *matrix.shape)


def _panels(rows: DataFrame, n: int):
    """(rows of a panel, numbered from 0; how many; number of its first)."""
    for first in range(0, n, PANEL_ROWS):
        size = min(PANEL_ROWS, n - first)
        own = rows if size == n else rows.where(F.col("number").between(first, first + size - 1)).withColumn("number", F.col("number") - first)
        yield own, size, first


def fit(rows: DataFrame, n: int, sums: np.ndarray, components: int) -> Whitening:
    """From centred rows (number, v) and what they were centred by."""
    dims = len(sums)
    scatter = sum(_gram(_blocks(own, size, dims), size) for own, size, _ in _panels(rows, n))
    covariance = (scatter + scatter.T) / (2 * n)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    held = min(components, dims)
    return Whitening(n, sums, np.maximum(values[:held], 0.0), vectors[:, :held], float(np.trace(covariance)))


def project(rows: DataFrame, fitted: Whitening) -> DataFrame:
    """(number, whitened) of centred rows (number, v): the components with variance, in order. Sets ``identity_error``."""
    spark = rows.sparkSession
    dims = len(fitted.sums)
    # below that an eigenvalue is rounding of the largest one
    real = int((fitted.values > dims * np.finfo(np.float64).eps * fitted.values.max(initial=0.0)).sum())
    if not real:
        fitted.identity_error = 0.0
        return rows.select("number", F.array().cast("array<double>").alias("whitened"))
    by = _local(spark, fitted.vectors[:, :real] / np.sqrt(fitted.values[:real]), min(dims, COLUMNS_PER_BLOCK))
    out, scatter = None, np.zeros((real, real))
    for own, size, first in _panels(rows, fitted.n):
        projected = _blocks(own, size, dims).multiply(by)
        scatter += _gram(projected, size)
        found = callMLlibFunc("getIndexedRows", projected.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
        found = found.select((F.col("index") + first).alias("number"), vector_to_array("vector").alias("whitened"))
        out = found if out is None else out.unionByName(found)
    fitted.identity_error = float(np.abs(scatter / fitted.n - np.eye(real)).max())
    return out


def whiten(vectors: DataFrame, components: int = 32, scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """(vec_id, n, deviation, whitened, explained, identity_error) per vector, ``whitened`` and ``explained`` as arrays
    over the components. Runs jobs when called.

    Null vectors, empty ones, and those with null or non-finite entries take no part. Vectors of different length have
    no common covariance: each length is a fit of its own. Rows that repeat, also under one id or a null one, each count
    and each have a row. A component without variance (fewer rows than dimensions, or all alike) is null in ``whitened``.
    Equal eigenvalues have any basis of their space. A deviation beyond 64 bits fails. Other columns are ignored; an
    empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = numbered(integers(vectors, scale, offset), "number")
    found = rows.select("x").mapInArrow(_task_sums, "dims long, d long, n long, s long").groupBy("dims", "d").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    lengths: dict[int, list] = {}
    for r in found.orderBy("dims", "d").collect():  # one row per dimension
        lengths.setdefault(r["dims"], []).append((r["n"], r["s"]))
    out = None
    for dims, facts in lengths.items():
        n, sums = facts[0][0], np.array([s for _, s in facts], np.int64)
        own = rows if len(lengths) == 1 else numbered(rows.where(F.size("x") == dims).drop("number"), "number")
        apart = F.zip_with("x", F.lit(sums.tolist()).cast("array<long>"), lambda x, s: x * n - s)
        own = own.withColumn("apart", apart)
        deviation = F.aggregate("apart", F.lit(0).cast("long"), lambda t, a: t + a * a)
        own = materialise(own.select("number", "vec_id", F.transform("apart", lambda a: a / n).alias("v"), deviation.alias("deviation")), "centred")
        fitted = fit(own, n, sums, components)
        projected = materialise(project(own, fitted), "projected")
        held = len(fitted.values)
        padded = F.concat("whitened", F.array_repeat(F.lit(None).cast("double"), F.lit(held) - F.size("whitened")))
        explained = F.lit([None if math.isnan(x) else float(x) for x in fitted.explained]).cast("array<double>")
        found = own.join(projected, "number").select(
            "vec_id", F.lit(n).cast("long").alias("n"), "deviation", padded.alias("whitened"), explained.alias("explained"),
            F.lit(fitted.identity_error).alias("identity_error"),
        )
        out = found if out is None else out.unionByName(found)
    if out is None:
        kind = vectors.schema["vec_id"].dataType.simpleString()
        return spark.createDataFrame([], f"vec_id {kind}, n long, deviation long, whitened array<double>, explained array<double>, identity_error double")
    return out


def components_of(whitened: DataFrame) -> DataFrame:
    """One row per vector and component: (vec_id, component, n, deviation, whitened, explained, identity_error)."""
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("component", "c")
    return whitened.select("vec_id", "n", "deviation", "identity_error", each).select(
        "vec_id", (F.col("component") + 1).alias("component"), "n", "deviation", F.col("c.whitened").alias("whitened"),
        F.col("c.explained").alias("explained"), "identity_error",
    )
