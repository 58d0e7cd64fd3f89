"""Whitening of embeddings by distributed block matrices.

Entries become whole numbers; the distinct vectors are the list that is fitted.
Their rows, centred and numbered, are one ``BlockMatrix``; its transpose times
itself, in as many splits of the long dimension as there are blocks to share, is
the scatter matrix.  That has the dimensions' size, so the driver decomposes it.
The same ``BlockMatrix`` times the whitening matrix projects every distinct
vector once; rows take the projection of their vector.  All of it stays in the
JVM: rows go into the matrix and come out of it as DataFrames.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import written
from sluice.operators.sizing import broadcast_if_small

#: Units of 1 in a whole number.
SCALE = 256
#: Rows of a block: with 64 dimensions a block has 1 MB.
BLOCK_ROWS = 2048
#: Blocks that one task multiplies, about.
SPLIT_BLOCKS = 8
#: Least eigenvalue that counts, as a share of the largest.
LEAST = 1e-12


@dataclass(frozen=True)
class Whitening:
    #: Distinct vectors, their sums by dimension (exact), and the largest absolute entry.
    n: int
    sums: list[int]
    largest: int
    #: Eigenvalues that count, falling; unit eigenvectors as columns; the covariance's trace.
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def matrix(self) -> np.ndarray:
        """Dimensions x components."""
        return self.vectors / np.sqrt(self.values)


def whole_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, x): the rows whose vector is neither null nor holds a null or non-finite entry."""
    own = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    return own.where(F.col("v").isNotNull() & finite).select("id", F.transform("v", lambda c: F.floor(c * SCALE)).alias("x"))


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows with ``idx``, gapless from 0: block numbers must be small."""
    laid = written(rows.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")), "fit-list")
    first, offsets = 0, {}
    # A row a partition.
    for r in laid.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("at")).orderBy("_part").collect():
        offsets[r["_part"]], first = first - r["at"], first + r["n"]
    table = rows.sparkSession.createDataFrame(list(offsets.items()) or [(0, 0)], "_part int, _offset long")
    return laid.join(broadcast_if_small(table), "_part").select("x", (F.col("_at") + F.col("_offset")).alias("idx"))


def _block_matrix(rows: DataFrame, n: int, d: int, block_rows: int) -> BlockMatrix:
    """(idx, v array<double>) as distributed blocks of ``block_rows`` rows and all columns."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select(F.col("idx").alias("index"), array_to_vector("v").alias("vector")), "vector")
    return IndexedRowMatrix(callMLlibFunc("createIndexedRowMatrix", vectors, n, d)).toBlockMatrix(block_rows, d)


def _times(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """The product, with the dimension they share in ``splits``: without them one task takes all blocks of a row and column."""
    product = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock)


def _scatter(blocks: BlockMatrix, n: int) -> np.ndarray:
    """Transpose times itself over n: columns x columns."""
    splits = max(1, -(-n // blocks.rowsPerBlock) // SPLIT_BLOCKS)
    return _times(blocks.transpose(), blocks, splits).toLocalMatrix().toArray() / n


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int | None = None,
           block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, Whitening, float]:
    """Every remaining row of ``df`` as (id, ``deviation``, ``whitened`` array<double>), the fitted whitening, and the
    largest absolute entry by which the covariance of ``whitened`` over the fit list differs from the identity.

    Rows whose vector is null or holds a null or non-finite entry are left out.  An entry c counts as floor(256 * c);
    covariances are over the distinct vectors, centred first, with their number as divisor.  ``whitened`` has the first
    ``components`` (None: all) components of non-zero variance by falling variance: none, if there is one distinct
    vector.  ``deviation`` is the sum over dimensions of (n * x - S)^2, null where that is no long.  Vectors shorter
    than the longest count as filled up with zeros.  Null and repeated ids are rows like others; other columns are not
    read.  An empty table gives no rows, n = 0 and difference 0.
    """
    spark = df.sparkSession
    rows = written(whole_vectors(df, id_col, vector_col), "whole-vectors")
    d = rows.agg(F.max(F.size("x"))).first()[0] or 0
    rows = rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(d) - F.size("x"))))
    # Copies of a vector meet after a partial aggregation.
    fit = written(_numbered(rows.select("x").distinct()), "fit-rows")
    of = [F.get("x", F.lit(i)) for i in range(d)]
    largest = F.greatest(*[F.max(F.abs(c.cast("decimal(20,0)"))) for c in of], F.lit(0).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    n, most, *sums = fit.agg(F.count(F.lit(1)), largest, *[F.sum(c.cast("decimal(20,0)")) for c in of]).first()
    sums, most = [int(s or 0) for s in sums], int(most or 0)
    if not n or not d:
        none = Whitening(n, sums, most, np.zeros(0), np.zeros((d, 0)), 0.0)
        return rows.select("id", F.lit(0).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened")), none, 0.0

    means = F.array(*[F.lit(s / n) for s in sums])
    centred = fit.select("idx", F.zip_with(F.col("x"), means, lambda a, m: a.cast("double") - m).alias("v"))
    blocks = _block_matrix(centred, n, d, block_rows)
    blocks.persist(StorageLevel.MEMORY_AND_DISK)  # read three times; what is lost is built again from the fit list
    covariance = _scatter(blocks, n)
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(values)[::-1]
    order = order[values[order] > LEAST * max(values.max(), 0)][:components]
    model = Whitening(n, sums, most, values[order], vectors[:, order], float(np.trace(covariance)))

    kind = "bigint" if d * (2 * n * most) ** 2 < 1 << 62 else "decimal(38,0)"
    total = [F.lit(s).cast("decimal(38,0)").cast(kind) for s in sums]

    def deviation(x):
        away = F.zip_with(x, F.array(*total), lambda a, s: a.cast(kind) * F.lit(n).cast(kind) - s)
        squares = F.transform(away, lambda a: F.try_multiply(a, a))
        return F.aggregate(squares, F.lit(0).cast(kind), lambda t, v: F.try_add(t, v).cast(kind)).try_cast("long")

    if not len(order):
        return rows.select("id", deviation(F.col("x")).alias("deviation"), F.array().cast("array<double>").alias("whitened")), model, 0.0
    k = len(order)
    weights = spark.sparkContext.parallelize([((0, 0), DenseMatrix(d, k, model.matrix.ravel(order="F").tolist()))])
    projected = _times(blocks, BlockMatrix(weights, d, k, d, k), 1)
    error = float(np.abs(_scatter(projected, n) - np.eye(k)).max())
    by_index = callMLlibFunc("getIndexedRows", projected.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    by_index = MLUtils.convertVectorColumnsToML(by_index, "vector")
    by_index = written(by_index.select(F.col("index").alias("idx"), vector_to_array("vector").alias("whitened")), "projected")
    blocks._java_matrix_wrapper._java_model.blocks().unpersist(False)
    by_vector = fit.join(by_index, "idx").select("x", deviation(F.col("x")).alias("deviation"), "whitened")
    # A vector that many rows hold is a skewed key of the rows' side only, which adaptive execution splits.
    return rows.join(by_vector.hint("merge"), "x").select("id", "deviation", "whitened"), model, error
