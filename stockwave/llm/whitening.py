"""Embedding whitening on MLlib's distributed block matrices.

Centred distinct vectors are indexed into blocks, the transposed matrix times the matrix gives the
scatter, whose eigenvectors are found locally, and the matrix of all centred vectors times the whitening
matrix projects the rows. Vectors become whole numbers first, so sums and deviations are exact.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockwave.llm.common import table
from stockwave.session import stage

SCALE = 256
COMPONENTS = 4
BLOCK_ROWS = 1024  # rows of a block, more only where there would be over MAX_BLOCKS
BLOCK_COLUMNS = 1024
MAX_BLOCKS = 1 << 20  # whose places the driver lists
BLOCKS_PER_TASK = 64  # multiplied and summed by a task


class Whitening(NamedTuple):
    """Fitted on ``n`` distinct vectors of whole numbers with ``sums`` per dimension."""

    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues of the covariance, falling
    axes: np.ndarray  # unit eigenvectors as columns, the entry of largest size positive
    trace: float
    identity_error: float | None  # largest entry of |covariance of the whitened fit list - identity|

    @property
    def matrix(self) -> np.ndarray:
        """Takes centred vectors to whitened components."""
        return self.axes / np.sqrt(self.values)


def whole_vectors(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows whose vector is not null and holds only finite entries, with ``x``: floor(256 c) of each entry."""
    ok = F.col(vector).isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    ends = F.lit(-(2.0**63)), F.lit(2.0**63 - 1024)
    x = F.transform(vector, lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, ends[1]), ends[0])).cast("long"))
    return vectors.where(F.coalesce(ok, F.lit(False))).withColumn("x", x)


def padded(rows: DataFrame, dim: int) -> DataFrame:
    return rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.greatest(F.lit(0), F.lit(dim) - F.size("x")))))


def indexed(rows: DataFrame, label: str) -> DataFrame:
    """The stored rows with ``index``, numbers from 0 without gaps.

    Each writing task numbers its rows as it stores them, so the numbers are data and stay when a task is run again.
    """
    kept = stage(rows.withColumn("place", F.monotonically_increasing_id()), label)
    part, within = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    counts = kept.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per writing task
    offsets = counts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    return kept.join(F.broadcast(offsets), part == F.col("part")).withColumn("index", F.col("offset") + within).drop("place", "part", "offset")


def block_matrix(rows: DataFrame, n: int, mean: np.ndarray) -> BlockMatrix:
    """The centred ``x`` of ``n`` rows with ``index``, in blocks."""
    centred = F.zip_with("x", F.lit(mean.tolist()), lambda x, m: x - m)
    frame = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector(centred).alias("vector")), "vector")
    height = max(BLOCK_ROWS, -(-n // MAX_BLOCKS))
    return IndexedRowMatrix(frame, n, len(mean)).toBlockMatrix(height, min(BLOCK_COLUMNS, len(mean)))


def times(a: BlockMatrix, b: BlockMatrix) -> BlockMatrix:
    """a b, with the sums over a long middle dimension split among tasks."""
    splits = max(1, -(-(a.numCols() // a.colsPerBlock) // BLOCKS_PER_TASK))
    product = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, a.rowsPerBlock, b.colsPerBlock)


def squared(a: BlockMatrix) -> np.ndarray:
    """Transposed a times a, which is as small as a has columns."""
    product = times(a.transpose(), a).toLocalMatrix().toArray()
    return (product + product.T) / 2


def projected(a: BlockMatrix, matrix: np.ndarray) -> BlockMatrix:
    """a times a local matrix."""
    context, height = SparkSession.active().sparkContext, a.colsPerBlock
    blocks = [((i, 0), Matrices.dense(len(part), part.shape[1], part.ravel("F"))) for i, part in enumerate(matrix[at : at + height] for at in range(0, len(matrix), height))]
    return times(a, BlockMatrix(context.parallelize(blocks, 1), height, matrix.shape[1], len(matrix), matrix.shape[1]))


def fit(rows: DataFrame, components: int | None = None) -> Whitening:
    """Whitening of the distinct ``x`` of ``rows``, whose vectors have equal lengths.

    ``components`` limits how many axes are kept. Axes without variance are left out, as they cannot be scaled.
    """
    distinct = indexed(rows.select("x").distinct(), "distinct-vectors")
    size = distinct.agg(F.count(F.lit(1)), F.max(F.size("x"))).head()
    n, dim = size[0], size[1] or 0
    if not n or not dim:
        return Whitening(n, [], np.zeros(0), np.zeros((0, 0)), 0.0, None)
    sums = [int(s) for s in distinct.agg(*[F.sum(F.get("x", F.lit(i)).cast("decimal(20,0)")) for i in range(dim)]).head()]
    centred = block_matrix(distinct, n, np.array([s / n for s in sums])).persist(StorageLevel.MEMORY_AND_DISK)  # two products read it
    covariance = squared(centred) / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    kept = np.flatnonzero(values > max(values[0], 0) * dim * 1e-13)[:components]
    values, axes = values[kept], axes[:, kept]
    if len(kept):
        axes = axes * np.sign(axes[np.abs(axes).argmax(0), np.arange(len(kept))])
    found = Whitening(n, sums, values, axes, float(np.trace(covariance)), None)
    if len(kept):
        error = np.abs(squared(projected(centred, found.matrix)) / n - np.eye(len(kept))).max()
        found = found._replace(identity_error=float(error))
    centred._java_matrix_wrapper._java_model.blocks().unpersist(False)
    return found


def apply(rows: DataFrame, model: Whitening) -> DataFrame:
    """``rows`` with ``x`` and a new column ``whitened``: array<double>, a number per kept axis."""
    if not len(model.values):
        return rows.withColumn("whitened", F.array().cast("array<double>"))
    numbered = indexed(rows, "vectors")
    n = numbered.count()
    centred = block_matrix(numbered, n, np.array([s / model.n for s in model.sums]))
    moved = projected(centred, model.matrix).toIndexedRowMatrix()
    frame = callMLlibFunc("getIndexedRows", moved._java_matrix_wrapper._java_model)
    return numbered.join(frame.select("index", vector_to_array("vector").alias("whitened")), "index").drop("index")


def whiten(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int | None = None) -> DataFrame:
    """Whitened embeddings: id, n, deviation, whitened, explained, identity_error.

    Entries c become whole numbers x = floor(256 c); those beyond the range of long stay at its ends. Axes are the unit
    eigenvectors of the covariance of the distinct x vectors (divisor n), by falling eigenvalue e;
    ``whitened`` holds per kept axis the projection of x - S/n over sqrt(e), ``explained`` e / trace.
    ``deviation`` is the sum of (n x - S)^2 over dimensions, exact, null where a long cannot hold it.
    ``identity_error`` is the largest deviation of the whitened fit list's covariance from the identity.

    Vectors that are null or hold null or non-finite entries take no part; shorter ones (and empty ones beside longer) end in zeros.
    A null id is passed on. Repeated rows and equal vectors each get their row, and count once in the fit. Axes of
    equal eigenvalue come in any order. Axes without variance are left out: where all vectors are equal the arrays
    are empty and the error is null. An empty table gives no rows; other columns are left out.
    """
    rows = stage(whole_vectors(vectors.select(F.col(id).alias("id"), F.col(vector).alias("v")), "v").select("id", "x"), "whole-vectors")
    dim = rows.agg(F.max(F.size("x"))).head()[0] or 0
    rows = padded(rows, dim)
    model = fit(rows, components)

    def difference(x, s):
        return (F.lit(model.n).cast("decimal(19,0)") * x.cast("decimal(19,0)") - s).try_cast("long")

    sums = F.array(*[F.lit(str(s)).cast("decimal(38,0)") for s in model.sums]) if model.sums else F.array().cast("array<decimal(38,0)>")
    squares = F.aggregate(F.zip_with("x", sums, difference), F.lit(0).cast("long"), lambda total, d: F.try_add(total, F.try_multiply(d, d)))
    explained = F.lit((model.values / model.trace).tolist()) if len(model.values) else F.array().cast("array<double>")
    return apply(rows, model).select(
        F.col("id").alias(id), F.lit(model.n).cast("long").alias("n"), squares.alias("deviation"), "whitened",
        explained.alias("explained"), F.lit(model.identity_error).cast("double").alias("identity_error"),
    )


def op13_block_matrix(spark: SparkSession, folder: str) -> DataFrame:
    found = whiten(table(spark, folder, "embeddings"), components=COMPONENTS)
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "axis")
    return found.select("*", each).select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), "n", "deviation", "axis.whitened", "axis.explained", "identity_error"
    )
