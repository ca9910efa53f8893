"""Embedding whitening with block matrices.

Centred rows are indexed into a distributed BlockMatrix. Its transpose times itself is the scatter
of the fit list (each distinct vector once), whose eigenvectors are found locally, as only d x d
numbers are left. The rows times the whitening matrix is the second block product. Rows, blocks
and results stay on the executors; the driver sees d sums, d x d sums and k x k sums.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import finite_vector, numbered
from tallyloom.session import stage

COMPONENTS = 16
#: Rows and columns of a block, and rows whose blocks meet in one task of the scatter product.
BLOCK_ROWS, BLOCK_COLUMNS, SPLIT_ROWS = 1024, 1024, 32_768
#: Components with an eigenvalue below this share of the largest are rounding, not directions.
LEAST_SHARE = 1e-12


@dataclass
class Whitening:
    """What the fit list gives: count, sums, eigenvalues falling, the d x k projection, the trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    projection: np.ndarray
    trace: float


def blocked(rows: DataFrame, total: int, width: int) -> BlockMatrix:
    """Rows (i, y array<double>), missing i being rows of zeros, as a block matrix of ``total`` rows.

    A product reads its blocks several times, so they are kept; what a lost executor kept is made again.
    """
    vectors = MLUtils.convertVectorColumnsFromML(rows.select(F.col("i"), array_to_vector("y").alias("y")), "y")
    return IndexedRowMatrix(vectors, total, width).toBlockMatrix(BLOCK_ROWS, min(width, BLOCK_COLUMNS)).persist(StorageLevel.MEMORY_AND_DISK)


def _let_go(matrix: BlockMatrix) -> None:
    matrix._java_matrix_wrapper._java_model.blocks().unpersist(False)


def self_product(matrix: BlockMatrix, total: int) -> np.ndarray:
    """Transpose times the matrix, which is let go. The long side is cut into splits, so no task gets all its blocks."""
    left, right = matrix.transpose()._java_matrix_wrapper._java_model, matrix._java_matrix_wrapper._java_model
    splits = max(1, -(-total // SPLIT_ROWS))
    product = BlockMatrix(left.multiply(right, splits), matrix.colsPerBlock, matrix.colsPerBlock)
    local = product.toLocalMatrix().toArray()
    _let_go(matrix)
    return local


def times(spark: SparkSession, matrix: BlockMatrix, small: np.ndarray) -> DataFrame:
    """(i, z array<double>): the rows of the block matrix times a small local one."""
    step = matrix.colsPerBlock
    parts = [((k, 0), Matrices.dense(len(p), small.shape[1], p.T.ravel().tolist()))
             for k, p in enumerate(small[s:s + step] for s in range(0, len(small), step))]
    local = BlockMatrix(spark.sparkContext.parallelize(parts, 1), step, small.shape[1], *small.shape)
    rows = callMLlibFunc("getIndexedRows", matrix.multiply(local).toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return rows.select(F.col("index").alias("i"), vector_to_array("vector").alias("z"))


def _centred(rows: DataFrame, n: int, sums: list[int]) -> DataFrame:
    # n x - S is exact in long numbers, so rounding happens once, in the division.
    away = F.zip_with("x", F.array(*[F.lit(s).cast("long") for s in sums]), lambda x, s: (F.lit(n) * x - s) / F.lit(float(n)))
    return rows.select("i", away.alias("y"))


def fit(distinct: DataFrame, total: int, width: int, components: int = COMPONENTS) -> Whitening:
    """Whitening of stored rows (i, x array<long>), each a distinct vector with a row number below ``total``."""
    found = distinct.select(F.posexplode("x").alias("at", "value")).groupBy("at").agg(F.sum("value").alias("s"), F.count(F.lit(1)).alias("n"))
    by_place = {r["at"]: (r["s"], r["n"]) for r in found.collect()}  # one row per dimension
    n, sums = by_place[0][1], [by_place[k][0] for k in range(width)]
    covariance = self_product(blocked(_centred(distinct, n, sums), total, width), total) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    used = int((values[:components] > max(values[0], 0.0) * LEAST_SHARE).sum())
    values, vectors = values[:used], vectors[:, :used]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(used)]) if used else np.ones(0)
    return Whitening(n, sums, values, vectors * signs / np.sqrt(values), float(np.trace(covariance)))


def identity_error(fitted: DataFrame, n: int, components: int, total: int) -> float:
    """Largest absolute entry of the covariance of the whitened rows (i, z) minus the identity."""
    means = [r or 0.0 for r in fitted.agg(*[F.avg(F.get("z", F.lit(k))) for k in range(components)]).first()]
    away = F.zip_with("z", F.array(*[F.lit(m) for m in means]), lambda z, m: z - m)
    covariance = self_product(blocked(fitted.select("i", away.alias("y")), total, components), total) / n
    return float(np.abs(covariance - np.eye(components)).max())


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of rows (vec_id, x array<long>).

    The fit list is each distinct vector once. Repeated rows and equal vectors each get their own
    result rows; a null vec_id stays null. Vectors that are null or empty, and those of another
    length than the most frequent one (of equally frequent ones the longest), are left out.
    Components are numbered from 1 by falling eigenvalue, up to ``components``; there are fewer
    where the vectors span fewer directions, so one distinct vector gives no rows, and neither
    does an empty table. Of the two directions of an eigenvector, its largest entry is positive.
    A deviation beyond the range of long is null. Other columns are not read.
    """
    spark = rows.sparkSession
    kind = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    given = stage(rows.select("vec_id", "x").filter("size(x) > 0"), "vectors")
    lengths = given.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], kind)
    width = lengths[0]["width"]
    placed = numbered(given.filter(F.size("x") == width), "i", "placed")
    total = placed.count()
    firsts = stage(placed.groupBy("x").agg(F.min("i").alias("i")), "distinct")
    found = fit(firsts, total, width, components)
    used = len(found.values)
    if not used:
        return spark.createDataFrame([], kind)
    away = F.transform(
        F.arrays_zip("x", F.array(*[F.lit(s).cast("long") for s in found.sums]).alias("s")),
        lambda p: (F.lit(found.n) * p["x"] - p["s"]).cast("decimal(19,0)"))
    squares = F.aggregate(away, F.lit(0).cast("decimal(38,0)"), lambda acc, v: (acc + v * v).cast("decimal(38,0)"))
    matrix = blocked(_centred(placed, found.n, found.sums), total, width)
    marked = placed.join(firsts.select("i", F.lit(True).alias("first")), "i", "left").withColumn("deviation", squares.try_cast("long"))
    out = stage(marked.join(times(spark, matrix, found.projection), "i").drop("x"), "projected")
    _let_go(matrix)
    error = identity_error(out.filter("first").select("i", "z"), found.n, used, total)
    shares = F.array(*[F.lit(float(v / found.trace)) for v in found.values])
    return out.select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(found.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))


def scaled(embeddings: DataFrame, factor: int = 64, offset: int = 1_000_000) -> DataFrame:
    """(vec_id, x): whole numbers floor(factor c) + offset of vectors whose entries are all finite."""
    whole = F.transform("embedding", lambda c: F.floor(F.lit(float(factor)) * c.cast("double")) + F.lit(offset))
    return embeddings.filter(finite_vector("embedding")).select("vec_id", whole.alias("x"))
