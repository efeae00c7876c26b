"""Embedding whitening with Spark MLlib's BlockMatrix.

1. Entries become whole numbers (``grid`` steps a unit, floors). The fit list is
   each different vector once (a partial aggregate, so a vector that many rows
   share leaves a task once); its number and its sums per dimension are exact.
2. Rows of the fit list are centred (exact integer difference, then one division),
   numbered without gaps, and indexed into distributed blocks. Transpose times
   blocks is the scatter; the product's middle dimension is split, so each task
   holds some blocks and partial products add up. The driver sees one width x width
   matrix, whose eigenvectors it takes by ``eigh``.
3. The whitening matrix (components over square roots of their eigenvalues) is one
   block; BlockMatrix products project the fit list (to measure how far its covariance is
   from the identity) and all rows, which come back by their row numbers.

The driver holds what Spark's BlockMatrix product itself keeps there: the number and
shape of each block. A block grows from 1,024 to 65,536 rows with the input, so a
hundred billion vectors are some 1.5 million blocks.

Defined cases: rows whose vector is null or holds null, NaN or infinite entries are
dropped, and so are empty vectors. Vectors of unequal widths, and entries of 2**40 or
more in size, raise an error. Null or repeated ids are rows like others. Components
whose eigenvalue is below 1e-12 of the largest don't exist: they give no rows, so a
table with one different vector, or none, gives no rows. ``deviation`` is null
where it exceeds a long. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equilibra.llm._work import numbered, run_dir, saved

RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
TASK_BYTES = 32 << 20  #: centred values that a task of a product holds
LARGEST = 2.0**40


def grid_rows(vectors: DataFrame, grid: int, shift: int) -> DataFrame:
    """(vec_id, x): usable vectors on the grid."""
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    usable = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    usable = usable.filter((F.size("v") > 0) & ~F.exists("v", bad))
    step = lambda v: F.when(F.abs(v) < LARGEST, F.floor(F.lit(grid) * v) + shift).otherwise(F.raise_error(F.lit("an entry is too large for the grid")).cast("long"))
    return usable.select("vec_id", F.transform("v", step).alias("x"))


def _stack(column) -> np.ndarray:
    """An Arrow list column as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and exact sums per dimension."""

    def add(batches: Iterator) -> Iterator:
        import pyarrow as pa

        n, total = 0, None
        for batch in batches:
            if len(batch):
                own = _stack(batch.column("x")).sum(0)
                n, total = n + len(batch), own if total is None else total + own
        if n:
            yield pa.record_batch([pa.array([n], pa.int64()), pa.array([total.tolist()], pa.list_(pa.int64()))], names=["n", "s"])

    parts = fit.select("x").mapInArrow(add, "n long, s array<long>")
    rows = parts.select("n", F.posexplode("s").alias("k", "s")).groupBy("k").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("k").collect()
    return (rows[0]["n"] if rows else 0), [r["s"] for r in rows]


def centred(rows: DataFrame, n: int, total: list[int]) -> DataFrame:
    """(at, v, deviation): x minus the mean in doubles, and the sum of (n*x - S)**2."""
    mean = np.array([s // n for s in total], np.int64)
    rest = np.array([s % n for s in total], np.int64)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for k in range(0, len(batch), 2000):
                part = batch.slice(k, 2000)
                x = _stack(part.column("x")) - mean
                if np.abs(x).max(initial=0) * n < 2**62:
                    off = n * x - rest
                else:
                    off = x.astype(object) * n - rest.astype(object)
                if float(np.abs(off).max(initial=0)) ** 2 * off.shape[1] < 2**62:
                    deviation = (off.astype(np.int64) ** 2).sum(1).tolist()
                else:
                    deviation = [d if (d := sum(int(e) ** 2 for e in row)) < 2**63 else None for row in off.tolist()]
                flat = pa.array((off / n).astype(float).ravel())
                v = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, len(mean)), pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([part.column("at"), v, pa.array(deviation, pa.int64())], names=["at", "v", "deviation"])

    return rows.select("at", "x").mapInArrow(run, "at long, v array<double>, deviation long")


def blocks(centred_rows: DataFrame, count: int, width: int) -> BlockMatrix:
    """Rows (at, v), numbered without gaps, as distributed blocks."""
    per_block = min(65_536, max(1024, count // 100_000))
    vectors = centred_rows.select(F.col("at"), array_to_vector("v").alias("v"))
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "v"), count, width)
    return matrix.toBlockMatrix(per_block, width)


def times(left: BlockMatrix, right: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """left x right, the middle dimension in ``splits`` parts that are added up.

    MLlib's multiply takes the number of parts; its Python form has no argument for it.
    """
    product = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock)


def gram(matrix: BlockMatrix, count: int, width: int) -> np.ndarray:
    """Transpose times matrix, on the driver: width x width."""
    splits = max(1, -(-16 * count * width // TASK_BYTES))
    return times(matrix.transpose(), matrix, splits).toLocalMatrix().toArray()


def projected(spark: SparkSession, matrix: BlockMatrix, onto: np.ndarray) -> BlockMatrix:
    """Rows times a small matrix."""
    block = Matrices.dense(*onto.shape, onto.ravel(order="F").tolist())
    return times(matrix, BlockMatrix(spark.sparkContext.parallelize([((0, 0), block)], 1), *onto.shape))


def rows_of(spark: SparkSession, matrix: BlockMatrix) -> DataFrame:
    """(at, z) of each row of a matrix of one column of blocks."""
    per_block = matrix.rowsPerBlock

    def cut(item):
        (k, _), block = item
        for j, row in enumerate(block.toArray().tolist()):
            yield k * per_block + j, row

    return spark.createDataFrame(matrix.blocks.flatMap(cut), "at long, z array<double>")


def whiten(vectors: DataFrame, components: int = 16, grid: int = 64, shift: int = 1_000_000) -> DataFrame:
    """A row per usable vector and component: vec_id, component, n, deviation, whitened,
    explained (share of variance), identity_error (one value for all)."""
    spark = vectors.sparkSession
    base = run_dir(spark, "whitening")
    rows = numbered(grid_rows(vectors, grid, shift), f"{base}/rows", "at")
    widths = rows.agg(F.min(F.size("x")).alias("lo"), F.max(F.size("x")).alias("hi"), F.count(F.lit(1)).alias("rows")).first()
    if widths["lo"] != widths["hi"]:
        raise ValueError(f"vectors have widths from {widths['lo']} to {widths['hi']}")
    empty = spark.createDataFrame([], RESULT)
    if not widths["rows"]:
        return empty
    width = widths["hi"]
    fit = numbered(rows.select("x").distinct(), f"{base}/fit", "at")
    n, total = sums(fit)
    own = saved(centred(fit, n, total), f"{base}/fit-centred")
    matrix = blocks(own, n, width)
    values, vectors_ = np.linalg.eigh(gram(matrix, n, width) / n)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > 1e-12 * max(values.max(), 0)]
    if not len(order):
        return empty
    onto = vectors_[:, order] / np.sqrt(values[order])
    error = float(np.abs(gram(projected(spark, matrix, onto), n, len(order)) / n - np.eye(len(order))).max())
    shares = [float(v / values.sum()) for v in values[order]]
    every = saved(centred(rows, n, total), f"{base}/rows-centred")
    z = saved(rows_of(spark, projected(spark, blocks(every, widths["rows"], width), onto)), f"{base}/whitened").withColumnRenamed("at", "of")
    told = rows.select("at", "vec_id").join(every.select(F.col("at").alias("row"), "deviation"), F.col("at") == F.col("row"))
    whole = told.join(z, F.col("at") == F.col("of")).select("vec_id", "deviation", F.posexplode("z").alias("k", "whitened"))
    return whole.select(
        "vec_id",
        (F.col("k") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(F.lit(shares), F.col("k") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
