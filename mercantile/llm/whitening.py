"""Embedding whitening with MLlib block matrices.

The distinct vectors, scaled to whole numbers and centred exactly, are indexed
as the rows of a distributed matrix and cut into blocks; the transposed matrix
times itself is the scatter, multiplied in splits of the row blocks so that no
task sees more than ``SPLIT`` blocks; its eigenvectors are found on the driver
(one square of the vector length); the block matrix times the whitening matrix
projects the rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import dense_keys
from .common import materialise, register, table

#: Entries of a block, and row blocks that one task multiplies.
BLOCK = 1 << 19
SPLIT = 8
#: Eigenvalues below this share of the trace are rounding, not variance.
TINY = 1e-12
OUT_SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")


def _usable(vec: Column, scale: int) -> Column:
    inside = F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                      & (F.abs(c.cast("double") * scale) < float(1 << 53)))
    return vec.isNotNull() & (F.size(vec) > 0) & F.coalesce(inside, F.lit(False))


def scatter(matrix: BlockMatrix, row_blocks: int) -> np.ndarray:
    """Transposed matrix times itself, the row blocks dealt over splits."""
    left, right = matrix.transpose(), matrix
    product = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model,
                                             max(1, -(-row_blocks // SPLIT)))
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock).toLocalMatrix().toArray()


def principal(cov: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(whitening matrix, explained shares, which components have variance)."""
    value, vector = np.linalg.eigh((cov + cov.T) / 2)
    value, vector = value[::-1][:components], vector[:, ::-1][:, :components]
    trace = float(np.trace(cov))
    real = value > TINY * trace if trace > 0 else np.zeros(len(value), bool)
    root = np.sqrt(np.where(real, value, 1.0))
    return np.where(real, vector / root, 0.0), np.where(real, value / (trace or 1.0), 0.0), real


def whiten_embeddings(vectors: DataFrame, components: int = 4, scale: int = 256, id_col: str = "vec_id",
                      vec_col: str = "embedding") -> DataFrame:
    """Whitened leading components of every usable vector.

    Entries c become whole numbers x = floor(scale * c); the covariance is that
    of the distinct x vectors, so copies weigh nothing.  Returns one row per
    input row and component (at most the vectors' length): vec_id, component,
    n, deviation, whitened, explained, identity_error.

    Rows whose vector is NULL, empty, or holds NULL, non-finite or scaled
    entries of 2**53 or more are dropped; so are vectors whose length is not the
    commonest (ties: the longest).  Components without variance (one distinct
    vector, a constant or dependent dimension) whiten and explain 0 and take no
    part in identity_error, which is 0 where none is left; equal eigenvalues
    leave the choice of vectors open; deviations beyond 63 bits are NULL.  NULL
    ids and repeated rows are rows like others; an empty table gives an empty
    result; other columns are ignored."""
    spark = vectors.sparkSession
    vec = F.col("vec")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec")).where(_usable(vec, scale))
    lengths = rows.groupBy(F.size("vec").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if lengths is None:
        return spark.createDataFrame([], OUT_SCHEMA)
    dims = lengths["dims"]
    rows = (rows.where(F.size("vec") == dims)
            .select("vec_id", F.transform(vec, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("x"))
            .select("vec_id", "x", F.xxhash64("x").alias("h1"), F.xxhash64(F.lit("second"), "x").alias("h2")))
    fit = materialise(dense_keys(rows.select("h1", "h2", "x").distinct(), ["h1", "h2"], start=-1, out="index"), "whiten-fit")
    n = fit.count()
    sums = (fit.select(F.posexplode("x").alias("i", "v")).groupBy("i")
            .agg(F.sum(F.col("v").cast("decimal(19,0)")).cast("string").alias("s")).collect())  # one row per dimension
    sums = [s for _, s in sorted((r["i"], r["s"]) for r in sums)]
    # n * x - S, exact; divided by n it is the centred vector.
    total = F.array(*[F.lit(s).cast("decimal(33,0)") for s in sums])
    exact = F.zip_with("x", total, lambda v, s: v.cast("decimal(19,0)") * F.lit(n).cast("decimal(13,0)") - s)
    centred = fit.select("index", array_to_vector(F.transform(exact, lambda y: y.cast("double") / n)).alias("vector"))
    per_block = max(64, BLOCK // dims)
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(centred, "vector"), n, dims).toBlockMatrix(per_block, dims)
    white, explained, real = principal(scatter(matrix, -(-n // per_block)) / n, min(components, dims))
    k = white.shape[1]
    one = spark.sparkContext.parallelize([((0, 0), DenseMatrix(dims, k, white.ravel(order="F")))], 1)
    projected = matrix.multiply(BlockMatrix(one, dims, k)).toIndexedRowMatrix()
    projected = (callMLlibFunc("getIndexedRows", projected._java_matrix_wrapper._java_model)
                 .select("index", vector_to_array("vector").alias("white")))
    square = F.aggregate(exact, F.lit(0).cast("decimal(38,0)"),
                         lambda acc, y: F.try_add(acc, F.try_multiply(y, y).cast("decimal(38,0)")).cast("decimal(38,0)"))
    made = materialise(fit.join(projected, "index").select("h1", "h2", "white", square.try_cast("long").alias("deviation")),
                       "whitened")
    off = [F.abs(F.covar_pop(F.col("white")[i], F.col("white")[j]) - float(i == j))
           for i in range(k) for j in range(i, k) if real[i] and real[j]]
    error = made.agg(F.array_max(F.array(*off)).alias("e")).first()["e"] if off else 0.0
    share = F.array(*[F.lit(float(e)) for e in explained])
    return (rows.select("vec_id", "h1", "h2").join(made, ["h1", "h2"])
            .select("vec_id", "deviation", F.posexplode(F.arrays_zip("white", share.alias("share"))).alias("i", "z"))
            .select("vec_id", (F.col("i") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
                    F.col("z.white").alias("whitened"), F.col("z.share").alias("explained"),
                    F.lit(float(error)).alias("identity_error")))


@register("op12_embedding_whitening")
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten_embeddings(table(spark, sf_dir, "embeddings"))
