"""Embedding whitening by block matrices.

Entries become whole numbers x = floor(64 * c) + 1,000,000, so sums and
deviations are exact.  The fit list is each distinct vector once.  Its centred
rows are indexed without gaps into a distributed BlockMatrix; the transpose times
the matrix gives the scatter (the long dimension is cut into as many partial
products as there are groups of blocks, so no task sees all rows), whose
eigenvectors are found on the driver (dimension squared numbers, whatever the
table's size).  A BlockMatrix product with the whitening matrix projects the
rows.

Defined cases: vectors that are null, empty or hold null or non-finite entries
take no part; of vectors of unlike lengths, those of the commonest length do
(ties: the longer); repeated rows each come out, a null id stays null;
components without variance (relative to the whole under ``FLOOR``) do not
exist, so a table of one distinct vector, or none, gives no rows; a deviation
beyond 64 bits is an error; other columns are not read.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

SCALE, SHIFT, TOP = 64, 1_000_000, 16
#: Share of the whole variance from which a component counts as one.
FLOOR = 1e-12
#: Size of a block; a product takes about ``GROUP`` blocks of rows at a time.
BLOCK_ROWS, BLOCK_COLS, GROUP = 1024, 1024, 16
RESULT = ("vec_id long, component int, n long, deviation long, whitened double,"
          " explained double, identity_error double")


def whole(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, x) of the rows that take part."""
    def sound(c):
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))

    v = F.col(vec_col).cast("array<double>")
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")) \
        .where(F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", sound)) \
        .select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE) + SHIFT).alias("x"))


def indexed(rows: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``rows``, stored, with a gapless ``index`` from 0, and their number."""
    kept = stored(rows.withColumn("__rid", F.monotonically_increasing_id()), name)
    part = F.shiftrightunsigned("__rid", 33)
    counts = kept.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("n")) \
        .orderBy("__part").collect()  # one row a partition
    before = [0, *itertools.accumulate(r["n"] for r in counts)]
    spark = rows.sparkSession
    first = spark.createDataFrame([(r["__part"], b) for r, b in zip(counts, before)],
                                  "__part long, __before long")
    out = kept.withColumn("__part", part).join(F.broadcast(first), "__part")
    low = F.col("__rid").bitwiseAND(F.lit((1 << 33) - 1))
    return out.withColumn("index", F.col("__before") + low) \
        .drop("__part", "__before", "__rid"), before[-1]


def sums(fit: DataFrame, dim: int) -> list[int]:
    """Exact sum of every dimension, one row per task and dimension shuffled."""
    def run(batches):
        total = np.zeros(dim, np.int64)
        for b in batches:
            total += _matrix(b.column(0), dim).sum(axis=0)
        yield pa.record_batch([pa.array(np.arange(dim)), pa.array(total)], names=["dim", "s"])

    per = fit.select("x").mapInArrow(run, "dim long, s long")
    return [int(r["s"]) for r in per.groupBy("dim").agg(F.sum("s").alias("s"))
            .orderBy("dim").collect()]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dim)


def centred(rows: DataFrame, n: int, total: list[int]) -> DataFrame:
    """(index, vec_id, deviation, c): rows moved by the fit list's mean."""
    s = np.array(total, np.int64)
    dim = len(total)

    def run(batches):
        for b in batches:
            d = n * _matrix(b.column("x"), dim) - s
            if d.size and float(np.abs(d).max()) ** 2 * dim >= 2.0 ** 62:
                dev = [sum(int(y) ** 2 for y in r) for r in d]  # pyarrow checks the range
            else:
                dev = (d * d).sum(axis=1)
            c = pa.ListArray.from_arrays(pa.array(np.arange(0, d.size + 1, dim, np.int32)),
                                         pa.array((d / n).ravel()))
            yield pa.record_batch([b.column("index"), b.column("vec_id"),
                                   pa.array(dev, pa.int64()), c],
                                  names=["index", "vec_id", "deviation", "c"])

    return rows.select("index", "vec_id", "x").mapInArrow(
        run, "index long, vec_id long, deviation long, c array<double>")


def blocks(rows: DataFrame, n: int, dim: int) -> BlockMatrix:
    """The distributed matrix of (index, c)."""
    vectors = MLUtils.convertVectorColumnsFromML(
        rows.select("index", array_to_vector("c").alias("vector")), "vector")
    return IndexedRowMatrix(vectors, n, dim).toBlockMatrix(BLOCK_ROWS, BLOCK_COLS)


def product(a: BlockMatrix, b: BlockMatrix) -> BlockMatrix:
    """a times b, its inner dimension cut into groups of blocks; without the cut
    all of a long inner dimension would meet in one task."""
    inner = -(-a.numCols() // a.colsPerBlock)
    java = a._java_matrix_wrapper.call(
        "multiply", b._java_matrix_wrapper._java_model, max(1, inner // GROUP))
    return BlockMatrix(java, a.rowsPerBlock, b.colsPerBlock)


def local_blocks(spark, m: np.ndarray) -> BlockMatrix:
    """A small matrix as a BlockMatrix."""
    parts = [((at // BLOCK_COLS, 0), Matrices.dense(
        len(m[at:at + BLOCK_COLS]), m.shape[1],
        m[at:at + BLOCK_COLS].ravel(order="F").tolist())) for at in range(0, len(m), BLOCK_COLS)]
    return BlockMatrix(spark.sparkContext.parallelize(parts, 1), BLOCK_COLS, m.shape[1], *m.shape)


def principal(v: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of the components there are."""
    e, u = np.linalg.eigh(v)
    order = np.argsort(-e, kind="stable")[:top]
    order = order[e[order] > FLOOR * max(np.trace(v), 0)]
    return e[order], u[:, order]


def whiten(rows: DataFrame, top: int = TOP, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """One row per vector and component (see ``RESULT``)."""
    spark = rows.sparkSession
    empty = spark.createDataFrame([], RESULT)
    xs = whole(rows, id_col, vec_col)
    lengths = xs.groupBy(F.size("x").alias("dim")).agg(F.count(F.lit(1)).alias("k")) \
        .orderBy(F.desc("k"), F.desc("dim")).first()
    if lengths is None:
        return empty
    dim = lengths["dim"]
    every, m = indexed(xs.where(F.size("x") == dim), "vectors")
    fit, n = indexed(every.select("x").distinct(), "fit-list")
    total = sums(fit, dim)
    fit_c = centred(fit.withColumn("vec_id", F.lit(None).cast("long")), n, total)
    a = blocks(fit_c, n, dim)
    v = product(a.transpose(), a).toLocalMatrix().toArray() / n
    e, u = principal(v, top)
    if not len(e):
        return empty
    w = local_blocks(spark, u / np.sqrt(e))
    y = product(a, w)
    error = float(np.abs(product(y.transpose(), y).toLocalMatrix().toArray() / n
                         - np.eye(len(e))).max())
    all_c = stored(centred(every, n, total), "centred")
    z = product(blocks(all_c, m, dim), w)
    projected = callMLlibFunc("getIndexedRows",
                              z.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    share = F.array(*[F.lit(float(x)) for x in e / np.trace(v)])
    flat = all_c.select("index", "vec_id", "deviation").join(
        projected.select("index", vector_to_array("vector").alias("y")), "index") \
        .select("vec_id", "deviation", F.posexplode("y").alias("at", "whitened"))
    return flat.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
