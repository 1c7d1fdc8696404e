"""Token ids in ORC files.

Documents are range-partitioned and sorted by id, tokenised where they lie and
written as ORC: integer run-length encoded stripes, row indexes every
``ROW_INDEX`` rows, and Bloom filters on the document ids, so that readers take
stripes in parallel and skip those that cannot hold an id.  Each row also names
its block (the writing partition) and place in it, from which running positions
follow by a sum per block and a sum over the blocks' totals.

Defined cases: a null text has only the end id; texts of any length are one row of
ids; null ids come first; rows that share an id come out each, by the hash of their
text, then by reading order; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from panelforge.session import scratch_path

from .tokens import steps, word_tokenizer

#: Rows between entries of the row index.
ROW_INDEX = 1000
SCHEMA = "doc_id long, block int, place long, ids array<int>"


def tokenised(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """Rows of ``SCHEMA`` in ascending id order; rows of one id, of which there may
    be any number (null ids, repeated rows), are dealt by their texts' hashes and
    their places in the input."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    order = ("doc_id", "hash", "place")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                       F.xxhash64(text).alias("hash"),
                       F.monotonically_increasing_id().alias("place"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches):
        block, place = TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4")
        for b in batches:
            for part in steps(b):
                ids = word_tokenizer(path).encode(part.column("text").to_pylist())
                sizes = np.array([len(x) + 1 for x in ids])
                flat = np.concatenate([y for x in ids for y in (x, end)]).astype(np.int32)
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                n = part.num_rows
                yield pa.record_batch(
                    [part.column("doc_id"), pa.array(np.full(n, block, np.int32)),
                     pa.array(np.arange(place, place + n)),
                     pa.ListArray.from_arrays(ends, flat)],
                    names=["doc_id", "block", "place", "ids"])
                place += n

    return rows.mapInArrow(run, SCHEMA)


def write(docs: DataFrame, out: str, path: str, end_id: int, **cols) -> None:
    tokenised(docs, path, end_id, **cols).write \
        .option("compression", "zstd") \
        .option("orc.bloom.filter.columns", "doc_id") \
        .option("orc.bloom.filter.fpp", "0.01") \
        .option("orc.create.index", "true") \
        .option("orc.row.index.stride", str(ROW_INDEX)).orc(out)


def read(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(SCHEMA).orc(out)


def find(spark: SparkSession, out: str, doc_ids: list[int]) -> DataFrame:
    """Rows of some documents; stripes and row groups are skipped by their
    statistics and Bloom filters."""
    return read(spark, out).where(F.col("doc_id").isin(doc_ids))


def ids_crc(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def placed(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every row read back."""
    def run(batches):
        for b in batches:
            ids = b.column("ids")
            flat, at = ids.values.to_numpy(), ids.offsets.to_numpy()
            crc = [ids_crc(flat[s:e]) for s, e in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.record_batch(
                [b.column("doc_id"), b.column("block"), b.column("place"),
                 pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())],
                names=["doc_id", "block", "place", "n_tokens", "ids_crc32"])

    rows = tokens.mapInArrow(
        run, "doc_id long, block int, place long, n_tokens long, ids_crc32 long")
    return rows


def with_start(rows: DataFrame) -> DataFrame:
    """``rows`` with start: the ids of all rows before, over blocks and places."""
    before = F.sum("total").over(
        W.Window.orderBy("block").rowsBetween(W.Window.unboundedPreceding, -1))
    blocks = rows.groupBy("block").agg(F.sum("n_tokens").alias("total")) \
        .withColumn("base", F.coalesce(before, F.lit(0))).select("block", "base")
    inside = F.sum("n_tokens").over(W.Window.partitionBy("block").orderBy("place"))
    return rows.withColumn("inside", inside).join(blocks, "block") \
        .withColumn("start", F.col("base") + F.col("inside") - F.col("n_tokens")) \
        .drop("base", "inside", "block", "place")


def scratch(spark: SparkSession) -> str:
    return scratch_path(spark, "token-orc")
