"""Per-period document sets with a ledger: which periods came, and as what."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import safe_cast
from .files import (MATRIX_TYPE, PAYLOAD_TYPE, _read_docs, path_of, read_json_matrix,
                    read_json_payload)

STATUSES = ("absent", "corrupt", "no rows", "loaded")


def _period(file: str | Column, pattern: str) -> Column:
    return safe_cast(F.regexp_extract(file, pattern, 1), "int")


def period_status(spark: SparkSession, path: str, pattern: str, expected: Sequence[int] | DataFrame,
                  columns: Sequence[str], kind: str = "matrix",
                  per_line: bool = False) -> DataFrame:
    """(period, n_files, n_docs, n_bad_docs, n_rows, status), one row for every
    expected period and every other one that has files.

    ``pattern`` takes the period out of a file's path.  A document is bad if it
    does not parse or lacks a column of ``columns``.  A period is ``loaded`` if it
    has a usable row, ``absent`` without a file, ``corrupt`` if bad documents are
    all that it has besides empty ones, and ``no rows`` otherwise."""
    # the listing, not a scan: that passes over files without bytes
    names = spark.read.format("binaryFile").load(path).inputFiles()
    listed = (spark.createDataFrame([(path_of(n),) for n in names], "file string")
              .groupBy(_period("file", pattern).alias("period"))
              .agg(F.count(F.lit(1)).alias("n_files")))
    docs = _read_docs(spark, path, per_line)
    if kind == "matrix":
        doc = F.from_json("value", MATRIX_TYPE)
        header, size = F.col("doc")[0], F.size("doc") - 1
        broken = F.col("doc").isNull() | F.exists("doc", lambda r: r.isNull())
    elif kind == "payload":
        doc = F.from_json("value", PAYLOAD_TYPE)
        header, size = F.col("doc.header"), F.size("doc.data")
        broken = F.col("doc.header").isNull() | F.col("doc.data").isNull()
    else:
        raise ValueError(f"unknown kind of document {kind!r}")
    names = F.array(*[F.lit(c) for c in columns]) if columns else F.array().cast("array<string>")
    lacks = F.size(F.array_except(names, header)) > 0
    blank = F.trim("value") == ""
    parsed = docs.select(_period("__file", pattern).alias("period"), blank.alias("blank"),
                         doc.alias("doc")) \
        .withColumn("bad", ~F.col("blank") & F.coalesce(broken | ((size > 0) & lacks), F.lit(True)))
    rows = F.when(F.col("blank") | F.col("bad"), 0).otherwise(F.greatest(size, F.lit(0)))
    per = parsed.groupBy("period").agg(
        F.count_if(~F.col("blank")).alias("n_docs"), F.count_if("bad").alias("n_bad_docs"),
        F.sum(rows).cast("long").alias("n_rows"))
    wanted = expected.select(F.col(expected.columns[0]).cast("int").alias("period")) \
        if isinstance(expected, DataFrame) else \
        spark.createDataFrame([(int(p),) for p in expected], "period int")
    zero = F.lit(0).cast("long")
    joined = wanted.distinct().join(listed, "period", "full").join(per, "period", "left")
    counts = {c: F.coalesce(c, zero) for c in ("n_files", "n_docs", "n_bad_docs", "n_rows")}
    status = (F.when(F.col("n_files") == 0, "absent").when(F.col("n_rows") > 0, "loaded")
               .when(F.col("n_bad_docs") > 0, "corrupt").otherwise("no rows"))
    return joined.withColumns(counts).withColumn("status", status)


def load_periods(spark: SparkSession, path: str, pattern: str, expected: Sequence[int] | DataFrame,
                 columns: Mapping[str, str], kind: str = "matrix", per_line: bool = False,
                 period_name: str = "data_year") -> tuple[DataFrame, DataFrame]:
    """(rows, ledger) of a per-period document set.  Single periods may be absent
    or corrupt (the ledger says which); if none gave a row, this is an error that
    names them.  The check is a one-row probe; the ledger is worked out when read."""
    ledger = period_status(spark, path, pattern, expected, list(columns.values()), kind, per_line)
    if kind == "matrix":
        rows = read_json_matrix(spark, path, columns, pattern, period_name, per_line)
    else:
        rows = read_json_payload(spark, path, columns, period_name, per_line)
    if rows.isEmpty():
        bad = ledger.groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()
        raise ValueError("no usable period: " + ", ".join(
            f"{r['n']} {r['status']}" for r in sorted(bad)) + f" under {path}")
    return rows, ledger
