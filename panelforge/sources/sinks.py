"""Sinks: overwrite, slice (partition) overwrite, tables and views.

Writes are idempotent: re-running a job replaces exactly what it produced.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..session import delete_path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  files: int | None = None,
                  partition_by: Sequence[str] = ()) -> None:
    """Parquet write.  ``files=None`` keeps the plan's partitioning (AQE has
    already coalesced small shuffle partitions); ``files=n`` forces ``n``
    output files, which serialises the write into ``n`` tasks – only for
    small outputs."""
    out = df.repartition(files) if files else df
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def overwrite_slices(df: DataFrame, path: str,
                     period: str | Sequence[str]) -> None:
    """Replace only the period slices present in ``df`` (dynamic partition
    overwrite); all other slices stay.  Loading the same slice twice equals
    loading it once.

    Rows are rebalanced by period: each writer task holds few slices, and the
    adaptive planner splits a slice by its measured size into as many writers
    as it needs (``spark.sql.adaptive.advisoryPartitionSizeInBytes`` each), so
    a slice holding a third of all rows is no single task's work.
    """
    keys = [period] if isinstance(period, str) else list(period)
    out = df.hint("rebalance", *keys)
    (out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys).parquet(path))


def replace_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Create-or-replace a catalog table from a query result."""
    df.write.mode("overwrite").format(fmt).saveAsTable(name)


def replace_versioned(df: DataFrame, base: str, view: str, keep: int = 2) -> str:
    """Replace what ``view`` shows as a whole, without a moment in between.

    The rows go to a fresh folder under ``base``; once it is complete, the catalog
    view is switched to it.  Readers see the old version or the new one, and a run
    that fails before the switch changes nothing they see.  The newest ``keep``
    complete versions stay (a reader may still be on the one before); older ones
    and unfinished folders are removed after the switch.  One writer at a time.
    Returns the new version's folder."""
    spark, root = df.sparkSession, base.rstrip("/")
    done, others = _versions(spark, root)
    number = max([0, *(int(v[2:12]) for v in done + others)]) + 1
    path = f"{root}/v={number:010d}"
    df.write.mode("overwrite").parquet(path)
    _switch(spark, view, path)
    for old in others + done[:max(0, len(done) + 1 - keep)]:
        delete_path(spark, f"{root}/{old}")
    return path


def _switch(spark, view: str, path: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.`{path}`")


def _versions(spark, root: str) -> tuple[list[str], list[str]]:
    """Names of the complete versions, oldest first, and of unfinished ones."""
    p = _path(spark, root)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return [], []
    names = sorted(n for n in (s.getPath().getName() for s in fs.listStatus(p))
                   if re.fullmatch(r"v=\d{10}", n))
    done = [n for n in names if fs.exists(_path(spark, f"{root}/{n}/_SUCCESS"))]
    return done, [n for n in names if n not in done]


def _path(spark, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def create_view(df: DataFrame, name: str) -> None:
    """Create-or-replace a (session) view."""
    df.createOrReplaceTempView(name)


def insert_overwrite(df: DataFrame, table: str) -> None:
    """INSERT OVERWRITE into an existing table; columns bind by position,
    so the frame is first put in the table's column order."""
    target_cols = df.sparkSession.table(table).columns
    df.select(*target_cols).write.insertInto(table, overwrite=True)
