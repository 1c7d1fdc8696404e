"""Texts on their way to the spans found in them."""

from __future__ import annotations

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text bytes, row): ``row`` is a key of the row's content, for ids
    may be null or repeat."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    return rows.withColumn("row", F.xxhash64("doc_id", "text"))


def squeezed(rows: DataFrame, column: str = "text") -> DataFrame:
    """Texts (binary) compressed for the way to their spans; a null stays null."""
    def run(batches):
        z = zstandard.ZstdCompressor(level=3)
        for b in batches:
            at = b.schema.get_field_index(column)
            small = pa.array([None if t is None else z.compress(t)
                              for t in b.column(column).to_pylist()], pa.binary())
            yield b.set_column(at, column, small)

    return rows.mapInArrow(run, rows.schema)


def opened_texts(column: pa.Array) -> list[bytes | None]:
    z = zstandard.ZstdDecompressor()
    return [None if t is None else z.decompress(t) for t in column.to_pylist()]
