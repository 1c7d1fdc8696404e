"""Exact deduplication by a tree-merge of sorted digest runs.

Every row becomes a digest of its normalised text (all ASCII white space
deleted).  The rows of one holder (input partition) are sorted and folded into a
run with one entry per text: how many rows have it and which of them is best.
Holders then exchange runs in binomial rounds: at a level, ``radix`` holders cut
their runs by one digit of the digest's home and trade the parts, and each merges
what it got (an external merge sort followed by a streaming fold of neighbours).
After the last level every digest lies with its home, so no holder ever sees more
than ``radix`` entries of one text, however many rows have it.  Answers go back
to the holders' first runs, and from there to the rows, by equality joins whose
keys hold the holder: a hot text is spread over all of them.

At every level entries count as one text only if, beside the 64-bit digest they
are sorted by, their SHA-256 and their length agree, and the entry that stays is
the best row's: most code points in the original text, then smallest id.

Defined cases: a null text is empty; a null id is larger than every other; of
rows that tie in code points and id, the first in reading order stays; an empty
table gives no rows; texts of any length are one digest; other columns are not
read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_BREAK, stored

#: Runs that one merge takes in at a level, at most.
RADIX = 16
#: Holders, at most; more input partitions share them.
HOLDERS = 4096

TEXT = ["digest", "sha", "octets"]
RUN = "holder int, digest long, sha binary, octets long, n long, id long, rid long, size long"


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            holders: int = HOLDERS) -> DataFrame:
    """One thin row per document, with the holder it belongs to."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.char_length(text).cast("long").alias("n"),
                       F.regexp_replace(text, WORD_BREAK, "").alias("bare"),
                       F.monotonically_increasing_id().alias("rid"))
    return rows.select(
        F.pmod(F.shiftrightunsigned("rid", 33), F.lit(holders)).cast("int").alias("holder"),
        F.xxhash64("bare").alias("digest"), F.unhex(F.sha2("bare", 256)).alias("sha"),
        F.octet_length("bare").cast("long").alias("octets"), "n", "id", "rid")


def fold(rows: DataFrame) -> DataFrame:
    """Sorted runs of a partition's entries: equal neighbours become their best.

    The sort may spill; the fold holds one batch and one entry."""
    ordered = rows.select(*(c.split()[0] for c in RUN.split(", "))).sortWithinPartitions(
        "holder", *TEXT, F.col("n").desc(), F.col("id").asc_nulls_last(), "rid")

    def run(batches):
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            if held is not None:
                b = pa.concat_batches([held, b])
            new = np.zeros(b.num_rows, bool)
            new[0] = True
            for c in ("holder", *TEXT):
                col = b.column(c)
                new[1:] |= pc.not_equal(col[1:], col[:-1]).to_numpy(zero_copy_only=False)
            first = np.flatnonzero(new)
            out = b.take(pa.array(first))
            size = np.add.reduceat(b.column("size").to_numpy(), first)
            out = pa.RecordBatch.from_arrays([*out.columns[:-1], pa.array(size)], schema=b.schema)
            held = out.slice(out.num_rows - 1)
            if out.num_rows > 1:
                yield out.slice(0, out.num_rows - 1)
        if held is not None:
            yield held

    return ordered.mapInArrow(run, RUN)


def shape(holders: int, radix: int = RADIX) -> tuple[int, int]:
    """(radix, levels) of the smallest tree over so many holders."""
    levels = 1
    while radix ** levels < holders:
        levels += 1
    while levels and (radix - 1) ** levels >= holders and radix > 2:
        radix -= 1
    return radix, levels


def _next(level: int, radix: int, levels: int) -> Column:
    """The holder that gets an entry: its own with one digit of the home's."""
    home = F.pmod(F.shiftrightunsigned("digest", 1), F.lit(radix ** levels))

    def digit(x):
        return F.floor(x / F.lit(radix ** level)) % radix

    return (F.col("holder") + (digit(home) - digit(F.col("holder"))) * radix ** level).cast("int")


def tree_merge(runs: DataFrame, holders: int, radix: int = RADIX) -> DataFrame:
    """One entry per text, from one run per holder.  Each level is stored, so a
    lost executor costs part of one level."""
    radix, levels = shape(holders, radix)
    for level in range(levels):
        sent = runs.withColumn("holder", _next(level, radix, levels))
        runs = stored(fold(sent.repartitionById(radix ** levels, "holder")), f"runs-{level + 1}")
    return runs


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            radix: int = RADIX, holders: int = HOLDERS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, sha) of every row."""
    rows = stored(digests(docs, id_col, text_col, holders), "digests")
    first = stored(fold(rows.withColumn("size", F.lit(1).cast("long"))), "runs-0")
    n = first.agg(F.max("holder")).first()[0]
    best = tree_merge(first, (n or 0) + 1, radix).select(
        *TEXT, F.col("id").alias("keep_id"), F.col("rid").alias("keep_rid"),
        F.col("size").alias("group_size"))
    answers = first.select("holder", *TEXT).distinct().join(best, TEXT)
    return rows.join(answers, ["holder", *TEXT]).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size",
        (F.col("rid") == F.col("keep_rid")).alias("kept"), "sha")
