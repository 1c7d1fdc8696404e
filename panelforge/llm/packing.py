"""Packing of token pieces into sequences: dominance reduction, then best fit.

What is decided depends only on how many pieces there are of each length, so the
work is done on counts (at most ``capacity`` of them, whatever the corpus):

1. Martello-Toth dominance, from the longest pieces down.  A piece that fits
   with no other goes alone.  A piece and its exact complement go together.  A
   piece and the longest one that fits beside it go together if no choice of the
   pieces left over has a sum that fits too and is larger: then that pair
   dominates every other set.  Such sets are fixed for good.
2. The remaining pieces are placed by best fit, longest first, equal bins and
   equal pieces together.

The plan is a table of runs: the pieces of a length with ranks first..last go, in
turn, to consecutive sequences at one offset.  It is bounded by the capacity, not
by the corpus, and so may be broadcast.  Pieces are ranked within their length by
counts per stored part, so a common length is never sorted in one task.

Defined cases: a null text is one piece of the end id alone; texts of any length are
encoded whole and cut into as many pieces as they need; ties go by reading order; repeated rows and
ids are packed each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .common import stored
from .orc_tokens import ids_crc
from .tokens import steps, word_tokenizer

CAPACITY = 2048


def pieces(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY,
           id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, at[, ids]) of every piece."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "at"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    sql = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, at long"
    if with_ids:
        names, kinds, sql = [*names, "ids"], [*kinds, pa.list_(pa.int32())], sql + ", ids array<int>"

    def run(batches):
        part, at = TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4")
        for b in batches:
            for step in steps(b):
                out = []
                for doc, ids in zip(step.column("doc_id").to_pylist(), word_tokenizer(path)
                                    .encode(step.column("text").to_pylist())):
                    ids = np.concatenate([ids, end])
                    for n, a in enumerate(range(0, len(ids), capacity)):
                        piece = ids[a:a + capacity]
                        out.append((doc, n, a, len(piece), ids_crc(piece), part, at,
                                    *([piece.astype(np.int32)] if with_ids else [])))
                        at += 1
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                      names=names)

    return rows.mapInArrow(run, sql)


class Plan:
    """Sequences as runs of equal ones; see the module's text."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.capacity = capacity
        self.left = {n: c for n, c in counts.items() if c}
        self.used = defaultdict(int)
        self.sequences = 0
        #: (length, first rank, last rank, first sequence, offset)
        self.runs: list[tuple[int, int, int, int, int]] = []
        self.reduce()
        self.best_fit()

    def _place(self, length: int, n: int, sequence: int, offset: int) -> None:
        first = self.used[length]
        self.runs.append((length, first, first + n - 1, sequence, offset))
        self.used[length] += n

    def _fix(self, lengths: list[int], n: int) -> None:
        """``n`` new full sequences of these lengths."""
        offset = 0
        for x in lengths:
            self._place(x, n, self.sequences, offset)
            self.left[x] -= n
            if not self.left[x]:
                del self.left[x]
            offset += x
        self.sequences += n

    def _partners(self, x: int) -> list[int]:
        """Lengths left that fit beside one piece of length x."""
        room = self.capacity - x
        return [y for y, c in self.left.items() if y <= room and c > (y == x)]

    @staticmethod
    def _sums(lengths: list[int], low: int, high: int) -> bool:
        """Whether some pieces of these lengths sum to above low, up to high
        (each length as often as one likes: more than there may be)."""
        mask, wanted = (1 << high + 1) - 1, ((1 << high + 1) - 1) ^ ((1 << low + 1) - 1)
        reach = 1
        for x in sorted(lengths):
            step = x
            while step <= high:
                reach |= reach << step & mask
                step *= 2
            if reach & wanted:
                return True
        return False

    def reduce(self) -> None:
        for x in sorted(self.left, reverse=True):
            while x in self.left:
                fits = self._partners(x)
                if not fits:
                    self._fix([x], self.left[x])
                    break
                best = max(fits)
                room = self.capacity - x
                if best < room and self._sums(fits, best, room):
                    break  # left to best fit
                self._fix([x, best], self.left[x] // 2 if best == x
                          else min(self.left[x], self.left[best]))

    def best_fit(self) -> None:
        bins = defaultdict(list)  # room left: runs (first sequence, how many)
        for x in sorted(self.left, reverse=True):
            todo = self.left[x]
            while todo:
                room = min((r for r in bins if r >= x), default=None)
                if room is None:
                    room, deep = self.capacity, self.capacity // x
                    first, many = self.sequences, -(-todo // deep)
                    self.sequences += many
                else:
                    (first, many), deep = bins[room].pop(), room // x
                    if not bins[room]:
                        del bins[room]
                full = min(many, todo // deep)
                rest = min(todo - full * deep, deep - 1) if full < many else 0
                for layer in range(deep):
                    at = self.capacity - room + layer * x
                    n = full + (layer < rest)
                    if n:
                        self._place(x, n, first, at)
                for start, n, layers in ((first, full, deep), (first + full, int(rest > 0), rest),
                                         (first + full + (rest > 0), many - full - (rest > 0), 0)):
                    if n and room - layers * x:
                        bins[room - layers * x].append((start, n))
                todo -= full * deep + rest
        self.left = {}


def packed(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Stored ``pieces`` with sequence_id and offset."""
    spark = cut.sparkSession
    counts = {r["length"]: r["n"] for r in  # at most ``capacity`` rows
              cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = Plan(counts, capacity)
    runs = spark.createDataFrame(plan.runs, "length long, first long, last long, "
                                 "sequence long, offset long")
    by_part = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.Window.partitionBy("length").orderBy("part")
                             .rowsBetween(W.Window.unboundedPreceding, -1))
    base = by_part.select("part", "length", F.coalesce(before, F.lit(0)).alias("base"))
    inside = F.row_number().over(W.Window.partitionBy("part", "length").orderBy("at"))
    ranked = cut.withColumn("inside", inside).join(base, ["part", "length"]) \
        .withColumn("rank", F.col("base") + F.col("inside") - 1).drop("base", "inside")
    r = F.broadcast(stored(runs.coalesce(1), "packing-plan").withColumnRenamed("length", "of"))
    return ranked.join(r, (F.col("length") == F.col("of"))
                       & F.col("rank").between(F.col("first"), F.col("last"))) \
        .withColumn("sequence_id", F.col("sequence") + F.col("rank") - F.col("first")) \
        .drop("of", "first", "last", "sequence", "rank", "part", "at")


def pack(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY,
         with_ids: bool = False, **cols) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids])."""
    cut = stored(pieces(docs, path, end_id, capacity, with_ids=with_ids, **cols), "pieces")
    return packed(cut, capacity)
