"""Filter interaction audit: what every order of the filters would remove.

A document's failures are a mask of five bits.  Documents are counted per part
and mask (at most 32 cells a part), and each cell folds across the array of all
120 orders with SQL's ``aggregate`` and ``transform``: 600 structs (order, step)
weighted by the cell's counts.  A part's cells merge by elementwise sums.  The
order array is a constant of 120 short strings that travels with the plan.

Filter E (a copy of a text with a smaller id) needs no pass over pairs: rows are
pre-aggregated per text and part with the counts at the smallest id, so copies of
a text, however many, reach one task as one row per part.

Defined cases: a null text is empty, a null part is the empty string; a null id
is larger than every other, and rows with the same id, or both without one, are
not copies of each other under E; a label counts if any of its id's label rows
has it, rows without labels are neither good nor toxic; texts of any length are
counted whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .common import WORD_BREAK, let

LETTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(LETTERS)]
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
#: Thresholds of the conditions A, B and C.
MIN_WORDS, MIN_DISTINCT_PCT, MAX_UPPER_PCT = 50, 65, 5


def failures(text: Column) -> Column:
    """Mask of the conditions A (1), B (2), C (4), D (8) that a text fails."""
    def bit(condition, value):
        return F.when(condition, F.lit(value)).otherwise(F.lit(0))

    def of_words(w):
        return bit(F.size(w) < MIN_WORDS, 1) \
            + bit(100 * F.size(F.array_distinct(w)) < MIN_DISTINCT_PCT * F.size(w), 2)

    words = F.array_remove(F.split(text, WORD_BREAK), "")
    upper = F.regexp_count(text, F.lit("[A-Z]")).cast("long")
    return let(words, of_words) + bit(100 * upper > MAX_UPPER_PCT * F.char_length(text), 4) \
        + bit(text.rlike(r"[#$%&*|]"), 8)


def cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): rows per part and mask of all five filters."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        failures(text).alias("mask"), F.unhex(F.sha2(text, 256)).alias("sha"),
        F.octet_length(text).alias("octets")) \
        .withColumn("known", F.col("id").isNotNull()) \
        .withColumn("key", F.coalesce("id", F.monotonically_increasing_id()))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("key")) \
        .agg(F.max((F.coalesce("quality", F.lit(0)) == 1).cast("long")).alias("good"),
             F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("long")).alias("toxic")) \
        .withColumn("known", F.lit(True))
    text_key = ["sha", "octets"]
    sums = [F.sum(c).alias(c) for c in ("n", "good", "toxic")]
    none = F.lit(0).cast("long")
    by_id = rows.join(marks, ["key", "known"], "left") \
        .withColumns({"n": F.lit(1).cast("long"), "good": F.coalesce("good", none),
                      "toxic": F.coalesce("toxic", none)}) \
        .groupBy(*text_key, "part", "mask", "id").agg(*sums)
    rank = F.struct(F.col("id").isNull().alias("last"), "id")
    by_part = by_id.groupBy(*text_key, "part", "mask").agg(
        *sums, F.min(rank).alias("lo"),
        F.min_by(F.struct("n", "good", "toxic"), rank).alias("at"))
    # one row per part that has the text
    least = F.min("lo").over(W.Window.partitionBy(*text_key)) == F.col("lo")
    passing = [F.when(F.col("least"), F.col(f"at.{c}")).otherwise(none) for c in ("n", "good", "toxic")]
    split = by_part.withColumn("least", least).select("part", F.explode(F.array(
        F.struct("mask", *(p.alias(c) for p, c in zip(passing, ("n", "good", "toxic")))),
        F.struct((F.col("mask") + 16).alias("mask"),
                 *((F.col(c) - p).alias(c) for p, c in zip(passing, ("n", "good", "toxic"))))
    )).alias("c"))
    return split.select("part", "c.*").groupBy("part", "mask").agg(*sums)


def _weights(cell: Column) -> Column:
    """The 600 weighted structs of one cell, orders first, then steps."""
    orders = F.array(*[F.lit(o) for o in ORDERS])
    steps = F.array(*[F.lit(s) for s in range(1, 6)])
    mask, n = cell["mask"], cell["n"]
    none = F.lit(0).cast("long")

    def bit(letter):
        return F.element_at(F.array(*[F.lit(1 << i) for i in range(5)]),
                            F.ascii(letter) - (ord("A") - 1))

    def letter(order, step):
        return F.substr(order, step, F.lit(1))

    def first(order):  # step of the filter that removes the cell, 0: none does
        return F.aggregate(steps, F.lit(0), lambda at, s: F.when(at > 0, at).when(
            mask.bitwiseAND(bit(letter(order, s))) > 0, s).otherwise(F.lit(0)))

    def by_orders(hits):  # hits: (order, step that removes) of every order
        def share(x):  # orders in which this letter removes the cell
            return F.aggregate(hits, none, lambda acc, h: acc + F.when(
                (h["at"] > 0) & (letter(h["order"], h["at"]) == x), F.lit(1)).otherwise(F.lit(0)))

        def by_step(h, shares):
            def one(s):
                own = bit(letter(h["order"], s))
                here = h["at"] == s
                fails = mask.bitwiseAND(own) > 0
                values = (F.when((h["at"] == 0) | (h["at"] > s), n),
                          F.when(here, n), F.when(fails & (h["at"] < s), n),
                          F.when(mask == own, n), F.when(here, cell["good"]),
                          F.when(here, cell["toxic"]),
                          n * F.element_at(shares, F.ascii(letter(h["order"], s)) - (ord("A") - 1)))
                return F.struct(h["order"].alias("filter_order"), s.alias("step"),
                                *(F.coalesce(v, none).alias(c) for v, c in zip(values, COUNTS)))
            return F.transform(steps, one)

        return let(F.transform(F.array(*[F.lit(x) for x in LETTERS]), share), lambda shares:
                   F.flatten(F.transform(hits, lambda h: by_step(h, shares))))

    return let(F.transform(orders, lambda o: F.struct(o.alias("order"), first(o).alias("at"))),
               by_orders)


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """part, filter_order, step and the counts, 600 rows per part."""
    nobody = F.lit(0).cast("long")
    zeros = _weights(F.struct(F.lit(0).alias("mask"),
                              *(nobody.alias(c) for c in ("n", "good", "toxic"))))

    def plus(a, b):
        return F.struct(a["filter_order"].alias("filter_order"), a["step"].alias("step"),
                        *((a[c] + b[c]).alias(c) for c in COUNTS))

    # a part has 32 cells at most
    parts = cells(docs, labels, id_col, text_col, part_col).groupBy("part").agg(
        F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    merged = F.aggregate("cells", zeros, lambda acc, c: F.zip_with(acc, _weights(c), plus))
    return parts.select("part", F.inline(merged))
