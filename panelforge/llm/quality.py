"""Quality rules with adaptive thresholds.

Besides fixed base rules, a document is judged against its own language and
source: three rates (word length, symbols, repeated lines) must lie within
fences drawn from the quartiles of that group.  The quartiles come from
mergeable quantile sketches: counts per value rounded down to six significant
bits (relative error under 1/32), so that sketches of parts add up by ``sum``
and a hot source is pre-aggregated before any shuffle.  A group with fewer than
``MIN_GROUP`` documents takes the merged sketch of its language.

Only DataFrame functions are used.  Five-word windows of a text are compared by
64-bit hashes.  Defined cases: a null text has no words and fails the base rules;
texts of any length are measured whole; a null language or source counts as the empty string and
shares its group; ties and repeated rows get one verdict each; an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .common import WORD_BREAK, fresh, let, same, stored

#: Base rules.
MIN_WORDS, MAX_REPEAT_PCT, WINDOW = 10, 20, 5
#: Documents from which a group of language and source has fences of its own.
MIN_GROUP = 200
#: Fences: quartile -/+ REACH times the distance of the quartiles, taken as
#: LEAST at least (so that a group without spread keeps a margin).
REACH = 4
LEAST = {"word_len": 25, "symbol_rate": 50, "dup_line_rate": 100}
#: Words from which a document's mean word length is steady enough to judge.
MIN_WORDS_MEAN = 50
RATES = ("word_len", "symbol_rate", "dup_line_rate")


def _repeat_words(words: Column) -> Column:
    """Words that lie in a window of five words found twice or more."""
    def gram(w):
        return lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(WINDOW)])

    def covered(starts):
        return F.aggregate(
            F.sequence(F.lit(1), F.size(starts)), F.lit(0).cast("long"),
            lambda acc, k: acc + F.when(
                k < F.size(starts),
                F.least(F.lit(WINDOW), F.get(starts, k) - F.get(starts, k - 1))
            ).otherwise(F.lit(WINDOW)).cast("long"))

    def twice(s):  # s: sorted (hash, position)
        return F.array_sort(F.transform(F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda k: ((k > 0) & (F.get(s, k)["h"] == F.get(s, k - 1)["h"]))
            | (F.coalesce(F.get(s, k)["h"] == F.get(s, k + 1)["h"], F.lit(False)))),
            lambda k: F.get(s, k)["i"]))

    def count(h):
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")) \
            .otherwise(let(F.sort_array(F.transform(
                h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
                lambda s: let(twice(s), covered)))

    return let(words, lambda w: F.when(F.size(w) < WINDOW + 1, F.lit(0).cast("long"))
               .otherwise(let(F.transform(
                   F.sequence(F.lit(1), F.size(w) - WINDOW + 1), gram(w)), count)))


def measures(text: Column) -> Column:
    """Struct of a text's counts."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, WORD_BREAK), "")

    def of_words(w):
        return F.struct(F.size(w).cast("long").alias("n_words"),
                        F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
                        _repeat_words(w).alias("n_repeat_words"))

    def of_lines(ls):
        return F.struct(F.size(ls).cast("long").alias("n_lines"),
                        (F.size(ls) - F.size(F.array_distinct(ls))).cast("long")
                        .alias("n_dup_lines"))

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return F.struct(let(words, of_words).alias("w"), let(lines, of_lines).alias("l"),
                    F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long")
                    .alias("n_symbols"))


def counts(text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> Column:
    """A document's counts, rates, base verdict and group as one struct.

    It is one expression in which the measures are a bound variable: the optimizer
    copies a plain column's definition to every place that uses a field of it."""
    def of(m):
        words, lines = m["w"]["n_words"], m["l"]["n_lines"]
        failed = (words < MIN_WORDS) | \
            (100 * m["w"]["n_repeat_words"] > MAX_REPEAT_PCT * words)

        def rate(scale, top, bottom):
            return F.floor(scale * top / F.greatest(bottom, F.lit(1))).cast("long")

        return F.struct(
            _group(lang_col).alias("lang"), _group(source_col).alias("source"),
            words.alias("n_words"), m["w"]["word_chars"].alias("word_chars"),
            m["n_symbols"].alias("n_symbols"), m["l"]["n_dup_lines"].alias("n_dup_lines"),
            m["w"]["n_repeat_words"].alias("n_repeat_words"),
            failed.alias("base_failed"),
            rate(100, m["w"]["word_chars"], words).alias("word_len"),
            rate(1000, m["n_symbols"], words).alias("symbol_rate"),
            rate(1000, m["l"]["n_dup_lines"], lines).alias("dup_line_rate"))

    return let(measures(F.col(text_col)), of)


def _group(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _rates(m) -> Column:
    """(rate, v) of a document's rates; none if it fails the base rules."""
    pairs = F.array(*[F.struct(F.lit(r).alias("rate"), m[r].alias("v")) for r in RATES])
    return F.filter(pairs, lambda _: ~m["base_failed"])


def sketches(pairs: DataFrame) -> DataFrame:
    """Quantile sketches (rate, value, n) per language and source of (lang, source,
    p), where ``p`` holds the ``_rates`` of a document."""
    low = F.length(F.bin("v")) - 6  # bits beyond six significant ones
    mask = F.when(low > 0, F.expr("shiftleft(1L, length(bin(v)) - 6)")).otherwise(F.lit(1))
    # before a plain explode the optimizer puts a filter on the array's size, which
    # would work out the measures once more
    return (pairs.select("lang", "source", F.explode_outer("p").alias("p"))
            .select("lang", "source", "p.*").where("rate IS NOT NULL")
            .withColumn("value", F.col("v") - F.pmod("v", mask))
            .groupBy("lang", "source", "rate", "value").agg(F.count(F.lit(1)).alias("n")))


def _quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    up = W.Window.partitionBy(*keys).orderBy("value")
    cum = sketch.withColumn("cum", F.sum("n").over(up)) \
        .withColumn("total", F.sum("n").over(W.Window.partitionBy(*keys)))
    q = [F.min(F.when(4 * F.col("cum") >= k * F.col("total"), F.col("value")))
         for k in (1, 3)]
    return cum.groupBy(*keys).agg(q[0].alias("q1"), q[1].alias("q3"),
                                  F.max("total").alias("total"))


def fences(sketch: DataFrame) -> DataFrame:
    """One row per language and source: low and high fence of every rate."""
    own = _quartiles(sketch, ["lang", "source", "rate"])
    merged = _quartiles(sketch.groupBy("lang", "rate", "value").agg(F.sum("n").alias("n")),
                        ["lang", "rate"]).select(
        "lang", "rate", F.col("q1").alias("m1"), F.col("q3").alias("m3"))
    big = F.col("total") >= MIN_GROUP
    q1 = F.when(big, F.col("q1")).otherwise(F.col("m1"))
    q3 = F.when(big, F.col("q3")).otherwise(F.col("m3"))
    least = F.create_map(*[F.lit(x) for kv in LEAST.items() for x in kv])
    both = own.join(merged, ["lang", "rate"]) \
        .withColumn("step", REACH * F.greatest(q3 - q1, least[F.col("rate")])) \
        .select("lang", "source", "rate", (q1 - F.col("step")).alias("lo"),
                (q3 + F.col("step")).alias("hi"))
    aggs = [F.max(F.when(F.col("rate") == r, F.col(c))).alias(f"{r}_{c}")
            for r in RATES for c in ("lo", "hi")]
    return both.groupBy("lang", "source").agg(*aggs)


def _verdict(m, f) -> Column:
    """A measured rate beyond its fence rejects; without fences base rules."""
    bad = F.coalesce(m("symbol_rate") > f("symbol_rate_hi"), F.lit(False)) \
        | F.coalesce(m("dup_line_rate") > f("dup_line_rate_hi"), F.lit(False)) \
        | F.coalesce((m("n_words") >= MIN_WORDS_MEAN)
                     & ((m("word_len") < f("word_len_lo"))
                        | (m("word_len") > f("word_len_hi"))), F.lit(False))
    return ~(m("base_failed") | bad)


def score(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, counts, rates, base_failed, kept."""
    m = docs.select(F.col(id_col).alias("doc_id"), counts().alias("__m")) \
        .select("doc_id", "__m.*")
    rates = stored(m, "measures")
    pairs = rates.select("lang", "source", _rates(F.struct("base_failed", *RATES)).alias("p"))
    limits = stored(fences(sketches(pairs)), "fences")
    out = rates.join(limits, ["lang", "source"], "left")
    return out.withColumn("kept", _verdict(F.col, F.col))


def keep(docs: DataFrame) -> DataFrame:
    """The documents that pass, with the columns they came with.

    Measures are worked out twice (for the fences, then for the verdicts): that
    costs less than storing every text or shuffling it to its verdict.
    """
    (f,) = fresh(docs, "__f")
    pairs = docs.select(_group("lang").alias("lang"), _group("source").alias("source"),
                        let(counts(), _rates).alias("p"))
    limits = stored(fences(sketches(pairs)), "fences").select(F.struct("*").alias(f))
    out = docs.join(limits, (_group("lang") == F.col(f"{f}.lang"))
                    & (_group("source") == F.col(f"{f}.source")), "left")
    return out.where(let(counts(), lambda m: _verdict(
        lambda c: m[c], lambda c: F.col(f"{f}.{c}")))).select(*same(docs))
