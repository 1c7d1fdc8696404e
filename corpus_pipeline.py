"""Corpus pipeline: quality rules, near-duplicates, repeated spans, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``; what a stage stored on the
way is deleted then.  All but the last return the columns they were given.

Defined cases, in every stage: a null text is empty (the quality rules reject
it), texts of any length are worked on whole; a null id takes part like any other
and is the last choice among near copies; of rows equal in id and text one stays
where they are near copies of each other, and ties go to the smaller id; an empty
table gives no rows; further columns are carried along unread.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.llm import packing, quality, simhash, suffixes
from panelforge.llm.common import table
from panelforge.llm.queries import tokenizer
from panelforge.session import drop_scratch_since, scratch_mark, scratch_path


def quality_rules(spark, docs, sf_dir):
    """Documents that the quality rules reject go."""
    return quality.keep(docs)


def simhash_near_dedup(spark, docs, sf_dir):
    """Of each group of near-duplicates the document of smallest id stays."""
    return simhash.keep_one(docs)


def suffix_array_dedup(spark, docs, sf_dir):
    """Spans of 200 bytes or more that are found elsewhere are cut out."""
    out = suffixes.cut(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def best_fit_packing(spark, docs, sf_dir):
    """What is left, in sequences of at most 2048 tokens."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"), end_id=0)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: SQL cannot express fingerprints, suffix arrays or tokenizers; the pipeline is
#: tested against a brute-force version instead.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        mark, path = scratch_mark(spark), scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.schema(docs.schema).parquet(path)
        drop_scratch_since(spark, mark, path)
    return STAGES[-1][1](spark, docs, sf_dir)
