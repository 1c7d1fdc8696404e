"""The thin registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (audit, bpe, exact_dedup, orc_tokens, packing, quality, quotation, sharding,
               simhash, substring, suffixes, topk, whitening)
from .common import stored, table

#: Where the public tokenizers lie; a parameter, never copied.
TOKENIZERS = "/opt/tokenizers"


def tokenizer(name: str) -> str:
    try:
        import public_tokenizers
    except ImportError:
        return f"{TOKENIZERS}/{name}"
    return public_tokenizers.path(name)


def op1_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its words of 50-word windows seen earlier."""
    return substring.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed",
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    path = tokenizer("byte_bpe_50k.json")
    ids = bpe.encode(table(spark, sf_dir, "documents"), path)
    return bpe.decode(ids, path).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op3_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written as ORC and read back."""
    out = orc_tokens.scratch(spark)
    orc_tokens.write(table(spark, sf_dir, "documents"), out,
                     tokenizer("word_bpe_49k.json"), end_id=2)
    rows = stored(orc_tokens.placed(orc_tokens.read(spark, out)), "placed")
    return orc_tokens.with_start(rows).select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its bytes of 200-byte strings found elsewhere."""
    return suffixes.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op6_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 ids."""
    return packing.pack(table(spark, sf_dir, "documents"),
                        tokenizer("word_bpe_49k.json"), end_id=0)


def op7_slot_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 40 shards of near equal bytes."""
    out = sharding.shard(table(spark, sf_dir, "documents"), n_shards=40)
    return out.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"),
        "shard", F.col("position").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "vslot")


def op8_kd_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best inner products of every hundredth vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=10, every=100)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality.score(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept")


def op10_chat_quotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations in reply order, without quotes."""
    return quotation.format_chat(table(spark, sf_dir, "conversations"))


def op11_tree_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of its equal texts."""
    return exact_dedup.classes(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept",
        F.lower(F.hex("sha")).alias("text_sha256"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of the 120 orders of five filters removes, per source."""
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings whitened on their sixteen first components."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_recompression, op2_bpe, op3_orc_tokens, op4_simhash, op5_suffix_array,
    op6_best_fit, op7_slot_sharding, op8_kd_top_k, op9_quality_rules, op10_chat_quotation,
    op11_tree_merge, op12_filter_audit, op13_whitening)}
