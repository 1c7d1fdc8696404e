"""The thin queries on the smallest tables: columns, rows and, where SQL can
express the operator, values."""
import os
import sys

import duckdb
import pandas as pd
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

from check_oracle import ALL, digest  # noqa: E402
from panelforge.llm.oracle import oracle_sql  # noqa: E402
from panelforge.llm.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_recompression": "doc_id n_words n_removed kept_sha256",
    "op2_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op3_orc_tokens": "doc_id start n_tokens ids_crc32",
    "op4_simhash": "doc_id fingerprint component_id",
    "op5_suffix_array": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op6_best_fit": "doc_id piece start length ids_crc32 sequence_id offset",
    "op7_slot_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op8_kd_top_k": "query_id rank vec_id score",
    "op9_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words"
                         " base_failed kept",
    "op11_tree_merge": "doc_id keep_id group_size kept text_sha256",
    "op12_filter_audit": "part filter_order step kept removed redundant unique_fails good_lost"
                         " toxic_lost shapley",
    "op13_whitening": "vec_id component n deviation whitened explained identity_error",
    "op10_chat_quotation": "conv_id turn role parent_turn root_turn depth n_quoted body chat",
}
INTS = {"piece", "rank", "shard", "grown_shard", "step", "component"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_rows(spark, name):
    df = QUERIES[name](spark, SF)
    kinds = dict(df.dtypes)
    assert set(COLUMNS[name].split()) <= set(kinds)
    assert all(kinds[c] == "int" for c in INTS & set(kinds))
    got = df.toPandas()
    if "doc_id" in kinds:
        want = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").toPandas()
        assert set(got["doc_id"]) == set(want["doc_id"])
        if name != "op6_best_fit":
            assert len(got) == len(want)
    if name in oracle_sql():
        con = duckdb.connect()
        for t in ALL:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        other = con.execute(oracle_sql()[name]).fetchdf()
        clean = [d.astype(object).where(d.notna(), None) for d in (got, other)]
        assert digest(pd.DataFrame(clean[0])) == digest(pd.DataFrame(clean[1]))


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
