"""The thin queries on the whole smallest tables against brute force: every value
of their contracts, digests and spans included."""
import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from panelforge.llm.queries import QUERIES, tokenizer

from . import test_whitening
from .test_simhash import brute_components, brute_print
from .test_substring import brute as brute_words
from .test_topk import brute as brute_topk

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return sorted((r.doc_id, r.text or "") for r in rows)


def got(spark, name, columns):
    rows = QUERIES[name](spark, SF).select(*columns.split()).collect()
    return sorted(tuple(r) for r in rows)


def sha(b):
    return hashlib.sha256(b).hexdigest()


def u32(ids):
    return np.array(ids, "<u4").tobytes()


def test_op1(spark, docs):
    want = sorted((d, n, gone, sha(kept.encode())) for d, n, gone, kept in brute_words(docs, 50))
    assert got(spark, "op1_recompression", "doc_id n_words n_removed kept_sha256") == want
    assert any(w[2] for w in want)


def test_op2(spark, docs):
    lib = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    want = []
    for d, t in docs:
        ids = lib.encode(t, add_special_tokens=False).ids
        text = lib.decode(ids, skip_special_tokens=False)
        want.append((d, len(ids), sha(u32(ids)), sha(text.encode())))
    assert got(spark, "op2_bpe", "doc_id n_tokens ids_sha256 decoded_sha256") == want


def test_op3(spark, docs):
    lib = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    want, start = [], 0
    for d, t in docs:
        ids = [*lib.encode(t, add_special_tokens=False).ids, 2]
        want.append((d, start, len(ids), zlib.crc32(u32(ids))))
        start += len(ids)
    assert got(spark, "op3_orc_tokens", "doc_id start n_tokens ids_crc32") == want


def test_op4(spark, docs):
    prints = [(d, brute_print(t)) for d, t in docs]
    want = [(d, f"{p:016x}", c) for (d, p), c in zip(prints, brute_components(prints))]
    assert got(spark, "op4_simhash", "doc_id fingerprint component_id") == want
    assert any(d != c for d, _, c in want)


def test_op5(spark, docs):
    texts = [(d, t.encode()) for d, t in docs]
    count = Counter(hash(t[i:i + 200]) for _, t in texts for i in range(len(t) - 199))
    want = []
    for d, t in texts:
        step = np.zeros(len(t) + 1, int)
        for i in range(len(t) - 199):
            if count[hash(t[i:i + 200])] > 1:
                step[i] += 1
                step[i + 200] -= 1
        gone = np.cumsum(step)[:-1] > 0
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        want.append((d, len(t), int(gone.sum()), runs, sha(kept)))
    assert got(spark, "op5_suffix_array", "doc_id n_bytes n_removed n_spans kept_sha256") == want
    assert any(w[3] > 1 for w in want)


def test_op6(spark, docs):
    lib = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    want, total = [], 0
    for d, t in docs:
        ids = [*lib.encode(t, add_special_tokens=False).ids, 0]
        total += len(ids)
        want += [(d, p, 2048 * p, len(x), zlib.crc32(u32(x))) for p, x in enumerate(
            ids[i:i + 2048] for i in range(0, len(ids), 2048))]
    rows = QUERIES["op6_best_fit"](spark, SF).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for x in places.values():
        at = 0
        for offset, length in sorted(x):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) <= -(-total // 2048) + 1


def test_op8(spark):
    rows = [(r.vec_id, r.embedding, None) for r in
            spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert got(spark, "op8_kd_top_k", "query_id rank vec_id score") == sorted(brute_topk(rows))


def test_op13(spark, monkeypatch):
    rows = [(r.vec_id, list(r.embedding), None) for r in
            spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    out = test_whitening.check(spark, rows)
    key = lambda r: (r.vec_id, r.component, r.n, r.deviation)
    assert sorted(map(key, QUERIES["op13_whitening"](spark, SF).collect())) == sorted(map(key, out))
