import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelforge.llm import bpe, orc_tokens, packing, tokens
from panelforge.llm.queries import tokenizer

BYTES, WORDS = tokenizer("byte_bpe_50k.json"), tokenizer("word_bpe_49k.json")


def texts():
    rng = random.Random(2)
    fixed = [None, "", " ", "  a", "a  \n", "it's 's x's 'll''s don't'VE I'm",
             "a<|endoftext|> b <|endoftext|><|startoftext|>x", "ΑΣ ΟΔΟΣ Σ", "İ DŽ ﬁ é Å",
             "a" * 500, "\x1c\x85᠎​x", "日本語 テスト 🙂🙂", "ab" * 4000 + "!" * 99,
             "one two " * 3000, "same text", "same text"]
    return fixed + ["".join(rng.choice(" ab'sABé1.\n\tΣ<|日") for _ in range(rng.randint(1, 80)))
                    for _ in range(300)]


def library(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


def test_encode_and_decode_equal_the_library(make_docs):
    docs = make_docs(texts()).withColumn("ids", F.lit(1))
    rows = bpe.decode(bpe.encode(docs, BYTES), BYTES).collect()
    lib = Tokenizer.from_file(BYTES)
    assert len(rows) == len(texts())
    for r in rows:
        want = lib.encode(texts()[r.doc_id] or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == want
        assert r.decoded == lib.decode(want, skip_special_tokens=False)


def test_verification_is_exact():
    """A pair passes if and only if exact merging leaves it as it is."""
    v = bpe.vocabulary(BYTES)
    rng = np.random.default_rng(1)
    words = [" the", "ing", " and", "aaaa", " ", "é"] * 3
    syms = np.concatenate([v.longest([w.encode() for w in words])[0],
                           rng.integers(0, len(v.left), 3000)])
    a, b = rng.choice(syms, 20_000), rng.choice(syms, 20_000)
    text = {i: v.bytes_of[int(v.id_of[i])] for i in set(a.tolist() + b.tolist())}
    exact = [m.tolist() == [x, y] for m, x, y in
             zip(v.merge([text[x] + text[y] for x, y in zip(a.tolist(), b.tolist())]),
                 a.tolist(), b.tolist())]
    assert v.compatible(a, b).tolist() == exact


def test_memory_of_words_may_run_out(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    monkeypatch.setattr(tokens, "REMEMBERED", 20)
    v, w = bpe.Vocabulary(BYTES), tokens.WordTokenizer(WORDS)
    for t in texts()[1:80]:
        assert np.frombuffer(v.encode([t])[0], "<u4").tolist() == library(BYTES, t)
        assert w.encode([t])[0].tolist() == library(WORDS, t)


def test_orc_files(spark, make_docs, no_rows, tmp):
    docs = make_docs(texts() + [(3, "again")]).repartition(5).withColumn("block", F.lit(9))
    orc_tokens.write(docs, tmp + "/o", WORDS, 2)
    back = orc_tokens.read(spark, tmp + "/o")
    rows = sorted(orc_tokens.with_start(orc_tokens.placed(back)).collect(),
                  key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted([*range(len(texts())), 3])
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
        if r.doc_id != 3:
            ids = np.array([*library(WORDS, texts()[r.doc_id]), 2], "<u4")
            assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))
    assert orc_tokens.find(spark, tmp + "/o", [3, 5]).count() == 3
    orc_tokens.write(no_rows, tmp + "/e", WORDS, 2)
    assert orc_tokens.with_start(orc_tokens.placed(orc_tokens.read(spark, tmp + "/e"))).count() == 0


def check_plan(counts, capacity):
    plan = packing.Plan(dict(counts), capacity)
    cells, seen = {}, {}
    for length, first, last, seq, offset in plan.runs:
        for k in range(first, last + 1):
            assert seen.setdefault((length, k), 0) == 0
            seen[length, k] = 1
            cells.setdefault(seq + k - first, []).append((offset, length))
    assert {x: sum(1 for y, _ in seen if y == x) for x in counts} == dict(counts)
    for inside in cells.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(cells) == plan.sequences
    return plan.sequences


def best_fit_decreasing(counts, capacity):
    rooms = []
    for x in sorted((x for x, c in counts.items() for _ in range(c)), reverse=True):
        fit = min((r for r in rooms if r >= x), default=None)
        if fit is None:
            rooms.append(capacity - x)
        else:
            rooms[rooms.index(fit)] -= x
    return len(rooms)


def test_plans():
    rng = random.Random(7)
    assert check_plan({100: 4}, 100) == 4
    assert check_plan({60: 3, 40: 2, 30: 1}, 100) == 3
    assert check_plan({1: 1000}, 64) == 16
    for _ in range(300):
        cap = rng.choice([10, 37, 100, 256])
        counts = {rng.randint(1, cap): rng.randint(1, 9) for _ in range(rng.randint(1, 40))}
        got = check_plan(counts, cap)
        low = -(-sum(x * c for x, c in counts.items()) // cap)
        assert low <= got <= best_fit_decreasing(counts, cap) + 1


def test_packing(spark, make_docs, no_rows):
    docs = make_docs(texts() + [(3, "again")]).repartition(4).withColumn("part", F.lit("x"))
    rows = packing.pack(docs, WORDS, 0, capacity=64, with_ids=True).collect()
    cells = {}
    for r in rows:
        assert len(r.ids) == r.length and r.piece * 64 == r.start
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        cells.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for inside in cells.values():
        at = 0
        for o, n in sorted(inside):
            assert o == at
            at += n
        assert at <= 64
    for i, t in enumerate(texts()):
        if i != 3:
            got = [x for r in sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece)
                   for x in r.ids]
            assert got == [*library(WORDS, t), 0]
    assert packing.pack(no_rows, WORDS, 0).count() == 0


def test_digests(make_docs):
    row = bpe.encode(make_docs(["ab"]), BYTES).first()
    assert hashlib.sha256(bytes(row.ids)).hexdigest() == hashlib.sha256(
        np.array(library(BYTES, "ab"), "<u4").tobytes()).hexdigest()


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        tokens.WordTokenizer.__init__(object.__new__(tokens.WordTokenizer), BYTES)


def test_ids_equal_the_library_beside_any_character():
    """Every code point alone, between signs, beside combining marks and twice."""
    from tokenizers import Tokenizer
    path = tokenizer("word_bpe_49k.json")
    ours, lib = tokens.WordTokenizer(path), Tokenizer.from_file(path)
    points = [*range(0xD800), *range(0xE000, 0x33500), *range(0xE0000, 0xE0200)]
    for form in ("{0}", "!{0}!", "a{0}\u0327b", "{0}\u0301 {0}\u03a3", "A{0}{0}'s x{0}"):
        texts = [form.format(chr(c)) for c in points]
        want = lib.encode_batch_fast(texts, add_special_tokens=False)
        bad = [c for c, x, y in zip(points, ours.encode(texts), want) if x.tolist() != y.ids]
        assert not bad, (form, [hex(c) for c in bad[:5]])
    for text in ("!\u088f!", "!\ua7dd!", "\u0130\u0327", "a\u08d3\u0327",
                 "<|endoftext|>\u088f<|endoftext|> x", "plain <|endoftext|>"):
        assert ours.encode([text, "x"])[0].tolist() == lib.encode(text, add_special_tokens=False).ids
    latin = "éèêçüßäöóñíÉÈÑÇÜÖÄÊÓÍ«»“”–—…€ Ελληνικά русский 日本語 한국어"
    assert not ours.rare.search(latin)  # the languages of the tables take the quick way


def test_many_rows_of_one_id_are_dealt_over_tasks(spark, make_docs):
    rows = [(None, f"null {i}") for i in range(300)] + [(7, "same")] * 300 + \
        [(i, f"own {i}") for i in range(300)]
    docs = make_docs(rows).repartition(4)
    path = tokenizer("word_bpe_49k.json")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = orc_tokens.tokenised(docs, path, 2).select("doc_id", "block").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(out) == 900
    assert len({r.block for r in out if r.doc_id is None}) > 1
    assert len({r.block for r in out if r.doc_id == 7}) > 1
    ids = [r.doc_id for r in sorted(out, key=lambda r: r.block)]
    assert [i for i in ids if i is not None] == sorted(i for i in ids if i is not None)


def test_find_skips_what_cannot_hold_an_id(spark, tmp):
    """Statistics, row indexes and Bloom filters spare the scan most rows."""
    docs = spark.range(0, 60_000, 2).selectExpr("id as doc_id", "sha2(string(id), 256) as text")
    orc_tokens.write(docs, tmp + "/orc", tokenizer("word_bpe_49k.json"), end_id=2)

    def scanned(doc_id):
        df = orc_tokens.find(spark, tmp + "/orc", [doc_id])
        ids = [r.doc_id for r in df.collect()]
        scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        return ids, scan.metrics().apply("numOutputRows").value()

    ids, rows = scanned(37_776)
    assert ids == [37_776] and 0 < rows <= 2 * orc_tokens.ROW_INDEX
    ids, rows = scanned(37_777)  # inside the range of its row group: the Bloom filter
    assert ids == [] and rows == 0


def test_chunks_are_cut_once_however_often_they_occur():
    """The word pattern sees each different chunk of a call, not all text."""
    seen = []

    class Pattern:
        def findall(self, text):
            seen.append(text)
            return words.findall(text)

    w = tokens.WordTokenizer(WORDS)
    words, w.words = w.words, Pattern()
    passage = "It's one, two　three ΟΔΟΣ, <|endoftext|>x! a b"
    texts = [f"{passage} {i}" for i in range(500)]
    got = w.encode(texts)
    assert all(g.tolist() == library(WORDS, t) for g, t in zip(got[::50], texts[::50]))
    assert len(seen) < 520


def test_steps_hold_every_row_in_order(monkeypatch):
    monkeypatch.setattr(tokens, "TOGETHER", 10)
    texts = ["", "abc", "é" * 40, "", "x" * 9, "y", "z" * 10, ""]
    batch = pa.record_batch([pa.array(range(8)), pa.array(texts)], names=["doc_id", "text"])
    parts = list(tokens.steps(batch))
    assert [t for p in parts for t in p.column("text").to_pylist()] == texts
    assert len(parts) > 3 and all(p.num_rows for p in parts)
    assert list(tokens.steps(batch.slice(0, 0))) == []
    assert [p.num_rows for p in tokens.steps(batch.slice(3, 2))] == [2]
