import zlib

import numpy as np
from pyspark.sql import functions as F

from panelforge.llm import quality, sharding


def test_shards_are_even_and_gapless(make_docs):
    texts = ["x" * (i * 37 % 900) for i in range(600)] + [None, ""]
    rows = sharding.shard(make_docs(texts), 7).collect()
    assert sorted(r.id for r in rows) == list(range(len(texts)))
    load = [sum(r["size"] for r in rows if r.shard == s) for s in range(7)]
    assert max(load) - min(load) <= 20
    for s in range(7):
        at = sorted(r.position for r in rows if r.shard == s)
        assert at == list(range(len(at)))
    assert {r.id: r.text_crc32 for r in rows} == {
        i: zlib.crc32((t or "").encode()) for i, t in enumerate(texts)}


def test_repeated_rows_and_empty(make_docs, no_rows):
    rows = sharding.shard(make_docs([(1, "a"), (1, "a"), (None, None)]), 3).collect()
    assert len(rows) == 3 and len({(r.shard, r.position) for r in rows}) == 3
    assert sharding.shard(no_rows, 3).count() == 0


def test_a_third_of_equal_rows_stays_near_equal(spark, make_docs):
    rows = [(5, "hot " * 20)] * 900 + [(None, None)] * 300 + [(i, f"t{i}" * 9) for i in range(1500)]
    out = sharding.shard(make_docs(rows).repartition(9), 8).collect()
    assert sorted((-1 if r.id is None else r.id, r["size"], r.text_crc32) for r in out) == sorted(
        (-1 if i is None else i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))
        for i, t in rows)
    load = [sum(r["size"] for r in out if r.shard == s) for s in range(8)]
    assert max(load) - min(load) <= 100
    for s in range(8):
        at = sorted(r.position for r in out if r.shard == s)
        assert at == list(range(len(at)))


def test_versions_of_a_stored_map(spark, make_docs, tmp):
    docs = make_docs(["x" * (i * 37 % 900) for i in range(900)]).selectExpr(
        "*", "1 as vslot", "2 as size", "3 as number", "4 as part", "5 as rid")
    where = tmp + "/map"

    def run(n):
        return {r.id: r.shard for r in sharding.shard(docs, n, n_slots=512, map_path=where).collect()}

    first, again = run(4), run(4)
    assert again == first  # nothing to move
    grown = run(5)
    moved = [grown[i] for i in grown if grown[i] != first[i]]
    assert moved.count(4) >= 0.9 * len(moved) and len(moved) < 0.3 * len(grown)
    shrunk = run(3)
    assert set(shrunk.values()) == {0, 1, 2}
    maps = {v: {r.vslot: r.shard for r in sharding.load_map(spark, where, v).collect()}
            for v in range(5)}
    assert [len(m) for m in maps.values()] == [512] * 5
    assert maps[1] == maps[2] and max(maps[3].values()) == 4
    newest = sharding.load_map(spark, where)
    assert {r.version for r in newest.collect()} == {4}
    assert sharding.load_map(spark, tmp + "/none") is None


def test_the_query_against_brute_force(spark):
    from panelforge.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op7_slot_sharding"](spark, sf).collect()
    want = {r.doc_id: (len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode()))
            for r in docs}
    assert {r.doc_id: (r["size"], r.text_crc32) for r in got} == want and len(got) == len(want)
    load = [sum(r["size"] for r in got if r.shard == s) for s in range(40)]
    total, largest = sum(load), max(n for n, _ in want.values())
    assert max(load) <= max(largest, total / 40 + largest) and sum(x > 0 for x in load) == 40


def test_a_version_moves_only_what_it_must():
    weight = np.full(64, 10)
    first = sharding.first_map(64, 4)
    assert (sharding.rebalance(first, weight, 4) == first).all()
    grown = sharding.rebalance(first, weight, 5)
    assert set(grown[grown != first]) == {4}


def brute(text):
    words = [w for w in (text or "").replace("\x0b", " ").replace("\x0c", " ").split()]
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    hit = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\r\x0b\x0c")]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(hit))


def test_counts(make_docs):
    texts = ["a b c d e a b c d e f", "a a a a a a a", "x\nx\n \n\nx # <", "", None,
             "é ü ß " * 9, " \t lead\x0b\x0ctrail \r\n", "a b \x1c c", "w " * 3000]
    got = {r.doc_id: r for r in quality.score(make_docs(texts)).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        n, chars, symbols, dup, rep = brute(t)
        if "\x1c" in (t or ""):
            n, chars = 3, 5
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) \
            == (n, chars, symbols, dup, rep), t
        assert r.base_failed == (n < 10 or 100 * rep > 20 * n)
        assert not (r.kept and r.base_failed)


def test_adaptive_fence_rejects_what_its_source_lacks(make_docs, no_rows):
    clean = [" ".join(f"w{i * 7 % 97}x{j}" for j in range(60)) for i in range(300)]
    junk = " ".join(f"w{j}###" for j in range(60))
    docs = make_docs([*clean, junk]).withColumn("kept", F.lit("theirs")) \
        .withColumn("__m", F.lit(1))
    kept = quality.keep(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == list(range(300))
    assert quality.keep(no_rows).count() == 0
