import hashlib
import random

import pytest
from pyspark.sql import functions as F

from panelforge.llm import exact_dedup

SPACES = "\t\n\x0b\x0c\r "


def brute(rows):
    """Multiset of (doc_id, keep_id, size, kept, sha) of (id, text) in order."""
    groups = {}
    for at, (i, t) in enumerate(rows):
        bare = "".join(c for c in t or "" if c not in SPACES)
        groups.setdefault(bare, []).append((-len(t or ""), i is None, i or 0, at, i))
    out = []
    for bare, g in groups.items():
        best = min(g)
        sha = hashlib.sha256(bare.encode()).hexdigest()
        out += [(x[4], best[4], len(g), x is best, sha) for x in g]
    return out


def got(df, **how):
    out = exact_dedup.classes(df, **how).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")))
    return [tuple(r) for r in out.collect()]


def same(a, b):
    assert sorted(a, key=repr) == sorted(b, key=repr)


@pytest.mark.parametrize("parts,radix", [(1, 16), (5, 2), (24, 3), (24, 16)])
def test_against_brute_force(spark, make_docs, parts, radix):
    rng = random.Random(parts)
    texts = ["".join(rng.choice("ab \n") for _ in range(rng.randint(0, 5))) for _ in range(400)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    rows += [(None, None), (None, "ab"), (None, "a b"), (7, " a"), (7, " a"), (9, " "),
             (10, "  "), (11, "é" * 5), (12, "x" * 300_000), (13, "x " * 300_000)]
    df = make_docs(rows).repartition(parts).cache()
    order = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    same(got(df, radix=radix), brute(order))


def test_hot_text_over_many_holders(spark, make_docs):
    rows = [(i, "same  text" if i % 3 == 0 else f"own {i}") for i in range(3000)]
    df = make_docs(rows).repartition(40)
    out = got(df, radix=4)
    same(out, brute(rows))
    assert sum(r[3] for r in out) == 2001
    same(got(df, radix=4, holders=3), out)  # partitions share holders


def test_a_level_takes_one_entry_per_run(spark, make_docs):
    df = make_docs([(i, "hot") for i in range(1000)]).repartition(16)
    rows = exact_dedup.digests(df).withColumn("size", F.lit(1).cast("long"))
    first = exact_dedup.fold(rows)
    assert first.count() == 16 and first.agg(F.sum("size")).first()[0] == 1000
    assert exact_dedup.shape(16, 4) == (4, 2) and exact_dedup.shape(1) == (2, 1)
    assert exact_dedup.shape(33, 16) == (6, 2)


def test_unlike_texts_of_one_digest_stay_apart(spark):
    rows = spark.createDataFrame(
        [(0, 5, bytearray([a]), o, 3, i, i, 1) for i, (a, o) in
         enumerate([(1, 9), (2, 9), (1, 9), (1, 8)])], exact_dedup.RUN)
    out = exact_dedup.tree_merge(rows.coalesce(1), 1)
    assert sorted((bytes(r.sha), r.octets, r.id, r["size"]) for r in out.collect()) == \
        [(b"\x01", 8, 3, 1), (b"\x01", 9, 0, 2), (b"\x02", 9, 1, 1)]


def test_empty_and_clashing_columns(spark, no_rows):
    assert got(no_rows) == []
    df = spark.createDataFrame([(1, "a b", "x", 3), (2, "ab", "y", 4)],
                               "doc_id long, text string, holder string, digest int")
    same(got(df), brute([(1, "a b"), (2, "ab")]))
