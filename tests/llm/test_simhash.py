import random

import xxhash
from pyspark.sql import functions as F

from panelforge.llm import simhash
from panelforge.llm.components import components


def brute_print(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = low.encode().split()
    grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints):
    """prints: list of (doc_id, fp)."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i][1] ^ prints[j][1]).count("1") <= 4:
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(prints):
        low[find(i)] = min(low.get(find(i), d), d)
    return [low[find(i)] for i in range(len(prints))]


def corpus():
    rng = random.Random(5)
    vocab = [f"Wort{i}é" for i in range(300)]
    texts = [None, "", " \t", "one", "Two words", "a b c", "a b c d"]
    for _ in range(25):
        base = [rng.choice(vocab) for _ in range(rng.randint(60, 300))]
        for _ in range(rng.randint(1, 6)):
            new = list(base)
            for _ in range(rng.randint(0, 3)):
                new[rng.randrange(len(new))] = rng.choice(vocab)
            texts.append(" ".join(new))
    texts.append("x " * 70_000)
    return texts


def test_against_brute_force(make_docs):
    texts = corpus()
    docs = make_docs(texts).withColumn("fp", F.lit(0)).withColumn("component_id", F.lit(1))
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    prints = [(i, brute_print(t)) for i, t in enumerate(texts)]
    assert [got[i].fp & (1 << 64) - 1 for i in range(len(texts))] == [p for _, p in prints]
    assert [got[i].component_id for i in range(len(texts))] == brute_components(prints)


def test_blocks_of_a_hot_key_lose_no_link(spark):
    rng = random.Random(1)
    centre = rng.getrandbits(63)
    fps = {centre}
    while len(fps) < 700:
        x = rng.choice([centre, *list(fps)[:50]])
        for b in rng.sample(range(64), rng.randint(1, 7)):
            x ^= 1 << b
        fps.add(x)
    fps = sorted(x if x < 1 << 63 else x - (1 << 64) for x in fps)
    reps = spark.createDataFrame([(x,) for x in fps], "fp long")
    prints = [(x, x & (1 << 64) - 1) for x in fps]
    for block in (37, 4096):
        roots = {r.node: r.root for r in
                 components(simhash.candidate_links(reps, 4, block)).collect()}
        assert [roots.get(x, x) for x in fps] == brute_components(prints)


def test_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(900, 901)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert set(got) == set(range(1, 201)) | {901}
    assert all(got[i] == 0 for i in range(1, 201)) and got[901] == 900


def test_keep_one(make_docs, no_rows):
    text = " ".join(f"w{i}" for i in range(80))
    docs = make_docs([(3, text), (1, text), (7, "other words here now"), (1, text), (None, "zz")])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "7", "None"]
    assert simhash.keep_one(no_rows).count() == 0


def test_keep_one_chooses_rows(make_docs):
    rng = random.Random(2)
    clean = [" ".join(f"t{i}w{k}x{rng.getrandbits(20)}" for k in range(90)) for i in range(24)]
    rows = [(None, t) for t in clean[:20]] + [(None, clean[3])]  # null ids, unlike texts
    rows += [(8, clean[20]), (None, clean[20]), (None, clean[20])]  # copies of a row with an id
    rows += [(5, clean[21]), (5, clean[22])]  # one id, unlike texts
    rows += [(4, clean[23]), (5, clean[23]), (4, clean[23])]  # 5 is a copy of 4 here
    prints = [(i, brute_print(t)) for i, t in enumerate(clean)]
    assert len(set(brute_components(prints))) == len(clean)
    got = simhash.keep_one(make_docs(rows)).collect()
    want = [(None, t) for t in clean[:20]] + [(8, clean[20]), (5, clean[21]), (5, clean[22]),
                                              (4, clean[23])]
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(want, key=str)
