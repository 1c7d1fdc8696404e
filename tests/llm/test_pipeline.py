"""The pipeline against a brute-force version of each of its stages."""
import random
import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from panelforge.llm import quality
from panelforge.llm.queries import tokenizer

from .test_simhash import brute_components, brute_print
from .test_suffixes import brute

COLS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    rng = random.Random(8)
    vocab = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in "lmnrst"]
    prose = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    passage = prose(60)
    texts = [prose(rng.randint(40, 160)) for _ in range(60)]
    texts += [texts[3], texts[3], texts[4] + " x", "too short", None, "", "same " * 50]
    texts += [prose(40) + " " + passage + " é " + prose(30) for _ in range(4)]
    texts += [" ".join("###" + w for w in texts[1].split())]
    return [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]


def test_against_brute_force(spark, tmp):
    rows = corpus()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .repartition(3).write.parquet(tmp + "/sf/documents.parquet")
    got = corpus_pipeline.run(spark, tmp + "/sf").collect()

    scored = quality.score(spark.read.parquet(tmp + "/sf/documents.parquet")).collect()
    kept = {r.doc_id for r in scored if r.kept}
    left = [(d, t) for d, t, *_ in rows if d in kept]
    assert set(range(60)) <= kept and not kept & {63, 64, 65, 66, 71}
    low = brute_components([(d, brute_print(t)) for d, t in left])
    left = [(d, t) for (d, t), c in zip(left, low) if c == d]
    assert not {60, 61} & {d for d, _ in left}
    cut = {int(d): k.decode("utf-8", "ignore") for d, _, k, _ in brute(left, 200)}
    assert any(len(cut[d]) < len(t) for d, t in left)
    lib = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    want = {}
    for d, t in cut.items():
        ids = np.array([*lib.encode(t, add_special_tokens=False).ids, 0], "<u4")
        want[d] = (len(ids), zlib.crc32(ids.tobytes()))
    assert {r.doc_id: (r.length, r.ids_crc32) for r in got} == want
    total = sum(n for n, _ in want.values())
    assert len({r.sequence_id for r in got}) <= -(-total // 2048) + 1


def test_stages_keep_columns_and_stand_empty_tables(spark, make_docs, no_rows):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = make_docs(["a b", None]).toDF("doc_id", "text", "lang", "source", "n_chars") \
            .selectExpr("*", "1 as row", "2 as fp", "3 as `a.b`", "array(1) as runs")
        assert stage(spark, docs, "").columns == docs.columns, name
        assert stage(spark, no_rows, "").count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, no_rows, "").count() == 0
