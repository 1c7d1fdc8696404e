import duckdb
import pandas as pd

from panelforge.llm import oracle, quotation

SCHEMA = "conv_id long, turn long, role string, text string"
ROWS = [
    (1, 0, "user", "Hello all.\nThe plan is ready."),
    (1, 1, "assistant", "Which plan?"),
    (1, 2, "user", "Ann wrote:\n> the  PLAN is ready.\nGood."),
    (1, 3, "user", "> > The plan is ready.\n> Good.\nAgreed.\nMore."),
    (1, 4, "user", "> Nobody said this\nOdd."),
    (1, 5, "user", "> Hello all. The plan\n> is ready.\nRewrapped."),
    (1, 6, "user", ">> Good.\n> Agreed. more.\nDeep"),
    (1, 6, "user", ">> Good.\n> Agreed. more.\nDeep"),
    (2, 0, "user", "> The plan is ready.\nOther conversation"),
    (2, 1, None, None), (2, 2, "user", ""), (None, 3, "user", "> x"),
    (2, None, "user", "> Other conversation\ny"), (3, 0, "user", "x > y")]


def test_links_threads_and_sql(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = quotation.format_chat(df.withColumn("body", df.text)).toPandas()
    by = {(r.conv_id, r.turn): r for r in got.itertuples()}
    assert [by[1, t].parent_turn for t in (2, 3, 5, 6)] == [0, 2, 0, 3]
    assert by[1, 6].root_turn == 0 and by[1, 6].depth == 3
    assert by[1, 2].body == "Good." and pd.isna(by[1, 4].parent_turn)
    assert len(got) == len(ROWS)
    con = duckdb.connect()
    con.register("conversations_df", pd.DataFrame(ROWS, columns=["conv_id", "turn", "role", "text"]))
    con.sql("create view conversations as select conv_id::bigint as conv_id,"
            " turn::bigint as turn, role, text from conversations_df")
    want = con.sql(oracle.chat_sql()).df()
    flat = lambda d: sorted(
        tuple("-" if pd.isna(x) else str(x).removesuffix(".0") for x in r)
        for r in d[sorted(d.columns)].itertuples(index=False))
    assert flat(got) == flat(want)


def test_empty(spark):
    assert quotation.format_chat(spark.createDataFrame([], SCHEMA)).count() == 0


def test_hot_conversation_line(spark):
    rows = [(1, t, "user", "ok" if t % 2 == 0 else "> ok\nfine") for t in range(400)]
    got = quotation.format_chat(spark.createDataFrame(rows, SCHEMA))
    assert got.where("parent_turn = 0").count() == 200


def test_reply_order(spark):
    """Messages stand behind what they answer; a generated tree of replies."""
    import random
    rng = random.Random(5)
    rows, parent = [], {}
    for conv in range(40):
        said = []
        for t in range(rng.randint(2, 14)):
            text = f"message {conv} number {t} says {rng.random()}"
            if said and rng.random() < 0.8:
                p = rng.randrange(len(said))
                parent[conv, t] = p
                rows.append((conv, t, "user", f"Ann wrote:\n> {said[p]}\n{text}"))
            else:
                rows.append((conv, t, "user", text))
            said.append(text)
    rng.shuffle(rows)
    got = quotation.format_chat(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.conv_id, r.turn): r.parent_turn for r in got if r.parent_turn is not None} == parent

    def walk(conv, t):
        yield conv, t
        for c in sorted(c for (k, c), p in parent.items() if k == conv and p == t):
            yield from walk(conv, c)

    turns = sorted((c, t) for c, t, *_ in rows)
    want = [x for c, t in turns if (c, t) not in parent for x in walk(c, t)]
    assert [(r.conv_id, r.turn) for r in got] == want
    con = duckdb.connect()
    con.register("frame", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]))
    con.sql("create view conversations as select * from frame")
    path = {(r.conv_id, r.turn): r.path for r in got}
    assert {(c, t): p for c, t, p in con.sql(
        f"select conv_id, turn, path from ({oracle.chat_sql()})").fetchall()} == path
