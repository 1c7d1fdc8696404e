"""Chat formatting by quotation linking.

A line starting with ``>`` marks quotes another message; the number of marks is
the level.  Passages (neighbouring lines of one level) and single lines are
normalised (case, white space), hashed and joined to the first message of the
same conversation that says them unquoted.  The parent of a message is the
earlier message that holds most characters of its outermost linked quotes; a
message that quotes nothing known starts a thread.  Threads are resolved by
pointer doubling (a round halves every chain), and messages come out in reply
order, without quotes and without the "... wrote:" lines above them.

Only DataFrame functions are used.  An original is the *first* saying of a
passage, found by a pre-aggregated minimum, so a line that a third of a
conversation repeats costs one row and no pairs.

Defined cases: a null text has an empty body; texts of any length are read whole; a null conversation, turn or role
is kept and never linked; messages that share conversation and turn are read as
one message and share its parent; repeated rows each come out; an empty table
gives no rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .common import stored

#: Quote marks at the start of a line.
MARKS = r"^(?: ?>)+ ?"
#: Last words of the line that announces a quote.
ANNOUNCE = r"wrote:\s*$"


def _lines(text: Column) -> Column:
    """Array of (level, said) of a text's lines."""
    def parse(line):
        marks = F.regexp_extract(line, MARKS, 0)
        return F.struct(F.regexp_count(marks, F.lit(">")).alias("level"),
                        F.regexp_replace(line, MARKS, "").alias("said"))
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), parse)


def _norm(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def parsed(messages: DataFrame) -> DataFrame:
    """Messages with lines, number of quoted lines and unquoted body."""
    lines = F.col("lines")
    own = F.filter(lines, lambda x, i: (x["level"] == 0) & ~(
        x["said"].rlike(ANNOUNCE) & (F.coalesce(F.get(lines, i + 1)["level"], F.lit(0)) > 0)))
    return (messages.withColumn("lines", _lines(F.col("text")))
            .withColumn("n_quoted", F.size(F.filter(lines, lambda x: x["level"] > 0)))
            .withColumn("body", F.when(F.col("n_quoted") == 0, F.coalesce("text", F.lit("")))
                        .otherwise(F.trim(F.array_join(F.transform(
                            own, lambda x: x["said"]), "\n")))))


def _units(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    norm = rows.withColumn("norm", _norm(F.col(text))).where(F.length("norm") > 0)
    return norm.select(*keys, F.md5("norm").alias("unit"), F.length("norm").alias("weight"))


def originals(quoted_in: DataFrame) -> DataFrame:
    """First turn of each conversation that says a unit: body, paragraph, line."""
    parts = F.array_distinct(F.concat(F.array("body"), F.split("body", r"\n\s*\n"),
                                      F.split("body", "\n")))
    said = quoted_in.select("conv_id", "turn", F.explode(parts).alias("part"))
    return _units(said, ["conv_id", "turn"], "part") \
        .groupBy("conv_id", "unit").agg(F.min("turn").alias("first_turn"))


def quotes(quoting: DataFrame) -> DataFrame:
    """Units of the quoted passages and lines of every quoting message."""
    key = ["conv_id", "turn", "twin"]
    lines = quoting.select(*key, F.posexplode("lines").alias("at", "x")) \
        .select(*key, "at", "x.*")
    by_line = W.Window.partitionBy(*key).orderBy("at")
    runs = lines.withColumn("new", F.when(
        F.col("level") == F.lag("level").over(by_line), 0).otherwise(1)) \
        .withColumn("run", F.sum("new").over(by_line)).where(F.col("level") > 0)
    passages = runs.groupBy(*key, "run", "level").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("at", "said"))), lambda x: x["said"]),
        "\n").alias("said"))
    both = runs.select(*key, "level", "said").unionByName(passages.select(*key, "level", "said"))
    return _units(both, ["conv_id", "turn", "level"], "said")


def links(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, parent_turn) of every message that quotes an earlier one."""
    key_ok = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    quoting = messages.where((F.col("n_quoted") > 0) & key_ok) \
        .withColumn("twin", F.md5(F.coalesce("text", F.lit("")))) \
        .dropDuplicates(["conv_id", "turn", "twin"])
    asked = stored(quotes(quoting), "quoted-units")
    around = messages.where(key_ok).join(
        asked.select("conv_id").distinct(), "conv_id", "left_semi")
    found = asked.join(originals(around), ["conv_id", "unit"]) \
        .where(F.col("first_turn") < F.col("turn")) \
        .groupBy("conv_id", "turn", "level", "first_turn").agg(F.sum("weight").alias("weight"))
    return found.groupBy("conv_id", "turn").agg(F.min_by(
        "first_turn", F.struct(F.col("level"), -F.col("weight"), -F.col("first_turn")))
        .alias("parent_turn"))


def _key(turn: str) -> Column:
    """A turn as text that sorts like the number."""
    return F.lpad((F.col(turn).cast("decimal(20,0)") + F.lit(Decimal(1 << 63))).cast("string"),
                  20, "0")


def threads(link: DataFrame) -> DataFrame:
    """(conv_id, turn, parent_turn, root_turn, depth, above) by pointer doubling;
    ``above`` are the message's ancestors, root first."""
    now = stored(link.withColumn("root_turn", F.col("parent_turn"))
                 .withColumn("depth", F.lit(1).cast("long"))
                 .withColumn("above", _key("parent_turn")), "threads")
    while True:
        up = now.select("conv_id", F.col("turn").alias("root_turn"), F.col("root_turn").alias("up"),
                        F.col("depth").alias("more"), F.col("above").alias("beyond"))
        if now.join(up, ["conv_id", "root_turn"], "left_semi").isEmpty():
            return now
        now = stored(now.join(up, ["conv_id", "root_turn"], "left").select(
            "conv_id", "turn", "parent_turn",
            F.coalesce("up", "root_turn").alias("root_turn"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.concat_ws("/", "beyond", "above").alias("above")), "threads")


def format_chat(conversations: DataFrame) -> DataFrame:
    """One row per message in reply order: parent, root, depth, path, body, chat.

    ``path`` are the keys of a message's ancestors and its own: sorted by it, every
    message stands behind what it answers and before the next answer to that.  It
    is as long as the thread is deep."""
    msgs = parsed(conversations.select("conv_id", "turn", "role", "text"))
    tree = threads(links(msgs))
    out = msgs.drop("lines", "text").join(tree, ["conv_id", "turn"], "left")
    role = F.coalesce("role", F.lit(""))
    return out.select(
        "conv_id", "turn", "role", "parent_turn",
        F.coalesce("root_turn", "turn").alias("root_turn"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        F.col("n_quoted").cast("long").alias("n_quoted"),
        F.when(F.col("turn").isNotNull(), F.concat_ws("/", "above", _key("turn"))).alias("path"),
        "body", F.concat(F.lit("<|"), role, F.lit("|>\n"), F.col("body")).alias("chat")) \
        .orderBy("conv_id", "path", "body")
