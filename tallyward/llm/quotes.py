"""Operator 6 [native]: quotation linking.

Every line of a message has a quote level: the number of ">" it begins with. A passage is one
non-blank line; a message without own text holds the blank passage, and a quote level with blank
lines only quotes it. Quoted passages are normalised (lower case, single blanks), hashed and linked to
the latest earlier message of the thread that holds the passage as its own text. A message answers the
earlier message that most of its least deeply quoted, linked characters come from. Pointer
jumping over these answers gives each message the root of its conversation and its depth, in as
many rounds as the logarithm of the longest chain. Quotes and the lines that announce them are
taken out of the texts. Everything is made of Spark functions.

Holders and quotes of a passage are put in one order and each quote takes the last holder before
it, so a passage that many messages hold or quote makes no pairs. The order is cut into slices of
equal size whatever the passage; the last holder is carried over from one slice to the next. No conversation is collected: (root, depth, sent, message)
is its reply order, and sorting by it is up to the reader.

Contract: null text counts as empty. Messages with nothing linked are roots of depth 0; a passage
quoted before it is written links nothing. Rows that repeat a message id are one message: the
smallest (sent, text) is kept. Rows with a null id are left out. A null thread is a thread of its
own. Other columns are dropped. Empty table: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.tables import stored

QUOTED = r"^\s*>"
MARKS = r"^(\s*>)+ ?"
ANNOUNCES = r"(?i)\bwrote:\s*$"


def level(line: Column) -> Column:
    """How deeply a line is quoted."""
    return F.length(F.translate(F.regexp_extract(line, MARKS, 0), " \t\r\f", ""))


def content(line: Column) -> Column:
    return F.regexp_replace(line, MARKS, "")


def normalised(passage: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(passage), r"\s+", " "))


def without_quotes(text: Column) -> Column:
    """The message's own lines: no quoted ones, and none that announces a quote right below it."""
    lines = F.split(text, "\n")
    return F.regexp_replace(F.array_join(F.get(F.transform(F.array(lines), lambda all_: F.filter(
        all_, lambda x, i: ~x.rlike(QUOTED)
        & ~(x.rlike(ANNOUNCES) & F.coalesce(F.get(all_, i + 1).rlike(QUOTED), F.lit(False))))), 0), "\n"), r"^\s+|\s+$", "")


def passages(messages: DataFrame) -> DataFrame:
    """thread, message, sent, level, hash and size of every non-blank line, and of the blank passage
    of a message without own text and of quote levels with blank lines only."""
    lines = messages.select("thread", "message", "sent", (without_quotes(F.col("text")) == "").alias("bare"), F.transform(
        F.split("text", "\n"), lambda x: F.struct(level(x).alias("level"), normalised(content(x)).alias("passage"))).alias("lines"))
    told = lines.select("*", F.filter("lines", lambda x: x.passage != "").alias("told"))
    empty = F.array_except(F.filter(F.col("lines.level"), lambda x: x > 0), F.filter(F.col("told.level"), lambda x: x > 0))
    empty = F.when(F.col("bare"), F.array_append(empty, F.lit(0))).otherwise(empty)
    blank = F.transform(empty, lambda x: F.struct(x.alias("level"), F.lit("").alias("passage")))
    found = told.select("thread", "message", "sent", F.explode(F.concat("told", blank)).alias("line"))
    return found.select("thread", "message", "sent", "line.level", F.sha2("line.passage", 256).alias("hash"),
                        F.length("line.passage").alias("size"))


def answers(found: DataFrame) -> DataFrame:
    """message and the message it answers (parent), for messages with a link, and linked: how many
    of its quoted passages have an original."""
    own = found.filter("level = 0").select("thread", "message", "sent", "level", "hash").distinct()
    quoted = found.filter("level > 0").groupBy("thread", "message", "sent", "level", "hash").agg(
        F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
    # A message's quotes stand before its own lines, so that it never answers itself.
    place = [F.col(c) for c in ("thread", "hash", "sent", "message")] + [F.col("level") == 0]
    both = quoted.unionByName(own, allowMissingColumns=True).repartitionByRange(*place)
    both = stored(both.withColumn("slice", F.spark_partition_id()), "passage-slices")
    holds = F.when(F.col("level") == 0, F.struct("sent", "message"))
    sliced = Window.partitionBy("thread", "hash", "slice").orderBy("sent", "message", F.col("level") == 0)
    near = both.withColumn("near", F.last(holds, True).over(sliced.rowsBetween(Window.unboundedPreceding, 0))).filter("level > 0")
    # One row for each passage and slice; only passages that span slices have something to carry.
    last = both.groupBy("thread", "hash", "slice").agg(F.max(holds).alias("last"))
    before = Window.partitionBy("thread", "hash").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(F.col("thread").alias("t"), F.col("hash").alias("h"), F.col("slice").alias("s"),
                          F.last("last", True).over(before).alias("carried")).filter("carried is not null")
    here = near.thread.eqNullSafe(carried.t) & (near.hash == carried.h) & (near.slice == carried.s)
    links = near.join(carried, here, "left").select(
        "message", "level", "size", "n", F.coalesce("near", "carried").alias("holder")).filter("holder is not null")
    votes = links.groupBy("message", "level", "holder").agg(F.sum("size").alias("size"), F.sum("n").alias("n"))
    best = votes.groupBy("message").agg(
        F.max(F.struct((-F.col("level")).alias("near"), "size", "holder")).alias("best"), F.sum("n").alias("linked"))
    return best.select("message", F.col("best.holder.message").alias("parent"), "linked")


def roots(parents: DataFrame) -> DataFrame:
    """message, root and depth of messages that have a parent. Each round doubles the reach of the
    messages that have not met a root yet; the others take no further part."""
    now = stored(parents.select("message", F.col("parent").alias("up"), F.lit(1).cast("long").alias("depth"),
                                F.lit(False).alias("done")), "replies")
    while now.filter("not done").limit(1).count():
        above = now.select(F.col("message").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"),
                           F.col("done").alias("ended"))
        moved = now.filter("not done").join(above, "up", "left").select(
            "message", F.coalesce("next", "up").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            (F.col("next").isNull() | F.col("ended")).alias("done"))
        now = stored(now.filter("done").unionByName(moved), "replies")
    return now.select("message", F.col("up").alias("root"), "depth")


def conversations(messages: DataFrame) -> DataFrame:
    """thread, message, sent, parent, root, depth, max_level, linked and text (without quotes) of
    every message. ``messages`` has thread, message, sent and text."""
    kept = messages.filter("message is not null").groupBy("message").agg(
        F.min(F.struct("sent", F.coalesce("text", F.lit("")).alias("text"), "thread")).alias("row"))
    messages = kept.select("row.thread", "message", "row.sent", "row.text")
    found = stored(passages(messages), "passages")
    parents = stored(answers(found), "answers")
    levels = found.groupBy("message").agg(F.max("level").alias("max_level"))
    placed = messages.join(parents, "message", "left").join(roots(parents), "message", "left").join(levels, "message", "left")
    return placed.select(
        "thread", "message", "sent", "parent", F.coalesce("root", "message").alias("root"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        F.coalesce("max_level", F.lit(0)).cast("long").alias("max_level"),
        F.coalesce("linked", F.lit(0)).cast("long").alias("linked"), without_quotes(F.col("text")).alias("text"))


def replies_with_quotes(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) as mails: each quotes the turn before it, and the one
    before that one level deeper. Made by joins on the turn's rank in its conversation."""
    ranked = turns.groupBy("conv_id", "turn").agg(F.min(F.struct(
        F.coalesce("text", F.lit("")).alias("text"), F.coalesce("role", F.lit("")).alias("role"))).alias("own"))
    before = ranked.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("own").alias("one"))
    second = ranked.select("conv_id", (F.col("turn") + 2).alias("turn"), F.col("own").alias("two"))

    def quoted(text: Column, mark: str) -> Column:
        return F.array_join(F.transform(F.split(text, "\n"), lambda x: F.concat(F.lit(mark), x)), "\n")

    joined = ranked.join(before, ["conv_id", "turn"], "left").join(second, ["conv_id", "turn"], "left")
    deep = F.when(F.col("two").isNotNull(), F.concat(quoted(F.col("two.text"), ">> "), F.lit("\n"))).otherwise("")
    head = F.when(F.col("one").isNotNull(), F.concat(
        F.col("one.role"), F.lit(" wrote:\n"), deep, quoted(F.col("one.text"), "> "), F.lit("\n\n"))).otherwise("")
    return joined.select(
        F.col("conv_id").cast("string").alias("thread"), F.concat_ws(":", "conv_id", "turn").alias("message"),
        F.col("turn").cast("long").alias("sent"), F.concat(head, F.col("own.text")).alias("text"))
