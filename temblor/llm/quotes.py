"""Quotation linking: conversations in reply order, with quoted passages traced to their messages.

A message is parsed into lines with a quote level (leading `>` marks). Quoted lines of eight
characters or more are passages: normalised and hashed, they are joined to the unquoted lines of
all messages, first to the earliest message of the same conversation that has the line, if that
comes before, else to the first of the table. The message most quoted at the outermost linked level
is the one replied to. Without a link, a message replies to the turn before its own. Reply chains
are followed to their roots by doubling.

Originals are reduced to one message per hash and conversation, and one per hash, before they are
joined; so a passage that all messages share meets each of them once.

Defined results: a null text has no lines. Rows with a null `conv_id` or `turn` are messages too,
ordered first. Rows that share (conv_id, turn) are one message each if their texts differ, and one
message if they don't; equal rows give one row. A message that only quotes has an empty text left.
Further columns are ignored; a null role stays null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from temblor.llm.common import materialise

MARK = r"^(?:[ \t]*>)+[ \t]?"
ATTRIBUTION = r"^[ \t]*(?:On\b.{0,200}\bwrote|Le\b.{0,200}\ba écrit|Am\b.{0,200}\bschrieb|El\b.{0,200}\bescribió)[ \t]*:[ \t]*$"
KEY = ["conv_id", "turn", "text_hash"]


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[\s>]+", " "))


def _parsed(text: Column) -> Column:
    """Array of (level, line) of the lines of a text; attribution lines and marks are taken off."""
    lines = F.split(F.coalesce(text, F.lit("")), r"\r?\n")
    levels = F.transform(
        lines,
        lambda x: F.struct(
            F.char_length(F.regexp_replace(F.regexp_extract(x, MARK, 0), "[^>]", "")).alias("level"),
            F.regexp_replace(x, MARK, "").alias("line"),
        ),
    )
    return F.filter(levels, lambda x: ~F.rlike(x["line"], F.lit(ATTRIBUTION)))


def messages(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, text_hash, role, lines, own (text without quotes) of every different message."""
    text = F.coalesce("text", F.lit(""))
    rows = conversations.select("conv_id", "turn", F.xxhash64(text).alias("text_hash"), "role", text.alias("text"))
    rows = rows.groupBy(*KEY, "text").agg(F.min("role").alias("role"))
    lines = rows.select(*KEY, "role", _parsed(F.col("text")).alias("lines"))
    own = F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["line"])
    return lines.withColumn("own", F.trim(F.array_join(own, "\n")))


def passages(found: DataFrame) -> DataFrame:
    """conv_id, turn, text_hash, level, passage: the hash of every line of some length."""
    each = found.select(*KEY, F.explode("lines").alias("x")).select(*KEY, "x.level", _normal(F.col("x.line")).alias("line"))
    return each.where(F.char_length("line") >= 8).select(*KEY, "level", F.xxhash64("line").alias("passage"))


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    same = left[columns[0]].eqNullSafe(right[columns[0]])
    for c in columns[1:]:
        same &= left[c].eqNullSafe(right[c])
    return same


def _message(*columns: str) -> Column:
    """A message's key as one value; these are in order, nulls first."""
    return F.struct(*(F.col(c).alias(name) for c, name in zip(columns, KEY)))


def replies(found: DataFrame) -> DataFrame:
    """conv_id, turn, text_hash, n_quoted and n_linked passages, and `to`, the message replied to.

    Replies only go to messages that come before in the order of (conv_id, turn, text_hash).
    """
    every = materialise(passages(found), "passages")
    original = every.where("level = 0")
    near = original.groupBy("passage", "conv_id").agg(F.min(_message(*KEY)).alias("near"))
    far = original.groupBy("passage").agg(F.min(_message(*KEY)).alias("far"))

    quoted = every.where("level > 0").groupBy(*KEY, "level", "passage").agg(F.count("*").alias("n"))
    met = quoted.join(near, _same(quoted, near, ["passage", "conv_id"]), "left")
    met = met.select(*(quoted[c] for c in (*KEY, "level", "passage")), "n", "near").join(far, "passage", "left")
    own = _message(*KEY)
    to = F.when(F.col("near") < own, F.col("near")).when(F.col("far") < own, F.col("far"))
    met = met.select(*KEY, "level", "n", to.alias("to"))
    counted = met.groupBy(*KEY).agg(
        F.sum("n").alias("n_quoted"), F.sum(F.when(F.col("to").isNotNull(), F.col("n")).otherwise(0)).alias("n_linked")
    )
    votes = met.where(F.col("to").isNotNull()).groupBy(*KEY, "to").agg(F.min("level").alias("level"), F.sum("n").alias("n"))
    best = votes.groupBy(*KEY).agg(F.min(F.struct("level", (-F.col("n")).alias("less"), "to")).alias("best"))

    before = found.groupBy("conv_id", (F.col("turn") + 1).alias("next")).agg(F.min(_message(*KEY)).alias("before"))
    before = before.where("next IS NOT NULL").withColumnRenamed("conv_id", "in_conv")
    keys = found.select(*KEY)
    out = keys.join(counted, _same(keys, counted, KEY), "left").select(*(keys[c] for c in KEY), "n_quoted", "n_linked")
    out = out.join(best, _same(out, best, KEY), "left").select(*(out[c] for c in KEY), "n_quoted", "n_linked", "best")
    out = out.join(before, out["conv_id"].eqNullSafe(before["in_conv"]) & (out["turn"] == before["next"]), "left")
    return out.select(
        *KEY,
        F.coalesce("n_quoted", F.lit(0)).cast("long").alias("n_quoted"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        F.coalesce("best.to", "before").alias("to"),
    )


def roots(links: DataFrame, most_rounds: int = 64) -> DataFrame:
    """node, root, depth of every row of `links` (node, parent or null), which has no circles.

    Chains are followed by doubling; each round is written to the shared folder. Only messages that
    have not reached their root yet take part in the next one. Every parent has to be a node.
    """
    root = F.col("parent").isNull()
    state = links.select(
        "node",
        F.coalesce("parent", "node").alias("up"),
        F.when(root, 0).otherwise(1).cast("long").alias("depth"),
        root.alias("done"),
    )
    state = materialise(state, "reply-chains")
    for _ in range(most_rounds):
        going = state.where("NOT done")
        if going.isEmpty():
            return state.select("node", F.col("up").alias("root"), "depth")
        above = state.select(
            F.col("node").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"), F.col("done").alias("there")
        )
        further = going.join(above, "up").select(
            "node", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), F.col("there").alias("done")
        )
        state = materialise(state.where("done").unionByName(further), "reply-chains")
    raise RuntimeError(f"replies not followed up after {most_rounds} rounds")


def link_quotations(conversations: DataFrame) -> DataFrame:
    """Per different message: text without quotes, what it replies to, its thread and depth there.

    Columns: conv_id, turn, role, text, n_quoted, n_linked, to_conv, to_turn, thread (a number for
    the root message), depth (replies from the root). Ordered by thread, depth, conv_id and turn,
    the rows are the conversations in reply order.
    """
    found = materialise(messages(conversations), "messages")
    linked = replies(found)
    named = linked.select(
        "*", F.xxhash64(_message(*KEY)).alias("node"), F.when(F.col("to").isNotNull(), F.xxhash64("to")).alias("parent")
    )
    named = materialise(named, "replies")
    texts = found.select(F.xxhash64(_message(*KEY)).alias("node"), "role", F.col("own").alias("text"))
    out = named.join(roots(named.select("node", "parent")), "node").join(texts, "node")
    return out.select(
        "conv_id",
        "turn",
        "role",
        "text",
        "n_quoted",
        "n_linked",
        F.col("to.conv_id").alias("to_conv"),
        F.col("to.turn").alias("to_turn"),
        F.col("root").alias("thread"),
        "depth",
    )


def op4_quotations(spark, sf_dir: str) -> DataFrame:
    """All conversations in reply order without quotes."""
    return link_quotations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
