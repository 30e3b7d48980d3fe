r"""Chat formatting as relational work: turns are collected as structs, sorted, merged and concatenated by
Spark expressions only.

The template of a conversation, adjacent turns of one role in one block:

    <turn user>first text<+>second text</turn><turn assistant>answer</turn>

Inside roles and texts a backslash becomes ``\0``, ``<`` becomes ``\1`` and ``>`` becomes ``\2``, so markers
cannot be forged and every turn can be read back. The loss mask is a list of runs (characters, in loss)
over the whole output; the texts of ``loss_role`` are in it, markers are not.

All array work is linear in the number of turns. Defined cases: turns are ordered by turn, then role, then
text, nulls first; null texts and roles are empty; repeated rows are turns of their own; rows with a null
conversation form one conversation; an empty table gives an empty result; extra columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (character, what it becomes); undone in reverse order.
ESCAPES = (("\\", "\\0"), ("<", "\\1"), (">", "\\2"))


def escaped(text: Column) -> Column:
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescaped(text: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def format_chats(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    loss_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: formatted, loss_runs."""
    coded = lambda name: escaped(F.coalesce(F.col(name), F.lit("")))
    one = F.struct(F.col(turn).alias("turn"), coded(role).alias("role"), coded(text).alias("text"))
    rows = turns.groupBy(F.col(conversation).alias("_conversation")).agg(F.sort_array(F.collect_list(one)).alias("_turns"))
    earlier = F.concat(F.array(F.lit(None).cast("string")), F.slice(F.col("_turns.role"), F.lit(1), F.size("_turns") - 1))

    def piece(t: Column, before: Column) -> Column:
        again = before.eqNullSafe(t["role"])
        opening = F.concat(F.when(before.isNull(), "<turn ").otherwise("</turn><turn "), t["role"], F.lit(">"))
        return F.struct(
            F.when(again, "<+>").otherwise(opening).alias("mark"), t["text"].alias("text"), (t["role"] == escaped(F.lit(loss_role))).alias("loss")
        )

    pieces = rows.select("_conversation", F.zip_with("_turns", earlier, piece).alias("_pieces"))
    runs = F.transform(
        "_pieces",
        lambda p: F.array(
            F.struct(F.char_length(p["mark"]).alias("chars"), F.lit(False).alias("loss")),
            F.struct(F.char_length(p["text"]).alias("chars"), p["loss"].alias("loss")),
        ),
    )
    closing = F.struct(F.lit(len("</turn>")).alias("chars"), F.lit(False).alias("loss"))
    return pieces.select(
        F.col("_conversation").alias(conversation),
        F.concat(F.array_join(F.transform("_pieces", lambda p: F.concat(p["mark"], p["text"])), ""), F.lit("</turn>")).alias("formatted"),
        F.concat(F.flatten(runs), F.array(closing)).alias("loss_runs"),
    )


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, in order."""
    blocks = F.filter(F.split(formatted, "<turn "), lambda b: b != "")

    def turns(block: Column) -> Column:
        role = F.substring_index(block, ">", 1)
        body = F.substring(block, F.char_length(role) + 2, F.char_length(block) - F.char_length(role) - len("></turn>"))
        return F.transform(F.split(body, r"<\+>"), lambda t: F.struct(unescaped(role).alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_texts(formatted: Column, loss_runs: Column) -> Column:
    """The texts under the loss mask, in order, unescaped.

    A text lies between two markers, so the output is cut before each text's marker, and the runs say how many
    characters of each part are the marker, how many the text and whether it counts.
    """
    parts = F.filter(F.split(formatted, "(?=<turn |<[+]>|</turn>)"), lambda p: (p != "") & (p != "</turn>"))
    texts = F.filter(loss_runs, lambda run, k: k % 2 == 1)
    counted = F.filter(F.zip_with(parts, texts, lambda p, run: F.struct(p.alias("part"), run.alias("run"))), lambda x: x["run"]["loss"])
    return F.transform(counted, lambda x: unescaped(F.when(x["run"]["chars"] > 0, F.right(x["part"], x["run"]["chars"])).otherwise("")))
