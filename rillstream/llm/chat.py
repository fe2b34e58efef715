"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the context, and only its text is trainable. A
conversation that ends with other turns, or has no assistant turn, gives one more example without a trainable text, so
that nothing is lost. An example holds all turns before its target, so a conversation is as long as its last example, and it
is gathered in one row only then; examples are made from it one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, SEP, CLOSE = "<s>[INST] ", " [/INST]\n", "</s>"
#: Control strings of the template, which texts and roles must not hold as they are.
CONTROL = r"(<)(/?s>)|(\[)(/?INST\])"
BACKSLASH = "\\"


def escaped(text: Column) -> Column:
    """Double backslashes, and put one after the first character of every control string."""
    doubled = F.replace(text, F.lit(BACKSLASH), F.lit(BACKSLASH * 2))
    return F.regexp_replace(doubled, CONTROL, r"$1$3\\$2$4")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def turns(rows: DataFrame) -> DataFrame:
    """(conv_id, turns): the rows of each conversation in order of turn, then role and text; nulls first."""
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("t")).alias("turns"))


def examples(rows: DataFrame) -> DataFrame:
    """(conv_id, target, formatted, loss_start, loss_end) of the rows (conv_id, turn, role, text) of conversations.

    target is the index of the trainable turn, null in an example without one; the loss span counts
    code points. Null roles and texts are empty; rows without conv_id are one conversation; repeated rows are
    turns of their own; conversations are never cut. Other columns are left out; an empty table gives no examples.
    """
    shown = F.transform("turns", lambda t: F.concat(
        F.lit(OPEN), escaped(t["role"]), F.lit(SEP), escaped(t["text"]), F.lit(CLOSE)))
    ends = F.filter(F.sequence(F.lit(0), F.size("turns") - 1), lambda i: F.get("turns", i)["role"] == "assistant")
    last = F.size("turns") - 1
    tail = F.when(F.get("turns", last)["role"] == "assistant", F.array().cast("array<int>")).otherwise(F.array(last))
    talks = turns(rows).withColumns({"shown": shown, "ends": F.concat(ends, tail)})
    each = talks.select("conv_id", "turns", "shown", F.explode("ends").alias("end"))
    trained = F.get("turns", F.col("end"))["role"] == "assistant"
    formatted = F.array_join(F.slice("shown", F.lit(1), F.col("end") + 1), "")
    each = each.select("conv_id", F.when(trained, F.col("end")).alias("target"), formatted.alias("formatted"),
                       F.length(escaped(F.get("turns", F.col("end"))["text"])).alias("size"))
    loss_end = F.length("formatted") - len(CLOSE)
    return each.select("conv_id", "target", "formatted",
                       F.when(F.col("target").isNotNull(), loss_end - F.col("size")).alias("loss_start"),
                       F.when(F.col("target").isNotNull(), loss_end).alias("loss_end"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, losses, formatted_chars) of examples, from their formatted texts and loss spans alone."""
    loss = unescaped(F.substring(F.col("formatted"), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    rows = formatted.select("conv_id", "formatted", F.length("formatted").alias("chars"),
                            F.when(F.col("loss_end").isNotNull(), F.struct("loss_end", loss.alias("text"))).alias("loss"))
    talks = rows.groupBy("conv_id").agg(
        F.max_by("formatted", "chars").alias("longest"), F.sort_array(F.collect_list("loss")).alias("losses"),
        F.sum("chars").alias("formatted_chars"))
    pieces = F.filter(F.split("longest", "\\Q" + CLOSE + "\\E"), lambda x: x != "")
    parsed = F.transform(pieces, lambda piece: F.struct(
        unescaped(F.substring_index(F.substr(piece, F.lit(len(OPEN) + 1)), SEP, 1)).alias("role"),
        unescaped(F.substr(
            piece, F.instr(piece, SEP) + len(SEP))).alias("text")))
    return talks.select("conv_id", parsed.alias("turns"), F.transform("losses", lambda x: x["text"]).alias("losses"),
                        "formatted_chars")
