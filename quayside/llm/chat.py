"""Chat formatting with Spark expressions only.

Turns are collected per conversation and sorted; neighbours of one role share a header; headers, texts and ends
are concatenated. Every text passes an escape, so that no text can forge a control string and the
conversation can be read back exactly:

    <|turn|>role LINE BREAK text <|next|> text of the same role <|end|>

The result is kept in segments with a flag: their texts joined are the formatted conversation, and the flagged
ones are what the loss is computed on (the texts of one role, without any control string).

Defined cases: a null text or role counts as empty, turns sort by (turn, role, text) with nulls first, rows
without a conversation id form one conversation, an empty table gives no rows. All steps are linear in
the number of turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, NEXT, END = "<|turn|>", "<|next|>", "<|end|>"
#: Escapes in the order in which they are applied; reading back goes the other way.
ESCAPES = (("\\", "\\b"), ("<|", "\\l"))
#: A role ends at its line break, so one inside a role is escaped as well.
ROLE_ESCAPES = (*ESCAPES, ("\n", "\\n"))


def escape(text: Column, escapes: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    for plain, code in escapes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, escapes: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    for plain, code in reversed(escapes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def format_conversations(rows: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """conv_id, formatted, segments (text, loss) per conversation."""
    turn = F.struct(
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    grouped = rows.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))

    def opened(t: Column, i: Column) -> Column:
        previous = F.get(F.col("turns"), i - 1)["role"]
        header = F.concat(F.lit(TURN), escape(t["role"], ROLE_ESCAPES), F.lit("\n"))
        return (
            F.when(i == 0, header)
            .when(previous == t["role"], F.lit(NEXT))  # merged into the turn before it
            .otherwise(F.concat(F.lit(END), header))
        )

    def segments(t: Column, i: Column) -> Column:
        return F.array(
            F.struct(opened(t, i).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(t["text"]).alias("text"), (t["role"] == loss_role).alias("loss")),
        )

    closing = F.array(F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")))
    whole = F.concat(F.flatten(F.transform("turns", segments)), closing)
    out = grouped.select("conv_id", whole.alias("segments"))
    return out.select("conv_id", F.array_join(F.col("segments.text"), "").alias("formatted"), "segments")


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, from its string alone."""
    blocks = F.filter(F.split(formatted, r"<\|turn\|>"), lambda b: b.endswith(END))

    def turns(block: Column) -> Column:
        head = F.instr(block, "\n")
        role = F.substr(block, F.lit(1), head - 1)
        body = F.substr(block, head + 1, F.length(block) - head - len(END))
        texts = F.split(body, r"<\|next\|>", -1)
        return F.transform(
            texts, lambda t: F.struct(unescape(role, ROLE_ESCAPES).alias("role"), unescape(t).alias("text"))
        )

    return F.flatten(F.transform(blocks, turns))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, as it was before it was escaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
