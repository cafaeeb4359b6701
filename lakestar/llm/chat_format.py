"""Chat formatting: conversations to training strings, and back (Spark expressions only).

Template: a block for each run of turns with the same role,

    <turn ROLE>TEXT<turn/>TEXT</turn>

and a line feed after it; ``<turn/>`` parts the merged turns of one block. Inside a text every ``<turn`` or
``</turn``, with any number of backslashes after its ``<``, gets one backslash more there, so a text never holds
a mark and the step is undone by taking one away. In a role, & < > are written as references.

The loss mask is a list of segments (characters, in the loss or not) that covers the formatted string: mark, text,
mark, text, ..., mark. Segment 2i + 1 is the text of turn i, and is in the loss when its role is ``assistant``.

Defined results: turns are ordered by turn, ties by role, then text, nulls first; a null text is empty, a null role
has no name; repeated rows are turns of their own; rows without a conversation id form one conversation; an
empty table gives an empty result. A conversation is one string, so its turns meet in one row: that is the result's
own size, not a group that grows in passing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
PART, END = "<turn/>", "</turn>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)(/?turn)", r"<\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)(/?turn)", r"<$1$2")


def _role_out(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _role_in(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("&gt;"), F.lit(">")), F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """conv_id, formatted, loss_mask (array of chars int, loss boolean)."""
    row = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                   F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sorted_ = turns.groupBy(F.col(conv_col).alias("conv_id")).agg(F.sort_array(F.collect_list(row)).alias("turns"))
    places = sorted_.withColumn("starts", F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"])))
    last = F.size("turns")
    merged = places.withColumn("blocks", F.transform("starts", lambda s, k: F.struct(
        _role_out(F.get("turns", s)["role"]).alias("role"),
        F.transform(F.slice("turns", s + 1, F.coalesce(F.get("starts", k + 1), last) - s), lambda t: escape(t["text"])).alias("texts"))))
    opened = lambda b: F.concat(F.lit("<turn "), b["role"], F.lit(">"))
    formatted = F.array_join(F.transform("blocks", lambda b: F.concat(opened(b), F.array_join(b["texts"], PART), F.lit(END))), "")
    segment = lambda chars, loss: F.struct(chars.cast("int").alias("chars"), loss.alias("loss"))
    no = F.lit(False)
    mask = F.flatten(F.transform("blocks", lambda b, k: F.flatten(F.transform(b["texts"], lambda x, i: F.array(
        segment(F.when(i > 0, F.lit(len(PART))).otherwise(F.length(opened(b)) + F.when(k > 0, F.lit(len(END))).otherwise(0)), no),
        segment(F.length(x), b["role"] == ASSISTANT))))))
    return merged.select("conv_id", formatted.alias("formatted"), F.concat(mask, F.array(segment(F.lit(len(END)), no))).alias("loss_mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (array of role, text, loss), formatted_chars: parsed from the strings and masks alone."""
    blocks = F.slice(F.split("formatted", END, -1), F.lit(1), F.size(F.split("formatted", END, -1)) - 1)
    parsed = formatted.withColumn("read", F.flatten(F.transform(blocks, lambda b: F.transform(
        F.split(F.regexp_replace(b, r"^<turn [^>]*>", ""), PART, -1),
        lambda x: F.struct(_role_in(F.regexp_extract(b, r"^<turn ([^>]*)>", 1)).alias("role"), x.alias("text"))))))
    seg = lambda i: F.get("loss_mask", 2 * i + 1)
    wrong = F.raise_error(F.lit("the loss mask does not fit the formatted string"))
    turns = F.transform("read", lambda t, i: F.struct(
        t["role"].alias("role"), unescape(t["text"]).alias("text"),
        F.when(F.length(t["text"]) == seg(i)["chars"], seg(i)["loss"]).otherwise(wrong.cast("boolean")).alias("loss")))
    return parsed.select("conv_id", turns.alias("turns"), F.length("formatted").cast("bigint").alias("formatted_chars"))
