r"""Chat formatting: turns of a conversation as one marked text, by Spark expressions only.

The template is

    <|im_start|>role\ntext<|im_end|>\n

per block.  Adjacent turns of one role are one block, their texts parted by <|im_sep|>, so that the turns can be read back.
No control string can stem from a text: a backslash is doubled and `<|` becomes `<\|`; in a role `%`, line feed and `<` are
written as %25, %0A and %3C.  Both are undone when the text is read back.

A null role or text counts as empty; turns sort by turn (nulls first), then role, then text, so ties have one order; repeated
rows are turns of their own; an empty table has no conversations; a conversation without an id is one of its own.
The output row of a conversation holds all its turns, so one conversation must fit into a task's memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of the template.
START, END, SEPARATOR = "<|im_start|>", "<|im_end|>", "<|im_sep|>"
#: The role whose texts are trained on.
ASSISTANT = "assistant"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escaped_role(role: Column) -> Column:
    for plain, code in (("%", "%25"), ("\n", "%0A"), ("<", "%3C")):
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def unescaped_role(role: Column) -> Column:
    for plain, code in (("<", "%3C"), ("\n", "%0A"), ("%", "%25")):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted) per conversation of `turns` (conv_id, turn, role, text)."""
    turn = F.struct(
        turns["turn"].alias("turn"),
        F.coalesce(turns["role"], F.lit("")).alias("role"),
        F.coalesce(turns["text"], F.lit("")).alias("text"),
    )
    gathered = turns.select(turns["conv_id"].alias("conv_id"), turn.alias("t")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("t")).alias("turns")
    )
    indexes = F.sequence(F.lit(0), F.size("turns") - 1)

    def mark(i: Column) -> Column:
        this, before = F.get("turns", i), F.get("turns", i - 1)
        same = (i > 0) & (this["role"] == before["role"])
        opening = F.when(i == 0, "").otherwise(END + "\n")
        head = F.when(same, SEPARATOR).otherwise(F.concat(opening, F.lit(START), escaped_role(this["role"]), F.lit("\n")))
        return F.concat(head, escaped(this["text"]))

    formatted = F.concat(F.array_join(F.transform(indexes, mark), ""), F.lit(END + "\n"))
    return gathered.select("conv_id", formatted.alias("formatted"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text), as they were before they were merged."""

    def turns_of(block: Column) -> Column:
        body = F.substr(block, F.lit(len(START) + 1))
        role = F.substring_index(body, "\n", 1)
        texts = F.split(F.substr(body, F.char_length(role) + 2), r"<\|im_sep\|>", -1)
        return F.transform(texts, lambda text: F.struct(unescaped_role(role).alias("role"), unescaped(text).alias("text")))

    # The last piece is what follows the last block: nothing.
    pieces = F.split(formatted, r"<\|im_end\|>\n", -1)
    return F.flatten(F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turns_of))


def loss_text(turns: Column) -> Column:
    """All text under the loss mask: the assistant's texts in order."""
    return F.array_join(F.transform(F.filter(turns, lambda t: t["role"] == ASSISTANT), lambda t: t["text"]), "")


def digest(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations hold, read back from them."""
    turns = formatted.select("conv_id", "formatted", read_back(F.col("formatted")).alias("turns"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    turns = turns.select("conv_id", "formatted", "turns", lines.alias("lines"), loss_text(F.col("turns")).alias("loss"))
    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2("lines", 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
