"""Chat formatting in Spark expressions: sorted turn structs, merged runs, concatenation, loss segments.

Template of a conversation, with adjacent turns of one role merged into one block:

    <|im_start|>role\\ntext of turn 1<|im_sep|>text of turn 2<|im_end|>\\n

Control strings inside texts and roles are made harmless by one backslash between ``<`` and ``|``; a text
that has backslashes there already gets one more, so taking one away always gives the text back. A line
feed in a role is written ``\\n`` (and a backslash ``\\\\``), as the role ends at the first line feed.

The output holds the formatted string and its segments: the pieces whose concatenation it is, each with
a flag that says whether the loss counts it. Exactly the texts of assistant turns are counted. All work is
array functions over one sorted array per conversation, linear in its turns; the only shuffle is the
grouping by conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    """Insert a backslash into every ``<|`` and ``<\\...\\|``."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    """Undo ``escape``."""
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    # Between pairs of backslashes, so that the n after one is not taken for a line feed.
    parts = F.split(unescape(role), r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def format_chats(
    turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    loss_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: id, ``formatted`` and ``segments`` (array of content, loss).

    Turns are ordered by turn number (null first), then role and text, so ties and repeated rows have one
    order and are all kept. Null text or role counts as empty; rows with a null conversation id form one
    conversation; an empty table gives an empty one; extra columns are not read.
    """
    sorted_turns = turns.select(
        F.col(conv_col).alias("conv"),
        F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                 F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("turn"),
    ).groupBy("conv").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    last = F.size("turns") - 1

    def segments(turn: Column, i: Column) -> Column:
        opens = (i == 0) | (F.get("turns", i - 1)["role"] != turn["role"])
        closes = (i == last) | (F.get("turns", i + 1)["role"] != turn["role"])
        head = F.when(opens, F.concat(F.lit(START), _escape_role(turn["role"]), F.lit("\n"))).otherwise(F.lit(SEPARATOR))
        return F.array(
            F.struct(head.alias("content"), F.lit(False).alias("loss")),
            F.struct(escape(turn["text"]).alias("content"), (turn["role"] == loss_role).alias("loss")),
            F.struct(F.when(closes, F.lit(END)).otherwise(F.lit("")).alias("content"), F.lit(False).alias("loss")))

    cut = sorted_turns.select("conv", F.flatten(F.transform("turns", segments)).alias("segments"))
    return cut.select(
        F.col("conv").alias(conv_col),
        F.array_join(F.transform("segments", lambda s: s["content"]), "").alias("formatted"),
        F.filter("segments", lambda s: s["content"] != "").alias("segments"))


def read_turns(formatted: Column) -> Column:
    """The turns (array of role, text) that a formatted string holds, texts as they were."""
    blocks = F.split(formatted, r"<\|im_end\|>\n")
    whole = F.slice(blocks, F.lit(1), F.size(blocks) - 1)  # nothing follows the last end mark

    def turns(block: Column) -> Column:
        body = F.substring(block, F.lit(len(START) + 1), F.char_length(block))
        at = F.instr(body, "\n")
        role = _unescape_role(F.substring(body, F.lit(1), at - 1))
        texts = F.split(F.substring(body, at + 1, F.char_length(body)), r"<\|im_sep\|>")
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(whole, turns))


def loss_text(segments: Column) -> Column:
    """All text under the loss, as it was, joined without anything between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["content"])), "")


def digest(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Per conversation, read back from the output: turns and their hash, loss text and its hash, length."""
    read = formatted.select(
        conv_col, read_turns(F.col("formatted")).alias("turns"), loss_text(F.col("segments")).alias("loss"),
        F.char_length("formatted").alias("chars"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        conv_col, F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.col("chars").cast("long").alias("formatted_chars"))
