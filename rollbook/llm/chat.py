"""Chat formatting with DataFrame expressions only, and reading back what was formatted.

A conversation is its rows sorted by (turn, role, text); null role and null text are
empty, rows with a null conversation id form one conversation, repeated rows are
turns of their own.  Neighbouring turns of one role share a block:

    <|user|>text<|then|>text<|end|><|assistant|>text<|end|>

A role that is no plain word stands in its header coded in letters.  A control string is ``<``, any number of
backslashes, and one of the marks below, or its counterpart in square brackets;
inside texts every one gets one more backslash after its bracket, and reading back
takes one away, so any text comes back unchanged and none can open or close a block.
Very long texts are formatted whole; an empty table gives no conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Marks of the template and of common chat templates, as they stand after an angle bracket.
ANGLED = (r"\|[a-z_]*\|>", r"/?s>", r"/?SYS>")
#: The same after a square bracket.
SQUARE = (r"/?INST\]",)
_ESCAPE = rf"(<)(\\*)(?={'|'.join(ANGLED)})|(\[)(\\*)(?={'|'.join(SQUARE)})"
_UNESCAPE = rf"(<)\\(\\*)(?={'|'.join(ANGLED)})|(\[)\\(\\*)(?={'|'.join(SQUARE)})"
THEN, END = "<|then|>", "<|end|>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_ESCAPE), F.lit(r"$1$3\\$2$4"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_UNESCAPE), F.lit("$1$3$2$4"))


def _text(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def format_chats(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row a conversation: its id, ``formatted`` and the loss mask as ``segments``.

    The segments' texts one after another are ``formatted``; ``loss`` marks those to
    learn from.  Texts are escaped before they are collected, row by row, wherever the
    rows lie; what is brought together for a conversation is the output itself.
    """
    rows = turns.select(
        F.col(conv).alias(conv),
        F.struct(
            F.col(turn).alias("turn"),
            _text(role).alias("role"),
            _text(text).alias("text"),
            escape(_text(text)).alias("body"),
        ).alias("said"),
    )
    grouped = rows.groupBy(conv).agg(F.sort_array(F.collect_list("said")).alias("said"))
    segmented = grouped.select(conv, _segments(F.col("said")).alias("segments"))
    return segmented.select(conv, F.array_join(F.col("segments.text"), "").alias("formatted"), "segments")


def _segments(said: Column) -> Column:
    """Header where the role changes, a separator where it goes on, an end where it will change."""

    def one(x: Column, i: Column) -> Column:
        before, after = F.get(said, i - 1)["role"], F.get(said, i + 1)["role"]
        opens = F.when((i > 0) & (before == x["role"]), F.lit(THEN)).otherwise(
            F.concat(F.lit("<|"), _header(x["role"]), F.lit("|>"))
        )
        closes = F.when(after == x["role"], F.lit("")).otherwise(F.lit(END))
        part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(part(opens, F.lit(False)), part(x["body"], x["role"] == LOSS_ROLE), part(closes, F.lit(False)))

    return F.flatten(F.transform(said, one))


def _header(role: Column) -> Column:
    """A role as it stands in a header: plain if it is a word other than the marks', else its bytes in letters a to p."""
    plain = role.rlike(r"\A[a-z]+\z") & ~role.isin("then", "end")
    return F.when(plain, role).otherwise(F.concat(F.lit("_"), F.translate(F.hex(F.encode(role, "UTF-8")), "0123456789ABCDEF", "abcdefghijklmnop")))


def _role(header: Column) -> Column:
    coded = F.decode(F.unhex(F.translate(F.substr(header, F.lit(2)), "abcdefghijklmnop", "0123456789ABCDEF")), "UTF-8")
    return F.when(header.startswith("_"), coded).otherwise(header)


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    blocks = F.filter(F.split(formatted, r"<\|end\|>"), lambda b: b != "")

    def turns(block: Column) -> Column:
        role = _role(F.regexp_extract(block, r"^<\|([a-z_]*)\|>", 1))
        texts = F.split(F.regexp_replace(block, r"^<\|[a-z_]*\|>", ""), r"<\|then\|>")
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def digests(chats: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Counts and digests of what each formatted conversation and its mask read back to."""
    learnt = F.filter("segments", lambda x: x["loss"])
    read = chats.select(
        conv,
        "formatted",
        F.array_join(F.transform(learnt, lambda x: unescape(x["text"])), "").alias("learnt"),
        read_back(F.col("formatted")).alias("turns"),
    )
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return read.select(
        conv,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(said, "UTF-8"), 256).alias("turns_sha256"),
        F.char_length("learnt").cast("long").alias("loss_chars"),
        F.sha2(F.encode("learnt", "UTF-8"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
