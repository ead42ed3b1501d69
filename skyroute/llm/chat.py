"""Chat formatting with DataFrame expressions only.

``format_chats`` sorts each conversation's collected turns, merges neighbouring turns of
one role into one block and writes

    <|im_start|>ROLE newline TEXT <|im_sep|> TEXT ... <|im_end|> newline

Control strings inside texts and roles get a backslash after their first character, one
more than they had, so ``unescape`` restores every text and no unescaped control string
comes from a text.

Defined cases: a null text or role is empty; a null turn sorts first; turns with equal
numbers sort by role, then text; repeated rows are repeated turns; a null ``conv_id`` is a
conversation of its own; other columns are ignored; no rows give no rows. A conversation
is one string, so its turns meet in one task: that is the operator's result, and a single
conversation must stay below Spark's 2 GB value limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
# Control strings that public chat templates use. Each starts with < or [
# and holds neither of them, nor a backslash, later on.
CONTROLS = (START, SEPARATOR, END, "<s>", "</s>", "<|endoftext|>", "[INST]", "[/INST]")
TRAINED_ROLE = "assistant"


def _quoted(text: str) -> str:
    return "".join(f"\\{c}" if c in "|[]/" else c for c in text)


_TAILS = "(?=" + "|".join(_quoted(c[1:]) for c in CONTROLS) + ")"
ESCAPE = r"([<\[])(\\*)" + _TAILS
UNESCAPE = r"([<\[])\\(\\*)" + _TAILS


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, "$1$2")


def _escape_role(role: Column) -> Column:
    """A role is one line: its newlines and backslashes are written as \\n and \\b."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def format_chats(conversations: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """``conv_id``, ``formatted`` and ``segments``, the loss mask.

    ``segments`` cuts ``formatted`` into consecutive pieces ``(text, loss)``; ``loss`` is
    true exactly on the (escaped) texts of ``trained_role``.
    """
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    turn = F.struct(
        "turn", "role", _escape_role(F.col("role")).alias("head"), "text", escape(F.col("text")).alias("body")
    )
    sorted_turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    turns = F.col("turns")

    def role_at(i: Column) -> Column:
        return F.get(turns, i)["role"]

    def pieces(t: Column, i: Column) -> Column:
        begins = (i == 0) | (role_at(i - 1) != t["role"])
        ends = (i == F.size(turns) - 1) | (role_at(i + 1) != t["role"])
        before = F.when(begins, F.concat(F.lit(START), t["head"], F.lit("\n"))).otherwise(SEPARATOR)
        after = F.when(ends, F.lit(END + "\n")).otherwise("")
        return F.array(
            F.struct(before.alias("text"), F.lit(False).alias("loss")),
            F.struct(t["body"].alias("text"), (t["role"] == trained_role).alias("loss")),
            F.struct(after.alias("text"), F.lit(False).alias("loss")),
        )

    masked = sorted_turns.select("conv_id", F.flatten(F.transform(turns, pieces)).alias("segments"))
    return masked.select(
        "conv_id",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments",
    )


def read_back(formatted: Column) -> Column:
    """The turns ``array<struct<role, text>>`` that a formatted conversation holds."""
    blocks = F.filter(F.split(formatted, _quoted(START), -1), lambda _, i: i > 0)

    def turns(block: Column) -> Column:
        head = F.substring_index(block, "\n", 1)
        body = F.right(block, F.char_length(block) - F.char_length(head) - 1)
        texts = F.split(F.left(body, F.char_length(body) - len(END) - 1), _quoted(SEPARATOR), -1)
        return F.transform(
            texts, lambda x: F.struct(_unescape_role(head).alias("role"), unescape(x).alias("text"))
        )

    return F.flatten(F.transform(blocks, turns))


def loss_text(segments: Column) -> Column:
    """All unescaped text under the mask, nothing between the pieces."""
    return F.array_join(
        F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), ""
    )


def digests(formatted: DataFrame) -> DataFrame:
    """Turn and loss digests of ``format_chats``' result, read back from it."""
    read = formatted.select(
        "conv_id",
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        read_back(F.col("formatted")).alias("turns"),
        loss_text(F.col("segments")).alias("loss"),
    )
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
