"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it as context, and only its own
text trainable. A conversation that ends with other turns gets one more example without a target, so
that no turn is lost; so does one without an assistant turn.

The template writes a turn as `<s>role`, a line end, the text, `</s>`. Inside roles and texts the
characters that markers begin with are written as references (`&lt;`, `&lsqb;`, and `&amp;` for the
ampersand itself), so that no text can hold a marker, and reading back is exact. A null role is
`&null;`, a line end within a role `&nl;`.

A conversation's turns are one row's array: its last example holds all of them in one string anyhow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<s>", "</s>"
TARGET = "assistant"
#: What is written for what, in the order of writing; read in the opposite order.
REFERENCES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;"))


def escape(text: str | Column) -> Column:
    column = F.col(text) if isinstance(text, str) else text
    for char, reference in REFERENCES:
        column = F.replace(column, F.lit(char), F.lit(reference))
    return column


def unescape(text: str | Column) -> Column:
    column = F.col(text) if isinstance(text, str) else text
    for char, reference in reversed(REFERENCES):
        column = F.replace(column, F.lit(reference), F.lit(char))
    return column


def _written_role(role: Column) -> Column:
    lines = F.replace(escape(role), F.lit("\n"), F.lit("&nl;"))
    return F.coalesce(lines, F.lit("&null;"))


def _read_role(role: Column) -> Column:
    lines = F.replace(role, F.lit("&nl;"), F.lit("\n"))
    return F.when(role != "&null;", unescape(lines))


def format_examples(conversations: DataFrame) -> DataFrame:
    """One row for each assistant turn, with its context: conv_id, example (from 0), n_turns,
    formatted, loss_start, loss_chars (code points of `formatted`; null without a target) and last
    (whether all turns of the conversation are in it).

    Turns are ordered by `turn`, then role, then text, nulls first; repeated rows are kept; a null
    text is empty; a null conv_id is a conversation like any other. Other columns are ignored.
    """
    turn = F.struct(
        F.col("turn"), F.col("role"), F.coalesce("text", F.lit("")).alias("text")
    ).alias("turn")
    grouped = conversations.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(turn)).alias("turns")
    )
    parts = grouped.select(
        "conv_id",
        F.transform(
            "turns",
            lambda t: F.struct(
                F.coalesce(t["role"] == TARGET, F.lit(False)).alias("target"),
                F.concat(F.lit(OPEN), _written_role(t["role"]), F.lit("\n")).alias("head"),
                escape(t["text"]).alias("body"),
            ),
        ).alias("turns"),
    )
    n = F.size("turns")
    ends = F.filter(
        F.sequence(F.lit(1), n), lambda i: (i == n) | F.element_at("turns", i)["target"]
    )
    examples = parts.select("conv_id", "turns", F.posexplode(ends).alias("example", "n_turns"))
    prefix = F.slice("turns", F.lit(1), F.col("n_turns"))
    formatted = F.array_join(
        F.transform(prefix, lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), ""
    )
    final = F.element_at("turns", F.col("n_turns"))
    chars = F.char_length(final["body"])
    return examples.select(
        "conv_id",
        F.col("example").cast("long").alias("example"),
        F.col("n_turns").cast("long").alias("n_turns"),
        formatted.alias("formatted"),
        F.when(final["target"], F.char_length(formatted) - len(CLOSE) - chars)
        .cast("long")
        .alias("loss_start"),
        F.when(final["target"], chars).cast("long").alias("loss_chars"),
        (F.col("n_turns") == n).alias("last"),
    )


def read_turns(formatted: str | Column) -> Column:
    """The turns of a formatted example, as an array of (role, text)."""
    column = F.col(formatted) if isinstance(formatted, str) else formatted
    written = F.slice(F.split(column, CLOSE), 1, F.size(F.split(column, CLOSE)) - 1)
    return F.transform(
        written,
        lambda t: F.struct(
            _read_role(
                F.substring(
                    F.substring_index(t, "\n", 1), F.lit(len(OPEN) + 1), F.char_length(t)
                )
            ).alias("role"),
            unescape(F.substring(t, F.locate("\n", t) + 1, F.char_length(t))).alias("text"),
        ),
    )


def read_target(examples: DataFrame) -> Column:
    """The text under an example's loss mask, as it was before formatting; null without one."""
    return unescape(
        F.substring(F.col("formatted"), F.col("loss_start") + 1, F.col("loss_chars"))
    )


def conversation_digests(examples: DataFrame) -> DataFrame:
    """Per conversation what reading its examples back gives: conv_id, n_turns, turns_sha256 (role,
    line end, text, line end per turn; a null role is empty), loss_chars, loss_sha256 (all text
    under the loss masks, in order) and formatted_chars."""
    turns = F.when(F.col("last"), read_turns("formatted"))
    line = F.lit("\n")
    told = F.array_join(
        F.transform(
            "turns", lambda t: F.concat(F.coalesce(t["role"], F.lit("")), line, t["text"], line)
        ),
        "",
    )
    own = examples.select(
        "conv_id",
        "example",
        F.char_length("formatted").cast("long").alias("chars"),
        read_target(examples).alias("target"),
        turns.alias("turns"),
    ).select(
        "conv_id",
        "example",
        "chars",
        "target",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(told, "UTF-8"), 256).alias("turns_sha256"),
    )
    target = F.when(F.col("target").isNotNull(), F.struct("example", "target"))
    grouped = own.groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"),
        F.max("turns_sha256").alias("turns_sha256"),
        F.sort_array(F.collect_list(target)).alias("targets"),
        F.sum("chars").alias("formatted_chars"),
    )
    loss = F.array_join(F.transform("targets", lambda t: t["target"]), "")
    return grouped.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(F.encode(loss, "UTF-8"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
