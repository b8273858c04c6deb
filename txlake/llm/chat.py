"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the
context and only its text is trainable. What follows a conversation's last
assistant turn (and a conversation without one) is an example without a target, so
that every turn can be read back.

A turn is written as ``</s>[INST] role [/INST] text``. The four characters that control
strings need are escaped inside roles and texts by a backslash, which makes marks
unambiguous and the way back exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, BETWEEN = "</s>[INST] ", " [/INST] "
#: Characters that a backslash goes before inside a text. Without a bare one of them no mark can appear.
ESCAPED = r"([\\<\[])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\<\[])", "$1")


def conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, turns``: roles and texts in the order of ``turn``, ties by role and text; nulls are empty strings."""
    plain = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    return plain.groupBy("conv_id").agg(ordered.alias("turns"))


def expand(turns: DataFrame, target: str = "assistant") -> DataFrame:
    """``conv_id, example, examples, target_turn, formatted, loss_start, loss_end`` of ``conv_id, turn, role, text``.

    ``example`` counts from 0 to ``examples`` - 1; ``target_turn`` is the trainable turn's place, null
    for the example of a tail without a target. The loss mask covers the escaped
    text of the target, as code points of ``formatted``, end exclusive (null without
    a target). Null roles and texts are empty; turns that tie or repeat are kept, in
    the order of role and text; a null ``conv_id`` is a conversation of its own;
    other columns are ignored; an empty table gives no rows.
    """
    rendered = conversations(turns).select(
        "conv_id",
        F.transform("turns", lambda t: F.concat(F.lit(OPEN), escape(t["role"]), F.lit(BETWEEN), escape(t["text"]))).alias("parts"),
        F.transform("turns", lambda t: F.length(escape(t["text"]))).alias("sizes"),
        F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: F.get("turns", i - 1)["role"] == target).alias("targets"),
        F.size("turns").alias("n"),
    )
    tail = F.when(F.coalesce(F.try_element_at("targets", F.lit(-1)), F.lit(0)) < F.col("n"), F.array(F.col("n")))
    wanted = F.concat("targets", F.coalesce(tail, F.array().cast("array<int>")))
    each = rendered.select(
        "conv_id", "parts", "sizes", "targets", F.size(wanted).alias("examples"),
        F.posexplode(wanted).alias("example", "last"),
    )
    formatted = F.array_join(F.slice("parts", 1, F.col("last")), "")
    trainable = F.array_contains("targets", F.col("last"))
    made = each.select(
        "conv_id", "example", "examples", "last", formatted.alias("formatted"), trainable.alias("trainable"),
        F.element_at("sizes", F.col("last")).alias("size"),
    )
    length = F.length("formatted")
    return made.select(
        "conv_id", "example", "examples",
        F.when(F.col("trainable"), F.col("last") - 1).alias("target_turn"),
        "formatted",
        F.when(F.col("trainable"), length - F.col("size")).alias("loss_start"),
        F.when(F.col("trainable"), length).alias("loss_end"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns in a formatted text, as an array of ``role, text``."""
    parts = F.slice(F.split(formatted, r"</s>\[INST\] ", -1), 2, F.length(formatted) + 1)

    def turn(part: Column) -> Column:
        at = F.instr(part, BETWEEN)
        return F.struct(
            unescape(F.substring(part, F.lit(1), at - 1)).alias("role"),
            unescape(F.substring(part, at + len(BETWEEN), F.length(part))).alias("text"),
        )

    return F.transform(parts, turn)
