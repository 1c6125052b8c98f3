"""Prefix-target expansion of conversations: every assistant turn is an example of its own.

An example is `<s>`, all turns before the target, the target's header, its reply and `</s>`; only the reply is
trainable. A turn is `[INST] role [/INST] text</s>`. Wherever one of the control strings stands in a role or a
text, a backslash is put behind its bracket; one that has backslashes there gets one more. So control strings
only stand where the template has put them, and taking one backslash away restores every text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The template's control strings.
BEGIN, END, HEADER, HEADER_END = "<s>", "</s>", "[INST] ", " [/INST] "
TARGET_ROLE = "assistant"

#: A bracket that opens a control string, with any number of backslashes behind it.
_OPENS = r"(<|\[)(?=\\*/?(?:s>|INST\]))"
_ESCAPED = r"(<|\[)\\(?=\\*/?(?:s>|INST\]))"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _OPENS, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1")


def render(role: Column, text: Column) -> Column:
    """One turn in the template."""
    return F.concat(F.lit(HEADER), escape(role), F.lit(HEADER_END), escape(text), F.lit(END))


def prefix_target_examples(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    target_role: str = TARGET_ROLE,
) -> DataFrame:
    """`conv_id`, `seq`, `formatted`, `loss_start`, `loss_end`: one row per turn of the target role.

    Characters from `loss_start` up to `loss_end` (from 0, exclusive) are trainable: the escaped reply, without
    the mark of its end. `seq` is the place of the target in its conversation. A conversation that does not
    end in a target has one more row, all its turns with an empty mask at its end, so that no turn is lost.

    Turns are ordered by number, then role, then text; null numbers come first, and repeated rows are turns of
    their own. Null roles and texts are empty, and rows without conversation id form one conversation. Other
    columns are not read; an empty table gives no rows. A conversation is one row while it is expanded: its
    longest example holds all of it in any case, and examples are built one by one.
    """
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    conversations = turns.groupBy(F.col(conv_col).alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("t"))
    numbered = F.transform("t", lambda turn, i: F.struct(turn["role"].alias("role"), i.alias("seq")))
    targets = F.filter(numbered, lambda turn: turn["role"] == target_role)["seq"]
    rest = F.when(F.element_at("t", -1)["role"] == target_role, F.array().cast("array<int>"))
    rows = conversations.select(
        "conv_id",
        F.transform("t", lambda turn: render(turn["role"], turn["text"])).alias("rendered"),
        F.size("t").alias("n"),
        F.concat(targets, F.coalesce(rest, F.array(F.size("t")))).alias("targets"),
    ).select("conv_id", "rendered", "n", F.explode("targets").alias("seq"))
    header = len(HEADER) + len(HEADER_END) + len(END)
    reply = F.length(F.get("rendered", F.col("seq"))) - header - F.length(escape(F.lit(target_role)))
    formatted = rows.select(
        "conv_id",
        "seq",
        F.concat(F.lit(BEGIN), F.array_join(F.slice("rendered", 1, F.col("seq") + 1), "")).alias("formatted"),
        F.when(F.col("seq") < F.col("n"), reply).alias("reply"),
    )
    end = F.length("formatted") - F.when(F.col("reply").isNull(), 0).otherwise(len(END))
    return formatted.select(
        "conv_id",
        "seq",
        "formatted",
        (end - F.coalesce("reply", F.lit(0))).alias("loss_start"),
        end.alias("loss_end"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, as an array of `role` and `text`."""
    marked = F.split(F.substr(formatted, F.lit(len(BEGIN) + 1)), END)
    head = lambda turn: F.substring_index(turn, HEADER_END, 1)
    return F.transform(
        F.slice(marked, 1, F.size(marked) - 1),
        lambda turn: F.struct(
            unescape(F.substr(head(turn), F.lit(len(HEADER) + 1))).alias("role"),
            unescape(F.substr(turn, F.length(head(turn)) + len(HEADER_END) + 1)).alias("text"),
        ),
    )


def trainable_text(formatted: Column, loss_start: Column, loss_end: Column) -> Column:
    """The text under the mask as it was before formatting."""
    return unescape(F.substr(formatted, loss_start + 1, loss_end - loss_start))
