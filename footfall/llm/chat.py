"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context
and that reply as the only trainable part. A conversation that doesn't end on an
assistant turn has one more example, without a trainable part, that holds all its
turns; so the formatted rows hold every turn of every conversation.

A turn is written as ``<|role|>``, the text, ``<|end|>``. Inside roles and texts a
backslash follows each ``<``, ``[``, ``|`` and backslash, so that neither these marks nor
other common control strings (``</s>``, ``[INST]``) can stand there, and taking the
backslashes out again restores the text.

The trainable part is given by its first character (from 0) and its length, the
end mark not included.

An example holds all turns before its reply, so a conversation of n turns takes
n * n / 2 turns of text; that is the method's. Turns are numbered and put together
per conversation, which has to fit a row, as its last example has to.

Defined cases: a NULL text is empty; a NULL role is the role ``unknown``; rows are
in order of turn (NULL first), those with the same turn by role and text, and repeated rows are
turns of their own. Rows without a conversation id form one conversation with a
NULL id. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "<|end|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[|])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[|])\\", "$1")


def _turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), escape(role), F.lit("|>"), escape(text), F.lit(END))


def format_examples(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``example``, ``formatted``, ``loss_start`` and ``loss_length``.

    Takes ``conv_id``, ``turn``, ``role`` and ``text``. Examples are numbered from 0
    in the order of their replies; one without a trainable part has NULL there.
    """
    turns = conversations.select(
        "conv_id",
        F.struct(
            "turn",
            F.coalesce("role", F.lit("unknown")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).alias("t"),
    )
    gathered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    written = gathered.select(
        "conv_id",
        F.transform("turns", lambda t: t.role).alias("roles"),
        F.transform("turns", lambda t: _turn(t.role, t.text)).alias("written"),
        F.transform("turns", lambda t: F.char_length(escape(t.text))).alias("lengths"),
    )
    last = F.size("roles") - 1
    targets = F.filter(
        F.sequence(F.lit(0), last),
        lambda i: (F.get("roles", i) == "assistant") | (i == last),
    )
    examples = written.select("*", F.posexplode(targets).alias("example", "target"))
    formatted = F.array_join(F.slice("written", F.lit(1), F.col("target") + 1), "")
    trainable = F.get("roles", F.col("target")) == "assistant"
    length = F.get("lengths", F.col("target"))
    return examples.select(
        "conv_id", "example", formatted.alias("formatted"), trainable.alias("t"), length.alias("n")
    ).select(
        "conv_id",
        "example",
        "formatted",
        F.when(
            F.col("t"), F.char_length("formatted") - F.col("n") - F.lit(len(END))
        ).alias("loss_start"),
        F.when(F.col("t"), F.col("n")).alias("loss_length"),
    )


def trainable_text(examples: DataFrame) -> Column:
    """The text under an example's loss mask, unescaped; NULL without one."""
    return unescape(F.substring("formatted", F.col("loss_start") + 1, F.col("loss_length")))


def read_turns(formatted: Column) -> Column:
    """``role`` and ``text`` of every turn of an example, as they were before."""
    # Marks are the only places where ``<`` comes before ``|``.
    parts = F.split(formatted, r"<\|end\|>", -1)
    whole = F.slice(parts, F.lit(1), F.size(parts) - 1)
    return F.transform(
        whole,
        lambda p: F.struct(
            unescape(F.regexp_extract(p, r"(?s)^<\|(.*?)\|>", 1)).alias("role"),
            unescape(F.regexp_extract(p, r"(?s)^<\|.*?\|>(.*)$", 1)).alias("text"),
        ),
    )
