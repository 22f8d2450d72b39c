"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example of its own: all preceding turns are context
and only that reply is trainable.  Turns after the last assistant turn (or a
conversation without one) become one more example without a trainable span, so that
no turn is lost.

Template of a turn: ``<|im_start|>role NEWLINE text<|im_end|>NEWLINE``.  Inside roles
and texts a backslash is written ``\\s``, the control strings' opening ``<|`` becomes
``<\\|`` and a newline in a role ``\\n``.  Written texts therefore never hold ``<|``,
each backslash starts an escape, and :func:`unescape` gives back the original.

Defined results: NULL role or text is empty; a NULL conv_id is one conversation; turns
are ordered by (turn, role, text) with NULL first, so ties and repeated rows keep a
fixed order; an empty table gives no examples; other columns are not read.  All turns
of one conversation are brought together, since an example is one string that holds
them; the examples of a conversation leave the task one at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TARGET = "assistant"


def _replace(column: Column, old: str, new: str) -> Column:
    return F.replace(column, F.lit(old), F.lit(new))


def escape(text: Column) -> Column:
    return _replace(_replace(text, "\\", "\\s"), "<|", "<\\|")


def unescape(text: Column) -> Column:
    return _replace(_replace(_replace(text, "\\|", "|"), "\\n", "\n"), "\\s", "\\")


def turn_text(role: Column, text: Column) -> Column:
    role = _replace(escape(role), "\n", "\\n")
    return F.concat(F.lit(START), role, F.lit("\n"), escape(text), F.lit(END + "\n"))


def chat_examples(conversations: DataFrame) -> DataFrame:
    """Examples: ``conv_id``, ``example`` (from 0), ``text``, ``loss_start``, ``loss_end``.

    ``[loss_start, loss_end)`` are code points of ``text``; both are NULL in an
    example without a trainable span.  ``last`` marks the longest example.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turn = F.struct(
        F.col("turn"), role.alias("role"), text.alias("text"),
        turn_text(role, text).alias("written"),
    )
    whole = (
        conversations.select("conv_id", turn.alias("t"))
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list("t")).alias("turns"))
        .withColumn("written", F.array_join("turns.written", ""))
    )
    # Length of the text up to the end of each turn, by one pass over the turns.
    ends = F.aggregate(
        "turns",
        F.array().cast("array<long>"),
        lambda acc, t: F.concat(
            acc,
            F.array(
                F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0))
                + F.char_length(t["written"])
            ),
        ),
    )
    marks = F.transform(
        F.arrays_zip(F.col("turns.role").alias("role"), F.col("ends").alias("end")),
        lambda x: F.struct((x["role"] == TARGET).alias("target"), x["end"].alias("end")),
    )
    replies = F.filter("marks", lambda m: m["target"])
    tail = F.filter(
        F.slice("marks", -1, 1), lambda m: ~m["target"]
    )
    closing = len(END) + 1
    # A reply's text ends before the turn's closing mark; its length is known.
    body = F.transform(
        F.filter("turns", lambda t: t["role"] == TARGET),
        lambda t: F.char_length(escape(t["text"])).cast("long"),
    )
    example = F.posexplode(
        F.concat(
            F.zip_with(
                "replies", "body",
                lambda m, n: F.struct(
                    m["end"].alias("end"), (m["end"] - closing - n).alias("loss_start"),
                    (m["end"] - closing).alias("loss_end"),
                ),
            ),
            F.transform(
                tail,
                lambda m: F.struct(
                    m["end"].alias("end"), F.lit(None).cast("long").alias("loss_start"),
                    F.lit(None).cast("long").alias("loss_end"),
                ),
            ),
        )
    ).alias("example", "e")
    return (
        whole.withColumn("ends", ends)
        .withColumn("marks", marks)
        .withColumn("replies", replies)
        .withColumn("body", body)
        .select("conv_id", "written", F.size("turns").alias("n"), F.element_at("ends", -1).alias("all"), example)
        .select(
            "conv_id", "example",
            F.substring("written", F.lit(1), F.col("e.end").cast("int")).alias("text"),
            F.col("e.loss_start").alias("loss_start"), F.col("e.loss_end").alias("loss_end"),
            (F.col("e.end") == F.col("all")).alias("last"),
        )
    )


def read_turns(text: Column) -> Column:
    """Turns of a formatted text as an array of (role, text)."""
    parts = F.split(text, r"<\|im_end\|>\n")
    parts = F.slice(parts, 1, F.size(parts) - 1)

    def turn(part: Column) -> Column:
        body = F.substring(part, F.lit(len(START) + 1), F.char_length(part))
        cut = F.locate("\n", body)
        return F.struct(
            unescape(F.substring(body, F.lit(1), cut - 1)).alias("role"),
            unescape(F.substring(body, cut + 1, F.char_length(body))).alias("text"),
        )

    return F.transform(parts, turn)


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation: its turns, read from the longest example, and the trainable
    text, read under each example's mask in order."""
    loss = F.substring(
        "text", (F.col("loss_start") + 1).cast("int"),
        (F.col("loss_end") - F.col("loss_start")).cast("int"),
    )
    return (
        examples.select(
            "conv_id", "example", F.char_length("text").cast("long").alias("chars"),
            unescape(loss).alias("loss"), F.when(F.col("last"), F.col("text")).alias("whole"),
        )
        .groupBy("conv_id")
        .agg(
            F.array_sort(F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("example", "loss")))).alias("l"),
            F.max("whole").alias("whole"),
            F.sum("chars").alias("formatted_chars"),
            F.count(F.lit(1)).alias("n_examples"),
        )
        .select(
            "conv_id", read_turns(F.col("whole")).alias("turns"),
            F.array_join("l.loss", "").alias("loss_text"), "formatted_chars", "n_examples",
        )
    )
