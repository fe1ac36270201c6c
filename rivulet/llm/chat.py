"""Chat formatting: a log of events becomes messages, and messages become one string.

The log is partitioned by conversation and message and sorted by sequence number. Its
events are streamed deltas (append), edits (replace) and regenerations (start over).
Only DataFrame functions are used.

Rows: a null conversation id is a conversation of its own, a null turn comes first, a
null text, role or kind counts as an empty text, an empty role, a delta. Messages of a
conversation are ordered by turn, role, text and message id, so that equal turns have
one order; events of equal sequence number by kind, role and text. Repeated events
count each. Other columns, whatever their names, are left out. An empty log gives no
rows.

A conversation is rendered as one string, so one task writes it; its messages are folded
before that in tasks of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
REPLACING = ("edit", "regenerate")


def escape(text: Column, one_line: bool = False) -> Column:
    r"""The text without control strings: ``\`` as ``\\``, ``<|`` as ``<\|``.

    With ``one_line``, a line feed becomes ``\n``.
    """
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))
    return F.replace(out, F.lit("\n"), F.lit("\\n")) if one_line else out


def unescape(text: Column, one_line: bool = False) -> Column:
    """What ``escape`` was given. Between doubled backslashes each one marks an escape."""

    def plain(part: Column) -> Column:
        part = F.replace(part, F.lit("\\|"), F.lit("|"))
        return F.replace(part, F.lit("\\n"), F.lit("\n")) if one_line else part

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), plain), "\\")


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages from a log of (conv_id, turn, message_id, seq, kind, role, text).

    A message's text is what its last edit or regeneration and the deltas after it say;
    its role is the last one that is not null.
    """
    event = F.struct(
        "seq",
        F.coalesce("kind", F.lit("delta")).alias("kind"),
        "role",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    grouped = events.groupBy("conv_id", "turn", "message_id").agg(
        F.sort_array(F.collect_list(event)).alias("log")
    )
    log = F.col("log")
    last = F.array_max(F.transform(log, lambda e, i: F.when(e["kind"].isin(*REPLACING), i)))
    live = F.slice(log, F.coalesce(last, F.lit(0)) + 1, F.size(log))
    roles = F.filter(F.transform(log, lambda e: e["role"]), lambda r: r.isNotNull())
    return grouped.select(
        "conv_id",
        "turn",
        "message_id",
        F.when(F.size(roles) > 0, F.element_at(roles, -1)).otherwise("").alias("role"),
        F.array_join(F.transform(live, lambda e: e["text"]), "").alias("text"),
    )


def render(messages: DataFrame, learn: str = "assistant") -> DataFrame:
    """One string per conversation and the mask of what a model learns from.

    Messages have conv_id, turn, message_id, role, text. Returns conv_id, n_turns,
    formatted, loss_spans (start and length in code points of each text of the role
    ``learn``, as escaped) and loss_turns (a flag per turn).
    """
    head = F.concat(F.lit(START), escape(F.col("role"), True), F.lit("\n"))
    body = escape(F.col("text"))
    pieces = messages.select(
        "conv_id",
        "turn",
        "role",
        "text",
        "message_id",
        F.concat(head, body, F.lit(f"{END}\n")).alias("piece"),
        F.length(head).cast("long").alias("before"),
        F.length(body).cast("long").alias("within"),
        (F.col("role") == learn).alias("learnt"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text", "message_id")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.withColumn(
        "place", F.coalesce(F.sum(F.length("piece")).over(earlier), F.lit(0))
    )
    turn = F.struct("place", "piece", "before", "within", "learnt")
    grouped = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    turns = F.col("turns")
    return grouped.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.array_join(F.transform(turns, lambda t: t["piece"]), "").alias("formatted"),
        F.transform(
            F.filter(turns, lambda t: t["learnt"]),
            lambda t: F.struct(
                (t["place"] + t["before"]).alias("start"), t["within"].alias("length")
            ),
        ).alias("loss_spans"),
        F.transform(turns, lambda t: t["learnt"]).alias("loss_turns"),
    )


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a rendered conversation, unescaped."""
    parts = F.split(formatted, r"<\|im_end\|>\n", -1)
    parts = F.slice(parts, 1, F.size(parts) - 1)

    def turn(part: Column) -> Column:
        head = F.substring_index(part, "\n", 1)
        role = F.substr(head, F.lit(len(START) + 1))
        text = F.substr(part, F.length(head) + 2)
        return F.struct(unescape(role, True).alias("role"), unescape(text).alias("text"))

    return F.transform(parts, turn)


def digests(rendered: DataFrame) -> DataFrame:
    """Per conversation what its string and mask say when read back."""
    turns = rendered.select(
        "conv_id", "formatted", "loss_turns", read_back(F.col("formatted")).alias("turns")
    )
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learnt = F.filter("turns", lambda t, i: F.get("loss_turns", i))
    texts = turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(said, "").alias("said"),
        F.array_join(F.transform(learnt, lambda t: t["text"]), "").alias("learnt"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    return texts.select(
        "conv_id",
        "n_turns",
        F.sha2("said", 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        "formatted_chars",
    )
