"""Chat formatting by event-sourced reconstruction.

A log of events (opened messages, streamed deltas, edits, regenerations) is folded into
final messages, message by message first, so that the many small events of a hot
conversation are combined under the key of their message before anything is grouped by
conversation. Final messages are then ordered inside their conversation, rendered with a
template, and put together with a byte mask of what the assistant said.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Kinds of events. ``open`` names the role, ``delta`` adds text, ``edit`` replaces the
#: text so far, ``regenerate`` discards it and all later messages opened before.
OPEN, DELTA, EDIT, REGENERATE = "open", "delta", "edit", "regenerate"

#: Template.
START, MESSAGE, END = "<|start|>", "<|message|>", "<|end|>"
#: Strings that mean something to chat templates. A backslash goes behind the first
#: character of each one in a text, and before each backslash.
CONTROLS = ("<|", "|>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<s>", "</s>")
ASSISTANT = "assistant"
#: Code points of a delta and of a discarded draft in ``as_events``.
PIECE, DRAFT = 512, 40


def escape(text: Column) -> Column:
    """``text`` without any control string; ``unescape`` undoes it."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROLS:
        out = F.replace(out, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conversation, message, role, text) of a log.

    ``events`` has conversation, message, seq, kind, role and text; message and seq are
    of any orderable type, seq grows inside a conversation. Other columns are not looked
    at. Equal events are one event delivered twice. A message's text is that of its last
    edit (nothing after a regeneration or without either) and of the deltas after it, by
    seq. A regeneration also takes back the later messages of its conversation that were
    opened before it. The role is that of the first ``open``; without one it is empty, as
    are null roles and texts. Null conversations, messages and sequences are values like
    others, and null sequences come first. An unknown kind changes nothing.
    """
    resets = F.col("kind").isin(EDIT, REGENERATE)
    # null sequences are given a place, else max and min would pass over them
    at = F.struct(F.col("seq").isNotNull().alias("known"), F.col("seq").alias("seq"))
    event = F.struct(at.alias("at"), F.col("kind").alias("kind"), F.coalesce("text", F.lit("")).alias("text"))
    messages = events.groupBy("conversation", "message").agg(
        F.collect_set(F.when(F.col("kind").isin(DELTA, EDIT), event)).alias("pieces"),
        F.max(F.when(resets, at)).alias("reset"),
        F.max(F.when(F.col("kind") == REGENERATE, at)).alias("again"),
        F.min(at).alias("opened"),
        F.min_by(F.coalesce("role", F.lit("")), F.when(F.col("kind") == OPEN, at)).alias("role"),
    )
    live = F.filter(
        "pieces", lambda e: F.col("reset").isNull() | (e["at"] > F.col("reset"))
        | ((e["at"] == F.col("reset")) & (e["kind"] == EDIT))
    )
    ordered = F.sort_array(live)
    earlier = (
        Window.partitionBy("conversation").orderBy("message")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        messages.withColumn("text", F.array_join(F.transform(ordered, lambda e: e["text"]), ""))
        .withColumn("cut", F.max("again").over(earlier))
        .filter("cut IS NULL OR opened > cut")
        .select("conversation", "message", F.coalesce("role", F.lit("")).alias("role"), "text")
    )


def render(messages: DataFrame) -> DataFrame:
    """One row (conversation, formatted, loss) for each conversation of ``fold``.

    ``loss`` lists what the assistant said as (start, length) in bytes of ``formatted``,
    in order. Roles and texts are escaped, so each control string is the template's own.
    """
    head = F.concat(F.lit(START), escape(F.col("role")), F.lit(MESSAGE))
    shown = messages.select(
        "conversation", "message", (F.col("role") == ASSISTANT).alias("said"),
        head.alias("head"), escape(F.col("text")).alias("body"),
    )
    size = (F.octet_length("head") + F.octet_length("body") + F.lit(len(END))).cast("long")
    order = Window.partitionBy("conversation").orderBy("message")
    before = F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1))
    placed = shown.withColumn("place", F.coalesce(before, F.lit(0)))
    span = F.struct(
        (F.col("place") + F.octet_length("head")).alias("start"),
        F.octet_length("body").cast("long").alias("length"),
    )
    piece = F.struct("place", F.concat("head", "body", F.lit(END)).alias("text"))
    return placed.groupBy("conversation").agg(
        F.sort_array(F.collect_list(piece)).alias("pieces"),
        F.sort_array(F.collect_list(F.when(F.col("said"), span))).alias("loss"),
    ).select(
        "conversation",
        F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"), "loss",
    )


def read_back(rendered: DataFrame) -> DataFrame:
    """Add ``turns``, the (role, text) that the template holds, and ``learned``, the
    unescaped texts under the mask, both read from the formatted text alone."""
    turn = F.slice(F.split("formatted", "<[|]end[|]>"), F.lit(1), F.greatest(
        F.size(F.split("formatted", "<[|]end[|]>")) - 1, F.lit(0)
    ))

    def parts(t: Column) -> Column:
        inner = F.split(F.substr(t, F.lit(len(START) + 1)), "<[|]message[|]>")
        return F.struct(
            unescape(F.get(inner, F.lit(0))).alias("role"), unescape(F.get(inner, F.lit(1))).alias("text")
        )

    data = F.col("formatted").cast("binary")
    spans = F.transform("loss", lambda s: unescape(
        F.substr(data, (s["start"] + 1).cast("int"), s["length"].cast("int")).cast("string")
    ))
    return rendered.withColumns({"turns": F.transform(turn, parts), "learned": spans})


def as_events(conversations: DataFrame) -> DataFrame:
    """The log that would have streamed ``conversations`` (conv_id, turn, role, text).

    Every row is a message, opened and then streamed in deltas of ``PIECE`` code points.
    Before, the assistant streams a draft that is regenerated, and others one that they
    edit into the first piece. Messages are ordered by turn (nulls last), then role and
    text, so ties have an order and repeated rows stay messages of their own; null texts
    are empty.
    """
    text = F.coalesce("text", F.lit(""))
    rows = conversations.select(
        F.col("conv_id").alias("conversation"),
        F.struct(
            F.col("turn").isNull().alias("last"), F.col("turn").alias("turn"),
            F.coalesce("role", F.lit("")).alias("role"), F.xxhash64(text).alias("hash"),
            F.monotonically_increasing_id().alias("tie"),
        ).alias("message"),
        F.coalesce("role", F.lit("")).alias("author"),
        text.alias("whole"),
    )
    pieces = F.regexp_extract_all("whole", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    said = F.col("author") == ASSISTANT

    def event(kind: Column, role: Column, body: Column) -> Column:
        return F.struct(kind.alias("kind"), role.alias("role"), body.alias("text"))

    none = F.lit(None).cast("string")
    start = F.array(
        event(F.lit(OPEN), F.col("author"), none),
        event(F.lit(DELTA), none, F.substr("whole", F.lit(1), F.lit(DRAFT))),
        event(F.when(said, REGENERATE).otherwise(EDIT), none, F.when(said, none).otherwise(F.get("pieces", F.lit(0)))),
    )
    rest = F.when(said, F.col("pieces")).otherwise(F.slice("pieces", F.lit(2), F.greatest(F.size("pieces"), F.lit(1))))
    log = F.concat(start, F.transform(rest, lambda p: event(F.lit(DELTA), none, p)))
    streamed = rows.withColumn("pieces", pieces).select(
        "conversation", "message", F.posexplode(log).alias("step", "event")
    )
    return streamed.select(
        "conversation", "message", F.struct("message", "step").alias("seq"), "event.*"
    )


def format_conversations(conversations: DataFrame) -> DataFrame:
    """Formatted text and loss mask of every conversation, by way of its log.

    Takes conv_id, turn, role and text; see ``as_events``, ``fold`` and ``render`` for
    null, empty, tied and repeated rows. Rows of a null conv_id are one conversation, an
    empty table gives an empty result, and other columns are not looked at.
    """
    return render(fold(as_events(conversations)))
