"""Chat formatting from an event log.

A log holds one row per event: conversation, sequence number, message, kind,
role and text. ``message`` sets a message's text and role, ``edit`` replaces
its text, ``delta`` appends a streamed piece, and ``regenerate`` empties a
message and discards every later message as it was logged before that event.
The log is partitioned by conversation, sorted by sequence number and folded
into final messages, which a template renders.

Template: every turn is ``<s>...</s>``. A user's text stands in ``[INST]``
marks, the system's in ``<<SYS>>`` marks, an assistant's is bare, and another
role is named in ``[ROLE]`` marks before its text. A control string inside a
text gets a backslash after its first character (and one more if it already
has some), which ``unescape`` takes away again; nothing else is changed.

Defined cases: a null text or role is empty; a null sequence number comes
first; a null conversation is one conversation; exact repeats of an event count
once; events of equal sequence number apply in the order of kind, role and
text; events of unknown kinds do nothing; a message without a live event is
left out; an empty log gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellpulse.llm.common import let

#: How each kind of event ranks among events of equal number.
KINDS = ("message", "edit", "regenerate", "delta")
FIRST = -(2**63)
#: What may follow the first character of a control string.
TAILS = r"(/?s>|/?INST\]|</?SYS>>|/?ROLE\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + TAILS, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + TAILS, "$1$2$3")


def fold(
    log: DataFrame,
    conversation: str = "conv_id",
    sequence: str = "seq",
    message: str = "message",
    kind: str = "kind",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Final messages: ``conv_id``, ``message``, ``role``, ``text``.

    Events meet by message, so a conversation with a third of all events is
    folded by as many tasks as its messages fill; only three numbers per
    message meet by conversation, to find what a regeneration discards.
    """
    rank = F.array_position(F.array(*(F.lit(k) for k in KINDS)), F.col(kind))
    event = F.struct(
        F.coalesce(F.col(sequence).cast("long"), F.lit(FIRST)).alias("seq"),
        rank.alias("rank"),
        F.col(role).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    events = log.select(F.col(conversation).alias("conv_id"), F.col(message).alias("message"), event.alias("e"))
    events = events.where(F.col("e.rank") > 0)
    again = KINDS.index("regenerate") + 1
    messages = events.groupBy("conv_id", "message").agg(
        F.sort_array(F.collect_set("e")).alias("log"),
        F.max(F.when(F.col("e.rank") == again, F.col("e.seq"))).alias("again"),
    )
    earlier = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    live = F.filter("log", lambda e: F.coalesce(e["seq"] > F.col("cut"), F.lit(True)))
    messages = messages.withColumn("cut", F.max("again").over(earlier)).select(
        "conv_id", "message", live.alias("log")
    )
    delta = KINDS.index("delta") + 1

    def text_of(events: Column) -> Column:
        resets = F.filter(F.sequence(F.lit(0), F.size(events) - 1), lambda i: F.get(events, i)["rank"] < delta)
        start = F.coalesce(F.try_element_at(resets, F.lit(-1)), F.lit(0))
        after = lambda first: F.slice(events, first + 1, F.size(events))
        piece = lambda e: F.when(e["rank"] == again, F.lit("")).otherwise(e["text"])
        return let(start, lambda first: F.array_join(F.transform(after(first), piece), ""))

    named = F.filter("log", lambda e: e["role"].isNotNull() & (e["rank"] == 1))
    return messages.where(F.size("log") > 0).select(
        "conv_id",
        "message",
        F.coalesce(F.try_element_at(named, F.lit(-1))["role"], F.lit("")).alias("role"),
        let(F.col("log"), text_of).alias("text"),
    )


def segments_of(role: Column, text: Column) -> Column:
    """A turn as pieces of formatted text, each under the loss mask or not."""
    piece = lambda x, loss: F.struct(x.alias("text"), F.lit(loss).alias("loss"))
    around = lambda head, tail: F.array(
        piece(F.concat(F.lit("<s>" + head), escape(text), F.lit(tail + "</s>")), False)
    )
    named = F.concat(F.lit("<s>[ROLE]"), escape(role), F.lit("[/ROLE]"), escape(text), F.lit("</s>"))
    return (
        F.when(role == "user", around("[INST]", "[/INST]"))
        .when(role == "system", around("<<SYS>>", "<</SYS>>"))
        .when(
            role == "assistant",
            F.array(piece(F.lit("<s>"), False), piece(escape(text), True), piece(F.lit("</s>"), False)),
        )
        .otherwise(F.array(piece(named, False)))
    )


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: ``formatted`` and ``segments``, whose texts make it up in order.

    A conversation is one string, so its messages meet here.
    """
    turns = messages.select("conv_id", F.struct("message", segments_of(F.col("role"), F.col("text")).alias("s")).alias("t"))
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    segments = F.flatten(F.transform("t", lambda t: t["s"]))
    return grouped.select("conv_id", segments.alias("segments")).select(
        "conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments"
    )


def turns_of(formatted: Column) -> Column:
    """The turns read back from formatted text: an array of ``role`` and ``text``."""
    parts = F.split(formatted, "</s>")
    inner = lambda part, head, tail: F.substring(
        part, F.lit(head + 1), F.length(part) - head - tail
    )
    turn = lambda role, text: F.struct(role.alias("role"), unescape(text).alias("text"))

    def read(part: Column) -> Column:
        named = part.startswith("<s>[ROLE]")
        rest = F.substring_index(inner(part, 9, 0), "[/ROLE]", 1)
        after = F.substring(part, F.length(rest) + F.lit(9 + 7 + 1), F.length(part))
        return (
            F.when(part.startswith("<s>[INST]"), turn(F.lit("user"), inner(part, 9, 7)))
            .when(part.startswith("<s><<SYS>>"), turn(F.lit("system"), inner(part, 10, 8)))
            .when(named, turn(unescape(rest), after))
            .otherwise(turn(F.lit("assistant"), inner(part, 3, 0)))
        )

    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), read)


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations hold, read back from them."""
    lines = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    under = F.array_join(
        F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), ""
    )
    turn_digest = let(
        turns_of(F.col("formatted")),
        lambda t: F.struct(
            F.size(t).cast("long").alias("n"), F.sha2(F.array_join(F.transform(t, lines), ""), 256).alias("sha")
        ),
    )
    loss = let(under, lambda x: F.struct(F.length(x).cast("long").alias("n"), F.sha2(x, 256).alias("sha")))
    return formatted.select("conv_id", "formatted", turn_digest.alias("t"), loss.alias("loss")).select(
        "conv_id",
        F.col("t.n").alias("n_turns"),
        F.col("t.sha").alias("turns_sha256"),
        F.col("loss.n").alias("loss_chars"),
        F.col("loss.sha").alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


#: Events of one message that a log of turns may hold, and pieces that a text is streamed in.
EVENTS, PIECES = 1 << 9, 200
PIECE_CHARS = 32


def log_of_turns(conversations: DataFrame) -> DataFrame:
    """A table of turns as the log that a chat would have written.

    An assistant's text is streamed in pieces; by a hash of the turn a third of them are
    streamed wrongly first and then regenerated. A third of all other texts are
    sent with a mistake and edited later. Rows of one turn are numbered by role and
    text, so repeated rows are messages of their own. A row without a turn number is sent as it is.
    """
    rows = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    same_turn = Window.partitionBy("conv_id", "turn").orderBy(F.coalesce("role", F.lit("")), "text")
    rows = rows.withColumn("place", F.row_number().over(same_turn) - 1)
    size = F.greatest(F.lit(PIECE_CHARS), F.ceil(F.length("text") / PIECES).cast("int"))
    starts = F.sequence(F.lit(0), F.greatest(F.ceil(F.length("text") / F.col("size")).cast("int") - 1, F.lit(0)))
    pieces = F.transform(starts, lambda i: F.substring("text", i * F.col("size") + 1, F.col("size")))
    draw = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(3))
    streamed = (F.col("role") == "assistant") & F.col("turn").isNotNull()
    rows = rows.withColumn("size", size).select(
        "conv_id", "turn", "place", "role", "text", pieces.alias("pieces"), draw.alias("draw"), F.coalesce(streamed, F.lit(False)).alias("streamed")
    )
    event = lambda kind, role, text: F.array(F.struct(F.lit(kind).alias("kind"), role.alias("role"), text.alias("text")))
    nothing, wrong = F.lit(None).cast("string"), F.reverse("pieces")
    deltas = lambda texts: F.transform(texts, lambda t: F.struct(F.lit("delta").alias("kind"), nothing.alias("role"), t.alias("text")))
    opened = event("message", F.col("role"), nothing)
    stream = F.concat(opened, deltas("pieces"))
    again = F.concat(opened, deltas(wrong), event("regenerate", nothing, nothing), deltas("pieces"))
    mistaken = event("message", F.col("role"), F.concat(F.lit("draft: "), F.reverse("text")))
    edited = F.concat(mistaken, event("edit", nothing, F.col("text")))
    events = (
        F.when(F.col("streamed"), F.when(F.col("draw") == 0, again).otherwise(stream))
        .when((F.col("draw") == 1) & F.col("turn").isNotNull(), edited)
        .otherwise(event("message", F.col("role"), F.col("text")))
    )
    number = F.col("turn").cast("long") * (1 << 32) + F.col("place") * EVENTS
    log = rows.select("conv_id", number.alias("number"), F.struct("turn", "place").alias("message"), F.posexplode(events).alias("k", "e"))
    return log.select("conv_id", (F.col("number") + F.col("k")).alias("seq"), "message", "e.kind", "e.role", "e.text")
