"""Chat logs folded into messages and rendered (DataFrame functions only).

A log row is an event of a conversation: ``seq`` orders the events, ``kind``
says what happened and ``target`` which message it happened to:

========== ==================================================================
message    a complete message (role, text)
start      an empty message that deltas will fill (role)
delta      text appended to the message
edit       the message's text becomes this text
regenerate the message's text is discarded; later deltas build it anew
delete     the message is withdrawn
========== ==================================================================

Events are folded per (conversation, target) first, so a long conversation is
spread over tasks and only final messages meet in the conversation's row.

Template: ``### Role: text</turn>\\n`` per message. Inside texts and roles a
backslash becomes two, and what makes up a control string gets a backslash in
its middle (``<\\/turn>``, ``#\\#``), so neither control string can occur in an
escaped text, and unescaping is dropping each escaping backslash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunelake.llm.common import quoted

# The template's control strings and the roles written as titles.
MARK = "###"
END = "</turn>\n"
ROLES = {"system": "System", "user": "User", "assistant": "Assistant"}

LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("</turn>"), F.lit("<\\/turn>"))
    return F.replace(text, F.lit("##"), F.lit("#\\#"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def turn_events(turns: DataFrame) -> DataFrame:
    """A table with one row per turn, as a log of ``message`` events."""
    return turns.select("conv_id", quoted("turn").cast("long").alias("seq"), quoted("turn").cast("string").alias("target"),
                        F.lit("message").alias("kind"), "role", "text")


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages: conv_id, messages array<struct<seq, role, text>> in
    order of their first event.

    A ``message`` or ``start`` opens a new message; every other event acts on
    the last message opened for its target, or opens one when there is none.
    Equal seq: ties are broken by kind (openings first), role and text.
    Repeated ``message`` rows stay separate messages. Null text and role count
    as empty, a null seq sorts first, a null kind is a ``message``, a null
    conv_id or target is a value like any other; unknown kinds raise.
    """
    kinds = ["message", "start", "regenerate", "edit", "delta", "delete"]
    kind = F.coalesce(F.col("kind"), F.lit("message"))
    rank = F.array_position(F.array(*map(F.lit, kinds)), kind).cast("int")
    rank = F.when(rank > 0, rank).otherwise(F.raise_error(F.concat(F.lit("unknown event kind: "), kind)))
    per_target = (events.select("conv_id", "target", F.struct(
        F.col("seq").alias("seq"), rank.alias("rank"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")).alias("e"))
        .groupBy("conv_id", "target").agg(F.sort_array(F.collect_list("e")).alias("log")))
    # [start, end) of each message within the target's log
    per_target = per_target.withColumn("cuts", F.expr(
        "array_distinct(array_union(array(0), filter(sequence(0, size(log) - 1), i -> log[i].rank <= 2)))"))
    runs = F.expr("transform(cuts, (a, k) -> slice(log, a + 1, coalesce(try_element_at(cuts, k + 2), size(log)) - a))")
    fold = """transform(runs, r -> struct(
        r[0].seq as seq, r[0].role as role,
        array_join(transform(filter(slice(r, greatest(1, array_max(transform(r,
            (e, i) -> if(e.rank in (1, 2, 3, 4), i + 1, 0)))), size(r)), e -> e.rank in (1, 4, 5)), e -> e.text), '') as text,
        exists(r, e -> e.rank = 6) as gone))"""
    messages = (per_target.withColumn("runs", runs).withColumn("messages", F.expr(fold))
                .select("conv_id", F.expr("transform(filter(messages, m -> not m.gone), m -> struct(m.seq, m.role, m.text))").alias("messages")))
    return (messages.groupBy("conv_id")
            .agg(F.sort_array(F.flatten(F.collect_list("messages"))).alias("messages")))


def render(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans: every conversation as one text, and the
    places of its assistant texts in it: array of (start, length) in code
    points and (byte_start, byte_length) in UTF-8, in order.

    Roles other than those of ``ROLES`` are written as ``=`` and the escaped
    name. A conversation without messages renders to nothing and is left out.
    """
    role_names = F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv])
    named = F.coalesce(F.try_element_at(role_names, F.col("m.role")),
                       F.concat(F.lit("="), F.replace(escape(F.col("m.role")), F.lit(":"), F.lit("\\:"))))
    rows = (conversations.select("conv_id", F.explode("messages").alias("m"))
            .select("conv_id", F.col("m.seq").alias("seq"), F.col("m.role").alias("role"),
                    F.concat(F.lit(MARK + " "), named, F.lit(": ")).alias("head"), escape(F.col("m.text")).alias("body")))
    # running ends: a sorted pass over the conversation, which its text needs anyway
    order = Window.partitionBy("conv_id").orderBy("seq", "role", "body")
    for unit, length in (("chars", F.char_length), ("bytes", F.octet_length)):
        rows = (rows.withColumn(unit, length("body").cast("long"))
                .withColumn(f"{unit}_to", F.sum(length("head") + length("body") + len(END)).over(
                    order.rowsBetween(Window.unboundedPreceding, 0)) - len(END) - F.col(unit)))
    span = F.struct(F.col("chars_to").alias("start"), F.col("chars").alias("length"),
                    F.col("bytes_to").alias("byte_start"), F.col("bytes").alias("byte_length"))
    piece = F.struct(F.col("chars_to").alias("at"), F.concat("head", "body", F.lit(END)).alias("text"))
    return (rows.withColumn("piece", piece)
            .withColumn("span", F.when(F.col("role") == LOSS_ROLE, span))
            .groupBy("conv_id")
            .agg(F.sort_array(F.collect_list("piece")).alias("pieces"), F.sort_array(F.collect_list("span")).alias("loss_spans"))
            .select("conv_id", F.array_join("pieces.text", "").alias("formatted"), "loss_spans"))


def format_conversations(events: DataFrame) -> DataFrame:
    """The log folded and rendered: conv_id, formatted, loss_spans."""
    return render(fold_events(events))


def read_turns(rendered: DataFrame) -> DataFrame:
    """``rendered`` plus ``turns`` array<struct<role, text>>, parsed from the
    formatted text alone, and ``loss_texts`` array<string>, the unescaped
    texts under the loss mask."""
    names = F.create_map(*[F.lit(x) for k, v in ROLES.items() for x in (v, k)])

    def turn(part: Column) -> Column:
        role = F.regexp_extract(part, r"(?s)^### ((?:[^:\\]|\\.)*): ", 1)
        known = F.try_element_at(names, role)
        return F.struct(F.coalesce(known, unescape(F.substr(role, F.lit(2)))).alias("role"),
                        unescape(F.substr(part, F.char_length(role) + len(MARK) + 4)).alias("text"))

    parts = F.split("formatted", END)
    turns = F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), turn)
    raw = F.col("formatted").cast("binary")
    texts = F.transform("loss_spans", lambda s: unescape(
        F.substr(raw, (s["byte_start"] + 1).cast("int"), s["byte_length"].cast("int")).cast("string")))
    return rendered.withColumn("turns", turns).withColumn("loss_texts", texts)


def digests(rendered: DataFrame) -> DataFrame:
    """What a reader gets back from the formatted texts, one row per conversation."""
    back = read_turns(rendered)
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))
