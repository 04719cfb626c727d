"""Conversations folded from event logs and rendered with a loss mask (DataFrame functions only)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
# Strings that training or serving code reads as marks; inside a text their first character is escaped.
CONTROL = ("<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]")
_ENTITY = {"<": "&lt;", "[": "&#91;", "\n": "&#10;"}


def escape(text: Column) -> Column:
    """Replace what could be taken for a mark.  Only marks and the escapes themselves change."""
    pairs = [(e, "&amp;" + e[1:]) for e in ("&amp;", *_ENTITY.values())]
    pairs += [(c, _ENTITY[c[0]] + c[1:]) for c in CONTROL]
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), pairs, text)


def unescape(text: Column) -> Column:
    pairs = [(e, c) for c, e in _ENTITY.items()] + [("&amp;", "&")]
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), pairs, text)


def fold_events(log: DataFrame) -> DataFrame:
    """The final messages of an event log ``conv_id, message, seq, kind, role, text``.

    Kinds: ``delta`` appends its text, ``edit`` replaces the message by its
    text, ``regenerate`` empties it so that later deltas write it anew.  Events
    of a message are applied by ``seq``; equal ``seq`` by kind, then text.  An
    event delivered twice (all columns equal) counts once.  A missing text is
    empty; an unknown or missing kind changes nothing.  The role is that of the
    last event that names one; a message without one has role "".  A message
    whose events leave no text stays, with an empty text.  ``message`` is any
    sortable column, missing ones first.

    One row per event and one group per message: what meets in a task is one
    message, whose text has to fit there anyway, not a conversation.
    """
    event = F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text"), "role")
    kept = (
        log.select("conv_id", "message", event.alias("_event"))
        .groupBy("conv_id", "message")
        .agg(F.sort_array(F.collect_set("_event")).alias("_events"))
    )
    known = F.filter("_events", lambda e: e["kind"].isin("delta", "edit", "regenerate"))
    # Position of the last event that discards what came before, 0 if there is none.
    reset = F.coalesce(
        F.array_max(F.transform("_known", lambda e, i: F.when(e["kind"] != "delta", i + 1).otherwise(0))), F.lit(0)
    )
    text = F.array_join(
        F.transform(
            F.filter("_known", lambda e, i: i + 1 >= F.col("_reset")),
            lambda e: F.when(e["kind"] == "regenerate", F.lit("")).otherwise(e["text"]),
        ),
        "",
    )
    role = F.coalesce(
        F.try_element_at(F.filter(F.transform("_events", lambda e: e["role"]), lambda r: r.isNotNull()), F.lit(-1)), F.lit("")
    )
    return (
        kept.withColumn("_known", known)
        .withColumn("_reset", reset)
        .select("conv_id", "message", F.when(F.size("_events") > 0, role).otherwise("").alias("role"), text.alias("text"))
    )


def render(messages: DataFrame, learn: str = "assistant") -> DataFrame:
    """One text per conversation with the spans a model should learn.

    ``messages``: ``conv_id, message, role, text``.  A turn is
    ``<|im_start|>role\\ntext<|im_end|>\\n``.  Marks inside roles and texts are
    escaped, line feeds in roles too, so the text can be read back exactly.
    Messages of equal number are ordered by role, then text.  ``loss_spans``
    are half-open ranges of code points of ``formatted``: the texts of the
    ``learn`` role, one per turn, empty ones included.

    The text of a conversation is one value, so a conversation has to fit in a
    task; its offsets come from a window, not from repeated concatenation.
    """
    head = F.concat(F.lit(OPEN), F.replace(escape(F.coalesce("role", F.lit(""))), F.lit("\n"), F.lit("&#10;")), F.lit("\n"))
    turns = messages.select(
        "conv_id", "message", "role", "text", head.alias("_head"), escape(F.coalesce("text", F.lit(""))).alias("_body")
    )
    order = Window.partitionBy("conv_id").orderBy("message", "role", "text")
    size = F.length("_head") + F.length("_body") + len(CLOSE)
    placed = turns.select(
        "conv_id",
        F.row_number().over(order).alias("_n"),
        (F.sum(size.cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - len(CLOSE)).alias("_end"),
        F.length("_body").cast("long").alias("_size"),
        F.col("role").eqNullSafe(learn).alias("_learn"),
        F.concat("_head", "_body", F.lit(CLOSE)).alias("_turn"),
    )
    grouped = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("_n", "_turn", "_end", "_size", "_learn"))).alias("_turns")
    )
    spans = F.transform(
        F.filter("_turns", lambda t: t["_learn"]),
        lambda t: F.struct((t["_end"] - t["_size"]).alias("start"), t["_end"].alias("end")),
    )
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("_turns", lambda t: t["_turn"]), "").alias("formatted"),
        spans.alias("loss_spans"),
    )


def read_back(rendered: DataFrame) -> DataFrame:
    """The turns and learned texts of ``render``, read from its output alone.

    Adds ``turns`` (array of role and text) and ``loss_texts``.
    """
    parts = F.filter(F.split("formatted", r"<\|im_start\|>"), lambda _, i: i > 0)
    line = lambda t: F.instr(t, "\n")
    turn = lambda t: F.struct(
        unescape(F.substring(t, F.lit(1), line(t) - 1)).alias("role"),
        unescape(F.substring(t, line(t) + 1, F.length(t) - line(t) - len(CLOSE))).alias("text"),
    )
    learned = F.transform(
        "loss_spans",
        lambda s: unescape(F.substring("formatted", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))),
    )
    return rendered.withColumn("turns", F.transform(parts, turn)).withColumn("loss_texts", learned)


def turns_to_log(turns: DataFrame) -> DataFrame:
    """An event log that folds back to ``turns`` (``conv_id, turn, role, text``).

    User turns arrive as half a text and an edit to the whole; assistant turns
    as a discarded draft, a regeneration, and two deltas; others as two deltas.
    Rows with equal conversation and turn become messages of their own, ordered
    by role and text.
    """
    again = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    text = F.coalesce("text", F.lit(""))
    half = F.floor(F.length(text) / 2).cast("int")
    left = F.substring(text, F.lit(1), half)
    right = F.substring(text, half + 1, F.length(text))
    event = lambda seq, kind, t: F.struct(
        F.lit(seq).alias("seq"), F.lit(kind).alias("kind"), F.col("role").alias("role"), t.alias("text")
    )
    deltas = [event(4, "delta", left), event(5, "delta", right)]
    events = (
        F.when(F.col("role") == "user", F.array(event(1, "delta", left), event(2, "edit", text)))
        .when(
            F.col("role") == "assistant",
            F.array(event(1, "delta", right), event(2, "regenerate", F.lit("")), *deltas),
        )
        .otherwise(F.array(*deltas))
    )
    log = turns.withColumn("message", F.struct("turn", again.alias("again")))
    return log.select("conv_id", "message", F.explode(events).alias("_e")).select("conv_id", "message", "_e.*")
