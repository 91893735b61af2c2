"""Chat formatting: a declarative template, a state machine over roles, and loss flags."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """How a conversation is written, learned from and checked.

    A turn is ``open + role + after_role + text + close``. ``open`` and ``close`` are control
    strings; inside a text a backslash goes after their first character, so they never occur
    there. Roles are percent-encoded. ``learn`` names the roles whose texts carry the loss.
    ``moves`` are the allowed (state, role, next state); ``ends`` the states to stop in.
    """

    open: str = "### "
    after_role: str = ":\n"
    close: str = "</turn>\n"
    learn: tuple[str, ...] = ("assistant",)
    start: str = "start"
    moves: tuple[tuple[str, str, str], ...] = (
        ("start", "system", "ready"),
        ("start", "user", "asked"),
        ("ready", "user", "asked"),
        ("asked", "assistant", "answered"),
        ("answered", "user", "asked"),
    )
    ends: tuple[str, ...] = ("answered",)

    def controls(self) -> list[str]:
        return [self.open.rstrip("\n"), self.close.rstrip("\n")]


TEMPLATE = ChatTemplate()


def escape(text: Column, template: ChatTemplate = TEMPLATE) -> Column:
    """Put a backslash into every control string, and one more into those that have some."""
    for c in template.controls():
        pattern = f"({re.escape(c[0])})(\\\\*)({re.escape(c[1:])})"
        text = F.regexp_replace(text, pattern, r"$1\\$2$3")
    return text


def unescape(text: Column, template: ChatTemplate = TEMPLATE) -> Column:
    """Undo ``escape``."""
    for c in template.controls():
        pattern = f"({re.escape(c[0])})\\\\(\\\\*)({re.escape(c[1:])})"
        text = F.regexp_replace(text, pattern, "$1$2$3")
    return text


def _walk(roles: Column, template: ChatTemplate) -> Column:
    """The state after the roles, and the number of the first turn out of order."""
    table = F.create_map(
        *(F.lit(x) for state, role, after in template.moves for x in (f"{state}\n{role}", after))
    )

    def step(seen: Column, role: Column) -> Column:
        after = table[F.concat(seen["state"], F.lit("\n"), F.coalesce(role, F.lit("")))]
        return F.struct(
            F.coalesce(after, F.lit("")).alias("state"),
            (seen["n"] + 1).alias("n"),
            F.when(seen["bad"].isNull() & after.isNull(), seen["n"])
            .otherwise(seen["bad"])
            .alias("bad"),
        )

    first = F.struct(
        F.lit(template.start).alias("state"),
        F.lit(0).alias("n"),
        F.lit(None).cast("int").alias("bad"),
    )
    return F.aggregate(roles, first, step)


def chat_segments(turns: DataFrame, template: ChatTemplate = TEMPLATE) -> DataFrame:
    """Conversations (``conv_id, turn, role, text``) as segments to train on.

    Returns ``conv_id, seg_no, turn_no, role, text, loss, valid, first_bad_turn``: three segments
    per turn (marker, escaped text, end), numbered through the conversation; their texts in order
    are the formatted conversation. ``loss`` is true for the texts of learned roles alone.
    ``valid`` says whether the roles follow the template's state machine to one of its ends;
    ``first_bad_turn`` is the 0-based place of the first turn that no move allows. Conversations
    out of order are marked, not dropped.

    Turns are ordered by turn (nulls first), then role, then text; repeated rows are turns of
    their own. Null roles and texts count as empty, rows with a null conv_id are one conversation,
    and an empty table gives no segments. Other columns are ignored.
    """
    empty = F.lit("")
    gathered = (
        turns.select(
            "conv_id",
            F.struct(
                F.col("turn"),
                F.coalesce(F.col("role"), empty).alias("role"),
                F.coalesce(F.col("text"), empty).alias("text"),
            ).alias("_turn"),
        )
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list("_turn")).alias("_turns"))
        .withColumn("_end", _walk(F.col("_turns.role"), template))
    )
    each = gathered.select(
        "conv_id",
        (F.col("_end.bad").isNull() & F.col("_end.state").isin(*template.ends)).alias("valid"),
        F.col("_end.bad").alias("first_bad_turn"),
        F.posexplode("_turns").alias("turn_no", "_turn"),
    )
    role, text = F.col("_turn.role"), F.col("_turn.text")
    mark = F.concat(F.lit(template.open), F.url_encode(role), F.lit(template.after_role))

    def segment(n: int, content: Column, loss: Column) -> Column:
        number = (F.col("turn_no") * 3 + n).alias("seg_no")
        return F.struct(number, content.alias("text"), loss.alias("loss"))

    parts = F.array(
        segment(0, mark, F.lit(False)),
        segment(1, escape(text, template), role.isin(*template.learn)),
        segment(2, F.lit(template.close), F.lit(False)),
    )
    return each.select("*", F.explode(parts).alias("_part")).select(
        "conv_id",
        "_part.seg_no",
        "turn_no",
        role.alias("role"),
        "_part.text",
        "_part.loss",
        "valid",
        "first_bad_turn",
    )


def formatted_chats(segments: DataFrame) -> DataFrame:
    """Segments joined: ``conv_id, formatted, learned`` (the segments under the loss, in order)."""
    parts = F.array_sort(F.collect_list(F.struct("seg_no", "text", "loss")))
    return (
        segments.groupBy("conv_id")
        .agg(parts.alias("_parts"))
        .select(
            "conv_id",
            F.array_join("_parts.text", "").alias("formatted"),
            F.filter("_parts", lambda p: p["loss"])["text"].alias("learned"),
        )
    )


def parse_chat(formatted: Column, template: ChatTemplate = TEMPLATE) -> Column:
    """The turns (role, text) of a formatted conversation."""
    pieces = F.split(formatted, re.escape(template.open))
    after = len(template.after_role)

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, template.after_role, 1)
        last = F.length(piece) - F.length(role) - after - len(template.close)
        body = F.substr(piece, F.length(role) + after + 1, last)
        return F.struct(F.url_decode(role).alias("role"), unescape(body, template).alias("text"))

    return F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), turn)
