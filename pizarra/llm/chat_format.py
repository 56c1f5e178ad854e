"""Chat formatting: a finite-state machine over roles and a declarative template.

DataFrame functions only.  A conversation's turns, by turn number, run through the
machine's transition table, which says whether their order is valid.  The template
turns them into text segments with a loss flag each; joined, they are the training
text.  Control strings inside texts get an escape character after their first
character, so every control string in the output is a mark of the template and the
turns can be read back from the output alone.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pizarra.llm.common import col

ESCAPE = "\\"
START, INVALID = "start", "invalid"


@dataclass(frozen=True)
class Turn:
    """How the turns of one role are marked, and whether their text is trained on."""
    begin: str
    end: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """``roles`` by name; turns of other roles are ``other[0] role other[1] text other[2]``,
    without loss.  ``moves[state][role]`` is the next state (a missing one is invalid for good);
    a conversation may stop in the states of ``stops``."""
    roles: dict[str, Turn]
    other: tuple[str, str, str]
    moves: dict[str, dict[str, str]]
    stops: tuple[str, ...]
    controls: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        marks = [m for t in self.roles.values() for m in (t.begin, t.end)] + list(self.other)
        ends = [t.end for t in self.roles.values()] + [self.other[2]]
        if len(set(marks)) != len(marks) or any(len(m) < 2 or ESCAPE in m for m in marks):
            raise ValueError("control strings must differ, have two characters or more and be free of the escape character")
        for a in marks:
            for b in marks:
                # no control string may begin inside another: then none can arise where texts and marks meet
                if any(b.startswith(a[i:]) or a[i:].startswith(b) for i in range(1, len(a))):
                    raise ValueError(f"control strings {a!r} and {b!r} overlap")
        if INVALID in self.moves or not ends:
            raise ValueError(f"{INVALID!r} is no state of a template")
        object.__setattr__(self, "controls", tuple(marks))


TEMPLATE = Template(
    roles={
        "system": Turn("<<SYS>>", "<</SYS>>"),
        "user": Turn("[INST]", "[/INST]"),
        "assistant": Turn("<s>", "</s>", loss=True),
    },
    other=("<<ROLE>>", "<<TEXT>>", "<</ROLE>>"),
    moves={
        START: {"system": "told", "user": "asked"},
        "told": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked"},
    },
    stops=("answered",),
)


def escaped(text: Column, template: Template = TEMPLATE) -> Column:
    out = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    for c in template.controls:
        out = F.replace(out, F.lit(c), F.lit(c[0] + ESCAPE + c[1:]))
    return out


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _final_state(turns: Column, template: Template) -> Column:
    """The machine's run: ``struct(state, bad)``, ``bad`` the number of turns before the first invalid one."""
    moves = F.create_map(*[F.lit(x) for s, to in template.moves.items() for r, nxt in to.items() for x in (f"{s}>{r}", nxt)])
    step = F.aggregate(
        turns, F.struct(F.lit(START).alias("state"), F.lit(0).cast("int").alias("seen")),
        lambda acc, t: F.struct(
            F.coalesce(F.try_element_at(moves, F.concat(acc["state"], F.lit(">"), t["role"])), F.lit(INVALID)).alias("state"),
            (acc["seen"] + F.when(acc["state"] == INVALID, 0).otherwise(1)).cast("int").alias("seen")))
    return step


def _segments(t: Column, template: Template) -> Column:
    def seg(text: Column, loss: bool) -> Column:
        return F.struct(text.alias("text"), F.lit(loss).alias("loss"))

    text, out = escaped(t["text"], template), None
    for role, turn in template.roles.items():
        parts = F.array(seg(F.lit(turn.begin), False), seg(text, turn.loss), seg(F.lit(turn.end), False))
        out = F.when(t["role"] == role, parts) if out is None else out.when(t["role"] == role, parts)
    a, b, c = template.other
    other = F.array(seg(F.concat(F.lit(a), escaped(t["role"], template), F.lit(b)), False), seg(text, False), seg(F.lit(c), False))
    return other if out is None else out.otherwise(other)


def format_conversations(convs: DataFrame, template: Template = TEMPLATE, id_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per conversation: ``conv_id, valid, bad_turn, segments, formatted``.

    ``segments`` is an array of ``struct(text, loss)`` and ``formatted`` its texts
    joined.  ``valid``: the machine accepts the order of the roles; ``bad_turn`` is the
    0-based place of the first turn it doesn't (null: none; a conversation that only
    stops too early has none either).  Invalid conversations are formatted like the others.

    Turns go by number (nulls first); equal numbers by role, then text, in byte order, and
    repeated rows stay repeated.  A null text or role is an empty one.  Rows without a
    conversation id are one conversation without id.  Only the four columns are
    read.  An empty table gives no rows.  A conversation is one row of the result, so it has to fit
    into one; its turns are gathered in each map task before they move.
    """
    # an absent turn number sorts first: array_sort would put a null field's struct by its other fields
    turn = F.struct(F.coalesce(col(turn_col).cast("long"), F.lit(-(1 << 63))).alias("turn"),
                    F.coalesce(col(role_col).cast("string"), F.lit("")).alias("role"),
                    F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    grouped = convs.select(col(id_col).cast("long").alias("conv_id"), turn.alias("t")).groupBy("conv_id").agg(
        F.array_sort(F.collect_list("t")).alias("turns"))
    run = grouped.withColumn("_end", _final_state(F.col("turns"), template)).withColumn(
        "segments", F.flatten(F.transform("turns", lambda t: _segments(t, template))))
    return run.select(
        "conv_id", F.col("_end.state").isin(*template.stops).alias("valid"),
        F.when(F.col("_end.state") == INVALID, F.col("_end.seen") - 1).alias("bad_turn"),
        "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))


def read_turns(formatted: Column, template: Template = TEMPLATE) -> Column:
    """The turns ``array<struct(role, text)>`` that a formatted text holds."""
    ends = [t.end for t in template.roles.values()] + [template.other[2]]
    pieces = F.split(formatted, "(?<=" + "|".join(re.escape(e) for e in ends) + ")", -1)
    a, b, c = template.other

    def turn(p: Column) -> Column:
        def inner(begin: str, end: str) -> Column:
            return F.substring(p, F.lit(len(begin) + 1), F.char_length(p) - len(begin) - len(end))

        split = F.split(inner(a, c), re.escape(b), 2)
        out = None
        for role, t in template.roles.items():
            is_role = F.startswith(p, F.lit(t.begin))
            got = F.struct(F.lit(role).alias("role"), unescaped(inner(t.begin, t.end)).alias("text"))
            out = F.when(is_role, got) if out is None else out.when(is_role, got)
        other = F.struct(unescaped(split[0]).alias("role"), unescaped(split[1]).alias("text"))
        return other if out is None else out.otherwise(other)

    return F.transform(F.filter(pieces, lambda p: p != ""), turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")


def chat_report(convs: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Per conversation, read back from the formatted output: number and digest of its
    turns, length and digest of the text under the loss mask, length of the formatted text."""
    out = format_conversations(convs, template).withColumn("turns", read_turns(F.col("formatted"), template)).withColumn(
        "trained", loss_text(F.col("segments")))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("trained").cast("long").alias("loss_chars"), F.sha2(F.col("trained").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "valid")


def with_probe(convs: DataFrame, spark: SparkSession) -> DataFrame:
    """``convs`` and conversation -7, both of whose texts are made of control strings."""
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return convs.select("conv_id", "turn", "role", "text").unionByName(probe)
