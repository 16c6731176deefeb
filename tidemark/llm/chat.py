"""Operator 12: formatting of conversations by a state machine over roles, DataFrame functions only.

A ``Template`` states, as data, the marks around a turn of each role, the roles whose texts are
learned, and the moves of a finite-state machine: from each state, the roles that may speak next and
the state that leads to. Each conversation becomes one string, as a list of segments with a loss
flag each: opening mark, text, closing mark. Marks are never learned.

Control strings inside texts are escaped: the escape sign and each mark become the escape sign and a
letter, so an escaped text holds no mark and is read back without loss. ``Template`` makes sure that
no mark can begin inside another or arise where a text meets one.

A turn out of order does not stop the rest: the conversation is formatted whole, ``valid`` is false
and ``fault`` names the first turn (from 0) that the machine has no move for, or the number of turns
if it ends in a state in which it must not.

Texts are escaped and marked before the shuffle; a conversation is gathered into one row, because
one row is what training reads. Its size is that of one conversation.

Defined cases: a null text is empty; a null role counts as an empty one; turns are ordered by turn,
null first, then role and text; rows that are repeated are turns of their own; rows with a null id are
one conversation; an empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LETTERS = "abcdefghijklmnopqrstuvwxy"


@dataclass(frozen=True)
class Template:
    """marks: (opening, closing) by role; other: (opening, between, closing) of a turn of any other
    role, whose name stands before ``between``; learned: roles under the loss; moves: by state and
    role, the next state; ends: states in which a conversation may end; escape: the escape sign."""

    marks: Mapping[str, tuple[str, str]]
    other: tuple[str, str, str]
    learned: tuple[str, ...]
    moves: Mapping[str, Mapping[str, str]]
    ends: tuple[str, ...]
    begin: str = "start"
    escape: str = "\\"

    def __post_init__(self):
        controls, openings = self.controls(), self.openings()
        if len(controls) > len(_LETTERS) or len(set(openings)) < len(openings) or not all(controls) or len(self.escape) != 1:
            raise ValueError("openings differ, marks are not empty, 25 at most, and the escape sign is one character")
        firsts = {c[0] for c in controls}
        if any(firsts & set(c[1:]) or self.escape in c for c in controls):
            raise ValueError("no mark holds the escape sign, nor after its first character one that marks begin with")

    def openings(self) -> list[str]:
        return [*(first for first, _ in self.marks.values()), self.other[0]]

    def controls(self) -> list[str]:
        """All marks, the longer ones first, so that none is read as the beginning of another."""
        return sorted({m for pair in self.marks.values() for m in pair} | set(self.other), key=lambda m: (-len(m), m))


#: Roles alternate after an optional system turn. What a person asked last may stay unanswered.
ALTERNATING = Template(
    marks={"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")},
    other=("[ROLE]", "[/ROLE]", "</s>"),
    learned=("assistant",),
    moves={"start": {"system": "briefed", "user": "asked"}, "briefed": {"user": "asked"}, "asked": {"assistant": "answered"}, "answered": {"user": "asked"}},
    ends=("asked", "answered"),
)


def escaped(text: Column, template: Template) -> Column:
    out = F.replace(text, F.lit(template.escape), F.lit(f"{template.escape}z"))
    for letter, mark in zip(_LETTERS, template.controls(), strict=False):
        out = F.replace(out, F.lit(mark), F.lit(template.escape + letter))
    return out


def unescaped(text: Column, template: Template) -> Column:
    """Every escape sign has its letter after it, so the letters can be read one by one; the sign
    itself comes last."""
    out = text
    for letter, mark in zip(_LETTERS, template.controls(), strict=False):
        out = F.replace(out, F.lit(template.escape + letter), F.lit(mark))
    return F.replace(out, F.lit(f"{template.escape}z"), F.lit(template.escape))


def _by_role(role: Column, template: Template, of, otherwise: Column) -> Column:
    out = None
    for name, marks in template.marks.items():
        out = F.when(role == name, of(name, marks)) if out is None else out.when(role == name, of(name, marks))
    return otherwise if out is None else out.otherwise(otherwise)


def _segments(role: Column, text: Column, template: Template) -> Column:
    """The segments of one turn: (text, loss)."""
    part = lambda x, loss=False: F.struct(x.alias("text"), F.lit(loss).alias("loss"))
    first, between, last = template.other
    stranger = F.array(part(F.concat(F.lit(first), escaped(role, template), F.lit(between))), part(escaped(text, template)), part(F.lit(last)))
    return _by_role(role, template, lambda name, marks: F.array(part(F.lit(marks[0])), part(escaped(text, template), name in template.learned), part(F.lit(marks[1]))), stranger)


def _first_fault(roles: Column, template: Template) -> Column:
    """Number of the first turn without a move, or of all turns if the last state is no end; null if
    the conversation is well formed. The machine stays in its last state from a fault on."""
    moves = F.create_map(*[x for state, by in template.moves.items() for role, after in by.items() for x in (F.struct(F.lit(state).alias("state"), F.lit(role).alias("role")), F.lit(after))])

    def move(machine: Column, role: Column) -> Column:
        after = F.try_element_at(moves, F.struct(machine["state"].alias("state"), role.alias("role")))
        stuck = machine["stuck"] | after.isNull()
        return F.struct(F.when(stuck, machine["state"]).otherwise(after).alias("state"), stuck.alias("stuck"), (machine["at"] + F.when(stuck, 0).otherwise(1)).alias("at"))

    start = F.struct(F.lit(template.begin).alias("state"), F.lit(False).alias("stuck"), F.lit(0).alias("at"))
    over = lambda machine: F.when(machine["stuck"] | ~machine["state"].isin(*template.ends), machine["at"])
    return F.aggregate(roles, start, move, over)


def format_chats(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", template: Template = ALTERNATING) -> DataFrame:
    """One row per conversation: conv_id, valid, fault, segments (array of text and loss) and
    formatted, all segments in a row."""
    who, said = F.coalesce(df[role].cast("string"), F.lit("")), F.coalesce(df[text], F.lit(""))
    rows = df.select(df[conv].alias("conv_id"), F.struct(df[turn].alias("turn"), who.alias("role"), said.alias("said")).alias("at"))
    rows = rows.select("conv_id", F.struct("at.turn", "at.role", _segments(F.col("at.role"), F.col("at.said"), template).alias("segments")).alias("turn"))
    gathered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    fault = _first_fault(F.transform("turns", lambda t: t["role"]), template)
    placed = gathered.select("conv_id", fault.alias("fault"), F.flatten(F.transform("turns", lambda t: t["segments"])).alias("segments"))
    return placed.select("conv_id", F.col("fault").isNull().alias("valid"), "fault", "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))


def turns_of(formatted: Column, template: Template = ALTERNATING) -> Column:
    """The turns (role, text) that a formatted string holds."""
    opening = "|".join(re.escape(m) for m in sorted(template.openings(), key=len, reverse=True))
    closing = "|".join(re.escape(m) for m in sorted({*(last for _, last in template.marks.values()), template.other[2]}, key=len, reverse=True))
    found = F.regexp_extract_all(formatted, F.lit(f"(?s)(?:{opening}).*?(?:{closing})"), F.lit(0))

    def read(turn: Column) -> Column:
        inside = lambda first, last: F.substring(turn, F.lit(len(first) + 1), F.length(turn) - len(first) - len(last))
        pair = lambda name, body: F.struct(name.alias("role"), unescaped(body, template).alias("text"))
        first, between, last = template.other
        parts = F.split(inside(first, last), re.escape(between), 2)
        out = pair(unescaped(F.get(parts, 0), template), F.get(parts, 1))
        for name, marks in template.marks.items():
            out = F.when(F.startswith(turn, F.lit(marks[0])), pair(F.lit(name), inside(*marks))).otherwise(out)
        return out

    return F.transform(found, read)


def learned_text(segments: Column, template: Template = ALTERNATING) -> Column:
    """The text under the loss, in order, as it was before escaping."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"], template)), "")


def read_back(formatted: DataFrame, template: Template = ALTERNATING) -> DataFrame:
    """What the rows of ``format_chats`` hold, as digests and lengths."""
    spoken = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    read = formatted.select("conv_id", "valid", "fault", turns_of(F.col("formatted"), template).alias("turns"), learned_text(F.col("segments"), template).alias("learned"), F.length("formatted").cast("long").alias("formatted_chars"))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(F.transform("turns", spoken), ""), 256).alias("turns_sha256"), F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"), "formatted_chars", "valid", F.col("fault").cast("long").alias("fault"),
    )
