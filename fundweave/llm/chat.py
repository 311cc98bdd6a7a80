"""Chat formatting: turns of a conversation to one text, with a loss flag for every segment.

A `Template` declares the marks around a turn, the roles under the loss and a finite-state machine
over roles. The machine walks a conversation's turns; a role without a transition puts it into the
error state, which it does not leave. Such conversations are formatted too and flagged, so that the
caller decides.

Escapes. Inside a text the template's own strings cannot occur. A backslash becomes a pair of backslash
and letter, so does the first character of every end mark and header mark, and in roles the first
character of the colon; the pairs' letters are ones that the template's strings do not have (`b`, `l`,
`h`, `c` with the default one). Every backslash of an escaped text begins such a pair, so they are undone
one kind at a time, the backslash's own last. A template whose strings could not be told apart from
text is refused.

All of it is DataFrame expressions. The turns of one conversation become one row, because its
formatted text is one value; that value's size is what bounds a row, however many rows the table has.

Defined cases: null texts and roles read as empty; turns are ordered by turn (null first), then role
and text, so ties and repeated rows have one order; a null conv_id is a conversation of its own; an
empty table gives an empty result; columns that are not named are not read.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, whole

ERROR = "error"


@dataclass(frozen=True)
class Template:
    """`header` goes before the role, `colon` after it, `end` after the text."""

    header: str = "### "
    colon: str = ": "
    end: str = "</turn>\n"
    start: str = "start"
    #: state -> role -> next state
    moves: Mapping[str, Mapping[str, str]] = field(
        default_factory=lambda: {
            "start": {"system": "system", "user": "user"},
            "system": {"user": "user"},
            "user": {"assistant": "assistant"},
            "assistant": {"user": "user"},
        }
    )
    #: States in which a conversation is complete.
    accept: tuple[str, ...] = ("assistant",)
    loss_roles: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        for name in ("header", "colon", "end"):
            mark = getattr(self, name)
            if not mark or "\\" in mark:
                raise ValueError(f"{name} needs a character and no backslash")
        # With such an end mark, the end of a text and the mark's beginning could make a mark too early.
        if any(self.end[:n] == self.end[-n:] for n in range(1, len(self.end))):
            raise ValueError("the end mark must not begin as it ends")

    def escapes(self, role: bool = False) -> list[tuple[str, str, str]]:
        """(plain character, what must follow it, letter of its pair), the backslash's first."""
        used = set(self.header + self.colon + self.end)
        letters = [c for c in "blhc" + "adefgijkmnopqrstuvwxyz" if c not in used]
        end, header, colon = (mark.strip() or mark for mark in (self.end, self.header, self.colon))
        found = [("\\", "", letters[0]), (end[0], end[1:], letters[1]), (header[0], header[1:], letters[2])]
        return [*found, (colon[0], "", letters[3])] if role else found


DEFAULT = Template()


def _escaped(text: Column, pairs: list[tuple[str, str, str]]) -> Column:
    for plain, then, letter in pairs:
        if then:
            ahead = f"{re.escape(plain)}(?={re.escape(then)})"
            text = F.regexp_replace(text, ahead, f"\\\\{letter}")
        else:
            text = F.replace(text, F.lit(plain), F.lit(f"\\{letter}"))
    return text


def _plain(text: Column, pairs: list[tuple[str, str, str]]) -> Column:
    for plain, _, letter in reversed(pairs):
        text = F.replace(text, F.lit(f"\\{letter}"), F.lit(plain))
    return text


def escape(text: Column, template: Template = DEFAULT) -> Column:
    return _escaped(text, template.escapes())


def unescape(text: Column, template: Template = DEFAULT) -> Column:
    return _plain(text, template.escapes())


def escape_role(role: Column, template: Template = DEFAULT) -> Column:
    return _escaped(role, template.escapes(role=True))


def unescape_role(role: Column, template: Template = DEFAULT) -> Column:
    return _plain(role, template.escapes(role=True))


def step(template: Template, state: Column, role: Column) -> Column:
    """The machine's next state."""
    out = F.lit(ERROR)
    for at, by_role in template.moves.items():
        for name, to in by_role.items():
            out = F.when((state == at) & (role == name), F.lit(to)).otherwise(out)
    return out


def formatted(
    df: DataFrame,
    template: Template = DEFAULT,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, segments (text, loss; in order, their
    concatenation is `formatted`), state (the machine's last), valid, complete, bad_turn (place of
    the first turn out of order, from 0, or null)."""
    turns = df.select(
        col(conv).alias("conv_id"),
        F.struct(
            col(turn).alias("turn"), whole(col(role)).alias("role"), whole(col(text)).alias("text")
        ).alias("t"),
    )
    whole_conv = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def segments(t: Column) -> Column:
        head = F.concat(F.lit(template.header), escape_role(t["role"], template), F.lit(template.colon))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(
                escape(t["text"], template).alias("text"), t["role"].isin(*template.loss_roles).alias("loss")
            ),
            F.struct(F.lit(template.end).alias("text"), F.lit(False).alias("loss")),
        )

    walk = F.aggregate(
        "turns",
        F.struct(
            F.lit(template.start).alias("state"),
            F.lit(0).alias("place"),
            F.lit(None).cast("int").alias("bad"),
        ),
        lambda a, t: F.struct(
            step(template, a["state"], t["role"]).alias("state"),
            (a["place"] + 1).alias("place"),
            F.when(
                a["bad"].isNull() & (step(template, a["state"], t["role"]) == ERROR), a["place"]
            )
            .otherwise(a["bad"])
            .alias("bad"),
        ),
    )
    out = whole_conv.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.flatten(F.transform("turns", segments)).alias("segments"),
        walk.alias("walk"),
    )
    return out.select(
        "conv_id",
        "n_turns",
        F.concat_ws("", F.transform("segments", lambda s: s["text"])).alias("formatted"),
        "segments",
        F.col("walk.state").alias("state"),
        F.col("walk.bad").isNull().alias("valid"),
        F.col("walk.state").isin(*template.accept).alias("complete"),
        F.col("walk.bad").alias("bad_turn"),
    )


def read_turns(text: Column, template: Template = DEFAULT) -> Column:
    """array<struct<role, text>> of a formatted text: the inverse of the formatting."""
    parts = F.split(text, re.escape(template.end))  # ends with an empty part after the last mark
    turns = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))

    def parse(x: Column) -> Column:
        role = F.substring_index(F.substr(x, F.lit(len(template.header) + 1)), template.colon, 1)
        body = F.substr(x, F.length(role) + len(template.header) + len(template.colon) + 1)
        return F.struct(unescape_role(role, template).alias("role"), unescape(body, template).alias("text"))

    return F.transform(turns, parse)


def loss_text(segments: Column, template: Template = DEFAULT) -> Column:
    """All text under the loss mask, unescaped, in order."""
    under = F.filter(segments, lambda s: s["loss"])
    return F.concat_ws("", F.transform(under, lambda s: unescape(s["text"], template)))
