"""Chat formatting: a finite-state machine over roles and a declarative template.

Native DataFrame functions only. A conversation is one row of text segments,
each with a loss flag. The control strings of the template never occur inside
a formatted text: one that does in the input gets a backslash after its first
character (one more, if it has some already), which ``parse_chat`` takes out
again, so the turns can be read back exactly from the formatted text.

Defined results: a NULL text is an empty text, a NULL role an empty role; rows
with equal turn numbers (repeated rows too) are turns of their own, ordered by
role and text, a NULL turn number first; a NULL conversation id is one
conversation; an empty table gives no rows; further columns are ignored. A
conversation whose roles the machine rejects is formatted all the same, with
``valid`` false and ``first_bad`` the place (from 0) of the first role that has
no transition, or the number of turns if only the end is not accepted.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    """What stands before and after a text of a role, and whether the text is trained on."""

    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class ChatTemplate:
    """Turns by role, the frame of any other role, the transitions and the accepted last roles."""

    turns: dict[str, Turn]
    other: tuple[str, str, str]
    controls: tuple[str, ...]
    moves: dict[str, tuple[str, ...]] = field(default_factory=dict)
    ends: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        site = re.compile(self.escape_pattern)
        if any(site.search(c, 1) for c in self.controls):
            raise ValueError("a control string may not contain another one behind its first character")
        for turn in [*self.turns.values(), Turn(*self.other[::2])]:
            if not site.search(turn.before) or not site.search(turn.after):
                raise ValueError("what stands before and after a text needs a control string")

    @property
    def escape_pattern(self) -> str:
        firsts = "".join(sorted({re.escape(c[0]) for c in self.controls}))
        return rf"([{firsts}])(\\*)({'|'.join(re.escape(c[1:]) for c in self.controls)})"

    @property
    def unescape_pattern(self) -> str:
        return self.escape_pattern.replace(r"(\\*)", r"\\(\\*)", 1)

    @property
    def turn_pattern(self) -> str:
        """One formatted turn; the texts hold no control strings, so the shortest match is the turn."""
        frames = [f"{re.escape(t.before)}.*?{re.escape(t.after)}" for t in self.turns.values()]
        return "(?s)" + "|".join([*frames, ".*?".join(map(re.escape, self.other))])


INSTRUCT = ChatTemplate(
    turns={
        "system": Turn("<<SYS>>\n", "\n<</SYS>>\n\n"),
        "user": Turn("[INST] ", " [/INST]"),
        "assistant": Turn("<s> ", " </s>\n", loss=True),
    },
    other=("[ROLE]", "[:ROLE]", "[/ROLE]\n"),
    controls=("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[:ROLE]", "[/ROLE]"),
    moves={"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    ends=("assistant",),
)


def escape(text: Column, template: ChatTemplate = INSTRUCT) -> Column:
    """A text without control strings; ``unescape`` gives the text back."""
    return F.regexp_replace(text, template.escape_pattern, r"$1\\$2$3")


def unescape(text: Column, template: ChatTemplate = INSTRUCT) -> Column:
    return F.regexp_replace(text, template.unescape_pattern, "$1$2$3")


def _walk(roles: Column, template: ChatTemplate) -> Column:
    """(state, place, first_bad) after the roles; the state stays where a role has no transition."""
    moves = F.create_map(*[F.lit(x) for a, bs in template.moves.items() for b in bs for x in (f"{a}>{b}", b)])
    start = F.struct(F.lit("").alias("state"), F.lit(0).alias("at"), F.lit(-1).alias("bad"))

    def step(acc: Column, role: Column) -> Column:
        to = F.try_element_at(moves, F.concat(acc["state"], F.lit(">"), role))
        return F.struct(F.when(acc["bad"] < 0, F.coalesce(to, acc["state"])).otherwise(acc["state"]).alias("state"),
                        (acc["at"] + 1).alias("at"),
                        F.when((acc["bad"] < 0) & to.isNull(), acc["at"]).otherwise(acc["bad"]).alias("bad"))

    return F.aggregate(roles, start, step)


def _segments(turn: Column, template: ChatTemplate) -> Column:
    """Before, text and after of one turn as segments with loss flags."""
    def seg(text: Column, loss: bool) -> Column:
        return F.struct(text.alias("text"), F.lit(loss).alias("loss"))

    text = escape(turn["text"], template)
    a, b, c = template.other
    out = F.array(seg(F.concat(F.lit(a), escape(turn["role"], template), F.lit(b)), False), seg(text, False), seg(F.lit(c), False))
    for role, t in template.turns.items():
        out = F.when(turn["role"] == role, F.array(seg(F.lit(t.before), False), seg(text, t.loss), seg(F.lit(t.after), False))).otherwise(out)
    return out


def format_chat(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                template: ChatTemplate = INSTRUCT) -> DataFrame:
    """One row per conversation: id, ``segments`` (text, loss), ``formatted``, ``valid``, ``first_bad``.

    A conversation is the unit of the output, like a document: its rows meet in
    one row, in the order of their turns. The number of conversations, not
    their length, is what spreads over tasks.
    """
    rows = df.select(F.col(conv).alias("conv"), F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text")).alias("t"))
    got = rows.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    got = got.select("conv", _walk(F.col("turns.role"), template).alias("end"), F.flatten(
        F.transform("turns", lambda t: _segments(t, template))).alias("segments"))
    bad = (F.when(F.col("end.bad") >= 0, F.col("end.bad"))
           .when(~F.col("end.state").isin(*template.ends), F.col("end.at")))
    return got.select(F.col("conv").alias(conv), "segments", F.concat_ws("", "segments.text").alias("formatted"),
                      bad.isNull().alias("valid"), bad.alias("first_bad"))


def parse_chat(formatted: Column, template: ChatTemplate = INSTRUCT) -> Column:
    """The turns (role, text) read back from a formatted text."""
    def inner(chunk: Column, before: str, after: str) -> Column:
        return F.substring(chunk, F.lit(len(before) + 1), F.length(chunk) - len(before) - len(after))

    def turn(role: Column, text: Column) -> Column:
        return F.struct(unescape(role, template).alias("role"), unescape(text, template).alias("text"))

    def read(chunk: Column) -> Column:
        a, b, c = template.other
        body = inner(chunk, a, c)
        out = turn(F.substring_index(body, b, 1), F.substring(body, F.locate(b, body) + len(b), F.length(body)))
        for role, t in template.turns.items():
            out = F.when(chunk.startswith(t.before), turn(F.lit(role), inner(chunk, t.before, t.after))).otherwise(out)
        return out

    return F.transform(F.regexp_extract_all(formatted, F.lit(template.turn_pattern), F.lit(0)), read)


def loss_text(segments: Column, template: ChatTemplate = INSTRUCT) -> Column:
    """The texts under the loss mask, one after the other, as they were given."""
    kept = F.filter(segments, lambda s: s["loss"])
    return F.concat_ws("", F.transform(kept, lambda s: unescape(s["text"], template)))
