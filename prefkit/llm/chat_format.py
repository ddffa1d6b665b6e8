r"""Chat formatting by a finite-state machine over roles.

A ``Template`` declares, per role, the text that opens a turn, whether the turn's text counts in the
loss, and after which states the role may follow. The machine walks each conversation's turns in
order: a legal role moves it to that role's state, an illegal one is counted and restarts the machine
there (a role that the template does not know is counted and leaves the state alone). Each turn emits
three segments, its opening, its text and its closing, with a loss flag each; the formatted text is
the segments joined.

Texts cannot fake a turn: the escape character is doubled, and every control string of the template
(what opens or closes turns) is broken by an escape behind its first character, so none occurs inside
an escaped text; ``unescape`` drops an escape before any character. ``read_turns`` parses a formatted
text back into its turns.

Only built-in DataFrame functions are used. A conversation is one training example and hence one row;
the exchange is one grouping by conversation.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START = "start"


@dataclass(frozen=True)
class Turn:
    """How turns of ``role`` are written: what opens them, the states that they may follow, and whether
    their text counts in the loss."""

    role: str
    opens: str
    after: tuple[str, ...]
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """A chat format. Turns of roles without an entry open with ``other``, the escaped role and
    ``other_end``. ``ends`` are the states in which a conversation may end."""

    turns: tuple[Turn, ...]
    closes: str
    ends: tuple[str, ...]
    other: str = "### Role "
    other_end: str = "</role>"
    escape: str = "\\"

    def __post_init__(self):
        marks = self.controls
        if len(self.escape) != 1 or any(len(m) < 2 or self.escape in m for m in marks):
            raise ValueError("control strings have two characters or more, none of them the escape")
        for a in marks:
            for b in marks:
                if any(b.startswith(a[-n:]) for n in range(1, min(len(a), len(b)) + (a != b))):
                    raise ValueError(f"the end of {a!r} may begin {b!r}: occurrences could overlap")

    @property
    def controls(self) -> tuple[str, ...]:
        """The strings that mark turns; an opening counts without its trailing white space."""
        found = [t.opens.rstrip() for t in self.turns] + [self.other.rstrip(), self.other_end.rstrip(), self.closes.rstrip()]
        return tuple(dict.fromkeys(found))


#: Titled turns; the assistant's texts count in the loss.
TITLED = Template(
    turns=(
        Turn("system", "### System: ", after=(START,)),
        Turn("user", "### User: ", after=(START, "system", "assistant")),
        Turn("assistant", "### Assistant: ", after=("user",), loss=True),
    ),
    closes="</turn>\n",
    ends=("assistant",),
)


def escape(text: Column, template: Template) -> Column:
    """``text`` with escapes doubled and all control strings broken."""
    e = template.escape
    text = F.replace(text, F.lit(e), F.lit(e + e))
    for mark in template.controls:
        text = F.replace(text, F.lit(mark), F.lit(mark[0] + e + mark[1:]))
    return text


def unescape(text: Column, template: Template) -> Column:
    """The text that ``escape`` was given."""
    return F.regexp_replace(text, f"(?s){re.escape(template.escape)}(.)", "$1")


def _opening(role: Column, template: Template) -> Column:
    out = F.concat(F.lit(template.other), escape(role, template), F.lit(template.other_end))
    for t in template.turns:
        out = F.when(role == t.role, t.opens).otherwise(out)
    return out


def segments(turns: Column, template: Template) -> Column:
    """The segments (``text``, ``loss``) of an array of (``role``, ``text``) turns."""

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def emitted(t: Column) -> Column:
        counts = t["role"].isin([x.role for x in template.turns if x.loss])
        return F.array(
            segment(_opening(t["role"], template), F.lit(False)),
            segment(escape(t["text"], template), counts),
            segment(F.lit(template.closes), F.lit(False)),
        )

    return F.flatten(F.transform(turns, emitted))


def walk(turns: Column, template: Template) -> Column:
    """The machine's run over the turns' roles: its last ``state``, how many turns were ``illegal`` and
    the position (from 0) of the ``first`` of them (null: none)."""
    legal = [F.lit(x) for t in template.turns for s in t.after for x in (f"{s}>{t.role}", t.role)]
    known = [F.lit(x) for t in template.turns for x in (t.role, t.role)]
    step, restart = F.create_map(*legal), F.create_map(*known)

    def move(at: Column, t: Column) -> Column:
        to = F.try_element_at(step, F.concat(at["state"], F.lit(">"), t["role"]))
        first = F.coalesce(at["first"], F.when(to.isNull(), at["seen"]))
        return F.struct(
            F.coalesce(to, F.try_element_at(restart, t["role"]), at["state"]).alias("state"),
            (at["illegal"] + to.isNull().cast("bigint")).alias("illegal"),
            first.alias("first"),
            (at["seen"] + 1).alias("seen"),
        )

    zero = F.lit(0).cast("bigint")
    begin = F.struct(
        F.lit(START).alias("state"), zero.alias("illegal"), F.lit(None).cast("bigint").alias("first"), zero.alias("seen")
    )
    return F.aggregate(turns, begin, move)


def format_conversations(conversations: DataFrame, template: Template = TITLED) -> DataFrame:
    """One row per conversation: ``conv_id, segments`` (array of text and loss), ``formatted``,
    ``valid`` (every turn legal and the last state one of ``ends``), ``n_illegal``, ``first_illegal``.

    Rows stand in the order of ``turn``, null first; equal turns by role, then text, so that repeated
    rows stay and every order of the input gives one result. A null role or text is empty. The null
    conv_id is one conversation. Other columns are ignored; an empty table gives no rows.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    made = grouped.select("conv_id", segments(F.col("turns"), template).alias("segments"), walk(F.col("turns"), template).alias("run"))
    return made.select(
        "conv_id",
        "segments",
        F.array_join("segments.text", "").alias("formatted"),
        ((F.col("run.illegal") == 0) & F.col("run.state").isin(list(template.ends))).alias("valid"),
        F.col("run.illegal").alias("n_illegal"),
        F.col("run.first").alias("first_illegal"),
    )


def read_turns(formatted: Column, template: Template = TITLED) -> Column:
    """The turns (array of ``role``, ``text``) of a formatted conversation."""
    parts = F.split(formatted, re.escape(template.closes), -1)

    def parsed(part: Column) -> Column:
        rest = F.substr(part, F.lit(len(template.other) + 1))
        role = F.substring_index(rest, template.other_end, 1)
        text = F.substr(rest, F.length(role) + len(template.other_end) + 1)
        role = unescape(role, template)
        for t in template.turns:
            own = F.startswith(part, F.lit(t.opens))
            role = F.when(own, t.role).otherwise(role)
            text = F.when(own, F.substr(part, F.lit(len(t.opens) + 1))).otherwise(text)
        return F.struct(role.alias("role"), unescape(text, template).alias("text"))

    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), parsed)


def loss_text(segs: Column, template: Template = TITLED) -> Column:
    """All text under the loss mask, unescaped, in order and with nothing between."""
    marked = F.filter(segs, lambda s: s["loss"])
    return unescape(F.array_join(F.transform(marked, lambda s: s["text"]), ""), template)
