"""Chat formatting by a declarative template, in DataFrame functions alone.

A finite-state machine over roles checks the turn order.  Its states are named
after the last role read (the start state is ``""``), so the state before each
turn is the role of the turn before it; the template lists which roles may
follow in each state and in which states a conversation may end.  A turn that
may not follow is a fault; the machine goes on from its role, and the
conversation is still formatted.

Every turn becomes segments (marks and text, each with a loss flag).  A text
can hold no control string of the template: inside each one a backslash is put
behind the opening bracket (one more if some stand there), which
:func:`unescape` takes out again.  So the formatted text can be read back.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daycut.operators.rows import computed


@dataclass(frozen=True)
class Part:
    """One segment of a turn: literal ``text``, or a slot of the turn."""

    text: str = ""
    slot: str = ""              # "", "role" or "text"
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks, loss flags and turn order of a chat format.

    ``turns`` lists the parts of each role, ``other`` those of any further
    role.  The last part of a turn starts with a control string that closes no
    turn of another role; of the control strings, none but the first character
    is ``[`` or ``<`` and each starts with one of these.
    """

    begin: str
    turns: dict[str, tuple[Part, ...]]
    other: tuple[Part, ...]
    control: tuple[str, ...]
    follows: dict[str, tuple[str, ...]]
    final: tuple[str, ...]


#: The instruction format with ``[INST]`` marks.
INSTRUCTION = Template(
    begin="<s>",
    turns={"system": (Part("[SYS] "), Part(slot="text"), Part(" [/SYS]")),
           "user": (Part("[INST] "), Part(slot="text"), Part(" [/INST]")),
           "assistant": (Part(" "), Part(slot="text", loss=True), Part("</s>"))},
    other=(Part("[ROLE] "), Part(slot="role"), Part(" [/ROLE] "), Part(slot="text"), Part(" [/TURN]")),
    control=("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]", "[/TURN]"),
    follows={"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    final=("assistant",))


def _rests(template: Template) -> str:
    return "|".join(re.escape(c[1:]) for c in template.control)


def escape(text: Column, template: Template = INSTRUCTION) -> Column:
    """``text`` with every control string broken up by one backslash more."""
    return F.regexp_replace(text, rf"([<\[])(\\*)({_rests(template)})", r"$1\\$2$3")


def unescape(text: Column, template: Template = INSTRUCTION) -> Column:
    """The inverse of :func:`escape`."""
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({_rests(template)})", "$1$2$3")


def _moves(template: Template) -> list[str]:
    """The allowed pairs of state and role; a state but the first begins with
    ``=``, so that no role is taken for the start."""
    return [f"{s and '=' + s}\n{r}" for s, roles in template.follows.items() for r in roles]


def _emitted(template: Template, turn: Column, number: Column) -> Column:
    """The segments of one turn."""
    def parts(of: tuple[Part, ...]) -> Column:
        value = {"role": escape(turn["role"], template), "text": escape(turn["text"], template)}
        return F.array(*[F.struct(number.cast("int").alias("turn"), (value[p.slot] if p.slot else F.lit(p.text)).alias("text"),
                                  F.lit(p.loss).alias("loss"), F.lit(p.slot).alias("slot")) for p in of])

    out = parts(template.other)
    for role, of in template.turns.items():
        out = F.when(turn["role"] == role, parts(of)).otherwise(out)
    return out


def format_chats(turns: DataFrame, template: Template = INSTRUCTION, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: its segments and whether its turns are in order.

    Columns ``conv_id``, ``n_turns``, ``segments`` (array of turn, text, loss,
    slot; turn -1 is what stands before all turns), ``formatted`` (their texts
    joined), ``faults`` (positions, from 0, of turns that may not follow their
    state) and ``valid`` (no fault and a final state at the end).

    Rows go by turn (nulls first), equal ones by role and text.  Null role and
    text count as empty; repeated rows are turns of their own; rows with a null
    conversation id are one conversation.  An empty table gives no rows; other
    columns are ignored.  A conversation is one value, as its formatted text is.
    """
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("row"))
    chats = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    roles, n = F.col("rows.role"), F.size("rows")
    # arrays are zipped, not looked up by position inside a lambda, to stay linear
    states = F.transform(F.slice(roles, F.lit(1), n - 1), lambda r: F.concat(F.lit("="), r))
    moves = F.arrays_zip(F.concat(F.array(F.lit("")), states).alias("state"), roles.alias("role"))
    checked = F.transform(moves, lambda m, i: F.struct(
        i.alias("at"), F.concat_ws("\n", m["state"], m["role"]).isin(*_moves(template)).alias("ok")))
    faults = F.transform(F.filter(checked, lambda c: ~c["ok"]), lambda c: c["at"])
    begin = F.array(F.struct(F.lit(-1).alias("turn"), F.lit(template.begin).alias("text"), F.lit(False).alias("loss"),
                             F.lit("").alias("slot")))
    segments = F.concat(begin, F.flatten(F.transform("rows", lambda t, i: _emitted(template, t, i))))
    once = computed(chats, [F.col("conv_id"), n.cast("long").alias("n_turns"), segments.alias("segments"), faults.alias("faults"),
                            F.element_at(roles, -1).isin(*template.final).alias("ends")])
    return computed(once, [F.col("conv_id"), F.col("n_turns"), F.col("segments"),
                           F.array_join("segments.text", "").alias("formatted"), F.col("faults"),
                           (F.col("ends") & (F.size("faults") == 0)).alias("valid")])


def read_turns(chats: DataFrame, template: Template = INSTRUCTION, formatted_col: str = "formatted") -> DataFrame:
    """``chats`` and ``turns``: the (role, text) pairs read back from the
    formatted text.

    The controls and what stands between them are told apart by one pattern;
    a control that closes a role ends a turn, whose text (and role) are the
    pieces before it without the blanks that belong to the marks.  A null
    formatted text gives null.  The columns ``turns``, ``_marks`` and ``_gaps``
    of ``chats`` are replaced.
    """
    chats = chats.drop("turns", "_marks", "_gaps")
    pattern, formatted = rf"[<\[](?:{_rests(template)})", F.col(formatted_col)
    cut = computed(chats, [*[F.col(f"`{c}`") for c in chats.columns],
                           F.regexp_extract_all(formatted, F.lit(pattern), F.lit(0)).alias("_marks"),
                           F.split(formatted, pattern, -1).alias("_gaps")])
    n = F.size("_marks")
    pieces = F.arrays_zip(F.col("_marks").alias("mark"), F.slice("_gaps", F.lit(1), n).alias("gap"),
                          F.concat(F.array(F.lit("")), F.slice("_gaps", F.lit(1), F.greatest(n - 1, F.lit(0)))).alias("before"))
    closers = {parts[-1].text.strip(): role for role, parts in template.turns.items()}
    ends = F.filter(pieces, lambda p: p["mark"].isin(*closers, template.other[-1].text.strip()))

    def pad(part: Part, ahead: bool) -> int:
        """Blanks between a control and the slot next to it."""
        return len(part.text) - len(part.text.lstrip(" ") if ahead else part.text.rstrip(" "))

    def slot(of: tuple[Part, ...], name: str, gap: Column) -> Column:
        at = [p.slot for p in of].index(name)
        before, after = pad(of[at - 1], False), pad(of[at + 1], True)
        return unescape(F.substring(gap, F.lit(before + 1), F.length(gap) - before - after), template)

    def turn(p: Column) -> Column:
        role = slot(template.other, "role", p["before"])
        text = slot(template.other, "text", p["gap"])
        for close, name in closers.items():
            role = F.when(p["mark"] == close, F.lit(name)).otherwise(role)
            text = F.when(p["mark"] == close, slot(template.turns[name], "text", p["gap"])).otherwise(text)
        return F.struct(role.alias("role"), text.alias("text"))

    return computed(cut, [*[F.col(f"`{c}`") for c in chats.columns], F.transform(ends, turn).alias("turns")])


def chats_digest(chats: DataFrame, template: Template = INSTRUCTION) -> DataFrame:
    """Digest columns, read back from the output of :func:`format_chats`."""
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"], template)), "")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    back = computed(read_turns(chats, template), [
        F.col("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), loss.alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"), F.col("valid"), F.size("faults").cast("long").alias("n_faults")])
    return back.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
                       F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars", "valid", "n_faults")
