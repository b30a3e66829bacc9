"""Conversation structure repair over a suffix-shared automaton.

Each turn becomes one symbol: its role's initial and its first fault.  A
conversation's symbols are its signature.  The cheapest edits that give role
initials ``(s?(ua)+)?`` depend on the signature alone, and what they cost from
some turn on depends on the symbols from there on and on the grammar's state.
So distinct signatures share their common suffixes: sorted from the end, they
are the paths of an acyclic automaton minimised from the end, and each of its
nodes is worked out once, for all grammar states, over all conversations.

Rows move twice without their texts (repeats, signatures) and once with them
(repaired turns); conversations are read as streams, never held.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator
from functools import partial
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daycut.session import checkpointed

#: The grammar.  States: 0 start, 1 after the system turn, 2 after a user turn,
#: 3 after an assistant turn.  ``_KEEP``: state behind a kept initial;
#: ``_NEXT``: the one role an edit can put there, and the state behind it;
#: ``_END``: least inserts to an end.
_KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_NEXT = (("user", 2), ("user", 2), ("assistant", 3), ("user", 2))
_END = (0, 2, 1, 0)
#: The symbol of a turn that has to go (blank or repeated).  The others are
#: s, u, a and o (any other initial); upper case if the text is truncated.
_GONE = "x"
_PAIRS = ("su", "ua", "au")

SPACE = " \t\n\x0b\x0c\r"
#: Signature bytes up to which the audits are sent to every task.
SENT_BYTES = 16 << 20
#: Parts of each signature's conversations where audits are too many to send.
SALTS = 16


class Costs(NamedTuple):
    """Costs of the edits; ``cut`` is added for each truncated turn that stays."""

    rerole: int = 3
    delete: int = 4
    insert: int = 3
    cut: int = 3


def _solve(symbol: str, below: list[int], costs: Costs) -> tuple[list[int], str]:
    """Cost-to-go and best first edit of a node in each state; ``below`` are
    the costs of the node that follows its symbol.

    Each edit leads to one state only, so the least audit in ASCII order takes
    the least letter that reaches the least cost.
    """
    options: list[dict[str, int]] = []
    extra = costs.cut if symbol.isupper() else 0
    for state in range(4):
        option = {"D": costs.delete + below[state]}
        if symbol != _GONE:
            kept = _KEEP.get((state, symbol.lower()))
            if kept is not None:
                option["K"] = extra + below[kept]
            option["R"] = costs.rerole + extra + below[_NEXT[state][1]]
        options.append(option)
    best = [min(o.values()) for o in options]
    for _ in range(2):                                      # an insert leads to another state of the node
        best = [min(best[q], costs.insert + best[_NEXT[q][1]]) for q in range(4)]
    for state, option in enumerate(options):
        option["I"] = costs.insert + best[_NEXT[state][1]]
    return best, "".join(min(k for k, v in o.items() if v == best[q]) for q, o in enumerate(options))


def _follow(state: int, edit: str, symbol: str) -> int:
    """State behind an edit."""
    return state if edit == "D" else _KEEP[state, symbol.lower()] if edit == "K" else _NEXT[state][1]


def _audits(batches: Iterable[pa.RecordBatch], costs: Costs) -> Iterator[pa.RecordBatch]:
    """Cost and audit of signatures that come sorted from their end.

    The path of the last signature is all that is held: node d stands for its
    last d symbols, and a signature works out only the nodes beyond what it
    shares with the one before.
    """
    path = ""                                               # symbols from the end
    cost = array("q", [costs.insert * n for n in _END])     # four per node
    edit = bytearray(b"".join(b"I" if n else b" " for n in _END))
    solved: dict[tuple, tuple] = {}
    for batch in batches:
        rows = []
        for signature in batch.column("signature").to_pylist():
            back = signature[::-1]
            shared, most = 0, min(len(back), len(path))
            while shared < most and back[shared] == path[shared]:
                shared += 1
            del cost[4 * (shared + 1):], edit[4 * (shared + 1):]
            for symbol in back[shared:]:
                below = cost[-4:].tolist()
                low = min(below)                            # equal steps are solved once
                key = symbol, *(b - low for b in below)
                if key not in solved:
                    solved[key] = _solve(symbol, list(key[1:]), costs)
                best, letters = solved[key]
                cost.extend(low + b for b in best)
                edit.extend(letters.encode())
            path, node, state, audit = back, len(back), 0, []
            while (letter := chr(edit[4 * node + state])) != " ":
                audit.append(letter)
                if letter == "I":
                    state = _NEXT[state][1]
                else:
                    node -= 1
                    state = _follow(state, letter, back[node])
            rows.append((signature, cost[4 * len(back)], "".join(audit), len(back) - shared))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                pa.string(), pa.int64(), pa.string(), pa.int64()))], ["signature", "cost", "audit", "nodes"])


def audits(signatures: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """``signature``, ``cost``, ``audit`` and ``nodes`` (automaton nodes worked
    out for it) of each distinct signature in the column ``signature``."""
    back = F.reverse("signature")
    return (signatures.select("signature").distinct().repartitionByRange(back).sortWithinPartitions(back)
            .mapInArrow(partial(_audits, costs=costs), "signature string, cost long, audit string, nodes long"))


def _describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Facts and signature per conversation; rows come conversation by
    conversation, in order."""
    now = _Open()
    for batch in batches:
        out = []
        for conv, turn, initial, fault in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "fault")]):
            if now.signature is None or conv != now.conv:
                out += now.closed()
                now = _Open(conv, bytearray())
            now.add(turn, initial, fault)
        if out:
            yield _facts(out, batch.schema.field("conv_id").type)
    if now.signature is not None:
        yield _facts(now.closed(), batch.schema.field("conv_id").type)


class _Open:
    """The conversation being read."""

    def __init__(self, conv=None, signature: bytearray | None = None) -> None:
        self.conv, self.signature = conv, signature
        self.first = self.last = self.initial = None
        self.distinct = self.illegal = 0
        self.faults = [0, 0, 0, 0]

    def add(self, turn, initial: str, fault: int) -> None:
        if turn is not None:
            self.distinct += self.last is None or turn != self.last
            self.first, self.last = turn if self.first is None else self.first, turn
        if self.initial is not None:
            self.illegal += self.initial + initial not in _PAIRS
        self.initial = initial
        self.faults[fault] += 1
        symbol = initial if initial in ("s", "u", "a") else "o"
        self.signature += (_GONE if fault in (1, 2) else symbol.upper() if fault == 3 else symbol).encode()

    def closed(self) -> list[tuple]:
        if self.signature is None:
            return []
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        return [(self.conv, gaps, *self.faults[1:], self.illegal, self.signature.decode())]


def _facts(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    types = (kind, *[pa.int64()] * 5, pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "signature"])


def _rows(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    space = F.lit(" ")
    return turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(F.col(role_col), space).alias("role"), F.coalesce(F.col(text_col), space).alias("text"),
                        ).withColumn("hash", F.unhex(F.sha2("text", 256)))


def conversation_facts(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                       text_col: str = "text") -> DataFrame:
    """Per conversation: ``conv_id``, ``gaps`` (turn numbers missing between
    the first and the last), ``blank``, ``duplicate``, ``truncated`` (turns by
    first fault), ``illegal`` (adjacent roles out of order) and ``signature``.

    Turns go by number (nulls first), then role, then hash of the text, so a
    repeated row lies next to its original.  A null role or text counts as one
    space.  Rows with a null id are one conversation.
    """
    rows = _rows(turns, conv_col, turn_col, role_col, text_col)
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cut = ~F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1)).isin(".", "!", "?")
    light = rows.select("conv_id", "turn", "role", "hash", blank.alias("blank"), cut.alias("cut"))
    again = F.expr("row_number() OVER (PARTITION BY conv_id, role, hash ORDER BY turn) > 1")
    fault = F.when(F.col("blank"), 1).when(F.col("again"), 2).when(F.col("cut"), 3).otherwise(0)
    ordered = (light.withColumn("again", again)
               .select("conv_id", "turn", "role", "hash", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))
               .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "hash"))
    return ordered.select("conv_id", "turn", "initial", "fault").mapInArrow(
        _describe, f"conv_id {light.schema['conv_id'].dataType.simpleString()}, gaps long, blank long, duplicate long, "
        "truncated long, illegal long, signature string")


def plan_repairs(facts: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """``facts`` with ``cost`` and ``audit`` (initials of Keep, Rerole, Delete,
    Insert) of the cheapest repair, the least one in ASCII order among equals.

    Very many conversations can share a signature: the audits are sent to all
    tasks if they are measured to be small, else each signature's
    conversations are dealt over ``SALTS`` parts.
    """
    found = checkpointed(audits(facts, costs).select("signature", "cost", "audit"))
    size = found.agg(F.sum(F.length("signature") + F.length("audit") + 32)).first()[0] or 0
    if size <= SENT_BYTES:
        return facts.join(F.broadcast(found), "signature")
    dealt = facts.withColumn("salt", F.pmod(F.xxhash64("conv_id"), F.lit(SALTS)))
    parts = found.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return dealt.join(parts, ["signature", "salt"]).drop("salt")


def _repair(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Applies each conversation's audit (its first row) to the rows behind it."""
    audit, at, state, place, conv = "", 0, 0, 0, None
    for batch in batches:
        out: list[tuple] = []

        def put(role: str, text: str, edit: str) -> None:
            nonlocal place
            out.append((conv, place, role, text, edit))
            place += 1

        def inserts() -> None:
            nonlocal at, state
            while at < len(audit) and audit[at] == "I":
                role, state = _NEXT[state]
                put(role, "", "I")
                at += 1

        for key, told, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text")]):
            if told is not None:                            # a new conversation
                audit, at, state, place, conv = told, 0, 0, 0, key
                inserts()
                continue
            edit, at = audit[at], at + 1
            if edit == "K":
                state = _KEEP[state, role[:1]]
                put(role, text, edit)
            elif edit == "R":
                role, state = _NEXT[state]
                put(role, text, edit)
            inserts()
        if out:
            types = batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.string(), pa.string()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                             ["conv_id", "place", "role", "text", "edit"])


def repaired_turns(turns: DataFrame, plans: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The turns that the audits of :func:`plan_repairs` leave: ``conv_id``,
    ``place`` (from 0), ``role``, ``text``, ``edit`` (K, R or I).

    Rows come conversation by conversation and in order within partitions, so
    a narrow step behind can read each conversation as a stream.
    """
    rows = _rows(turns, conv_col, turn_col, role_col, text_col).withColumn("audit", F.lit(None).cast("string"))
    heads = plans.select("conv_id", "audit")
    return (rows.unionByName(heads, allowMissingColumns=True).repartition("conv_id")
            .sortWithinPartitions("conv_id", F.col("audit").isNull(), "turn", "role", "hash")
            .select("conv_id", "audit", "role", "text")
            .mapInArrow(_repair, f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, place long, role string, "
                        "text string, edit string"))


def _digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of ``role:text`` lines per conversation, read as a stream."""
    conv, sha, kind = None, None, None

    def closed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], kind), pa.array([s for _, s in done])],
                                          ["conv_id", "sha256"])

    for batch in batches:
        kind, done = batch.schema.field("conv_id").type, []
        for key, place, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text")]):
            if place == 0:
                if sha is not None:
                    done.append((conv, sha.hexdigest()))
                conv, sha = key, hashlib.sha256()
            sha.update(("\n" * (place > 0) + f"{role}:{text}").encode())
        if done:
            yield closed()
    if sha is not None:
        done = [(conv, sha.hexdigest())]
        yield closed()


def repairs_digest(plans: DataFrame, repaired: DataFrame) -> DataFrame:
    """``plans`` and the SHA-256 of each conversation's repaired turns."""
    kind = repaired.schema["conv_id"].dataType.simpleString()
    sums = repaired.mapInArrow(_digest, f"conv_id {kind}, sha256 string").withColumnRenamed("conv_id", "id")
    return plans.join(sums, F.col("conv_id").eqNullSafe(F.col("id")), "left").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def repair_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", costs: Costs = Costs()) -> tuple[DataFrame, DataFrame]:
    """Plans (a row per conversation) and repaired turns.

    Roles are told by their first character.  Blank turns (white space alone)
    and turns whose role and text came before in the conversation are deleted;
    see :func:`conversation_facts` for order and nulls.  An empty table gives
    two empty results; extra columns are ignored.
    """
    cols = conv_col, turn_col, role_col, text_col
    plans = checkpointed(plan_repairs(checkpointed(conversation_facts(turns, *cols)), costs))
    return plans, repaired_turns(turns, plans, *cols)
