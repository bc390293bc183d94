r"""Chat formatting with a grammar round trip.

A conversation is written as its turns, one after the other:

    <s>[SYS] text [/SYS]</s>     <s>[INST] text [/INST]</s>     <s>[OUT] text [/OUT]</s>
    <s>[TURN] role [/ROLE] text [/TURN]</s>                      any other role

A turn is first written as it is. A deterministic parser reads it back: control strings are the template's
when no backslash stands before them; inside a text, backslashes before a control string lose one. If what
comes back isn't the one turn that went in, its text (and role) are escaped (one backslash more before every
control string, behind any that are there) and the turn is read back again, until it is identical; the grammar
guarantees that at the second try. The loss mask is the span of an [OUT] turn's text in the formatted text.

A turn is written where its row is read; it ends in a control string, so what is read of a conversation's text
is what is read of its turns, one after the other. Conversations are read in one pass over sorted rows with a
state of one turn; nothing is gathered by conversation. A digest runs along its conversation in order, so one
conversation is one task's, as a stream. A turn that isn't of the grammar, or whose masked span isn't what the
parser reads, is an error.

Defined cases: a null text or role is empty; turns are ordered by turn (null first), role and formatted text, so
that repeated rows and equal turn numbers have one order; rows of a null conv_id are one conversation. A text may
hold any control string, backslashes before it, and blanks at its ends. Other columns are ignored; an empty table
gives an empty one.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Control strings, which only the template may hold unescaped.
CONTROL = ("<s>", "</s>", "[SYS]", "[/SYS]", "[INST]", "[/INST]", "[OUT]", "[/OUT]", "[TURN]", "[/ROLE]", "[/TURN]")
MARKS = {"system": "SYS", "user": "INST", "assistant": "OUT"}
ROLES = {m: r for r, m in MARKS.items()}
_ANY = "|".join(map(re.escape, CONTROL))
_ESCAPABLE = re.compile(rf"\\*(?:{_ANY})")
_BARE = re.compile(rf"(?<!\\)(?:{_ANY})")


def escape(text: str) -> str:
    return _ESCAPABLE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPABLE.sub(lambda m: m[0].removeprefix("\\"), text)


def _write(role: str, text: str) -> str:
    mark = MARKS.get(role)
    return f"<s>[{mark}] {text} [/{mark}]</s>" if mark else f"<s>[TURN] {role} [/ROLE] {text} [/TURN]</s>"


def render(role: str, text: str) -> str:
    """One turn; escaped where it would not be read back as it is."""
    out = _write(role, text)
    if parse(out) == [(role, text)]:
        return out
    out = _write(role if role in MARKS else escape(role), escape(text))
    if parse(out) != [(role, text)]:
        raise ValueError(f"the turn doesn't survive: {out[:200]!r}")
    return out


def parse(formatted: str) -> list[tuple[str, str]] | None:
    """The turns of formatted text, or None if it isn't of the grammar."""
    turns, at = [], 0
    marks = [(m.start(), m.end(), m[0]) for m in _BARE.finditer(formatted)]
    i = 0
    while at < len(formatted):
        if i + 1 >= len(marks) or marks[i][2] != "<s>" or marks[i][0] != at or marks[i + 1][0] != marks[i][1]:
            return None
        kind = marks[i + 1][2][1:-1]
        need = ["[TURN]", "[/ROLE]", "[/TURN]", "</s>"] if kind == "TURN" else [f"[{kind}]", f"[/{kind}]", "</s>"]
        got = marks[i + 1 : i + 1 + len(need)]
        if [g[2] for g in got] != need or (kind != "TURN" and kind not in ROLES) or got[-1][0] != got[-2][1]:
            return None
        fields = []
        for a, b in zip(got[:-2], got[1:-1]):
            field = formatted[a[1] : b[0]]
            if len(field) < 2 or field[0] != " " or field[-1] != " ":
                return None
            fields.append(unescape(field[1:-1]))
        turns.append((ROLES[kind], fields[0]) if kind != "TURN" else (fields[0], fields[1]))
        at, i = got[-1][1], i + 1 + len(need)
    return turns


def masked(formatted: str) -> tuple[int, int] | None:
    """The span of a rendered turn's text that the loss covers: that of an [OUT] turn."""
    head, tail = "<s>[OUT] ", " [/OUT]</s>"
    return (len(head), len(formatted) - len(tail)) if formatted.startswith(head) else None


def format_chats(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, formatted, loss_from, loss_to: a conversation's formatted text is its rows' in order of turn, role and formatted; the loss covers code points loss_from to loss_to of a row's."""
    C.small_batches(conversations.sparkSession)
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches):
        for batch in batches:
            out = [render(role, text) for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())]
            span = [masked(x) or (None, None) for x in out]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("turn"), batch.column("role"), pa.array(out, pa.string()), pa.array([x[0] for x in span], pa.int64()), pa.array([x[1] for x in span], pa.int64())], ["conv_id", "turn", "role", "formatted", "loss_from", "loss_to"])

    return rows.mapInArrow(C.batchwise(run), "conv_id long, turn long, role string, formatted string, loss_from long, loss_to long")


def read_chats(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from formatted chats."""

    def run(batches):
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        now, state = (), None

        def done():
            return [now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]]

        def table(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

        for batch in batches:
            out = []
            for c, text, a, b in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "formatted", "loss_from", "loss_to"))):
                if state is None or now != c:
                    if state is not None:
                        out.append(done())
                    now, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                turns = parse(text)
                if turns is None:
                    raise ValueError(f"not of the grammar: {text[:200]!r}")
                learned = "" if a is None else unescape(text[a:b])
                if learned != "".join(said for role, said in turns if role == "assistant"):
                    raise ValueError(f"the loss mask isn't the assistant's text: {text[:200]!r}")
                for role, said in turns:
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += len(text)
            yield table(out)
        if state is not None:
            yield table([done()])

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "formatted")
    return ordered.mapInArrow(C.batchwise(run), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
