"""Chat formatting by a finite-state machine over roles.

A declarative :class:`Template` says how turns of each role are marked, which roles
are learned from (the loss flag), which role may follow which, and where a conversation may
end.  The machine goes through a conversation's turns in order, keeps the state, and
emits the formatted text as segments: a turn's mark, its text and its end, each
with a loss flag.  A conversation whose roles leave the table of transitions is formatted
whole all the same; its segments say that it is not valid.

Texts may hold anything.  The escape character, and every control string in a text, gets the
escape character before it, so a reader that goes from left to right finds the marks and
gives back roles and texts exactly (:func:`read_back`).

Scale: turns are dealt out by conversation and sorted inside the partitions by
Spark, which spills; tasks go through the rows as a stream and hold one turn of one
conversation, so a conversation with a third of all turns is long work for its task, as a digest
over its turns in order has to be, but never a group in memory.  The texts are
shuffled once.

Defined results: a null text is empty, a null role is the empty role, which is in no
transition; turns of one conversation go by turn (nulls first), then role, then text, so
repeated rows stand beside each other and all count; rows with a null id are one conversation with
a null id; a very long text is one segment; an empty table gives no row; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: characters of segments passed on at a time: bounds what a task holds
FLUSH = 1 << 20


@dataclass(frozen=True)
class Template:
    """Marks, loss flags and the machine.  ``marks`` are the roles with a name of their own; any other
    role is written after ``other``.  A turn is ``open + name + colon``, the text, ``close``."""

    open: str = "### "
    colon: str = ": "
    close: str = " </turn>\n"
    end: str = "</turn>"
    escape: str = "\\"
    marks: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    other: str = "Role "
    learned: frozenset[str] = frozenset({"assistant"})
    #: state: roles that may come next; a role's name is the state after it
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    ends: frozenset[str] = frozenset({"user", "assistant"})

    def __post_init__(self):
        if self.end not in self.close or any(c.startswith(self.escape) for c in self.controls):
            raise ValueError("the close must hold the end string, and no control string begins with the escape")
        if any(self.end.startswith(self.end[i:]) for i in range(1, len(self.end))):
            raise ValueError("the end string must not begin as it ends")

    @property
    def controls(self) -> tuple[str, ...]:
        return self.open, self.end

    def escaped(self, text: str, *more: str) -> str:
        return re.sub("|".join(map(re.escape, (self.escape, *self.controls, *more))), lambda m: self.escape + m[0], text)

    def unescaped(self, text: str) -> str:
        return re.sub(re.escape(self.escape) + "(.)", r"\1", text, flags=re.S)

    def mark(self, role: str) -> str:
        name = self.marks.get(role)
        return self.open + (name if name is not None else self.other + self.escaped(role, self.colon)) + self.colon

    def step(self, state: str | None, role: str) -> str | None:
        """The state after a turn of ``role``; None once a turn was out of order."""
        return role if state is not None and role in self.follows.get(state, ()) else None


CHAT = Template()
SEGMENTS = "conv_id long, segment long, turn_no long, text string, loss boolean, valid boolean"


def _ordered(turns: DataFrame, *by: str) -> DataFrame:
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", *by)


def segments(turns: DataFrame, template: Template = CHAT, id_col: str = "conv_id", turn_col: str = "turn",
             role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The formatted conversations: conv_id, segment and turn_no (from 0), text, loss, and valid (whether the
    machine accepts the turns up to this one; on the last turn, also whether they may end there).  The
    rows of a conversation lie together and in order."""
    df = turns.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                      F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                      F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches):
        out, held = [], 0

        def batch():
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                              names=["conv_id", "segment", "turn_no", "text", "loss", "valid"])

        def turn(conv, no, role, text, ok):
            return [(conv, 3 * no, no, template.mark(role), False, ok),
                    (conv, 3 * no + 1, no, template.escaped(text), role in template.learned, ok),
                    (conv, 3 * no + 2, no, template.close, False, ok)]

        # a turn is passed on when the next one shows whether it is the last of its conversation
        last, state, no = None, "", 0
        for b in batches:
            for conv, role, text in zip(*(b.column(i).to_pylist() for i in (0, 2, 3))):
                if last is not None:
                    ends = last[0] != conv
                    out += turn(last[0], no, *last[1:], state is not None and (not ends or state in template.ends))
                    held += len(last[2])
                    state, no = ("", 0) if ends else (state, no + 1)
                    if held > FLUSH or len(out) > 20_000:
                        yield batch()
                        out, held = [], 0
                state = template.step(state, role)
                last = (conv, role, text)
        if last is not None:
            out += turn(last[0], no, *last[1:], state is not None and state in template.ends)
            yield batch()

    return _ordered(df, "turn", "role", "text").mapInArrow(run, SEGMENTS)


class Reader:
    """Reads formatted segments of one conversation back, in any cut of the text: the state is the part of a
    turn that has not ended yet."""

    def __init__(self, template: Template):
        t = self.template = template
        #: a turn's end, or an escaped character that the search steps over
        self.stop = re.compile(re.escape(t.escape) + "(?s:.)|" + re.escape(t.close))
        self.colon = re.compile(re.escape(t.escape) + "(?s:.)|" + re.escape(t.colon))
        self.roles = {v: k for k, v in t.marks.items()}

    def _find(self, pattern: re.Pattern, text: str, at: int) -> tuple[int, int] | None:
        for m in pattern.finditer(text, at):
            if not m[0].startswith(self.template.escape):
                return m.span()
        return None

    def turns(self, text: str) -> tuple[list[tuple[str, str, tuple[int, int]]], int]:
        """The whole turns at the beginning of ``text`` as (role, text, extent of the escaped text), and where the
        rest begins."""
        t, at, out = self.template, 0, []
        while text.startswith(t.open, at):
            colon = self._find(self.colon, text, at + len(t.open))
            end = colon and self._find(self.stop, text, colon[1])
            if not end:
                break
            name = text[at + len(t.open):colon[0]]
            role = self.roles[name] if name in self.roles else t.unescaped(name[len(t.other):])
            out.append((role, t.unescaped(text[colon[1]:end[0]]), (colon[1], end[0])))
            at = end[1]
        return out, at


DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
          "valid boolean")


def read_back(formatted: DataFrame, template: Template = CHAT, arranged: bool = False) -> DataFrame:
    """One row for each conversation, from its segments: the turns read out of the joined text (n_turns,
    turns_sha256 over role, line feed, text, line feed), the unescaped text under the loss flags (loss_chars,
    loss_sha256), formatted_chars and valid.  ``arranged`` says that a conversation's rows lie together and in
    order, as :func:`segments` leaves them; else they are sorted first."""
    rows = formatted if arranged else _ordered(formatted, "segment")

    def run(batches):
        reader = Reader(template)

        def digest(conv, open_, n, turns, loss_n, loss, chars, ok):
            if open_:
                raise ValueError(f"conversation {conv}: the formatted text ends inside a turn")
            return conv, n, turns.hexdigest(), loss_n, loss.hexdigest(), chars, ok

        def batch(out):
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                              names=[c.split()[0] for c in DIGEST.split(", ")])

        out, now = [], None
        for b in batches:
            for conv, text, loss, ok in zip(*(b.column(i).to_pylist() for i in (0, 3, 4, 5))):
                if now is None or now[0] != conv:
                    if now is not None:
                        out.append(digest(*now))
                        if len(out) >= 10_000:
                            yield batch(out)
                            out = []
                    now = [conv, "", 0, hashlib.sha256(), 0, hashlib.sha256(), 0, True]
                now[1] += text
                now[6] += len(text)
                now[7] = now[7] and ok
                if loss:
                    learned = template.unescaped(text)
                    now[4] += len(learned)
                    now[5].update(learned.encode())
                if now[1].endswith(template.close):
                    turns, end = reader.turns(now[1])
                    for role, said, _ in turns:
                        now[3].update(f"{role}\n{said}\n".encode())
                    now[2] += len(turns)
                    now[1] = now[1][end:]
        if now is not None:
            out.append(digest(*now))
        if out:
            yield batch(out)

    return rows.mapInArrow(run, DIGEST)


#: The rows of the registered query: tables hold one role after the other as the template's machine expects.
ORACLE_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
s AS (
  SELECT *, lag(role) OVER w AS before, lead(role) OVER w IS NULL AS is_last,
    length(CASE role WHEN 'system' THEN 'System' WHEN 'user' THEN 'User' WHEN 'assistant' THEN 'Assistant'
      ELSE 'Role ' || regexp_replace(role, '(\\|### |</turn>|: )', '\\\1', 'g') END) + length('### :  </turn>') + 1
    + length(regexp_replace(text, '(\\|### |</turn>)', '\\\1', 'g')) AS chars
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars,
  bool_and(coalesce(before, '') || '>' || role IN ('>system', '>user', 'system>user', 'user>assistant', 'assistant>user')
    AND (NOT is_last OR role IN ('user', 'assistant'))) AS valid
FROM s GROUP BY conv_id
"""
