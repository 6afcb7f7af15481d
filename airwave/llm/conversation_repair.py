"""Conversation structure repair: the cheapest edits after which roles alternate, found in one sorted stream.

Turns are repartitioned by conversation and sorted by turn. A conversation's roles have to read ``s?(ua)+`` by their
initials, or be gone. Keep costs nothing, Rerole 2, Insert of an empty turn 2, Delete 3; a truncated turn that stays
costs 1; blank turns and repeats have to go. A dynamic programme over four states (nothing yet, system, user, assistant)
runs along the stream, over any number of Arrow batches: it carries the states' costs above their least and the order
of their edits, of which there are finitely many, so a turn is one look-up in a table that fills as it is used.
What a turn leaves behind is the number of its table entry, four bytes that hold the four states' backpointers. These and
the turns stay in memory up to SPILL characters, beyond that in an unnamed file of the task, which ends with it; at the end
of a conversation they are read backwards for the edits and forwards for the repaired turns.

Of equally cheap edits those win whose initials are least as text. Two states' edits up to a turn are never one the
beginning of the other, as both have dealt with the same turns, so the order of the four carries over to what follows.

Defined cases: null ids are one conversation; null turns come first and leave no gap; null roles and texts are one
space, so such a text is blank; turns of one number are ordered by role and text; a repeated row is a duplicate; an empty
table gives an empty result; further columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Costs of edits, and what a truncated turn adds that stays.
RELABEL, DELETE, INSERT, CUT_SHORT = 2, 3, 2, 1
#: Characters of turns that a conversation keeps in memory.
SPILL = 1 << 23
BLANKS = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a turn with this initial, and after a made user or assistant turn.
AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
MADE = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): rows damaged by a hash of conversation and turn; a dropped row is marked as gone."""
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn"))) % 20
    rows = conversations.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("fault") == 3, F.sequence(F.lit(0), F.lit(1))).otherwise(F.sequence(F.lit(0), F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("fault") == 0).alias("gone"), F.explode(times).alias("copy")).drop("copy")


def _moves(initial: str, bad: bool, short: bool) -> Iterator[tuple[int, int, str, int]]:
    """(state before, cost, edits, state after): all ways to deal with a turn, turns inserted before it included."""
    for before in range(4):
        at, made = before, ""
        for _ in range(3):  # a third insert would only come back to the state of the first
            cost = INSERT * len(made)
            yield before, cost + DELETE, made + "D", at
            if not bad:
                if (at, initial) in AFTER:
                    yield before, cost + CUT_SHORT * short, made + "K", AFTER[at, initial]
                yield before, cost + RELABEL + CUT_SHORT * short, made + "R", MADE[at]
            at, made = MADE[at], made + "I"


#: By how much a state may cost more than another and still lead to the least: what the other needs to do all that it can.
_SLACK = {(START, ASSISTANT): 3, (SYSTEM, ASSISTANT): 0, (USER, ASSISTANT): 2, (ASSISTANT, USER): 2, (START, USER): 5, (SYSTEM, USER): 2}

State = tuple[tuple[int, int, int], ...]


class Automaton:
    """The states' costs and order as one number; step() looks up what a turn does to them."""

    def __init__(self) -> None:
        self.columns: list[State] = [((START, 0, 0),)]
        self.numbers = {self.columns[0]: 0}
        self.table: dict[tuple, tuple[int, int, int]] = {}
        self.entries: list[dict[int, tuple[int, str]]] = []

    def step(self, column: int, kind: tuple[str, bool, bool]) -> tuple[int, int, int]:
        """(column after, what the least cost grows by, entry with the backpointers)"""
        found = self.table.get((column, kind))
        return found if found else self.table.setdefault((column, kind), self._made(column, kind))

    def _made(self, column: int, kind: tuple[str, bool, bool]) -> tuple[int, int, int]:
        own = {state: (cost, rank) for state, cost, rank in self.columns[column]}
        best: dict[int, tuple[int, int, str, int]] = {}
        for before, cost, edits, after in _moves(*kind):
            if before in own:
                way = (own[before][0] + cost, own[before][1], edits, before)
                best[after] = min(best.get(after, way), way)
        least = min(b[0] for b in best.values())
        best = {s: b for s, b in best.items() if all(o not in best or b[0] <= best[o][0] + more for (p, o), more in _SLACK.items() if p == s)}
        order = {s: i for i, s in enumerate(sorted(best, key=lambda s: best[s][1:3]))}
        made = tuple((s, best[s][0] - least, order[s]) for s in sorted(best))
        if made not in self.numbers:
            self.numbers[made] = len(self.columns)
            self.columns.append(made)
        self.entries.append({s: (b[3], b[2]) for s, b in best.items()})
        return self.numbers[made], least, len(self.entries) - 1

    def end(self, column: int) -> tuple[int, str, int]:
        """(cost above the least, inserts at the end, last state)"""
        ways = []
        for state, cost, rank in self.columns[column]:
            at, made = state, ""
            for _ in range(3):
                if at in (START, ASSISTANT):
                    ways.append((cost + INSERT * len(made), rank, made, state))
                at, made = MADE[at], made + "I"
        cost, _, made, state = min(ways)
        return cost, made, state


class Conversation:
    """One conversation on its way through the stream."""

    def __init__(self, key: str | None, automaton: Automaton) -> None:
        self.key, self.automaton = key, automaton
        self.column = self.cost = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = None
        self.before: str | None = None
        self.roles, self.texts, self.entries, self.size = [], [], array("I"), 0
        self.file, self.at = None, []

    def add(self, turn: str | None, role: str, text: str, again: bool, blank: bool, short: bool) -> None:
        if turn is not None and (n := int(turn)) != self.last:
            self.first, self.last, self.turns = n if self.first is None else self.first, n, self.turns + 1
        initial = role[:1]
        self.illegal += self.before is not None and self.before + initial not in ("su", "ua", "au")
        self.before = initial
        short = short and not blank and not again
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + (again and not blank), self.truncated + short
        self.column, more, entry = self.automaton.step(self.column, (initial if initial in ("s", "u", "a") else "", blank or again, short))
        self.cost += more
        self.roles.append(role)
        self.texts.append(text)
        self.entries.append(entry)
        self.size += len(text) + len(role) + 16
        if self.size > SPILL:
            self.file = self.file or tempfile.TemporaryFile()
            self.at.append(self.file.seek(0, 2))
            pickle.dump((self.roles, self.texts, self.entries), self.file)
            self.roles, self.texts, self.entries, self.size = [], [], array("I"), 0

    def _part(self, i: int) -> tuple[list[str], list[str], array]:
        if i == len(self.at):
            return self.roles, self.texts, self.entries
        self.file.seek(self.at[i])
        return pickle.load(self.file)

    def edits(self) -> Iterator[str]:
        """The edits of each turn, inserts before it included, and those of the end."""
        more, made, state = self.automaton.end(self.column)
        self.cost += more
        back = [made]
        for i in reversed(range(len(self.at) + 1)):
            for entry in reversed(self._part(i)[2]):
                state, own = self.automaton.entries[entry][state]
                back.append(own)
        return reversed(back)

    def repaired(self, edits: Iterator[str]) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of the turns that are there after the repair."""
        state = START
        for i in range(len(self.at) + 2):
            roles, texts, _ = self._part(i) if i <= len(self.at) else ((None,), (None,), ())
            for role, text in zip(roles, texts, strict=True):
                for edit in next(edits):
                    if edit == "K":
                        state = AFTER[state, role[:1]]
                        yield edit, role, text
                    elif edit != "D":
                        state = MADE[state]
                        yield edit, NAMES[state], text if edit == "R" else ""

    def close(self) -> None:
        if self.file:
            self.file.close()


def streamed(rows: DataFrame, gone: Column | None = None) -> DataFrame:
    """Turns by conversation, in order of turn, with what is wrong with each; one shuffle, and sorts that spill.

    Rows that are gone only tell that their conversation is there.
    """
    gone = F.lit(False) if gone is None else gone
    plain = lambda c: F.when(gone, "").otherwise(F.coalesce(F.col(c), F.lit(" ")))
    rows = rows.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"), gone.alias("gone")).repartition("conv_id")
    seen = F.row_number().over(Window.partitionBy("conv_id", "gone", "role", "text").orderBy("turn")) > 1
    solid = F.rtrim(F.col("text"), F.lit(BLANKS))
    rows = rows.withColumns({"again": seen, "blank": solid == "", "short": ~F.right(solid, F.lit(1)).isin(".", "!", "?")})
    return rows.sortWithinPartitions("conv_id", "turn", "role", "text")


def _stream(rows: DataFrame, gone: Column | None, finished, schema: str) -> DataFrame:
    """finished(conversation) gives result rows at the end of each conversation."""
    as_text: list[Column] = [F.col("conv_id").cast("string").alias("key"), F.col("turn").cast("string").alias("turn")]
    names = [f.split()[0] for f in schema.split(", ")]

    def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton, now, out, size = Automaton(), None, [], 0
        for batch in batches:
            for key, turn, role, text, gone, again, blank, short in zip(*(batch[c].tolist() for c in batch.columns), strict=True):
                if now is None or key != now.key:
                    for row in finished(now) if now else ():
                        out.append(row)
                        size += sum(len(x) for x in row if isinstance(x, str)) + 64
                        if size > SPILL:
                            yield pd.DataFrame(out, columns=names, dtype=object)
                            out, size = [], 0
                    now = Conversation(key, automaton)
                if not gone:
                    now.add(turn, role, text, again, blank, short)
        for row in finished(now) if now else ():
            out.append(row)
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=names, dtype=object)
                out = []
        if out:
            yield pd.DataFrame(out, columns=names, dtype=object)

    own = streamed(rows, gone).select(*as_text, "role", "text", "gone", "again", "blank", "short")
    kind = rows.schema["conv_id"].dataType
    done = own.mapInPandas(go, schema)
    return done.select(F.col("key").cast(kind).alias("conv_id"), *names[1:])


def _turns(c: Conversation) -> Iterator[tuple]:
    for place, (edit, role, text) in enumerate(c.repaired(c.edits())):
        yield c.key, place, edit, role, text
    c.close()


def repaired(rows: DataFrame, gone: Column | None = None) -> DataFrame:
    """(conv_id, place, edit, role, text): the turns of all conversations after the repair."""
    return _stream(rows, gone, _turns, "key string, place long, edit string, role string, text string")


def _digest(c: Conversation) -> Iterator[tuple]:
    edits, whole, first = list(c.edits()), hashlib.sha256(), True
    for _, role, text in c.repaired(iter(edits)):
        whole.update(("" if first else "\n").encode() + f"{role}:{text}".encode(errors="surrogatepass"))
        first = False
    gaps = 0 if c.first is None else min(c.last - c.first + 1 - c.turns, (1 << 63) - 1)
    yield c.key, gaps, c.blank, c.duplicate, c.truncated, c.illegal, c.cost, "".join(edits), whole.hexdigest()
    c.close()


def audited(rows: DataFrame, gone: Column | None = None) -> DataFrame:
    """A row for each conversation: its faults, the cheapest edits' cost and initials, and a hash of the repaired turns."""
    figures = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return _stream(rows, gone, _digest, f"key string, {figures}")


def op11_conversation_repair(conversations: DataFrame) -> DataFrame:
    return audited(damaged(conversations), F.col("gone"))
