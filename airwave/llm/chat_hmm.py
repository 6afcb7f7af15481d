"""Chat formatting: roles of transcript lines by a hidden Markov model, and canonical turns.

A transcript is lines of a conversation, some of which start with a speaker's marker. The states are role and whether the
line begins a turn; a line is seen as its marker, its length class, whether it ends in a question mark and whether it is
the first. Transitions and emissions are counted with add-one smoothing from conversations whose roles are known, those
whose conv_id hashes to TRAIN of FOLDS. Viterbi decoding gives the roles; equal roles without a new turn are joined
and written as canonical turns.

Conversations are cut into blocks of BLOCK turn numbers, and Spark deals lines by block, so that a long conversation is
the work of many tasks. Where a conversation has several blocks, each block is first brought to its max-plus matrix (the
best score from every state before it to every state at its end); Viterbi over these few matrices gives the states at the
edges, and each block is decoded between them. Scores are multiples of 1/GRID, so sums are exact and the path is a best
path of the whole conversation. Turns over an edge are joined at the end. Blocks and chains are read as streams: as soon as
Viterbi's survivors share an ancestor, what is before is written out, so memory does not grow with a conversation.

Defined cases: null text is one empty line; null turns come first, in one block; null conv_ids are one conversation; unknown
roles don't train, nor does a step over an edge; repeated rows are turns of their own, one after the other; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from airwave.llm.common import staged

ROLES = ("system", "user", "assistant")
STATES = [(r, begins) for r in ROLES for begins in (True, False)]
#: Markers by style; a transcript uses one style.
STYLES = (
    {"system": "System:", "user": "User:", "assistant": "Assistant:"},
    {"system": "SYSTEM>", "user": "Human>", "assistant": "AI>"},
    {"system": "[system]", "user": "[user]", "assistant": "[assistant]"},
    {"system": "### Instruction", "user": "Q:", "assistant": "A:"},
)
FOLDS, TRAIN = 10, tuple(range(8))
#: Turn numbers in a block; the grid of scores.
BLOCK, GRID = 256, 1 << 20
#: Of ten turns, so many lose their marker in the transcripts that op9 makes.
LOST_MARKERS = 3
_WORDS = {"system": "system", "instruction": "system", "user": "user", "human": "user", "q": "user", "assistant": "assistant", "ai": "assistant", "bot": "assistant", "a": "assistant"}
_MARKER = re.compile(r"\s*(?:#+\s*|\[)?(system|instruction|user|human|q|assistant|ai|bot|a)(?:\]|\s*[:>]|\s*$)\s*", re.IGNORECASE)
_LENGTHS = 12
_SHAPE = (len(ROLES) + 1, _LENGTHS, 2, 2)
_WHITE = " \t\n\r\x0b\x0c"
#: Whether a step from a state (row) to a state begins a turn.
_BEGINS = np.array([[begins or role != before for role, begins in STATES] for before, _ in STATES], np.int64)


def marker(line: str) -> tuple[int, int]:
    """(0 or 1 + the role's place, where the text begins)."""
    m = _MARKER.match(line)
    if not m or (m[1].lower() == "instruction" and "#" not in m[0]):
        return 0, 0
    return 1 + ROLES.index(_WORDS[m[1].lower()]), m.end()


def observation(line: str, first: bool) -> tuple[int, int, int, int]:
    """Marker, length class, question, first line."""
    return marker(line)[0], min(_LENGTHS - 1, len(line).bit_length()), int(line.rstrip().endswith("?")), int(first)


def block_of(size: int) -> Column:
    return F.coalesce(F.floor(F.col("turn") / size), F.lit(-(1 << 63)))


def keyed(turns: DataFrame, size: int = BLOCK) -> DataFrame:
    """Turns with their block and what orders equal turn numbers."""
    own = [c for c in turns.columns if c == "later"]
    keys = [F.xxhash64("text").alias("body"), F.monotonically_increasing_id().alias("copy")]
    return turns.select("conv_id", block_of(size).alias("block"), "turn", "role", *keys, F.coalesce("text", F.lit("")).alias("text"), *own)


def lines(rows: DataFrame, *columns: str) -> DataFrame:
    """The lines of keyed turns in order, dealt by block; rows without a text come before those with one and have one null line."""
    order = ("turn", "role", "body", "copy")
    rows = rows.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", F.col("text").isNotNull(), *order)
    # turns are dealt and sorted before they are split: fewer rows, and the lines stay in order
    rows = rows.select("conv_id", "block", *order, *columns, F.posexplode_outer(F.split("text", "\n")).alias("line_no", "line"))
    return rows.withColumn("begins", F.col("line_no") == 0)


def long_conversations(turns: DataFrame, size: int = BLOCK) -> DataFrame:
    """(conv_id, first_block) of conversations with several blocks."""
    blocks = turns.select("conv_id", block_of(size).alias("block")).groupBy("conv_id").agg(F.min("block").alias("first_block"), F.max("block").alias("last_block"))
    return blocks.where("first_block <> last_block").select("conv_id", "first_block")


def with_later(turns: DataFrame, long: DataFrame | None, how: str, size: int = BLOCK) -> DataFrame:
    """turns (how="inner": those of long conversations) and whether other blocks come before theirs."""
    columns = ("conv_id", "turn", "role", "text")
    if long is None:
        return turns.select(*columns, F.lit(False).alias("later"))
    joined = turns.join(long.withColumnRenamed("conv_id", "long_id"), F.col("conv_id").eqNullSafe(F.col("long_id")), how)
    return joined.select(*columns, F.coalesce(block_of(size) > F.col("first_block"), F.lit(False)).alias("later"))


def transcripts(turns: DataFrame) -> DataFrame:
    """Turns with speakers' markers before their texts: a style for each conversation, some markers lost."""
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES)))
    shown = F.create_map(*(F.lit(x) for i, s in enumerate(STYLES) for r, m in s.items() for x in (f"{i}{r}", m)))
    lost = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(10)) < LOST_MARKERS
    name = F.when(lost, F.lit(None)).otherwise(F.try_element_at(shown, F.concat(style.cast("string"), F.col("role"))))
    return turns.select("conv_id", "turn", "role", F.concat(F.coalesce(F.concat(name, F.lit(" ")), F.lit("")), F.coalesce("text", F.lit(""))).alias("text"))


class Hmm:
    def __init__(self, start: np.ndarray, move: np.ndarray, emit: list[np.ndarray]) -> None:
        on_grid = lambda x: np.round(x * GRID) / GRID
        self.start, self.move, self.emit = on_grid(start), on_grid(move), [on_grid(e) for e in emit]
        self.known: dict[tuple[int, int, int, int], np.ndarray] = {}  # a few hundred observations at most

    def seen(self, line: str, first: bool) -> np.ndarray:
        what = observation(line, first)
        if what not in self.known:
            self.known[what] = sum(e[:, x] for e, x in zip(self.emit, what, strict=True))
        return self.known[what]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted lines with known roles to counts of (what, state, value)."""
    total: dict[tuple[int, int, int], int] = {}
    last = before = None
    for batch in batches:
        for conv, block, line, role, begins, later in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            fresh = (conv, block) != last
            before = None if fresh else before
            if role in ROLES:
                state = STATES.index((role, begins))
                seen = [(k, state, x) for k, x in enumerate(observation(line, fresh and not later))]
                if before is not None:
                    seen.append((5, before, state))
                elif not (fresh and later):
                    seen.append((4, state, 0))
                for key in seen:
                    total[key] = total.get(key, 0) + 1
                before = state
            else:
                before = None
            last = (conv, block)
    if total:
        yield pa.RecordBatch.from_arrays([*(pa.array([k[i] for k in total], pa.int32()) for i in range(3)), pa.array(list(total.values()), pa.int64())], ["what", "state", "value", "n"])


def train(turns: DataFrame, long: DataFrame | None = None, size: int = BLOCK) -> Hmm:
    """Counts are a few hundred numbers, whatever the table; only they come to the driver."""
    known = turns.where(F.pmod(F.xxhash64("conv_id"), F.lit(FOLDS)).isin(*TRAIN))
    rows = lines(keyed(with_later(known, long, "left", size), size), "later").select("conv_id", "block", "line", "role", "begins", "later")
    found = rows.mapInArrow(_counts, "what int, state int, value int, n long").groupBy("what", "state", "value").agg(F.sum("n").alias("n")).collect()
    n = len(STATES)
    emit = [np.ones((n, size)) for size in _SHAPE]
    start, move = np.ones(n), np.ones((n, n))
    for r in found:
        if r.what < 4:
            emit[r.what][r.state, r.value] += r.n
        elif r.what == 4:
            start[r.state] += r.n
        else:
            move[r.state, r.value] += r.n
    log = lambda x: np.log(x / x.sum(axis=-1, keepdims=True))
    return Hmm(log(start), log(move), [log(e) for e in emit])


class Decoder:
    """Viterbi over a stream of steps: gives states as soon as all survivors agree on them."""

    def __init__(self, hmm: Hmm) -> None:
        self.hmm = hmm
        self.begin()

    def begin(self, entry: int | None = None) -> None:
        """A new stream: a whole conversation, or what comes after the state entry."""
        self.entry, self.score, self.back, self.settled = entry, None, [], False

    def step(self, line: str) -> list[int]:
        if self.score is not None:
            return self.advance(self.hmm.move + self.hmm.seen(line, False))
        before = self.hmm.start if self.entry is None else self.hmm.move[self.entry]
        self.score = before + self.hmm.seen(line, self.entry is None)
        return []

    def advance(self, matrix: np.ndarray) -> list[int]:
        """A step whose scores from state (row) to state are given."""
        paths = self.score[:, None] + matrix
        self.back.append(paths.argmax(axis=0))
        self.score = paths.max(axis=0)
        self.score -= self.score.max()
        alive, at = set(range(len(STATES))), len(self.back)
        while at and len(alive) > 1:
            at -= 1
            alive = {int(self.back[at][s]) for s in alive}
        if len(alive) > 1:
            return []
        out = self._trace(alive.pop(), at)
        self.back = self.back[at:]
        # the settled step is written out; it stays only as where the next pointers lead
        self.back[0] = np.zeros_like(self.back[0])
        self.settled = True
        return out

    def _trace(self, state: int, at: int) -> list[int]:
        """States of the steps up to at, the last being state; those written out before are left out."""
        out = [state]
        for k in range(at - 1, -1, -1):
            state = int(self.back[k][state])
            out.append(state)
        out.reverse()
        return out[1:] if self.settled else out

    def end(self, state: int | None = None) -> list[int]:
        """The states that are left, the last one given or the best."""
        out = [] if self.score is None else self._trace(int(self.score.argmax()) if state is None else state, len(self.back))
        self.begin()
        return out


def viterbi(hmm: Hmm, texts: list[str]) -> list[int]:
    decoder, out = Decoder(hmm), []
    for line in texts:
        out += decoder.step(line)
    return out + decoder.end()


_MATRIX = "conv_id long, block long, later boolean, score array<double>, begun array<long>"
_EDGE = "conv_id long, block long, entry int, exit int, n_before long"
_TURN = "conv_id long, turn long, block long, open boolean, role string, text string, n_lines long, n_agree long"


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(schema))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    batch = pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
    rows.clear()
    return batch


def _matrices(hmm: Hmm):
    """Sorted lines (conv_id, block, line, later) to each block's matrix, and the turns that its best paths begin."""
    schema = _arrow(_MATRIX)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        last = score = begun = None
        row, column = np.indices(hmm.move.shape)
        for batch in batches:
            for conv, block, line, later in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (conv, block, later) != last:
                    if last:
                        out.append((*last, score.ravel().tolist(), begun.ravel().tolist()))
                    last = (conv, block, later)
                    score = (hmm.move if later else np.tile(hmm.start, (len(STATES), 1))) + hmm.seen(line, not later)
                    begun = _BEGINS if later else np.ones_like(_BEGINS)
                    continue
                paths = score[:, :, None] + hmm.move
                best = paths.argmax(axis=1)
                score = paths.max(axis=1) + hmm.seen(line, False)
                # the differences between rows matter, so all lose the same
                score -= score.max()
                begun = begun[row, best] + _BEGINS[best, column]
            yield _batch(out, schema)
        if last:
            out.append((*last, score.ravel().tolist(), begun.ravel().tolist()))
            yield _batch(out, schema)

    return go


def _edges(hmm: Hmm):
    """Sorted matrices to the states at the edges of each block and the turns begun before it."""
    schema = _arrow(_EDGE)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        decoder, waiting, last, entry, n = Decoder(hmm), [], None, None, 0

        def take(states: list[int]) -> None:
            nonlocal entry, n
            for state, (conv, block, begun) in zip(states, waiting, strict=False):
                out.append((conv, block, entry, state, n))
                n += int(begun[entry or 0, state])
                entry = state
            del waiting[: len(states)]

        for batch in batches:
            for conv, block, _, score, begun in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                matrix, begun = (np.array(x).reshape(hmm.move.shape) for x in (score, begun))
                if (conv,) != last:
                    take(decoder.end())
                    last, entry, n = (conv,), None, 0
                    decoder.score = matrix[0]
                    waiting.append((conv, block, begun))
                else:
                    waiting.append((conv, block, begun))
                    take(decoder.advance(matrix))
            yield _batch(out, schema)
        take(decoder.end())
        yield _batch(out, schema)

    return go


def _turns(hmm: Hmm):
    """Sorted lines, before them their block's edges if it has any, to turns; open ones may go on in other blocks."""
    schema = _arrow(_TURN)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        decoder, waiting = Decoder(hmm), []
        last, turn = None, None  # turn: [number, role, lines, agreeing lines, whether it came over an edge]
        entry = exit_ = None
        n = 0  # turns begun so far

        def close(at_edge: bool = False) -> None:
            if turn:
                open_ = turn[4] or at_edge
                text = "\n".join(turn[2])
                out.append((last[0], turn[0], last[1], open_, ROLES[turn[1]], text if open_ else text.strip(_WHITE), len(turn[2]), turn[3]))

        def take(states: list[int]) -> None:
            nonlocal turn, n
            for s, (line, role) in zip(states, waiting, strict=False):
                of, begins = s // 2, s % 2 == 0
                over = turn is None and entry is not None and not _BEGINS[entry, s]
                if turn is None or turn[1] != of or begins:
                    close()
                    n += not over
                    turn = [n - 1, of, [], 0, over]
                seen, at = marker(line)
                turn[2].append(line[at:] if seen == 1 + of else line)
                turn[3] += ROLES[of] == role
            del waiting[: len(states)]

        def end() -> None:
            nonlocal turn
            take(decoder.end(exit_))
            close(exit_ is not None)
            turn = None

        for batch in batches:
            for conv, block, line, role, *edge in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (conv, block) != last:
                    end()
                    last, (entry, exit_, n) = (conv, block), edge
                    n = n or 0
                    decoder.begin(entry)
                if line is not None:
                    waiting.append((line, role))
                    take(decoder.step(line))
            yield _batch(out, schema)
        end()
        yield _batch(out, schema)

    return go


def edges(raw: DataFrame, hmm: Hmm, long: DataFrame, size: int = BLOCK) -> DataFrame:
    rows = lines(keyed(with_later(raw, long, "inner", size), size), "later").select("conv_id", "block", "line", "later")
    matrices = rows.mapInArrow(_matrices(hmm), _MATRIX)
    return matrices.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(_edges(hmm), _EDGE)


def decoded(raw: DataFrame, hmm: Hmm, long: DataFrame | None = None, size: int = BLOCK) -> DataFrame:
    """Canonical turns of transcripts: role, text without marker, lines, and lines whose known role agrees.

    long: the conversations with several blocks, None if there are none.
    """
    result = ("conv_id", "turn", "role", "text", "n_lines", "n_agree")
    at_edge = ("entry", "exit", "n_before")
    rows = keyed(raw, size).select("*", *(F.lit(None).cast(k).alias(c) for c, k in zip(at_edge, ("int", "int", "long"), strict=True)))
    if long is not None:
        rows = rows.unionByName(edges(raw, hmm, long, size), allowMissingColumns=True)
    turns = lines(rows, *at_edge).select("conv_id", "block", "line", "role", *at_edge).mapInArrow(_turns(hmm), _TURN)
    if long is None:
        return turns.select(*result)
    turns = staged(turns, "turns")
    parts = F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda x: x["text"])
    joined = turns.where("open").groupBy("conv_id", "turn", "role").agg(
        F.btrim(F.array_join(parts, "\n"), F.lit(_WHITE)).alias("text"), F.sum("n_lines").alias("n_lines"), F.sum("n_agree").alias("n_agree")
    )
    return turns.where("not open").select(*result).unionByName(joined.select(*result))


def parsed(raw: DataFrame, size: int = BLOCK) -> DataFrame:
    """Canonical turns of transcripts by a model that is trained on those whose roles are known."""
    long = staged(long_conversations(raw, size), "long-conversations")
    long = None if long.isEmpty() else long
    return decoded(raw, train(raw, long, size), long, size)


def op9_chat_hmm(conversations: DataFrame) -> DataFrame:
    """Transcripts made of the table's turns, decoded: one row for each canonical turn."""
    raw = transcripts(conversations)
    turns = parsed(raw)
    held_out = ~F.pmod(F.xxhash64("conv_id"), F.lit(FOLDS)).isin(*TRAIN)
    canonical = F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("text"), F.lit("\n<|end|>"))
    return turns.select("conv_id", "turn", "role", canonical.alias("rendered"), "n_lines", "n_agree", held_out.alias("held_out"))
