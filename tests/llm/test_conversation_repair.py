"""Repair against a search that carries whole edit strings, and by its own definition."""

import hashlib
import random
import re
import zlib

import pytest

from airwave.llm import conversation_repair as repair
from tests.conftest import SF

SCHEMA = "conv_id long, turn long, role string, text string, fault string, gone string, key string"
SOLID = re.compile("[^\x20\x09-\x0d]")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def plain(rows):
    """The figures of one conversation's damaged rows (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    faults, seen = [], set()
    for _, role, text in rows:
        solid = SOLID.findall(text)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    ways = {("", ""): (0, "", ())}  # the last initials that matter -> cost, edits, turns; all ways are kept until they are worse

    def grown(ways, options):
        out = {}
        for (done, _), (cost, edits, turns) in ways.items():
            for more, letter, turn in options(done):
                initials = done if turn is None else "s" if turn[0][:1] == "s" else turn[0][:1]
                own = (cost + more, edits + letter, turns if turn is None else (*turns, turn))
                out[initials, ""] = min(out.get((initials, ""), own), own)
        return out

    nexts = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def inserted(ways):
        for _ in range(4):
            more = grown(ways, lambda done: [(2, "I", (names[x], "")) for x in nexts[done] if x in names])
            for k, w in more.items():
                ways[k] = min(ways.get(k, w), w)
        return ways

    # inserts may come before a row in any number, so ways with and without them have to be kept apart by their edits
    for (_, role, text), fault in zip(rows, faults, strict=True):
        before = {}
        for (done, _), way in ways.items():
            for (d, _), w in inserted({(done, ""): way}).items():
                before[d, w[1]] = min(before.get((d, w[1]), w), w)
        out = {}
        for (done, _), (cost, edits, turns) in before.items():
            options = [(3, "D", None)]
            if fault not in ("blank", "duplicate"):
                if role[:1] and role[:1] in nexts[done]:
                    options.append(((fault == "truncated"), "K", (role, text)))
                options += [(2 + (fault == "truncated"), "R", (names[x], text)) for x in nexts[done] if x in names]
            for more, letter, turn in options:
                own = (cost + more, edits + letter, turns if turn is None else (*turns, turn))
                key = (done if turn is None else turn[0][:1], "")
                out[key] = min(out.get(key, own), own)
        ways = out
    last = {}
    for (done, _), way in ways.items():
        for (d, _), w in inserted({(done, ""): way}).items():
            last[d, w[1]] = w
    cost, edits, turns = min(w for (d, _), w in last.items() if d in ("", "a"))
    known = sorted({r[0] for r in rows if r[0] is not None})
    initials = [r[1][:1] for r in rows]
    count = faults.count
    text = "\n".join(f"{r}:{t}" for r, t in turns).encode()
    return (
        known[-1] - known[0] + 1 - len(known) if known else 0, count("blank"), count("duplicate"), count("truncated"),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)), cost, edits, hashlib.sha256(text).hexdigest(),
    )


def expected(rows):
    by = {}
    for r in damaged(rows):
        by.setdefault(r[0], []).append(r[1:])
    return {c: plain(by.get(c, [])) for c in {r[0] for r in rows}}


def made(seed, n=400):
    rnd = random.Random(seed)
    texts = ["Yes.", "No!", "what?", "cut", "", " \n\t", None, "Grüße.", "x. \r\n", "\x1c", "a\nb."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "admin", "User"]
    out = []
    for c in range(n):
        length = rnd.choice((0, 1, 2, 3, 5, 8, 13))
        for t in range(length):
            turn = None if rnd.random() < 0.05 else t * rnd.choice((1, 1, 1, 2)) - rnd.choice((0, 0, 3))
            role = rnd.choice(roles) if rnd.random() < 0.4 else ("user", "assistant")[t % 2]
            out.append((None if c == 7 else c, turn, role, rnd.choice(texts) if rnd.random() < 0.5 else f"text {rnd.randrange(40)}."))
            if rnd.random() < 0.1:
                out.append(out[-1])
    rnd.shuffle(out)
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


@pytest.mark.parametrize("spill", [40, repair.SPILL])
def test_cheapest_edits(spark, monkeypatch, spill):
    monkeypatch.setattr(repair, "SPILL", spill)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    rows = made(1)
    try:
        got = {r.conv_id: tuple(r)[1:] for r in repair.op11_conversation_repair(table(spark, rows)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = expected(rows)
    assert set(got) == set(want)
    for c in want:
        assert got[c] == want[c], c


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/conversations.parquet")
    got = {r.conv_id: tuple(r)[1:] for r in repair.op11_conversation_repair(docs).collect()}
    assert got == expected([(r.conv_id, r.turn, r.role, r.text) for r in docs.collect()])


def test_repaired_turns_read_as_they_should(spark):
    rows = made(2, 60)
    by = {}
    for r in repair.repaired(table(spark, rows)).orderBy("conv_id", "place").collect():
        by.setdefault(r.conv_id, []).append(r)
    for c, turns in by.items():
        assert re.fullmatch("(s?(ua)+)?", "".join(t.role[:1] for t in turns)), c
        assert [t.place for t in turns] == list(range(len(turns)))
        assert all((t.text == "") == (t.edit == "I") for t in turns if t.text is not None and t.edit == "I")


def test_one_giant_conversation_keeps_a_bounded_table(spark):
    """Costs of all states stay near the least, so the table ends; memory does not grow with the turns but for the edits."""
    rnd, automaton = random.Random(4), repair.Automaton()
    one = repair.Conversation("1", automaton)
    for t in range(200_000):
        one.add(str(t), rnd.choice(("user", "assistant", "system", "x")), f"t{t}." * rnd.randrange(8), rnd.random() < 0.2, rnd.random() < 0.1, rnd.random() < 0.2)
    assert len(automaton.columns) < 400 and one.file is not None
    edits = list(one.edits())
    letters = "".join(edits)
    assert one.cost == 3 * letters.count("D") + 2 * letters.count("R") + 2 * letters.count("I") + sum(1 for e, s in zip(edits, shorts(4), strict=False) if s and e[-1:] in "KR")
    assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for _, r, _ in one.repaired(iter(edits))))
    one.close()


def shorts(seed):
    """Which turns of the giant conversation are truncated and neither blank nor repeated."""
    rnd = random.Random(seed)
    for _ in range(200_000):
        rnd.choice(("user", "assistant", "system", "x"))
        rnd.randrange(8)
        again, blank, short = rnd.random() < 0.2, rnd.random() < 0.1, rnd.random() < 0.2
        yield short and not again and not blank


def test_empty_table(spark):
    assert repair.op11_conversation_repair(table(spark, [])).count() == 0
