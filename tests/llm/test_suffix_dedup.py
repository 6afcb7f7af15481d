"""op6 against all 200-byte strings, with its slices, salts and joins forced to every form."""

import collections
import hashlib
import random
import time

import numpy as np
import pytest

from airwave.llm import suffix_dedup
from tests.llm.test_operators import by_id, docs, rows  # noqa: F401


def brute(data):
    """(bytes, removed, spans, hash of the rest) of each text."""
    count = collections.Counter(d[i : i + 200] for d in data for i in range(len(d) - 199))
    for d in data:
        gone = np.zeros(len(d) + 1, int)
        for i in range(len(d) - 199):
            if count[d[i : i + 200]] > 1:
                gone[i : i + 200] = 1
        kept = bytes(c for c, g in zip(d, gone[:-1], strict=True) if not g)
        yield len(d), int(gone.sum()), int((np.diff(gone, prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()


def figures(df):
    return collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


@pytest.mark.parametrize("form", ["plain", "all hot", "shuffled", "short chunks"])
def test_suffix_dedup(docs, rows, monkeypatch, form):  # noqa: F811
    if form == "all hot":
        monkeypatch.setattr(suffix_dedup, "LEAST_HOT", 0)
        monkeypatch.setattr(suffix_dedup, "HOT_SHARE", 0)
    if form == "shuffled":
        monkeypatch.setattr(suffix_dedup, "BROADCAST_BYTES", -1)
    if form == "short chunks":
        docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        want = collections.Counter((r[0], *f) for r, f in zip(rows, brute([(r[1] or "").encode() for r in rows]), strict=True))
        assert figures(suffix_dedup.op6_suffix_dedup(docs)) == want
    finally:
        docs.sparkSession.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_random_texts_of_few_words(spark):
    """Chance repeats around anchors at every distance, cut anywhere, with periodic stretches."""
    rnd = random.Random(11)
    phrases = ["".join(rnd.choice("abcdef ") for _ in range(rnd.choice([30, 64, 100, 170, 230, 400]))) for _ in range(12)]
    texts = []
    for _ in range(120):
        parts = [rnd.choice(phrases)[rnd.randrange(20) :] if rnd.random() < 0.8 else "xy" * rnd.randrange(300) for _ in range(rnd.randrange(1, 9))]
        texts.append("".join(parts))
    texts += texts[:5] * 3
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    want = collections.Counter((i, *f) for i, f in enumerate(brute([t.encode() for t in texts])))
    assert figures(suffix_dedup.op6_suffix_dedup(df)) == want


def test_long_texts_cross_slices(spark, monkeypatch):
    """A text of several slices of CHUNK bytes with a passage over an edge that another text holds."""
    rnd = np.random.default_rng(3)
    long = "".join(map(chr, rnd.integers(97, 123, 3 * suffix_dedup.CHUNK + 500)))
    at = suffix_dedup.CHUNK - 150
    other = "head " + long[at : at + 400] + " and an end of its own"
    df = spark.createDataFrame([(1, long), (2, other)], "doc_id long, text string")
    got = {r.doc_id: r for r in suffix_dedup.repeats(df).collect()}
    assert [(s.start, s.end) for s in got[1].removed] == [(at, at + 400)]
    assert [(s.start, s.end) for s in got[2].removed] == [(5, 405)]


def test_equal_rows_take_linear_time(spark):
    rnd = random.Random(4)
    text = " ".join(f"w{rnd.randrange(10**6)}" for _ in range(2800))
    df = spark.createDataFrame([(7, text)] * 2000 + [(i, text[: 50 * i]) for i in range(30)], "doc_id long, text string").repartition(16)
    began = time.time()
    got = suffix_dedup.op6_suffix_dedup(df).collect()
    assert time.time() - began < 60
    assert len(got) == 2030 and all(r.n_removed == (len(text) if r.doc_id == 7 else 50 * r.doc_id if 50 * r.doc_id >= 200 else 0) for r in got if r.doc_id != 7 or r.n_bytes == len(text))


def test_a_passage_that_all_documents_hold_is_dealt_over_tasks(spark):
    """Its anchors are hot, so their rows carry salts; the result is that of brute force."""
    rnd = random.Random(6)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(500))
    word = lambda: "".join(rnd.choice("ijklmnop") for _ in range(rnd.randrange(3, 9)))
    text = lambda: " ".join(word() for _ in range(rnd.randrange(20, 60)))
    texts = [text() + passage + text() for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(10)
    hot = suffix_dedup.hot_anchors(df)
    assert 0 < len(hot) < 40
    want = collections.Counter((i, *f) for i, f in enumerate(brute([t.encode() for t in texts])))
    assert figures(suffix_dedup.op6_suffix_dedup(df)) == want


def test_runs_hold_every_string_once(rows, monkeypatch):  # noqa: F811
    texts = [(r[1] or "").encode() for r in rows]
    want = [(i, s) for i, d in enumerate(texts) for s in range(len(d) - 199)]
    for chunk in (suffix_dedup.CHUNK, 700):
        monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
        got = []
        for data, text, bounds, at in suffix_dedup.pieces(texts):
            _, _, part, first, n, spot = suffix_dedup.runs(data, bounds)
            assert ((spot >= first + n - 1) & (spot <= first + 200 - suffix_dedup.ANCHOR)).all()
            got += [(int(text[p]), int(f - bounds[p] + at[p]) + k) for p, f, m in zip(part, first, n, strict=True) for k in range(m)]
        assert sorted(got) == want
