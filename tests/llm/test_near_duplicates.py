"""Near duplicates against brute force on all pairs, and against the pairs that the 2-bit rule leaves."""

import itertools
import random
from fractions import Fraction

import numpy as np
import pytest

import corpus_pipeline
from airwave.llm import near_duplicates
from tests.conftest import SF

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(texts, least=Fraction(4, 5)):
    """The kept ids where each text has one id: the least of each component."""
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[a : a + 5]) for a in range(max(1, len(w) - 4))}
    root = {i: i for i in sets}
    find = lambda x: x if root[x] == x else find(root[x])
    for a, b in itertools.combinations(sorted(sets), 2):
        if Fraction(len(sets[a] & sets[b]), len(sets[a] | sets[b])) >= least:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return sorted({find(i) for i in sets})


def texts():
    rnd = random.Random(8)
    word = lambda: f"w{rnd.randrange(500)}"
    out = []
    for n in (5, 12, 40, 150, 400):
        for _ in range(4):
            base = [word() for _ in range(n)]
            for changes in (0, 0, 1, 2, 3, 5, n // 20, n // 10):
                own = list(base)
                for at in rnd.sample(range(n), min(n, changes)):
                    own[at] = word()
                out.append(" ".join(own) if rnd.random() < 0.5 else "\n".join(own).upper())
    out += [None, "", " \n", "one two", "ONE  two", "one two three"]
    rnd.shuffle(out)
    return dict(enumerate(out))


@pytest.mark.parametrize("block", [3, 2048])
def test_keeps_the_least_of_each_similar_group(spark, monkeypatch, block):
    monkeypatch.setattr(near_duplicates.components, "__defaults__", (block,))
    found = texts()
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in found.items()], SCHEMA)
    assert sorted(r.doc_id for r in near_duplicates.keep_one(docs).collect()) == brute(found)


def test_stage_finds_what_differs_in_many_bits(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {r.doc_id: r.text for r in docs.collect()}
    rows = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, SF).collect()
    assert sorted(r.doc_id for r in rows) == brute(found)


def test_buckets_rarely_miss_at_the_limit():
    """Pairs of similarity 0.8 share a bucket but for 3 in a million."""
    rnd = np.random.default_rng(1)
    for _ in range(300):
        h = rnd.integers(0, 1 << 63, 100, dtype=np.uint64)
        a, b = np.unique(h[:90]), np.unique(h[10:])
        assert set(near_duplicates.buckets(a).tolist()) & set(near_duplicates.buckets(b).tolist())


def test_simhash_index_proposes(spark, monkeypatch):
    """With no hashes of minima the SimHash index still finds copies that differ in no or few bits; the exact check decides."""
    rnd = random.Random(3)
    base = [f"w{rnd.randrange(5000)}" for _ in range(3000)]
    changed = ([*base[:at], "changed", *base[at:]] for at in range(100, 3000, 10))
    bits = lambda t: near_duplicates.simhash(" ".join(t).encode())
    near = next(t for t in changed if 1 <= (bits(t) ^ bits(base)).bit_count() <= 2)
    other = [f"v{rnd.randrange(5000)}" for _ in range(3000)]
    docs = spark.createDataFrame([(i, " ".join(t), "en", "s", None) for i, t in enumerate((base, near, other))], SCHEMA)
    monkeypatch.setattr(near_duplicates, "_marks", lambda b, own=near_duplicates._marks: own(b) | {"buckets": [[]] * b.num_rows})
    assert sorted(r.doc_id for r in near_duplicates.keep_one(docs).collect()) == [0, 2]


def test_batches_are_worked_on_in_slices(spark):
    from airwave.llm.common import SLICE, map_batches

    most = map_batches(spark.range(5000).coalesce(1), lambda b: {"n": [b.num_rows]}, "n long", slices=True).collect()
    assert sum(r.n for r in most) == 5000 and max(r.n for r in most) <= SLICE
