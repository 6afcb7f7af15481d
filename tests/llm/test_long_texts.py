"""Whole queries on texts that cross the operators' inner slices, and on keys that hold most rows."""

import collections
import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from airwave.llm import bloom_lm, simhash_gray
from tests.llm.test_operators import components_brute, simhash_brute


def test_fingerprint_of_a_text_of_several_chunks(spark):
    rnd = random.Random(2)
    text = " ".join(f"w{rnd.randrange(5000)}" for _ in range(simhash_gray._CHUNK + 9000))
    got = simhash_gray.op4_simhash_gray(spark.createDataFrame([(1, text), (2, text + " x"), (3, "short one")], "doc_id long, text string")).collect()
    assert {r.doc_id: int(r.fingerprint, 16) for r in got} == {1: simhash_brute(text), 2: simhash_brute(text + " x"), 3: simhash_brute("short one")}


def test_scores_of_a_text_of_several_slices(spark):
    rnd = random.Random(3)
    texts = [" ".join(f"w{rnd.randrange(900)}" for _ in range(n)) for n in (bloom_lm.SLICE + 50_000, 30, 7)]
    got = {r.doc_id: r for r in bloom_lm.scores(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    tokens = [[*t.split(), None] for t in texts]
    count = collections.Counter(x for i, ws in enumerate(tokens) for x in ws if zlib.crc32(str(i).encode()) % 7 != 2)
    total = sum(count.values()) + len(count) + 1
    for i, ws in enumerate(tokens):
        base = sum(math.log10((count[x] + 1) / total) for x in ws)
        assert got[i].n_tokens == len(ws) and math.isclose(got[i].base_score, base, rel_tol=1e-9) and got[i].score < 0


def test_components_around_one_fingerprint(spark):
    """All fingerprints within two bits of one, and chains that hang on it: one component with a hot root."""
    rnd = np.random.default_rng(5)
    root = 0x1234_5678_9ABC_DEF0
    fps = {root} | {root ^ (1 << a) for a in range(64)} | {root ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)}
    fps |= {int(x) for x in rnd.integers(0, 1 << 63, 50)}
    df = spark.createDataFrame([(simhash_gray.signed(f),) for f in fps], "fp long")
    stars = simhash_gray.star_components(simhash_gray.near_links(df))
    assert stars.groupBy("root").count().agg(F.max("count")).first()[0] == 64 + 64 * 63 // 2
    small = set(list(fps)[:300])
    got = simhash_gray.star_components(simhash_gray.near_links(spark.createDataFrame([(simhash_gray.signed(f),) for f in small], "fp long"))).count()
    want = components_brute(small)
    assert got == len(small) - len(set(want.values()))


def test_equal_rows_of_one_key_keep_one(spark):
    """A third of all rows are equal; only rows that go or repeat are gathered."""
    rnd = random.Random(7)
    body = " ".join(f"w{rnd.randrange(9000)}" for _ in range(60))
    rows = [(5, body)] * 400 + [(i, " ".join(f"v{rnd.randrange(9000)}" for _ in range(40))) for i in range(1000, 1800)] + [(9, body)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    kept = [r.doc_id for r in simhash_gray.keep_one(docs).collect()]
    assert sorted(kept) == [5, *range(1000, 1800)]
