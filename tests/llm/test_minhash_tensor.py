"""Tensored banding against all pairs, and pivots and cells against all pairs of a bucket."""

import itertools
import random
import time

import numpy as np
import pytest

from airwave.llm import minhash_tensor, near_duplicates, pivot_links
from tests.conftest import SF

SCHEMA = "doc_id long, text string, key string, fp string, n_shingles string, root string, kept string"


def brute(rows):
    """(n_shingles, component_id) of each row (doc_id, text), by all pairs of texts."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[a : a + 3]) for a in range(max(1, len(w) - 2))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)]


def made(seed):
    rnd = random.Random(seed)
    word = lambda: f"W{rnd.randrange(400)}é"
    out = []
    for n in (3, 6, 14, 40, 90, 250, 800):
        for _ in range(3):
            base = [word() for _ in range(n)]
            for changes in (0, 0, 1, 1, 2, 3, 4, n // 40, n // 25, n // 15):
                own = list(base)
                for at in rnd.sample(range(n), min(n, changes)):
                    own[at] = word()
                out.append(" ".join(own) if rnd.random() < 0.5 else "\n\x0b".join(own).lower())
    out += [None, None, "", " \n", "one two", "ONE  two", "one two three", "one", "one", "x\x1cy z"]
    rnd.shuffle(out)
    rows = [(int(i), t) for i, t in enumerate(out)]
    rows += [rows[5], rows[5], (None, rows[9][1]), (None, "nobody has this text or an id"), (None, None), (None, "")]
    return rows


def comparable(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


@pytest.mark.parametrize("block, pivots", [(3, False), (3, True), (pivot_links.BLOCK, True)])
def test_components_of_all_similar_pairs(spark, monkeypatch, block, pivots):
    monkeypatch.setattr(minhash_tensor, "similar", lambda m, s, least, b: (pivot_links.similar if pivots else all_in_cells)(m, s, least, block))
    rows = made(5)
    docs = spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], SCHEMA).repartition(5)
    got = minhash_tensor.op13_minhash_tensor(docs).collect()
    want = brute(rows)
    assert comparable((r.doc_id, r.n_shingles, r.component_id) for r in got) == comparable((d, n, c) for (d, _), (n, c) in zip(rows, want, strict=True))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def all_in_cells(member, sets, least, block):
    member = member.select("bucket", "fp").withColumn("root", member["fp"])
    return pivot_links.in_cells(pivot_links.with_middle(member), sets, least, block)


def test_buckets_of_a_family_are_merged_where_that_saves_pairs(spark):
    """Ten buckets of nearly the same members become one; a chain of small buckets stays as it is; no two members of a bucket part."""
    rows = [(b, fp, fp) for b in range(10) for fp in range(12) if fp != b]
    chain = [(100 + b, 1000 + b + i, 1000 + b + i) for b in range(0, 40) for i in (0, 1)]
    got = pivot_links.merged(spark.createDataFrame([*rows, *chain], "bucket long, fp long, root long")).collect()
    by = {}
    for r in got:
        by.setdefault(r.bucket, set()).add(r.fp)
    assert sorted(len(v) for v in by.values()) == [2] * 40 + [12]
    assert {frozenset(v) for v in by.values()} == {frozenset(range(12))} | {frozenset((1000 + b, 1001 + b)) for b in range(40)}
    assert len(got) == 12 + 80


def test_few_pairs_are_dealt_in_small_blocks():
    assert pivot_links.block_size(0, 200, 2048) == pivot_links.LEAST_BLOCK
    assert pivot_links.block_size(4_500_000, 211, 2048) == 51
    assert pivot_links.block_size(1e12, 200, 2048) == 2048
    assert pivot_links.block_size(1e12, 200, 3) == 3


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_tensor.op13_minhash_tensor(docs).collect()}
    assert got == {d: w for (d, _), w in zip(rows, brute(rows), strict=True)}


def test_tables_rarely_miss_at_the_limit():
    """By formula 4 pairs in a million at 0.85; here none of 400."""
    assert 1 - (1 - (1 - 0.85**minhash_tensor.ROWS) ** minhash_tensor.SIDE) ** 2 < 5e-6
    rnd = np.random.default_rng(1)
    for _ in range(400):
        h = rnd.integers(0, 1 << 63, 100, dtype=np.uint64)
        a, b = minhash_tensor.hashes(np.unique(h[:93])), minhash_tensor.hashes(np.unique(h[8:]))
        same = a == b
        assert same[: minhash_tensor.SIDE].any() and same[minhash_tensor.SIDE :].any()


def test_large_family_in_linear_rows(spark):
    """20,000 different near copies share nearly all keys: a row or two for each and no all-pairs cells."""
    rnd = random.Random(2)
    base = [f"b{i}" for i in range(200)]
    rows = []
    for i in range(20_000):
        own = list(base)
        own[rnd.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(own), "a", "b", "c", "d", "e"))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(8)
    began = time.time()
    got = minhash_tensor.op13_minhash_tensor(docs).collect()
    assert {r.component_id for r in got} == {0}
    assert time.time() - began < 120
    sets = [near_duplicates.shingles(r[1].encode().split(), 3) for r in rows[:2]]
    assert len(sets[0]) == 198


def test_empty_table(spark):
    assert minhash_tensor.op13_minhash_tensor(spark.createDataFrame([], SCHEMA)).count() == 0


def test_family_about_the_limit(spark):
    """Members of which few are similar to the first pivot, outsiders, and a second family that one text joins to the first."""
    rnd = random.Random(8)
    base = [f"b{i}" for i in range(90)]
    rows = []
    for i in range(240):
        own = base[:45] + [f"c{j}" for j in range(45)] if i % 5 == 4 else list(base)
        for at in rnd.sample(range(90), 1 + i % 3):
            own[at] = f"x{i}"
        rows.append((i, " ".join(own)))
    docs = spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], SCHEMA).repartition(4)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in minhash_tensor.op13_minhash_tensor(docs).collect())
    assert got == [(d, n, c) for (d, _), (n, c) in zip(rows, brute(rows), strict=True)]
    assert len({c for _, _, c in got}) > 2
