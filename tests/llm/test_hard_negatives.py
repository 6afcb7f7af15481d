"""Hard negatives against all products, for odd rows and for blocks and groups of several sizes."""

import collections
import math
import random

import duckdb
import numpy as np
import pytest

from airwave.llm import hard_negatives
from tests.conftest import SF

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v string, score string, rank string"


def brute(rows):
    own = []
    for i, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = math.fmod(label + 1, 10) if i is not None and i % 7 == 0 else label
        own.append((i, label, [int(math.floor(256 * float(np.float32(x)))) for x in vector]))
    order = lambda x: (-x[1], x[0] is None, x[0] or 0)
    out = collections.Counter()
    for a, (i, label, v) in enumerate(own):
        if i is None or i % 100:
            continue
        scored = [(j, sum(x * y for x, y in zip(v, w, strict=False)), m) for b, (j, m, w) in enumerate(own) if b != a]
        for p, p_score, _ in sorted((x for x in scored if x[2] == label), key=order)[:5]:
            window = [x for x in scored if x[2] != label and 30 * p_score <= 100 * x[1] <= 90 * p_score]
            for rank, (j, score, _) in enumerate(sorted(window, key=order)[:10], 1):
                cut = lambda x: max(-(2**63) + 1, min(2**63 - 1, x))
                out[i, p, rank, j, cut(p_score), cut(score)] += 1
    return out


def made(seed):
    rnd = np.random.default_rng(seed)
    py = random.Random(seed)
    centres = rnd.normal(size=(12, 9))
    rows = [(int(i), [float(x) for x in centres[i % 12] + rnd.normal(size=9) * 0.3], int((i % 12) % 5)) for i in range(900)]
    same = [0.5] * 9
    rows += [(int(i), same, 3 if i % 2 else 4) for i in range(1000, 1330)]  # ties
    rows += [(100, rows[100][1], 1), rows[300], rows[300], rows[55], rows[55]] + [rows[200]] * 14 + [rows[777]] * 12
    rows += [(2000, None, 1), (2001, same, None), (2002, [1.0, None], 1), (2003, [float("nan")], 2), (2004, [float("inf")] * 9, 2), (None, same, 3), (None, rows[3][1], 2)]
    rows += [(2100, [], 1), (2101, [1.0, 2.0], 1), (2200, [0.0] * 9, 0), (2300, [-x for x in same], 0), (-700, rows[8][1], 2), (2400, [1.0] * 12, 4)]
    py.shuffle(rows)
    return rows


def found(df):
    return collections.Counter((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


@pytest.mark.parametrize("block, at_once", [(64, 5), (hard_negatives.BLOCK, hard_negatives.ANCHORS)])
def test_windows_are_exact(spark, monkeypatch, block, at_once):
    monkeypatch.setattr(hard_negatives, "TASK_BLOCKS", 3)
    rows = made(1)
    df = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA).repartition(4)
    got = found(hard_negatives.mined(df, block, at_once))
    assert got == brute(rows) and got


def test_numbers_beyond_doubles(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.choice((1e30, 3e38, 1.5, -1e20, 2.0**40)) * rnd.random() for _ in range(4)], i % 3) for i in range(150)]
    rows += [(1000 + i, [float(rnd.randrange(1 << 22)) for _ in range(4)], i % 3) for i in range(150)]
    df = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA)
    assert found(hard_negatives.mined(df, 32)) == brute([(i, [float(np.float32(x)) for x in v], m) for i, v, m in rows])


def test_whole_table_and_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    cur = con.execute(hard_negatives.OP12_SQL)
    names = [d[0] for d in cur.description]
    want = collections.Counter(tuple(dict(zip(names, r, strict=True))[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in cur.fetchall())
    assert found(hard_negatives.op12_hard_negatives(spark.read.parquet(f"{SF}/embeddings.parquet"))) == want and want


def test_cells_come_in_falling_order_and_bounds_hold():
    rnd = np.random.default_rng(5)
    m = np.floor(rnd.normal(size=(800, 16)) * 60)
    books = hard_negatives.fitted(m, 8)
    cells = np.stack([hard_negatives.nearest(h, b) for h, b in zip(hard_negatives.halves(m), books, strict=True)], axis=1)
    block = hard_negatives.Block(np.arange(800), np.zeros(800), np.ones(800), m, cells, books)
    for q in m[:20]:
        seen, last = 0, np.inf
        for up, low, a, b in block.visits(q):
            scores = block.vectors[a:b] @ q
            assert up <= last + 1e-9 and low <= scores.min() and scores.max() <= up
            seen, last = seen + b - a, up
        assert seen == 800


def test_search_stops_before_the_end():
    """On clustered rows the certificate spares cells."""
    rnd = np.random.default_rng(6)
    centres = rnd.normal(size=(40, 8)) * 100
    m = np.floor(np.repeat(centres, 50, axis=0) + rnd.normal(size=(2000, 8)))
    books = hard_negatives.fitted(m, 40)
    cells = np.stack([hard_negatives.nearest(h, b) for h, b in zip(hard_negatives.halves(m), books, strict=True)], axis=1)
    block = hard_negatives.Block(np.arange(2000), np.zeros(2000), np.ones(2000), m, cells, books)
    rows, whole = [], block.scores
    block.scores = lambda q, at: rows.extend(at) or whole(q, at)
    best = hard_negatives.Best(6)
    hard_negatives.searched(block, m[0], [best], lambda at: np.zeros(len(at), bool))
    assert [r[0] for r in best.rows] == sorted((m @ m[0]).tolist(), reverse=True)[:6] and len(rows) < 600


def test_empty_table(spark):
    assert hard_negatives.op12_hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0
