"""Hard negatives by an inverted multi-index with certified windows.

A vector is split into halves. Two codebooks, one for each half, are fitted by k-means on SAMPLE rows at most; every row is in the
cell of its nearest words. Rows are range-sorted by cell and held in blocks of BLOCK rows at most, each with the radii of its
halves' clusters. For an anchor q a cluster of a half bounds its rows' half scores: q.c + |q| r from above, q.c - |q| r from
below. Cells are visited by a heap over pairs of clusters in falling order of the summed upper bounds (multi-sequence search); the search of a
block ends when no cell left can better what the anchor has, which is carried from block to block. So results are exact: recall is 1.

Two passes: the first finds each anchor's POSITIVES best rows of its label; each has a window of scores, 30 to 90 % of its own, and
the second finds the first NEGATIVES rows of other labels in each window. It skips cells that lie above all windows, and ends where the
upper bounds fall below all windows' ends or tenth scores. Anchors are the stated query set; ANCHORS of them at most are broadcast at once and meet every
block, so the index is read twice for so many anchors; a task keeps the best rows of these anchors and gives them out once.

Components are whole numbers and a score is their product, summed exactly: in doubles where the largest sum stays below 2**53, with
Python's integers beyond that. Vectors of unequal length are compared as if the shorter one ended in zeros.

Defined cases: rows with a null label or vector, or a component that is null or not finite (256 times as large, too), take no part; empty vectors have
score 0. Equal rows are told apart by number only: each is a row, as anchor, positive and negative. A null id is no anchor and comes after
all others among equal scores. Scores that a long cannot hold are cut to its ends in the result (not in the comparisons). An empty table gives an
empty result; columns besides vec_id, embedding and label, whatever their names, are not read.
"""

from __future__ import annotations

import heapq
import itertools
import pickle
from collections.abc import Iterator
from decimal import Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from airwave.llm.common import map_batches, shuffle_width, staged

#: Rows that codebooks are fitted on, rows of a block, anchors that are broadcast at once, and rows that are scored at once.
SAMPLE, BLOCK, ANCHORS, STEP = 16_384, 16_384, 65_536, 512
#: Blocks that a task takes one after the other, so that its best rows are given out once for all of them.
TASK_BLOCKS = 64
#: Rows to a cell that the number of words aims at, the most words of a codebook, and rounds of k-means.
CELL_ROWS, WORDS, FITTED = 64, 256, 6
POSITIVES, NEGATIVES = 5, 10
#: Percent of the positive's score that bound a window.
WINDOW = (30, 90)
EVERY = 100
LABELS = 10
EXACT = 2.0**53
_LONG = (1 << 63) - 1
LAST = _LONG  # where a null id stands

Codebooks = tuple[np.ndarray, np.ndarray]


def _scaled(batch: pa.RecordBatch) -> dict[str, list]:
    """Rows that take part, their whole components as bytes."""
    out: dict[str, list] = {"id": [], "label": [], "v": []}
    for i, vector, label in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        if label is None or vector is None or any(x is None for x in vector):
            continue
        v = np.floor(256.0 * np.array(vector, float))
        if np.isfinite(v).all():
            out["id"].append(LAST if i is None else i)
            out["label"].append(label)
            out["v"].append((v + 0.0).tobytes())
    return out


def rows_of(embeddings: DataFrame) -> DataFrame:
    """(id, label, v, n): distinct rows that take part, and how many are equal to each."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    rows = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), label.cast("long"))
    return map_batches(rows, _scaled, "id long, label long, v binary").groupBy("id", "label", "v").agg(F.count("*").alias("n"))


def matrix(vectors: list[bytes], size: int) -> np.ndarray:
    out = np.zeros((len(vectors), size))
    for row, v in zip(out, vectors, strict=True):
        own = np.frombuffer(v)
        row[: len(own)] = own
    return out


def halves(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return m[:, : m.shape[1] // 2], m[:, m.shape[1] // 2 :]


def nearest(half: np.ndarray, words: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        return np.argmin((words**2).sum(axis=1) - 2 * half @ words.T, axis=1)


def fitted(sample: np.ndarray, words: int) -> Codebooks:
    """A codebook for each half, by k-means from spread-out rows."""
    books = []
    for half in halves(sample):
        book = half[np.linspace(0, len(half) - 1, min(words, len(half))).astype(int)] if len(half) else np.zeros((1, half.shape[1]))
        for _ in range(FITTED):
            near = nearest(half, book)
            n = np.bincount(near, minlength=len(book))
            sums = np.zeros_like(book)
            np.add.at(sums, near, half)
            book = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], book)
        books.append(book)
    return books[0], books[1]


def codebooks(rows: DataFrame, count: int, size: int) -> Codebooks:
    """From rows of small hashes, about SAMPLE of them, as many on any number of partitions."""
    share = max(1, count // SAMPLE)
    found = rows.where(F.pmod(F.xxhash64("v", "id", "label"), F.lit(share)) == 0).select("v").limit(2 * SAMPLE).toArrow()  # bounded
    words = int(min(WORDS, max(2, (count / CELL_ROWS) ** 0.5)))
    return fitted(matrix(sorted(found.column(0).to_pylist()), size), words)


class Block:
    """Rows of neighbouring cells, with bounds of their clusters' half scores."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, counts: np.ndarray, vectors: np.ndarray, cells: np.ndarray, books: Codebooks) -> None:
        order = np.lexsort((cells[:, 1], cells[:, 0]))
        self.ids, self.labels, self.counts, self.vectors, cells = ids[order], labels[order], counts[order], vectors[order], cells[order]
        self.words, self.radius, own = [], [], []
        for k, (half, book) in enumerate(zip(halves(self.vectors), books, strict=True)):
            used, place = np.unique(cells[:, k], return_inverse=True)
            with np.errstate(over="ignore", invalid="ignore"):
                away = np.sqrt(((half - book[used][place]) ** 2).sum(axis=1))
            radius = np.zeros(len(used))
            np.maximum.at(radius, place, np.where(np.isfinite(away), away, np.inf))
            self.words.append(book[used])
            self.radius.append(radius)
            own.append(place)
        cut = np.flatnonzero(np.any(cells[1:] != cells[:-1], axis=1)) + 1
        starts, ends = np.concatenate(([0], cut)), np.concatenate((cut, [len(cells)]))
        self.cells = {(int(own[0][a]), int(own[1][a])): (int(a), int(b)) for a, b in zip(starts, ends, strict=True)}
        self.by_first = [[] for _ in self.words[0]]
        for i, j in self.cells:
            self.by_first[i].append(j)

    def bounds(self, q: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(upper, lower) of the half scores of each half's clusters; widened by what doubles may have rounded."""
        out = []
        for half, words, radius in zip(halves(q[None]), self.words, self.radius, strict=True):
            length = np.sqrt((half**2).sum())
            middle, reach = words @ half[0], np.where(radius > 0, radius * length, 0.0)
            reach = reach + 1e-9 * (np.abs(middle) + reach + np.abs(words) @ np.abs(half[0])) + 1e-9
            out.append((middle + reach, middle - reach))
        return out

    def visits(self, q: np.ndarray) -> Iterator[tuple[float, float, int, int]]:
        """(upper bound, lower bound, first row, end) of the block's cells, in falling order of the upper bound.

        A row of the heap is the best cell left of a cluster of the first half, its clusters of the second half standing in order of
        their bounds; cells without rows are never in the heap.
        """
        (up, low), (up2, low2) = self.bounds(q)
        rows = [sorted(js, key=lambda j: (-up2[j], j)) for js in self.by_first]
        heap = [(-(up[i] + up2[js[0]]), i, 0) for i, js in enumerate(rows) if js]
        heapq.heapify(heap)
        while heap:
            bound, i, at = heap[0]
            j = rows[i][at]
            if at + 1 < len(rows[i]):
                heapq.heapreplace(heap, (-(up[i] + up2[rows[i][at + 1]]), i, at + 1))
            else:
                heapq.heappop(heap)
            yield -bound, low[i] + low2[j], *self.cells[i, j]

    def scores(self, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        rows = self.vectors[at]
        if np.abs(q).max(initial=0) * np.abs(rows).max(initial=0) * max(1, len(q)) < EXACT:
            return rows @ q
        whole = [int(x) for x in q]
        return np.array([sum(int(x) * y for x, y in zip(r, whole, strict=True)) for r in rows], dtype=object)


class Best:
    """The first n rows of a range of scores, higher scores first and then smaller ids; equal rows count as often as they are there."""

    def __init__(self, n: int, low: float = -np.inf, high: float = np.inf) -> None:
        self.n, self.low, self.high, self.rows, self.full = n, low, high, [], False

    @property
    def least(self) -> float:
        """A score below this changes nothing."""
        return self.rows[-1][0] if self.full else self.low

    def add(self, scores: np.ndarray, block: Block, at: np.ndarray, out: np.ndarray) -> None:
        """out: which rows do not count."""
        ok = np.flatnonzero((scores >= self.least) & (scores <= self.high) & ~out)
        if len(ok) > 4 * self.n and scores.dtype != object:  # only what may be among the first
            ok = ok[scores[ok] >= np.partition(scores[ok], len(ok) - self.n)[len(ok) - self.n]]
        if len(ok):
            found = [(scores[i], int(block.ids[at[i]]), int(block.labels[at[i]]), block.vectors[at[i]].tobytes(), int(block.counts[at[i]])) for i in ok]
            self.merge(found)

    def merge(self, found: list[tuple]) -> None:
        kept, n = [], 0
        for row in sorted(self.rows + found, key=lambda r: (-r[0], *r[1:4])):
            if n >= self.n:
                break
            kept.append((*row[:4], min(row[4], self.n - n)))
            n += kept[-1][4]
        self.rows, self.full = kept, n >= self.n


def searched(block: Block, q: np.ndarray, wanted: list[Best], out) -> None:
    """Visits cells until none left can add to what is wanted; out(rows) says which rows do not count."""
    waiting: list[tuple[int, int]] = []
    n, step = 0, 32  # cells are scored together, more as the search goes on

    def score() -> None:
        at = np.concatenate([np.arange(a, b) for a, b in waiting])
        scores, no = block.scores(q, at), out(at)
        for w in wanted:
            w.add(scores, block, at, no)
        waiting.clear()

    high = max((w.high for w in wanted), default=-np.inf)
    for up, low, a, b in block.visits(q):
        if all(up < w.least for w in wanted):
            break
        if low <= high:
            waiting.append((a, b))
            n += b - a
            if n >= step:
                score()
                n, step = 0, min(STEP, 2 * step)
    if waiting:
        score()


def index(rows: DataFrame, books: Codebooks, size: int, count: int, block: int = BLOCK) -> DataFrame:
    """(data): every row, in blocks of neighbouring cells; a hot cell is as many blocks as it needs."""

    def placed(batch: pa.RecordBatch) -> dict[str, list]:
        first, second = (nearest(h, b) for h, b in zip(halves(matrix(batch.column(2).to_pylist(), size)), books, strict=True))
        return {"id": batch.column(0), "label": batch.column(1), "v": batch.column(2), "n": batch.column(3), "i": first, "j": second}

    cells = map_batches(rows.select("id", "label", "v", "n"), placed, "id long, label long, v binary, n long, i int, j int")
    spread = [F.col("i"), F.col("j"), F.xxhash64("id", "v")]
    tasks = max(shuffle_width(rows.sparkSession), -(-count // (TASK_BLOCKS * block)))
    ordered = cells.repartitionByRange(tasks, *spread).sortWithinPartitions(*spread)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, step := min(block, 2048)):
                held.append(batch.slice(at, step))
                n += held[-1].num_rows
                if n + step > block:
                    yield made(held)
                    held, n = [], 0
        if held:
            yield made(held)

    def made(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        ids, labels, counts, i, j = (t.column(c).to_numpy() for c in ("id", "label", "n", "i", "j"))
        whole = matrix(t.column("v").to_pylist(), size)
        small = np.abs(whole).max(initial=0) < 1 << 15
        data = pickle.dumps((ids, labels, counts, whole.astype(np.int16) if small else whole, np.stack((i, j), axis=1)))
        return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["data"])

    return ordered.mapInArrow(blocks, "data binary")


#: What tasks give out: an anchor's place, which of its lists, what is known of it, and a row with its score and how often it is there.
RESULT = "anchor int, slot int, anchor_id long, anchors long, positive_id long, positive_score decimal(38,0), score decimal(38,0), more string, id long, label long, v binary, n long"
_MOST = 10**38 - 1
_DIGITS = 650


def _decimal(x) -> Decimal:
    return Decimal(max(-_MOST, min(_MOST, int(x))))


def _text(x) -> str | None:
    """A score that a decimal cannot hold, as text that sorts as the numbers do."""
    return None if abs(x) <= _MOST else str(int(x) + 10**_DIGITS).zfill(_DIGITS + 1)


def _pass(blocks: DataFrame, books: Codebooks, shared, wanted, out) -> DataFrame:
    """RESULT rows: what each task's blocks have for each anchor. wanted(anchor) makes its lists, out(block, anchor) tells which rows do not count."""
    schema = to_arrow_schema(T.StructType.fromDDL(RESULT))

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, lists = shared.value, None
        for batch in batches:
            for data in batch.column(0):
                ids, labels, counts, vectors, cells = pickle.loads(data.as_py())
                block = Block(ids, labels, counts, vectors.astype(float), cells, books)
                lists = lists or [wanted(a) for a in anchors]
                for a, own in zip(anchors, lists, strict=True):
                    if own:
                        searched(block, a["v"], own, out(block, a))
        rows = (
            (k, s, a["id"], a["n"], p, _decimal(p_score), _decimal(r[0]), _text(r[0]), *r[1:])
            for k, (a, own) in enumerate(zip(anchors, lists or [()] * len(anchors), strict=True))
            for s, (w, (p, p_score)) in enumerate(zip(own, a.get("positives", [(None, 0)]), strict=True))
            for r in w.rows
        )
        while some := list(itertools.islice(rows, 4096)):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), schema, strict=True)], schema=schema)

    return blocks.mapInArrow(go, RESULT)


def firsts(found: DataFrame, n: int) -> DataFrame:
    """The first n of what the tasks have found for a list; of a row that is there several times, n is how often it is among them."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.desc("more"), "id", "label", "v")
    ahead = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    return found.withColumn("ahead", ahead).where(F.col("ahead") < n).withColumn("n", F.least("n", n - F.col("ahead")))


def mined(embeddings: DataFrame, block: int = BLOCK, at_once: int = ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)"""
    rows = staged(rows_of(embeddings), "vectors")
    count, longest = rows.agg(F.count("*"), F.max(F.length("v"))).first()
    size = max(2, (longest or 0) // 8)
    books = codebooks(rows, count, size)
    blocks = staged(index(rows, books, size, count, block), "multi-index")
    own = rows.where((F.col("id") % EVERY == 0) & (F.col("id") < LAST))
    groups = max(1, -(-own.count() // at_once))
    return reduce(DataFrame.unionByName, (_mined(own, blocks, books, size, groups, k) for k in range(groups)))


def _mined(own: DataFrame, blocks: DataFrame, books: Codebooks, size: int, groups: int, k: int) -> DataFrame:
    """The negatives of one group of anchors."""
    context = own.sparkSession.sparkContext
    part = own.where(F.pmod(F.xxhash64("id", "v"), F.lit(groups)) == k).orderBy("id", "label", "v")
    anchors = [a | {"v": matrix([a["v"]], size)[0]} for a in part.toArrow().to_pylist()]  # about ANCHORS
    shared = context.broadcast(anchors)
    # one more than the positives, as the anchor's own row is among them
    found = _pass(blocks, books, shared, lambda a: [Best(POSITIVES + 1)], lambda b, a: lambda at: b.labels[at] != a["label"])
    best = firsts(staged(found, "positives"), POSITIVES + 1).orderBy("anchor", "ahead").select("anchor", "score", "more", "id", "label", "v", "n").toArrow().to_pylist()
    lists: list[list] = [[] for _ in anchors]
    for r in best:
        a = anchors[r["anchor"]]
        itself = r["id"] == a["id"] and r["label"] == a["label"] and np.array_equal(matrix([r["v"]], size)[0], a["v"])
        score = int(r["more"]) - 10**_DIGITS if r["more"] else int(r["score"])
        lists[r["anchor"]] += [(r["id"], score)] * (r["n"] - itself)
    shared.destroy()
    shared = context.broadcast([a | {"positives": p[:POSITIVES]} for a, p in zip(anchors, lists, strict=True)])
    low, high = WINDOW

    def wanted(a: dict) -> list[Best]:
        return [Best(NEGATIVES, -(-low * s // 100), high * s // 100) if s >= 0 else Best(NEGATIVES, np.inf, -np.inf) for _, s in a["positives"]]

    found = staged(_pass(blocks, books, shared, wanted, lambda b, a: lambda at: b.labels[at] == a["label"]), "negatives")
    shared.destroy()
    each = firsts(found, NEGATIVES).select("*", F.posexplode(F.sequence(F.lit(1), F.col("n"))).alias("nth", "one"))
    known = lambda c: F.when(F.col(c) < LAST, F.col(c))
    long = lambda c: F.greatest(F.lit(-_LONG), F.least(F.lit(_LONG), F.col(c))).cast("long")
    return each.select(
        "anchor_id", known("positive_id").alias("positive_id"), (F.col("ahead") + F.col("nth") + 1).cast("int").alias("rank"), known("id").alias("negative_id"),
        long("positive_score").alias("positive_score"), long("score").alias("negative_score"), F.explode(F.sequence(F.lit(1), F.col("anchors"))).alias("copy"),
    ).drop("copy")


def op12_hard_negatives(embeddings: DataFrame) -> DataFrame:
    return mined(embeddings)


OP12_SQL = """
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, a.label = b.label AS alike, b.r AS b, b.vec_id AS id, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.r <> b.r
), p AS (
  SELECT a, anchor_id, b, id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id, b) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY score DESC, id, s.b) AS INT) AS rank, id AS negative_id,
  positive_score, score AS negative_score
FROM p JOIN s ON p.a = s.a AND NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
