"""SimHash near-dedup with a Gray-order hierarchical index.

Distinct fingerprints only are indexed. The upper nodes of the index are masked bit patterns that Spark shuffles on:
a mask fixes one third of the bits that its parent left open, so two fingerprints that differ in two bits or fewer
share at least one child of every node they share. A node that is too large is split again; after four levels at most
13 bits are open, which bounds a node by its patterns, however many documents there are. Inside a node the
fingerprints are sorted by Gray rank, and runs of neighbours are factored into inner nodes (the bits they agree on).
A search adds up differences on the way down and leaves out a whole run once there are more than two.

A node's links are joined up where they are found, so it gives a forest, not all pairs. Components come from
alternating star contractions, each round written to the shared folder.

Defined cases: no words (or null text) gives fingerprint zero, linked like any other; repeated rows get equal
results; null ids are no candidates for component_id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airwave.llm.common import KEY, map_batches, row_key, shuffle_width, sized, staged, utf8

MAX_DIFF = 2
SHINGLE = 3
#: Nodes above this are split by further bits, down to LEVELS; FANOUT neighbours in Gray order make an inner node.
NODE_LIMIT, LEVELS, FANOUT = 2048, 4, 16
_CHUNK = 1 << 16


def simhash(data: bytes) -> int:
    """The fingerprint, unsigned: a bit is set if over half of the shingles' hashes have it."""
    words = data.lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(SHINGLE, n)
    m = n - k + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[:m].tolist(), ends[k - 1 :].tolist(), strict=True)), np.uint64, m)
    counts = np.zeros(64, np.int64)
    for at in range(0, m, _CHUNK):
        octets = hashes[at : at + _CHUNK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * counts > m, bitorder="little").view("<u8")[0])


def _fingerprints(batch: pa.RecordBatch) -> dict[str, list]:
    values = np.array([simhash(x) for x in utf8(batch)], np.uint64)
    return {"key": batch.column(0), "doc_id": batch.column(1), "fp": values.view(np.int64)}


def fingerprints(docs: DataFrame) -> DataFrame:
    rows = docs.select(row_key("doc_id", "text").alias("key"), "doc_id", "text")
    return map_batches(rows, _fingerprints, f"key {KEY}, doc_id long, fp long")


def mask_tree() -> list[list[tuple[int, int]]]:
    """For each level, the masks in order of their parents: (parent's place, mask); three to a parent."""
    levels, parents = [], [0]
    for _ in range(LEVELS):
        level = []
        for at, mask in enumerate(parents):
            free = [b for b in range(64) if not mask >> b & 1]
            cuts = [round(len(free) * i / (MAX_DIFF + 1)) for i in range(MAX_DIFF + 2)]
            level += [(at, mask | sum(1 << b for b in free[i:j])) for i, j in zip(cuts, cuts[1:], strict=False)]
        levels.append(level)
        parents = [m for _, m in level]
    return levels


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def gray_rank(fp: Column) -> Column:
    """The place of a bit pattern in the reflected Gray sequence, ordered as unsigned."""
    rank = fp
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


class GrayIndex:
    """Inner nodes over fingerprints in Gray order; search by accumulated differences."""

    def __init__(self, fps: np.ndarray) -> None:
        self.fps, self.levels = fps, []
        ones, any_ = fps, fps
        while len(ones) > 1:
            cuts = np.arange(0, len(ones), FANOUT)
            ones, any_ = np.bitwise_and.reduceat(ones, cuts), np.bitwise_or.reduceat(any_, cuts)
            self.levels.append((~(ones ^ any_), ones))
        self.levels.reverse()

    def links(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (i, j), lo <= i < hi, i < j, that differ in MAX_DIFF bits or fewer."""
        q = np.arange(lo, hi)
        node = np.zeros(len(q), np.int64)
        diff = np.zeros(len(q), np.uint8)
        fixed = np.zeros(len(q), np.uint64)
        for depth, (mask, pattern) in enumerate(self.levels):
            if depth:
                q, node, diff, fixed = self._down(q, node, diff, fixed, len(mask))
            fresh = mask[node] & ~fixed
            diff = diff + np.bitwise_count((self.fps[q] ^ pattern[node]) & fresh)
            # a run that ends at or before the query has only pairs that the other side finds
            ok = (diff <= MAX_DIFF) & ((node + 1) * FANOUT ** (len(self.levels) - depth) > q)
            q, node, diff, fixed = q[ok], node[ok], diff[ok], mask[node[ok]]
        q, node, diff, fixed = self._down(q, node, diff, fixed, len(self.fps))
        ok = (node > q) & (diff + np.bitwise_count((self.fps[q] ^ self.fps[node]) & ~fixed) <= MAX_DIFF)
        return q[ok], node[ok]

    @staticmethod
    def _down(q, node, diff, fixed, size):
        child = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
        ok = child < size
        return tuple(np.repeat(x, FANOUT)[ok] if x is not node else child[ok] for x in (q, node, diff, fixed))


def node_forest(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(member, root) places of one node's components; members that are roots are left out."""
    n, index = len(fps), GrayIndex(fps)
    root = np.arange(n)
    step = max(1, (1 << 21) // n)
    for lo in range(0, n, step):
        i, j = index.links(lo, min(n, lo + step))
        while len(i):
            i, j = root[i], root[j]
            apart = i != j
            i, j = i[apart], j[apart]
            np.minimum.at(root, np.maximum(i, j), np.minimum(i, j))
            while (deeper := root[root]).tobytes() != root.tobytes():
                root = deeper
    member = np.flatnonzero(root != np.arange(n))
    return member, root[member]


def _node_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node and Gray rank to links; a task holds one batch and one node at most."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(mask: np.ndarray, pattern: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        cut = np.flatnonzero((mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])) + 1
        bounds = np.concatenate(([0], cut, [len(fps)]))
        sizes = np.diff(bounds)
        group = np.repeat(np.arange(len(sizes)), sizes)
        small = sizes[group] <= FANOUT
        out_a, out_b = [], []
        for shift in range(1, FANOUT):  # nodes of one run: neighbours are compared outright
            ok = np.flatnonzero(small[:-shift] & (group[:-shift] == group[shift:]))
            if not len(ok):
                break
            ok = ok[np.bitwise_count(fps[ok] ^ fps[ok + shift]) <= MAX_DIFF]
            out_a.append(fps[ok + shift])
            out_b.append(fps[ok])
        for g in np.flatnonzero(sizes > FANOUT):
            own = fps[bounds[g] : bounds[g + 1]]
            member, root = node_forest(own)
            out_a.append(own[member])
            out_b.append(own[root])
        a, b = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (out_a, out_b))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=schema)

    held: list[np.ndarray] = []
    for batch in batches:
        now = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
        if held:
            now = [np.concatenate((x, y)) for x, y in zip(held, now, strict=True)]
        if not len(now[0]):
            continue
        last = (now[0] != now[0][-1]) | (now[1] != now[1][-1])
        cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
        if cut:
            yield links(now[0][:cut], now[1][:cut], now[2][:cut].view(np.uint64))
        held = [x[cut:] for x in now]
    if held and len(held[0]):
        yield links(held[0], held[1], held[2].view(np.uint64))


def near_links(fps: DataFrame, node_limit: int = NODE_LIMIT) -> DataFrame:
    """(a, b): links that join the same components as all pairs of distinct fingerprints within MAX_DIFF bits."""
    frontier = fps.select("fp", F.lit(0).alias("mask"))
    leaves = None
    for depth, level in enumerate(mask_tree()):
        children = F.array(*(F.struct(F.lit(i).alias("mask"), F.lit(signed(m)).alias("bits")) for i, (_, m) in enumerate(level)))
        nodes = frontier.select("fp", F.explode(F.slice(children, F.col("mask") * 3 + 1, F.lit(3))).alias("c")).select(
            "fp", "c.mask", F.col("fp").bitwiseAND(F.col("c.bits")).alias("pattern")
        )
        if depth < LEVELS - 1:
            large = staged(nodes.groupBy("mask", "pattern").count().where(F.col("count") > node_limit).drop("count"), "gray-large")
            done = large.isEmpty()
        else:
            done = True
        here = nodes if done else nodes.join(large, ["mask", "pattern"], "left_anti")
        here = here.select("fp", (F.col("mask") + 1000 * depth).alias("mask"), "pattern")
        leaves = here if leaves is None else leaves.unionByName(here)
        if done:
            break
        frontier = staged(nodes.join(large, ["mask", "pattern"], "left_semi").select("fp", "mask"), "gray-frontier")
    ordered = leaves.repartition("mask", "pattern").sortWithinPartitions("mask", "pattern", gray_rank(F.col("fp")))
    return ordered.select("mask", "pattern", "fp").withColumn("mask", F.col("mask").cast("long")).mapInArrow(_node_links, "a long, b long")


#: Least tasks of a step of star_components, and rows that are worth one more.
EDGES_TASKS, EDGES_A_TASK = 8, 1 << 15


def star_components(links: DataFrame) -> DataFrame:
    """(v, root): every linked vertex but the roots, by alternating large-star and small-star rounds.

    The least neighbours are written before they are joined, so both sides of a join come straight from their shuffles and
    the rows of a vertex that most others hang on can be split over tasks.
    """
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "stars")
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not now[0] or now == state:
            return edges.select(F.col("u").alias("v"), F.col("v").alias("root"))
        state = now
        # no more rows than twice the edges come from a step; tasks of a few rows would cost more than they do
        few = max(EDGES_TASKS, 2 * now[0] // EDGES_A_TASK)
        kept = (lambda df, name: staged(df.coalesce(few), name)) if few < shuffle_width(edges.sparkSession) else staged
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = kept(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = kept(large, "stars")
        least = kept(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = kept(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "stars")


def components(docs: DataFrame, node_limit: int = NODE_LIMIT) -> DataFrame:
    """(key, doc_id, fp, component_id) for every row of docs."""
    marked = staged(fingerprints(docs), "fingerprints")
    distinct = least_ids(marked)
    return labelled(marked, distinct, near_links(distinct, node_limit))


def least_ids(marked: DataFrame) -> DataFrame:
    return staged(marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct-fingerprints")


def labelled(marked: DataFrame, distinct: DataFrame, links: DataFrame, *further: str) -> DataFrame:
    """(key, doc_id, fp, component_id and further columns) for every row of marked, from links between its fingerprints."""
    stars = star_components(links)
    member = stars.select(F.col("v").alias("fp"), "root").unionByName(stars.select(F.col("root").alias("fp"), "root").distinct())
    member = member.join(distinct, "fp")
    member = staged(member, "members")
    least = staged(member.groupBy("root").agg(F.min("least_id").alias("component_id")), "least")
    named = member.join(least, "root").select("fp", "component_id")
    named = distinct.join(named, "fp", "left").select("fp", F.coalesce("component_id", "least_id").alias("component_id"))
    # written, so that both sides of the last join come straight from shuffles and a hot fingerprint can be split
    named = staged(named, "named-fingerprints")
    return marked.join(named, "fp").select("key", "doc_id", "fp", "component_id", *further)


def op4_simhash_gray(docs: DataFrame) -> DataFrame:
    return components(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group: that of the component's id; a group without any id keeps its rows."""
    return keep_least(docs, components(docs))


def keep_least(docs: DataFrame, parts: DataFrame) -> DataFrame:
    """The rows of docs that bear the id of their component; of equal rows one.

    The keys of rows that go are broadcast where they are counted to be few, and meet the texts in a sort-merge join beyond that, in
    which Spark can split hot keys. Keys that several equal rows have are few, and only rows of such keys are gathered.
    """
    keys = parts.groupBy("key").agg(F.count("*").alias("rows"), F.first(~F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("goes"))
    known = staged(keys.where("goes or rows > 1").select(F.col("key").alias("__key"), "goes"), "found")
    rows = docs.withColumn("__key", row_key("doc_id", "text"))
    single = rows.join(sized(known.select("__key")), "__key", "left_anti").select(docs.columns)
    several = staged(known.where("not goes").select("__key"), "equal-rows")
    return single.unionByName(rows.join(several, "__key", "left_semi").dropDuplicates(["__key"]).select(docs.columns))
