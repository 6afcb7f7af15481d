"""Links between similar sets that share a bucket, without all pairs of a bucket.

Buckets propose, whole sets decide. Each bucket has its least member as pivot, and each member is compared with the least of its
buckets' pivots: a row a member, however large the bucket. What is linked gets one root, and a bucket whose members all have one root is
done. Open buckets that hang together by members form a family. Many buckets of nearly the same members would compare the same pairs again
and again, so a family with fewer pairs of members than its buckets have together is one bucket from then on; others keep theirs. Each bucket
gets another pivot, of the root that most of its members have; all members are compared with it, and it leaves the bucket, as all its pairs
are known. The rest is compared in cells. The Jaccard distance is a metric, so members whose distances from the pivot differ by more
than a link allows are not similar: a cell holds two neighbouring bins of such distances. Within a cell members of the root that most
have need not be compared with each other: each block of members meets each block of the other roots' members, and a task holds two blocks
of about BLOCK members at most (fewer, where that would leave tasks without a cell). So a family of near copies costs a row or two a member, and
with it a few outsiders as many rows a member as there are blocks of outsiders; no pair of different roots is left out. Roots here are
known connections, which need not be all: one that is missed costs comparisons and loses no link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airwave.llm.common import map_batches, shuffle_width, sized, staged
from airwave.llm.simhash_gray import star_components

#: Members of a block at most.
BLOCK = 2048
#: Cells that a task should get, and members of a block that are worth a cell.
CELLS_A_TASK, LEAST_BLOCK = 8, 32

_U = np.uint64
Least = tuple[int, int]


def distinct_buckets(member: DataFrame) -> DataFrame:
    """(bucket, fp) of buckets with several members; of buckets with the same members one."""
    wide = lambda c: F.sum(c.cast("decimal(38,0)"))
    alike = member.groupBy("bucket").agg(F.count("*").alias("n"), wide(F.col("fp")).alias("s"), wide(F.xxhash64("fp")).alias("x"), F.min("fp").alias("pivot"))
    once = staged(alike.where("n > 1").groupBy("n", "s", "x").agg(F.min_by(F.struct("bucket", "pivot"), "bucket").alias("b")).select("b.*"), "near-buckets")
    return staged(member.join(once, "bucket").select("bucket", "fp", "pivot"), "near-members")


def _both(batch: pa.RecordBatch) -> dict[str, list]:
    """Sizes of the intersection and the union of two sorted sets."""
    both, whole = [], []
    for a, b in zip(batch.column(2), batch.column(3), strict=True):
        x, y = np.frombuffer(a.as_buffer(), _U), np.frombuffer(b.as_buffer(), _U)
        x, y = (x, y) if len(x) <= len(y) else (y, x)
        both.append(int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()))
        whole.append(len(x) + len(y) - both[-1])
    return {"fp": batch.column(0), "pivot": batch.column(1), "both": both, "whole": whole}


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(fp, pivot, both, whole) for pairs (fp, pivot)."""
    other = sets.select(F.col("fp").alias("pivot"), F.col("shingles").alias("others"))
    rows = sets.join(sized(pairs), "fp").join(other, "pivot").select("fp", "pivot", "shingles", "others")
    return map_batches(rows, _both, "fp long, pivot long, both long, whole long", slices=True)


def _near(least: Least) -> Column:
    part, whole = least
    return whole * F.col("both") >= part * F.col("whole")


def rooted(member: DataFrame, links: DataFrame) -> DataFrame:
    """(bucket, fp, root): members with a vertex that they are connected with by two links at most; links: (a, b) with at most one b for an a."""
    to = staged(links.select(F.col("a").alias("fp"), F.col("b").alias("root")), "pivot-of")
    further = to.select(F.col("fp").alias("root"), F.col("root").alias("top"))
    to = staged(to.join(further, "root", "left").select("fp", F.coalesce("top", "root").alias("root")), "pivot-roots")
    return member.select("bucket", "fp").join(to, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def _open(member: DataFrame) -> DataFrame:
    """Members of buckets that have several roots."""
    several = member.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("bucket")
    return staged(member.join(staged(several, "open-buckets"), "bucket", "left_semi"), "open-members")


def merged(member: DataFrame) -> DataFrame:
    """(bucket, fp, root): a bucket for each family of buckets that has fewer pairs of members than its buckets have together; else the buckets.

    A family is named by the least pivot that a member of its buckets has in another bucket; whatever the name, a bucket goes to one family whole.
    """
    counted = staged(member.groupBy("bucket").agg(F.count("*").cast("double").alias("n"), F.min("fp").alias("pivot")), "open-counts")
    least = staged(member.join(counted, "bucket").groupBy("fp").agg(F.min("pivot").alias("least")), "least-pivots")
    family = member.join(least, "fp").groupBy("bucket").agg(F.min("least").alias("family"))
    family = staged(family.join(counted.select("bucket", "n"), "bucket"), "families")
    whole = staged(member.join(family.select("bucket", "family"), "bucket").select("family", "fp", "root").distinct(), "family-members")
    apart = family.groupBy("family").agg(F.sum(F.col("n") * F.col("n")).alias("apart"))
    sizes = whole.groupBy("family").agg(F.count("*").cast("double").alias("n"))
    fewer = staged(sizes.join(apart, "family").where("n * n < apart").select("family"), "merged-families")
    joint = whole.join(fewer, "family", "left_semi").select(F.xxhash64(F.lit("family"), "family").alias("bucket"), "fp", "root")
    rest = member.join(family.join(fewer, "family", "left_anti").select("bucket"), "bucket", "left_semi").select("bucket", "fp", "root")
    return staged(joint.unionByName(rest), "open-members")


def with_middle(member: DataFrame) -> DataFrame:
    """member, with one of each bucket's members, of the root that most have, as pivot, and that root as top."""
    by_root = member.groupBy("bucket", "root").agg(F.count("*").alias("n"), F.max("fp").alias("fp"))
    middle = by_root.groupBy("bucket").agg(F.max_by(F.struct("fp", "root"), F.struct("n", "fp")).alias("m"))
    return member.join(staged(middle.select("bucket", F.col("m.fp").alias("pivot"), F.col("m.root").alias("top")), "pivots"), "bucket")


def similar(member: DataFrame, sets: DataFrame, least: Least, block: int = BLOCK) -> DataFrame:
    """(a, b): links that join the same components as all pairs of a bucket whose similarity is least[0] / least[1] or more.

    member: (bucket, fp, pivot) of distinct_buckets; sets: (fp, shingles), sorted distinct hashes.
    """
    tested = staged(member.where("fp <> pivot").groupBy("fp").agg(F.min("pivot").alias("pivot")), "pairs")
    links = staged(compared(tested, sets).where(_near(least)).select(F.col("fp").alias("a"), F.col("pivot").alias("b")), "pivot-links")
    own = _open(rooted(member, links))
    return links if own.isEmpty() else links.unionByName(in_cells(with_middle(merged(own)), sets, least, block))


def block_size(pairs: float, tasks: int, most: int) -> int:
    """Members of a block: as many as leave some cells for each task, so that one family is dealt to all tasks; at most the given number."""
    return min(most, max(LEAST_BLOCK, int((pairs / (CELLS_A_TASK * tasks)) ** 0.5)))


def in_cells(member: DataFrame, sets: DataFrame, least: Least, block: int) -> DataFrame:
    """(a, b): links of members with their buckets' pivots, and between members of different roots. member: (bucket, fp, root, pivot, top)."""
    part, whole = least
    member = staged(member, "members-of-pivots")
    far = F.floor((1 - F.col("both") / F.col("whole")) / ((whole - part) / whole + 1e-9)).cast("int")
    away = compared(staged(member.where("fp <> pivot").select("fp", "pivot").distinct(), "pairs"), sets)
    away = staged(away.select("fp", "pivot", far.alias("bin"), _near(least).alias("near")), "bins")
    links = away.where("near").select(F.col("fp").alias("a"), F.col("pivot").alias("b"))
    binned = member.join(away, ["fp", "pivot"]).withColumn("root", F.when(F.col("near"), F.col("top")).otherwise(F.col("root")))
    binned = staged(binned.select("bucket", "fp", "root", F.explode(F.array(F.col("bin"), F.col("bin") + 1)).alias("bin")), "binned")
    by_root = binned.groupBy("bucket", "bin", "root").agg(F.count("*").alias("n"))
    cells = by_root.groupBy("bucket", "bin").agg(F.sum("n").alias("n"), F.max_by(F.struct("root", "n"), F.struct("n", "root")).alias("most"))
    cells = staged(cells.where("n > most.n").select("bucket", "bin", F.col("most.root").alias("most"), F.col("n").cast("double").alias("n"), (F.col("n") - F.col("most.n")).alias("minors")), "cells")
    block = block_size(cells.agg(F.sum(F.col("n") * F.col("minors"))).first()[0] or 0, shuffle_width(member.sparkSession), block)
    blocks = lambda name: F.ceil(F.col(name) / F.lit(block)).cast("int")
    rows = binned.join(cells.select("bucket", "bin", "most", blocks("n").alias("wide"), blocks("minors").alias("deep")), ["bucket", "bin"])
    place = lambda n: F.pmod(F.xxhash64("fp"), n).cast("int")
    every = rows.select("bucket", "bin", "fp", "root", F.lit(False).alias("minor"), place(F.col("wide")).alias("x"), F.explode(F.sequence(F.lit(0), F.col("deep") - 1)).alias("y"))
    minor = rows.where("root <> most")
    minor = minor.select("bucket", "bin", "fp", "root", F.lit(True).alias("minor"), F.explode(F.sequence(F.lit(0), F.col("wide") - 1)).alias("x"), place(F.col("deep")).alias("y"))
    rows = every.unionByName(minor).join(sets, "fp")
    cell = F.xxhash64("bucket", "bin", "x", "y")
    rows = rows.select(cell.alias("cell"), "minor", "fp", "root", "shingles").repartition("cell").sortWithinPartitions("cell", "minor")
    return links.unionByName(staged(rows.mapInArrow(lambda batches: _cells(batches, least), "a long, b long"), "cell-links"))


def _cells(batches: Iterator[pa.RecordBatch], least: Least) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell, the minor ones last."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    name, every, minors = None, [], []

    def done() -> pa.RecordBatch:
        pairs = list(cell_links(every, minors, least)) if every and minors else []
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], schema=schema)

    for batch in batches:
        for cell, minor, fp, root, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if cell != name:
                yield done()
                name, every, minors = cell, [], []
            (minors if minor else every).append((fp, root, np.frombuffer(data, _U)))
    yield done()


def cell_links(every: list[tuple], minors: list[tuple], least: Least) -> Iterator[tuple[int, int]]:
    """(minor, member) of different roots: links that join the same roots as all similar pairs do."""
    part, whole = least
    size = np.array([len(s) for _, _, s in every])
    fps, ids = np.array([f for f, _, _ in every]), np.concatenate([s for _, _, s in every])
    names, ids = np.unique(ids, return_inverse=True)
    start, mark = np.cumsum(size) - size, np.zeros(len(names) + 1, bool)
    known = {r: i for i, r in enumerate({r for _, r, _ in every} | {r for _, r, _ in minors})}
    group = np.array([known[r] for _, r, _ in every])
    joined = np.arange(len(known))
    for fp, root, own in minors:
        place = np.searchsorted(names, own)
        place = place[(place < len(names)) & (names[np.minimum(place, len(names) - 1)] == own)]
        mark[place] = True
        both = np.add.reduceat(mark[ids], start, dtype=np.int64)
        mark[place] = False
        near = (whole * both >= part * (size + len(own) - both)) & (joined[group] != joined[known[root]])
        for at in np.flatnonzero(near):
            if joined[group[at]] != joined[known[root]]:
                joined[joined == joined[group[at]]] = joined[known[root]]
                yield fp, int(fps[at])
