"""Suffix-array dedup: removal of every byte in a LENGTH-byte string that also starts somewhere else.

Prefix doubling: positions are sorted by ranks of growing stretches of text, and those whose rank is unique drop out. A rank
pair (rank of a stretch, rank of the stretch after or before it) is reranked by Spark until the stretches have LENGTH bytes.
Ranks of unsorted stretches are hashes, so equal ranks mean equal text and a pair at any offset can be named where the text is read.

1. Offset ANCHOR. Each LENGTH-byte string holds an anchor, the place of its least ANCHOR-byte hash (leftmost); strings of one
   anchor that follow each other make a run, a row of the sort. Where the anchor's rank is unique no string of the run is
   repeated; where the rank of the whole run's text occurs again, all of them are.
2. Offsets 2 and 4 times ANCHOR. For what is left, the stretch that begins at the anchor and the one that ends with it double:
   pairs of the rank and the rank of what is beside it, ANCHOR and then 2 * ANCHOR bytes away, are reranked. Strings of a run
   that hold a stretch of unique rank drop out, which shortens the run from its left or right end.
3. LENGTH. The strings that survived are sorted by (anchor's rank, rank of the string); equal neighbours are repeated.

Hot groups. Equal runs, pairs and strings of one Arrow batch are brought together before anything is shuffled: one stands for
all. Anchors that many documents of a sample hold (HOT_SHARE of HOT_DOCS) are dealt over SALTS tasks by the rank that is
compared, so equal ranks still meet; the sample decides where rows are sorted, never what is found. Pairs are counted by
partial aggregates. Rows of equal content share a key and are worked through once a batch.

The texts are read again for steps 2 and 3 and for the result. What was found joins them by key: broadcast if it is counted
to be below BROADCAST_BYTES, else by a shuffle.

Ranks are 64-bit hashes, compared below an equal 64-bit anchor rank; keys have 128 bits. Defined cases: null text is empty;
texts shorter than LENGTH lose nothing; equal rows count as places of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airwave.llm.common import as_array, map_batches, row_key, staged, utf8

LENGTH, ANCHOR = 200, 32
#: Bytes that are hashed at once.
CHUNK = 1 << 20
#: Hot anchors: in more than this share of about so many sampled documents, and in LEAST_HOT at least; tasks for each.
HOT_DOCS, HOT_SHARE, LEAST_HOT, SALTS = 4096, 0.005, 20, 64
#: What was found is broadcast below this size. The bound is low, so that the plan is the same for all but small tables.
BROADCAST_BYTES = 1 << 20

_U = np.uint64
_TABLE = np.random.default_rng(7).integers(1, 2**62, 256, dtype=_U) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
#: Of runs in the sort: settled before it, first of equal ones that others of its anchor may match, not seen again so far.
LOOSE, SAMPLE, REPEATED = 0, 1, 2
_RUN = "anchor long, salt int, whole long, ka long, kb long, start int, n int, off int, total int, again boolean"
#: What step 2 puts beside the ranks, by round: from and to in bytes from the anchor's start, to its right and to its left.
_NEXT = {"right1": (ANCHOR, 2 * ANCHOR), "left1": (-ANCHOR, 0), "right2": (2 * ANCHOR, 4 * ANCHOR), "left2": (-3 * ANCHOR, -ANCHOR)}
_STRETCH = "right long, left long, ka long, kb long, start int, off int, lo int, hi int, " + ", ".join(f"{k} long" for k in _NEXT)
_STRINGS = "anchor long, salt int, ka long, kb long, start int, m0 long, m1 long, m2 long, i array<int>, ranks array<long>"


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, n + 1 at least."""
    size = max(n, CHUNK + 2 * LENGTH) + 1
    if not _POWERS or len(_POWERS[0][0]) < size:
        made = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            x = np.full(size, base, _U)
            x[0] = 1
            made.append(np.multiply.accumulate(x))
        _POWERS[0] = made[0], made[1]
    return _POWERS[0]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


class Hashes:
    """Hashes of any stretch of some bytes."""

    def __init__(self, data: np.ndarray) -> None:
        power, self.inverse = _powers(len(data))
        self.sums = np.zeros(len(data) + 1, _U)
        np.cumsum(_TABLE[data] * power[: len(data)], out=self.sums[1:])

    def all(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return _mixed((self.sums[length:] - self.sums[:n]) * self.inverse[:n])

    def at(self, start: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        return _mixed((self.sums[start + length] - self.sums[start]) * self.inverse[start])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(_U))


def pieces(texts: list[bytes], length: int = LENGTH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts side by side in stretches of about CHUNK bytes; long ones overlap so that each string is whole in one.

    Gives the bytes and, for each text in the stretch, its number, its place in the stretch and the place within the text.
    """
    parts: list[tuple[int, int, bytes]] = []
    size = 0
    for i, data in enumerate(texts):
        for at in range(0, max(1, len(data) - length + 1), CHUNK):
            part = data[at : at + CHUNK + length - 1]
            if len(part) < length:
                continue
            parts.append((i, at, part))
            size += len(part)
            if size >= CHUNK:
                yield _joined(parts)
                parts, size = [], 0
    if parts:
        yield _joined(parts)


def _joined(parts: list[tuple[int, int, bytes]]):
    sizes = np.array([len(p) for _, _, p in parts])
    return (
        np.frombuffer(b"".join(p for _, _, p in parts), np.uint8),
        np.array([i for i, _, _ in parts]),
        np.concatenate(([0], np.cumsum(sizes))),
        np.array([at for _, at, _ in parts]),
    )


def runs(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR):
    """The hashes of some texts side by side, and of their runs: the anchor's rank, part, first string, strings, anchor's place."""
    hashes = Hashes(data)
    ranks = hashes.all(anchor)
    places = (ranks >> _U(24) << _U(24)) | np.arange(len(ranks), dtype=_U)
    width, least, step = length - anchor + 1, places, 1
    while step * 2 <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    n = len(places) - width + 1
    least = (np.minimum(least[:n], least[width - step : width - step + n]) & _U(0xFFFFFF)).astype(np.int64)
    part = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:n]
    start = np.flatnonzero(np.arange(n) + length <= bounds[part + 1])
    part, spot = part[start], least[start]
    cut = np.flatnonzero(np.concatenate(([True], (spot[1:] != spot[:-1]) | (part[1:] != part[:-1]))))
    first, last = start[cut], start[np.concatenate((cut[1:], [len(start)])) - 1]
    return hashes, ranks[spot[cut]], part[cut], first, last - first + 1, spot[cut]


def firsts(*codes: np.ndarray) -> np.ndarray:
    """For each row the place of the first row that has the same codes."""
    if not len(codes[0]):
        return np.zeros(0, np.int64)
    order = np.lexsort(codes[::-1])
    new = np.zeros(len(order), bool)
    new[0] = True
    for c in codes:
        new[1:] |= c[order[1:]] != c[order[:-1]]
    head = np.flatnonzero(new)
    out = np.empty(len(order), np.int64)
    out[order] = np.repeat(order[head], np.diff(np.append(head, len(order))))
    return out


def _distinct(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch with the columns ka, kb, ...: the rows to work through, whether more rows have their key, and the keys of all."""
    ka, kb = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
    first = firsts(ka, kb)
    rows, times = np.unique(first, return_counts=True)
    return rows, times > 1, ka, kb


def _has(sorted_: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(values), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)] == values


def _runs(batch: pa.RecordBatch, hot: np.ndarray) -> dict[str, np.ndarray]:
    """The rows of the first sort, and rows of negative salt for runs that are known to be repeated already.

    Equal runs right after each other, as in periodic text, are one row; of runs that are equal in the batch one goes to the sort.
    """
    rows, many, ka, kb = _distinct(batch)
    texts = utf8(batch)
    made = []
    for data, text, bounds, at in pieces([texts[i] for i in rows]):
        hashes, rank, part, first, n, spot = runs(data, bounds)
        whole, doc = hashes.of(first, first + n - 1 + LENGTH), text[part]
        new = (whole[1:] != whole[:-1]) | (rank[1:] != rank[:-1]) | (first[1:] != first[:-1] + n[:-1]) | (doc[1:] != doc[:-1])
        cut = np.flatnonzero(np.concatenate(([True], new)))
        times = np.diff(np.concatenate((cut, [len(first)])))
        start = first - bounds[part] + at[part]
        made.append([x[cut] for x in (rank, whole, doc, start, n, spot - first)] + [times])
    names = ("anchor", "salt", "whole", "ka", "kb", "start", "n", "off", "total", "again")
    if not made:
        return {k: [] for k in names}
    rank, whole, doc, start, n, off, times = (np.concatenate(x) for x in zip(*made, strict=True))
    again, total, equal = (times > 1) | many[doc], n * times, firsts(rank, whole)
    local = equal != np.arange(len(equal))
    again[equal[local]] = True
    salt = np.where(_has(hot, rank), 1 + (whole % _U(SALTS)).astype(np.int64), 0)
    # settled runs that follow each other in a text are one row
    old = np.flatnonzero(local)
    joins = (doc[old[1:]] == doc[old[:-1]]) & (start[old[1:]] == start[old[:-1]] + total[old[:-1]])
    head = np.flatnonzero(np.concatenate(([True], ~joins))) if len(old) else np.zeros(0, np.int64)
    row = np.concatenate((np.flatnonzero(~local), old[head]))
    if len(old):
        total[old[head]] = np.add.reduceat(total[old], head)
        salt[old] = -1 - (start[old] & 0xFFFF)
    key = rows[doc[row]]
    return {
        "anchor": rank.view(np.int64)[row], "salt": salt[row], "whole": whole.view(np.int64)[row], "ka": ka[key], "kb": kb[key],
        "start": start[row], "n": n[row], "off": off[row], "total": total[row], "again": again[row],
    }


def hot_anchors(docs: DataFrame) -> np.ndarray:
    """The ranks of anchors that more than HOT_SHARE of sampled documents hold: some thousands at most, as a document has few."""
    rows = docs.count()
    least = max(LEAST_HOT, int(HOT_SHARE * min(rows, HOT_DOCS)))

    def anchors(batch: pa.RecordBatch) -> dict[str, list]:
        found = [np.unique(np.stack((text[part], rank.view(np.int64))), axis=1)[1] for _, rank, text, part in _anchors(utf8(batch))]
        ranks, counts = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.int64),) * 2
        return {"anchor": ranks, "n": counts}

    sample = docs.select("text") if rows <= HOT_DOCS else docs.select("text").sample(HOT_DOCS / rows, seed=1)
    seen = map_batches(sample, anchors, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n")).where(F.col("n") > least)
    return np.sort(seen.select("anchor").toArrow()["anchor"].to_numpy()).view(_U)


def _anchors(texts: list[bytes]):
    for data, text, bounds, _ in pieces(texts):
        hashes, rank, part, *_ = runs(data, bounds)
        yield hashes, rank, text, part


_N, _OFF = 1 << 8, 1 << 8


def packed(start: Column, a: Column, b: Column, off: Column) -> Column:
    """A run as one number: its start, its strings from a to before b, and the anchor's place from the start."""
    return (((start.cast("long") * F.lit(_N) + a) * F.lit(_N) + b) * F.lit(_OFF) + off)


def _unpacked(x: np.ndarray) -> tuple[np.ndarray, ...]:
    return x // (_N * _N * _OFF), x // (_N * _OFF) % _N, x // _OFF % _N, x % _OFF


def beside(rows: DataFrame, lists: DataFrame, size: Column, how: str) -> DataFrame:
    """rows with what lists has for their keys; broadcast only if its counted size is below BROADCAST_BYTES."""
    total = lists.agg(F.sum(F.lit(96) + size)).first()[0] or 0
    return rows.join(F.broadcast(lists) if total <= BROADCAST_BYTES else lists.hint("merge"), ["ka", "kb"], how)


def _listed(batch: pa.RecordBatch):
    """Of a batch with the columns ka, kb, text, runs: for each stretch of text, its hashes and the runs that lie in it.

    (hashes, end of the stretch in its text, key's row, start in the stretch, start in the text, a, b, off)
    """
    rows, _, ka, kb = _distinct(batch)
    lists = batch.column(3)
    texts = utf8(batch)
    for i in rows:
        start, a, b, off = _unpacked(np.sort(lists[i].values.to_numpy(zero_copy_only=False)))
        data = texts[i]
        for at in range(0, len(data), CHUNK):
            own = (start >= at) & (start < at + CHUNK)
            if own.any():
                lo, hi = max(0, at - 4 * ANCHOR), min(len(data), at + CHUNK + 3 * LENGTH)
                hashes = Hashes(np.frombuffer(data, np.uint8, hi - lo, lo))
                yield hashes, hi - lo, int(i), start[own] - lo, start[own], a[own], b[own], off[own]


def _stretches(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    """For each run the anchor's rank, twice, and the ranks of the stretches beside it; those that leave the text have none."""
    out: dict[str, list] = {f.split()[0]: [] for f in _STRETCH.split(", ")}
    ka, kb = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
    for hashes, size, i, at, start, a, b, off in _listed(batch):
        p, beside_ = at + off, []
        for x, y in _NEXT.values():
            ok = (p + x >= 0) & (p + y <= size)
            beside_.append(pa.array(hashes.at(np.where(ok, p + x, 0), np.where(ok, y - x, 0)).view(np.int64), mask=~ok))
        anchor, n = hashes.at(p, ANCHOR).view(np.int64), len(start)
        for k, x in zip(out, (anchor, anchor, np.full(n, ka[i]), np.full(n, kb[i]), start, off, a, b, *beside_), strict=True):
            out[k].append(pa.array(x) if isinstance(x, np.ndarray) else x)
    return {k: pa.concat_arrays(x) if x else [] for k, x in out.items()}


def doubled(rows: DataFrame, turn: int, reach: int) -> DataFrame:
    """A round: pairs (rank, next rank) are reranked, and strings that hold a stretch of unique rank drop out.

    reach: bytes of the doubled stretch beside its anchor.
    """
    sides = F.explode(F.array(*(F.struct(F.lit(s).alias("side"), F.col(s).alias("rank"), F.col(f"{s}{turn}").alias("next")) for s in ("right", "left"))))
    pairs = rows.select(sides.alias("s")).select("s.*").where("next is not null")
    again = staged(pairs.groupBy("side", "rank", "next").count().where("count > 1").drop("count"), "repeated-pairs")
    for s in ("right", "left"):
        own = again.where(F.col("side") == s).select(F.col("rank").alias(s), F.col("next").alias(f"{s}{turn}"), F.lit(True).alias(f"on_{s}"))
        rows = rows.join(own, [s, f"{s}{turn}"], "left")
    # string i reaches off - i bytes to the left of its anchor and LENGTH - ANCHOR - (off - i) to the right of it
    hi = F.when(F.col("on_right"), F.col("hi")).otherwise(F.least("hi", F.col("off") - F.lit(LENGTH - ANCHOR - reach)))
    lo = F.when(F.col("on_left"), F.col("lo")).otherwise(F.greatest("lo", F.col("off") - F.lit(reach - 1)))
    ranks = {s: F.xxhash64(s, f"{s}{turn}") for s in ("right", "left")}
    return staged(rows.withColumns({"hi": hi, "lo": lo} | ranks).where("lo < hi").drop("on_right", "on_left", f"right{turn}", f"left{turn}"), "doubled")


def _strings(batch: pa.RecordBatch, hot: np.ndarray) -> dict[str, pa.Array]:
    """The ranks of the surviving strings; of strings that are equal in the batch one goes to the sort, the others' bits are set."""
    ka, kb = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
    heads, flat, seen = [], [], 0
    for hashes, _, i, at, start, a, b, off in _listed(batch):
        n = b - a
        owner = np.repeat(np.arange(len(at)), n)
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + a[owner]
        begin = at[owner] + place
        heads.append((hashes.at(at + off, ANCHOR), np.full(len(at), i), start))
        flat.append((seen + owner, place, hashes.at(begin, LENGTH)))
        seen += len(at)
    names = [f.split()[0] for f in _STRINGS.split(", ")]
    if not heads:
        return {k: [] for k in names}
    anchor, row, start = (np.concatenate(x) for x in zip(*heads, strict=True))
    owner, place, rank = (np.concatenate(x) for x in zip(*flat, strict=True))
    equal = firsts(anchor[owner], rank)
    twin = np.zeros(len(rank), bool)
    local = equal != np.arange(len(rank))
    twin[local] = True
    twin[equal[local]] = True
    bits = np.zeros((len(anchor), 3), _U)
    np.bitwise_or.at(bits, (owner[twin], place[twin] >> 6), _U(1) << (place[twin] & 63).astype(_U))
    # strings to sort, dealt over tasks where their anchor is hot; a run whose strings are all settled is a row without any
    owner, place, rank = owner[~local], place[~local], rank[~local]
    salt = np.where(_has(hot, anchor[owner]), 1 + (rank % _U(SALTS)).astype(np.int64), 0)
    order = np.lexsort((place, salt, owner))
    owner, place, rank, salt = owner[order], place[order], rank[order], salt[order]
    cut = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (salt[1:] != salt[:-1])))) if len(owner) else np.zeros(0, np.int64)
    rest = np.setdiff1d(np.arange(len(anchor)), owner)
    run = np.concatenate((owner[cut], rest))
    first = np.concatenate(([True], run[1:] != run[:-1])) if len(run) else np.zeros(0, bool)
    mask = np.where(first[:, None], bits[run], _U(0)).view(np.int64)
    ends = np.concatenate((cut, np.full(len(rest) + 1, len(owner)))).astype(np.int32)
    offsets = pa.array(ends)
    values = {
        "anchor": anchor.view(np.int64)[run], "salt": np.concatenate((salt[cut], -1 - (start[rest] & 0xFFFF))), "ka": ka[row[run]], "kb": kb[row[run]], "start": start[run],
        "m0": mask[:, 0], "m1": mask[:, 1], "m2": mask[:, 2],
    }
    lists = {"i": pa.ListArray.from_arrays(offsets, pa.array(place.astype(np.int32))), "ranks": pa.ListArray.from_arrays(offsets, pa.array(rank.view(np.int64)))}
    return {k: as_array(v, pa.array(v).type) for k, v in values.items()} | lists


def _covered(starts, sizes, masks) -> tuple[np.ndarray, np.ndarray]:
    """(from, to before) of the bytes that runs and single strings of them cover."""
    whole = sizes > 0
    a, b = [starts[whole]], [starts[whole] + sizes[whole] - 1 + LENGTH]
    bits = np.unpackbits(masks[~whole].view(np.uint8).reshape(-1, 24), axis=1, bitorder="little")
    run, place = np.nonzero(bits)
    a.append(starts[~whole][run] + place)
    b.append(a[1] + LENGTH)
    return np.concatenate(a), np.concatenate(b)


def _cut(batch: pa.RecordBatch) -> dict[str, list]:
    out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "removed": []}
    for data, found in zip(utf8(batch), batch.column(4), strict=True):
        spans, kept = [], data
        if found.is_valid:
            own = found.values
            field = lambda k: own.field(k).to_numpy(zero_copy_only=False).astype(np.int64)
            a, b = _covered(field("start"), field("n"), np.stack([field(f"m{k}") for k in range(3)], axis=1))
            edge = np.zeros(len(data) + 1, np.int64)
            np.add.at(edge, a, 1)
            np.add.at(edge, b, -1)
            gone = np.cumsum(edge)[:-1] > 0
            turn = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
            spans = list(zip(turn[::2].tolist(), turn[1::2].tolist(), strict=True))
            kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out["n_bytes"].append(len(data))
        out["n_removed"].append(len(data) - len(kept))
        out["n_spans"].append(len(spans))
        out["removed"].append([{"start": a, "end": b} for a, b in spans])
        out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
    return out | {"doc_id": batch.column(2)}


def settled_runs(texts: DataFrame, hot: np.ndarray) -> DataFrame:
    """The first sort: runs whose anchor is not unique, and what is known of them."""
    by_anchor = Window.partitionBy("anchor", "salt").orderBy("whole")
    near = map_batches(texts, lambda batch: _runs(batch, hot), _RUN)
    near = near.withColumns({"before": F.lag("whole").over(by_anchor), "after": F.lead("whole").over(by_anchor)})
    near = near.where(F.col("before").isNotNull() | F.col("after").isNotNull() | F.col("again") | (F.col("salt") != 0))
    repeated = (F.col("salt") < 0) | F.coalesce(F.col("before") == F.col("whole"), F.lit(False))
    first = F.col("again") | F.coalesce(F.col("after") == F.col("whole"), F.lit(False))
    near = near.withColumn("kind", F.when(repeated, REPEATED).when(first, SAMPLE).otherwise(LOOSE))
    # nothing can match the first of equal runs where all runs of the anchor are equal to others; hot anchors are not asked
    open_ = (F.col("salt") > 0) | (F.min("kind").over(Window.partitionBy("anchor", "salt")) == LOOSE)
    kind = F.when((F.col("kind") == SAMPLE) & ~open_, REPEATED).otherwise(F.col("kind"))
    return staged(near.select("ka", "kb", "start", "n", "off", "total", kind.cast("int").alias("kind")), "repeated-anchors")


def by_key(rows: DataFrame, a: Column, b: Column) -> DataFrame:
    """(ka, kb, runs): the runs of each key, which a text's length bounds."""
    return staged(rows.groupBy("ka", "kb").agg(F.collect_list(packed(F.col("start"), a, b, F.col("off"))).alias("runs")), "unsettled-runs")


def repeats(docs: DataFrame) -> DataFrame:
    """Every row of docs with the stretches (in bytes) that repeated strings cover, and the hash of what is left."""
    keyed = docs.select(row_key("doc_id", "text").alias("key"), "doc_id", "text").select("key.a", "key.b", "doc_id", "text")
    keyed = keyed.toDF("ka", "kb", "doc_id", "text")
    texts = keyed.select("ka", "kb", "text")
    hot = hot_anchors(docs)
    near = settled_runs(texts, hot)

    open_ = by_key(near.where(F.col("kind") != REPEATED), F.lit(0), F.col("n"))
    listed = beside(texts, open_, 8 * F.size("runs"), "inner").select("ka", "kb", "text", "runs")
    left = staged(map_batches(listed, _stretches, _STRETCH), "stretches")
    left = doubled(left, 1, ANCHOR)
    left = doubled(left, 2, 3 * ANCHOR)

    open_ = by_key(left, F.col("lo"), F.col("hi"))
    listed = beside(texts, open_, 8 * F.size("runs"), "inner").select("ka", "kb", "text", "runs")
    strings = map_batches(listed, lambda batch: _strings(batch, hot), _STRINGS).repartition("anchor", "salt")
    # one exchange by anchor; the window below needs no other
    strings = strings.select("anchor", "salt", "ka", "kb", "start", "m0", "m1", "m2", F.explode_outer(F.arrays_zip("i", "ranks")).alias("s"))
    strings = strings.select("anchor", "salt", "ka", "kb", "start", "m0", "m1", "m2", "s.i", F.col("s.ranks").alias("rank"))
    by_rank = Window.partitionBy("anchor", "salt", "rank").orderBy("i")
    twin = F.col("rank").isNotNull() & (F.lag("start").over(by_rank).isNotNull() | F.lead("start").over(by_rank).isNotNull())
    one = lambda k: F.when(F.col("twin") & (F.shiftright("i", 6) == k), F.expr("shiftleft(1L, i % 64)")).otherwise(F.lit(0).cast("long"))
    bits = lambda k: F.bit_or(F.col(f"m{k}").bitwiseOR(one(k))).alias(f"m{k}")
    singles = strings.withColumn("twin", twin).where("twin or m0 <> 0 or m1 <> 0 or m2 <> 0")
    singles = singles.groupBy("anchor", "salt", "ka", "kb", "start").agg(bits(0), bits(1), bits(2)).select("ka", "kb", "start", F.lit(0).alias("n"), "m0", "m1", "m2")

    none = F.lit(0).cast("long")
    whole = near.where(F.col("kind") != LOOSE).select("ka", "kb", "start", F.col("total").alias("n"), none.alias("m0"), none.alias("m1"), none.alias("m2"))
    found = whole.unionByName(singles).groupBy("ka", "kb").agg(F.collect_set(F.struct("start", "n", "m0", "m1", "m2")).alias("found"))
    # written, so that both sides of a shuffled join come straight from their shuffles and many equal rows can be split
    found = staged(found, "repeated-strings")
    joined = beside(keyed, found, 80 * F.size("found"), "left").select("ka", "kb", "doc_id", "text", "found")
    return map_batches(joined, _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<start:long,end:long>>")


def op6_suffix_dedup(docs: DataFrame) -> DataFrame:
    return repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
