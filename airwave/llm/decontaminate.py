"""Benchmark decontamination by spaced-seed hashing.

A spaced seed looks at fixed places of a short stretch of tokens and ignores the others, so a changed token at an
ignored place still gives the same hash. Seeds of the benchmark are hashed, joined in the tasks with the seeds of
every place of every document, and each hit is checked along its diagonal: a window of the item (WINDOW tokens, or
the whole item if shorter) counts as an overlap if at least MIN_MATCH of its tokens are equal in place.

Masks go by the item's length. Those for items below WINDOW tokens were chosen by enumeration: wherever the tokens lie that
MIN_MATCH lets differ, a seed survives, so no overlap is lost. From WINDOW tokens on, four changed tokens in a window leave a
seed of MASKS. Items of fewer than SOLID tokens must not differ and are one solid seed.

The benchmark is dealt into blocks of about BLOCK_TOKENS tokens by a hash of the row, and one map-only pass over the
documents is made for each block; a block is broadcast and its result written before the next is read, so neither the driver
nor a worker holds more than one, and nothing is shuffled. A benchmark of any size is held against all documents.

Hits are counted by item and diagonal in slices, so a text or an item of one token over and over takes memory for a slice.

Tokens are runs of ASCII letters (lower-cased), digits and non-ASCII bytes. Defined cases: null or empty texts hold
nothing and are contained in nothing; items without an id are reported with a null id; repeated rows give repeated results;
items of equal text are all reported; of an item's diagonals the one with most equal tokens, then most hits, then the first.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airwave.llm.common import KEY, map_batches, row_key, staged, utf8

#: Places looked at (1) and ignored (0), for items of WINDOW tokens and more.
MASKS = ("1101100110111", "1110010101011", "11101101")
#: Masks for shorter items, by the least length that they serve.
SHORT_MASKS = {
    15: ("1111011", "110010111", "111111", "1101111", "111010101"),
    8: ("111011", "11001011", "11111"),
    5: ("1111", "11011", "11101", "10111"),
}
#: The share of a window that has to be equal; items below SOLID tokens have to be equal as a whole.
WINDOW, MIN_MATCH, SOLID = 24, 0.8, 5
#: Items of fewer tokens say nothing about contamination: clean() does not look for them.
LEAST_TOKENS = 5
#: Tokens of the benchmark that are broadcast at once, about; hits, and tokens of diagonals, that are handled at once.
BLOCK_TOKENS, HITS = 1_000_000, 1 << 20

_KEEP = bytes(c if c >= 0x80 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_FACTORS = np.random.default_rng(5).integers(1, 2**62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BITS = 20
_RESULT = (
    f"key {KEY}, doc_id long, item_id long, n_seed_hits long, first_token long, n_tokens long, n_matched long, similarity double"
)


def tokens(data: bytes) -> np.ndarray:
    words = data.lower().translate(_KEEP).split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def masks_for(length: int) -> tuple[str, ...]:
    """The masks that are laid on an item of so many tokens."""
    if length >= WINDOW:
        return MASKS
    return next((m for least, m in SHORT_MASKS.items() if length >= least), ("1" * length,))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def seeds(codes: np.ndarray, mask: str) -> np.ndarray:
    """The hash of the mask's places at every start."""
    n = len(codes) - len(mask) + 1
    out = np.full(max(n, 0), len(mask) * 64 + mask.count("1"), np.uint64)
    if n > 0:
        for k, on in enumerate(mask):
            if on == "1":
                out += codes[k : k + n] * _FACTORS[k % 64]
                if k % 64 == 63:
                    out = _mixed(out)
    return _mixed(out)


class SeedBlock:
    """The sorted seeds of some items, and their tokens."""

    def __init__(self, items: list[tuple[int | None, np.ndarray]]) -> None:
        self.items = [(i, x) for i, x in items if len(x)]
        found = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        used: dict[str, None] = {}
        for place, (_, codes) in enumerate(self.items):
            for mask in masks_for(len(codes)):
                used[mask] = None
                h = seeds(codes, mask)
                found.append((h, np.full(len(h), place), np.arange(len(h))))
        self.masks = list(used)
        h, place, at = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(h, kind="stable")
        self.hashes, self.place, self.at = h[order], place[order], at[order]
        self.bitmap = np.zeros(1 << _BITS, bool)
        self.bitmap[(self.hashes >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def diagonals(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item's place, diagonal, equal seeds) of every diagonal that holds one, in order."""
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        shift = np.int64(1 << 32)
        for mask in self.masks:
            h = seeds(codes, mask)
            at = np.flatnonzero(self.bitmap[(h >> np.uint64(64 - _BITS)).astype(np.int64)])
            lo, hi = (np.searchsorted(self.hashes, h[at], side) for side in ("left", "right"))
            some = hi > lo
            at, lo, n = at[some], lo[some], (hi - lo)[some]
            total = np.cumsum(n)
            begin = 0
            while begin < len(at):  # so many places of the text that their hits are about HITS
                end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + HITS, "right")))
                m = n[begin:end]
                which = np.repeat(lo[begin:end] - np.cumsum(m) + m, m) + np.arange(m.sum())
                own, times = np.unique(self.place[which] * shift + np.repeat(at[begin:end], m) - self.at[which] + (shift >> 1), return_counts=True)
                keys, inverse = np.unique(np.concatenate((keys, own)), return_inverse=True)
                counts = np.bincount(inverse, np.concatenate((counts, times)), len(keys)).astype(np.int64)
                begin = end
        return keys // shift, keys % shift - (shift >> 1), counts

    def contained(self, item: np.ndarray, diagonals: np.ndarray, hits: np.ndarray, codes: np.ndarray) -> tuple[int, int, int, int] | None:
        """(equal tokens, hits, -first token, tokens) of an item's best diagonal that holds an overlap."""
        best, size, width = None, len(item), min(len(item), WINDOW)
        least = MIN_MATCH * width if size >= SOLID else width
        step = max(1, HITS // size)
        for begin in range(0, len(diagonals), step):
            own, n = diagonals[begin : begin + step], hits[begin : begin + step]
            at = own[:, None] + np.arange(size)
            inside = (at >= 0) & (at < len(codes))
            total = np.zeros((len(own), size + 1), np.int32)
            np.cumsum((codes[np.where(inside, at, 0)] == item) & inside, axis=1, out=total[:, 1:])
            good = total[:, width:] - total[:, :-width] >= least
            for row in np.flatnonzero(good.any(axis=1)) if good.any() else ():
                a, b = int(good[row].argmax()), size - int(good[row][::-1].argmax())
                lo, hi = max(a, -int(own[row])), min(b, len(codes) - int(own[row]))
                found = int(total[row, b] - total[row, a]), int(n[row]), -lo - int(own[row]), hi - lo
                best = found if best is None else max(best, found)
        return best

    def overlaps(self, codes: np.ndarray) -> list[tuple[int | None, int, int, int, int]]:
        """(item, seed hits, first token, tokens, equal tokens) of the best diagonal of each item that is contained."""
        if not len(self.hashes) or not len(codes):
            return []
        place, diagonal, hits = self.diagonals(codes)
        cuts = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1]))).tolist() if len(place) else []
        out = []
        for a, b in zip(cuts, [*cuts[1:], len(place)], strict=True) if cuts else ():
            item_id, item = self.items[place[a]]
            if best := self.contained(item, diagonal[a:b], hits[a:b], codes):
                equal, n, first, size = best
                out.append((item_id, n, -first, size, equal))
        return out


def blocks(benchmark: DataFrame, block_tokens: int = BLOCK_TOKENS, least_tokens: int = 1) -> Iterator[SeedBlock]:
    """The benchmark's items, dealt into blocks of bounded size; each is fetched when it is asked for."""
    items = benchmark.select("item_id", "text").where(F.col("text").isNotNull())
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-size // (6 * block_tokens)))
    for k in range(n):
        own = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        found = ((r.item_id, tokens(r.text.encode())) for r in own.toLocalIterator())
        yield SeedBlock(sorted((x for x in found if len(x[1]) >= least_tokens), key=lambda x: (x[0] is None, x[0] or 0)))


def leaks(docs: DataFrame, benchmark: DataFrame, block_tokens: int = BLOCK_TOKENS, least_tokens: int = 1) -> DataFrame:
    """One row for each document and benchmark item that it contains."""
    rows = docs.select(row_key("doc_id", "text").alias("key"), "doc_id", "text")
    context = docs.sparkSession.sparkContext

    def against(shared) -> DataFrame:
        def scan(batch: pa.RecordBatch) -> dict[str, list]:
            keys, ids = batch.column(0), batch.column(1)
            found = [(i, *x) for i, data in enumerate(utf8(batch)) for x in shared.value.overlaps(tokens(data))]
            at, item, n, first, size, equal = zip(*found, strict=True) if found else ((),) * 6
            at = pa.array(at, pa.int32())
            return {
                "key": keys.take(at), "doc_id": ids.take(at), "item_id": list(item), "n_seed_hits": list(n), "first_token": list(first), "n_tokens": list(size),
                "n_matched": list(equal), "similarity": [e / s for e, s in zip(equal, size, strict=True)],
            }

        return map_batches(rows, scan, _RESULT)

    made, waiting = [], None
    for block in blocks(benchmark, block_tokens, least_tokens):
        if waiting:  # another one follows: this one's result is written, and the block goes
            made.append(staged(against(waiting), "leaks"))
            waiting.unpersist()
        waiting = context.broadcast(block)
    return reduce(DataFrame.unionByName, [*made, against(waiting)])


def op7_decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return leaks(docs, benchmark).drop("key")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that contain no benchmark item of LEAST_TOKENS tokens or more."""
    # written first, so that Spark knows its size and shuffles texts only if it is too large to broadcast
    found = staged(leaks(docs, benchmark, least_tokens=LEAST_TOKENS).select(F.col("key").alias("__key")).distinct(), "found")
    rows = docs.withColumn("__key", row_key("doc_id", "text"))
    return rows.join(found, "__key", "left_anti").select(docs.columns)
