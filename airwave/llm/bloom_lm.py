"""Language-model scoring with a log-frequency Bloom filter.

A count c is quantised to the level 1 + floor(log2 c), and an n-gram of level q is put into the filter q times, once with
each level up to q. A count is read back by probing levels upwards until one is missing. The filter holds the
one- and two-token counts of the training documents; probabilities interpolate the two orders, the pairs' with an absolute
discount, so that a pair seen once with a token seen once is not as certain as one seen often.

N-grams are counted where they are read (sorted arrays of hashes and counts) and meet in shards by hash; each shard
counts up, and makes its own segment of the filter, BITS bits to an entry at every size. There is a shard to every
SHARD_BYTES of text, so the memory of its task does not grow with the corpus.
Segments are broadcast in groups of MAX_BITS bits. A task holds one group at a time: where there are several, the codes
of a whole batch of documents are held against one after the other, each code against the group of its shard.

The base score needs exact counts. The most frequent tokens, HEAD at most, are broadcast as sorted arrays; the others are
joined by Spark on their hashes.

Defined cases: null text is empty and has one token, the end; null ids train and are not held out; equal rows get equal
results; without training documents N and V are 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airwave.llm.common import id_remainder, map_batches, shuffle_width, staged, utf8

MODULUS, HELD_OUT = 7, 2
#: Bits to an entry, hash functions, and the most bits of a group of segments (256 MB).
BITS, HASHES, MAX_BITS = 8, 4, 1 << 31
#: Weight of the two-token estimate, and what is taken off the count of a pair.
WEIGHT, DISCOUNT = 0.6, 0.75
#: Bytes of training text to a shard, at most on average; a shard is counted in one task.
SHARD_BYTES = 1 << 27
#: Exact counts that are broadcast at most.
HEAD = 1 << 20
#: Tokens that are handled at once in a task, slices that are counted before they are sent, and slices that wait for a pass
#: over several groups of segments.
SLICE, COUNTED, WAITING = 400_000, 6, 12

_U = np.uint64
_END = xxhash.xxh3_64_intdigest(b"")
_START = _U(0x5851F42D4C957F2D)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def token_hashes(data: bytes) -> np.ndarray:
    words = data.lower().split()
    words.append(b"")
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U, len(words))


def slices(texts: list[bytes], size: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first document, lengths, token hashes) of runs of documents with about size tokens."""
    first, held, n = 0, [], 0
    for i, data in enumerate(texts):
        held.append(token_hashes(data))
        n += len(held[-1])
        if n >= size or i == len(texts) - 1:
            yield first, np.array([len(x) for x in held]), np.concatenate(held)
            first, held, n = i + 1, [], 0


def pair_codes(tokens: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A code of each token with the one before it in its document."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[np.cumsum(lengths) - lengths] = _START
    return mixed(before * _U(0x9E3779B97F4A7C15) + mixed(tokens))


def levels_of(counts: np.ndarray) -> np.ndarray:
    return np.frexp(counts.astype(float))[1]


def count_of(level: np.ndarray) -> np.ndarray:
    """The middle of the counts of a level; 0 for level 0."""
    return np.where(level > 0, (3 * np.exp2(level - 1.0) - 1) / 2, 0.0)


def probability(pair: np.ndarray, context: np.ndarray, token: np.ndarray, total: int) -> np.ndarray:
    """The interpolated probability of tokens from the counts of the pairs they end, of the tokens before, and of their own."""
    ratio = np.divide(np.maximum(pair - DISCOUNT, 0), context, out=np.zeros(len(pair)), where=context > 0)
    return WEIGHT * np.minimum(1.0, ratio) + (1 - WEIGHT) * np.minimum(1.0, (token + 1) / total)


def summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    cut = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1]))) if len(codes) else np.zeros(0, np.int64)
    return codes[cut], np.add.reduceat(counts, cut) if len(cut) else counts


def places(codes: np.ndarray, level: int, bits: np.ndarray | int) -> Iterator[np.ndarray]:
    """The bits of an entry within its segment, one array for each hash function."""
    g = mixed(codes + _U(level * 0xD6E8FEB86659FD93 % (1 << 64)))
    step = (g >> _U(32)) | _U(1)
    low = g & _U(0xFFFFFFFF)
    for k in range(HASHES):
        yield (low + _U(k) * step) % bits


class LogFrequencyFilter:
    def __init__(self, segments: dict[int, tuple[int, bytes]], shards: int) -> None:
        self.shards = _U(shards)
        self.bits = np.array([segments.get(s, (8, b"\0"))[0] for s in range(shards)], _U)
        self.start = np.concatenate(([0], np.cumsum(self.bits)[:-1])).astype(_U)
        self.data = np.frombuffer(b"".join(segments.get(s, (8, b"\0"))[1] for s in range(shards)), np.uint8)

    def levels(self, codes: np.ndarray) -> np.ndarray:
        """The level of each code: probes upwards until one is missing."""
        out = np.zeros(len(codes), np.int64)
        shard, left = shard_of(codes, int(self.shards)), np.arange(len(codes))
        for level in range(1, 64):
            own = shard[left]
            spots = places(codes[left], level, self.bits[own])
            ok = np.ones(len(left), bool)
            for spot in spots:
                spot = spot + self.start[own]
                ok &= (self.data[spot >> _U(3)] >> (spot & _U(7)).astype(np.uint8)) & 1 == 1
                if not ok.any():
                    return out
            left = left[ok]
            out[left] = level
        return out


class GroupedFilter:
    """A filter whose segments are broadcast in groups; one group is in memory at a time."""

    def __init__(self, groups: list, group_of: np.ndarray) -> None:
        self.groups, self.group_of = groups, group_of
        self.slices = 1 if len(groups) < 2 else WAITING

    def levels(self, codes: np.ndarray) -> np.ndarray:
        if len(self.groups) == 1:
            return self.groups[0].value.levels(codes)
        out = np.zeros(len(codes), np.int64)
        own = self.group_of[shard_of(codes, len(self.group_of))]
        for g, shared in enumerate(self.groups):
            at = np.flatnonzero(own == g)
            if len(at):
                # value would keep every group for as long as the worker lives
                lm = shared.value if hasattr(shared, "_value") else shared.load_from_path(shared._path)
                out[at] = lm.levels(codes[at])
                del lm
        return out


def shard_of(codes: np.ndarray, shards: int) -> np.ndarray:
    return ((codes >> _U(40)) * _U(shards) >> _U(24)).astype(np.int64)


def _counted(shards: int):
    """Batches of texts to (shard, order, codes, counts): sorted codes with their counts, as bytes."""
    schema = pa.schema([("shard", pa.int32()), ("n", pa.int32()), ("codes", pa.binary()), ("counts", pa.binary())])

    def emit(order: int, codes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        cuts = np.searchsorted(shard_of(codes, shards), np.arange(shards + 1))
        some = np.flatnonzero(np.diff(cuts))
        parts = [(int(s), order, codes[cuts[s] : cuts[s + 1]].tobytes(), counts[cuts[s] : cuts[s + 1]].astype(np.uint32).tobytes()) for s in some]
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*parts, strict=True), schema, strict=True)], schema=schema)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {1: [], 2: []}
        waiting = 0

        def flush():
            for order, parts in held.items():
                if parts:
                    yield emit(order, *summed(np.concatenate([c for c, _ in parts]), np.concatenate([n for _, n in parts])))
                    parts.clear()

        for batch in batches:
            for _, lengths, tokens in slices(utf8(batch)):
                for order, codes in ((1, mixed(tokens)), (2, pair_codes(tokens, lengths))):
                    held[order].append(np.unique(codes, return_counts=True))
                waiting += len(tokens)
                if waiting > COUNTED * SLICE:
                    yield from flush()
                    waiting = 0
        yield from flush()

    return go


def _segment(shards: int, max_bits: int):
    """All parts of a shard to its exact token counts and its segment of the filter, which is never above BITS to an entry.

    A segment of more than max_bits is a group by itself.
    """

    def go(group: pd.DataFrame) -> pd.DataFrame:
        entries, exact = [], None
        for order in (1, 2):
            own = group[group.n == order]
            codes, counts = summed(np.frombuffer(b"".join(own.codes), _U), np.frombuffer(b"".join(own.counts), np.uint32).astype(np.int64))
            entries.append((codes, levels_of(counts)))
            if order == 1:
                exact = codes, counts
        total = int(sum(q.sum() for _, q in entries))
        bits = max(8, -(-total * BITS // 8) * 8)
        data = np.zeros(bits, bool)
        for codes, q in entries:
            for level in range(1, int(q.max(initial=0)) + 1):
                for spot in places(codes[q >= level], level, _U(bits)):
                    data[spot.astype(np.int64)] = True
        sizes = np.bincount(levels_of(exact[1]), minlength=64)
        return pd.DataFrame(
            {
                "shard": [int(group.shard.iloc[0])], "bits": [bits], "segment": [np.packbits(data, bitorder="little").tobytes()],
                "tokens": [int(exact[1].sum())], "by_level": [sizes.tolist()], "codes": [exact[0].tobytes()], "counts": [exact[1].astype(np.int64).tobytes()],
            }
        )

    return go


_SHARD = "shard int, bits long, segment binary, tokens long, by_level array<long>, codes binary, counts binary"


def _unpacked(least: int, most: int):
    def go(batch: pa.RecordBatch) -> dict[str, list]:
        codes = [np.frombuffer(x, np.int64) for x in batch.column(0).to_pylist()]
        counts = [np.frombuffer(x, np.int64) for x in batch.column(1).to_pylist()]
        c, n = np.concatenate(codes), np.concatenate(counts)
        ok = (n >= least) & (n < most)
        return {"code": c[ok], "count": n[ok]}

    return go


class Scorer:
    def __init__(self, head: tuple[np.ndarray, np.ndarray], tokens: int, distinct: int) -> None:
        self.codes, self.counts, self.tokens, self.distinct = *head, tokens, distinct

    def exact(self, codes: np.ndarray) -> np.ndarray:
        """The counts of the head; -1 for codes outside it."""
        if not len(self.codes):
            return np.full(len(codes), -1)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.counts[at], -1)

    @staticmethod
    def levelled(texts: list[bytes], lm: GroupedFilter) -> Iterator[tuple]:
        """The slices of texts: first document, lengths, and codes, places and levels of tokens and of pairs."""
        held = []

        def flush():
            found = lm.levels(np.concatenate([x for _, _, one, _, two, _ in held for x in (one, two)]))
            at = 0
            for first, lengths, one, inverse, two, where in held:
                mid, end = at + len(one), at + len(one) + len(two)
                yield first, lengths, one, inverse, two, where, found[at:mid], found[mid:end]
                at = end
            held.clear()

        for first, lengths, tokens in slices(texts):
            one, inverse = np.unique(mixed(tokens), return_inverse=True)
            two, where = np.unique(pair_codes(tokens, lengths), return_inverse=True)
            held.append((first, lengths, one, inverse.astype(np.int32), two, where.astype(np.int32)))
            if len(held) >= lm.slices:
                yield from flush()
        if held:
            yield from flush()

    def __call__(self, batch: pa.RecordBatch, lm: GroupedFilter) -> dict[str, list]:
        texts = utf8(batch)
        out = {k: np.zeros(len(texts)) for k in ("head_score", "score", "n_tokens", "head_known")}
        tail: list = [None] * len(texts)
        total = self.tokens + self.distinct + 1
        for first, lengths, one, inverse, _, where, level_one, level_two in self.levelled(texts, lm):
            doc = np.repeat(np.arange(len(lengths)), lengths)
            rows = slice(first, first + len(lengths))
            exact = self.exact(one)[inverse]
            known = exact >= 0
            out["n_tokens"][rows] = lengths
            out["head_known"][rows] = np.bincount(doc, known, len(lengths))
            out["head_score"][rows] = np.bincount(doc, np.where(known, np.log10(np.maximum(exact + 1, 1) / total), 0), len(lengths))
            single = count_of(level_one)[inverse]
            double = count_of(level_two)[where]
            context = np.empty(len(inverse))
            context[1:] = single[:-1]
            context[np.cumsum(lengths) - lengths] = single[-1]  # as many starts as ends
            out["score"][rows] = np.bincount(doc, np.log10(probability(double, context, single, total)), len(lengths))
            ends = np.cumsum(lengths)
            for i, (a, b) in enumerate(zip(ends - lengths, ends, strict=True)):
                tail[first + i] = one[inverse[a:b][~known[a:b]]].view(np.int64)
        sizes = np.concatenate(([0], np.cumsum([len(x) for x in tail]))).astype(np.int32)
        flat = np.concatenate(tail) if tail else np.zeros(0, np.int64)
        return {
            "doc_id": batch.column(1), "held_out": batch.column(2), "n_tokens": out["n_tokens"].astype(np.int64), "head_known": out["head_known"].astype(np.int64),
            "head_score": out["head_score"], "score": out["score"], "tail": pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat)),
        }


def scores(docs: DataFrame, head: int = HEAD, max_bits: int = MAX_BITS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Every row of docs with its counts, base score and the model's score."""
    spark = docs.sparkSession
    rows = docs.select("text", "doc_id", F.coalesce(id_remainder("doc_id", MODULUS) == HELD_OUT, F.lit(False)).alias("held_out"))
    training = rows.where(~F.col("held_out")).select("text")
    size = training.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(32, 2 * shuffle_width(spark), -(-size // shard_bytes))
    parts = training.mapInArrow(_counted(shards), "shard int, n int, codes binary, counts binary")
    made = staged(parts.groupBy("shard").applyInPandas(_segment(shards, max_bits), _SHARD), "ngram-shards")

    segments, groups, group_of, held = {}, [], np.zeros(shards, np.int64), 0
    tokens, by_level = 0, np.zeros(64, np.int64)
    for r in made.select("shard", "bits", "segment", "tokens", "by_level").toLocalIterator():
        if segments and held + r.bits > max_bits:
            groups.append(spark.sparkContext.broadcast(LogFrequencyFilter(segments, shards)))
            segments, held = {}, 0
        segments[r.shard] = r.bits, bytes(r.segment)
        group_of[r.shard] = len(groups)
        held += r.bits
        tokens += r.tokens
        by_level += np.array(r.by_level)
    above = by_level[::-1].cumsum()[::-1]
    level = next((i for i in range(1, 64) if above[i] <= head), 63)
    counts = lambda least, most: map_batches(made.select("codes", "counts"), _unpacked(least, most), "code long, count long")
    top = counts(1 << (level - 1), 1 << 62).toArrow()
    codes = top["code"].to_numpy().view(_U)
    order = np.argsort(codes)
    groups.append(spark.sparkContext.broadcast(LogFrequencyFilter(segments, shards)))
    lm, scorer = GroupedFilter(groups, group_of), Scorer((codes[order], top["count"].to_numpy()[order]), tokens, int(by_level.sum()))
    shared = spark.sparkContext.broadcast(scorer)
    schema = "doc_id long, held_out boolean, n_tokens long, head_known long, head_score double, score double, tail array<long>"
    scored = map_batches(rows, lambda batch: shared.value(batch, lm), schema)
    scored = staged(scored.withColumn("row", F.monotonically_increasing_id()), "head-scores")

    total = F.lit(float(scorer.tokens + scorer.distinct + 1))
    rare = scored.select("row", F.explode("tail").alias("code")).groupBy("row", "code").count().withColumnRenamed("count", "times")
    if level > 1:
        rare = rare.join(counts(1, 1 << (level - 1)), "code", "left")
    else:
        rare = rare.withColumn("count", F.lit(None).cast("long"))
    seen = F.coalesce("count", F.lit(0))
    rare = rare.groupBy("row").agg(
        F.sum(F.col("times") * F.log10((seen + 1) / total)).alias("rare_score"), F.sum(F.when(seen > 0, F.col("times")).otherwise(0)).alias("rare_known")
    )
    return scored.drop("tail").join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("head_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("head_score") + F.coalesce("rare_score", F.lit(0.0))).alias("base_score"),
        "score",
    )


def op5_bloom_lm(docs: DataFrame) -> DataFrame:
    return scores(docs)
