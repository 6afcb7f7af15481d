"""Near duplicates by the SimHash index and hashes of minima, confirmed by exact Jaccard similarity of word shingles.

Texts whose SimHash fingerprints hang together in the Gray-order index (simhash_gray) are a bucket; it proposes, too, what is near in
bits. Two bits alone leave out half of the near copies, so hashes of minima propose the rest.

Shingles are SHINGLE words (a shorter text is one shingle). Texts of equal words are one text. Each text has BANDS
buckets, a hash of ROWS minima of its shingles' hashes for each; a pair of similarity s shares no bucket with
probability (1 - s**ROWS)**BANDS, which is 3e-6 at LEAST and less above. Buckets only propose: their members are compared by
the whole sets of shingles, as pivot_links says, and linked at LEAST or more. Shingles are made only for texts that share a bucket.

Defined cases: no words (or null text) is a text of its own, equal to all others without words; null ids are no
candidates for component_id; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airwave.llm.common import KEY, map_batches, row_key, sized, staged, utf8
from airwave.llm.pivot_links import BLOCK, distinct_buckets, similar
from airwave.llm.simhash_gray import keep_least, labelled, least_ids, signed, simhash, star_components
from airwave.llm.simhash_gray import near_links as gray_links

#: Words of a shingle, and the least similarity as a fraction of whole numbers.
SHINGLE, LEAST = 5, (4, 5)
BANDS, ROWS = 32, 5

_U = np.uint64
_RND = np.random.default_rng(17)
_FACTORS = _RND.integers(1, 2**62, SHINGLE, dtype=_U) * _U(2) + _U(1)
_FLIPS, _TURNS = _RND.integers(0, 2**63, BANDS * ROWS, dtype=_U), _RND.integers(1, 2**62, BANDS * ROWS, dtype=_U) * _U(2) + _U(1)
_BAND = _RND.integers(0, 2**63, BANDS, dtype=_U)
_CHUNK = 256


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def shingles(words: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of the shingles."""
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U, len(words))
    k = min(size, len(codes))
    n = len(codes) - k + 1 if k else 0
    out = np.full(n, k, _U)
    for i in range(k):
        out += codes[i : i + n] * _FACTORS[i]
    return np.unique(mixed(out))


def minima(hashes: np.ndarray, flips: np.ndarray, turns: np.ndarray) -> np.ndarray:
    """The least of the hashes under each of some permutations."""
    least = np.full(len(flips), ~_U(0))
    for at in range(0, len(hashes), _CHUNK):
        np.minimum(least, ((hashes[at : at + _CHUNK, None] ^ flips) * turns).min(axis=0), out=least)
    return least


def buckets(hashes: np.ndarray) -> np.ndarray:
    out = _BAND.copy()
    for row in mixed(minima(hashes, _FLIPS, _TURNS)).reshape(BANDS, ROWS).T:
        out = mixed(out * _U(0x9E3779B97F4A7C15) + row)
    return out


def _marks(batch: pa.RecordBatch) -> dict[str, list]:
    fps, own, gray = [], [], []
    for data in utf8(batch):
        words = data.lower().split()
        fps.append(xxhash.xxh64_intdigest(b" ".join(words), 42) - (1 << 63))
        own.append(buckets(shingles(words)).view(np.int64) if words else [])
        gray.append(signed(simhash(data)) if words else None)
    return {"key": batch.column(0), "doc_id": batch.column(1), "fp": fps, "buckets": own, "gray": gray}


def shingle_sets(docs: DataFrame, marked: DataFrame, member: DataFrame, size: int) -> DataFrame:
    """(fp, shingles): the sorted distinct hashes of the shingles of texts that share a bucket; a text that many rows have is made once."""
    wanted = marked.groupBy("fp").agg(F.min("key").alias("key")).join(member.select("fp").distinct(), "fp", "left_semi")
    texts = docs.select(row_key("doc_id", "text").alias("key"), "text").join(sized(staged(wanted, "near-wanted")), "key").select("fp", "text")
    made = lambda batch: {"fp": batch.column(0), "shingles": [shingles(x.lower().split(), size).tobytes() for x in utf8(batch)]}
    # equal rows share a key
    return staged(map_batches(texts, made, "fp long, shingles binary", slices=True).groupBy("fp").agg(F.first("shingles").alias("shingles")), "shingle-sets")


def gray_buckets(marked: DataFrame) -> DataFrame:
    """(fp, bucket): texts whose fingerprints hang together by the links of the SimHash index, in a bucket for each component."""
    texts = staged(marked.where("gray IS NOT NULL").select("fp", "gray").distinct(), "gray-texts")
    stars = star_components(gray_links(texts.select(F.col("gray").alias("fp")).distinct()))
    roots = texts.join(stars.select(F.col("v").alias("gray"), "root"), "gray", "left")
    return roots.select("fp", F.xxhash64(F.lit("gray"), F.coalesce("root", "gray")).alias("bucket"))


def near_links(docs: DataFrame, marked: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b): links between texts that join the same components as all pairs which share a bucket and are similar."""
    own = marked.select("fp", "buckets").distinct().select("fp", F.explode("buckets").alias("bucket"))
    member = distinct_buckets(gray_buckets(marked).unionByName(own))
    return similar(member, shingle_sets(docs, marked, member, SHINGLE), LEAST, block)


def components(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(key, doc_id, fp, component_id) for every row of docs; fp is a hash of the text's words."""
    rows = docs.select(row_key("doc_id", "text").alias("key"), "doc_id", "text")
    marked = staged(map_batches(rows, _marks, f"key {KEY}, doc_id long, fp long, buckets array<long>, gray long", slices=True), "near-marks")
    return labelled(marked, least_ids(marked), near_links(docs, marked, block))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group: that of the component's id; a group without any id keeps its rows."""
    return keep_least(docs, components(docs))
