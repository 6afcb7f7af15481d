"""Near duplicates by MinHash with tensored banding, verified on the whole sets of shingles.

A text is the set of its SHINGLE-word shingles (shorter: the whole sequence). Two collections of SIDE hashes each, every hash
of ROWS minima, give SIDE * SIDE tables: a table's key is a pair, one hash of the first collection and one of the second. So
2 * SIDE * ROWS minima (84) do the work of 2 * ROWS * SIDE**2 (1176). A pair of similarity s shares no key with probability
1 - (1 - (1 - s**ROWS)**SIDE)**2, which is 4e-6 at 0.85 and less above.

Keys are formed only from hashes that another text has too, so texts without a likeness leave after their 2 * SIDE hashes were
counted, and no table holds them. Texts of the same words are one text; keys with the same members are one. Candidates are
compared by whole sets as pivot_links says, and linked texts get their component by star contraction.

Defined cases: no words (or null text) is linked with nothing and is its own component; a null id is no candidate for
component_id, and a component without any id has a null one and is kept; equal rows are near duplicates of each other
and are each a row; an empty table gives an empty result; columns besides doc_id and text, whatever their names, are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airwave.llm import near_duplicates as near
from airwave.llm.common import KEY, map_batches, row_key, staged, utf8
from airwave.llm.pivot_links import BLOCK, distinct_buckets, similar
from airwave.llm.simhash_gray import labelled, least_ids

#: Words of a shingle, and the least similarity as a fraction of whole numbers.
SHINGLE, LEAST = 3, (85, 100)
#: Hashes of a collection, and minima of a hash.
SIDE, ROWS = 14, 3

_U = np.uint64
_RND = np.random.default_rng(29)
_FLIPS, _TURNS = _RND.integers(0, 2**63, 2 * SIDE * ROWS, dtype=_U), _RND.integers(1, 2**62, 2 * SIDE * ROWS, dtype=_U) * _U(2) + _U(1)
_PLACE = _RND.integers(0, 2**63, 2 * SIDE, dtype=_U)


def hashes(shingles: np.ndarray) -> np.ndarray:
    """The 2 * SIDE hashes of a set, those of the first collection first."""
    out = _PLACE.copy()
    for row in near.mixed(near.minima(shingles, _FLIPS, _TURNS)).reshape(2 * SIDE, ROWS).T:
        out = near.mixed(out * _U(0x9E3779B97F4A7C15) + row)
    return out


def _marks(batch: pa.RecordBatch) -> dict[str, list]:
    fps, sizes, own = [], [], []
    for data in utf8(batch):
        words = data.lower().split()
        found = near.shingles(words, SHINGLE)
        fps.append(xxhash.xxh64_intdigest(b" ".join(words), 42) - (1 << 63))
        sizes.append(len(found))
        own.append(hashes(found).view(np.int64) if words else [])
    return {"key": batch.column(0), "doc_id": batch.column(1), "fp": fps, "n_shingles": sizes, "hashes": own}


def table_keys(marked: DataFrame) -> DataFrame:
    """(bucket, fp): the table keys of texts, from those of their hashes that another text has too."""
    texts = staged(marked.groupBy("fp").agg(F.first("hashes").alias("hashes")), "minhash-texts")
    each = texts.select("fp", F.posexplode("hashes").alias("at", "h"))
    shared = staged(each.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "shared-halves")
    own = each.join(shared, "h", "left_semi").groupBy("fp").agg(F.collect_list(F.struct("at", "h")).alias("own"))  # 2 * SIDE at most
    side = lambda first: F.transform(F.filter("own", lambda x: (x["at"] < SIDE) == F.lit(first)), lambda x: x["h"])
    keys = F.flatten(F.transform(side(True), lambda a: F.transform(side(False), lambda b: F.xxhash64(a, b))))
    return own.select("fp", F.explode(keys).alias("bucket"))


def components(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(key, doc_id, fp, component_id, n_shingles) for every row of docs."""
    rows = docs.select(row_key("doc_id", "text").alias("key"), "doc_id", "text")
    marked = staged(map_batches(rows, _marks, f"key {KEY}, doc_id long, fp long, n_shingles long, hashes array<long>"), "minhash-marks")
    member = distinct_buckets(table_keys(marked.where("n_shingles > 0")))
    links = similar(member, near.shingle_sets(docs, marked, member, SHINGLE), LEAST, block)
    named = labelled(marked, least_ids(marked), links, "n_shingles")
    return named.withColumn("component_id", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")))


def op13_minhash_tensor(docs: DataFrame) -> DataFrame:
    return components(docs).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
