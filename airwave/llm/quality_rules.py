"""Quality rules by cross-document line frequency.

Lines are normalised (ASCII lower case, runs of white space to one space) and hashed. For each host (column
``source``) the distinct documents that hold a line are counted. A document is distinct by its text: copies of a page are
one, or else a page that was crawled often would lose all of its lines in all of its copies. A line above a limit - a share of
the host's documents, or for lines of several words a number of them - is removed from all of the host's documents; a
document that keeps too small a share of its words is rejected.

The text is read in one Arrow pass, which gives the per-document figures and the hashed lines; counting is a
partially aggregated shuffle of (host, line, text) hashes. The few lines above their limits are written and joined back:
broadcast by Spark while they are small, else by shuffles whose hot keys Spark can split.

Defined cases: null text is empty text; a null source is the host ''; lines without a word are never counted nor
removed; equal rows count as copies of one text and get equal results; an empty table gives an empty result. Only
the named columns are read, so further columns (also ones named like results) do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from airwave.llm.common import KEY, SPACE, map_batches, row_key, staged, utf8
from airwave.llm.rewrite import rewrite_text

#: A line is removed when more than MIN_DOCS documents of its host hold it and these are above MAX_SHARE of the host's,
MIN_DOCS, MAX_SHARE = 20, 0.05
#: or when more than MAX_DOCS hold it, at whatever size of the host, if it has LINE_WORDS words at least.
MAX_DOCS, LINE_WORDS = 200, 5
#: A document is depleted when less than this share of its words is left.
LEAST_LEFT = 0.3
#: Base rule: fewer words than this fail, and more repeated words than this percentage.
LEAST_WORDS, MOST_REPEATED = 20, 30
WINDOW = 8
#: Frequent lines are broadcast to the rewriting of texts up to this number (16 MB).
BROADCAST_LINES = 1 << 20

SYMBOLS = b"#*$%&|<>"
_NOT_CHARS = SPACE + bytes(range(0x80, 0xC0))
_FEATURES = (
    f"key {KEY}, doc_id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, body long, lines array<struct<h:long,w:int>>"
)
_PRIMES = np.random.default_rng(11).integers(1, 2**62, WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows that are found twice or more in the text. Hashes propose windows, the words decide."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.uint64, len(words))
    if len(ids) > len(words) - 2:
        return 0
    codes = (codes + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    codes ^= codes >> np.uint64(29)
    keys = np.zeros(n, np.uint64)
    for k in range(window):
        keys += codes[k : k + n] * _PRIMES[k % WINDOW]
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    if not same.any():
        return 0
    twin = np.zeros(n, bool)
    twin[order[1:][same]] = True
    twin[order[:-1][same]] = True
    starts, seen = np.flatnonzero(twin).tolist(), {}
    for s in starts:
        seen.setdefault(tuple(words[s : s + window]), []).append(s)
    edge = np.zeros(len(words) + 1, np.int64)
    for group in seen.values():
        if len(group) > 1:
            np.add.at(edge, group, 1)
            np.add.at(edge, np.asarray(group) + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def normalised(line: bytes) -> bytes:
    return b" ".join(line.lower().split())


def line_hash(line: bytes) -> int:
    return xxhash.xxh64_intdigest(line, 42) - (1 << 63)


def _features(batch: pa.RecordBatch) -> dict[str, list]:
    out: dict[str, list] = {k: [] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "body", "lines")}
    for data in utf8(batch):
        words = data.split()
        with_word = [x for x in data.split(b"\n") if x and not x.isspace()]
        weights: dict[int, int] = {}
        for line in with_word:
            own = line.lower().split()
            h = line_hash(b" ".join(own))
            weights[h] = weights.get(h, 0) + len(own)
        out["n_words"].append(len(words))
        out["word_chars"].append(len(data.translate(None, _NOT_CHARS)))
        out["n_symbols"].append(len(data) - len(data.translate(None, SYMBOLS)))
        out["n_dup_lines"].append(len(with_word) - len(set(with_word)))
        out["n_repeat_words"].append(repeated_words(words))
        out["body"].append(xxhash.xxh64_intdigest(data, 7) - (1 << 63))
        out["lines"].append([{"h": h, "w": w} for h, w in weights.items()])
    return out | {k: batch.column(batch.schema.get_field_index(k)) for k in ("key", "doc_id", "host")}


def line_features(docs: DataFrame) -> DataFrame:
    """One row per document: base figures and its distinct normalised lines as (hash, words)."""
    rows = docs.select("doc_id", "source", "text").select(
        row_key("doc_id", "source", "text").alias("key"), "doc_id", F.coalesce("source", F.lit("")).alias("host"), "text"
    )
    return map_batches(rows, _features, _FEATURES)


def frequent_lines(features: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, max_docs: int = MAX_DOCS) -> DataFrame:
    """(host, h, n_docs): lines that more distinct documents of a host hold than a limit allows."""
    lines = features.select("host", "body", F.explode("lines").alias("line")).select("host", "body", "line.h", "line.w").distinct()
    counts = lines.groupBy("host", "h", "w").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") > min_docs)
    hosts = features.select("host", "body").distinct().groupBy("host").agg(F.count("*").alias("host_docs"))
    above = (F.col("n_docs") > F.lit(max_share) * F.col("host_docs")) | ((F.col("n_docs") > max_docs) & (F.col("w") >= LINE_WORDS))
    return counts.join(hosts, "host").where(above).select("host", "h", "n_docs")


def verdicts(
    docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, max_docs: int = MAX_DOCS, least_left: float = LEAST_LEFT
) -> DataFrame:
    """Every row of docs with its figures, the hashes of its removed lines and the verdict."""
    features = staged(line_features(docs), "line-features")
    frequent = staged(frequent_lines(features, min_docs, max_share, max_docs).select("host", "h"), "frequent-lines")
    return judged(features, frequent, least_left)


def judged(features: DataFrame, frequent: DataFrame, least_left: float) -> DataFrame:
    """features with the hashes of removed lines and the verdict."""
    removed = (
        features.select("key", "host", F.explode("lines").alias("line"))
        .select("key", "host", "line.h", "line.w")
        .join(frequent, ["host", "h"], "left_semi")
        .groupBy("key")
        .agg(F.collect_set(F.struct("h", "w")).alias("gone"))  # a set, as equal rows share a key
    )
    removed = staged(removed, "removed-lines")
    gone = F.aggregate("gone", F.lit(0).cast("long"), lambda acc, x: acc + x["w"])
    return (
        features.drop("lines")
        .join(removed, "key", "left")
        .withColumn("removed", F.col("gone.h"))
        .withColumn("n_removed_words", F.coalesce(gone, F.lit(0).cast("long")))
        .withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))
        .withColumn("kept", ~F.col("base_failed") & (F.col("n_words") - F.col("n_removed_words") >= F.lit(least_left) * F.col("n_words")))
    )


def op1_quality_rules(docs: DataFrame) -> DataFrame:
    return verdicts(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words"
    )


def without(text: bytes, gone: np.ndarray) -> tuple[bytes, int]:
    """The text without lines whose hashes are in the sorted array, and the words that go."""
    left, words = [], 0
    for line in text.split(b"\n"):
        own = line.lower().split()
        h = line_hash(b" ".join(own)) if own else None
        at = np.searchsorted(gone, h) if own else 0
        if own and at < len(gone) and gone[at] == h:
            words += len(own)
        else:
            left.append(line)
    return b"\n".join(left), words


def clean(docs: DataFrame, least_left: float = LEAST_LEFT, **limits: float) -> DataFrame:
    """The documents that stay, with their columns, without the lines above the limits; n_chars is counted anew.

    Frequent lines are few, as each takes many documents. Below BROADCAST_LINES, which is counted, they are broadcast and each text is judged
    and changed where it is read, so no text is shuffled; beyond it, verdicts are joined by key.
    """
    features = staged(line_features(docs), "line-features")
    frequent = staged(frequent_lines(features, **limits).select("host", "h"), "frequent-lines")
    if frequent.count() > BROADCAST_LINES:
        return _joined_clean(docs, judged(features, frequent, least_left))
    hosts: dict[str, list[int]] = {}
    for r in frequent.toLocalIterator():
        hosts.setdefault(r.host, []).append(r.h)
    shared = docs.sparkSession.sparkContext.broadcast({host: np.sort(np.array(h, np.int64)) for host, h in hosts.items()})
    schema = to_arrow_schema(docs.schema)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(schema.names, batch.columns, strict=True))
            stays, texts, changed = [], columns["text"].to_pylist(), False
            for i, (data, host) in enumerate(zip(utf8(batch), columns["source"].to_pylist(), strict=True)):
                words = data.split()
                if len(words) < LEAST_WORDS or 100 * repeated_words(words) > MOST_REPEATED * len(words):
                    continue
                if (gone := shared.value.get(host or "")) is not None:
                    left, n = without(data, gone)
                    if len(words) - n < least_left * len(words):
                        continue
                    if n:
                        texts[i], changed = left.decode(), True
                stays.append(i)
            at = pa.array(stays, pa.int64())
            if changed:
                sizes = [len(texts[i]) if texts[i] is not None else None for i in stays]
                columns = {k: c.take(at) for k, c in columns.items()}
                if "n_chars" in columns:
                    before = columns["n_chars"].to_pylist()
                    old = columns["text"].to_pylist()
                    columns["n_chars"] = pa.array([n if texts[i] != o else b for i, n, o, b in zip(stays, sizes, old, before, strict=True)], schema.field("n_chars").type)
                columns["text"] = pa.array([texts[i] for i in stays], schema.field("text").type)
                yield pa.RecordBatch.from_arrays(list(columns.values()), schema=schema)
            else:
                yield pa.RecordBatch.from_arrays([c.take(at) for c in columns.values()], schema=schema)

    return docs.mapInArrow(judge, docs.schema)


def _joined_clean(docs: DataFrame, judgement: DataFrame) -> DataFrame:
    found = judgement.where("not kept or removed is not null").select("key", "kept", "removed").distinct()

    def cut(text: str, removed: list[int]) -> str:
        return without(text.encode(), np.sort(np.array(removed, np.int64)))[0].decode()

    return rewrite_text(docs, row_key("doc_id", "source", "text"), found, "removed", cut, ~F.col("kept"))


OP1_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d
), wins AS (
  SELECT r, i, array_to_string(list_slice(ws, i, i + 7), chr(1)) AS win
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) > 7)
), twice AS (
  SELECT r, unnest(range(i, i + 8)) AS p FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM wins) WHERE c > 1
), rep AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM twice GROUP BY r
), raw AS (
  SELECT r, host, text, unnest(string_split(text, chr(10))) AS line FROM d
), lines AS (
  SELECT r, host, text, line, regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS lw FROM raw WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), norm AS (
  SELECT r, host, text, array_to_string(lw, ' ') AS nl, len(lw) AS n FROM lines
), dup AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY r
), freq AS (
  SELECT host, nl FROM (SELECT host, nl, n, count(DISTINCT text) AS c FROM norm GROUP BY ALL)
  JOIN (SELECT host, count(DISTINCT text) AS h FROM d GROUP BY host) USING (host) WHERE c > 20 AND (c > 0.05 * h OR (c > 200 AND n >= 5))
), gone AS (SELECT r, sum(n) AS n_removed_words FROM norm SEMI JOIN freq USING (host, nl) GROUP BY r
), f AS (
  SELECT d.doc_id, len(ws)::BIGINT AS n_words,
    length(regexp_replace(d.text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(n_removed_words, 0)::BIGINT AS n_removed_words
  FROM d JOIN w USING (r) LEFT JOIN rep USING (r) LEFT JOIN dup USING (r) LEFT JOIN gone USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_words - n_removed_words >= 0.3 * n_words AS kept, n_removed_words
FROM f
"""
