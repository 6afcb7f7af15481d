"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is logistic in the features it holds (words and parts of words);
a document's is their noisy-or with a leak: 1 - (1 - leak) * product of (1 - sentence score). Both are trained from
document labels alone, and the sentence scores then locate the offending sentences.

Features are chosen by the likelihood ratio of their document counts in the training sample. The sample has at most
max_train_docs labelled documents (those with the smallest hashes of their ids) of MAX_TRAIN_CHARS characters at most, one
for each id, which bounds the ids that are broadcast and the sentences that the driver fits on; everything is scored.

Defined cases: null or empty text has no sentence and gets the leak as its score; null labels and ids, and labels without a
document, don't train; of labels of one id the largest, of documents of one id one counts; without a training document of both
labels every score is the share of label 1 (0.5 if there is none); repeated rows give repeated results; only the named columns
are read, so further columns do no harm.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airwave.llm.common import KEY, id_remainder, map_batches, row_key, staged, utf8

#: The bounds on labelled documents that train, and on their length.
MAX_TRAIN_DOCS, MAX_TRAIN_CHARS = 20_000, 200_000
#: Features: at most so many, with this odds ratio, likelihood ratio (G squared) and number of documents at least.
MAX_FEATURES, LEAST_ODDS, LEAST_G2, LEAST_DOCS = 800, 6.0, 16.0, 4
#: Lengths of the parts of words.
PARTS = (4, 5, 6)
ROUNDS, RATE, RIDGE = 300, 0.15, 0.002
THRESHOLD, OFFENDING = 0.7, 0.5
#: Remainders of crc32 of the id by 3; rows with this one are held out.
MODULUS, HELD_OUT = 3, 1

_ENDS = re.compile(rb"[.!?\n]+")
_KEEP = bytes(c if c >= 0x80 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_CACHE = 400_000


def sentences(data: bytes) -> list[tuple[int, int]]:
    """(start, end) in bytes of the stretches between sentence ends that hold something."""
    out, at = [], 0
    for m in [*_ENDS.finditer(data), None]:
        end = m.start() if m else len(data)
        if data[at:end].strip():
            out.append((at, end))
        at = m.end() if m else end
    return out


def word_parts(word: bytes) -> set[bytes]:
    """A word, marked as whole, and its pieces."""
    marked = b"^" + word + b"$"
    return {marked} | {marked[i : i + n] for n in PARTS for i in range(len(marked) - n + 1)}


class Features:
    """Looks up the chosen features of words; holds the answers for the words seen last."""

    def __init__(self, names: list[bytes]) -> None:
        self.place = {n: i for i, n in enumerate(names)}
        self.known: dict[bytes, tuple[int, ...]] = {}

    def of(self, words: list[bytes]) -> set[int]:
        out: set[int] = set()
        for w in words:
            ids = self.known.get(w)
            if ids is None:
                if len(self.known) >= _CACHE:
                    self.known.clear()
                ids = self.known[w] = tuple(sorted(self.place[p] for p in word_parts(w) if p in self.place))
            if ids:
                out.update(ids)
        return out

    def bag(self, data: bytes) -> list[tuple[int, int, list[int]]]:
        """(start, end, features) of each sentence that has features."""
        if not self.of(list(set(data.lower().translate(_KEEP).split()))):
            return []
        low = data.lower()
        found = ((a, b, sorted(self.of(low[a:b].translate(_KEEP).split()))) for a, b in sentences(data))
        return [x for x in found if x[2]]


def training_rows(docs: DataFrame, labels: DataFrame, max_train_docs: int) -> DataFrame:
    """(doc_id, text, label) of the sample: a bounded number of rows of bounded length, one for each id."""
    marked = labels.where(F.col("toxic").isNotNull() & (id_remainder("doc_id", MODULUS) != HELD_OUT))
    marked = marked.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(F.length("text") <= MAX_TRAIN_CHARS)
    ids = marked.join(texts.select("doc_id"), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train_docs)
    rows = texts.join(F.broadcast(staged(ids, "training-ids")), "doc_id")
    return staged(rows.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text")), "training-rows")


def choose_features(sample: DataFrame, positives: int, negatives: int) -> list[bytes]:
    """Parts of words whose document counts speak for label 1, strongest first."""

    def parts(batches):
        for batch in batches:
            counts = (Counter(), Counter())
            for data, label in zip(utf8(batch), batch.column(1).to_pylist(), strict=True):
                found: set[bytes] = set()
                for w in set(data.lower().translate(_KEEP).split()):
                    found |= word_parts(w)
                counts[1 if label else 0].update(found)
            names = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), *(pa.array([c[n] for n in names], pa.int64()) for c in counts)], ["part", "neg", "pos"]
            )

    size = sample.sparkSession.conf.get("spark.sql.shuffle.partitions")
    rows = sample.repartition(int(size), "doc_id").select("text", "label")
    counts = rows.mapInArrow(parts, "part binary, neg long, pos long").groupBy("part").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    odds = lambda c, n: (F.col(c) + 0.5) / (F.lit(n) - F.col(c) + 0.5)
    seen = F.col("pos") + F.col("neg")
    gain = lambda x, total: F.when(x > 0, x * F.log(x * (positives + negatives) / total)).otherwise(0.0)
    g2 = sum(
        gain(F.col(c), seen * n) + gain(F.lit(n) - F.col(c), (F.lit(positives + negatives) - seen) * n) for c, n in (("pos", positives), ("neg", negatives))
    )
    counts = counts.where((F.col("pos") >= LEAST_DOCS) & (odds("pos", positives) >= LEAST_ODDS * odds("neg", negatives)))
    best = counts.select("part", (2 * g2).alias("g2")).where(F.col("g2") >= LEAST_G2)
    return [bytes(r.part) for r in best.orderBy(F.desc("g2"), "part").limit(MAX_FEATURES).collect()]


def fit(bags: pa.ListArray, labels: np.ndarray, size: int) -> tuple[np.ndarray, float, float]:
    """(weights, bias, leak) by gradient steps on the noisy-or likelihood; the classes weigh what they are.

    bags: of each document the features of each of its sentences.
    """
    inner = bags.flatten()
    n_sentences, n_features = (np.diff(x.offsets.to_numpy()) for x in (bags, inner))
    sentence_of = np.repeat(np.arange(len(bags)), n_sentences)
    rows = np.repeat(np.arange(len(inner)), n_features)
    cols = inner.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    empty = n_sentences == 0
    leak = float((labels[empty].sum() + 0.1) / (empty.sum() + 2)) if empty.any() else 0.01
    leak = min(leak, 0.3)
    params, mean, square = np.concatenate((np.full(size, 0.5), [-2.0])), np.zeros(size + 1), np.zeros(size + 1)
    n = max(1, len(bags))
    for step in range(1, ROUNDS + 1):
        z = np.bincount(rows, params[cols], len(sentence_of)) + params[-1]
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        none = np.exp(np.bincount(sentence_of, np.log1p(-np.minimum(p, 1 - 1e-9)), len(bags))) * (1 - leak)
        pull = np.where(labels == 1, -none / np.maximum(1 - none, 1e-9), 1.0)[sentence_of] * p
        grad = np.concatenate((np.bincount(cols, pull[rows], size), [pull.sum()])) / n
        grad[:-1] += RIDGE * params[:-1] / size
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        params = params - RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return params[:-1], float(params[-1]), leak


def noisy_or(scores: list[float], leak: float) -> float:
    return 1 - (1 - leak) * math.exp(sum(math.log1p(-min(p, 1 - 1e-12)) for p in scores))


class Model:
    def __init__(self, names: list[bytes], weights: np.ndarray, bias: float, leak: float) -> None:
        self.features, self.weights, self.bias, self.leak = Features(names), weights, bias, leak

    def score(self, data: bytes) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's score, and (start, end, score) in bytes of each sentence that has features."""
        out = []
        for a, b, ids in self.features.bag(data):
            z = float(self.weights[ids].sum()) + self.bias
            out.append((a, b, 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))))
        return noisy_or([p for _, _, p in out], self.leak), out


def train(docs: DataFrame, labels: DataFrame, max_train_docs: int = MAX_TRAIN_DOCS) -> Model:
    sample = training_rows(docs, labels, max_train_docs)
    counts = {r.label: r["count"] for r in sample.groupBy((F.col("label") > 0).cast("int").alias("label")).count().collect()}
    positives, negatives = counts.get(1, 0), counts.get(0, 0)
    if not positives or not negatives:
        return Model([], np.zeros(0), 0.0, 0.5 if not counts else positives / (positives + negatives))
    names = choose_features(sample, positives, negatives)

    features = Features(names)

    def bags(batch: pa.RecordBatch) -> dict[str, list]:
        return {"key": batch.column(1), "label": batch.column(2), "bag": [[x[2] for x in features.bag(d)] for d in utf8(batch)]}

    rows = map_batches(sample.select("text", F.xxhash64("doc_id").alias("key"), "label"), bags, "key long, label int, bag array<array<int>>")
    got = rows.toArrow().sort_by([("key", "ascending"), ("label", "ascending")]).combine_chunks()
    bag = got["bag"].combine_chunks() if got.num_rows else pa.array([], pa.list_(pa.list_(pa.int32())))
    weights, bias, leak = fit(bag, (got["label"].to_numpy() > 0).astype(int), len(names))
    return Model(names, weights, bias, leak)


def in_characters(data: bytes, spans: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
    """Spans in bytes, in order and apart, as spans in characters; one pass over the text."""
    out, seen, last = [], 0, 0
    for a, b, score in spans:
        start = seen + len(data[last:a].decode())
        seen, last = start + len(data[a:b].decode()), b
        out.append((start, seen, score))
    return out


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """Every row of docs with its score and its offending sentences, in characters."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batch: pa.RecordBatch) -> dict[str, list]:
        scores, spans = [], []
        for data in utf8(batch):
            total, found = shared.value.score(data)
            scores.append(total)
            spans.append([{"start": a, "end": b, "score": p} for a, b, p in in_characters(data, [x for x in found if x[2] >= OFFENDING])])
        return {"key": batch.column(0), "doc_id": batch.column(1), "score": scores, "offending": spans}

    rows = docs.select(row_key("doc_id", "text").alias("key"), "doc_id", "text")
    return map_batches(rows, score, f"key {KEY}, doc_id long, score double, offending array<struct<start:long,end:long,score:double>>")


def op2_toxicity_mil(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs, train(docs, labels)).select(
        "doc_id",
        F.coalesce(id_remainder("doc_id", MODULUS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        F.size("offending").cast("long").alias("n_offending"),
        F.array_join(F.transform("offending", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias("offending"),
    )
