"""The corpus pipeline: five stages over documents, each on all that the one before kept.

Quality rules drop rejected documents and frequent lines; near-dedup keeps one document of each group
of texts that the SimHash index or hashes of minima propose and whose five-word shingles have a similarity of 0.8 or more;
decontamination drops documents that contain a benchmark item; the secret scan masks what it finds; mixing gives the
training stream, a row for each copy of a document in order of its position.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from airwave.llm import curriculum_mix, decontaminate, near_duplicates as near, quality_rules, secret_scan
from airwave.llm.common import read_table, remove, scratch_dir, temporary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.masked(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return curriculum_mix.mixed(docs)


#: Texts of an Arrow batch at most, which the JVM and a worker each hold.
BATCH = 2000


def in_small_batches(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage with batches of BATCH texts; the session keeps that, as results are lazy."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        now = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
        if now <= 0 or now > BATCH:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("quality", in_small_batches(quality)),
    ("near_duplicates", in_small_batches(near_duplicates)),
    ("decontamination", in_small_batches(decontamination)),
    ("secrets", in_small_batches(secrets)),
    ("mixing", in_small_batches(mixing)),
]

#: SQL has no XXH64 fingerprints, seeds or randomness tests; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents; each result is written and read again as the next one's input.

    What a stage has cut goes when its result is written, and a result goes when the next one is; only the last one stays.
    """
    docs, last = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = f"{scratch_dir(spark)}/airwave/pipeline-{name}-{uuid.uuid4().hex}"
        with temporary(spark):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        if last:
            remove(spark, last)
        docs, last = spark.read.schema(made.schema).parquet(path), path
    return docs
