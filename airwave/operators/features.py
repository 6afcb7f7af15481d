"""Feature blocks in long form (id, idx, value) with a vocabulary (idx, name), fitted once and applied to unseen items."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airwave.functions import scalars
from airwave.operators import aggregates
from airwave.operators.relational import channel_cap, dense_ids
from airwave.sources import artifacts


@dataclass
class Vocabulary:
    """Names of a block's positions, fitted on known items."""

    names: DataFrame  # idx, name

    @classmethod
    def of(cls, pairs: DataFrame) -> Vocabulary:
        return cls(dense_ids(pairs, "name", "idx"))

    def multi_hot(self, pairs: DataFrame) -> DataFrame:
        """(id, idx, value 1) of the (item, name) pairs whose name is known."""
        return pairs.join(self.names, "name").select(F.col("item").alias("id"), "idx").distinct().withColumn("value", F.lit(1.0))

    def counts(self, pairs: DataFrame) -> DataFrame:
        """(id, idx, value): how often an item has a name."""
        return pairs.join(self.names, "name").groupBy(F.col("item").alias("id"), "idx").agg(F.sum("n").cast("double").alias("value"))


def genre_pairs(genres: DataFrame) -> DataFrame:
    return genres.select("item", F.col("genre").alias("name"))


def channel_pairs(channels: DataFrame, most: int = 20) -> DataFrame:
    return channels.join(channel_cap(channels, most).select("item"), "item", "left_semi").select("item", F.col("channel").alias("name"))


def show_time(schedule: DataFrame, windows: int = 12) -> DataFrame:
    """(id, idx, value 1): windows of the day in which a program starts, counted from 0."""
    bucket = scalars.time_bucket(scalars.hhmm(F.col("start")), windows)
    return schedule.select(F.col("program").alias("id"), bucket.alias("idx")).distinct().withColumn("value", F.lit(1.0))


def top_terms(counts: DataFrame, n: int = 500, occurrences: bool = False) -> DataFrame:
    """(idx, name, score): the n terms with the largest tf * ln(items / df)."""
    items = counts.agg(F.countDistinct("item").alias("items"))
    score = F.round(F.col("tf") * F.log(F.col("items") / F.col("df")), 6)
    best = aggregates.term_figures(counts, occurrences).crossJoin(F.broadcast(items)).select("term", score.alias("score"))
    best = best.orderBy(F.desc("score"), "term").limit(n)  # bounded by n from here on
    return best.select((F.row_number().over(Window.orderBy(F.desc("score"), "term")) - 1).alias("idx"), F.col("term").alias("name"), "score")


def geo_cells(geo: DataFrame, user_map: DataFrame | None = None, **grid) -> DataFrame:
    rows = geo if user_map is None else geo.join(user_map, "user").withColumn("user", F.col("user_id"))
    return rows.select(F.col("user").alias("id"), scalars.geo_cell(F.col("lat"), F.col("lon"), **grid).alias("idx")).distinct().withColumn("value", F.lit(1.0))


def l2_normalised(block: DataFrame) -> DataFrame:
    norm = block.groupBy("id").agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("norm"))
    return _scaled(block, norm)


def max_normalised(block: DataFrame, size: int) -> DataFrame:
    """Divided by the largest value; positions that are not listed are zero."""
    norm = block.groupBy("id").agg(F.when(F.count("*") < size, F.greatest(F.max("value"), F.lit(0.0))).otherwise(F.max("value")).alias("norm"))
    return _scaled(block, norm)


def _scaled(block: DataFrame, norm: DataFrame) -> DataFrame:
    value = F.when(F.abs("norm") > 1e-13, F.col("value") / F.col("norm")).otherwise(F.col("value"))
    return block.join(norm, "id").select("id", "idx", value.alias("value"))


def select_positions(block: DataFrame, vocabulary: DataFrame, drop: list[int]) -> tuple[DataFrame, DataFrame]:
    """Block and vocabulary without some positions, the others numbered anew."""
    shift: Column = sum((F.when(F.col("idx") > d, 1).otherwise(0) for d in drop), F.lit(0))
    renumber = lambda df: df.where(~F.col("idx").isin(drop)).withColumn("idx", (F.col("idx") - shift).cast("int"))
    return renumber(block), renumber(vocabulary)


def chained(block: DataFrame, steps: list) -> DataFrame:
    """Post-processors in order; the same list serves unseen items."""
    return reduce(lambda b, f: f(b), steps, block)


@dataclass
class Extractor:
    """What a chain learned from known items, as tables that are saved and applied to unseen ones.

    Positions that are dropped leave the vocabulary, too; the norm is an item's own, so nothing of it is stored; coefficients (idx, k, w)
    of regressions, over the positions that stay, are optional and append an item's latent factors behind its content.
    """

    names: DataFrame  # idx, name, kept: a name's position after the chain, null if it is dropped
    coefficients: DataFrame | None = None  # idx, k, w
    normalise: bool = False

    @classmethod
    def fitted(cls, pairs: DataFrame, drop: tuple[int, ...] = (), normalise: bool = False, coefficients: DataFrame | None = None) -> Extractor:
        names = Vocabulary.of(pairs).names
        shift = sum((F.when(F.col("idx") > d, 1).otherwise(0) for d in drop), F.lit(0))
        kept = (F.col("idx") - shift).cast("int")
        return cls(names.withColumn("kept", F.when(~F.col("idx").isin(*drop), kept) if drop else kept), coefficients, normalise)

    @property
    def vocabulary(self) -> DataFrame:
        """(idx, name) of the positions that stay."""
        return self.names.where("kept IS NOT NULL").select(F.col("kept").alias("idx"), "name")

    def transform(self, pairs: DataFrame) -> DataFrame:
        """(id, idx, value) of items, known or not; names that no known item has give nothing."""
        content = Vocabulary(self.vocabulary).multi_hot(pairs)
        content = l2_normalised(content) if self.normalise else content
        if self.coefficients is None:
            return content
        behind = self.names.agg((F.count("kept")).alias("size"))  # one row
        factors = regressed(content, self.coefficients).crossJoin(F.broadcast(behind))
        return content.unionByName(factors.select("id", (F.col("idx") + F.col("size")).cast("int").alias("idx"), "value"))

    def save(self, name: str) -> Extractor:
        """Written unless it is there whole already, and as loaded from there."""
        artifacts.save(self.names, f"{name}-names")
        if self.coefficients is not None:
            artifacts.save(self.coefficients, f"{name}-coefficients")
        spark = self.names.sparkSession
        # last, so that an extractor with this table has all others
        artifacts.save(spark.range(1).select(F.lit(self.normalise).alias("normalise"), F.lit(self.coefficients is not None).alias("regresses")), f"{name}-extractor")
        return Extractor.load(spark, name)

    @classmethod
    def load(cls, spark: SparkSession, name: str) -> Extractor:
        table = lambda part: spark.read.parquet(f"{artifacts.shared_folder(spark)}/airwave/{name}-{part}")
        kind = table("extractor").first()  # one row
        return cls(table("names"), table("coefficients") if kind.regresses else None, kind.normalise)


def joined_blocks(blocks: list[tuple[DataFrame, int]], ids: DataFrame | None = None) -> DataFrame:
    """Blocks side by side: (id, idx, value) of the ids that all blocks have, positions shifted by the sizes before."""
    common = reduce(DataFrame.intersect, (b.select("id").distinct() for b, _ in blocks))
    if ids is not None:
        common = common.join(ids, "id", "left_semi")
    at, parts = 0, []
    for b, size in blocks:
        parts.append(b.withColumn("idx", (F.col("idx") + at).cast("int")))
        at += size
    return reduce(DataFrame.unionByName, parts).join(common, "id", "left_semi")


def regressed(content: DataFrame, coefficients: DataFrame) -> DataFrame:
    """(id, idx k, value): latent factors of items from their content, by (idx, k, w) of one regression for each dimension."""
    rows = content.join(coefficients, "idx")
    return rows.groupBy("id", F.col("k").alias("idx")).agg(F.sum(F.col("value") * F.col("w")).alias("value"))


def cold_items(blocks: list[tuple[DataFrame, int]], content: DataFrame, coefficients: DataFrame) -> DataFrame:
    """Features of items without ratings: content blocks of fitted vocabularies, then the factors regressed from content."""
    return joined_blocks([*blocks, (regressed(content, coefficients), 0)])


def vectors(block: DataFrame, size: int) -> DataFrame:
    """(id, features): the long form as pyspark.ml vectors."""
    from pyspark.ml.functions import array_to_vector

    entries = F.map_from_entries(F.array_distinct(F.collect_list(F.struct("idx", "value"))))
    dense = block.groupBy("id").agg(entries.alias("m"))
    value = lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0))
    return dense.select("id", array_to_vector(F.transform(F.sequence(F.lit(0), F.lit(size - 1)), value)).alias("features"))
