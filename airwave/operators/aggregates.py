"""Normalisers, temporal aggregates and statistics."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airwave.functions import scalars
from airwave.sources.artifacts import cut


def sum_pairs(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("user", "item").agg(F.sum("rating").alias("rating"))


def normalised(ratings: DataFrame, how: str) -> DataFrame:
    """how: 'max' by the item's largest rating, 'total' by the user's sum, anything else as it is.

    The figure of a user or item is partially aggregated and joined, so a popular item is no task of its own.
    """
    if how == "max":
        figure, on = ratings.groupBy("item").agg(F.max("rating").alias("figure")), "item"
    elif how == "total":
        figure, on = ratings.groupBy("user").agg(F.sum("rating").alias("figure")), "user"
    else:
        return ratings
    return ratings.join(figure, on).withColumn("rating", F.try_divide("rating", "figure")).drop("figure")


def corpus_stats(ratings: DataFrame) -> DataFrame:
    return ratings.agg(F.countDistinct("user").alias("users"), F.countDistinct("item").alias("items"), F.count("*").alias("n"))


def active_users(watch: DataFrame, least_weeks: int = 2) -> DataFrame:
    """Users seen in so many weeks of every month present."""
    months = watch.select(F.month("date").alias("month")).distinct()
    seen = watch.groupBy("user", F.month("date").alias("month")).agg(F.countDistinct(scalars.week_of_month(F.col("date"))).alias("weeks"))
    good = seen.where(F.col("weeks") >= least_weeks).groupBy("user").agg(F.count("*").alias("n"))
    return good.join(F.broadcast(months.agg(F.count("*").alias("n"))), "n").select("user")


def regular_users(watch: DataFrame) -> DataFrame:
    """Users present on every date."""
    dates = watch.agg(F.countDistinct("date").alias("n"))
    return watch.groupBy("user").agg(F.countDistinct("date").alias("n")).join(F.broadcast(dates), "n").select("user")


def by_genre(watch: DataFrame, genres: DataFrame, grain: list, min_watch: float = 0, users: DataFrame | None = None) -> DataFrame:
    """Sum of seconds by user, genre and grain; short watches and users outside the list are left out before the join."""
    rows = watch.where(F.col("seconds") >= min_watch)
    if users is not None:
        rows = rows.join(users, "user", "left_semi")
    return rows.join(genres.select("item", "genre"), "item").groupBy("user", "genre", *grain).agg(F.sum("seconds").alias("seconds"))


def weekly_from_daily(daily: DataFrame) -> DataFrame:
    grain = [scalars.week_of_month(F.col("date")).alias("week"), F.month("date").alias("month")]
    return daily.groupBy("user", "genre", *grain).agg(F.sum("seconds").alias("seconds"))


def packed(rows: DataFrame, by: list[str]) -> DataFrame:
    """genre,seconds,genre,seconds... for each key, in order of genre."""
    pairs = F.array_sort(F.collect_list(F.struct("genre", F.col("seconds").cast("string").alias("s"))))
    return rows.groupBy(*by).agg(F.array_join(F.transform(pairs, lambda p: F.concat_ws(",", p["genre"], p["s"])), ",").alias("packed"))


def item_texts(texts: DataFrame) -> DataFrame:
    """(item, text): an item's texts of all dates with a blank between, in order of the dates."""
    parts = F.array_sort(F.collect_list(F.when(F.col("text").isNotNull(), F.struct("date", "text"))))
    return texts.groupBy("item").agg(parts.alias("p")).where(F.size("p") > 0).select("item", F.array_join(F.transform("p", lambda x: x["text"]), " ").alias("text"))


def term_counts(texts: DataFrame, **options) -> DataFrame:
    """(item, term, n): how often an item's text has a term."""
    return texts.select("item", F.explode(scalars.tokens(F.col("text"), **options)).alias("term")).groupBy("item", "term").agg(F.count("*").alias("n"))


def term_figures(counts: DataFrame, occurrences: bool = False) -> DataFrame:
    """(term, tf, df): uses in all, and items that have it (or, on request, uses again)."""
    return counts.groupBy("term").agg(F.sum("n").alias("tf"), (F.sum("n") if occurrences else F.count("*")).alias("df"))


#: Features of a user's items that a task of weighted_mean should take at most.
ENTRIES_A_TASK = 1 << 22


def weighted_mean(watch: DataFrame, block: DataFrame) -> DataFrame:
    """(user, idx, value): the mean of the items' features, weighted by watch time, over items that have features.

    An item's features travel as one row of two arrays, once for each watch, to its user; they are taken apart and added up there. So no row
    is shuffled for each feature of each watch, and tasks are as many as the features need.
    """
    packed = block.groupBy(F.col("id").alias("item")).agg(F.collect_list(F.struct("idx", "value")).alias("f"))
    packed = cut(packed.select("item", F.col("f.idx").alias("places"), F.col("f.value").alias("x")), "packed-features")
    each = packed.agg(F.avg(F.size("x"))).first()[0] or 0
    tasks = max(int(watch.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(watch.count() * each / ENTRIES_A_TASK))
    own = watch.select("user", "item", "rating").join(packed, "item").select("user", "rating", "places", "x").repartition(tasks, "user")
    total = own.groupBy("user").agg(F.sum("rating").alias("total"))
    rows = own.select("user", "rating", F.explode(F.arrays_zip("places", "x")).alias("f"))
    sums = rows.groupBy("user", F.col("f.places").alias("idx")).agg(F.sum(F.col("rating") * F.col("f.x")).alias("v"))
    return sums.join(total, "user").select("user", "idx", (F.col("v") / F.col("total")).alias("value"))


def mean_vector(profiles: DataFrame) -> DataFrame:
    """(idx, value): the mean of array profiles."""
    return profiles.select(F.posexplode("profile").alias("idx", "v")).groupBy("idx").agg(F.avg("v").alias("value"))
