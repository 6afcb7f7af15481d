"""Ready pipelines: plain functions from input tables to results."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airwave.functions import scalars
from airwave.operators import aggregates, exports, features, relational, scoring, training
from airwave.sources.artifacts import cut

WORK_DAYS = "work"


def temporal_aggregation(watch: DataFrame, genres: DataFrame, grain: str = "weekly", days: str = WORK_DAYS, min_watch: float = 300, least_weeks: int = 2) -> DataFrame:
    """Seconds by user, genre and grain ('daily', 'weekly' or 'hourly').

    Weekly takes work days (Monday to Thursday) and active users; hourly all days and users present on every date;
    daily everything.
    """
    if grain == "daily":
        return aggregates.by_genre(watch, genres, ["date"])
    if grain == "hourly":
        return aggregates.by_genre(watch, genres, ["hour"], min_watch, aggregates.regular_users(watch))
    rows = watch.where(~scalars.is_weekend(F.col("date"))) if days == WORK_DAYS else watch
    weeks = [scalars.week_of_month(F.col("date")).alias("week"), F.month("date").alias("month")]
    return aggregates.by_genre(rows, genres, weeks, min_watch, aggregates.active_users(rows, least_weeks))


def corpus(ratings: DataFrame, transform: str = "none") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Ratings, transformed, with int ids; and the maps of users and of items."""
    rows = cut(aggregates.normalised(ratings, transform), "ratings")
    users, items = relational.dense_ids(rows, "user", "uid"), relational.dense_ids(rows, "item", "iid")
    return relational.to_int_ids(rows, users, items), users, items


Blocks = dict[str, tuple[DataFrame, int]]


def sides(ratings: DataFrame, user_blocks: Blocks, item_blocks: Blocks, least: float) -> tuple[DataFrame, DataFrame, int]:
    """Features of users and of items (id, idx, value) and their number in all; the users' positions come first.

    Blocks (id, idx, value) with their sizes: those that cover too small a share of the rated ids go; ids that all others have stay.
    """
    out, at = [], 0
    for on, blocks in (("user", user_blocks), ("item", item_blocks)):
        ids = ratings.select(F.col(on).alias("id")).distinct()
        names = relational.covering({n: b.join(ids, "id", "left_semi") for n, (b, _) in blocks.items()}, ids.count(), least)
        if not names:
            raise ValueError(f"no {on} block covers more than {least:.0%} of the ids")
        side = features.joined_blocks([blocks[n] for n in names]).withColumn("idx", (F.col("idx") + at).cast("int"))
        out.append(cut(side, f"{on}-side"))
        at += sum(blocks[n][1] for n in names)
    return *out, at


def design_rows(ratings: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """(user, item, idx, value, label) of the ratings whose user and item both have features."""
    users, items = users.withColumnRenamed("id", "user"), items.withColumnRenamed("id", "item")
    rows = aggregates.sum_pairs(ratings).join(users.select("user").distinct(), "user", "left_semi").join(items.select("item").distinct(), "item", "left_semi")
    rows = cut(rows.withColumnRenamed("rating", "label"), "design-pairs")
    return rows.join(users, "user").unionByName(rows.join(items, "item")).select("user", "item", "idx", "value", "label")


def sparse_design(ratings: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """(user, item, places, x, label in minutes) of the ratings whose user and item both have features: what the trainers take.

    A side's features are one list for each id before they meet the ratings, so no row is made for each rating and feature.
    """
    listed = lambda side, on: side.groupBy(F.col("id").alias(on)).agg(F.collect_list(F.struct("idx", "value")).alias(f"{on}_f"))
    rows = aggregates.sum_pairs(ratings).join(listed(users, "user"), "user").join(listed(items, "item"), "item")
    rows = rows.select("user", "item", F.array_sort(F.concat("user_f", "item_f")).alias("f"), "rating")
    return rows.select("user", "item", F.col("f.idx").alias("places"), F.col("f.value").alias("x"), (F.col("rating") / 60).alias("label"))


def assembled(ratings: DataFrame, user_blocks: Blocks, item_blocks: Blocks, least: float) -> tuple[DataFrame, int]:
    """The design in long form, and its dimension: coverage, common ids, features side by side, ratings of these ids."""
    users, items, size = sides(ratings, user_blocks, item_blocks, least)
    return design_rows(ratings, users, items), size


def factor_model(ratings: DataFrame, rank: int, rounds: int) -> tuple[DataFrame, DataFrame]:
    """(user, uf) and (item, vf) of trained factors, by the tables' own ids."""
    user_map, item_map = relational.dense_ids(ratings, "user", "uid"), relational.dense_ids(ratings, "item", "iid")
    ints = relational.to_int_ids(ratings, user_map, item_map).select(F.col("uid").alias("user"), F.col("iid").alias("item"), "rating")
    users, items = training.als(ints, rank, rounds)
    as_double = lambda c: F.transform(c, lambda x: x.cast("double"))
    users = users.join(user_map, F.col("id") == F.col("uid")).select("user", as_double("features").alias("uf"))
    items = items.join(item_map, F.col("id") == F.col("iid")).select("item", as_double("features").alias("vf"))
    return cut(users, "user-factors"), cut(items, "item-factors")


Score = Callable[[dict, dict], np.ndarray]


def ranked(users: DataFrame, items: DataFrame, score: Score, train: DataFrame, test: DataFrame, n: int) -> DataFrame:
    """Hit sets of the best n of all and of unseen items, for users with a history, against the test's own lists."""
    predicted = scoring.best_items(scoring.with_seen(users, train), items, score, n)
    truth = relational.known_only(test.join(users, "user", "left_semi"), train, train).groupBy("user", "item").agg(F.sum("rating").alias("score"))
    return scoring.hit_sets(predicted, relational.top_all_and_new(relational.mark_seen(truth, train), n))


def cold_ranked(users: DataFrame, items: DataFrame, score: Score, test: DataFrame, n: int) -> DataFrame:
    """Hits of the best n cold items of users that the test knows."""
    top = scoring.best_items(users.join(test, "user", "left_semi"), items, score, n)
    found = top.join(test.select("user", "item").distinct().withColumn("hit", F.lit(1)), ["user", "item"], "left")
    return found.groupBy("user").agg(F.count("hit").alias("hits"), F.count("*").alias("n_predicted"))


def cold_of(train: DataFrame, test: DataFrame) -> DataFrame:
    return test.select("item").distinct().join(train, "item", "left_anti")


def figure(rows: DataFrame, test: str, column: str) -> DataFrame:
    return rows.select(F.lit(test).alias("test"), F.col(column).cast("double").alias("value"))


def matrix_factorisation(train: DataFrame, test: DataFrame, content: tuple[DataFrame, int], rank: int = 5, rounds: int = 5, n: int = 10, share: float = 0.2) -> DataFrame:
    """Metrics of a factor model: errors on known pairs, and with mean or regressed profiles for cold items; ranking of known and of cold items.

    content: features (id, idx, value) of all items, and their number; profiles of cold items are regressed from them.
    """
    users, items = factor_model(train.withColumn("rating", F.col("rating") / 60), rank, rounds)
    test_rows = test.withColumn("label", F.col("rating") / 60)
    error = lambda profiles: scoring.squared_error(scoring.pair_scores(test_rows, users, profiles).select("label", F.col("score").alias("prediction")))
    with_mean = scoring.completed(test, items, "item", "vf", scoring.mean_profile(items, "vf", rank))
    block, size = content
    profiles = items.select(F.col("item").alias("id"), F.col("vf").alias("profile"))
    fitted = training.cold_profiles(block, profiles, rank, size)
    coefficients = train.sparkSession.createDataFrame([(i, k, float(w)) for (i, k), w in np.ndenumerate(fitted)], "idx int, k int, w double")
    cold = features.regressed(block.join(cold_of(train, test).withColumnRenamed("item", "id"), "id", "left_semi"), coefficients)
    cold = cut(cold.groupBy(F.col("id").alias("item")).agg(F.array_sort(F.collect_list(F.struct("idx", "value")))["value"].alias("vf")), "cold-profiles")
    score = scoring.dot_scores()
    sampled = cut(exports.sample_users(users, share), "sampled-users")
    rates = cut(scoring.hit_rates(ranked(sampled, items, score, train, test, n), n), "rates")
    parts = [
        figure(error(items), "warm: rmse", "rmse"),
        figure(error(with_mean), "mean profiles: rmse", "rmse"),
        figure(error(items.unionByName(cold)), "regressed profiles: rmse", "rmse"),
        figure(rates, "known items: precision", "precision"),
        figure(rates, "known items: recall", "recall"),
        figure(scoring.cold_recall(cold_ranked(sampled, cold, score, test, n)), "cold items: recall", "cold_recall"),
    ]
    return reduce(DataFrame.unionByName, parts)


def recommend(
    train: DataFrame, test: DataFrame, genres: DataFrame, channels: DataFrame, schedule: DataFrame, dates: list[str],
    factors: int = 3, rounds: int = 5, n: int = 10, k: int = 5, least: float = 0.3,
) -> DataFrame:
    """The job from ratings to programs of an hour, with a factorisation machine on features; its summary.

    Features: genres, channels and show times of items, users' means of genres. Tests: error on known pairs, ranking of known and of
    cold items. Tests and programs are those of all users with features. The programs of the dates are written by hour.
    """
    spark = train.sparkSession
    train, test = cut(train, "train"), cut(test.select("user", "item", "rating"), "test")
    item_blocks: Blocks = {}
    for name, pairs in (("genre", features.genre_pairs(genres)), ("channel", features.channel_pairs(cut(channels, "channels")))):
        pairs = cut(pairs, "pairs")
        vocabulary = features.Vocabulary.of(pairs)
        item_blocks[name] = cut(vocabulary.multi_hot(pairs), f"{name}-block"), vocabulary.names.count()
    item_blocks["show"] = cut(features.show_time(schedule), "show-block"), 13
    means = aggregates.weighted_mean(train, item_blocks["genre"][0]).withColumnRenamed("user", "id")
    user_blocks = {"genre": (cut(means, "genre-means"), item_blocks["genre"][1])}
    users, items, size = sides(train, user_blocks, item_blocks, least)
    design = cut(sparse_design(train, users, items).withColumn("split", exports.split_of(F.col("user"))), "design")
    part = lambda s: design.where(F.col("split") == s)
    steps = (1e-2, 1e-3)
    fits = [training.fm_l2(size, factors, step=s, rounds=rounds) for s in steps]
    model, at, errors = training.grid_search(part("tr"), {"validation": part("va"), "test": part("te")}, fits)
    model = training.Weights.of(cut(model.table(spark), "model"))

    wide = spark.createDataFrame(
        [(i, *map(float, row)) for i, row in enumerate(model.matrix)], ", ".join(["idx int", "w double", *(f"v{j} double" for j in range(factors))])
    )
    shares = lambda side, on, x: cut(scoring.partial_model(side, wide, factors).select(F.col("id").alias(on), F.col("linear").alias(f"l{x}"), F.col("latent").alias(f"v{x}")), f"{on}-shares")
    user_shares, item_shares = shares(users, "user", "u"), shares(items, "item", "i")
    known = cut(item_shares.join(train, "item", "left_semi"), "known-items")
    cold = cut(item_shares.join(cold_of(train, test), "item", "left_semi"), "cold-items")
    pair = scoring.factorisation_scores(model.bias)
    rates = scoring.hit_rates(ranked(user_shares, known, pair, train, test, n), n)
    recall = scoring.cold_recall(cold_ranked(user_shares, cold, pair, test, n))
    pairs = aggregates.sum_pairs(test).join(user_shares, "user").join(item_shares, "item")
    predicted = scoring.combined(F.col("lu"), F.col("li"), F.col("vu"), F.col("vi"), model.bias)
    holdout = scoring.squared_error(pairs.select((F.col("rating") / 60).alias("label"), predicted.alias("prediction"))).first().mse
    programs, _ = hourly_programs(user_shares, item_shares, schedule, dates, k, pair)
    row = lambda **figures: spark.createDataFrame([tuple(map(str, figures.values()))], ", ".join(f"`{c}` string" for c in figures))
    metrics = rates.select(*(exports.metric(c).alias(f"known items: {c}") for c in ("precision", "recall"))).crossJoin(recall.select(exports.metric("cold_recall").alias("cold items: recall")))
    return exports.summary(
        {
            "dates": exports.date_figures(train),
            "corpus": aggregates.corpus_stats(train),
            "features": row(**{name: n_ for name, (_, n_) in item_blocks.items()}),
            "assembled": row(dimension=size, rows=design.count()),
            "models": row(step=steps[at], validation_mse=f"{errors.validation[at]:.4g}", test_mse=f"{errors.test[at]:.4g}"),
            "tests": metrics.crossJoin(row(**{"known items: mse": f"{holdout:.4g}"})),
            "prediction": programs.agg(F.count("*").alias("programs"), F.countDistinct("user").alias("users")),
        }
    )


def programs_by_hour(users: DataFrame, items: DataFrame, schedule: DataFrame, dates: list[str], k: int, score: Score) -> DataFrame:
    """(user, date, hour, rank, program, start, channel, score): the best k programs of each user for each hour of the dates."""
    offers = cut(relational.hourly_offers(schedule.where(F.substring("start", 1, 8).isin(dates))), "offers")
    best = scoring.best_in_slots(users, items, offers.select("slot", "item"), score, k)
    return best.join(offers, ["slot", "item"]).select("user", "date", "hour", "rank", F.col("item").alias("program"), "start", "channel", "score")


def hourly_programs(users: DataFrame, items: DataFrame, schedule: DataFrame, dates: list[str], k: int, score: Score) -> tuple[DataFrame, DataFrame]:
    """programs_by_hour, and the lines that were written with a folder for each hour."""
    best = cut(programs_by_hour(users, items, schedule, dates, k, score), "hourly-programs")
    return best, exports.written_by_hour(best)


def predict(ratings: DataFrame, schedule: DataFrame, dates: list[str], k: int = 5, rank: int = 5, rounds: int = 5) -> tuple[DataFrame, DataFrame]:
    """hourly_programs from factors of the ratings; programs without ratings get the mean profile."""
    users, items = factor_model(ratings, rank, rounds)
    scheduled = schedule.where(F.substring("start", 1, 8).isin(dates)).select(F.col("program").alias("item")).distinct()
    profiles = scoring.completed(scheduled, items, "item", "vf", scoring.mean_profile(items, "vf", rank))
    return hourly_programs(users, profiles, schedule, dates, k, scoring.dot_scores())
