"""Filters, joins, set operations, id maps and rankings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airwave.sources.artifacts import cut


def min_support(ratings: DataFrame, user_above: int, item_above: int) -> DataFrame:
    """Ratings of users and items with more ratings than this; both are counted on all ratings."""
    often = lambda c, n: ratings.groupBy(c).count().where(F.col("count") > n).select(c)
    return ratings.join(often("user", user_above), "user", "left_semi").join(often("item", item_above), "item", "left_semi")


def channel_cap(channels: DataFrame, most: int = 20) -> DataFrame:
    """Items with at most so many channels."""
    return channels.groupBy("item").agg(F.countDistinct("channel").alias("n_channels")).where(F.col("n_channels") <= most)


def known_only(rows: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    return rows.join(users.select("user"), "user", "left_semi").join(items.select("item"), "item", "left_semi")


def dense_ids(df: DataFrame, column: str, name: str, kind: str = "int") -> DataFrame:
    """(column, name): ids 0..n-1 in the order of the distinct values, without a sort in one partition.

    kind: int, as the factor models take; beyond 2 ** 31 values ask for long.

    Values are range-sorted and written; a partition's rows are numbered by themselves, and offsets come from
    the partitions' counts, a table as small as their number.
    """
    ordered = df.select(column).where(F.col(column).isNotNull()).distinct().repartitionByRange(column).sortWithinPartitions(column)
    ordered = cut(ordered.select(column, F.monotonically_increasing_id().alias("at")), "ordered-ids").withColumn("part", F.shiftright("at", 33))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ordered.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    offsets = offsets.select("part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return ordered.join(F.broadcast(offsets), "part").select(column, (F.col("at") - F.col("first") + F.col("offset")).cast(kind).alias(name))


def to_int_ids(rows: DataFrame, user_map: DataFrame, item_map: DataFrame) -> DataFrame:
    """Rows with int ids for users and items that both maps know."""
    return rows.join(user_map, "user").join(item_map, "item")


def with_default(rows: DataFrame, other: DataFrame, on: str, column: str, default: Column) -> DataFrame:
    return rows.join(other, on, "left").withColumn(column, F.coalesce(column, default))


def in_all(blocks: list[DataFrame]) -> DataFrame:
    """Ids that every block has."""
    return reduce(DataFrame.intersect, (b.select("id").distinct() for b in blocks))


def coverage(rows: DataFrame, total: int, least: float) -> DataFrame:
    """(block): blocks of (block, id) rows whose ids cover more than this share of total."""
    return rows.groupBy("block").agg(F.countDistinct("id").alias("n")).where(F.col("n") > least * total).select("block")


def covering(blocks: dict[str, DataFrame], total: int, least: float) -> list[str]:
    """Names of the blocks that cover enough, in the order given."""
    rows = reduce(DataFrame.unionByName, (b.select(F.lit(n).alias("block"), "id") for n, b in blocks.items()))
    kept = {r.block for r in coverage(rows, total, least).collect()}  # one row for each block
    return [n for n in blocks if n in kept]


def top_n(rows: DataFrame, by: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    return rows.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(rank) <= n)


def mark_seen(rows: DataFrame, seen: DataFrame) -> DataFrame:
    """rows of users that have a seen set, and whether each (user, item) is in it."""
    pairs = seen.select("user", "item").distinct().withColumn("seen", F.lit(True))
    own = rows.join(seen.select("user").distinct(), "user", "left_semi")
    return own.join(pairs, ["user", "item"], "left").withColumn("seen", F.coalesce("seen", F.lit(False)))


def top_all_and_new(marked: DataFrame, n: int, extra: int = 0) -> DataFrame:
    """Per user the best n items of all, and of those not seen, from rows that know what is seen.

    One pass: the best n of the seen and of the unseen hold both lists, so what is ranked in the end is 2 n rows a user.
    """
    order = [F.desc("score"), F.col("item")]
    few = top_n(marked, ["user", "seen"], order, n + extra, "own")
    best = few.withColumn("all", F.row_number().over(Window.partitionBy("user").orderBy(*order)))
    lists = F.array(F.struct(F.lit("all").alias("kind"), F.col("all").alias("rank")), F.struct(F.lit("new").alias("kind"), F.when(~F.col("seen"), F.col("own")).alias("rank")))
    rows = best.select("user", "item", "score", F.explode(lists).alias("l")).select("user", "item", "score", "l.kind", "l.rank")
    return rows.where(F.col("rank") <= n + extra)


def hourly_offers(schedule: DataFrame) -> DataFrame:
    """(slot, date, hour, item, start, channel): programs that start in an hour, each once, at its first start; slot is date and hour."""
    rows = schedule.select(F.col("program").alias("item"), "start", "channel", F.substring("start", 1, 8).alias("date"), F.substring("start", 9, 2).alias("hour"))
    first = rows.groupBy("item", "date", "hour").agg(F.min(F.struct("start", "channel")).alias("f"))
    return first.select(F.concat("date", "hour").alias("slot"), "date", "hour", "item", F.col("f.start").alias("start"), F.col("f.channel").alias("channel"))
