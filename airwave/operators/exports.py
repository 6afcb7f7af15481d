"""Splits and text exports."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airwave.operators.relational import dense_ids
from airwave.sources.artifacts import cut, save, shared_folder


def split_of(user: Column, train: float = 0.7, test: float = 0.2) -> Column:
    """'tr', 'te' or 'va' by the user's last digit; a user is in one part only."""
    tenth = F.pmod(user, F.lit(10)) / 10
    return F.when(tenth < round(train, 10), "tr").when(tenth < round(train + test, 10), "te").otherwise("va")


def sample_users(users: DataFrame, size: float) -> DataFrame:
    """A share of the users, or so many if size is above 1. The same on every run: by a hash of the id, not by partition."""
    place = F.pmod(F.col("user") * 7919, F.lit(1000))
    return users.orderBy(place, "user").limit(int(size)) if size > 1 else users.where(place < int(size * 1000))


def written_by_hour(best: DataFrame) -> DataFrame:
    """(date, hour, user, programs in order of rank) as written with a folder for each hour, and read back."""
    listed = F.array_sort(F.collect_list(F.struct("rank", "program")))
    lines = best.groupBy("date", "hour", "user").agg(F.array_join(F.transform(listed, lambda r: r["program"].cast("string")), "\t").alias("programs"))
    saved = save(lines, f"hourly-{uuid.uuid4().hex}", by=("date", "hour"))
    return saved.select(F.col("date").cast("string").alias("date"), F.lpad(F.col("hour").cast("string"), 2, "0").alias("hour"), "user", "programs")


def append_metrics(rows: DataFrame, name: str, run: str) -> DataFrame:
    """The stored metrics (run, model, test, metric, value) after those of a run (model, test, metric, value) came to them.

    A run's figures of a model and a test are a folder of their own, so a run that is repeated replaces them and doubles nothing.
    """
    spark, keys = rows.sparkSession, ("run", "model", "test")
    path = f"{shared_folder(spark)}/airwave/{name}"
    rows.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
    schema = "metric string, value double, " + ", ".join(f"{k} string" for k in keys)
    return spark.read.schema(schema).parquet(path).select(*keys, "metric", "value")


def metric(column: str) -> Column:
    """A metric as text of four digits."""
    return F.format_string("%.4g", column)


def date_figures(rows: DataFrame) -> DataFrame:
    day = lambda c: F.date_format(c, "yyyyMMdd")
    return rows.agg(day(F.min("date")).alias("first"), day(F.max("date")).alias("last"), F.countDistinct("date").alias("days"))


def summary(sections: dict[str, DataFrame]) -> DataFrame:
    """(section, key, value): the columns of one-row tables as text, one below the other."""

    def listed(section: str, row: DataFrame) -> DataFrame:
        text = row.select(*(F.col(f"`{c}`").cast("string").alias(c) for c in row.columns))
        return text.unpivot([], [f"`{c}`" for c in row.columns], "key", "value").select(F.lit(section).alias("section"), "key", "value")

    return reduce(DataFrame.unionByName, (listed(s, row) for s, row in sections.items()))


def _listed(entries: Column, sep: str, one) -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(entries)), one), sep)


def number(c: Column) -> Column:
    """Whole numbers without decimals."""
    return F.when(c == F.floor(c), F.floor(c).cast("string")).otherwise(c.cast("string"))


def user_history(ratings: DataFrame) -> DataFrame:
    """user@(item,rating)%(item,rating)"""
    one = lambda e: F.concat(F.lit("("), e["item"].cast("string"), F.lit(","), number(e["rating"]), F.lit(")"))
    return ratings.groupBy("user").agg(F.concat(F.col("user").cast("string"), F.lit("@"), _listed(F.struct("item", "rating"), "%", one)).alias("line"))


def item_features(block: DataFrame) -> DataFrame:
    """item@(idx,value)%(idx,value), without zeros"""
    one = lambda e: F.concat(F.lit("("), e["idx"].cast("string"), F.lit(","), number(e["value"]), F.lit(")"))
    rows = block.where(F.col("value") != 0).groupBy("id")
    return rows.agg(F.concat(F.col("id").cast("string"), F.lit("@"), _listed(F.struct("idx", "value"), "%", one)).alias("line"))


def sparse_lines(block: DataFrame, size: int | None = None) -> DataFrame:
    """(id, line): idx,value,idx,value... after id and size if a size is given."""
    one = lambda e: F.concat_ws(",", e["idx"].cast("string"), number(e["value"]))
    line = _listed(F.struct("idx", "value"), ",", one)
    if size is not None:
        line = F.concat_ws(",", F.col("id").cast("string"), F.lit(str(size)), line)
    return block.where(F.col("value") != 0).groupBy("id").agg(line.alias("line"))


def rating_lines(ratings: DataFrame) -> DataFrame:
    """(user, line): item's place,rating,... where places count the sorted items from 1."""
    places = dense_ids(ratings, "item", "idx").withColumn("idx", F.col("idx") + 1)
    return sparse_lines(ratings.join(places, "item").select(F.col("user").alias("id"), "idx", F.col("rating").alias("value"))).withColumnRenamed("id", "user")


#: Rows of a part file of an ordered export.
PART_ROWS = 1 << 17


def write_ordered(lines: DataFrame, key: str, path: str, entries: Column | None = None, part_rows: int = PART_ROWS) -> None:
    """Lines as text in the order of a unique key: part files of part_rows rows each in path/lines, and beside them what locates a row.

    path/rows has (key, row, pointer): a row's place from 0, and how many entries the rows before it have (entries: a row's own, else 1).
    No line holds its key, so it is the place that says whose it is. Places come from a range sort; pointers from sums of the parts
    and, within one, of its rows. Lines are written last, so an export to a new path is whole once they have their mark (_SUCCESS).
    """
    own = entries if entries is not None else F.lit(1)
    placed = dense_ids(lines, key, "row", "long")
    rows = cut(lines.select(key, "line", own.cast("long").alias("n")).join(placed, key).withColumn("part", F.floor(F.col("row") / part_rows)), "placed-lines", by=("part",))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("part").agg(F.sum("n").alias("n"))  # a row for each part_rows lines
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    pointer = F.col("start") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    rows.join(parts, "part").select(key, "row", pointer.alias("pointer")).write.mode("overwrite").parquet(f"{path}/rows")
    dealt = rows.select("part", "row", "line").repartition("part").sortWithinPartitions("part", "row")
    # the order within a part has to be the writer's input order; the row is dropped after the sort
    dealt.select("part", "line").write.mode("overwrite").partitionBy("part").text(f"{path}/lines")


def read_ordered(spark: SparkSession, path: str, part_rows: int = PART_ROWS) -> DataFrame:
    """(row, line) of an ordered export, placed by where a line stands in its part file."""
    files = spark.read.option("recursiveFileLookup", True).text(f"{path}/lines")  # so that an export without rows has the same columns
    part = F.regexp_extract("_metadata.file_path", r"part=(\d+)", 1).cast("long")
    lines = files.select(part.alias("part"), F.col("value").alias("line"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("block", "at")) - 1  # a part has part_rows rows
    return lines.select((F.col("part") * part_rows + place).alias("row"), "line")


def ordered_export(lines: DataFrame, key: str, entries: Column | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """(key, line, row, pointer) of lines written in order of the key and read back by their places."""
    spark = lines.sparkSession
    path = f"{shared_folder(spark)}/airwave/ordered-{uuid.uuid4().hex}"
    write_ordered(lines, key, path, entries, part_rows)
    return spark.read.parquet(f"{path}/rows").join(read_ordered(spark, path, part_rows), "row").select(key, "line", "row", "pointer")


def densified(lines: DataFrame) -> DataFrame:
    """(id, line) for each id from 1 to the largest; a blank where there is none."""
    most = lines.agg(F.max("id")).first()[0] or 0  # one number; the range itself is made in parallel
    ids = lines.sparkSession.range(1, most + 1).select(F.col("id").cast(lines.schema["id"].dataType).alias("id"))
    return ids.join(lines, "id", "left").select("id", F.coalesce("line", F.lit(" ")).alias("line"))


def active_rows(ratings: DataFrame, least: int = 5) -> DataFrame:
    """Users with so many entries, as item and rating in turn."""
    one = lambda e: F.concat_ws(" ", e["item"].cast("string"), number(e["rating"]))
    rows = ratings.groupBy("user").agg(F.count("*").alias("n"), _listed(F.struct("item", "rating"), " ", one).alias("line"))
    return rows.where(F.col("n") >= least).select("user", "line")
