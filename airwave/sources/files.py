"""Headerless, positional text inputs. Paths may be globs or gzip; no schema is inferred."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _delimited(spark: SparkSession, paths, sep: str, fields: dict[str, int], width: int) -> DataFrame:
    schema = ", ".join(f"f{i} string" for i in range(width))
    raw = spark.read.schema(schema).option("sep", sep).option("quote", "").csv(paths)
    return raw.select(*(F.col(f"f{i}").alias(name) for name, i in fields.items()))


def valid_dates(spark: SparkSession, prefix: str, dates: list[str], work_days: bool = False) -> list[str]:
    """The dates (yyyyMMdd) whose path prefix + date is there; on request only Monday to Thursday."""
    asked = [d for d in dates if not work_days or datetime.strptime(d, "%Y%m%d").weekday() < 4]
    if not asked:
        return []
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{prefix}*")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern) or ()
    names = {f.getPath().getName() for f in found}
    last = prefix.rsplit("/", 1)[-1]
    return [d for d in asked if last + d in names]


def by_month(dates: list[str]) -> dict[str, list[str]]:
    """The dates of each month (yyyyMM), in order."""
    out: dict[str, list[str]] = {}
    for d in sorted(dates):
        out.setdefault(d[:6], []).append(d)
    return out


def watch_log(spark: SparkSession, prefix: str, dates: list[str]) -> DataFrame | None:
    """user, item, seconds of the given days that are there; None without any."""
    dates = valid_dates(spark, prefix, dates)
    if not dates:
        return None
    rows = _delimited(spark, [prefix + d for d in dates], "\t", {"user": 0, "item": 1, "rating": 2}, 3)
    return rows.withColumn("rating", F.col("rating").cast("double"))


def ratings_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("user int, item int, rating double").csv(path)


def binary_ratings(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Every listed pair has rating 1."""
    return _delimited(spark, path, sep, {"user": 0, "item": 1}, 2).withColumn("rating", F.lit(1.0))


def schedule(spark: SparkSession, path: str) -> DataFrame:
    return _delimited(spark, path, "|", {"channel": 1, "start": 2, "end": 3, "program": 4}, 20)


def genres(spark: SparkSession, path: str, lang: str = "en", clean: bool = False) -> DataFrame:
    """Genre ids and descriptions of a language; clean: white space in descriptions becomes '-'."""
    rows = _delimited(spark, path, "|", {"genre_id": 1, "lang": 2, "description": 3}, 8).where(F.col("lang") == lang).distinct()
    return rows.withColumn("description", F.regexp_replace("description", r"\s", "-")) if clean else rows


def program_genres(spark: SparkSession, path: str) -> DataFrame:
    rows = _delimited(spark, path, "|", {"item": 1, "genre_id": 2, "rank": 3}, 8)
    return rows.withColumn("rank", F.expr("try_cast(trim(rank) AS int)"))


def program_texts(spark: SparkSession, path: str) -> DataFrame:
    rows = _delimited(spark, path, "|", {"item": 1, "text": 4}, 8)
    return rows.withColumn("text", F.coalesce("text", F.lit(""))).where(F.length("text") > 0)


def channel_names(spark: SparkSession, path: str) -> DataFrame:
    return _delimited(spark, path, "|", {"channel": 1, "name": 2}, 8).groupBy("channel").agg(F.min("name").alias("name"))


def geo(spark: SparkSession, paths) -> DataFrame:
    rows = _delimited(spark, paths, "\t", {"user": 0, "lat": 1, "lon": 2}, 3)
    return rows.select("user", F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon")).distinct()


def scheduled_watch(spark: SparkSession, paths) -> DataFrame:
    """user, item, hour of an ISO time stamp, seconds."""
    rows = _delimited(spark, paths, "\t", {"user": 0, "item": 1, "ts": 2, "seconds": 4}, 5)
    at = F.try_to_timestamp(F.regexp_replace("ts", r"T\s*", " "))
    return rows.select("user", "item", F.hour(at).alias("hour"), F.to_date(at).alias("date"), F.expr("try_cast(seconds AS double)").cast("int").alias("seconds"))


def program_scores(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("user int, program string, score double").option("sep", "\t").csv(path)


def program_map(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("program string, id int").option("sep", "\t").csv(path)


def feature_map(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("idx int, name string, score double").csv(path)


def labeled_csv(spark: SparkSession, path: str) -> DataFrame:
    """Lines id,id,feature...,label: the features as an array, and the label."""
    parts = F.split(F.col("value"), ",")
    n = F.size(parts)
    cast = lambda x: x.cast("double")
    return spark.read.text(path).select(F.transform(F.slice(parts, F.lit(3), n - 3), cast).alias("features"), cast(F.element_at(parts, -1)).alias("label"))
