"""Mixing sources to target weights along a time-varying curriculum.

Sources in code point order (null last) have weights 5, 2, 1, repeating, and share all words of the corpus; a source's
target stops at MAX_REPEAT times its size, and what is over is shared again by weight (water filling: in order of
size by weight, a source stops if its limit is below the level that the rest of the words gives).

Within a source the documents stand in the order of a hash of their ids. Whole passes over the source make up the floor of
target by size, and a first part of one more pass the rest, so the words taken miss the target by half a document at
most, with equal rows too, as each stands in the order by itself. Each weight has a schedule over training time, piecewise linear. Its integral is the share of the target that is
wanted by a time; inverting it at the middle of a document's words gives the document's position in training, and the
documents are range-sorted by it.

Running sums are taken in two steps, by bucket of the hash and then within a bucket, so that no source is one task. Sources may
be as many as hosts: they are numbered, and their limits added up, by range-sorted partitions and the partitions' totals.

Defined cases: null text has size 0; documents of size 0, and all of a source without words, are taken 0 times and
have no position; null ids are ordered by their rows' content; columns of documents named position or copy give way in the
stream (no other name clashes); equal rows are taken equally often, but for one copy; an empty table gives an empty result.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airwave.llm.common import KEY, map_batches, row_key, staged, utf8

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
#: Knots (time, rate) of each weight's schedule: heavy sources come more at the start, light ones more towards the end.
SCHEDULES = {5: ((0.0, 1.5), (1.0, 0.5)), 2: ((0.0, 1.0), (0.5, 1.25), (1.0, 0.75)), 1: ((0.0, 0.5), (0.7, 1.0), (1.0, 2.0))}
#: Hex digits of the id's hash that make a bucket: 4096 buckets to a source.
BUCKET_DIGITS = 3
#: Equal rows that are made from one row at once.
CHUNK = 4096


def _sizes(batch: pa.RecordBatch) -> dict[str, list]:
    return {"key": batch.column(0), "doc_id": batch.column(1), "source": batch.column(2), "size": [len(x.split()) for x in utf8(batch)]}


def sizes(docs: DataFrame) -> DataFrame:
    """(key, doc_id, place, size, h): place is the source, made not null; h the hash that orders a source."""
    rows = docs.select(row_key("doc_id", "source", "text").alias("key"), "doc_id", "source", "text")
    sized = map_batches(rows, _sizes, f"key {KEY}, doc_id long, source string, size long")
    place = F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source")))
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat_ws(" ", F.lit(""), "key.a", "key.b"))
    return sized.select("key", "doc_id", place.alias("place"), "size", F.md5(name).alias("h"))


def before(df: DataFrame, order: list[Column], **sums: str) -> DataFrame:
    """df with columns name = sum of a column over all rows that come before, without a sort in one task.

    Rows are range-sorted and written; a partition adds up its own, and what comes before it is the totals of the partitions, a
    table as small as their number.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    ranged = staged(ranged, "ranged").withColumn("part", F.shiftright("at", 33))
    parts = ranged.groupBy("part").agg(*(F.sum(c).alias(f"{name}_part") for name, c in sums.items()))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", *(F.coalesce(F.sum(f"{name}_part").over(earlier), F.lit(0)).alias(f"{name}_part") for name in sums))
    own = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    ranged = ranged.withColumns({name: F.coalesce(F.sum(c).over(own), F.lit(0)) for name, c in sums.items()}).join(F.broadcast(parts), "part")
    return ranged.withColumns({name: F.col(name) + F.col(f"{name}_part") for name in sums}).drop("at", "part", *(f"{name}_part" for name in sums))


def targets(sized: DataFrame) -> DataFrame:
    """(place, source_size, weight, target): one row for each source."""
    by_source = sized.groupBy("place").agg(F.sum("size").alias("source_size")).withColumn("one", F.lit(1).cast("long"))
    ranked = before(by_source, [F.col("place")], rank="one")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    t = ranked.select("place", "source_size", weight.alias("weight"), (F.lit(MAX_REPEAT) * F.col("source_size")).alias("most"))
    t = before(t, [F.col("most") / F.col("weight"), F.col("place")], most_before="most", weight_before="weight")
    words, weights = (float(x or 0) for x in t.agg(F.sum("source_size"), F.sum("weight")).first())
    share = (F.lit(words) - F.col("most_before")) / (F.lit(weights) - F.col("weight_before"))
    t = staged(t.withColumn("stops", F.col("most") <= share * F.col("weight")), "limits")
    stopped, their_weight = (float(x or 0) for x in t.where("stops").agg(F.sum("most"), F.sum("weight")).first())
    level = (words - stopped) / (weights - their_weight) if weights > their_weight else 0.0
    target = F.when(F.col("stops"), F.col("most").cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return t.select("place", "source_size", "weight", target.alias("target"))


def time_of(share: Column, knots: tuple[tuple[float, float], ...]) -> Column:
    """The time by which a schedule has asked for this share of its integral."""
    steps, total = [], 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
        steps.append((t0, t1, w0, (w1 - w0) / (t1 - t0), total))
        total += (w0 + w1) / 2 * (t1 - t0)
    out = None
    for t0, t1, w0, slope, g0 in steps[::-1]:
        g = share * F.lit(total) - F.lit(g0)
        t = F.least(F.lit(t1), F.lit(t0) + 2 * g / (F.lit(w0) + F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * g, F.lit(0.0)))))
        out = t if out is None else F.when(share * F.lit(total) <= F.lit(g0 + (w0 + w0 + slope * (t1 - t0)) / 2 * (t1 - t0)), t).otherwise(out)
    return out


def plan(docs: DataFrame) -> DataFrame:
    """A row for each row of docs: figures of its source, the words taken of it, and the positions of its copies.

    Equal rows stand one after the other in the order of their source, so that of many equal rows as many are taken once more as the
    target asks for. They share a key, and nth counts them from 0; a key's rows are made from one row in steps of CHUNK.
    """
    sized = staged(sizes(docs), "sizes").withColumn("bucket", F.substring("h", 1, BUCKET_DIGITS))
    units = sized.groupBy("place", "bucket", "h", "size", "key", "doc_id").agg(F.count("*").alias("rows")).withColumn("all", F.col("rows") * F.col("size"))
    sums = sized.groupBy("place", "bucket").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("place").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("place", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("bucket_start")).join(targets(sized), "place")
    inner = Window.partitionBy("place", "bucket").orderBy("h", "size", "key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = units.withColumn("upto", F.sum("all").over(inner)).join(sums, ["place", "bucket"])
    rows = rows.withColumn("first", F.col("bucket_start") + F.col("upto") - F.col("all"))
    rows = rows.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1, F.lit(CHUNK).cast("long"))))
    rows = rows.withColumn("nth", F.explode(F.sequence(F.col("from"), F.least(F.col("from") + CHUNK, F.col("rows")) - 1)))
    whole = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0))
    rows = rows.withColumn("start", F.col("first") + F.col("nth") * F.col("size")).withColumn("whole", whole)
    extra = F.col("start") + F.col("size") / 2 < F.col("target") - F.col("whole") * F.col("source_size")
    rows = rows.withColumn("copies", F.when(F.col("size") > 0, F.col("whole") + extra.cast("long")).otherwise(0))

    def position(copy: Column) -> Column:
        share = F.least(F.lit(1.0), F.try_divide(copy * F.col("source_size") + F.col("start") + F.col("size") / 2, F.col("target")))
        out = F.lit(None).cast("double")
        for w, knots in SCHEDULES.items():
            out = F.when(F.col("weight") == w, time_of(share, knots)).otherwise(out)
        return out

    made = F.transform(F.filter(F.array(*map(F.lit, range(MAX_REPEAT))), lambda c: c < F.col("copies")), position)
    return rows.select(
        "key", "doc_id", "rows", "nth", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), made.alias("positions")
    )


def op10_curriculum_mix(docs: DataFrame) -> DataFrame:
    """A row for each document with its copies' positions; range-sorted by the first, documents without one at the end."""
    listed = F.array_join(F.transform("positions", lambda x: F.format_string("%.6f", x)), ",")
    rows = plan(docs).select(
        "doc_id", "size", "source_size", "target", "taken",
        F.round(F.try_element_at("positions", F.lit(1)), 9).alias("first_position"), listed.alias("positions"),
    )
    order = F.asc_nulls_last("first_position"), F.col("doc_id")
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def mixed(docs: DataFrame) -> DataFrame:
    """The training stream: a row for each copy with its position, range-sorted by position.

    Of equal rows one carries the text to all their positions.
    """
    placed = staged(plan(docs).where(F.size("positions") > 0).select("key", "rows", "positions"), "placed")
    several = staged(placed.where("rows > 1").select("key").distinct(), "equal-rows")
    own = [c for c in docs.columns if c not in ("position", "copy")]
    rows = docs.select(row_key("doc_id", "source", "text").alias("key"), F.struct(*(docs[c] for c in own)).alias("doc"))
    once = rows.join(several, "key", "left_semi").groupBy("key").agg(F.first("doc").alias("doc"))
    rows = rows.join(several, "key", "left_anti").unionByName(once).join(placed, "key")
    stream = rows.select("doc", "key", F.posexplode("positions").alias("copy", "position"))
    order = "position", "key", "copy"
    return stream.repartitionByRange("position", "key").sortWithinPartitions(*order).select("doc.*", "copy", "position")


def _time_sql(share: str, knots: tuple[tuple[float, float], ...]) -> str:
    parts, total = [], 0.0
    steps = []
    for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
        steps.append((t0, t1, w0, (w1 - w0) / (t1 - t0), total))
        total += (w0 + w1) / 2 * (t1 - t0)
    for t0, t1, w0, slope, g0 in steps:
        g = f"({share} * {total!r}::DOUBLE - {g0!r}::DOUBLE)"
        t = f"least({t1!r}::DOUBLE, {t0!r}::DOUBLE + 2 * {g} / ({w0!r}::DOUBLE + sqrt(greatest({w0 * w0!r}::DOUBLE + {2 * slope!r}::DOUBLE * {g}, 0::DOUBLE))))"
        parts.append((f"{share} * {total!r}::DOUBLE <= {g0 + (w0 + w0 + slope * (t1 - t0)) / 2 * (t1 - t0)!r}::DOUBLE", t))
    return "CASE " + " ".join(f"WHEN {c} THEN {t}" for c, t in parts[:-1]) + f" ELSE {parts[-1][1]} END" if len(parts) > 1 else parts[0][1]


SHARE_SQL = "least(1::DOUBLE, (c * source_size + start + size / 2) / nullif(target, 0))"
OP10_SQL = rf"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS place,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), s AS (SELECT place, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS most FROM d GROUP BY place
), w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY place)) - 1) % 3 + 1] AS weight FROM s
), c AS (
  SELECT *, sum(source_size) OVER ()::DOUBLE AS words, sum(weight) OVER ()::DOUBLE AS weights,
    coalesce(sum(most) OVER b, 0)::DOUBLE AS most_before, coalesce(sum(weight) OVER b, 0)::DOUBLE AS weight_before
  FROM w WINDOW b AS (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), st AS (SELECT *, most <= (words - most_before) / (weights - weight_before) * weight AS stops FROM c
), lv AS (
  SELECT *, (words - sum(CASE WHEN stops THEN most ELSE 0 END) OVER ()::DOUBLE)
    / nullif(weights - sum(CASE WHEN stops THEN weight ELSE 0 END) OVER ()::DOUBLE, 0) AS level FROM st
), t AS (SELECT place, source_size, weight, CASE WHEN stops THEN most::DOUBLE ELSE level * weight END AS target FROM lv
), r AS (
  SELECT d.*, source_size, weight, target, sum(size) OVER (PARTITION BY place ORDER BY h, size ROWS UNBOUNDED PRECEDING)::BIGINT - size AS start,
    coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS whole
  FROM d JOIN t USING (place)
), k AS (
  SELECT *, CASE WHEN size > 0 THEN whole + (start + size / 2 < target - whole * source_size)::BIGINT ELSE 0 END AS copies,
    least(1::DOUBLE, (start + size / 2) / nullif(target, 0)) AS share FROM r
)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken,
  CASE WHEN copies > 0 THEN round(CASE weight {" ".join(f"WHEN {w} THEN {_time_sql('share', k)}" for w, k in SCHEDULES.items())} END, 9) END AS first_position,
  array_to_string(list_transform(range(copies), lambda c: printf('%.6f',
    CASE weight {" ".join(f"WHEN {w} THEN {_time_sql(SHARE_SQL, k)}" for w, k in SCHEDULES.items())} END)), ',') AS positions
FROM k
"""
