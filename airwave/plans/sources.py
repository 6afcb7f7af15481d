"""Scans and sinks: inputs are written as the headerless text that the readers take, and read back."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airwave.functions import scalars
from airwave.operators import aggregates, exports, features, scoring
from airwave.operators.relational import dense_ids
from airwave.plans.pipelines import programs_by_hour
from airwave.plans.registry import query
from airwave.sources import artifacts, files
from airwave.sources.views import Views


#: Stands for a field that the readers skip.
NONE = "(skipped)"


def text_file(rows: DataFrame, sep: str, *columns) -> str:
    """The columns as lines of text in shared storage; the path."""
    path = f"{artifacts.shared_folder(rows.sparkSession)}/airwave/text-{uuid.uuid4().hex}"
    field = lambda c: F.lit("x") if isinstance(c, str) and c == NONE else F.col(c) if isinstance(c, str) else c
    rows.select(F.concat_ws(sep, *(F.coalesce(field(c).cast("string"), F.lit("")) for c in columns)).alias("value")).write.text(path)
    return path


@query("scan_watch_log", "watch", """SELECT CAST("user" AS VARCHAR) AS "user", CAST(item AS VARCHAR) AS item, rating FROM watch
WHERE date IN (DATE '1995-01-02', DATE '1995-01-03', DATE '1995-01-04')""")
def scan_watch_log(v: Views):
    """Three days that were written, and one that is asked for but missing."""
    base = f"{artifacts.shared_folder(v.spark)}/airwave/watch-{uuid.uuid4().hex}/"
    days = ["19950102", "19950103", "19950104"]
    rows = v.watch().withColumn("day", F.date_format("date", "yyyyMMdd")).where(F.col("day").isin(days))
    rows.select(F.concat_ws("\t", "user", "item", "rating").alias("value"), "day").write.partitionBy("day").text(base)
    return files.watch_log(v.spark, f"{base}day=", [*days, "18991231"])


@query("scan_ratings_csv", "watch", 'SELECT CAST("user" AS INT) AS "user", CAST(item AS INT) AS item, rating FROM watch')
@query("sink_ratings_csv", "watch", 'SELECT CAST("user" AS INT) AS "user", CAST(item AS INT) AS item, rating FROM watch')
def scan_ratings_csv(v: Views):
    return files.ratings_csv(v.spark, text_file(v.watch(), ",", "user", "item", "rating"))


@query("scan_binary_ratings", "watch", 'SELECT CAST("user" AS VARCHAR) AS "user", CAST(item AS VARCHAR) AS item, 1.0::DOUBLE AS rating FROM watch')
def scan_binary_ratings(v: Views):
    return files.binary_ratings(v.spark, text_file(v.watch(), "\t", "user", "item"), "\t")


def _schedule(v: Views) -> DataFrame:
    return files.schedule(v.spark, text_file(v.schedule(), "|", F.lit("US"), "channel", "start", "start", "program"))


@query("scan_schedule", "schedule", 'SELECT channel, start, start AS "end", CAST(program AS VARCHAR) AS program FROM schedule')
def scan_schedule(v: Views):
    return _schedule(v)


@query("scan_programs_on_date", "schedule", "SELECT DISTINCT CAST(program AS VARCHAR) AS program FROM schedule WHERE start LIKE '20240105%'")
def scan_programs_on_date(v: Views):
    return _schedule(v).where(F.substring("start", 1, 8) == "20240105").select("program").distinct()


@query("scan_genre_dict", "", "SELECT DISTINCT source AS genre_id, lang, 'about ' || source AS description FROM documents WHERE lang = 'de'")
def scan_genre_dict(v: Views):
    docs = v.table("documents").withColumn("d", F.concat(F.lit("about "), "source"))
    return files.genres(v.spark, text_file(docs, "|", NONE, "source", "lang", "d"), "de")


@query("scan_genre_desc_clean", "", "SELECT DISTINCT source AS genre_id, lang, 'about-' || source AS description FROM documents WHERE lang = 'en'")
def scan_genre_desc_clean(v: Views):
    docs = v.table("documents").withColumn("d", F.concat(F.lit("about "), "source"))
    return files.genres(v.spark, text_file(docs, "|", NONE, "source", "lang", "d"), clean=True)


def _program_genres(v: Views) -> DataFrame:
    return files.program_genres(v.spark, text_file(v.program_genre(), "|", NONE, "item", "genre", F.concat(F.lit(" "), F.col("rank").cast("string"))))


@query("scan_program_genre", "watch pg", """SELECT DISTINCT CAST(item AS VARCHAR) AS item, genre AS genre_id FROM pg
WHERE item IN (SELECT item FROM watch) AND genre IN (SELECT genre FROM pg WHERE rank = 1)""")
def scan_program_genre(v: Views):
    first = v.program_genre().where("rank = 1").select(F.col("genre").alias("genre_id")).distinct()
    rows = _program_genres(v).join(v.watch().select(F.col("item").cast("string")), "item", "left_semi").join(first, "genre_id", "left_semi")
    return rows.select("item", "genre_id").distinct()


@query("scan_program_genre_top", "pg", "SELECT CAST(item AS VARCHAR) AS item, genre AS genre_id, rank FROM pg WHERE rank IN (1, 2, 3)")
def scan_program_genre_top(v: Views):
    return _program_genres(v).where(F.col("rank").isin(1, 2, 3))


@query("scan_program_desc", "watch", r"""SELECT CAST(doc_id AS VARCHAR) AS item, regexp_replace(text, '[\r\n|]', ' ', 'g') AS text FROM documents
WHERE length(text) > 0 AND doc_id IN (SELECT item FROM watch)""")
def scan_program_desc(v: Views):
    """Descriptions of known items; line and field ends within a text become blanks, as in the input files."""
    text = F.regexp_replace("text", r"[\r\n|]", " ")
    rows = files.program_texts(v.spark, text_file(v.table("documents"), "|", NONE, "doc_id", NONE, NONE, text))
    return rows.join(v.watch().select(F.col("item").cast("string")).distinct(), "item", "left_semi")


@query("scan_channel_names", "", "SELECT CAST(s_suppkey AS VARCHAR) AS channel, min(s_name) AS name FROM supplier GROUP BY 1")
def scan_channel_names(v: Views):
    return files.channel_names(v.spark, text_file(v.table("supplier").union(v.table("supplier")), "|", NONE, "s_suppkey", "s_name"))


@query("scan_geo", "geo", 'SELECT DISTINCT CAST("user" AS VARCHAR) AS "user", lat, lon FROM geo')
def scan_geo(v: Views):
    return files.geo(v.spark, text_file(v.geo().union(v.geo()), "\t", "user", "lat", "lon"))


@query("scan_sched_watch", "sched", """SELECT CAST("user" AS VARCHAR) AS "user", CAST(item AS VARCHAR) AS item, hour,
strftime(date, '%Y-%m-%d') AS day, CAST(floor(seconds) AS INT) AS seconds FROM sched""")
def scan_sched_watch(v: Views):
    iso = F.date_format("ts", "yyyy-MM-dd'T 'HH:mm:ss")
    path = text_file(v.sched(), "\t", "user", "item", iso, NONE, F.floor("seconds"))
    return files.scheduled_watch(v.spark, path).select("user", "item", "hour", F.date_format("date", "yyyy-MM-dd").alias("day"), "seconds")


@query("scan_valid_dates", "sched", """SELECT CAST(month(date) AS INT) AS month, CAST(count(DISTINCT date) AS BIGINT) AS days, CAST(min(date) AS VARCHAR) AS first_day FROM sched
WHERE dayofweek(date) NOT IN (5, 6, 0) GROUP BY 1""")
def scan_valid_dates(v: Views):
    """Work days of two years that have a folder, by month; most are missing."""
    base = f"{artifacts.shared_folder(v.spark)}/airwave/days-{uuid.uuid4().hex}/"
    v.sched().select(F.col("user").cast("string").alias("value"), F.date_format("date", "yyyyMMdd").alias("day")).write.partitionBy("day").text(base)
    asked = [(datetime(2023, 1, 1) + timedelta(days=i)).strftime("%Y%m%d") for i in range(731)]
    months = files.by_month(files.valid_dates(v.spark, f"{base}day=", asked, work_days=True))
    rows = [(int(m[4:]), len(days), f"{days[0][:4]}-{days[0][4:6]}-{days[0][6:]}") for m, days in months.items()]
    return v.spark.createDataFrame(rows, "month int, days long, first_day string")


@query("scan_program_scores", "watch", 'SELECT CAST("user" AS INT) AS "user", CAST(item AS VARCHAR) AS program, rating AS score FROM watch')
def scan_program_scores(v: Views):
    return files.program_scores(v.spark, text_file(v.watch(), "\t", "user", "item", "rating"))


@query("scan_program_map", "", "SELECT p_name AS program, CAST(p_partkey AS INT) AS id FROM part")
def scan_program_map(v: Views):
    return files.program_map(v.spark, text_file(v.table("part"), "\t", "p_name", "p_partkey"))


@query("scan_feature_map", "", "SELECT CAST(p_partkey AS INT) AS idx, p_name AS name FROM part")
def scan_feature_map(v: Views):
    return files.feature_map(v.spark, text_file(v.table("part"), ",", "p_partkey", "p_name", F.lit(1.5))).select("idx", "name")


@query("scan_labeled_csv", "", "SELECT CAST(p_size AS VARCHAR) || '.0,' || CAST(p_partkey % 7 AS VARCHAR) || '.0' AS features, CAST(p_partkey % 3 AS DOUBLE) AS label FROM part")
def scan_labeled_csv(v: Views):
    rows = files.labeled_csv(v.spark, text_file(v.table("part"), ",", NONE, NONE, "p_size", F.col("p_partkey") % 7, F.col("p_partkey") % 3))
    return rows.select(F.array_join(F.transform("features", lambda x: x.cast("string")), ",").alias("features"), "label")


# Sinks.


@query("sink_artifact", "watch", 'SELECT "user", item, sum(rating) AS rating FROM watch GROUP BY ALL')
def sink_artifact(v: Views):
    return artifacts.cut(aggregates.sum_pairs(v.watch()), "pairs")


@query("sink_if_absent", "watch", """SELECT 'kept' AS how, "user", count(*)::BIGINT AS n FROM watch GROUP BY ALL
UNION ALL SELECT 'overwritten', "user", sum(rating)::BIGINT FROM watch GROUP BY ALL UNION ALL SELECT 'incomplete', "user", count(*)::BIGINT FROM watch GROUP BY ALL""")
def sink_if_absent(v: Views):
    """A whole result is kept, or overwritten if asked; a folder that a writer left without its mark is written anew. Names come from inputs and parameters."""
    counts = v.watch().groupBy("user").agg(F.count("*").alias("n"))
    sums = v.watch().groupBy("user").agg(F.sum("rating").cast("long").alias("n"))
    parts = []
    for how in ("kept", "overwritten", "incomplete"):
        name = artifacts.name_of("counts", v.sf_dir, how, uuid.uuid4().hex)
        artifacts.save(counts if how != "incomplete" else sums, name)
        if how == "incomplete":
            artifacts.remove(v.spark, f"{artifacts.shared_folder(v.spark)}/airwave/{name}/_SUCCESS")
        again = artifacts.save(sums if how != "incomplete" else counts, name, overwrite=how == "overwritten")
        parts.append(again.select(F.lit(how).alias("how"), "user", "n"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("artifact_key", "watch", """SELECT "user", md5(array_to_string(list_sort(list(DISTINCT CAST(item AS VARCHAR))), '%')) AS md5_key,
sha256(array_to_string(list_sort(list(CAST(item AS VARCHAR))), '%')) AS sha256_key FROM watch GROUP BY 1""")
def artifact_key(v: Views):
    items = v.watch().groupBy("user").agg(F.collect_list(F.col("item").cast("string")).alias("items"))
    return items.select("user", artifacts.key_of(F.col("items")).alias("md5_key"), artifacts.key_of(F.col("items"), False, "sha256").alias("sha256_key"))


NUM = "CASE WHEN {0} = floor({0}) THEN CAST(CAST({0} AS BIGINT) AS VARCHAR) ELSE CAST({0} AS VARCHAR) END"
PAIRS = 'pairs AS (SELECT "user", item, sum(rating) AS rating FROM watch GROUP BY ALL)'


@query("sink_user_history_text", "watch", f""", {PAIRS} SELECT "user", "user" || '@' || string_agg('(' || item || ',' || {NUM.format("rating")} || ')', '%' ORDER BY item) AS line
FROM pairs GROUP BY 1""")
def sink_user_history_text(v: Views):
    return exports.user_history(aggregates.sum_pairs(v.watch()))


CHANNEL_BLOCK = """, cap AS (SELECT item FROM channels GROUP BY 1 HAVING count(DISTINCT channel) <= 20),
vocab AS (SELECT channel, CAST(row_number() OVER (ORDER BY channel) - 1 AS INT) AS idx FROM (SELECT DISTINCT channel FROM channels SEMI JOIN cap USING (item))),
block AS (SELECT DISTINCT item AS id, idx, 1.0::DOUBLE AS value FROM channels SEMI JOIN cap USING (item) JOIN vocab USING (channel))"""
GENRE_BLOCK = """, vocab AS (SELECT genre, CAST(row_number() OVER (ORDER BY genre) - 1 AS INT) AS idx FROM (SELECT DISTINCT genre FROM pg)),
block AS (SELECT DISTINCT item AS id, idx, 1.0::DOUBLE AS value FROM pg JOIN vocab USING (genre))"""


def genre_block(v: Views) -> DataFrame:
    pairs = features.genre_pairs(v.program_genre())
    return features.Vocabulary.of(pairs).multi_hot(pairs)


@query("sink_item_feature_text", "pg", GENRE_BLOCK + " SELECT id, id || '@' || string_agg('(' || idx || ',1)', '%' ORDER BY idx) AS line FROM block GROUP BY 1")
def sink_item_feature_text(v: Views):
    return exports.item_features(genre_block(v))


@query("sink_features_sparse_text", "pg", GENRE_BLOCK + " SELECT id, id || ',16,' || string_agg(idx || ',1', ',' ORDER BY idx) AS line FROM block GROUP BY 1")
def sink_features_sparse_text(v: Views):
    return exports.sparse_lines(genre_block(v), 16)


def entries() -> Column:
    """Pairs of a sparse line."""
    return (F.size(F.split("line", ",")) / 2).cast("long")


CSR = """SELECT {0}, line, row_number() OVER (ORDER BY {0}) - 1 AS row,
CAST(coalesce(sum(len(string_split(line, ',')) // 2) OVER (ORDER BY {0} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS pointer FROM lines"""


@query("sink_features_csr", "pg", GENRE_BLOCK + ", lines AS (SELECT id, string_agg(idx || ',1', ',' ORDER BY idx) AS line FROM block GROUP BY 1) " + CSR.format("id"))
def sink_features_csr(v: Views):
    """Rows by item as written to ordered part files and read back by their places, with row pointers."""
    return exports.ordered_export(exports.sparse_lines(genre_block(v)), "id", entries())


RATING_LINES = f""", {PAIRS}, place AS (SELECT item, row_number() OVER (ORDER BY item) AS idx FROM (SELECT DISTINCT item FROM pairs))
SELECT "user", string_agg(idx || ',' || {NUM.format("rating")}, ',' ORDER BY idx) AS line FROM pairs JOIN place USING (item) GROUP BY 1"""


@query("sink_ratings_sparse_text", "watch", RATING_LINES)
def sink_ratings_sparse_text(v: Views):
    return exports.rating_lines(aggregates.sum_pairs(v.watch()))


@query("sink_ratings_csr", "watch", RATING_LINES.replace("SELECT \"user\", string_agg", "lines AS (SELECT \"user\", string_agg").replace("place AS (SELECT item, row_number() OVER (ORDER BY item) AS idx FROM (SELECT DISTINCT item FROM pairs))", "place AS (SELECT item, row_number() OVER (ORDER BY item) AS idx FROM (SELECT DISTINCT item FROM pairs)),") + ") " + CSR.format('"user"'))
def sink_ratings_csr(v: Views):
    """Rows by user as written to ordered part files and read back by their places, with row pointers."""
    return exports.ordered_export(exports.rating_lines(aggregates.sum_pairs(v.watch())), "user", entries())


@query("densify_feature_rows", "watch", f""", {PAIRS}, l AS (SELECT "user" AS id, string_agg(item, ' ' ORDER BY item) AS line FROM pairs GROUP BY 1)
SELECT g.id, coalesce(line, ' ') AS line FROM (SELECT unnest(range(1, (SELECT max(id) FROM l) + 1)) AS id) g LEFT JOIN l ON g.id = l.id""")
def densify_feature_rows(v: Views):
    items = F.array_join(F.transform(F.array_sort(F.collect_list("item")), lambda x: x.cast("string")), " ")
    return exports.densified(aggregates.sum_pairs(v.watch()).groupBy(F.col("user").alias("id")).agg(items.alias("line")))


@query("export_active_user_rows", "watch", f""", {PAIRS} SELECT "user", string_agg(item || ' ' || {NUM.format("rating")}, ' ' ORDER BY item) AS line
FROM pairs GROUP BY 1 HAVING count(*) >= 5""")
def export_active_user_rows(v: Views):
    return exports.active_rows(aggregates.sum_pairs(v.watch()))


@query("filter_schedule_by_programs", "schedule pg", "SELECT channel, start, program FROM schedule WHERE program IN (SELECT item FROM pg WHERE genre = 'red')")
def filter_schedule_by_programs(v: Views):
    return v.schedule().join(v.program_genre().where("genre = 'red'").select(F.col("item").alias("program")), "program", "left_semi").select("channel", "start", "program")


TOP_PROGRAMS = """, firsts AS (SELECT program, start[1:8] AS date, start[9:10] AS hour, min(start) AS start, arg_min(channel, (start, channel)) AS channel FROM schedule GROUP BY ALL),
scores AS (SELECT DISTINCT "user", ("user" * 31 + p * 17) % 1009 / 1009 AS score, p AS program FROM (SELECT DISTINCT "user" FROM sched), (SELECT DISTINCT item AS p FROM sched)),
best AS (SELECT "user", date, hour, row_number() OVER (PARTITION BY "user", date, hour ORDER BY score DESC, program) AS rank, program, start, channel, score FROM firsts JOIN scores USING (program)
  WHERE date = '20240105' QUALIFY rank <= 5)"""


def hourly(v: Views) -> DataFrame:
    users, programs = v.sched().select("user").distinct(), v.sched().select("item").distinct()
    return programs_by_hour(users, programs, v.schedule(), ["20240105"], 5, lambda u, i: (u["user"] * 31 + i["item"] * 17) % 1009 / 1009)


@query("topk_programs_per_hour", "sched schedule", TOP_PROGRAMS + ' SELECT "user", date, hour, CAST(rank AS INT) AS rank, program, start, channel, round(score, 9) AS score FROM best')
def topk_programs_per_hour(v: Views):
    return hourly(v).withColumn("score", F.round("score", 9))


@query("sink_hourly_recs", "sched schedule", TOP_PROGRAMS + """ SELECT date, hour, "user", string_agg(program, chr(9) ORDER BY rank) AS programs FROM best GROUP BY ALL""")
def sink_hourly_recs(v: Views):
    return exports.written_by_hour(hourly(v))


SUMMARY = (
    GENRE_BLOCK
    + """, corpus AS (SELECT count(DISTINCT "user") AS users, count(DISTINCT item) AS items, count(*) AS n, min(date) AS first, max(date) AS last, count(DISTINCT date) AS days FROM train),
sized AS (SELECT count(*) AS n, 1 + max(idx) AS size FROM block), tested AS (SELECT sqrt(avg(pow(rating - (SELECT avg(rating) FROM train), 2))) AS rmse, count(*) AS n FROM test)
SELECT 'dates' AS section, 'first' AS key, strftime(first, '%Y%m%d') AS value FROM corpus UNION ALL SELECT 'dates', 'last', strftime(last, '%Y%m%d') FROM corpus
UNION ALL SELECT 'dates', 'days', CAST(days AS VARCHAR) FROM corpus UNION ALL SELECT 'corpus', 'users', CAST(users AS VARCHAR) FROM corpus
UNION ALL SELECT 'corpus', 'items', CAST(items AS VARCHAR) FROM corpus UNION ALL SELECT 'corpus', 'n', CAST(n AS VARCHAR) FROM corpus
UNION ALL SELECT 'features', 'item_genre', CAST(size AS VARCHAR) FROM sized UNION ALL SELECT 'assembled', 'item_genre', CAST(n AS VARCHAR) FROM sized
UNION ALL SELECT 'models', 'mean', '1' UNION ALL SELECT 'tests', 'mean: rmse', printf('%#.4g', rmse) FROM tested UNION ALL SELECT 'tests', 'mean: rows', CAST(n AS VARCHAR) FROM tested"""
)


@query("report_summary", "watch train test pg", SUMMARY)
def report_summary(v: Views):
    """The run of a model that predicts the mean rating: dates, corpus, features, assembled rows, models and tests."""
    train, test, block = v.train(), v.test(), genre_block(v)
    mean = train.agg(F.avg("rating").alias("prediction"))
    tested = scoring.squared_error(test.crossJoin(F.broadcast(mean)).select(F.col("rating").alias("label"), "prediction")).crossJoin(test.agg(F.count("*").alias("n")))
    return exports.summary(
        {
            "dates": exports.date_figures(train),
            "corpus": aggregates.corpus_stats(train),
            "features": block.agg((F.max("idx") + 1).alias("item_genre")),
            "assembled": block.agg(F.count("*").alias("item_genre")),
            "models": v.spark.range(1).select(F.lit(1).alias("mean")),
            "tests": tested.select(exports.metric("rmse").alias("mean: rmse"), F.col("n").alias("mean: rows")),
        }
    )


@query("rank_dense_id_map", "watch", 'SELECT "user", CAST(row_number() OVER (ORDER BY "user") - 1 AS INT) AS id FROM (SELECT DISTINCT "user" FROM watch)')
def rank_dense_id_map(v: Views):
    return dense_ids(v.watch(), "user", "id")
