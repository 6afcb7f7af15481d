"""Filters, joins, aggregates, rankings, set operations and scalars over the views."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airwave.functions import scalars, vectors
from airwave.operators import aggregates, features, relational
from airwave.plans.pipelines import corpus, temporal_aggregation
from airwave.plans.registry import query
from airwave.plans.sources import PAIRS
from airwave.sources import files
from airwave.sources.artifacts import save, shared_folder
from airwave.sources.views import CUT, Views


@query("filter_date_range", "watch", """SELECT CAST("user" AS BIGINT) AS "user", item, rating, strftime(date, '%Y%m%d') AS day FROM watch
WHERE date BETWEEN DATE '1995-02-01' AND DATE '1995-02-14'""")
def filter_date_range(v: Views):
    low, high = scalars.date_range("19950214", "19950201")
    return v.watch().where(F.col("date").between(low, high)).select("user", "item", "rating", F.date_format("date", "yyyyMMdd").alias("day"))


@query("filter_min_watch", "watch", 'SELECT "user", item, rating FROM watch WHERE rating >= 300')
def filter_min_watch(v: Views):
    return v.watch().where("rating >= 300").select("user", "item", "rating")


@query("filter_min_support", "watch", """SELECT "user", item, rating FROM watch WHERE "user" IN (SELECT "user" FROM watch GROUP BY 1 HAVING count(*) > 3)
AND item IN (SELECT item FROM watch GROUP BY 1 HAVING count(*) > 2)""")
def filter_min_support(v: Views):
    return relational.min_support(v.watch(), 3, 2).select("user", "item", "rating")


@query("filter_hour_slot", "schedule", "SELECT channel, start, program FROM schedule WHERE start LIKE '2024010508%'")
def filter_hour_slot(v: Views):
    at = F.to_timestamp(F.lit("2024010508"), "yyyyMMddHH")
    return v.schedule().where(F.date_trunc("hour", F.to_timestamp("start", "yyyyMMddHHmm")) == at)


@query("filter_channel_cap", "channels", "SELECT item, count(DISTINCT channel)::BIGINT AS n_channels FROM channels GROUP BY 1 HAVING count(DISTINCT channel) <= 20")
def filter_channel_cap(v: Views):
    return relational.channel_cap(v.channels())


@query("filter_in_vocab", "pg watch", 'SELECT "user", item, rating FROM watch WHERE item IN (SELECT item FROM pg WHERE genre = \'blue\')')
def filter_in_vocab(v: Views):
    return v.watch().join(v.program_genre().where("genre = 'blue'"), "item", "left_semi").select("user", "item", "rating")


@query("filter_feature_coverage", "watch pg", """, total AS (SELECT count(DISTINCT item) AS n FROM watch), b AS (SELECT genre AS block, count(DISTINCT item) AS c
FROM pg SEMI JOIN watch USING (item) GROUP BY 1) SELECT block FROM b, total WHERE c > 0.12 * n""")
def filter_feature_coverage(v: Views):
    items = v.watch().select("item").distinct()
    blocks = v.program_genre().join(items, "item", "left_semi").select(F.col("genre").alias("block"), F.col("item").alias("id"))
    return relational.coverage(blocks, items.count(), 0.12)


KNOWN = 'SELECT t."user", t.item, t.rating FROM test t WHERE t."user" IN (SELECT "user" FROM train) AND t.item IN (SELECT item FROM train)'


@query("filter_test_known", "watch train test", KNOWN)
def filter_test_known(v: Views):
    return relational.known_only(v.test(), v.train(), v.train()).select("user", "item", "rating")


@query("filter_seen_users_for_items", "watch pg", "SELECT DISTINCT \"user\" FROM watch WHERE item IN (SELECT item FROM pg WHERE genre = 'red')")
def filter_seen_users_for_items(v: Views):
    return v.watch().join(v.program_genre().where("genre = 'red'"), "item", "left_semi").select("user").distinct()


MAPS = """, um AS (SELECT "user", CAST(row_number() OVER (ORDER BY "user") - 1 AS INT) AS uid FROM (SELECT DISTINCT "user" FROM train)),
im AS (SELECT item, CAST(row_number() OVER (ORDER BY item) - 1 AS INT) AS iid FROM (SELECT DISTINCT item FROM train))"""


ALL_MAPS = MAPS.replace("FROM train", "FROM watch")


def maps(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return relational.dense_ids(rows, "user", "uid"), relational.dense_ids(rows, "item", "iid")


@query("join_ids_to_int", "watch", ALL_MAPS + ' SELECT uid, iid, rating FROM watch JOIN um USING ("user") JOIN im USING (item)')
def join_ids_to_int(v: Views):
    return relational.to_int_ids(v.watch(), *maps(v.watch())).select("uid", "iid", "rating")


@query("build_corpus", "watch", """, shares AS (SELECT CAST("user" AS VARCHAR) AS "user", CAST(item AS VARCHAR) AS item, rating / sum(rating) OVER (PARTITION BY "user") AS rating FROM watch),
um AS (SELECT "user", CAST(row_number() OVER (ORDER BY "user") - 1 AS INT) AS uid FROM (SELECT DISTINCT "user" FROM shares)),
im AS (SELECT item, CAST(row_number() OVER (ORDER BY item) - 1 AS INT) AS iid FROM (SELECT DISTINCT item FROM shares))
SELECT uid, iid, round(rating, 9) AS rating FROM shares JOIN um USING ("user") JOIN im USING (item)""")
def build_corpus(v: Views):
    """Logs of two dates are read, transformed, and given int ids in the order of the ids as text."""
    base = f"{shared_folder(v.spark)}/airwave/corpus-{uuid.uuid4().hex}/"
    rows = v.watch().withColumn("day", F.when(F.col("date") < F.lit(CUT).cast("date"), "19950101").otherwise("19960101"))
    rows.select(F.concat_ws("\t", "user", "item", "rating").alias("value"), "day").write.partitionBy("day").text(base)
    ratings, _, _ = corpus(files.watch_log(v.spark, f"{base}day=", ["19950101", "19960101", "19970101"]), "total")
    return ratings.select("uid", "iid", F.round("rating", 9).alias("rating"))


@query("build_test_set", "watch train test", MAPS + ' SELECT uid, iid, rating FROM test JOIN um USING ("user") JOIN im USING (item)')
@query("join_scores_to_int", "watch train test", MAPS + ' SELECT uid, iid, rating FROM test JOIN um USING ("user") JOIN im USING (item)')
def build_test_set(v: Views):
    return relational.to_int_ids(v.test(), *maps(v.train())).select("uid", "iid", "rating")


@query("join_ids_to_str", "watch", ALL_MAPS + """ SELECT CAST("user" AS VARCHAR) AS user_name, CAST(item AS VARCHAR) AS item_name, count(*)::BIGINT AS n
FROM watch JOIN um USING ("user") JOIN im USING (item) GROUP BY ALL""")
def join_ids_to_str(v: Views):
    users, items = maps(v.watch())
    ints = relational.to_int_ids(v.watch(), users, items).select("uid", "iid")
    back = ints.join(users, "uid").join(items, "iid")
    return back.groupBy(F.col("user").cast("string").alias("user_name"), F.col("item").cast("string").alias("item_name")).agg(F.count("*").alias("n"))


@query("join_id_lookup", "watch pg", ALL_MAPS + " SELECT iid, genre FROM pg JOIN im USING (item)")
def join_id_lookup(v: Views):
    return v.program_genre().join(relational.dense_ids(v.watch(), "item", "iid"), "item").select("iid", "genre")


@query("join_left_default", "channels names", "SELECT channel, coalesce(name, 'unknown') AS name FROM (SELECT DISTINCT channel FROM channels) LEFT JOIN names USING (channel)")
def join_left_default(v: Views):
    return relational.with_default(v.channels().select("channel").distinct(), v.names(), "channel", "name", F.lit("unknown")).select("channel", "name")


@query("join_watch_genre_explode", "sched pg", 'SELECT "user", genre, hour, seconds FROM sched JOIN pg USING (item)')
def join_watch_genre_explode(v: Views):
    return v.sched().join(v.program_genre(), "item").select("user", "genre", "hour", "seconds")


@query("join_scores_schedule", "schedule pg", "SELECT program, channel, start, rank AS score FROM schedule JOIN pg ON program = item")
def join_scores_schedule(v: Views):
    return v.schedule().join(v.program_genre(), F.col("program") == F.col("item")).select("program", "channel", "start", F.col("rank").alias("score"))


BUSY = """, busy AS (SELECT * FROM sched WHERE event_type = 'purchase' AND dayofweek(date) NOT IN (5, 6, 0)),
months AS (SELECT count(DISTINCT month(date)) AS n FROM busy),
active AS (SELECT "user" FROM (SELECT "user", month(date) AS m, count(DISTINCT day(date) // 7) AS w FROM busy GROUP BY ALL) WHERE w >= 5
  GROUP BY 1 HAVING count(*) = (SELECT n FROM months))"""


def busy(v: Views) -> DataFrame:
    return v.sched().where((F.col("event_type") == "purchase") & ~scalars.is_weekend(F.col("date")))


@query("agg_active_users", "sched", BUSY + ' SELECT "user" FROM active')
def agg_active_users(v: Views):
    return aggregates.active_users(busy(v), 5)


@query("semi_active_users", "sched", BUSY + ' SELECT "user", item, seconds FROM busy SEMI JOIN active USING ("user")')
def semi_active_users(v: Views):
    return busy(v).join(aggregates.active_users(busy(v), 5), "user", "left_semi").select("user", "item", "seconds")


REGULAR = """, early AS (SELECT * FROM sched WHERE day(date) <= 7), regular AS (SELECT "user" FROM early GROUP BY 1
  HAVING count(DISTINCT date) = (SELECT count(DISTINCT date) FROM early))"""


def early(v: Views) -> DataFrame:
    return v.sched().where(F.dayofmonth("date") <= 7)


@query("agg_regular_users", "sched", REGULAR + ' SELECT "user" FROM regular')
def agg_regular_users(v: Views):
    return aggregates.regular_users(early(v))


HOURLY = """, g AS (SELECT "user", genre, hour, sum(seconds) AS seconds FROM (SELECT * FROM early WHERE seconds >= 10) SEMI JOIN regular USING ("user") JOIN pg USING (item) GROUP BY ALL)"""


def hourly_genres(v: Views) -> DataFrame:
    return aggregates.by_genre(early(v), v.program_genre(), ["hour"], 10, aggregates.regular_users(early(v)))


def seconds(df: DataFrame) -> DataFrame:
    return df.withColumn("seconds", F.col("seconds").cast("double"))


@query("agg_hourly_genre", "sched pg", REGULAR + HOURLY + ' SELECT "user", genre, hour, seconds::DOUBLE AS seconds FROM g')
def agg_hourly_genre(v: Views):
    return seconds(hourly_genres(v))


@query("agg_genre_pack", "sched pg", REGULAR + HOURLY + """ SELECT "user", hour, string_agg(genre || ',' || CAST(seconds AS VARCHAR), ',' ORDER BY genre) AS packed FROM g GROUP BY ALL""")
def agg_genre_pack(v: Views):
    return aggregates.packed(hourly_genres(v), ["user", "hour"])


DAILY = """, daily AS (SELECT "user", genre, date, sum(seconds) AS seconds FROM sched JOIN pg USING (item) GROUP BY ALL)"""


@query("agg_daily_genre", "sched pg", DAILY + " SELECT \"user\", genre, strftime(date, '%Y%m%d') AS day, seconds::DOUBLE AS seconds FROM daily")
def agg_daily_genre(v: Views):
    return seconds(aggregates.by_genre(v.sched(), v.program_genre(), ["date"])).select("user", "genre", F.date_format("date", "yyyyMMdd").alias("day"), "seconds")


@query("agg_weekly_from_daily", "sched pg", DAILY + """ SELECT "user", genre, CAST(day(date) // 7 AS INT) AS week, CAST(month(date) AS INT) AS month, sum(seconds)::DOUBLE AS seconds
FROM daily GROUP BY ALL""")
def agg_weekly_from_daily(v: Views):
    return seconds(aggregates.weekly_from_daily(aggregates.by_genre(v.sched(), v.program_genre(), ["date"])))


WEEKLY = """, days AS (SELECT * FROM sched WHERE dayofweek(date) NOT IN (5, 6, 0)), months AS (SELECT count(DISTINCT month(date)) AS n FROM days),
active AS (SELECT "user" FROM (SELECT "user", month(date) AS m, count(DISTINCT day(date) // 7) AS w FROM days GROUP BY ALL) WHERE w >= 2 GROUP BY 1 HAVING count(*) = (SELECT n FROM months))
SELECT "user", genre, CAST(day(date) // 7 AS INT) AS week, CAST(month(date) AS INT) AS month, sum(seconds)::DOUBLE AS seconds
FROM (SELECT * FROM days WHERE seconds >= 10) SEMI JOIN active USING ("user") JOIN pg USING (item) GROUP BY ALL"""


@query("agg_weekly_genre", "sched pg", WEEKLY)
@query("pipeline_temporal_agg", "sched pg", WEEKLY)
def agg_weekly_genre(v: Views):
    return seconds(temporal_aggregation(v.sched(), v.program_genre(), "weekly", min_watch=10))


@query("save_genre_monthly", "sched pg", WEEKLY)
def save_genre_monthly(v: Views):
    """Written with a folder for each month, and read back."""
    saved = save(agg_weekly_genre(v), f"genre-weekly-{uuid.uuid4().hex}", by=("month",))
    return saved.select("user", "genre", "week", F.col("month").cast("int").alias("month"), "seconds")


@query("agg_sum_user_item", "watch", f", {PAIRS} SELECT * FROM pairs")
def agg_sum_user_item(v: Views):
    return aggregates.sum_pairs(v.watch())


@query("agg_norm_max", "watch", 'SELECT "user", item, round(rating / max(rating) OVER (PARTITION BY item), 9) AS rating FROM watch')
def agg_norm_max(v: Views):
    return aggregates.normalised(v.watch(), "max").select("user", "item", F.round("rating", 9).alias("rating"))


@query("agg_norm_total", "watch", 'SELECT "user", item, round(rating / sum(rating) OVER (PARTITION BY "user"), 9) AS rating FROM watch')
def agg_norm_total(v: Views):
    return aggregates.normalised(v.watch(), "total").select("user", "item", F.round("rating", 9).alias("rating"))


@query("norm_none", "watch", 'SELECT "user", item, rating FROM watch')
def norm_none(v: Views):
    return aggregates.normalised(v.watch(), "unheard of").select("user", "item", "rating")


@query("agg_corpus_stats", "watch", 'SELECT count(DISTINCT "user")::BIGINT AS users, count(DISTINCT item)::BIGINT AS items, count(*)::BIGINT AS n FROM watch')
def agg_corpus_stats(v: Views):
    return aggregates.corpus_stats(v.watch())


@query("agg_item_genres", "pg", "SELECT item, string_agg(DISTINCT genre, ',' ORDER BY genre) AS names FROM pg GROUP BY 1")
def agg_item_genres(v: Views):
    return v.program_genre().groupBy("item").agg(F.array_join(F.array_sort(F.collect_set("genre")), ",").alias("names"))


@query("agg_item_channels", "channels", "SELECT item, count(DISTINCT channel)::BIGINT AS n, min(channel) AS least, max(channel) AS most FROM channels GROUP BY 1")
def agg_item_channels(v: Views):
    return v.channels().groupBy("item").agg(F.size(F.collect_set("channel")).cast("long").alias("n"), F.min("channel").alias("least"), F.max("channel").alias("most"))


@query("agg_item_showtimes", "schedule", "SELECT program, string_agg(DISTINCT start[9:10], ',' ORDER BY start[9:10]) AS hours FROM schedule GROUP BY 1")
def agg_item_showtimes(v: Views):
    return v.schedule().groupBy("program").agg(F.array_join(F.array_sort(F.collect_set(F.substring("start", 9, 2))), ",").alias("hours"))


@query("agg_item_text", "", """SELECT conv_id AS item, length(joined)::BIGINT AS n_chars, md5(joined) AS joined FROM (
SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS joined FROM conversations WHERE text IS NOT NULL GROUP BY 1)""")
def agg_item_text(v: Views):
    """An item's texts of several dates, in order; here the turns of a conversation."""
    rows = v.table("conversations").select(F.col("conv_id").alias("item"), F.col("turn").alias("date"), "text")
    return aggregates.item_texts(rows).select("item", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("joined"))


@query("agg_user_item_set", "watch", 'SELECT "user", string_agg(DISTINCT item, \',\' ORDER BY item) AS items FROM watch GROUP BY 1')
def agg_user_item_set(v: Views):
    return v.watch().groupBy("user").agg(F.array_join(F.transform(F.array_sort(F.collect_set("item")), lambda x: x.cast("string")), ",").alias("items"))


@query("rank_vocab_index", "pg", "SELECT genre, CAST(row_number() OVER (ORDER BY genre) - 1 AS INT) AS idx FROM (SELECT DISTINCT genre FROM pg)")
def rank_vocab_index(v: Views):
    return relational.dense_ids(v.program_genre(), "genre", "idx")


@query("order_by_key", "watch", f', {PAIRS} SELECT * FROM pairs ORDER BY "user", item')
def order_by_key(v: Views):
    return aggregates.sum_pairs(v.watch()).orderBy("user", "item")


@query("set_union_dates", "watch train test", 'SELECT "user", item, rating FROM train UNION ALL SELECT "user", item, rating FROM test')
def set_union_dates(v: Views):
    return v.train().unionByName(v.test()).select("user", "item", "rating")


@query("set_distinct", "watch", "SELECT DISTINCT item FROM watch")
def set_distinct(v: Views):
    return v.watch().select("item").distinct()


@query("set_intersect_feature_ids", "watch pg channels", "SELECT item AS id FROM pg INTERSECT SELECT item FROM channels INTERSECT SELECT item FROM watch")
def set_intersect_feature_ids(v: Views):
    return relational.in_all([x.select(F.col("item").alias("id")) for x in (v.program_genre(), v.channels(), v.watch())])


@query("set_intersect_users", "watch train test", 'SELECT "user" FROM train INTERSECT SELECT "user" FROM test')
def set_intersect_users(v: Views):
    return v.train().select("user").intersect(v.test().select("user"))


@query("set_cold_items", "watch train test", "SELECT item FROM test EXCEPT SELECT item FROM train")
def set_cold_items(v: Views):
    return v.test().select("item").distinct().join(v.train(), "item", "left_anti")


# Scalars and vectors.


@query("fn_split_field", "", "SELECT p_partkey, string_split(p_name, ' ')[2] AS second FROM part")
def fn_split_field(v: Views):
    return v.table("part").select("p_partkey", F.get(F.split("p_name", " "), F.lit(1)).alias("second"))


STOPS = ", ".join(f"'{w}'" for w in scalars.STOP_WORDS)
TOKENS = f"""toks AS (SELECT item, t AS term FROM (SELECT item, unnest(regexp_extract_all(lower(text), '([a-z0-9_]+)', 1)) AS t FROM texts) WHERE length(t) > 2 AND t NOT IN ({STOPS}))"""


@query("fn_tokenize", "texts", f", {TOKENS} SELECT item, count(*)::BIGINT AS n, min(term) AS least, max(term) AS most FROM toks GROUP BY 1")
def fn_tokenize(v: Views):
    words = v.texts().select("item", F.explode(scalars.tokens(F.col("text"))).alias("term"))
    return words.groupBy("item").agg(F.count("*").alias("n"), F.min("term").alias("least"), F.max("term").alias("most"))


@query("fn_hhmm", "schedule", "SELECT start, CAST(start[9:12] AS INT) AS clock, count(*)::BIGINT AS n FROM schedule GROUP BY ALL")
def fn_hhmm(v: Views):
    return v.schedule().groupBy("start", scalars.hhmm(F.col("start")).alias("clock")).agg(F.count("*").alias("n"))


@query("fn_utc_epoch", "schedule", "SELECT DISTINCT start, CAST(epoch(strptime(start, '%Y%m%d%H%M')) AS BIGINT) AS epoch FROM schedule")
def fn_utc_epoch(v: Views):
    return v.schedule().select("start", scalars.utc_epoch(F.col("start")).alias("epoch")).distinct()


@query("fn_utc_string", "schedule", "SELECT DISTINCT start, start AS again FROM schedule")
def fn_utc_string(v: Views):
    return v.schedule().select("start", scalars.utc_string(scalars.utc_epoch(F.col("start"))).alias("again")).distinct()


@query("fn_week_of_month", "watch", "SELECT CAST(day(date) // 7 AS INT) AS week, count(*)::BIGINT AS n FROM watch GROUP BY 1")
def fn_week_of_month(v: Views):
    return v.watch().groupBy(scalars.week_of_month(F.col("date")).alias("week")).agg(F.count("*").alias("n"))


@query("fn_is_weekend", "watch", "SELECT dayofweek(date) IN (5, 6, 0) AS weekend, count(*)::BIGINT AS n FROM watch GROUP BY 1")
def fn_is_weekend(v: Views):
    return v.watch().groupBy(scalars.is_weekend(F.col("date")).alias("weekend")).agg(F.count("*").alias("n"))


@query("fn_hour", "sched", "SELECT hour, count(*)::BIGINT AS n FROM sched GROUP BY 1")
def fn_hour(v: Views):
    return v.sched().groupBy("hour").agg(F.count("*").alias("n"))


@query("fn_time_bucket", "schedule", "SELECT CAST(CAST(start[9:12] AS INT) // 200 AS INT) AS bucket, CAST(CAST(start[9:12] AS INT) // 342 AS INT) AS seventh, count(*)::BIGINT AS n FROM schedule GROUP BY ALL")
def fn_time_bucket(v: Views):
    clock = scalars.hhmm(F.col("start"))
    return v.schedule().groupBy(scalars.time_bucket(clock).alias("bucket"), scalars.time_bucket(clock, 7).alias("seventh")).agg(F.count("*").alias("n"))


GEO = """, cells AS (SELECT "user", floor((lat - 24) / 5.2) AS r, floor((-lon - 66) / (59 / 12)) AS c FROM geo),
cell AS (SELECT "user", CAST(CASE WHEN r < 0 OR c < 0 THEN 0 WHEN r >= 5 OR c >= 12 THEN 59 ELSE r * 12 + c END AS INT) AS idx FROM cells)"""


@query("fn_geo_cell", "geo", GEO + ' SELECT "user", idx FROM cell')
def fn_geo_cell(v: Views):
    return v.geo().select("user", scalars.geo_cell(F.col("lat"), F.col("lon")).alias("idx"))


@query("feat_user_geo", "geo watch", ALL_MAPS + GEO + ' SELECT DISTINCT uid AS id, idx, 1.0::DOUBLE AS value FROM cell JOIN um USING ("user")')
def feat_user_geo(v: Views):
    """One-hot cells of users by the ids of the corpus."""
    users = relational.dense_ids(v.watch(), "user", "user_id")
    return features.geo_cells(v.geo(), users)


def text_of(c):
    return F.array_join(F.transform(c, lambda x: F.format_string("%.6f", x)), ",")


def _sql_text(expr: str) -> str:
    return f"array_to_string(list_transform({expr}, lambda x: printf('%.6f', x::DOUBLE)), ',')"


def _vector_query(name: str, fn, expr: str) -> None:
    pair = """, p AS (SELECT "user", item, uf, vf FROM (SELECT DISTINCT "user", item FROM watch) JOIN uf USING ("user") JOIN vf USING (item))"""

    @query(name, "watch train uf vf", pair + f' SELECT "user", item, {_sql_text(expr)} AS v FROM p')
    def vector_query(v: Views):
        rows = v.watch().select("user", "item").distinct().join(v.user_factors(), "user").join(v.item_factors(), "item")
        return rows.select("user", "item", text_of(fn(F.col("uf"), F.col("vf"))).alias("v"))


_vector_query("vec_concat", vectors.concat, "list_concat(uf, vf)")
_vector_query("vec_add", vectors.add, "list_transform(uf, lambda x, i: x + vf[i])")
_vector_query("vec_scale_div", lambda a, b: vectors.divide(a, F.lit(4.0)), "list_transform(uf, lambda x: x / 4)")
_vector_query("vec_dot", lambda a, b: F.array(vectors.dot(a, b)), "[list_dot_product(uf, vf)]")
_vector_query("vec_norm_l2", lambda a, b: vectors.norm_l2(a), "CASE WHEN list_dot_product(uf, uf) > 1e-26 THEN list_transform(uf, lambda x: x / sqrt(list_dot_product(uf, uf))) ELSE uf END")
_vector_query("vec_norm_max", lambda a, b: vectors.norm_max(a), "CASE WHEN list_max(uf) > 1e-13 THEN list_transform(uf, lambda x: x / list_max(uf)) ELSE uf END")
_vector_query("vec_slice", lambda a, b: vectors.take(a, [4, 0, 2]), "[uf[5], uf[1], uf[3]]")
_vector_query("vec_sparse_dense", lambda a, b: vectors.to_dense(vectors.to_sparse(a), 5), "uf")
