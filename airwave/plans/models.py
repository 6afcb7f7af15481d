"""Features, assembly, training, scoring and evaluation over the views."""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airwave.functions import vectors
from airwave.operators import aggregates, exports, features, relational, scoring, training
from airwave.plans.pipelines import assembled, hourly_programs, matrix_factorisation, recommend
from airwave.plans.registry import query
from airwave.plans.relational import TOKENS
from airwave.plans.sources import CHANNEL_BLOCK, GENRE_BLOCK, genre_block
from airwave.sources import artifacts
from airwave.sources.views import Views


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def channel_block(v: Views) -> DataFrame:
    """The pairs are found once; the vocabulary and the block come from them."""
    pairs = artifacts.cut(features.channel_pairs(artifacts.cut(v.channels(), "channels")), "channel-pairs")
    return artifacts.cut(features.Vocabulary.of(pairs).multi_hot(pairs), "channel-block")


@query("feat_item_genre", "pg", GENRE_BLOCK + " SELECT * FROM block")
def feat_item_genre(v: Views):
    return genre_block(v)


@query("feat_item_channel", "channels", CHANNEL_BLOCK + " SELECT * FROM block")
def feat_item_channel(v: Views):
    return channel_block(v)


SHOW = ", block AS (SELECT DISTINCT program AS id, CAST(CAST(start[9:12] AS INT) // 200 AS INT) AS idx, 1.0::DOUBLE AS value FROM schedule)"


@query("feat_item_showtime", "schedule", SHOW + " SELECT * FROM block")
def feat_item_showtime(v: Views):
    return features.show_time(v.schedule())


TERMS = f""", {TOKENS}, counts AS (SELECT item, term, count(*) AS n FROM toks GROUP BY ALL),
figures AS (SELECT term, sum(n)::BIGINT AS tf, count(*)::BIGINT AS df FROM counts GROUP BY 1),
best AS (SELECT term AS name, round(tf * ln((SELECT count(DISTINCT item) FROM counts) / df), 6) AS score FROM figures ORDER BY score DESC, name LIMIT 500),
vocab AS (SELECT CAST(row_number() OVER (ORDER BY score DESC, name) - 1 AS INT) AS idx, name, score FROM best)"""


@query("agg_term_freq", "texts", TERMS + " SELECT term, tf FROM figures")
def agg_term_freq(v: Views):
    return aggregates.term_figures(aggregates.term_counts(v.texts())).select("term", "tf")


@query("agg_doc_freq", "texts", TERMS + " SELECT term, df FROM figures")
def agg_doc_freq(v: Views):
    return aggregates.term_figures(aggregates.term_counts(v.texts())).select("term", "df")


@query("topn_terms", "texts", TERMS + " SELECT idx, name FROM vocab")
def topn_terms(v: Views):
    return features.top_terms(aggregates.term_counts(v.texts())).select("idx", "name")


TF_BLOCK = ", block AS (SELECT item AS id, idx, n::DOUBLE AS value FROM counts JOIN vocab ON term = name)"


def tf_block(v: Views) -> DataFrame:
    """Terms are counted once; the vocabulary and the values come from the counts."""
    counts = artifacts.cut(aggregates.term_counts(v.texts()), "term-counts")
    return features.Vocabulary(features.top_terms(counts).select("idx", "name")).counts(counts.withColumnRenamed("term", "name"))


@query("feat_item_tfidf", "texts", TERMS + " SELECT item AS id, idx, n::DOUBLE AS value FROM counts JOIN vocab ON term = name")
def feat_item_tfidf(v: Views):
    return tf_block(v)


MEAN = """, own AS (SELECT "user", item, sum(rating) AS w FROM watch WHERE item IN (SELECT id FROM block) GROUP BY ALL),
means AS (SELECT "user", idx, sum(w * value) / any_value(total) AS value FROM own JOIN (SELECT "user", sum(w) AS total FROM own GROUP BY 1) USING ("user")
  JOIN block ON id = item GROUP BY ALL) SELECT "user", idx, value FROM means"""


@query("agg_user_weighted_mean", "watch pg", GENRE_BLOCK + MEAN)
@query("feat_user_genre", "watch pg", GENRE_BLOCK + MEAN)
def agg_user_weighted_mean(v: Views):
    return aggregates.weighted_mean(v.watch(), genre_block(v))


@query("feat_user_channel", "watch channels", CHANNEL_BLOCK + MEAN)
def feat_user_channel(v: Views):
    return aggregates.weighted_mean(v.watch(), channel_block(v))


@query("feat_user_showtime", "schedule watch", SHOW + MEAN)
def feat_user_showtime(v: Views):
    return aggregates.weighted_mean(v.watch(), features.show_time(v.schedule()))


@query("feat_user_tfidf", "texts watch", TERMS + ", block AS (SELECT item AS id, idx, n::DOUBLE AS value FROM counts JOIN vocab ON term = name)" + MEAN)
def feat_user_tfidf(v: Views):
    return aggregates.weighted_mean(v.watch(), tf_block(v))


UF_MEAN = "SELECT k - 1 AS idx, round(avg(uf[k]), 6) AS value FROM uf, (SELECT unnest(range(1, 6)) AS k) GROUP BY 1"


@query("agg_mean_vector", "uf", UF_MEAN)
@query("cold_profile_average", "uf", UF_MEAN)
def agg_mean_vector(v: Views):
    return rounded(aggregates.mean_vector(v.user_factors().withColumnRenamed("uf", "profile")), "value")


L2 = ", norm AS (SELECT id, sqrt(sum(value * value)) AS n FROM block GROUP BY 1) SELECT id, idx, round(value / n, 6) AS value FROM block JOIN norm USING (id)"


@query("post_l2normalize", "pg", GENRE_BLOCK + L2)
def post_l2normalize(v: Views):
    return rounded(features.l2_normalised(genre_block(v)), "value")


@query("post_maxnormalize", "texts", TERMS + TF_BLOCK + ", norm AS (SELECT id, max(value) AS n FROM block GROUP BY 1) SELECT id, idx, round(value / n, 6) AS value FROM block JOIN norm USING (id)")
def post_maxnormalize(v: Views):
    return rounded(features.max_normalised(tf_block(v), 500), "value")


@query("post_select_positions", "pg", GENRE_BLOCK + " SELECT id, CASE WHEN idx > 2 THEN idx - 1 ELSE idx END AS idx, value FROM block WHERE idx <> 2")
def post_select_positions(v: Views):
    pairs = features.genre_pairs(v.program_genre())
    vocabulary = features.Vocabulary.of(pairs)
    return features.select_positions(vocabulary.multi_hot(pairs), vocabulary.names, [2])[0]


@query("post_chain", "pg", GENRE_BLOCK.replace("block AS (", "raw AS (") + ", block AS (SELECT id, CASE WHEN idx > 2 THEN idx - 1 ELSE idx END AS idx, value FROM raw WHERE idx <> 2)" + L2)
def post_chain(v: Views):
    """Selection and norm as an extractor that was saved and loaded."""
    pairs = features.genre_pairs(v.program_genre())
    extractor = features.Extractor.fitted(pairs, drop=(2,), normalise=True).save(artifacts.name_of("chain", v.sf_dir, uuid.uuid4().hex))
    return rounded(extractor.transform(pairs), "value")


JOINED = GENRE_BLOCK.replace("vocab", "gvocab").replace("block", "gblock") + CHANNEL_BLOCK.replace("block", "cblock") + """, ids AS (SELECT id FROM gblock INTERSECT SELECT id FROM cblock),
joined AS (SELECT id, idx, value FROM gblock SEMI JOIN ids USING (id) UNION ALL SELECT id, idx + 16, value FROM cblock SEMI JOIN ids USING (id))"""


def joined(v: Views) -> DataFrame:
    return features.joined_blocks([(genre_block(v), 16), (channel_block(v), 0)])


@query("join_feature_blocks", "pg channels", JOINED + " SELECT * FROM joined")
def join_feature_blocks(v: Views):
    return joined(v)


@query("join_rating_filter", "pg watch train channels", JOINED + ' SELECT "user", item, rating FROM watch WHERE item IN (SELECT id FROM ids)')
def join_rating_filter(v: Views):
    ids = joined(v).select(F.col("id").alias("item"))
    return v.watch().join(ids, "item", "left_semi").select("user", "item", "rating")


DESIGN = """, pairs AS (SELECT "user", item, sum(rating) AS label FROM train GROUP BY ALL),
design AS (SELECT "user", item, list_concat(uf, vf) AS x, label / 60 AS label FROM pairs JOIN uf USING ("user") JOIN vf USING (item))"""


def design(v: Views) -> DataFrame:
    """user, item, x (the user's block first), label in minutes."""
    pairs = aggregates.sum_pairs(v.train()).join(v.user_factors(), "user").join(v.item_factors(), "item")
    return pairs.select("user", "item", vectors.concat(F.col("uf"), F.col("vf")).alias("x"), (F.col("rating") / 60).alias("label"))


def as_text(df: DataFrame, column: str = "x") -> DataFrame:
    return df.withColumn(column, F.array_join(F.transform(column, lambda x: F.format_string("%.6f", x)), ","))


X_TEXT = "array_to_string(list_transform(x, lambda e: printf('%.6f', e::DOUBLE)), ',') AS x"


@query("join_assemble_design", "uf vf", DESIGN + f' SELECT "user", item, {X_TEXT}, label FROM design')
def join_assemble_design(v: Views):
    return as_text(design(v))


ASSEMBLED = (
    GENRE_BLOCK.replace("vocab", "gvocab").replace("block", "gblock")
    + CHANNEL_BLOCK.replace("block", "cblock")
    + """, total AS (SELECT count(DISTINCT item) AS n FROM train),
covered AS (SELECT (SELECT count(DISTINCT id) FROM cblock WHERE id IN (SELECT item FROM train)) > 0.5 * n AS channel, (SELECT count(DISTINCT id) FROM gblock WHERE id IN (SELECT item FROM train)) > 0.5 * n AS genre FROM total),
ids AS (SELECT DISTINCT item AS id FROM train, covered WHERE (NOT genre OR item IN (SELECT id FROM gblock)) AND (NOT channel OR item IN (SELECT id FROM cblock))),
side AS (SELECT id, idx + 1 AS idx, value FROM gblock, covered WHERE genre UNION ALL
  SELECT id, idx + 1 + CASE WHEN genre THEN 16 ELSE 0 END, value FROM cblock, covered WHERE channel),
pairs AS (SELECT "user", item, sum(rating) AS label FROM train WHERE item IN (SELECT id FROM ids) AND "user" IN (SELECT c_custkey FROM customer) GROUP BY ALL)
SELECT "user", item, 0 AS idx, c_acctbal AS value, label FROM pairs JOIN customer ON c_custkey = "user"
UNION ALL SELECT "user", item, CAST(idx AS INT), value, label FROM pairs JOIN side ON id = item"""
)


@query("assemble_continuous", "pg channels watch train", ASSEMBLED)
def assemble_continuous(v: Views):
    """A user's balance beside genres and channels of the item; blocks that cover half of the items or fewer go."""
    balance = v.table("customer").select(F.col("c_custkey").alias("id"), F.lit(0).alias("idx"), F.col("c_acctbal").alias("value"))
    channels = features.channel_pairs(v.channels())
    vocabulary = features.Vocabulary.of(channels)
    blocks = {"genre": (genre_block(v), 16), "channel": (vocabulary.multi_hot(channels), vocabulary.names.count())}
    return assembled(v.train(), {"balance": (balance, 1)}, blocks, 0.5)[0]


@query("to_labeled_points", "uf vf", DESIGN + f" SELECT label, {X_TEXT} FROM design")
def to_labeled_points(v: Views):
    points = design(v).select("label", array_to_vector("x").alias("features"))
    return as_text(points.select("label", vector_to_array("features").alias("x")))


@query("split_by_user_bucket", "watch", """SELECT "user", item, CASE WHEN "user" % 10 / 10 < 0.6 THEN 'tr' WHEN "user" % 10 / 10 < 0.9 THEN 'te' ELSE 'va' END AS split FROM watch""")
def split_by_user_bucket(v: Views):
    return v.watch().select("user", "item", exports.split_of(F.col("user"), 0.6, 0.3).alias("split"))


@query("sample_users", "watch", """SELECT 'share' AS how, "user" FROM (SELECT DISTINCT "user" FROM watch) WHERE ("user" * 7919) % 1000 < 200
UNION ALL (SELECT 'target', "user" FROM (SELECT DISTINCT "user" FROM watch) ORDER BY ("user" * 7919) % 1000, "user" LIMIT 25)""")
def sample_users(v: Views):
    users = v.watch().select("user").distinct()
    share, target = (exports.sample_users(users, n).withColumn("how", F.lit(how)) for n, how in ((0.2, "share"), (25, "target")))
    return share.unionByName(target)


# Scoring with deterministic stand-ins for trained factors.

ALL = """, scores AS (SELECT "user", item, list_dot_product(uf, vf) AS score FROM uf, vf)"""


PER_USER = ' SELECT "user", count(*)::BIGINT AS n, round(sum(score), 4) AS total, round(max(score), 6) AS best FROM scores GROUP BY 1'


def per_user(users: DataFrame, items: DataFrame, score: Column, block: int = scoring.BLOCK_ROWS) -> DataFrame:
    """Figures of each user's scores with all items, added up from the blocks'."""
    parts = lambda pairs: pairs.groupBy("user").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("score")).alias("total"), F.max("score").alias("best"))
    blocks = scoring.profile_pairs(users, items, score, parts, block)
    return blocks.groupBy("user").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 4).alias("total"), F.round(F.max("best"), 6).alias("best"))


for _name in ("join_cross_user_item", "predict_all_pairs", "mf_predict_all_pairs"):

    @query(_name, "uf vf", ALL + PER_USER)
    def predict_all_pairs(v: Views):
        return per_user(v.user_factors(), v.item_factors(), vectors.dot_of(F.col("uf"), F.col("vf"), 5))


@query("join_block_broadcast_nl", "uf vf", ALL + PER_USER)
def join_block_broadcast_nl(v: Views):
    """Item profiles in at least four blocks; each user's figures are added up from the blocks'."""
    items = v.item_factors()
    return per_user(v.user_factors(), items, vectors.dot_of(F.col("uf"), F.col("vf"), 5), max(1, min(scoring.BLOCK_ROWS, items.select("vf").distinct().count() // 4)))


#: A model as it may have been saved: ten features, no latent factors.
LINEAR = training.Weights(0.0, np.array([[1.0, -1.0, 0.5, 2.0, 0.0, 1.0, 1.0, -2.0, 0.25, 3.0]]).T)


@query("predict_pointwise", "uf vf", DESIGN + ' SELECT "user", item, label, round(list_dot_product(x, [1, -1, 0.5, 2, 0, 1, 1, -2, 0.25, 3]), 6) AS prediction FROM design')
def predict_pointwise(v: Views):
    loaded = training.Weights.of(artifacts.cut(LINEAR.table(v.spark), "model"))
    return rounded(training.predicted(design(v), loaded).select("user", "item", "label", "prediction"), "prediction")


@query("predict_partial", "uf vf", """, a AS (SELECT "user", list_dot_product(uf, [1, 2, 3, 4, 5]) AS lin, list_dot_product(uf, [1, 0, 1, 0, 1]) AS lat FROM uf),
b AS (SELECT item, list_dot_product(vf, [5, 4, 3, 2, 1]) AS lin, list_dot_product(vf, [0, 1, 0, 1, 0]) AS lat FROM vf),
scores AS (SELECT "user", item, a.lin + b.lin + (a.lat + b.lat) * (a.lat + b.lat) AS score FROM a, b)""" + PER_USER)  # fmt: skip
def predict_partial(v: Views):
    long = lambda df, i, x: df.select(F.col(i).alias("id"), F.posexplode(x).alias("idx", "value"))
    weights = lambda ws, vs: v.spark.createDataFrame([(i, float(w), float(x)) for i, (w, x) in enumerate(zip(ws, vs, strict=True))], "idx int, w double, v0 double")
    a = scoring.partial_model(long(v.user_factors(), "user", "uf"), weights((1, 2, 3, 4, 5), (1, 0, 1, 0, 1)), 1)
    b = scoring.partial_model(long(v.item_factors(), "item", "vf"), weights((5, 4, 3, 2, 1), (0, 1, 0, 1, 0)), 1)
    a, b = a.select(F.col("id").alias("user"), F.col("linear").alias("a"), F.col("latent").alias("la")), b.select(F.col("id").alias("item"), F.col("linear").alias("b"), F.col("latent").alias("lb"))
    return per_user(a, b, scoring.combined(F.col("a"), F.col("b"), F.col("la"), F.col("lb")))


@query("mf_predict_one", "uf vf", ALL + ' SELECT "user", item, round(score, 6) AS score FROM scores WHERE "user" = (SELECT min("user") FROM uf) AND item = (SELECT max(item) FROM vf)')
def mf_predict_one(v: Views):
    users, items = v.user_factors(), v.item_factors()
    one = users.join(F.broadcast(users.agg(F.min("user").alias("user"))), "user")
    other = items.join(F.broadcast(items.agg(F.max("item").alias("item"))), "item")
    return rounded(scoring.all_pairs(one, other, vectors.dot(F.col("uf"), F.col("vf"))), "score")


COLD = """, cold AS (SELECT [avg(vf[1]), avg(vf[2]), avg(vf[3]), avg(vf[4]), avg(vf[5])] AS c FROM vf),
full_items AS (SELECT item, coalesce(vf, c) AS vf FROM (SELECT DISTINCT item FROM test) LEFT JOIN vf USING (item), cold)"""


def completed_items(v: Views) -> DataFrame:
    factors = v.item_factors()
    return scoring.completed(v.test(), factors, "item", "vf", scoring.mean_profile(factors, "vf", 5))


@query("mf_predict_user_items", "uf vf test", COLD + ' SELECT item, round(list_dot_product(uf, full_items.vf), 6) AS score FROM full_items, (SELECT uf FROM uf WHERE "user" = (SELECT min("user") FROM uf))')
def mf_predict_user_items(v: Views):
    users = v.user_factors()
    one = users.join(F.broadcast(users.agg(F.min("user").alias("user"))), "user")
    return rounded(scoring.few_users(one, completed_items(v), vectors.dot(F.col("uf"), F.col("vf"))).drop("user"), "score")


@query("mf_predict_pairs_meta", "uf vf test", COLD + ' SELECT "user", item, rating, round(list_dot_product(uf, full_items.vf), 6) AS score FROM test JOIN uf USING ("user") JOIN full_items USING (item)')
def mf_predict_pairs_meta(v: Views):
    pairs = v.test().select("user", "item", "rating")
    return rounded(scoring.pair_scores(pairs, v.user_factors(), completed_items(v)), "score")


@query("feat_fact_lookup", "uf", 'SELECT "user", round(uf[1], 6) AS f0, round(uf[5], 6) AS f4 FROM uf WHERE "user" IN (SELECT c_custkey FROM customer WHERE c_mktsegment = \'BUILDING\')')
def feat_fact_lookup(v: Views):
    wanted = v.table("customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("user"))
    rows = v.user_factors().join(wanted, "user", "left_semi")
    return rows.select("user", F.round(F.get("uf", F.lit(0)), 6).alias("f0"), F.round(F.get("uf", F.lit(4)), 6).alias("f4"))


COLD_ITEM = """, own AS (SELECT id, idx, value FROM block WHERE id IN (SELECT item FROM test EXCEPT SELECT item FROM train)),
regressed AS (SELECT id, k AS idx, sum(value * ((idx * (k + 3)) % 7) / 7) AS value FROM own, (SELECT unnest(range(0, 5)) AS k) GROUP BY ALL)
SELECT id, idx, value FROM own UNION ALL SELECT id, CAST(idx + 16 AS INT), round(value, 6) FROM regressed"""


@query("feat_cold_item", "pg watch train test", GENRE_BLOCK + COLD_ITEM)
def feat_cold_item(v: Views):
    """Cold items by an extractor that was fitted on known content, saved and loaded; stand-ins for trained coefficients."""
    cold = v.test().select("item").distinct().join(v.train(), "item", "left_anti")
    pairs = features.genre_pairs(v.program_genre())
    coefficients = v.spark.range(16 * 5).select((F.col("id") % 16).cast("int").alias("idx"), F.floor(F.col("id") / 16).cast("int").alias("k"))
    coefficients = coefficients.withColumn("w", (F.col("idx") * (F.col("k") + 3)) % 7 / 7)
    extractor = features.Extractor.fitted(pairs, coefficients=coefficients).save(artifacts.name_of("cold-item", v.sf_dir, uuid.uuid4().hex))
    return rounded(extractor.transform(pairs.join(cold, "item", "left_semi")), "value")


# Ranking and evaluation.

N = 10
SEEN = f"""{ALL}, seen AS (SELECT DISTINCT "user", item FROM train),
tops AS (SELECT 'all' AS kind, "user", item, row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS rank FROM sc QUALIFY rank <= {N}
  UNION ALL SELECT 'new', "user", item, row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS rank FROM sc ANTI JOIN seen USING ("user", item) QUALIFY rank <= {N}),
truth AS (SELECT "user", item, sum(rating) AS score FROM test WHERE item IN (SELECT item FROM train) AND "user" IN (SELECT "user" FROM train) GROUP BY ALL),
actual AS (SELECT 'all' AS kind, "user", item, row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS rank FROM truth QUALIFY rank <= {N}
  UNION ALL SELECT 'new', "user", item, row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS rank FROM truth ANTI JOIN seen USING ("user", item) QUALIFY rank <= {N}),
hits AS (SELECT "user", kind, count(a.rank)::BIGINT AS hits, any_value(n) AS n_actual FROM tops t LEFT JOIN actual a USING ("user", kind, item)
  JOIN (SELECT "user", kind, count(*)::BIGINT AS n FROM actual GROUP BY ALL) USING ("user", kind) GROUP BY ALL)""".replace("AS score FROM uf, vf)", "AS score FROM uf, vf), sc AS (SELECT * FROM scores)")


def predicted(v: Views, users: DataFrame) -> DataFrame:
    """The best N of all and of unseen items by the stand-in factors."""
    return scoring.best_items(scoring.with_seen(users, v.train()), v.item_factors(), scoring.dot_scores(), N)


def hits(v: Views, users: DataFrame | None = None) -> DataFrame:
    truth = relational.known_only(v.test(), v.train(), v.train())
    if users is not None:
        truth = truth.join(users, "user", "left_semi")
    truth = relational.mark_seen(truth.groupBy("user", "item").agg(F.sum("rating").alias("score")), v.train())
    return scoring.hit_sets(predicted(v, v.user_factors() if users is None else users), relational.top_all_and_new(truth, N))


SEEN = SEEN.replace("sc AS (SELECT * FROM scores)", 'sc AS (SELECT "user", item, round(score, 9) AS score FROM scores)')


@query("topn_all_and_new", "uf vf test", SEEN + ' SELECT kind, "user", item, CAST(rank AS INT) AS rank FROM tops')
def topn_all_and_new(v: Views):
    return predicted(v, v.user_factors()).select("kind", "user", "item", "rank")


RATES = f""" SELECT round(avg(CASE WHEN kind = 'all' THEN hits / {N} END), 6) AS "precision", round(avg(CASE WHEN kind = 'all' THEN hits / n_actual END), 6) AS recall,
round(avg(CASE WHEN kind = 'all' THEN hits END), 6) AS mean_hits, round(avg(CASE WHEN kind = 'new' THEN hits / n_actual END), 6) AS new_hit_rate FROM hits"""


RATE_NAMES = ("precision", "recall", "mean_hits", "new_hit_rate")


@query("metric_hit_rate", "uf vf test", SEEN + RATES)
def metric_hit_rate(v: Views):
    return rounded(scoring.hit_rates(hits(v), N), *RATE_NAMES)


#: The evaluations take a fifth of the users, the same on every run.
SAMPLED = ' WHERE ("user" * 7919) % 1000 < 200'
SAMPLED_SEEN = SEEN.replace("AS score FROM scores)", f"AS score FROM scores{SAMPLED})").replace("GROUP BY ALL),\nactual", f"AND {SAMPLED[7:]} GROUP BY ALL),\nactual")


@query("eval_not_cold_hits", "uf vf test", SAMPLED_SEEN + RATES)
def eval_not_cold_hits(v: Views):
    return rounded(scoring.hit_rates(hits(v, exports.sample_users(v.user_factors(), 0.2)), N), *RATE_NAMES)


COLD_TOP = f"""{COLD}, cold_items AS (SELECT item FROM test EXCEPT SELECT item FROM train),
cs AS (SELECT "user", item, ("user" * 31 + item * 17) % 1009 AS score FROM (SELECT "user" FROM train INTERSECT SELECT "user" FROM test), cold_items),
best AS (SELECT "user", item, row_number() OVER (PARTITION BY "user" ORDER BY score DESC, item) AS rank FROM cs QUALIFY rank <= {N}),
chits AS (SELECT best."user", count(t.item)::BIGINT AS hits, count(*)::BIGINT AS n_predicted FROM best
  LEFT JOIN (SELECT DISTINCT "user", item FROM test) t ON best."user" = t."user" AND best.item = t.item GROUP BY ALL)"""


def cold_hits(v: Views, share: float | None = None) -> DataFrame:
    users = v.train().select("user").intersect(v.test().select("user"))
    if share is not None:
        users = exports.sample_users(users, share)
    cold = v.test().select("item").distinct().join(v.train(), "item", "left_anti")
    best = scoring.best_items(users, cold, lambda u, i: (u["user"] * 31 + i["item"] * 17) % 1009, N)
    found = best.join(v.test().select("user", "item").distinct().withColumn("hit", F.lit(1)), ["user", "item"], "left")
    return found.groupBy("user").agg(F.count("hit").alias("hits"), F.count("*").alias("n_predicted"))


@query("topn_cold_hits", "vf test", COLD_TOP + ' SELECT "user", hits, n_predicted FROM chits')
def topn_cold_hits(v: Views):
    return cold_hits(v)


COLD_RECALL = " SELECT round(avg(hits / n_predicted), 6) AS cold_recall FROM chits"
SAMPLED_COLD = COLD_TOP.replace("AS score FROM (SELECT", f"AS score FROM (SELECT * FROM (SELECT").replace('FROM test), cold_items)', f'FROM test){SAMPLED}), cold_items)')


@query("metric_cold_recall", "vf test", COLD_TOP + COLD_RECALL)
def metric_cold_recall(v: Views):
    return rounded(scoring.cold_recall(cold_hits(v)), "cold_recall")


@query("eval_cold_items", "vf test", SAMPLED_COLD + COLD_RECALL)
def eval_cold_items(v: Views):
    return rounded(scoring.cold_recall(cold_hits(v, 0.2)), "cold_recall")


ERROR = """, rows AS (SELECT rating / 60 AS label, 10 * list_dot_product(uf, vf) AS prediction FROM test JOIN uf USING ("user") JOIN vf USING (item))
SELECT round(avg(pow(label - prediction, 2)), 4) AS mse, round(sqrt(avg(pow(label - prediction, 2))), 4) AS rmse FROM rows"""

def warm_error(v: Views) -> DataFrame:
    rows = scoring.pair_scores(v.test(), v.user_factors(), v.item_factors())
    rows = rows.select((F.col("rating") / 60).alias("label"), (10 * F.col("score")).alias("prediction"))
    return rounded(scoring.squared_error(rows), "mse", "rmse", digits=4)


for _name in ("metric_mse", "metric_rmse", "eval_not_cold_error"):
    query(_name, "uf vf test", ERROR)(warm_error)


EVAL_MF = (
    SAMPLED_SEEN
    + SAMPLED_COLD.replace(COLD, COLD)
    + ERROR.replace("\nSELECT", ", err AS (SELECT").rstrip()
    + "),\nrates AS ("
    + RATES.strip()
    + ") SELECT 'rmse' AS test, rmse AS value FROM err UNION ALL SELECT 'precision', \"precision\" FROM rates UNION ALL SELECT 'recall', recall FROM rates"
    + " UNION ALL SELECT 'cold_recall', round(avg(hits / n_predicted), 6) FROM chits"
)


@query("eval_mf", "uf vf test", EVAL_MF)
def eval_mf(v: Views):
    """Rating error, ranking of known items and ranking of cold items in one table; the rankings for sampled users."""
    row = lambda df, column, test: df.select(F.lit(test).alias("test"), F.col(column).alias("value"))
    rates = eval_not_cold_hits(v)
    parts = [row(warm_error(v), "rmse", "rmse"), row(rates, "precision", "precision"), row(rates, "recall", "recall"), row(eval_cold_items(v), "cold_recall", "cold_recall")]
    return reduce(DataFrame.unionByName, parts)


@query("pipeline_recommend")
def pipeline_recommend(v: Views):
    """The whole job; the summary is the result, the programs of the predicted hours are written and counted in it."""
    ratings = v.train()
    return recommend(ratings, v.test(), v.program_genre(), v.channels(), v.schedule(), ["20240105"])


@query("pipeline_matrix_fact")
def pipeline_matrix_fact(v: Views):
    block = artifacts.cut(genre_block(v), "genre-block")
    return matrix_factorisation(v.train(), v.test(), (block, 16))


PREDICTED = """, su AS (SELECT DISTINCT "user" FROM sched), days AS (SELECT * FROM schedule WHERE start[1:8] IN ('20240105', '20240106')),
us AS (SELECT "user", [("user" * 3 % 17) / 17, ("user" * 4 % 17) / 17, ("user" * 5 % 17) / 17, ("user" * 6 % 17) / 17, ("user" * 7 % 17) / 17] AS uf FROM su),
ps AS (SELECT program, [(program * 5 % 19) / 19, (program * 6 % 19) / 19, (program * 7 % 19) / 19, (program * 8 % 19) / 19, (program * 9 % 19) / 19] AS vf FROM (SELECT DISTINCT program FROM days)),
slots AS (SELECT program, start[1:8] AS date, start[9:10] AS hour, min(start) AS start FROM days GROUP BY ALL),
best AS (SELECT "user", date, hour, program, row_number() OVER (PARTITION BY "user", date, hour ORDER BY round(list_dot_product(uf, vf), 9) DESC, program) AS rank
  FROM slots JOIN ps USING (program), us QUALIFY rank <= 5)
SELECT date, hour, "user", string_agg(program, chr(9) ORDER BY rank) AS programs FROM best GROUP BY ALL"""


@query("pipeline_predict", "sched schedule", PREDICTED)
def pipeline_predict(v: Views):
    """Programs of two days from stand-in factors, written by hour; pipelines.predict trains the factors first."""
    factor = lambda c, by, n: F.array(*((F.col(c) * (k + by) % n) / n for k in range(5)))
    users = v.sched().select("user").distinct().withColumn("uf", factor("user", 3, 17))
    programs = v.sched().select("item").distinct().withColumn("vf", factor("item", 5, 19))
    return hourly_programs(users, programs, v.schedule(), ["20240105", "20240106"], 5, scoring.dot_scores())[1]
