"""Golden cases and properties of the library's operators."""

import math
import os
import uuid

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from airwave.functions import scalars, vectors
from airwave.operators import aggregates, exports, features, relational, scoring, training
from airwave.plans import models, pipelines
from airwave.sources import artifacts, files
from airwave.sources.views import Views
from tests.conftest import SF


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_schedule_filter(spark, tmp_path):
    programs = ["AA", "XX", "BB", "AA", "FF", "YY", "AA", "ZZ", "CC", "WW"]
    path = tmp_path / "schedule.txt"
    path.write_text("\n".join(f"US|{i}|2014052104{i:02d}|2014052105{i:02d}|{p}|N|1800|" + "|" * 12 for i, p in enumerate(programs)))
    wanted = spark.createDataFrame([(p,) for p in ("AA", "BB", "CC", "DD", "FF")], "program string")
    got = files.schedule(spark, str(path)).join(wanted, "program", "left_semi").orderBy("start").collect()
    assert [r.program for r in got] == ["AA", "BB", "AA", "FF", "AA", "CC"]


def test_densified_rows(spark):
    lines = spark.createDataFrame([(3, "33 33 5"), (1, "9 11 11 5"), (5, "x")], "id int, line string")
    assert [tuple(r) for r in exports.densified(lines).orderBy("id").collect()] == [(1, "9 11 11 5"), (2, " "), (3, "33 33 5"), (4, " "), (5, "x")]


def test_active_rows(spark):
    rows = [(8, i, float(r)) for i, r in ((1, 88), (88, 5), (99, 11), (88, 77), (100, 22))] + [(3, 33, 5.0)]
    got = exports.active_rows(spark.createDataFrame(rows, "user int, item int, rating double")).collect()
    assert [(r.user, r.line) for r in got] == [(8, "1 88 88 5 88 77 99 11 100 22")]


def test_weighted_mean_of_vectors(spark):
    block = spark.createDataFrame([(1, 0, 2.0), (1, 3, 4.0), (2, 2, 1.0), (2, 4, 7.0), (3, 2, 1.0), (3, 3, 3.0)], "id int, idx int, value double")
    watch = spark.createDataFrame([(7, 1, 0.3), (7, 2, 0.6), (7, 3, 0.2), (7, 99, 5.0)], "user int, item int, rating double")
    got = {r.idx: r.value for r in aggregates.weighted_mean(watch, block).collect()}
    assert got == pytest.approx({0: 0.6 / 1.1, 2: 0.8 / 1.1, 3: 1.8 / 1.1, 4: 4.2 / 1.1})


def test_artifact_key(spark):
    assert one(spark, artifacts.key_of(F.array(F.lit("123456")))) [0] == "e10adc3949ba59abbe56e057f20f883e"


def test_date_range_in_either_order(spark):
    for a, b in (("20140522", "20140524"), ("20140524", "20140522")):
        low, high = scalars.date_range(a, b)
        assert [str(x) for x in one(spark, low, high)] == ["2014-05-22", "2014-05-24"]


def test_edges_of_scalars(spark):
    cell = lambda lat, lon: scalars.geo_cell(F.lit(lat), F.lit(lon)).cast("int")
    assert list(one(spark, cell(20.0, -70.0), cell(30.0, -60.0), cell(60.0, -70.0), cell(49.9, -124.9), cell(24.0, -66.0))) == [0, 0, 59, 59, 0]
    assert one(spark, scalars.time_bucket(F.lit(2359), 12), scalars.time_bucket(F.lit(2399), 7))[:] == (11, 7)
    assert one(spark, scalars.tokens(F.lit("The QUICK brown_fox, of 42 and 123!"))) [0] == ["quick", "brown_fox", "123"]


def test_vector_functions(spark):
    a, b = F.array(*map(F.lit, (3.0, 4.0))), F.array(*map(F.lit, (-1.0, -2.0)))
    got = one(spark, vectors.norm_l2(a), vectors.norm_max(b), vectors.divide(a, F.lit(0.0)), vectors.dot(a, F.array(F.lit(1.0))), vectors.norm_l2(F.array(F.lit(0.0))))
    assert list(got) == [[0.6, 0.8], [1.0, 2.0], None, None, [0.0]]


def test_readers_of_odd_lines(spark, tmp_path):
    (tmp_path / "g").write_text("a|1|en|Some genre|\nb|2|de|x|\na|1|en|Some genre|\n")
    assert [tuple(r) for r in files.genres(spark, str(tmp_path / "g"), clean=True).collect()] == [("1", "en", "Some-genre")]
    (tmp_path / "p").write_text("a|i1|g1| 2 |\na|i2|g2||\n")
    assert [r.rank for r in files.program_genres(spark, str(tmp_path / "p")).collect()] == [2, None]
    (tmp_path / "w").write_text("u\ti\t2014-05-21T 09:30:00\tx\t17\n")
    assert files.scheduled_watch(spark, str(tmp_path / "w")).first().hour == 9
    assert files.watch_log(spark, str(tmp_path), []) is None


def test_write_if_absent(spark):
    name = f"test-{uuid.uuid4().hex}"
    first, second = spark.range(3), spark.range(5)
    assert artifacts.save(first, name).count() == 3
    assert artifacts.save(second, name).count() == 3
    assert artifacts.save(second, name, overwrite=True).count() == 5


def test_dense_ids_are_a_bijection_in_order(spark):
    df = spark.range(0, 5000, 7, 13).selectExpr("id * 31 % 4999 AS k").union(spark.range(50).selectExpr("id AS k")).union(spark.createDataFrame([(None,)], "k long"))
    rows = sorted((r.k, r.i) for r in relational.dense_ids(df, "k", "i").collect())
    assert [i for _, i in rows] == list(range(len(rows))) and len({k for k, _ in rows}) == len(rows)


def test_splits_are_disjoint_and_honour_ratios(spark):
    got = spark.range(1000).select(exports.split_of(F.col("id"), 0.5, 0.3).alias("s")).groupBy("s").count().collect()
    assert {r.s: r["count"] for r in got} == {"tr": 500, "te": 300, "va": 200}


def test_normalised_totals(spark):
    rows = spark.createDataFrame([(u, i, float(1 + u * i)) for u in range(5) for i in range(6)] + [(9, 1, 0.0)], "user int, item int, rating double")
    sums = {r.user: r.s for r in aggregates.normalised(rows, "total").groupBy("user").agg(F.sum("rating").alias("s")).collect()}
    assert all(sums[u] == pytest.approx(1) for u in range(5)) and sums[9] is None
    assert aggregates.normalised(rows, "max").agg(F.max("rating")).first()[0] == 1


def test_active_users_need_every_month(spark):
    day = lambda m, d: f"2014-{m:02d}-{d:02d}"
    rows = [(1, day(5, 1)), (1, day(5, 9)), (1, day(6, 2)), (1, day(6, 20)), (2, day(5, 1)), (2, day(5, 9)), (3, day(5, 1)), (3, day(6, 2)), (3, day(6, 9))]
    watch = spark.createDataFrame(rows, "user int, d string").select("user", F.to_date("d").alias("date"))
    assert [r.user for r in aggregates.active_users(watch).collect()] == [1]


def test_top_n_is_a_prefix_and_extra_adds_one(spark):
    scores = spark.createDataFrame([(u, i, float(i * u % 5)) for u in (1, 2) for i in range(9)], "user int, item int, score double")
    seen = spark.createDataFrame([(1, 4), (1, 3)], "user int, item int")
    marked = relational.mark_seen(scores, seen)
    got = relational.top_all_and_new(marked, 3).orderBy("rank").collect()
    assert {r.user for r in got} == {1}  # no seen set, no rows
    assert [r.item for r in got if r.kind == "all"] == [4, 3, 8] and [r.item for r in got if r.kind == "new"] == [8, 2, 7]
    assert relational.top_all_and_new(marked, 3, extra=1).count() == 8


def test_rankings_are_those_of_all_pairs(spark, monkeypatch):
    """The best of all and of unseen items, with ties, in blocks of items and slices of users."""
    users = spark.range(40).select(F.col("id").alias("user"), F.array((F.col("id") % 7).cast("double"), F.lit(0.5)).alias("uf"))
    items = spark.range(60).select(F.col("id").alias("item"), F.array((F.col("id") * 5 % 11).cast("double"), F.lit(1.0)).alias("vf"))
    seen = spark.range(200).select((F.col("id") % 30).alias("user"), (F.col("id") * 17 % 60).alias("item"))
    known = {(r.user, r.item) for r in seen.collect()}
    rows = {u: sorted((-(u % 7 * (i * 5 % 11) + 0.5), i) for i in range(60)) for u in range(30)}
    want = [(u, "all", k + 1, i) for u, own in rows.items() for k, (_, i) in enumerate(own[:4])]
    want += [(u, "new", k + 1, i) for u, own in rows.items() for k, (_, i) in enumerate([x for x in own if (u, x[1]) not in known][:4])]
    for block, cells in ((7, 1 << 21), (1000, 100), (1000, 1 << 21)):
        monkeypatch.setattr(scoring, "CELLS", cells)
        got = scoring.best_items(scoring.with_seen(users, seen), items, scoring.dot_scores(), 4, block).collect()
        assert sorted((r.user, r.kind, r["rank"], r.item) for r in got) == sorted(want)
    assert scoring.best_items(users, items.limit(0), scoring.dot_scores(), 4).count() == 0
    assert scoring.best_items(users.limit(0), items, scoring.dot_scores(), 4).count() == 0


def test_best_in_slots_makes_no_pairs(spark, monkeypatch):
    users = spark.range(40).select(F.col("id").alias("user"), F.array(F.col("id") % 7 + 0.0, F.lit(1.0)).alias("uf"))
    items = spark.range(60).select(F.col("id").alias("item"), F.array(F.col("id") * 5 % 11 + 0.0, F.col("id") % 3 + 0.0).alias("vf"))
    offers = spark.createDataFrame([(f"s{s}", i) for s in range(5) for i in range(s, 60 + s, s + 1)] + [("s1", None), ("s0", 3), ("empty", 999)], "slot string, item long")
    given = {}
    for r in offers.collect():
        given.setdefault(r.slot, set()).add(r.item)
    score = lambda u, i: u % 7 * (i * 5 % 11) + i % 3
    want = []
    for u in range(40):
        for s, own in given.items():
            ranked = sorted((-score(u, i), i) for i in own if i is not None and i < 60)[:4]
            want += [(u, s, k + 1, i, float(-x)) for k, (x, i) in enumerate(ranked)]
    for block, cells in ((7, 1 << 21), (1000, 100), (1000, 1 << 21)):
        monkeypatch.setattr(scoring, "CELLS", cells)
        made = scoring.best_in_slots(users, items, offers, scoring.dot_scores(), 4, block)
        assert sorted((r.user, r.slot, r["rank"], r.item, r.score) for r in made.collect()) == sorted(want)
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan and ("Window" in plan) == (block == 7)
    assert scoring.best_in_slots(users, items, offers.limit(0), scoring.dot_scores(), 4).count() == 0


def test_null_items_are_no_candidates(spark):
    users = spark.range(3).select(F.col("id").alias("user"), F.array(F.lit(1.0)).alias("uf"))
    items = spark.createDataFrame([(1, [1.0]), (None, [9.0]), (2, [2.0])], "item long, vf array<double>")
    assert {r.item for r in scoring.best_items(users, items, scoring.dot_scores(), 5).collect()} == {1, 2}


def test_pairs_are_broadcast_joins_of_blocks(spark):
    users, items = spark.range(40).withColumnRenamed("id", "user"), spark.range(60).withColumnRenamed("id", "item")
    parts = lambda pairs: pairs.groupBy("user").agg(F.sum("score").alias("s"))
    made = scoring.all_pairs(users, items, F.col("user") * F.col("item"), parts, 7).groupBy("user").agg(F.sum("s").alias("s"))
    assert {r.user: r.s for r in made.collect()} == {u: u * sum(range(60)) for u in range(40)}
    plan = made._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("BroadcastNestedLoopJoin") == 9 and "CartesianProduct" not in plan


def test_few_users_are_broadcast_and_items_stay(spark, monkeypatch):
    """More items than a block with fewer users: one join, whichever way the users are known to be few."""
    users = spark.createDataFrame([(1, [5, 9]), (2, [60])], "user long, seen_items array<long>")
    items = spark.range(60).withColumnRenamed("id", "item")
    joins = lambda df: df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("BroadcastNestedLoopJoin")
    made = scoring.all_pairs(users, items, F.col("user") * F.col("item"), block=7)
    assert sorted((r.user, r.item, r.score, r.seen) for r in made.collect()) == [(u, i, u * i, u == 1 and i in (5, 9)) for u in (1, 2) for i in range(60)]
    assert joins(made) == 1
    monkeypatch.setattr(scoring.all_pairs, "__defaults__", (scoring.all_pairs.__defaults__[0], 7))
    assert joins(models.mf_predict_user_items(Views(spark, SF))) == 2  # the user's, and that of the mean profile


def test_missing_days_drop_out(spark, tmp_path):
    for day in ("20140521", "20140523", "20140524"):
        (tmp_path / f"w-{day}").write_text(f"u\ti\t{day}\n")
    prefix = f"{tmp_path}/w-"
    days = [f"201405{d}" for d in range(20, 26)]
    assert files.valid_dates(spark, prefix, days) == ["20140521", "20140523", "20140524"]
    assert files.valid_dates(spark, prefix, days, work_days=True) == ["20140521"]  # the 23rd is a Friday
    assert files.watch_log(spark, prefix, days).count() == 3 and files.watch_log(spark, prefix, ["20140520"]) is None
    assert files.by_month(["20140602", "20140523", "20140521"]) == {"201405": ["20140521", "20140523"], "201406": ["20140602"]}


def test_target_count_of_sampled_users(spark):
    users = spark.range(500).select(F.col("id").alias("user"))
    few = {r.user for r in exports.sample_users(users, 30).collect()}
    assert len(few) == 30 and few == {r.user for r in exports.sample_users(users.repartition(7), 30).collect()}
    assert len(few & {r.user for r in exports.sample_users(users, 0.2).collect()}) == 30


def test_a_run_deletes_what_it_has_cut(spark):
    with artifacts.temporary(spark) as folder:
        assert artifacts.cut(spark.range(5), "x").count() == 5 and len(os.listdir(folder)) == 1
    assert not os.path.exists(folder) and os.path.exists(os.path.dirname(folder))


def test_metrics_on_built_hits(spark):
    rows = [(1, "all", 2, 10, 4), (2, "all", 0, 10, 2), (1, "new", 1, 10, 2)]
    hits = spark.createDataFrame(rows, "user int, kind string, hits long, n_predicted long, n_actual long")
    got = scoring.hit_rates(hits, 10).first()
    assert (got.precision, got.recall, got.mean_hits, got.new_hit_rate) == pytest.approx((0.1, 0.25, 1.0, 0.5))
    assert scoring.hit_rates(hits.where("kind = 'all'"), 10).first().new_hit_rate is None
    empty = spark.createDataFrame([], "label double, prediction double")
    assert tuple(scoring.squared_error(empty).first()) == (-1, -1)
    assert scoring.cold_recall(hits.where("hits > 9")).first()[0] == -1


def test_post_processors(spark):
    block = spark.createDataFrame([(1, 0, 3.0), (1, 2, 1.0), (1, 3, 4.0)], "id int, idx int, value double")
    names = spark.createDataFrame([(i, f"n{i}") for i in range(4)], "idx int, name string")
    kept, renamed = features.select_positions(block, names, [2])
    assert sorted(tuple(r) for r in kept.collect()) == [(1, 0, 3.0), (1, 2, 4.0)]
    assert sorted(tuple(r) for r in renamed.collect()) == [(0, "n0"), (1, "n1"), (2, "n3")]
    norm = features.l2_normalised(kept).agg(F.sum(F.col("value") * F.col("value"))).first()[0]
    assert norm == pytest.approx(1)
    assert features.vectors(block, 4).first().features.toArray().tolist() == [3.0, 0.0, 1.0, 4.0]


def test_partial_model_equals_the_joined_one(spark):
    rnd = np.random.default_rng(1)
    w = training.Weights(0.0, rnd.normal(size=(6, 3)))
    u, i = rnd.normal(size=(4, 3)), rnd.normal(size=(5, 3))
    long = lambda m: spark.createDataFrame([(a, k, float(x)) for a, row in enumerate(m) for k, x in enumerate(row)], "id int, idx int, value double")
    weights = lambda rows: spark.createDataFrame([(k, *map(float, r)) for k, r in enumerate(rows)], "idx int, w double, v0 double, v1 double")
    a = scoring.partial_model(long(u), weights(w.matrix[:3]), 2).selectExpr("id AS user", "linear AS a", "latent AS la")
    b = scoring.partial_model(long(i), weights(w.matrix[3:]), 2).selectExpr("id AS item", "linear AS b", "latent AS lb")
    got = scoring.all_pairs(a, b, scoring.combined(F.col("a"), F.col("b"), F.col("la"), F.col("lb"))).collect()
    assert all(r.score == pytest.approx(w.predict(np.concatenate((u[r.user], i[r.item]))[None])[0]) for r in got) and len(got) == 20


@settings(max_examples=20, deadline=None)
@given(st.integers(0, 10_000), st.booleans())
def test_gradients_are_those_of_the_loss(seed, learned):
    rnd = np.random.default_rng(seed)
    x, y = rnd.normal(size=(7, 4)), rnd.normal(size=7)
    p = rnd.normal(size=(4, 3)) if learned else None
    w = training.Weights(float(rnd.normal()), rnd.normal(size=(3 if learned else 4, 3)), p)
    g, _ = training.gradients(w, x, y)
    flat = np.concatenate([[w.bias], w.matrix.ravel(), [] if p is None else p.ravel()])

    def loss(v):
        size = w.matrix.size
        made = training.Weights(v[0], v[1 : 1 + size].reshape(w.matrix.shape), None if p is None else v[1 + size :].reshape(p.shape))
        return ((made.predict(x) - y) ** 2).sum() / 2

    for k in range(len(flat)):
        step = np.zeros(len(flat))
        step[k] = 1e-5
        assert g[k] == pytest.approx((loss(flat + step) - loss(flat - step)) / 2e-5, rel=1e-3, abs=1e-3)


@pytest.mark.parametrize("learned", [False, True])
def test_saved_models_predict_the_same(spark, learned):
    rnd = np.random.default_rng(7)
    w = training.Weights(0.5, rnd.normal(size=(3 if learned else 4, 3)), rnd.normal(size=(4, 3)) if learned else None)
    w.matrix[1], w.matrix[-1] = 0, 0  # zeros are not written, also not those at the end
    again = training.Weights.of(artifacts.cut(w.table(spark), "model"))
    x = rnd.normal(size=(9, 4))
    assert np.array_equal(w.predict(x), again.predict(x))
    data = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id int, x array<double>")
    assert [r.prediction for r in training.predicted(data, again).orderBy("id").collect()] == pytest.approx(w.predict(x).tolist())


@pytest.mark.parametrize("learned", [False, True])
def test_sparse_rows_train_as_dense_ones(spark, learned):
    rnd = np.random.default_rng(9)
    x = rnd.normal(size=(60, 8)) * (rnd.random((60, 8)) < 0.3)
    y = x @ rnd.normal(size=8)
    dense = spark.createDataFrame([(r.tolist(), float(v)) for r, v in zip(x, y, strict=True)], "x array<double>, label double")
    places = [np.flatnonzero(r) for r in x]
    sparse = spark.createDataFrame([(p.tolist(), r[p].tolist(), float(v)) for p, r, v in zip(places, x, y, strict=True)], "places array<int>, x array<double>, label double")
    fit = training.fm_feature_learning if learned else training.fm_l2
    a, b = (training.descend(d, [fit(8, 2, step=0.05, rounds=3)])[0] for d in (dense, sparse))
    assert np.allclose(a.matrix, b.matrix) and a.bias == pytest.approx(b.bias)
    assert training.mean_squared_error(dense, a) == pytest.approx(training.mean_squared_error(sparse, b))


@pytest.fixture(scope="module")
def points(spark):
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(400, 5))
    y = x @ np.array([1.0, -2.0, 0.5, 0.0, 0.0]) + 0.1 * rnd.normal(size=400)
    return spark.createDataFrame([(row.tolist(), float(v)) for row, v in zip(x, y, strict=True)], "x array<double>, label double").cache()


def one(data, fit):
    return training.descend(data, [fit])[0]


def test_descent_lowers_the_loss(points):
    for fit in (training.fm_l2, training.fm_l21, training.fm_feature_learning):
        w = one(points, fit(5, 2, step=0.05, rounds=6))
        assert len(w.losses) == 6 and w.losses[-1] < w.losses[0] and training.mean_squared_error(points, w) > 0
    plain, fast = (one(points, training.fm_l2(5, 2, step=0.05, rounds=1, momentum=m)) for m in (False, True))
    assert np.allclose(plain.matrix, fast.matrix)  # the first step has no momentum
    assert one(points, training.fm_l2(5, 2, rounds=2, freeze_intercept=True)).bias == 0


def test_momentum_is_that_of_plain_numpy(points):
    rows = points.collect()
    x, y = np.array([r.x for r in rows]), np.array([r.label for r in rows])
    got = one(points, training.fm_l2(5, 2, step=0.05, rounds=5, reg=0.3, momentum=True))
    w = before = np.concatenate(([0.0], np.full(15, 0.2)))
    t, losses = 1.0, []
    for i in range(1, 6):
        m = w[1:].reshape(5, 3)
        model = training.Weights(w[0], m)
        losses.append(((model.predict(x) - y) ** 2).mean() / 2 + 0.15 * (m**2).sum())
        g = training.gradients(model, x, y)[0] / len(x)
        at = w + (t - 1) / t * (w - before)
        step = 0.05 / np.sqrt(i)
        new = np.concatenate(([at[0]], at[1:] * (1 - step * 0.3))) - step * g
        w, before, t = new, w, (1 + np.sqrt(1 + 4 * t * t)) / 2
    assert np.allclose(got.matrix.ravel(), w[1:]) and got.bias == pytest.approx(w[0]) and got.losses == pytest.approx(losses)


def test_large_group_penalty_drops_features(points):
    assert not one(points, training.fm_l21(5, 2, step=0.05, rounds=2, l21=1e4)).matrix.any()


def test_batches_cover_every_row_once(spark, points):
    same = spark.range(1000).select(F.array(F.lit(1.0), F.lit(2.0)).alias("x"), F.lit(1.0).alias("label"))
    for data in (points, same):
        deal = training.dealt(data, 8)
        parts = [deal.batch(i) for i in range(3, 11)]
        sizes = [p.count() for p in parts]
        assert sum(sizes) == data.count() and min(sizes) > 0.5 * sum(sizes) / 8
        assert sorted(map(tuple, (r for p in parts for r in p.collect()))) == sorted(map(tuple, data.collect()))
        assert parts[0].columns == data.columns
        plan = parts[0]._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(batch" in plan
    w = one(training.dealt(points, 4), training.fm_l2(5, 2, step=0.05, rounds=8))
    assert len(w.losses) == 8 and training.mean_squared_error(points, w) < training.mean_squared_error(points, training.fm_l2(5, 2).start)


def test_steps_without_rows_change_nothing(points):
    w = one(points.limit(0), training.fm_l2(5, 2, rounds=2))
    assert w.losses == [] and np.array_equal(w.matrix, training.fm_l2(5, 2).start.matrix)


def test_many_partitions_and_features(spark):
    """A sum over 500 partitions of rows with a few of 100,000 features; what leaves a task are the features that it touched."""
    rows = spark.range(0, 5000, 1, 500).select(
        F.array(*(F.pmod(F.xxhash64("id", F.lit(k)), F.lit(100_000)).cast("int") for k in range(4))).alias("places"),
        F.array(*(F.lit(1.0 + k) for k in range(4))).alias("x"), (F.col("id") % 7).cast("double").alias("label"),
    )
    start = training.fm_l2(100_000, 2).start
    (flat, loss, n), = training.summed_gradients(rows, [start])
    got = rows.toPandas()
    want, err = training.gradients(start, training.design_of(got), got.label.to_numpy())
    assert n == 5000 and loss == pytest.approx(err) and np.allclose(flat, want)


def test_weights_beyond_a_broadcast_are_refused(points, monkeypatch):
    monkeypatch.setattr(training, "MOST_BYTES", 100)
    with pytest.raises(ValueError, match="more than 100"):
        one(points, training.fm_l2(5, 2, rounds=1))


def jobs_of(spark, what):
    """How many jobs ran."""
    group = f"counted-{id(what)}"
    spark.sparkContext.setJobGroup(group, "")
    out = what()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_candidates_share_passes(spark, points):
    alone = [one(points, training.fm_l2(5, 2, step=s, rounds=n)) for s, n in ((1e-9, 1), (0.05, 3), (0.05, 3))]
    fits = [training.fm_l2(5, 2, step=s, rounds=n) for s, n in ((1e-9, 1), (0.05, 3), (0.05, 3))]
    (best, at, errors), jobs = jobs_of(spark, lambda: training.grid_search(points, {"validation": points, "test": points.limit(0)}, fits))
    assert at == 1 and errors.validation[1] == errors.validation.min() and math.isclose(errors.validation[1], errors.validation[2])
    assert (errors.test == -1).all() and np.allclose(errors.train, errors.validation)
    assert np.allclose(best.matrix, alone[1].matrix) and errors.validation[0] == pytest.approx(training.mean_squared_error(points, alone[0]))
    _, one_candidate = jobs_of(spark, lambda: training.grid_search(points, {"validation": points, "test": points.limit(0)}, fits[1:2]))
    assert jobs == one_candidate


def test_moments_give_all_regressions(spark):
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(300, 6)) * [1, 2, 0.5, 1, 1, 0]
    y = np.stack((x @ [1, 0, 0, -2, 0, 0], x @ [0, 0, 3, 0, 0.1, 0]), axis=1) + 0.1 * rnd.normal(size=(300, 2))
    split = np.where(np.arange(300) % 3, "tr", "va")
    data = spark.createDataFrame([(a.tolist(), b.tolist(), str(s)) for a, b, s in zip(x, y, split, strict=True)], "x array<double>, y array<double>, split string").repartition(5)
    found, jobs = jobs_of(spark, lambda: training.moments(data, 6, 2))
    a, b, n = x[split == "tr"], y[split == "tr"], (split == "tr").sum()
    own = found["tr"]
    assert own.n == n and jobs <= 3
    for reg in (0.01, 0.5):
        ridge, lasso = own.ridge(reg), own.lasso(reg)
        assert np.allclose(a.T @ (a @ ridge - b) / n + reg * ridge, 0, atol=1e-9)
        slope = a.T @ (b - a @ lasso) / n  # within reg, and at it where a weight is not zero
        assert (np.abs(slope) <= reg + 1e-8).all() and np.allclose(slope[lasso != 0], reg * np.sign(lasso[lasso != 0]), atol=1e-8)
        assert np.allclose(own.error(lasso), ((a @ lasso - b) ** 2).mean(axis=0))
    with pytest.raises(ValueError, match="more than"):
        training.moments(data, 5000)
    errors, _, at = training.linear_grid(data.select("x", F.slice("y", 1, 1).alias("y"), "split"), 6, [0.001, 10.0])
    assert at == 0 and list(errors.test) == [-1, -1] and errors.validation[0] < errors.validation[1]


def test_profiles_without_content(spark):
    none = spark.createDataFrame([], "id long, idx int, value double")
    profiles = spark.createDataFrame([(1, [1.0, 2.0])], "id long, profile array<double>")
    assert not training.cold_profiles(none, profiles, 2, 4).any()


def test_factors_with_checkpoints_beat_the_mean(spark):
    rnd = np.random.default_rng(8)
    u, i = rnd.random((40, 2)), rnd.random((30, 2))
    pairs = [(a, b, float(u[a] @ i[b])) for a in range(40) for b in range(30)]
    rnd.shuffle(pairs)
    pairs = [(int(a), int(b), float(r)) for a, b, r in pairs]
    known, held = pairs[:900], pairs[900:]
    users, items = training.als(spark.createDataFrame(known, "user int, item int, rating double"), 2, 100, 0.01)
    uf, vf = ({r.id: np.array(r.features) for r in t.collect()} for t in (users, items))
    mean = np.mean([r for *_, r in known])
    error = np.mean([(uf[a] @ vf[b] - r) ** 2 for a, b, r in held])
    assert error < 0.2 * np.mean([(mean - r) ** 2 for *_, r in held]) and spark.sparkContext.getCheckpointDir()


@pytest.mark.parametrize(("low", "high"), [(0, 9), (0, 1003), (-7, 2), (5, 5), (2**31 - 40, 2**31 - 1), (-(2**30), 2**30 - 30)])
def test_ids_go_to_blocks_in_ranges_and_back(spark, low, high):
    ids = sorted({*range(low, min(low + 1100, high + 1)), *range(max(low, high - 50), high + 1)})
    rows = spark.createDataFrame([(x,) for x in ids], "id int").select("id", training.in_ranges(F.col("id"), low, high)[0].alias("as"))
    rows = rows.select("id", "as", training.in_ranges(F.col("as"), low, high)[1].alias("back")).orderBy("id").collect()
    assert [r.back for r in rows] == ids and len({r["as"] for r in rows}) == len(ids)
    blocks = [r["as"] % training.BLOCKS for r in rows]
    assert blocks == sorted(blocks) and (high - low < 1000 or blocks[0] == 0 and blocks[-1] == training.BLOCKS - 1)


def test_factors_go_to_few_blocks_where_ratings_are_near(spark):
    """Ten groups of users rate ten groups of items; with the ids mixed, a factor goes to many blocks. Both fit the ratings."""
    rnd, sizes, jvm = np.random.default_rng(4), [], spark.sparkContext._jvm
    u, i = rnd.random((2000, 2)), rnd.random((1000, 2))
    pairs = sorted({(int(a), int(a // 200 * 100 + b)) for a in range(2000) for b in rnd.integers(0, 100, 12)})

    def written() -> int:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        none = jvm.java.util.ArrayList
        found = spark.sparkContext._jsc.sc().statusStore().stageList(none(), False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), none())
        return {found.apply(k).stageId(): found.apply(k).shuffleWriteBytes() for k in range(found.size())}

    for users, items in ((np.arange(2000), np.arange(1000)), (rnd.permutation(2000), rnd.permutation(1000))):
        ratings = spark.createDataFrame([(int(users[a]), int(items[b]), float(u[a] @ i[b])) for a, b in pairs], "user int, item int, rating double").coalesce(2)
        before = written()
        uf, vf = ({r.id: np.array(r.features) for r in t.collect()} for t in training.als(ratings, 2, 30, 0.001))
        sizes.append(sum(n for k, n in written().items() if k not in before))
        assert sorted(uf) == sorted({int(users[a]) for a, _ in pairs}) and sorted(vf) == sorted({int(items[b]) for _, b in pairs})
        assert np.mean([(uf[int(users[a])] @ vf[int(items[b])] - u[a] @ i[b]) ** 2 for a, b in pairs]) < 1e-3
    assert sizes[0] < sizes[1] / 2, sizes


def test_results_count_only_when_whole(spark):
    name = f"test-{os.urandom(6).hex()}"
    path = f"{artifacts.shared_folder(spark)}/airwave/{name}"
    assert artifacts.save(spark.range(5), name).count() == 5
    assert artifacts.save(spark.range(7), name).count() == 5 and artifacts.save(spark.range(6), name, overwrite=True).count() == 6
    os.remove(f"{path}/_SUCCESS")
    assert artifacts.save(spark.range(8), name).count() == 8
    assert artifacts.name_of("a", 1, "x") == artifacts.name_of("a", 1, "x") != artifacts.name_of("a", 1, "y")
    artifacts.remove(spark, path)


def test_metrics_of_a_repeated_run_do_not_double(spark):
    name = f"metrics-{os.urandom(6).hex()}"
    rows = lambda x: spark.createDataFrame([("m", "t", "mse", x), ("m", "t", "rmse", x), ("n", "t", "mse", 2 * x)], "model string, test string, metric string, value double")
    exports.append_metrics(rows(1.0), name, "a")
    exports.append_metrics(rows(2.0), name, "b")
    got = exports.append_metrics(rows(3.0), name, "a")
    assert {(r.run, r.model, r.test, r.metric): r.value for r in got.collect()} == {
        (run, m, "t", k): x * (2 if m == "n" else 1) for run, x in (("a", 3.0), ("b", 2.0)) for m, k in (("m", "mse"), ("m", "rmse"), ("n", "mse"))
    } and got.count() == 6
    artifacts.remove(spark, f"{artifacts.shared_folder(spark)}/airwave/{name}")


def test_temporal_grains(spark):
    rows = [(u, 1, f"2014-05-{d:02d}", d % 24, 400.0) for u in (1, 2) for d in range(1, 15) if u == 1 or d < 3]
    watch = spark.createDataFrame(rows, "user int, item int, d string, hour int, seconds double").withColumn("date", F.to_date("d"))
    genres = spark.createDataFrame([(1, "news"), (1, "sport")], "item int, genre string")
    assert pipelines.temporal_aggregation(watch, genres, "daily").count() == 2 * len(rows)
    assert {r.user for r in pipelines.temporal_aggregation(watch, genres, "weekly").collect()} == {1}
    assert {r.user for r in pipelines.temporal_aggregation(watch, genres, "hourly").collect()} == {1}
    assert not pipelines.temporal_aggregation(watch, genres, "hourly", min_watch=500).count()


def test_design_and_errors_from_lists_and_shares(spark):
    """Features that meet the ratings as lists give the rows of the long design; both sides' shares give the model's error on them."""
    rnd = np.random.default_rng(3)
    ratings = spark.createDataFrame([(u % 7, u * 5 % 11, 60.0 * u) for u in range(60)], "user int, item int, rating double")
    side = lambda n, at: spark.createDataFrame([(i, int(k), float(rnd.normal())) for i in range(n) for k in at + rnd.permutation(3)[: 1 + i % 3]], "id int, idx int, value double")
    users, items = side(6, 0), side(9, 3)  # user 6 and items 9 and 10 have none
    long = pipelines.design_rows(ratings, users, items).groupBy("user", "item", "label").agg(F.array_sort(F.collect_list(F.struct("idx", "value"))).alias("f"))
    made = pipelines.sparse_design(ratings, users, items)
    got = sorted((r.user, r.item, r.label, r.places, r.x) for r in made.collect())
    assert got == sorted((r.user, r.item, r.label / 60, [e.idx for e in r.f], [e.value for e in r.f]) for r in long.collect())
    assert len(got) == sum(u % 7 < 6 and u * 5 % 11 < 9 for u in range(60)) == 42
    assert "Generate" not in made._jdf.queryExecution().executedPlan().toString()
    model = training.Weights(0.5, rnd.normal(size=(6, 3)))
    wide = spark.createDataFrame([(i, *map(float, row)) for i, row in enumerate(model.matrix)], "idx int, w double, v0 double, v1 double")
    u, i = scoring.partial_model(users, wide, 2), scoring.partial_model(items, wide, 2)
    pairs = u.toDF("user", "lu", "vu").join(aggregates.sum_pairs(ratings), "user").join(i.toDF("item", "li", "vi"), "item")
    scored = pairs.select((F.col("rating") / 60).alias("label"), scoring.combined(F.col("lu"), F.col("li"), F.col("vu"), F.col("vi"), model.bias).alias("prediction"))
    assert scoring.squared_error(scored).first().mse == pytest.approx(training.mean_squared_error(made, model))


def test_recommendations_and_their_tests_are_of_all_users(spark, monkeypatch):
    """Every user with features is ranked, tested and gets programs: none is left out by a sample."""
    given = {}
    keep = lambda name, fn: lambda users, *rest: given.setdefault(name, []).append({r.user for r in users.select("user").collect()}) or fn(users, *rest)
    for name in ("best_items", "best_in_slots"):
        monkeypatch.setattr(scoring, name, keep(name, getattr(scoring, name)))
    v = Views(spark, SF)
    found = {(r.section, r.key): r.value for r in models.pipeline_recommend(v).collect()}
    trained = {r.user for r in v.train().select("user").distinct().collect()}
    tested = {r.user for r in v.test().select("user").distinct().collect()}
    assert given == {"best_items": [trained, trained & tested], "best_in_slots": [trained]}
    assert found["prediction", "users"] == found["corpus", "users"] == str(len(trained))


@pytest.mark.parametrize("factors", [2, 5])
def test_searches_leave_out_leaves_but_no_result(spark, monkeypatch, factors):
    """Distinct profiles, ties and long histories; most scores are never worked out."""
    monkeypatch.setattr(scoring, "LEAF", 8)
    rnd = np.random.default_rng(factors)
    vf = rnd.normal(size=(3000, factors))
    vf[2000:] = np.round(vf[2000:])
    uf = rnd.normal(size=(30, factors)) * rnd.choice([0.1, 1, 10], size=(30, 1))
    uf[:5] = np.round(uf[:5])
    seen = [rnd.permutation(3000)[: rnd.integers(1, 40)].tolist() for _ in uf]
    seen[7] = list(range(2990))
    score, worked = scoring.dot_scores(), []
    rows = pa.RecordBatch.from_arrays([pa.array(range(30)), pa.array(uf.tolist()), pa.array(seen)], names=["user", "uf", "seen_items"])
    known = scoring.Leaves.of({"item": np.arange(3000), "vf": vf})
    counted = scoring.Bounded(lambda u, i: worked.append(score.pairs(u, i).size) or score.pairs(u, i), score.most)
    got = {}
    for mine, kind, r, item, s in scoring._searched(iter([rows]), known, counted, ("all", "new"), 10):
        for u, i, x in zip(mine["user"].ravel()[r].tolist(), item.tolist(), s.tolist(), strict=True):
            got.setdefault((u, kind), []).append((-x, i))
    whole = score({"uf": uf[:, None]}, {"vf": vf})
    for u in range(30):
        ranked = sorted(zip((-whole[u]).tolist(), range(3000), strict=True))
        assert got[u, "all"] == ranked[:10]
        assert got[u, "new"] == [x for x in ranked if x[1] not in set(seen[u])][:10]
    assert sum(worked) < whole.size / 2


@pytest.mark.parametrize("kind_of_score", ["dot", "machine"])
def test_near_users_share_lists_and_lose_no_result(kind_of_score):
    """Ties, copies, long histories and users without a direction; what is worked out hardly grows with the items."""
    rnd, counts = np.random.default_rng(5), []
    users = 600
    vu = rnd.normal(size=(users, 3)) * rnd.choice([0.01, 1, 100], size=(users, 1))
    vu[:50] = np.round(vu[:50])
    vu[50:53] = 0
    vu[53] = np.nan
    for size in (4000, 64000):
        vi = rnd.normal(size=(size, 3)) + 3
        vi[size // 2 : -size // 4] = np.round(vi[size // 2 : -size // 4])
        seen = [rnd.permutation(size)[: rnd.integers(1, 40)].tolist() for _ in range(users)]
        seen[7] = list(range(size - 4))
        if kind_of_score == "dot":
            score, mine, known = scoring.dot_scores(), {"uf": vu}, {"vf": vi}
        else:
            score, mine, known = scoring.factorisation_scores(0.5), {"lu": rnd.normal(size=users), "vu": vu}, {"li": np.round(rnd.normal(size=size)), "vi": vi}
        rows = pa.RecordBatch.from_arrays([pa.array(range(users)), *(pa.array(x.tolist()) for x in mine.values()), pa.array(seen)], names=["user", *mine, "seen_items"])
        worked, known = [], {"item": np.arange(size) * 3, **known}
        seen_items = [{3 * x for x in own} for own in seen]
        rows = rows.set_column(rows.num_columns - 1, "seen_items", pa.array([sorted(x) for x in seen_items]))
        counted = scoring.Bounded(lambda u, i: worked.append(score.pairs(u, i).size) or score.pairs(u, i), score.most, score.of_users, score.of_items, score.error)  # noqa: B023
        got = {}
        for who, kind, r, item, s in scoring._grouped(iter([rows]), (scoring.Leaves.of(known), scoring.Longest.of(known, score)), counted, ("all", "new"), 10):
            for u, i, x in zip(who["user"].ravel()[r].tolist(), item.tolist(), s.tolist(), strict=True):
                got.setdefault((u, kind), []).append((-x, i))
        counts.append(sum(worked) / users)
        for u in (*range(60), *range(60, users, 29)):
            whole = score({c: x[u : u + 1, None] for c, x in mine.items()}, known)[0]
            ranked = [(-whole[i], 3 * int(i)) for i in np.lexsort((np.arange(size), -whole))] if u != 53 else []
            assert got.get((u, "all"), []) == ranked[:10]
            assert got.get((u, "new"), []) == [x for x in ranked if x[1] not in seen_items[u]][:10]
    assert counts[1] < 4 * counts[0], counts


def test_factorisation_scores_stay_below_their_bounds():
    rnd = np.random.default_rng(3)
    users, items = {"lu": rnd.normal(size=(50, 1)), "vu": rnd.normal(size=(50, 1, 3))}, {"item": np.arange(2000), "li": rnd.normal(size=2000), "vi": rnd.normal(size=(2000, 3))}
    score, known = scoring.factorisation_scores(0.5), scoring.Leaves.of(items)
    most = np.maximum.reduceat(score(users, known.columns), known.starts[:-1], axis=1)
    assert (most <= score.most(users, known.lo, known.hi)).all()
    assert score(users, items)[4, 9] == pytest.approx(0.5 + users["lu"][4, 0] + items["li"][9] + ((users["vu"][4, 0] + items["vi"][9]) ** 2).sum())


def test_equal_profiles_are_paired_once(spark):
    """Figures of all pairs from pairs of profiles, in blocks."""
    users = spark.range(3000).select(F.col("id").alias("user"), (F.col("id") % 3 + 0.0).alias("a"))
    items = spark.range(5000).select(F.col("id").alias("item"), (F.col("id") % 4 + 0.0).alias("b"))
    parts = lambda rows: rows.groupBy("user").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("score")).alias("s"))
    for block in (1, 100):
        made = scoring.profile_pairs(users, items, F.col("a") * F.col("b"), parts, block).groupBy("user").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
        got = {r.user: (r.n, r.s) for r in made.collect()}
        assert got == {u: (5000, u % 3 * 1.5 * 5000) for u in range(3000)}


def test_weighted_mean_shuffles_no_row_for_each_feature(spark, monkeypatch):
    monkeypatch.setattr(aggregates, "ENTRIES_A_TASK", 100)
    watch = spark.range(60).select((F.col("id") % 5).alias("user"), (F.col("id") % 12).alias("item"), (F.col("id") + 1.0).alias("rating"))
    block = spark.range(400).select((F.col("id") % 10).alias("id"), F.floor(F.col("id") / 10).cast("int").alias("idx"), (F.col("id") % 7 + 0.0).alias("value"))
    made = aggregates.weighted_mean(watch, block)
    got, want, total = {(r.user, r.idx): r.value for r in made.collect()}, {}, {}
    for i in range(60):
        if i % 12 < 10:
            total[i % 5] = total.get(i % 5, 0) + i + 1
            for k in range(40):
                want[i % 5, k] = want.get((i % 5, k), 0) + (i + 1) * ((k * 10 + i % 12) % 7)
    assert got == pytest.approx({(u, k): x / total[u] for (u, k), x in want.items()})
    plan = made._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "hashpartitioning(user" in plan and "idx" not in "".join(line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
