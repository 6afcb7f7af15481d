"""Training queries: regressions from moments, factorisation machines by gradients, alternating least squares, metrics of models."""

from __future__ import annotations

import math
import uuid

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airwave.operators import exports, relational, scoring, training
from airwave.plans.models import DESIGN, design, rounded
from airwave.plans.registry import query
from airwave.plans.relational import maps
from airwave.plans.sources import GENRE_BLOCK, genre_block
from airwave.sources import artifacts
from airwave.sources.views import Views

SIZE = 10
REGS = (0.01, 0.1, 1.0)


def split_design(v: Views) -> DataFrame:
    """The design with the part that its user is in; written, as several passes read it."""
    return artifacts.cut(design(v).select("x", "label", exports.split_of(F.col("user")).alias("split")), "split-design")


# The same solutions in SQL: moments, Gauss-Jordan elimination for ridge, coordinate descent for lasso.


def _products(size: int, y: list[str]) -> str:
    """Aggregates n, g (features x features), c (features x targets) and yy over rows with a list x."""
    rows = lambda cells: "[" + ", ".join(cells) + "]"
    g = rows(rows(f"sum(x[{i}] * x[{j}])" for j in range(1, size + 1)) for i in range(1, size + 1))
    c = rows(rows(f"sum(x[{i}] * {t})" for t in y) for i in range(1, size + 1))
    return f"count(*) AS n, {g} AS g, {c} AS c, {rows(f'sum({t} * {t})' for t in y)} AS yy"


def _ridge_sql(size: int) -> str:
    """e{size}: (reg, m) with the solutions behind the unit matrix, from moments fit(n, g, c) and regs(reg)."""
    steps = [
        "e0 AS (SELECT reg, list_transform(g, lambda r, i: list_concat(list_transform(r, lambda v, j: v / n + CASE WHEN i = j THEN reg ELSE 0 END),"
        " list_transform(c[i], lambda v: v / n))) AS m FROM fit, regs)"
    ]
    for k in range(1, size + 1):
        steps.append(
            f"e{k} AS (SELECT reg, list_transform(m, lambda r, i: CASE WHEN i = {k} THEN list_transform(r, lambda v: v / r[{k}])"
            f" ELSE list_transform(r, lambda v, j: v - r[{k}] / m[{k}][{k}] * m[{k}][j]) END) AS m FROM e{k - 1})"
        )
    return ", ".join(steps)


def _lasso_sql(size: int, sweeps: int) -> str:
    """cd: (reg, t, it, w) for each target t, from moments fit(n, g, c) and regs(reg); the last it has the solution."""
    j = f"(it % {size} + 1)"
    near = f"c[{j}][t] / n - list_dot_product(g[{j}], w) / n + g[{j}][{j}] / n * w[{j}]"
    new = f"CASE WHEN g[{j}][{j}] = 0 THEN 0 ELSE sign({near}) * greatest(abs({near}) - reg, 0) / (g[{j}][{j}] / n) END"
    return f"""cd AS (SELECT reg, t, 0 AS it, list_transform(range({size}), lambda i: 0::DOUBLE) AS w, n, g, c FROM fit, regs, (SELECT unnest(range(1, len(c[1]) + 1)) AS t FROM fit)
  UNION ALL SELECT reg, t, it + 1, list_transform(w, lambda v, i: CASE WHEN i = {j} THEN {new} ELSE v END), n, g, c FROM cd WHERE it < {size * sweeps})"""


def _grid_sql(solved: str, weights: str) -> str:
    split = """CASE WHEN "user" % 10 / 10 < 0.7 THEN 'tr' WHEN "user" % 10 / 10 < 0.9 THEN 'te' ELSE 'va' END"""
    return (
        DESIGN
        + f""", moments AS (SELECT {split} AS split, {_products(SIZE, ["label"])} FROM design GROUP BY 1), fit AS (SELECT * FROM moments WHERE split = 'tr'),
regs AS (SELECT unnest([{", ".join(f"{r}::DOUBLE" for r in REGS)}]) AS reg), {solved}, w AS ({weights}),
err AS (SELECT reg, split, (yy[1] - 2 * list_dot_product(w, list_transform(c, lambda r: r[1])) + list_dot_product(w, list_transform(g, lambda r: list_dot_product(r, w)))) / n AS mse FROM moments, w),
best AS (SELECT arg_min(reg, (mse, reg)) AS best FROM err WHERE split = 'va')
SELECT reg, CAST(idx - 1 AS INT) AS idx, round(w[idx], 6) AS w, reg = best AS chosen, round((SELECT mse FROM err e WHERE e.reg = w.reg AND split = 'tr'), 6) AS train,
round((SELECT mse FROM err e WHERE e.reg = w.reg AND split = 'va'), 6) AS validation, round((SELECT mse FROM err e WHERE e.reg = w.reg AND split = 'te'), 6) AS test
FROM w, best, (SELECT unnest(range(1, {SIZE + 1})) AS idx)"""
    )


def _grid(v: Views, lasso: bool) -> DataFrame:
    """Every candidate's weights and errors; all penalties and parts from one aggregate."""
    rows = design(v).select("x", F.array("label").alias("y"), exports.split_of(F.col("user")).alias("split"))
    errors, models, at = training.linear_grid(rows, SIZE, list(REGS), lasso)
    out = [
        (reg, i, round(float(w), 6), k == at, *(round(float(x), 6) for x in rest))
        for k, ((reg, *rest), m) in enumerate(zip(errors.itertuples(index=False), models, strict=True))
        for i, w in enumerate(m.matrix[:, 0])
    ]
    return v.spark.createDataFrame(out, "reg double, idx int, w double, chosen boolean, train double, validation double, test double")


@query("reg_ridge", "uf vf", _grid_sql(_ridge_sql(SIZE), f"SELECT reg, list_transform(m, lambda r: r[{SIZE + 1}]) AS w FROM e{SIZE}"))
def reg_ridge(v: Views):
    return _grid(v, False)


SWEEPS = 400


@query("reg_lasso", "uf vf", _grid_sql(_lasso_sql(SIZE, SWEEPS), f"SELECT reg, w FROM cd WHERE it = {SIZE * SWEEPS}"), recursive=True)
def reg_lasso(v: Views):
    return _grid(v, True)


GENRES, DIMENSIONS, COLD_REG = 16, 5, 0.1
COLD_FIT = (
    GENRE_BLOCK
    + f""", rows AS (SELECT list_transform(range({GENRES}), lambda i: CASE WHEN list_contains(own, i) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS x, vf AS y
  FROM (SELECT id, list(idx) AS own FROM block GROUP BY 1) JOIN vf ON id = item),
fit AS (SELECT {_products(GENRES, [f"y[{k}]" for k in range(1, DIMENSIONS + 1)])} FROM rows), regs AS (SELECT {COLD_REG}::DOUBLE AS reg), """
)
COLD_WEIGHTS = f"FROM (SELECT unnest(range(1, {GENRES + 1})) AS i)"


def _cold(v: Views, lasso: bool) -> DataFrame:
    profiles = v.item_factors().select(F.col("item").alias("id"), F.col("vf").alias("profile"))
    fitted = training.cold_profiles(genre_block(v), profiles, DIMENSIONS, GENRES, COLD_REG, lasso)
    return v.spark.createDataFrame([(k, i, round(float(w), 6)) for (i, k), w in np.ndenumerate(fitted)], "dimension int, idx int, w double")


@query("cold_profile_ridge", "uf vf pg", COLD_FIT + _ridge_sql(GENRES) + f""" SELECT CAST(k AS INT) AS dimension, CAST(i - 1 AS INT) AS idx, round(m[i][{GENRES + 1} + k], 6) AS w
{COLD_WEIGHTS}, (SELECT unnest(range({DIMENSIONS})) AS k), e{GENRES}""")  # fmt: skip
def cold_profile_ridge(v: Views):
    return _cold(v, False)


@query("cold_profile_lasso", "uf vf pg", COLD_FIT + _lasso_sql(GENRES, SWEEPS) + f""" SELECT CAST(t - 1 AS INT) AS dimension, CAST(i - 1 AS INT) AS idx, round(w[i], 6) AS w
{COLD_WEIGHTS}, cd WHERE it = {GENRES * SWEEPS}""", recursive=True)  # fmt: skip
def cold_profile_lasso(v: Views):
    return _cold(v, True)


#: Steps of the queries that train by gradients, and batches: together one pass over all rows, as a hundred steps of a hundredth are.
STEPS = 20


def trained(v: Views, fit: training.Fit) -> DataFrame:
    rows = design(v).where(exports.split_of(F.col("user")) == "tr").select("x", "label")
    return training.descend(training.dealt(rows, STEPS), [fit])[0].table(v.spark)


@query("fm_l2")
def fm_l2(v: Views):
    return trained(v, training.fm_l2(SIZE, rounds=STEPS))


@query("fm_l21")
def fm_l21(v: Views):
    return trained(v, training.fm_l21(SIZE, rounds=STEPS))


@query("fm_feature_learning")
def fm_feature_learning(v: Views):
    return trained(v, training.fm_feature_learning(SIZE, rounds=STEPS))


# Loss histories of full steps, which are sums that SQL can write too.


def _descent_sql(rounds: int, step: float, reg: float, momentum: bool) -> str:
    each = lambda cell: "[" + ", ".join(cell(j) for j in range(1, SIZE + 1)) + "]"
    start = each(lambda j: f"{1 / SIZE}::DOUBLE")
    parts, t = [DESIGN, f", s0 AS (SELECT 0::DOUBLE AS b, {start} AS w, {start} AS v, 0::DOUBLE AS pb, {start} AS pw, {start} AS pv)"], 1.0
    for i in range(1, rounds + 1):
        pull, s = (t - 1) / t if momentum else 0.0, step / math.sqrt(i)
        t = (1 + math.sqrt(1 + 4 * t * t)) / 2
        grads = each(lambda j: f"avg(d * x[{j}])"), each(lambda j: f"avg(2 * d * l * x[{j}])")
        at = lambda m, j: f"({m}[{j}] + {pull!r}::DOUBLE * ({m}[{j}] - p{m}[{j}])) * {1 - s * reg!r}::DOUBLE - {s!r}::DOUBLE * g{m}[{j}]"
        parts.append(f""", r{i} AS (SELECT x, list_dot_product(x, v) AS l, b + list_dot_product(x, w) + pow(list_dot_product(x, v), 2) - label AS d FROM design, s{i - 1}),
g{i} AS (SELECT avg(d) AS gb, {grads[0]} AS gw, {grads[1]} AS gv, avg(d * d) / 2 AS loss FROM r{i}),
s{i} AS (SELECT b + {pull!r}::DOUBLE * (b - pb) - {s!r}::DOUBLE * gb AS b, {each(lambda j: at("w", j))} AS w, {each(lambda j: at("v", j))} AS v, b AS pb, w AS pw, v AS pv,
  g{i}.loss + {reg / 2!r}::DOUBLE * (list_dot_product(w, w) + list_dot_product(v, v)) AS loss FROM g{i}, s{i - 1})""")
    return "".join(parts) + " " + " UNION ALL ".join(f"SELECT CAST({i} AS INT) AS step, round(loss, 6) AS loss FROM s{i}" for i in range(1, rounds + 1))


DESCENT = {"step": 1e-2, "reg": 0.1, "rounds": 5}


def _losses(v: Views, momentum: bool) -> DataFrame:
    rows = artifacts.cut(design(v).select("x", "label"), "design")
    w = training.descend(rows, [training.fm_l2(SIZE, 1, momentum=momentum, **DESCENT)])[0]
    return v.spark.createDataFrame([(i, round(x, 6)) for i, x in enumerate(w.losses, 1)], "step int, loss double")


@query("gd_train", "uf vf", _descent_sql(momentum=False, **DESCENT))
def gd_train(v: Views):
    return _losses(v, False)


@query("gd_accelerated", "uf vf", _descent_sql(momentum=True, **DESCENT))
def gd_accelerated(v: Views):
    return _losses(v, True)


@query("grid_search_validation")
def grid_search_validation(v: Views):
    """All candidates in one pass a step; every one's errors on the three parts."""
    rows = split_design(v)
    part = lambda s: rows.where(F.col("split") == s)
    grid = [{"step": s, "reg": r, "rounds": n} for s in (1e-3, 1e-4) for r in (0.0, 0.1) for n in (STEPS // 2, STEPS)]
    fits = [training.fm_l2(SIZE, 3, **g) for g in grid]
    _, at, errors = training.grid_search(training.dealt(part("tr").drop("split"), STEPS), {"validation": part("va"), "test": part("te")}, fits)
    out = [(*g.values(), *map(float, e), k == at) for k, (g, e) in enumerate(zip(grid, errors.itertuples(index=False), strict=True))]
    return v.spark.createDataFrame(out, "step double, reg double, rounds int, train double, validation double, test double, chosen boolean")


def int_ratings(v: Views) -> tuple[DataFrame, DataFrame, DataFrame]:
    users, items = maps(v.train())
    ints = relational.to_int_ids(v.train(), users, items).select(F.col("uid").alias("user"), F.col("iid").alias("item"), "rating")
    return ints, users, items


@query("mf_train_als")
def mf_train_als(v: Views):
    """The model: rank 5, a hundred rounds, with checkpoints."""
    users, items = training.als(int_ratings(v)[0])
    return users.withColumn("side", F.lit("user")).unionByName(items.withColumn("side", F.lit("item")))


@query("feat_fact_als")
def feat_fact_als(v: Views):
    """Feature blocks (side, id, idx, value) by the tables' own ids: rank 10, ten rounds."""
    ints, users, items = int_ratings(v)
    blocks = []
    for side, factors, names, on in zip(("user", "item"), training.als(ints, 10, 10), (users, items), ("uid", "iid"), strict=True):
        rows = factors.withColumnRenamed("id", on).join(names, on)
        blocks.append(rows.select(F.lit(side).alias("side"), F.col(side).alias("id"), F.posexplode("features").alias("idx", "value")))
    return blocks[0].unionByName(blocks[1])


@query("sink_model")
def sink_model(v: Views):
    """Models are saved, loaded and held against the held-out split: squared errors before and after, by model."""
    rows, out = split_design(v), []
    part = lambda s: rows.where(F.col("split") == s)
    linear = training.linear_grid(rows.select("x", F.array("label").alias("y"), "split"), SIZE, [0.1])[1][0]
    fm, learned = training.descend(part("tr"), [training.fm_l2(SIZE, 3, rounds=4), training.fm_feature_learning(SIZE, 3, rounds=4)])
    models = {"linear": linear, "fm": fm, "learned": learned}
    loaded = [training.Weights.of(artifacts.cut(w.table(v.spark), f"model-{name}")) for name, w in models.items()]
    before, after = (training.mean_squared_errors(part("te"), list(m)) for m in (models.values(), loaded))
    out += zip(models, before, after, strict=True)
    users, items = training.als(int_ratings(v)[0], rounds=10)
    for name, profiles in (("users", users), ("items", items)):
        saved = artifacts.cut(profiles, f"profiles-{name}")
        size = lambda df: float(df.agg(F.sum(F.aggregate("features", F.lit(0.0), lambda a, x: a + x * x))).first()[0])
        out.append((name, size(profiles), size(saved)))
    return v.spark.createDataFrame(out, "model string, before double, after double")


# Metrics of models: a table that runs append to.

MEANS = """, base AS (SELECT avg(rating) AS m FROM train), by_user AS (SELECT "user", avg(rating) AS m FROM train GROUP BY 1), by_item AS (SELECT item, avg(rating) AS m FROM train GROUP BY 1),
rows AS (SELECT rating, base.m AS "mean", coalesce(by_user.m, base.m) AS "user mean", coalesce(by_item.m, base.m) AS "item mean"
  FROM test, base LEFT JOIN by_user ON by_user."user" = test."user" LEFT JOIN by_item ON by_item.item = test.item),
listed AS (SELECT model, rating, p FROM (UNPIVOT rows ON "mean", "user mean", "item mean" INTO NAME model VALUE p)),
metrics AS (SELECT model, round(avg(pow(rating - p, 2)), 6) AS mse, round(sqrt(avg(pow(rating - p, 2))), 6) AS rmse FROM listed GROUP BY 1)"""


def mean_models(v: Views) -> DataFrame:
    """(model, test, metric, value) of three models: the mean rating, the user's and the item's."""
    train, base = v.train(), v.train().agg(F.avg("rating").alias("mean"))
    by = lambda c: train.groupBy(c).agg(F.avg("rating").alias(f"{c} mean"))
    rows = v.test().crossJoin(F.broadcast(base)).join(by("user"), "user", "left").join(by("item"), "item", "left")
    names = ("mean", "user mean", "item mean")
    error = lambda c: F.avg(F.pow(F.col("rating") - F.coalesce(F.col(f"`{c}`"), F.col("mean")), 2))
    found = rows.agg(*(error(c).alias(c) for c in names)).unpivot([], [f"`{c}`" for c in names], "model", "mse")
    figures = F.create_map(F.lit("mse"), F.round("mse", 6), F.lit("rmse"), F.round(F.sqrt("mse"), 6))
    return found.select("model", F.lit("warm").alias("test"), F.explode(figures).alias("metric", "value"))


def stored_metrics(v: Views) -> DataFrame:
    """Two runs append to a table, and the first does so again."""
    name, found = f"metrics-{uuid.uuid4().hex}", artifacts.cut(mean_models(v), "metrics")
    for run, model in (("first", "mean"), ("second", "user mean"), ("second", "item mean"), ("first", "mean")):
        stored = exports.append_metrics(found.where(F.col("model") == model), name, run)
    return stored


@query("sink_metric", "train test", MEANS + """ SELECT CASE WHEN model = 'mean' THEN 'first' ELSE 'second' END AS run, model, 'warm' AS test, metric, value
FROM (UNPIVOT metrics ON mse, rmse INTO NAME metric VALUE value)""")  # fmt: skip
def sink_metric(v: Views):
    return stored_metrics(v)


@query("select_best_model", "train test", MEANS + " SELECT model, rmse AS metric FROM metrics ORDER BY rmse, model LIMIT 1")
def select_best_model(v: Views):
    """The model with the least error in the stored metrics."""
    stored = stored_metrics(v).where("test = 'warm' AND metric = 'rmse'")
    return scoring.best_model(stored.select("model", F.col("value").alias("metric")))
