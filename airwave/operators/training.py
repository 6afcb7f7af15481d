"""Model training as Spark jobs: ALS, linear models, and factorisation machines by distributed gradients.

A gradient step broadcasts the weights, whose size is checked; each task adds up its rows' gradients in one array as large as the weights
and gives out the features that its rows touch, a row each. Spark adds these up by feature, in the tasks first, so no task holds
more than its own array, however many partitions there are; the driver gets one row for each feature. Models that are tried
together share each step's pass over the rows. Rows are dense arrays, or lists of places and values where most are zero.

Ridge and lasso come from the products of all pairs of columns, which one aggregate gives for all targets, penalties and splits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyspark.sql.types as T
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airwave.sources.artifacts import cut, shared_folder


#: Blocks of users and of items that ALS works on; it sends a factor to each block that has ratings with it.
BLOCKS = 10


def in_ranges(column: Column, low: int, high: int) -> tuple[Column, Column]:
    """Ids low .. high renamed so that ALS, which takes the remainder by BLOCKS, deals ranges of them to blocks; and a renamed column's ids."""
    width = (high - low) // BLOCKS + 1
    near = column.cast("long") - low
    return ((near % width) * BLOCKS + F.floor(near / width)).cast("int"), ((column % BLOCKS).cast("long") * width + F.floor(column / BLOCKS) + low).cast("int")


def als(ratings: DataFrame, rank: int = 5, rounds: int = 100, reg: float = 0.1, nonnegative: bool = False, seed: int = 3, checkpoint: int = 10):
    """(user factors, item factors) as (id, features); repeated pairs are summed first.

    Every ``checkpoint`` rounds the factors go to the shared folder, so lineage and what a lost executor costs stay bounded.

    Ids should be dense. Ranges of them are the blocks, so that a round sends a factor to few blocks where near users have ratings of near
    items; where ratings do not follow the ids, it is sent to as many as if ids were dealt by a hash.
    """
    context = ratings.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(f"{shared_folder(ratings.sparkSession)}/airwave/als")
    summed = cut(ratings.groupBy("user", "item").agg(F.sum("rating").cast("float").alias("rating")), "summed-ratings")
    ends = summed.agg(*(f(c).alias(f"{n}_{c}") for c in ("user", "item") for n, f in (("low", F.min), ("high", F.max)))).first()
    ranged = [c for c in ("user", "item") if ends[f"low_{c}"] is not None and ends[f"high_{c}"] - ends[f"low_{c}"] < 2**31 - 2 * BLOCKS]
    way = lambda c, column: in_ranges(F.col(column), ends[f"low_{c}"], ends[f"high_{c}"])
    model = ALS(
        rank=rank, maxIter=rounds, regParam=reg, nonnegative=nonnegative, seed=seed, userCol="user", itemCol="item", ratingCol="rating",
        checkpointInterval=checkpoint, numUserBlocks=BLOCKS, numItemBlocks=BLOCKS,
    ).fit(summed.withColumns({c: way(c, c)[0] for c in ranged}))
    factors = (("user", model.userFactors), ("item", model.itemFactors))
    return tuple(own.withColumn("id", way(c, "id")[1]) if c in ranged else own for c, own in factors)


@dataclass
class Moments:
    """Sums of products of features and targets over n rows: all that squared errors of linear models need."""

    n: int
    features: np.ndarray
    cross: np.ndarray
    targets: np.ndarray

    def error(self, w: np.ndarray) -> np.ndarray:
        """Mean squared errors of the targets by weights (features x targets); -1 without rows."""
        if not self.n:
            return np.full(len(self.targets), -1.0)
        return (self.targets - 2 * (w * self.cross).sum(axis=0) + (w * (self.features @ w)).sum(axis=0)) / self.n

    def ridge(self, reg: float) -> np.ndarray:
        """Least half mean squared error plus reg / 2 times the weights' squares: no intercept, features as they are."""
        own = self.features / max(1, self.n) + reg * np.eye(len(self.features))
        return np.linalg.lstsq(own, self.cross / max(1, self.n), rcond=None)[0]

    def lasso(self, reg: float, rounds: int = 10_000, enough: float = 1e-12) -> np.ndarray:
        """Least half mean squared error plus reg times the weights' sizes, by coordinate descent on the moments."""
        g, c = self.features / max(1, self.n), self.cross / max(1, self.n)
        w = np.zeros_like(c)
        for _ in range(rounds):
            moved = 0.0
            for j in range(len(g)):
                if g[j, j] > 0:
                    new = soft(c[j] - g[j] @ w + g[j, j] * w[j], reg) / g[j, j]
                    moved = max(moved, np.abs(new - w[j]).max(initial=0))
                    w[j] = new
            if moved < enough:
                break
        return w


#: Features and targets of a regression at most: their products are held by each task and by the driver.
WIDEST = 2000


def moments(data: DataFrame, size: int, targets: int = 1) -> dict[str, Moments]:
    """Moments of (x, or places and x; y, an array of targets) by split, in one aggregate; without a column split, of all as ''."""
    if (wide := size + targets) > WIDEST:
        raise ValueError(f"{wide} columns are more than {WIDEST}")

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for name, own in b.groupby("split"):
                z = np.concatenate((dense(own, size), np.stack(own.y.to_numpy()).astype(float)), axis=1)
                total = sums.setdefault(name, np.zeros((wide + 1, wide)))
                total[:-1] += z.T @ z
                total[-1, 0] += len(z)
        for name, total in sums.items():
            i, k = np.nonzero(np.concatenate((np.triu(total[:-1]), total[-1:])))
            yield pd.DataFrame({"split": name, "i": i, "k": k, "v": total[i, k]})

    split = F.col("split") if "split" in data.columns else F.lit("").alias("split")
    columns = [c for c in ("x", "places") if c in data.columns]
    sums = data.select(*columns, "y", split).mapInPandas(part, "split string, i int, k int, v double").groupBy("split", "i", "k").agg(F.sum("v").alias("v"))
    out = {}
    for name, own in sums.toPandas().groupby("split"):  # bounded by WIDEST
        m = np.zeros((wide + 1, wide))
        m[own.i, own.k] = own.v
        n, m = int(m[-1, 0]), m[:-1]
        m = m + np.triu(m, 1).T
        out[name] = Moments(n, m[:size, :size], m[:size, size:], np.diag(m)[size:].copy())
    return out


def cold_profiles(content: DataFrame, profiles: DataFrame, size: int, features: int, reg: float = 0.1, lasso: bool = False) -> np.ndarray:
    """Weights (features x latent dimensions) from content (id, idx, value) to profiles (id, profile), all dimensions in one aggregate.

    Items without content take no part; without any such row all weights are zero, so give the average profile instead.
    """
    rows = content.groupBy("id").agg(F.collect_list(F.struct("idx", "value")).alias("f")).join(profiles, "id")
    rows = rows.select(F.col("f.idx").alias("places"), F.col("f.value").alias("x"), F.slice("profile", 1, size).cast("array<double>").alias("y"))
    found = moments(rows, features, size).get("", Moments(0, np.zeros((features, features)), np.zeros((features, size)), np.zeros(size)))
    return found.lasso(reg) if lasso else found.ridge(reg)


def linear_grid(data: DataFrame, size: int, regs: list[float], lasso: bool = False) -> tuple[pd.DataFrame, list[Weights], int]:
    """Every candidate's errors (reg, train, validation, test; -1 without rows), the models, and the place of the chosen one.

    data: (x, y with one target, split 'tr', 'va' or 'te'). The least validation error wins, the first of equals.
    """
    found, none = moments(data, size), Moments(0, np.zeros((size, size)), np.zeros((size, 1)), np.zeros(1))
    parts = [found.get(s, none) for s in ("tr", "va", "te")]
    fits = [parts[0].lasso(r) if lasso else parts[0].ridge(r) for r in regs]
    errors = pd.DataFrame([(r, *(float(p.error(w)[0]) for p in parts)) for r, w in zip(regs, fits, strict=True)], columns=["reg", "train", "validation", "test"])
    return errors, [Weights(0.0, w) for w in fits], int(errors.validation.argmin())


#: Rows that are handled at once, rows of sums that a task gives out at once, and bytes of weights that may be broadcast.
ROWS, GIVEN, MOST_BYTES = 4096, 1 << 16, 1 << 30


@dataclass
class Sparse:
    """Rows of which few places are not zero; a product needs only the weights of these places."""

    rows: np.ndarray
    places: np.ndarray
    values: np.ndarray
    n: int

    def __matmul__(self, m: np.ndarray) -> np.ndarray:
        out = np.zeros((self.n, *m.shape[1:]))
        np.add.at(out, self.rows, self.values.reshape(-1, *[1] * (m.ndim - 1)) * m[self.places])
        return out

    def down(self, m: np.ndarray, size: int) -> np.ndarray:
        """The transposed product, for features 0 .. size - 1."""
        out = np.zeros((size, *m.shape[1:]))
        np.add.at(out, self.places, self.values.reshape(-1, *[1] * (m.ndim - 1)) * m[self.rows])
        return out


def design_of(rows: pd.DataFrame) -> np.ndarray | Sparse:
    """The features of some rows: x alone is dense; with places, x holds their values."""
    if "places" not in rows:
        return np.stack(rows.x.to_numpy()).astype(float)
    sizes = rows.places.map(len).to_numpy()
    flat = lambda c: np.concatenate(c.to_numpy()) if len(c) else np.zeros(0)
    return Sparse(np.repeat(np.arange(len(rows)), sizes), flat(rows.places).astype(np.int64), flat(rows.x).astype(float), len(rows))


def dense(rows: pd.DataFrame, size: int) -> np.ndarray:
    x = design_of(rows)
    if isinstance(x, np.ndarray):
        return x
    out = np.zeros((x.n, size))
    np.add.at(out, (x.rows, x.places), x.values)
    return out


def _down(x: np.ndarray | Sparse, m: np.ndarray, size: int) -> np.ndarray:
    return x.down(m, size) if isinstance(x, Sparse) else x.T @ m


@dataclass
class Weights:
    """w0, and a row (w, v_1 .. v_k) for each feature; a projection P for feature learning."""

    bias: float
    matrix: np.ndarray
    projection: np.ndarray | None = None
    losses: list[float] = field(default_factory=list)

    def predict(self, x: np.ndarray | Sparse) -> np.ndarray:
        g = x if self.projection is None else x @ self.projection
        return self.bias + g @ self.matrix[:, 0] + ((g @ self.matrix[:, 1:]) ** 2).sum(axis=1)

    def table(self, spark: SparkSession) -> DataFrame:
        """(part, row, column, value): all that a prediction needs, with zeros left out but for the last place of a part."""
        parts = {"bias": np.array([[self.bias]]), "matrix": self.matrix} | ({} if self.projection is None else {"projection": self.projection})
        rows = []
        for name, m in parts.items():
            keep = m != 0
            keep[-1, -1] = True
            rows += [(name, int(i), int(k), float(m[i, k])) for i, k in np.argwhere(keep)]
        return spark.createDataFrame(rows, WEIGHTS)

    @classmethod
    def of(cls, table: DataFrame) -> Weights:
        """The weights of a table that was saved."""
        found = table.toPandas()

        def part(name: str) -> np.ndarray | None:
            own = found[found.part == name]
            if not len(own):
                return None
            out = np.zeros((own.row.max() + 1, own.column.max() + 1))
            out[own.row, own.column] = own.value
            return out

        return cls(float(part("bias")[0, 0]), part("matrix"), part("projection"))


#: Linear models are weights without latent columns.
WEIGHTS = "part string, row int, column int, value double"


def predicted(data: DataFrame, w: Weights) -> DataFrame:
    """data with a prediction for each row of x."""
    schema = T.StructType([*data.schema.fields, T.StructField("prediction", T.DoubleType())])

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(prediction=w.predict(design_of(b)) if len(b) else np.zeros(0))

    return data.mapInPandas(part, schema)


def gradients(w: Weights, x: np.ndarray | Sparse, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Sums over rows of the gradient of half the squared error (bias, matrix, projection in a row), and of that error."""
    g = x if w.projection is None else x @ w.projection
    latent = g @ w.matrix[:, 1:]
    diff = w.bias + g @ w.matrix[:, 0] + (latent**2).sum(axis=1) - y
    down = _down(g, np.concatenate((diff[:, None], 2 * diff[:, None] * latent), axis=1), len(w.matrix))
    parts = [[diff.sum()], down.ravel()]
    if w.projection is not None:
        into = diff[:, None] * (w.matrix[:, 0] + 2 * latent @ w.matrix[:, 1:].T)
        parts.append(_down(x, into, len(w.projection)).ravel())
    return np.concatenate(parts), float((diff**2).sum() / 2)


@contextmanager
def shared(spark: SparkSession, models: list[Weights]) -> Iterator:
    """A broadcast of models, if they are not too large for one."""
    size = sum(m.nbytes for w in models for m in (w.matrix, w.projection) if m is not None)
    if size > MOST_BYTES:
        raise ValueError(f"{size} bytes of weights are more than {MOST_BYTES}: use fewer features, factors or candidates")
    sent = spark.sparkContext.broadcast(models)
    try:
        yield sent
    finally:
        sent.destroy()


def _flat(w: Weights) -> int:
    return 1 + w.matrix.size + (0 if w.projection is None else w.projection.size)


def summed_gradients(data: DataFrame, models: list[Weights]) -> list[tuple[np.ndarray, float, int]]:
    """(gradient sums, loss, rows) of each model, from one pass over data.

    Tasks give out a row (model, part, place, figures) for each feature that they touch; the bias has loss and count with it.
    """
    width = max(3, *(m.shape[1] for w in models for m in (w.matrix, w.projection) if m is not None))
    names = [f"c{k}" for k in range(width)]

    def tables(w: Weights, flat: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        yield 1, flat[1 : 1 + w.matrix.size].reshape(w.matrix.shape)
        if w.projection is not None:
            yield 2, flat[1 + w.matrix.size :].reshape(w.projection.shape)

    def rows(k: int, part: int, places: np.ndarray, values: np.ndarray) -> pd.DataFrame:
        out = pd.DataFrame(np.pad(values, ((0, 0), (0, width - values.shape[1]))), columns=names)
        return out.assign(model=k, part=part, place=places)[["model", "part", "place", *names]]

    def task(sent) -> Callable:
        def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            own = sent.value
            totals, losses, n = [np.zeros(_flat(w)) for w in own], [0.0] * len(own), 0
            for b in batches:
                for at in range(0, len(b), ROWS):
                    some = b.iloc[at : at + ROWS]
                    x, y = design_of(some), some.label.to_numpy(float)
                    n += len(some)
                    for k, w in enumerate(own):
                        g, loss = gradients(w, x, y)
                        totals[k] += g
                        losses[k] += loss
            for k, w in enumerate(own if n else ()):
                yield rows(k, 0, np.zeros(1, int), np.array([[totals[k][0], losses[k], n]]))
                for part, m in tables(w, totals[k]):
                    places = np.flatnonzero(m.any(axis=1))
                    for at in range(0, len(places), GIVEN):
                        yield rows(k, part, places[at : at + GIVEN], m[places[at : at + GIVEN]])

        return go

    columns = [c for c in ("x", "places") if c in data.columns]
    schema = "model int, part int, place int, " + ", ".join(f"{c} double" for c in names)
    with shared(data.sparkSession, models) as sent:
        sums = data.select(*columns, "label").mapInPandas(task(sent), schema).groupBy("model", "part", "place").agg(*(F.sum(c).alias(c) for c in names)).toPandas()
    out = []
    for k, w in enumerate(models):
        flat, own = np.zeros(_flat(w)), sums[sums.model == k]
        loss, n = 0.0, 0
        for part, some in own.groupby("part"):
            values = some[names].to_numpy()
            if part == 0:
                flat[0], loss, n = values[0, 0], float(values[0, 1]), int(values[0, 2])
            else:
                m = dict(tables(w, flat))[part]  # a view
                m[some.place.to_numpy()] = values[:, : m.shape[1]]
        out.append((flat, loss, n))
    return out


@dataclass
class Dealt:
    """Rows written in batches; a step reads one of them."""

    table: DataFrame
    batches: int

    def batch(self, i: int) -> DataFrame:
        return self.table.where(F.col("batch") == i % self.batches).drop("batch")


def dealt(data: DataFrame, batches: int) -> Dealt:
    """Rows dealt to batches by a hash of their places in data, so that equal rows spread; each row is in one batch."""
    rows = data.withColumn("batch", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(batches)).cast("int"))
    return Dealt(cut(rows.hint("rebalance", "batch"), "batches", ("batch",)), batches)


def soft_rows(m: np.ndarray, t: float) -> np.ndarray:
    """Rows shortened by t; shorter ones become zero."""
    return m * np.maximum(0, 1 - t / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300))


def soft(m: np.ndarray, t: float) -> np.ndarray:
    return np.sign(m) * np.maximum(np.abs(m) - t, 0)


@dataclass
class Fit:
    """A model that is to be trained: its start, how a step and the penalty's part of it are taken, what the penalty is worth."""

    start: Weights
    update: Callable[[Weights, Weights, float], Weights]
    penalty: Callable[[Weights], float]
    step: float
    rounds: int
    momentum: bool = False
    freeze_intercept: bool = False


def descend(data: DataFrame | Dealt, fits: list[Fit], seed: int = 42) -> list[Weights]:
    """Gradient descent of all fits, which share each step's pass; of Dealt rows a step reads one batch, each in turn.

    In step i the gradient at the weights is taken off by step / sqrt(i), with momentum from the point (t - 1) / t beyond them, as seen
    from the weights before; t grows from 1 to (1 + sqrt(1 + 4 t t)) / 2. A model's losses are those before each of its steps, with the
    penalty. A step without rows changes nothing.
    """
    now, before, t = [f.start for f in fits], [f.start for f in fits], [1.0] * len(fits)
    losses: list[list[float]] = [[] for _ in fits]
    for i in range(1, max((f.rounds for f in fits), default=0) + 1):
        at = [k for k, f in enumerate(fits) if i <= f.rounds]
        rows = data.batch(seed + i) if isinstance(data, Dealt) else data
        for k, (total, loss, n) in zip(at, summed_gradients(rows, [now[k] for k in at]), strict=True):
            if not n:
                continue
            f, w = fits[k], now[k]
            losses[k].append(loss / n + f.penalty(w))
            g, size = total / n, w.matrix.size
            rest = g[1 + size :].reshape(w.projection.shape) if w.projection is not None else None
            grad = Weights(0.0 if f.freeze_intercept else g[0], g[1 : 1 + size].reshape(w.matrix.shape), rest)
            start = _mix(w, before[k], (t[k] - 1) / t[k]) if f.momentum else w
            before[k], now[k] = w, f.update(start, grad, f.step / np.sqrt(i))
            t[k] = (1 + np.sqrt(1 + 4 * t[k] * t[k])) / 2
    for w, own in zip(now, losses, strict=True):
        w.losses = own
    return now


def _mix(a: Weights, b: Weights, pull: float) -> Weights:
    p = None if a.projection is None else a.projection + pull * (a.projection - b.projection)
    return Weights(a.bias + pull * (a.bias - b.bias), a.matrix + pull * (a.matrix - b.matrix), p)


def fm_l2(size: int, factors: int = 5, step: float = 1e-3, rounds: int = 100, reg: float = 0.01, **options) -> Fit:
    """Shrinks all but the intercept; starts at 1 / size everywhere."""
    update = lambda w, g, s: Weights(w.bias - s * g.bias, w.matrix * (1 - s * reg) - s * g.matrix)
    penalty = lambda w: reg / 2 * float((w.matrix**2).sum())
    return Fit(Weights(0.0, np.full((size, factors + 1), 1 / size)), update, penalty, step, rounds, **options)


def _lengths(m: np.ndarray) -> float:
    return float(np.linalg.norm(m, axis=1).sum())


def fm_l21(size: int, factors: int = 5, step: float = 1e-3, rounds: int = 100, l21: float = 0.01, **options) -> Fit:
    """Drops whole features: a soft threshold on the length of each feature's row."""
    update = lambda w, g, s: Weights(w.bias - s * g.bias, soft_rows(w.matrix - s * g.matrix, s * l21))
    start = np.random.default_rng(52).normal(size=(size, factors + 1)) * 0.01
    return Fit(Weights(0.0, start), update, lambda w: l21 * _lengths(w.matrix), step, rounds, **options)


def fm_feature_learning(size: int, factors: int = 5, learned: int | None = None, step: float = 1e-3, rounds: int = 100, l1: float = 0.01, l21: float = 0.01, **options) -> Fit:
    """Learns a projection of the features (sparse by entries and by rows) below the machine."""
    learned = learned or 2 * factors
    rnd = np.random.default_rng(52)

    def update(w: Weights, g: Weights, s: float) -> Weights:
        return Weights(w.bias - s * g.bias, w.matrix - s * g.matrix, soft_rows(soft(w.projection - s * g.projection, s * l1), s * l21))

    start = Weights(0.0, rnd.normal(size=(learned, factors + 1)) * 0.01, rnd.normal(size=(size, learned)) * 0.01)
    return Fit(start, update, lambda w: l1 * float(np.abs(w.projection).sum()) + l21 * _lengths(w.projection), step, rounds, **options)


def mean_squared_errors(data: DataFrame, models: list[Weights]) -> list[float]:
    """Of each model, from one pass; -1 without rows."""

    def task(sent) -> Callable:
        def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums, n = np.zeros(len(sent.value)), 0
            for b in batches:
                if len(b):
                    x, y, n = design_of(b), b.label.to_numpy(float), n + len(b)
                    sums += [((w.predict(x) - y) ** 2).sum() for w in sent.value]
            yield pd.DataFrame({"model": range(len(sums)), "s": sums, "n": n})

        return go

    columns = [c for c in ("x", "places") if c in data.columns]
    with shared(data.sparkSession, models) as sent:
        got = data.select(*columns, "label").mapInPandas(task(sent), "model int, s double, n long").groupBy("model").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()
    found = {r["model"]: r["s"] / r["n"] for r in got if r["n"]}
    return [found.get(k, -1.0) for k in range(len(models))]


def mean_squared_error(data: DataFrame, w: Weights) -> float:
    return mean_squared_errors(data, [w])[0]


def grid_search(train: DataFrame | Dealt, held_out: dict[str, DataFrame], fits: list[Fit]) -> tuple[Weights, int, pd.DataFrame]:
    """The model with the least validation error, the first of equals; its place; and every candidate's error by part of the rows.

    Candidates share the passes: as many jobs as the most rounds, and one for each part.
    """
    models = descend(train, fits)
    whole = train.table if isinstance(train, Dealt) else train
    errors = pd.DataFrame({name: mean_squared_errors(rows, models) for name, rows in {"train": whole, **held_out}.items()})
    at = int(errors.validation.argmin())
    return models[at], at, errors
