"""Scores of users and items, and metrics."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from airwave.functions import vectors
from airwave.sources.artifacts import cut


def completed(ids: DataFrame, profiles: DataFrame, on: str, column: str, fallback: DataFrame) -> DataFrame:
    """Profiles of ids; where there is none, the fallback's one profile."""
    rows = ids.select(on).distinct().join(profiles, on, "left").crossJoin(F.broadcast(fallback.withColumnRenamed(column, "__cold")))
    return rows.select(on, F.coalesce(column, "__cold").alias(column))


def mean_profile(profiles: DataFrame, column: str, size: int) -> DataFrame:
    """One row: the mean profile, for cold users or items."""
    return profiles.agg(F.array(*(F.avg(F.get(column, F.lit(k))) for k in range(size))).alias(column))


def pair_scores(pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Given pairs with their payload, and the dot product of their profiles."""
    return pairs.join(users, "user").join(items, "item").withColumn("score", vectors.dot(F.col("uf"), F.col("vf"))).drop("uf", "vf")


#: Rows of items that are broadcast at once; profiles of a hundred numbers are about a KB a row.
BLOCK_ROWS = 50_000


def with_seen(users: DataFrame, seen: DataFrame) -> DataFrame:
    """users that have a seen set, with its items as an array: a user's own history."""
    own = seen.groupBy("user").agg(F.collect_set("item").alias("seen_items"))
    return users.join(own, "user")


def all_pairs(
    users: DataFrame, items: DataFrame, score: Column, reduced: Callable[[DataFrame], DataFrame] = lambda pairs: pairs, block: int = BLOCK_ROWS
) -> DataFrame:
    """Every user with every item, by broadcasts of items that are counted to be small enough.

    Where items are more than a block and users are not, the users are broadcast. Else items are dealt into blocks by a hash; each is
    broadcast and reduced by itself, so give as ``reduced`` what may follow at once, as the best n of each user, and reduce the union
    again. users may carry seen_items.
    """
    n = max(1, -(-items.count() // block))
    if n > 1 and users.count() <= block:
        return reduced(few_users(users, items, score))
    own = lambda k: items if n == 1 else items.where(F.pmod(F.xxhash64("item"), F.lit(n)) == k)
    pairs = (_scored_pairs(users.crossJoin(F.broadcast(own(k))), score) for k in range(n))
    return reduce(DataFrame.unionByName, map(reduced, pairs))


def few_users(users: DataFrame, items: DataFrame, score: Column) -> DataFrame:
    """Every item with users that are known to be few: these are broadcast, and no item passes through the driver."""
    return _scored_pairs(items.crossJoin(F.broadcast(users)), score)


def _scored_pairs(pairs: DataFrame, score: Column) -> DataFrame:
    columns = [F.array_contains("seen_items", F.col("item")).alias("seen")] if "seen_items" in pairs.columns else []
    return pairs.select("user", "item", score.alias("score"), *columns)


def profile_pairs(users: DataFrame, items: DataFrame, score: Column, reduced: Callable[[DataFrame], DataFrame], block: int = BLOCK_ROWS) -> DataFrame:
    """What reduced makes of every user's scores with all items, for each user.

    Equal profiles have equal scores: pairs of distinct profiles are joined by all_pairs, and carry as n the number of items that have
    the profile, by which reduced has to weigh them. reduced groups by "user", a struct of the profile here, and takes what it gave
    once more, with the blocks' results. The users of a profile all get its figures. Where no two profiles are equal, these are all pairs.
    """
    users, mine = cut(users, "pair-users"), [c for c in users.columns if c != "user"]
    like = items.groupBy(*(c for c in items.columns if c != "item")).agg(F.count("*").alias("item"))
    like = cut(like.withColumnRenamed("item", "n").withColumn("item", F.monotonically_increasing_id()), "item-profiles")
    who = F.struct(*mine).alias("user")
    pairs = all_pairs(cut(users.select(who, *mine).distinct(), "user-profiles"), like, F.struct(score.alias("score"), "n").alias("score"), lambda rows: reduced(rows.select("user", "score.*")), block)
    return users.select("user", who.alias("__profile")).join(pairs.withColumnRenamed("user", "__profile"), "__profile").drop("__profile")


#: Scores that a task holds at once.
CELLS = 1 << 21
#: Numbers of items that are broadcast at once for a search.
NUMBERS = 1 << 24
#: Least items of a leaf, neighbours in profile that are searched or left out together. The square root of a block's items if that is more: then
#: a user's bounds and the scores of a leaf are as many.
LEAF = 256
#: Users of near directions that share a list of items at most; scores that are few enough to be worked out without a shorter list. Items that the
#: least of the best scores is taken from, and the longest ones that they are chosen among.
GROUP, FEW, TRIED, LONGEST = 256, 1 << 14, 512, 4096
#: Slots that an item may be in, on average, for a block of items to be broadcast whole.
SLOTS_AN_ITEM = 24


@dataclass(frozen=True)
class Bounded:
    """A score with what it is at most for items in a box, and as a product of vectors.

    most takes the columns of users, and the least and largest columns of items of each box. It has to add up in the order of pairs: rounding
    is monotone, so no score is above its bound by a last digit.

    Where it is given, scores of a user are products of a vector of the user with vectors of items, and what depends on the user alone. error says how far a
    score may be from that, given the columns of users and the largest sizes in the columns of items.
    """

    pairs: Callable[[dict, dict], np.ndarray]
    most: Callable[[dict, dict, dict], np.ndarray]
    of_users: Callable[[dict], np.ndarray] | None = None
    of_items: Callable[[dict], np.ndarray] | None = None
    error: Callable[[dict, dict], np.ndarray] | None = None

    def __call__(self, users: dict, items: dict) -> np.ndarray:
        return self.pairs(users, items)


def best_items(users: DataFrame, items: DataFrame, score: Callable[[dict, dict], np.ndarray], n: int, block: int | None = None) -> DataFrame:
    """(user, item, score, kind): for each user the best n items of all and, where users carry seen_items, of those not seen.

    score takes the columns of some users and of a block of items as arrays, with shapes (users, 1, ...) and (items, ...), and gives the
    scores of all their pairs. Items are broadcast in blocks, of NUMBERS numbers if not told otherwise, and the blocks' lists are ranked again.
    With a Bounded score users of near directions share a list of the items that may be among the best of one of them, and users without a
    direction search leaves of near profiles; both leave out what is bounded below the best n: the result is that of all pairs. Another score is worked out for all pairs, CELLS at a time. No row is made for what is not among
    the best, and nothing is sorted but these. Equal scores are ranked by item.
    """
    profile = [c for c in items.columns if c != "item"]
    wide = [F.coalesce(F.max(F.size(c)), F.lit(1)) if isinstance(items.schema[c].dataType, T.ArrayType) else F.lit(1) for c in profile]
    size = items.agg(F.count("*").alias("rows"), sum(wide, F.lit(1)).alias("numbers")).first()
    blocks = _blocks(items, size.rows, block or max(1, NUMBERS // size.numbers))
    users = users if len(blocks) == 1 else cut(users, "ranked-users")
    context, kinds = users.sparkSession.sparkContext, ("all", "new") if "seen_items" in users.columns else ("all",)
    user, item = (t.schema[c].dataType.simpleString() for t, c in ((users, "user"), (items, "item")))
    made = T.StructType.fromDDL(f"user {user}, item {item}, score double, kind string, rank int")
    schema = to_arrow_schema(made)

    def part(shared):
        def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = _grouped if isinstance(score, Bounded) else _all_scored
            for mine, kind, r, c, scores in found(batches, shared.value, score, kinds, n):
                rank = (np.arange(len(r)) - np.searchsorted(r, r) + 1).astype(np.int32)
                columns = mine["user"].ravel()[r], c, scores, [kind] * len(r), rank
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema, strict=True)], schema=schema)

        return go

    known = (_arrays(own.orderBy("item").toArrow()) for own in blocks)
    lists = [users.mapInArrow(part(context.broadcast((Leaves.of(x), Longest.of(x, score)) if isinstance(score, Bounded) else x)), made) for x in known]
    if len(lists) == 1:
        return lists[0]
    order = Window.partitionBy("user", "kind").orderBy(F.desc("score"), "item")
    return reduce(DataFrame.unionByName, lists).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def _seen(rows: pa.RecordBatch, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place of an item) of what the users have seen of some sorted items."""
    lists = rows.column(rows.schema.get_field_index("seen_items"))
    who, what = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy(zero_copy_only=False)
    place = np.minimum(np.searchsorted(items, what), len(items) - 1)
    hit = items[place] == what
    return who[hit], place[hit]


def _all_scored(batches: Iterator[pa.RecordBatch], known: dict, score: Callable, kinds: tuple[str, ...], n: int) -> Iterator[tuple]:
    """(users' columns, kind, row, item, score) of the best n, from all scores."""
    for rows, mine, scores in _scored(batches, known, score):
        for kind in kinds:
            if kind == "new":
                scores[_seen(rows, known["item"])] = -np.inf
            r, c = _best(scores, n)
            yield mine, kind, r, known["item"][c], scores[r, c]


@dataclass
class Leaves:
    """Items in leaves of near profiles: halves at the median of the widest column, as long as they are larger than a leaf."""

    item: np.ndarray  # sorted
    place: np.ndarray  # of the items in the order of leaves
    at: np.ndarray  # of items in the order of leaves
    starts: np.ndarray
    columns: dict[str, np.ndarray]  # in the order of leaves
    lo: dict[str, np.ndarray]
    hi: dict[str, np.ndarray]
    least: np.ndarray  # first place of each leaf; leaves are in this order

    @classmethod
    def of(cls, known: dict[str, np.ndarray]) -> Leaves:
        size = len(known["item"])
        most = max(LEAF, math.isqrt(size))
        columns = {c: x for c, x in known.items() if c != "item"}
        if not size:
            none = np.zeros(0, np.int64)
            return cls(none, none, none, none, columns, columns, columns, none)
        profile, open_, leaves = np.column_stack([x.reshape(size, -1) for x in columns.values()]), [np.arange(size)], []
        while open_:
            own = open_.pop()
            if len(own) <= most:
                leaves.append(np.sort(own))
                continue
            widths = np.ptp(profile[own], axis=0)
            if not widths.max() > 0:
                own = np.sort(own)
                leaves += [own[at : at + most] for at in range(0, len(own), most)]
                continue
            own = own[np.argsort(profile[own, widths.argmax()], kind="stable")]
            open_ += [own[: len(own) // 2], own[len(own) // 2 :]]
        leaves.sort(key=lambda x: x[0])
        place, starts = np.concatenate(leaves), np.cumsum([0, *map(len, leaves)])
        at = np.empty(size, np.int64)
        at[place] = np.arange(size)
        columns = {c: x[place] for c, x in columns.items()}
        lo, hi = ({c: np.ascontiguousarray(f.reduceat(x, starts[:-1], axis=0)) for c, x in columns.items()} for f in (np.minimum, np.maximum))
        return cls(known["item"], place, at, starts, columns, lo, hi, place[starts[:-1]])


@dataclass
class Longest:
    """Items by the lengths of their vectors, seen from the mean vector: it adds the same to all scores of a user. The longest come first."""

    place: np.ndarray  # of the item among all, which are sorted
    vector: np.ndarray  # single precision; what is decided by them allows for it
    length: np.ndarray
    copy: np.ndarray  # items before this one that have the same profile
    reach: dict[str, np.ndarray]  # largest sizes in the columns
    error: float  # of a product with a direction

    @classmethod
    def of(cls, known: dict[str, np.ndarray], score: Bounded) -> Longest | None:
        """None if there is no item, or one without a finite vector, or the score is no product."""
        if not len(known["item"]) or score.of_items is None:
            return None
        vector = np.asarray(score.of_items(known), float)
        size = float(np.abs(vector).max(initial=0)) * math.sqrt(vector.shape[1])
        if not size < 1e30:
            return None
        copy = _copies(np.column_stack([np.asarray(x, float).reshape(len(x), -1) for c, x in known.items() if c != "item"]))
        vector = (vector - vector.mean(axis=0)).astype(np.float32)
        length = np.sqrt(np.einsum("ij,ij->i", vector, vector))
        place = np.argsort(-length, kind="stable")
        reach = {c: np.abs(x).max(axis=0) for c, x in known.items() if c != "item"}
        return cls(place.astype(np.int32), vector[place], length[place], copy[place], reach, 4e-7 * vector.shape[1] * size)


def _copies(vectors: np.ndarray) -> np.ndarray:
    """How many rows before are equal; less where unequal rows fall on one key."""
    key = np.zeros(len(vectors))
    for x, w in zip(vectors.T, np.random.default_rng(1).normal(size=vectors.shape[1]), strict=True):
        key += w * x
    order = np.argsort(key, kind="stable")
    new = np.concatenate(([True], (np.diff(vectors[order], axis=0) != 0).any(axis=1)))
    copy = np.empty(len(vectors), np.int32)
    copy[order] = np.arange(len(order)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    return copy


def _grouped(batches: Iterator[pa.RecordBatch], known: tuple[Leaves, Longest | None], score: Bounded, kinds: tuple[str, ...], n: int) -> Iterator[tuple]:
    """What _all_scored gives: users with a direction in groups, the others from leaves."""
    leaves, longest = known
    for batch in batches:
        if not len(leaves.item) or not batch.num_rows:
            continue
        plain = np.arange(batch.num_rows)
        if longest is not None:
            mine = _arrays(pa.Table.from_batches([batch]), ("seen_items",))
            groups = _Groups(mine, leaves, longest, score, n, _seen(batch, leaves.item) if "new" in kinds else None)
            yield from groups.run()
            plain = np.flatnonzero(~groups.directed)
        if len(plain):
            yield from _searched([batch.take(pa.array(plain))], leaves, score, kinds, n)


class _Groups:
    """The best n of some users. Users of near directions share a list of items, halves of a group what is left of its list.

    Every user of a group has n unseen items above what is the least of the users' n-th best scores among a few items, if as many more
    are counted as one of them has seen. An item stays in the list if it may reach that for a direction within the group's cone.
    """

    def __init__(self, mine: dict, leaves: Leaves, known: Longest, score: Bounded, n: int, seen: tuple | None) -> None:
        self.mine, self.leaves, self.known, self.score, self.n = mine, leaves, known, score, n
        vector = np.asarray(score.of_users(mine), float)
        with np.errstate(all="ignore"):
            length = np.sqrt((vector**2).sum(axis=1))
            self.margin = np.asarray(score.error(mine, known.reach), float) / length + known.error
            self.unit = (vector / length[:, None]).astype(np.float32)
            self.directed = np.isfinite(self.unit).all(axis=1) & (length > 0) & (self.margin <= 1e-3 * known.length[0])
        self.seen = seen
        if seen is not None:
            self.starts = np.searchsorted(seen[0], np.arange(len(length) + 1))
            self.at = np.full(len(leaves.item), -1, np.int32)  # of items in a group's list

    def run(self) -> Iterator[tuple]:
        n_seen = np.diff(self.starts) if self.seen is not None else np.zeros(len(self.unit), np.int64)
        few = np.log2(1 + n_seen).astype(int) // 2  # so users who have seen much keep the others' lists short
        for k in np.unique(few[self.directed]):
            rows = np.flatnonzero(self.directed & (few == k))
            once = self.known.copy < self.n + n_seen[rows].max()
            open_ = [(rows, np.flatnonzero(once))]
            while open_:
                rows, items = open_.pop()
                if len(rows) <= GROUP:
                    items = self.left(rows, items)
                if len(rows) == 1 or (len(rows) <= GROUP and len(rows) * len(items) <= FEW):
                    yield from self.scored(rows, items)
                    continue
                rows = rows[np.argsort(self.unit[rows, np.ptp(self.unit[rows], axis=0).argmax()], kind="stable")]
                open_ += [(rows[: len(rows) // 2], items), (rows[len(rows) // 2 :], items)]

    def seen_in(self, rows: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of a row, place in the list) of what the rows have seen of a list of places of items."""
        sizes = self.starts[rows + 1] - self.starts[rows]
        who = np.repeat(np.arange(len(rows)), sizes)
        what = self.seen[1][np.repeat(self.starts[rows] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
        self.at[items] = np.arange(len(items))
        at = self.at[what]
        self.at[items] = -1
        return who[at >= 0], at[at >= 0]

    def left(self, rows: np.ndarray, items: np.ndarray) -> np.ndarray:
        """The items of a list, longest first, that may be among the best of one of some users."""
        known, unit, need = self.known, self.unit[rows], self.n
        if self.seen is not None:
            # what a user has seen is counted in the list if that is short, else as a whole
            if len(items) > LONGEST:
                need += int((self.starts[rows + 1] - self.starts[rows]).max())
            else:
                need += int(np.bincount(self.seen_in(rows, known.place[items])[0], minlength=1).max())
        if len(items) <= need:
            return items
        middle = unit.mean(axis=0)
        middle /= max(float(np.sqrt((middle**2).sum())), 1e-30)
        first = items[: max(LONGEST, 8 * need)]
        tried = max(TRIED, 4 * need)
        if len(first) > tried:
            first = first[np.argpartition(-(known.vector[first] @ middle), tried - 1)[:tried]]
        scores = unit @ known.vector[first].T
        least = float(np.partition(scores, len(first) - need, axis=1)[:, len(first) - need].min()) - float(self.margin[rows].max())
        items = items[: int(np.searchsorted(items, len(known.length) - np.searchsorted(known.length[::-1], np.float32(least))))]
        # the largest product with a direction of the cone; its angle is taken a little wider
        narrow = min(1.0, max(-1.0, float((unit @ middle).min()) - 1e-6))
        length, along = known.length[items], known.vector[items] @ middle
        most = along * narrow + np.sqrt(np.maximum(length**2 - along**2, 0)) * math.sqrt(1 - narrow**2)
        return items[(along >= length * narrow) | (most >= least)]

    def scored(self, rows: np.ndarray, items: np.ndarray) -> Iterator[tuple]:
        """The best n of each user of a list that holds them, by the scores themselves."""
        place = np.sort(self.known.place[items])
        known = {c: x[self.leaves.at[place]] for c, x in self.leaves.columns.items()}
        step = max(1, CELLS // len(place))
        for first in range(0, len(rows), step):
            some = rows[first : first + step]
            mine = {c: x[some] for c, x in self.mine.items()}
            scores = np.array(self.score({c: x[:, None] for c, x in mine.items()}, known), float)
            for kind in ("all", "new") if self.seen is not None else ("all",):
                if kind == "new":
                    scores[self.seen_in(some, place)] = -np.inf
                r, c = _best(scores, self.n)
                yield mine, kind, r, self.leaves.item[place[c]], scores[r, c]


def _searched(batches: Iterable[pa.RecordBatch], known: Leaves, score: Bounded, kinds: tuple[str, ...], n: int) -> Iterator[tuple]:
    """What _all_scored gives, from the leaves that may hold it. The first round searches a user's best leaf, each further one twice as many."""
    size = len(known.item)
    step = max(1, CELLS // max(LEAF, math.isqrt(size), len(known.least)))
    for batch in batches:
        for first in range(0, batch.num_rows if size else 0, step):
            rows = batch.slice(first, step)
            mine = {c: x[:, None] for c, x in _arrays(pa.Table.from_batches([rows]), ("seen_items",)).items()}
            search = _Search(mine, known, score, n, len(rows), _seen(rows, known.item) if "new" in kinds else None)
            search.run()
            for kind, (scores, places) in zip(kinds, search.best, strict=True):
                r, c = np.nonzero(scores > -np.inf)
                yield mine, kind, r, known.item[places[r, c]], scores[r, c]


class _Search:
    """The best n of some users among leaves: of all items, and of unseen ones."""

    def __init__(self, mine: dict, known: Leaves, score: Bounded, n: int, rows: int, seen: tuple | None) -> None:
        self.mine, self.known, self.score, self.n = mine, known, score, n
        self.bounds = np.array(score.most(mine, known.lo, known.hi), float)
        #: Scores and places of the best so far, best first. The last list is the one that needs most: of what is not seen.
        self.best = [(np.full((rows, n), -np.inf), np.full((rows, n), len(known.item))) for _ in range(1 if seen is None else 2)]
        if seen is not None:
            who, at = seen[0], known.at[seen[1]]
            order = np.argsort(at, kind="stable")
            self.seen_rows, self.seen_at = who[order], at[order]

    def run(self) -> None:
        active, many = np.arange(len(self.bounds)), 1
        while len(active):
            bounds = self.bounds[active]
            many = min(many, bounds.shape[1])
            leaf = bounds.argmax(axis=1)[:, None] if many == 1 else np.argpartition(-bounds, many - 1, axis=1)[:, :many]
            row, leaf = np.repeat(active, many), leaf.ravel()
            some = self.bounds[row, leaf] > -np.inf
            order = np.argsort(leaf[some], kind="stable")
            row, leaf = row[some][order], leaf[some][order]
            if not len(leaf):  # scores that are no numbers
                return
            found, held = [[] for _ in self.best], 0
            ends = [*(np.flatnonzero(np.diff(leaf)) + 1).tolist(), len(leaf)]
            for a, b in zip([0, *ends], ends, strict=False):
                held += self.leaf(leaf[a], row[a:b], found)
                if held > CELLS // 4:
                    self.merge(found)
                    found, held = [[] for _ in self.best], 0
            self.merge(found)
            self.bounds[row, leaf] = -np.inf
            active, many = self.left_out(active), many * 2

    def left_out(self, rows: np.ndarray) -> np.ndarray:
        """Leaves that cannot hold one of the best go for good; the rows that have others."""
        scores, places = (x[rows, -1, None] for x in self.best[-1])
        bounds = self.bounds[rows]
        left = (bounds > scores) | ((bounds == scores) & (bounds > -np.inf) & (self.known.least < places))
        self.bounds[rows] = np.where(left, bounds, -np.inf)
        return rows[left.any(axis=1)]

    def leaf(self, k: int, rows: np.ndarray, found: list) -> int:
        """The best n of a leaf for each of some users, as far as they are not below the best so far."""
        a, b = self.known.starts[k : k + 2]
        scores = np.asarray(self.score({c: x[rows] for c, x in self.mine.items()}, {c: x[a:b] for c, x in self.known.columns.items()}), float)
        held = 0
        for kind, (best, _) in enumerate(self.best):
            if kind:
                lo, hi = np.searchsorted(self.seen_at, (a, b))
                at = np.minimum(np.searchsorted(rows, self.seen_rows[lo:hi]), len(rows) - 1)
                hit = rows[at] == self.seen_rows[lo:hi]
                scores[at[hit], self.seen_at[lo:hi][hit] - a] = -np.inf
            keep = np.flatnonzero(scores.max(axis=1) >= best[rows, -1])
            if len(keep):
                first = np.argsort(-scores[keep], axis=1, kind="stable")[:, : self.n]
                found[kind].append((np.repeat(rows[keep], first.shape[1]), scores[keep[:, None], first].ravel(), self.known.place[a + first].ravel()))
                held += first.size
        return held

    def merge(self, found: list) -> None:
        for (scores, places), new in zip(self.best, found, strict=True):
            if not new:
                continue
            row, s, p = (np.concatenate(x) for x in zip(*new, strict=True))
            keep = s > -np.inf
            own = np.unique(row[keep])
            row, s, p = (np.concatenate(x) for x in ((row[keep], np.repeat(own, self.n)), (s[keep], scores[own].ravel()), (p[keep], places[own].ravel())))
            order = np.lexsort((p, -s, row))
            row, s, p = row[order], s[order], p[order]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            few = rank < self.n
            scores[row[few], rank[few]], places[row[few], rank[few]] = s[few], p[few]


def best_in_slots(users: DataFrame, items: DataFrame, offers: DataFrame, score: Callable[[dict, dict], np.ndarray], n: int, block: int = BLOCK_ROWS) -> DataFrame:
    """(user, slot, rank, item, score): for each user the best n of the items that each slot offers.

    offers: (slot, item), such as programs that start in an hour. Scores are worked out once for each user and item, as in best_items,
    and a slot is a mask over the items of the block: n rows leave a task for each user and slot, not a row for each pair. Items go in
    blocks so that a block's items and offers are bounded. With one block its lists are the result; else the
    lists of blocks, n rows each, are merged by rank.
    """
    offers = offers.where(F.col("item").isNotNull()).distinct()
    offered = cut(items.join(offers.groupBy("item").agg(F.sort_array(F.collect_set("slot")).alias("slots")), "item"), "offered-items")
    blocks = _blocks(offered, max(offered.count(), offers.count() // SLOTS_AN_ITEM), block)
    context = users.sparkSession.sparkContext
    user, item, slot = (t.schema[c].dataType.simpleString() for t, c in ((users, "user"), (items, "item"), (offers, "slot")))
    made = T.StructType.fromDDL(f"user {user}, slot {slot}, rank int, item {item}, score double")
    schema = to_arrow_schema(made)

    def part(shared):
        def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, masks = shared.value
            for _, mine, scores in _scored(batches, known, score):
                for name, places in masks:
                    own = scores[:, places]
                    r, c = _best(own, n)
                    if not len(r):
                        continue
                    rank = (np.arange(len(r)) - np.searchsorted(r, r) + 1).astype(np.int32)
                    columns = mine["user"][r], [name] * len(r), rank, known["item"][places[c]], own[r, c]
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema, strict=True)], schema=schema)

        return go

    lists = []
    for own in blocks:
        table = own.orderBy("item").toArrow()
        slots: dict = {}
        for place, names in enumerate(table.column("slots").to_pylist()):
            for name in names:
                slots.setdefault(name, []).append(place)
        shared = context.broadcast((_arrays(table.drop(["slots"])), [(name, np.array(places)) for name, places in sorted(slots.items())]))
        lists.append(users.mapInArrow(part(shared), made))
    if len(lists) == 1:
        return lists[0]
    order = Window.partitionBy("user", "slot").orderBy(F.desc("score"), "item")
    return reduce(DataFrame.unionByName, lists).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def _blocks(items: DataFrame, rows: int, block: int) -> list[DataFrame]:
    """items without null ids, dealt by a hash so that a block has about so many rows."""
    n, items = max(1, -(-rows // block)), items.where(F.col("item").isNotNull())
    return [items if n == 1 else items.where(F.pmod(F.xxhash64("item"), F.lit(n)) == k) for k in range(n)]


def _arrays(table: pa.Table, skip: tuple[str, ...] = ()) -> dict[str, np.ndarray]:
    """Columns as arrays; lists of one length as matrices."""
    return {c: _array(table.column(c).combine_chunks()) for c in table.schema.names if c not in skip}


def _array(x: pa.Array | pa.ChunkedArray) -> np.ndarray:
    x = pa.concat_arrays(x.chunks) if isinstance(x, pa.ChunkedArray) else x
    if not pa.types.is_list(x.type):
        return np.array(x.to_pylist()) if x.null_count or not pa.types.is_primitive(x.type) else x.to_numpy(zero_copy_only=False)
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1) if len(x) else np.zeros((0, 0))


def _scored(batches: Iterator[pa.RecordBatch], known: dict, score: Callable[[dict, dict], np.ndarray]) -> Iterator[tuple]:
    """(rows, their columns, scores of all their pairs): CELLS scores at a time."""
    size = len(known["item"])
    step = max(1, CELLS // max(1, size))
    for batch in batches:
        for at in range(0, batch.num_rows if size else 0, step):
            rows = batch.slice(at, step)
            mine = _arrays(pa.Table.from_batches([rows]), ("seen_items",))
            yield rows, mine, np.asarray(score({c: x[:, None] for c, x in mine.items()}, known), float)


def _best(scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the n largest scores of each row, the first column first among equals; -inf is no score."""
    least = np.partition(scores, scores.shape[1] - n, axis=1)[:, scores.shape[1] - n, None] if scores.shape[1] > n else -np.inf
    r, c = np.nonzero((scores >= least) & (scores > -np.inf))
    order = np.lexsort((c, -scores[r, c], r))
    r, c = r[order], c[order]
    few = np.arange(len(r)) - np.searchsorted(r, r) < n
    return r[few], c[few]


def dot_scores(digits: int = 9) -> Bounded:
    """Dot products of uf and vf, added up in order, to so many digits."""

    def score(users: dict, items: dict) -> np.ndarray:
        total = 0.0
        for k in range(items["vf"].shape[-1]):
            total = total + users["uf"][..., k] * items["vf"][..., k]
        return np.round(total, digits)

    def most(users: dict, lo: dict, hi: dict) -> np.ndarray:
        total = 0.0
        for k in range(lo["vf"].shape[-1]):
            own = users["uf"][..., k]
            total = total + np.maximum(own * lo["vf"][..., k], own * hi["vf"][..., k])
        return np.round(total, digits)

    def error(users: dict, reach: dict) -> np.ndarray:
        return 1.01 * 10.0**-digits + 1e-12 * (np.abs(users["uf"]) @ reach["vf"])

    return Bounded(score, most, lambda users: users["uf"], lambda items: items["vf"], error)


def factorisation_scores(bias: float) -> Bounded:
    """bias + w.x + |V'x|^2 from both sides' shares (lu, vu) and (li, vi), added up in order."""

    def score(users: dict, items: dict) -> np.ndarray:
        total = bias + users["lu"] + items["li"]
        for k in range(items["vi"].shape[-1]):
            total = total + (users["vu"][..., k] + items["vi"][..., k]) ** 2
        return total

    def most(users: dict, lo: dict, hi: dict) -> np.ndarray:
        total = bias + users["lu"] + hi["li"]
        for k in range(lo["vi"].shape[-1]):
            own = users["vu"][..., k]
            total = total + np.maximum((own + lo["vi"][..., k]) ** 2, (own + hi["vi"][..., k]) ** 2)
        return total

    def error(users: dict, reach: dict) -> np.ndarray:
        sizes = 2 * ((users["vu"] ** 2).sum(axis=1) + (reach["vi"] ** 2).sum())
        return 1e-12 * (abs(bias) + np.abs(users["lu"]) + reach["li"] + sizes)

    def of_users(users: dict) -> np.ndarray:
        return np.column_stack((np.ones(len(users["vu"])), 2 * users["vu"]))

    def of_items(items: dict) -> np.ndarray:
        return np.column_stack((items["li"] + (items["vi"] ** 2).sum(axis=1), items["vi"]))

    return Bounded(score, most, of_users, of_items, error)


def partial_model(block: DataFrame, weights: DataFrame, latent: int) -> DataFrame:
    """(id, linear, latent sums): one side's share of a factorisation model, worked out once for each id.

    weights: (idx, w, v0, v1, ...). A pair's score needs only both sides' shares, not their joined vectors.
    """
    rows = block.join(weights, "idx")
    sums = [F.sum(F.col("value") * F.col(f"v{k}")) for k in range(latent)]
    return rows.groupBy("id").agg(F.sum(F.col("value") * F.col("w")).alias("linear"), F.array(*sums).alias("latent"))


def combined(a: Column, b: Column, la: Column, lb: Column, w0: float = 0.0) -> Column:
    """w0 + w.x + |V'x|^2 from the two sides' shares."""
    both = vectors.add(la, lb)
    return F.lit(w0) + a + b + vectors.dot(both, both)


def squared_error(rows: DataFrame) -> DataFrame:
    """mse and rmse of (label, prediction); -1 without rows."""
    mse = F.avg(F.pow(F.col("label") - F.col("prediction"), 2))
    return rows.agg(mse.alias("mse")).select(F.coalesce("mse", F.lit(-1.0)).alias("mse"), F.coalesce(F.sqrt("mse"), F.lit(-1.0)).alias("rmse"))


def hit_sets(predicted: DataFrame, actual: DataFrame) -> DataFrame:
    """(user, kind, hits, n_actual): how many of a user's predicted items are in the actual list of the same kind."""
    found = predicted.select("user", "kind", "item").join(actual.select("user", "kind", "item").withColumn("hit", F.lit(1)), ["user", "kind", "item"], "left")
    hits = found.groupBy("user", "kind").agg(F.count("hit").alias("hits"), F.count("*").alias("n_predicted"))
    return hits.join(actual.groupBy("user", "kind").agg(F.count("*").alias("n_actual")), ["user", "kind"])


def hit_rates(hits: DataFrame, n: int) -> DataFrame:
    """precision and recall over all items, mean hits, and the mean hit rate of new items (null without any)."""
    whole, new = F.col("kind") == "all", F.col("kind") == "new"
    return hits.agg(
        F.avg(F.when(whole, F.col("hits") / n)).alias("precision"),
        F.avg(F.when(whole, F.col("hits") / F.col("n_actual"))).alias("recall"),
        F.avg(F.when(whole, F.col("hits").cast("double"))).alias("mean_hits"),
        F.avg(F.when(new & (F.col("n_actual") > 0), F.col("hits") / F.col("n_actual"))).alias("new_hit_rate"),
    )


def cold_recall(hits: DataFrame) -> DataFrame:
    """Mean share of the top list that is in the actual set; -1 without rows."""
    return hits.agg(F.coalesce(F.avg(F.col("hits") / F.col("n_predicted")), F.lit(-1.0)).alias("cold_recall"))


def best_model(metrics: DataFrame) -> DataFrame:
    """The model with the smallest metric; the first name wins ties."""
    return metrics.agg(F.min(F.struct("metric", "model")).alias("b")).select("b.model", "b.metric")
