"""Mixing sources to target weights by balanced sampling.

Sources get target word counts by weight, no more than a source can give at its most
repeats. A source at rate r takes every document floor(r) times; the fraction decides by
the cube method which documents are taken once more. Each document starts with that
fraction as its chance. In the flight phase three undecided documents of a source at a
time move their chances along the null-space of the two constraints, documents and words,
until a chance reaches 0 or 1. Both totals and, over all seeds, every chance are kept on
the way. The last few documents are landed together: of all outcomes, the one that misses
the source's words least.

The flight is a walk along sorted rows that holds a few of them, so a source with a third
of all rows is spread over all tasks: each task flies the rows it has of a source, and the
few rows that a task leaves undecided fly once more with those of other tasks.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, stored

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MOST_REPEATS = 2
SEED = 11
WORD = r"[^\x20\x09-\x0D]+"
# rows of about so many documents fly in one task
TASK_ROWS = 200_000
EPSILON = 1e-9
# documents of a source that land together, and what a missed document counts against a missed mean size
LANDING = 12
DOCUMENT_MISS = 0.1


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share_percent: int = SHARE_PERCENT, most: int = MOST_REPEATS) -> DataFrame:
    """source, source_size and target from (source, source_size), one row per source.

    Sources in code point order, null last, get the weights in turn. Targets are weight
    times a common level, up to `most` times the source's size; the level is such that all
    targets sum to the share. Sources are few: their windows may be one task.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    n = len(weights)
    place = F.pmod(F.row_number().over(in_order) - 1, F.lit(n))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place.cast("int") + 1)
    cap = F.col("source_size") * float(most)
    every = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = every.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    filled = (
        sizes.withColumn("weight", weight).withColumn("cap", cap)
        .withColumn("goal", F.sum("source_size").over(whole) * (share_percent / 100))
        # the level if all sources with a smaller ratio of cap to weight are at their cap
        .withColumn("level", (F.col("goal") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
        .withColumn("fits", F.col("level") * F.col("weight") <= F.col("cap"))
        .withColumn("common", F.min(F.when(F.col("fits"), F.struct(F.col("cap") / F.col("weight"), F.col("source"), F.col("level").alias("level")))).over(whole)["level"])
    )
    return filled.select("source", "source_size", F.when(F.col("common").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("common") * F.col("weight"))).alias("target"))


class Flight:
    """Chances of one source's documents on their way to 0 or 1.

    Two rows may be undecided between calls; the last `LANDING` rows wait behind them, so
    that the landing has some choice.
    """

    def __init__(self):
        self.waiting: list[list] = []  # [chance, size, coin, row]
        self.queue: deque[list] = deque()

    def add(self, chance: float, size: float, coin: float, row) -> list[tuple[object, int]]:
        """Take in a row; returns the rows decided by that."""
        if not EPSILON < chance < 1 - EPSILON:
            return [(row, int(chance > 0.5))]
        self.queue.append([chance, size, coin, row])
        if len(self.queue) <= LANDING:
            return []
        self.waiting.append(self.queue.popleft())
        return self._fly() if len(self.waiting) == 3 else []

    def undecided(self) -> list[list]:
        rest = [*self.waiting, *self.queue]
        self.waiting, self.queue = [], deque()
        return rest

    def _settle(self) -> list[tuple[object, int]]:
        done = [(w[3], int(w[0] > 0.5)) for w in self.waiting if not EPSILON < w[0] < 1 - EPSILON]
        self.waiting = [w for w in self.waiting if EPSILON < w[0] < 1 - EPSILON]
        return done

    def _fly(self) -> list[tuple[object, int]]:
        a, b, c = self.waiting
        # orthogonal to (1, 1, 1) and to the sizes; equal sizes leave a direction free
        u = (c[1] - b[1], a[1] - c[1], b[1] - a[1])
        if not any(u):
            u = (1.0, -1.0, 0.0)
        up = min(((1 - w[0]) / x if x > 0 else w[0] / -x) for w, x in zip(self.waiting, u) if x)
        down = min((w[0] / x if x > 0 else (1 - w[0]) / -x) for w, x in zip(self.waiting, u) if x)
        # forward with the chance that keeps the expected chances as they are
        step = up if c[2] * (up + down) < down else -down
        for w, x in zip(self.waiting, u):
            w[0] = min(1.0, max(0.0, w[0] + step * x))
        return self._settle()

    def land(self) -> list[tuple[object, int]]:
        """Decide the rest: of all outcomes the one that misses the expected words least, and documents next to that."""
        rest = self.undecided()
        if not rest:
            return []
        chance, size = np.array([w[0] for w in rest]), np.array([w[1] for w in rest])
        outcomes = (np.arange(1 << len(rest))[:, None] >> np.arange(len(rest))) & 1
        missed = outcomes - chance
        words = np.abs(missed @ size) / max(size.mean(), 1.0)
        return [(w[3], int(x)) for w, x in zip(rest, outcomes[np.argmin(words + DOCUMENT_MISS * np.abs(missed.sum(axis=1)))])]


COLUMNS = ["row", "source", "size", "draw", "coin", "chance"]


def _flown(last: bool):
    """mapInArrow function over rows sorted by source: decided rows with `more` 0 or 1, others with null and their chance."""

    def fly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flight, current, begun = Flight(), None, False
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*[batch.column(c).to_pylist() for c in COLUMNS]):
                if begun and row[1] != current:
                    out += _leave(flight, last)
                begun, current = True, row[1]
                out += [(r, x, None) for r, x in flight.add(row[5], float(row[2]), row[4], row)]
            yield _as_batch(out)
        if begun:
            yield _as_batch(_leave(flight, last))

    return fly


def _leave(flight: Flight, last: bool) -> list[tuple]:
    if last:
        return [(r, x, None) for r, x in flight.land()]
    return [(w[3], None, w[0]) for w in flight.undecided()]


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.float64(), pa.float64()]
    columns = [pa.array([r[0][i] for r in rows], k) for i, k in enumerate(kinds)]
    return pa.RecordBatch.from_arrays([*columns, pa.array([r[2] for r in rows], pa.float64()), pa.array([r[1] for r in rows], pa.int32())], names=[*COLUMNS, "more"])


def balanced_sample(rows: DataFrame, n_rows: int) -> DataFrame:
    """(row, more): whether each row of (row, source, size, draw, coin, chance) is taken, balanced within sources.

    Rows fly in the order of their draws, which come from a hash like the coins for their
    moves, so reruns agree.
    """
    schema = "row long, source string, size long, draw double, coin double, chance double, more int"
    order = [F.col("source").asc_nulls_last(), "draw", "size", "row"]
    parts = max(1, -(-n_rows // TASK_ROWS))
    task = F.least(F.lit(parts - 1), F.floor(F.col("draw") * parts)).cast("int")
    first = stored(rows.select(*COLUMNS).repartitionById(parts, task).sortWithinPartitions(*order).mapInArrow(_flown(False), schema), "mix-flight")
    open_rows = first.filter(F.col("more").isNull()).select(*COLUMNS)
    landed = open_rows.repartition("source").sortWithinPartitions(*order).mapInArrow(_flown(True), schema)
    return first.filter(F.col("more").isNotNull()).unionByName(landed).select("row", "more")


def mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, share_percent: int = SHARE_PERCENT, most: int = MOST_REPEATS, seed: int = SEED) -> DataFrame:
    """id, size, source_size, target and copies (0 to `most`) of every row.

    Size is the number of words. A null text has none, a null source is a source of its
    own. Rows without words are taken as their source's rate says, which adds no words.
    Rows that share an id or are equal are drawn one by one. Draws come from a hash of id,
    text and seed: reruns agree. An empty table gives no rows.
    """
    return _decided(docs, id, text, source, weights, share_percent, most, seed).select(
        F.col("id").alias(id), "size", "source_size", "target", "copies"
    )


def take(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, share_percent: int = SHARE_PERCENT, most: int = MOST_REPEATS, seed: int = SEED) -> DataFrame:
    """The mix itself: the input rows with all their columns, each as often as it is taken.

    Null ids, texts and sources are values like others. Of rows that are equal in id, text
    and source as many are taken as were drawn, whichever these are. An empty table gives
    an empty table.
    """
    key, copies, rank = fresh(docs, "mix_key", "mix_copies", "mix_rank")
    decided = _decided(docs, id, text, source, weights, share_percent, most, seed)
    per_key = decided.groupBy(F.col("key").alias(key)).agg(F.sort_array(F.collect_list("copies"), asc=False).alias(copies))
    # rows that share a key are equal in id, text and source: which of them is taken does not matter
    return (
        docs.withColumn(key, _key(id, text, source)).join(per_key, key)
        .withColumn(rank, F.row_number().over(Window.partitionBy(key).orderBy(key)))
        .withColumn(rank, F.explode(F.sequence(F.lit(0), F.element_at(copies, F.col(rank))))).filter(F.col(rank) > 0)
        .drop(key, copies, rank)
    )


def _key(id: str, text: str, source: str) -> Column:
    return F.xxhash64(F.col(id), F.col(text), F.col(source))


def _unit(seed: int, *columns: str) -> Column:
    """A number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 52)) / float(1 << 52)


def _decided(docs: DataFrame, id: str, text: str, source: str, weights: tuple[int, ...], share_percent: int, most: int, seed: int) -> DataFrame:
    sized = stored(
        docs.select(
            F.col(id).alias("id"), F.col(source).cast("string").alias("source"), n_words(F.col(text)).alias("size"),
            _key(id, text, source).alias("key"), F.monotonically_increasing_id().alias("row"),
        ),
        "mix-sizes",
    )
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = targets(per_source, weights, share_percent, most).withColumnRenamed("source", "goal_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rated = (
        sized.join(goals, F.col("source").eqNullSafe(F.col("goal_source")))
        .withColumn("rate", F.least(F.lit(float(most)), rate)).withColumn("sure", F.floor("rate").cast("int")).withColumn("chance", F.col("rate") - F.col("sure"))
        .withColumn("draw", _unit(seed, "key")).withColumn("coin", _unit(seed + 1, "key"))
    )
    sampled = balanced_sample(rated, sized.count())
    return rated.join(sampled, "row").select("id", "key", "size", "source_size", "target", (F.col("sure") + F.col("more")).cast("int").alias("copies"))
