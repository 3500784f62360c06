"""Order-dependent work on groups of any size.

A window over a key puts the whole key into one task. These helpers never do that:
numbering cuts each key into bounded ranges of an id, limits are taken per slice of the
input before they are taken per key, and stop positions come from a partial aggregate
that is joined back, where Spark may split the rows of a hot key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ID_SPAN = 1 << 16
SLICES = 256
SMALL_LIMIT = 4
BROADCAST_KEYS = 200_000


def numbered(df: DataFrame, keys: list[str], order_id: str, out: str = "position", span: int = ID_SPAN, id_limit: int = 1 << 64) -> DataFrame:
    """1-based position of each row within its key, ordered by a unique integer `order_id`.

    A key is cut into id ranges of `span`, these into ranges of span x span, and so on up
    to `id_limit`; each level adds the sizes of what comes before. So no window partition
    holds more than `span` rows, however many rows a key has and however sparse its ids
    are. Ids known to stay below a smaller limit need fewer levels.
    """
    names = [f"k{i}" for i in range(len(keys))]
    start = F.col(order_id) - F.pmod(F.col(order_id), F.lit(span).cast("bigint"))
    cut = df.withColumn("_cut", F.struct(*[F.col(k).alias(n) for n, k in zip(names, keys)], start.alias("range")))
    sizes = cut.groupBy("_cut").agg(F.count(F.lit(1)).alias("_n"))
    offsets = _sizes_before(sizes, names, span, span * span, id_limit)
    local = cut.withColumn("_local", F.row_number().over(Window.partitionBy("_cut").orderBy(order_id)))
    # the struct pairs null keys too, and both window and join use its one partitioning
    return (
        local.join(offsets, "_cut")
        .withColumn(out, F.col("_local") + F.col("_before"))
        .drop("_cut", "_local", "_before")
    )


def _sizes_before(sizes: DataFrame, names: list[str], span: int, width: int, id_limit: int) -> DataFrame:
    """Rows of the same key in earlier ranges: (_cut, _n) -> (_cut, _before)."""
    earlier = lambda keys: Window.partitionBy(*keys).orderBy("_cut.range").rowsBetween(Window.unboundedPreceding, -1)
    total = lambda keys: F.coalesce(F.sum("_n").over(earlier(keys)), F.lit(0))
    if width >= id_limit:
        return sizes.select("_cut", total([f"_cut.{n}" for n in names]).alias("_before"))
    start = F.col("_cut.range") - F.pmod(F.col("_cut.range"), F.lit(width).cast("bigint"))
    placed = sizes.withColumn("_wide", F.struct(*[F.col(f"_cut.{n}").alias(n) for n in names], start.alias("range")))
    wide_sizes = placed.groupBy(F.col("_wide").alias("_cut")).agg(F.sum("_n").alias("_n"))
    wide = _sizes_before(wide_sizes, names, span, width * span, id_limit).select(F.col("_cut").alias("_wide"), F.col("_before").alias("_wider"))
    within = placed.select("_cut", "_wide", total(["_wide"]).alias("_inside"))
    return within.join(wide, "_wide").select("_cut", (F.col("_inside") + F.col("_wider")).alias("_before"))


def _match(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join that also pairs null keys, keeping the left columns and the right's new ones."""
    renamed = right.select(*[F.col(c).alias("_r_" + c) if c in keys else F.col(c) for c in right.columns])
    on = [F.col(k).eqNullSafe(F.col("_r_" + k)) for k in keys]
    return left.join(renamed, on, how).drop(*["_r_" + k for k in keys])


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str | None = None, slices: int = SLICES) -> DataFrame:
    """The first n rows of each key. `order` must be total, so that the choice is unique.

    Larger limits are taken in two steps: each input slice keeps its own first n rows of
    the key, then those meet. One hot key thus never sends more than n x slices rows to
    one task. Both filters are plain row limits, which Spark applies before the shuffle.
    Where no key can be hot, slices=1 saves the first step.
    """
    name = rank or "_rank"
    if n > SMALL_LIMIT and slices > 1:
        df = _first_of_slices(df, keys, order, n, slices)
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.filter(F.col(name) <= n)
    return kept if rank else kept.drop(name)


def _first_of_slices(df: DataFrame, keys: list[str], order: list[Column], n: int, slices: int) -> DataFrame:
    sliced = df.withColumn("_slice", F.spark_partition_id() % slices)
    within = Window.partitionBy(*keys, "_slice").orderBy(*order)
    return sliced.withColumn("_first", F.row_number().over(within)).filter(F.col("_first") <= n).drop("_first", "_slice")


def top_rows(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first n rows of the whole input, ordered. Spark keeps n rows of each partition on the way and sorts none."""
    return df.orderBy(*order).limit(n)


def rows_between(df: DataFrame, order: list[Column], first: int, last: int, path: str) -> DataFrame:
    """Rows number first to last (from 1) of a total order, however deep.

    The rows are written in that order once, over many files; the counts of the files tell
    which of them hold the rows asked for, and only those are read.
    """
    spark = df.sparkSession
    df.orderBy(*order).withColumn("_serial", F.monotonically_increasing_id()).write.parquet(path)
    kept = spark.read.parquet(path)
    part = F.shiftright("_serial", 33)
    before, wanted = 0, []
    for row in kept.groupBy(part.alias("part")).count().orderBy("part").collect():
        low, high = max(first - before, 1), min(last - before, row["count"])
        if low <= high:
            start = row["part"] << 33
            wanted.append(F.col("_serial").between(start + low - 1, start + high - 1))
        before += row["count"]
    chosen = kept.filter(reduce(Column.__or__, wanted)) if wanted else kept.limit(0)
    return chosen.orderBy("_serial").drop("_serial")


def with_key_value(df: DataFrame, keys: list[str], source: DataFrame, value: Column, out: str, at_most: int | None = None) -> DataFrame:
    """Attach one aggregate per key. The aggregate is pre-combined; the join may split hot keys.

    `at_most` is a proven bound on the number of keys; under it the aggregate goes to every
    task and the rows of df stay where they are.
    """
    per_key = source.groupBy(*keys).agg(value.alias(out))
    return _match(df, F.broadcast(per_key) if at_most is not None and at_most <= BROADCAST_KEYS else per_key, keys, "left")
