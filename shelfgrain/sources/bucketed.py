"""A fact table and its dimension kept in the same buckets, so that they meet where they lie.

Both are written in buckets of the key and a share. Most keys have the one share 0. A key
with more rows than an average bucket would fill one alone; its facts are dealt over
several shares by their row id, and its dimension row is there once for each. Joins on key
and share, and counts by key and share, then need no exchange, and no bucket is much larger
than the others.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

SHARE = "bucket_share"
HOT = "bucket_hot"
BUCKETS = 64
MAX_BUCKETS = 50_000


@dataclass(frozen=True)
class CoPartitioned:
    """Names of the two tables, their key and number of buckets."""

    facts: str
    dims: str
    key: str
    buckets: int

    def join(self, spark: SparkSession, keep_without: bool = True) -> DataFrame:
        """Dimension rows with their facts; those without facts stay unless told otherwise.

        A hot key has facts, so a share of it that found none is no row without facts.
        """
        facts = spark.table(self.facts).drop(HOT).withColumn("_met", F.lit(True))
        met = spark.table(self.dims).join(facts, [self.key, SHARE], "left" if keep_without else "inner")
        return met.filter(F.col("_met").isNotNull() | ~F.col(HOT)).drop("_met", SHARE, HOT)

    def per_key(self, spark: SparkSession, *partial: Column, final: dict[str, Column] | None = None) -> DataFrame:
        """Aggregates of the facts by key. `partial` are taken within buckets; only the few hot keys' partial
        rows move, and are brought together by the aggregates in `final`, by default sums of the partial ones."""
        by_share = spark.table(self.facts).groupBy(self.key, SHARE, HOT).agg(*partial)
        names = [c for c in by_share.columns if c not in (self.key, SHARE, HOT)]
        combine = final or {n: F.sum(n) for n in names}
        cold = by_share.filter(~F.col(HOT)).select(self.key, *names)
        hot = by_share.filter(HOT).groupBy(self.key).agg(*[combine[n].cast(by_share.schema[n].dataType).alias(n) for n in names])
        return cold.unionByName(hot)


def hot_keys(facts: DataFrame, key: str, buckets: int) -> DataFrame:
    """(key, shares) of keys with more rows than an average bucket; there are fewer of them than buckets."""
    every = facts.count()
    counts = facts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    shares = F.ceil(F.col("_n") * buckets / F.lit(max(every, 1)))
    return counts.filter(F.col("_n") * buckets > every).select(key, shares.cast("int").alias("_shares"))


def write_co_partitioned(facts: DataFrame, dims: DataFrame, key: str, row_id: str, buckets: int = BUCKETS, name: str | None = None) -> CoPartitioned:
    """Write both tables in the same buckets below the scratch folder, each bucket as one sorted file.

    Facts are told apart by a hash of `row_id` where their key is hot; facts without a key
    stay, in share 0, and meet nothing. The hot keys are fewer than the buckets, so they are
    sent to all tasks.
    """
    if not 0 < buckets <= MAX_BUCKETS:
        raise ValueError(f"between 1 and {MAX_BUCKETS} buckets")
    spark = facts.sparkSession
    name = name or f"co_{uuid.uuid4().hex[:12]}"
    hot = F.broadcast(hot_keys(facts, key, buckets))
    marked = lambda df: df.join(hot, key, "left").withColumn(HOT, F.col("_shares").isNotNull())
    share = F.coalesce(F.pmod(F.xxhash64(row_id), F.col("_shares")), F.lit(0)).cast("int")
    placed = {
        f"{name}_facts": marked(facts).withColumn(SHARE, share).drop("_shares"),
        f"{name}_dims": marked(dims).withColumn(SHARE, F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_shares"), F.lit(1)) - 1))).drop("_shares"),
    }
    for table, rows in placed.items():
        (
            rows.repartition(buckets, key, SHARE)
            .write.bucketBy(buckets, key, SHARE)
            .sortBy(key, SHARE)
            .option("path", scratch_dir(spark, table))
            .saveAsTable(table)
        )
    return CoPartitioned(f"{name}_facts", f"{name}_dims", key, buckets)
