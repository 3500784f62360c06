"""Tables in the same buckets: no exchange between them, and no bucket that is hot."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfgrain.operators import sampling
from shelfgrain.sources import bucketed


@pytest.fixture(scope="module")
def tables(spark):
    facts = [("hot", i, i % 5) for i in range(900)] + [(f"p{i % 40}", 1000 + i, 1) for i in range(1000)] + [(None, 5000, 2), ("unknown", 5001, 3)]
    dims = [("hot", "Hot"), *[(f"p{i}", f"P{i}") for i in range(50)], (None, "none")]
    return spark.createDataFrame(facts, "key string, row long, star long"), spark.createDataFrame(dims, "key string, name string")


@pytest.fixture(scope="module")
def pair(spark, tables):
    return bucketed.write_co_partitioned(*tables, "key", "row", buckets=8)


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_same_rows_as_a_plain_join(spark, tables, pair):
    facts, dims = tables
    for keep in (True, False):
        want = Counter(map(tuple, sampling.reviews_of(dims, facts, "key", keep).select("key", "name", "row", "star").collect()))
        assert Counter(map(tuple, pair.join(spark, keep).select("key", "name", "row", "star").collect())) == want


def test_join_and_counts_have_no_exchange(spark, pair, no_broadcast):
    joined = pair.join(spark)
    assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
    counts = plan(pair.per_key(spark, F.count(F.lit(1)).alias("n")))
    # only partial rows of hot keys move
    cold, hot = counts.split("Union")[1], counts.count("Exchange hashpartitioning")
    assert hot == 1 and "Exchange" not in cold.split(f"NOT {bucketed.HOT}")[0]
    assert "Bucketed: true" in counts


def test_counts(spark, tables, pair):
    got = pair.per_key(spark, F.count(F.lit(1)).alias("n"), F.max("star").alias("best"), final={"n": F.sum("n"), "best": F.max("best")})
    want = tables[0].groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("star").alias("best"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))


def test_a_hot_key_lies_in_several_buckets(spark, tables, pair):
    rows = spark.table(pair.facts)
    shares = {r[bucketed.SHARE]: r["count"] for r in rows.filter("key = 'hot'").groupBy(bucketed.SHARE).count().collect()}
    assert len(shares) == 4 and max(shares.values()) < 300
    assert rows.filter("key <> 'hot'").select(bucketed.SHARE).distinct().collect() == [(0,)]
    assert spark.table(pair.dims).filter("key = 'hot'").count() == 4


def test_no_facts_and_no_buckets(spark, tables, no_broadcast):
    facts, dims = tables
    pair = bucketed.write_co_partitioned(facts.limit(0), dims, "key", "row", buckets=4)
    assert pair.join(spark).count() == dims.count()
    assert pair.per_key(spark, F.count(F.lit(1)).alias("n")).collect() == []
    with pytest.raises(ValueError):
        bucketed.write_co_partitioned(facts, dims, "key", "row", buckets=0)
