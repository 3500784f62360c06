"""Pages that arrive in any order are decided as all pages at once are."""

import random
import time

import pytest
from pyspark.sql import functions as F

from shelfgrain import session
from shelfgrain.operators import paging
from shelfgrain.streaming.pages import advance, drain_pages, kept_pages

SCHEMA = "job string, page long, n_items long"


@pytest.fixture(autouse=True)
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_pages_wait_for_those_before_them():
    assert advance(1, 0, {2: 5, 3: 0}, 3) == (1, 0, False, [])
    assert advance(1, 0, {1: 4, 2: 0, 3: 0, 5: 1}, 3) == (4, 2, False, [(1, 4)])
    assert advance(4, 2, {4: 0, 5: 1}, 3) == (5, 3, True, [])
    assert advance(1, 0, {1: 1, 2: 0, 3: 2}, 1)[2:] == (True, [(1, 1)])


@pytest.mark.parametrize("k", [1, 3])
def test_any_order_gives_the_same_pages(spark, k):
    rng = random.Random(k)
    log = [(f"j{j}", p, rng.choice([0, 0, 20, 7])) for j in range(12) for p in range(1, rng.randint(2, 40))]
    frame = spark.createDataFrame(log, SCHEMA)
    want = rows(paging.take_until_streak(frame, "job", "page", k=k, dense=True).select("job", "page", "n_items"))
    rng.shuffle(log)
    folder = session.scratch_dir(spark, "pages")
    for part in range(3):
        late = log[part::3] + [x for x in log[: 3 * part] if x[1] % 5 == 0] + [(None, 1, 20), ("j0", None, 20)]
        spark.createDataFrame(late, SCHEMA).write.mode("append").parquet(f"{folder}/in")
        drain_pages(kept_pages(spark.readStream.schema(SCHEMA).parquet(f"{folder}/in"), k=k), f"{folder}/out", f"{folder}/state")
    assert rows(spark.read.parquet(f"{folder}/out")) == want


def test_a_page_that_never_comes_is_empty_in_the_end(spark):
    folder = session.scratch_dir(spark, "pages")

    def land(*pages):
        spark.createDataFrame([("a", p, 9) for p in pages] + [("other", 1, 1)], SCHEMA).write.mode("append").parquet(f"{folder}/in")
        drain_pages(kept_pages(spark.readStream.schema(SCHEMA).parquet(f"{folder}/in"), patience_ms=500), f"{folder}/out", f"{folder}/state", once=True)
        return rows(spark.read.parquet(f"{folder}/out").filter(F.col("job") == "a").select("page"))

    assert land(1, 3, 4) == [(1,)]
    time.sleep(1)
    spark.createDataFrame([("other", 2, 1)], SCHEMA).write.mode("append").parquet(f"{folder}/in")
    drain_pages(kept_pages(spark.readStream.schema(SCHEMA).parquet(f"{folder}/in"), patience_ms=500), f"{folder}/out", f"{folder}/state", once=True)
    assert rows(spark.read.parquet(f"{folder}/out").filter(F.col("job") == "a").select("page")) == [(1,), (3,), (4,)]
