"""Which pages to request, and which collected pages count."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import numbers, text
from ..session import scratch_dir
from .ordering import numbered, rows_between, top_per_key, top_rows, with_key_value

DEEP_ROWS = 100_000


def frontier(jobs: DataFrame, n_pages: Column | int, sorts: list[str], first_page: int = 1) -> DataFrame:
    """One row per job, page and sort option. `n_pages` may differ per job."""
    last = F.lit(n_pages) if isinstance(n_pages, int) else n_pages
    last = last.cast("int") + (first_page - 1)
    pages = F.when(last >= first_page, F.sequence(F.lit(first_page), last)).otherwise(F.array().cast("array<int>"))
    return jobs.withColumn("page", F.explode(pages)).withColumn("sort", F.explode(F.array(*[F.lit(s) for s in sorts])))


def probes(jobs: DataFrame, pages: list[int] = fv.PROBE_PAGES, sorts: list[str] = fv.REVIEW_SORTS) -> DataFrame:
    """One row per job, probed page and sort option."""
    return jobs.withColumn("page", F.explode(F.array(*[F.lit(p) for p in pages]))).withColumn("sort", F.explode(F.array(*[F.lit(s) for s in sorts])))


def query_string(pairs: list[tuple[str, Column]]) -> Column:
    return F.concat_ws("&", *[F.concat(F.lit(k + "="), v.cast("string")) for k, v in pairs])


def json_parameter(fields: dict[str, Column]) -> Column:
    """A struct as compact JSON, quoted for use in a URL."""
    return text.percent_encode(F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()])))


def page_count(total: Column, size: int, cap: int | None = None) -> Column:
    return numbers.page_count(total, size, cap)


def take_until_empty(df: DataFrame, key: str, page: str, n_items: str = "n_items", jobs: int | None = None) -> DataFrame:
    """Pages of each job before its first empty one. With a proven bound on the jobs the payloads are not shuffled."""
    empties = df.filter(F.col(n_items) == 0).select(key, page)
    marked = with_key_value(df, [key], empties, F.min(page), "_stop", at_most=jobs)
    return marked.filter(F.col("_stop").isNull() | (F.col(page) < F.col("_stop"))).drop("_stop")


def take_until_streak(df: DataFrame, key: str, order_id: str, n_items: str = "n_items", k: int = fv.EMPTY_PAGES_TO_STOP, dense: bool = False) -> DataFrame:
    """Non-empty pages of each job before its first k empty attempts in a row.

    Every empty attempt marks the next k positions; a position marked k times ends a
    streak. `dense` says that `order_id` already counts 1, 2, 3, ... within the job.
    """
    log = df.withColumn("_at", F.col(order_id)) if dense else numbered(df, [key], order_id, out="_at")
    marks = (
        log.filter(F.col(n_items) == 0)
        .select(key, F.explode(F.sequence(F.col("_at"), F.col("_at") + (k - 1))).alias("_at"))
        .groupBy(key, "_at")
        .agg(F.count(F.lit(1)).alias("_marks"))
        .filter(F.col("_marks") == k)
    )
    marked = with_key_value(log, [key], marks, F.min("_at"), "_stop")
    kept = marked.filter(F.col("_stop").isNull() | (F.col("_at") < F.col("_stop")))
    return kept.filter(F.col(n_items) > 0).drop("_at", "_stop")


def cap_per_key(df: DataFrame, key: str, n: int, order: list[Column]) -> DataFrame:
    """The first n rows of each key."""
    return top_per_key(df, [key], order, n)


def estimate_total(probes: DataFrame, key: str, page: str, n_items: str = "n_items", size: int = fv.PAGE_SIZE) -> DataFrame:
    """Last page before the first gap, at least page 1, and the total it implies."""
    empties = probes.filter(F.col(n_items) == 0).select(key, page)
    marked = with_key_value(probes.select(key, page), [key], empties, F.min(page), "_stop")
    valid = F.when(F.col("_stop").isNull() | (F.col(page) < F.col("_stop")), F.col(page))
    return (
        marked.groupBy(key)
        .agg(F.greatest(F.coalesce(F.max(valid), F.lit(1)), F.lit(1)).cast("bigint").alias("last_valid_page"))
        .withColumn("estimated_total", F.col("last_valid_page") * size)
    )


def gallop(jobs: DataFrame, key: str, answer: Callable[[DataFrame], DataFrame], size: int = fv.PAGE_SIZE) -> DataFrame:
    """Last valid page of each job and the total it implies, by doubling and halving; n_requests is what it took.

    `answer` takes a frontier (key, page) and gives (key, page, n_items) for the pages that
    exist; a page without an answer is empty. Valid pages of a job are the first ones. A
    round asks one page of each open job: twice the last good one until one is empty, then
    the middle of what is left; so a job of p pages takes about 2 log2(p) requests. Rounds
    are stored, and there are as many as the longest job takes.
    """
    spark = jobs.sparkSession
    state = jobs.select(key).distinct().select(key, F.lit(0).cast("bigint").alias("good"), F.lit(None).cast("bigint").alias("empty"), F.lit(0).cast("bigint").alias("n_requests"))
    done: list[DataFrame] = []
    while True:
        place = scratch_dir(spark, "gallop")
        state.write.parquet(place)
        state = spark.read.schema(state.schema).parquet(place)
        is_open = F.col("empty").isNull() | (F.col("empty") - F.col("good") > 1)
        done.append(state.filter(~is_open))
        state = state.filter(is_open)
        if not state.limit(1).count():
            break
        middle = F.expr("(good + empty) div 2")
        asked = state.withColumn("page", F.when(F.col("empty").isNull(), F.greatest(F.lit(1), F.col("good") * 2)).otherwise(middle))
        found = answer(asked.select(key, "page")).filter(F.col("n_items") > 0).select(key, "page").distinct().withColumn("_there", F.lit(True))
        seen = asked.join(found, [key, "page"], "left")
        there = F.col("_there").isNotNull()
        state = seen.select(
            key, F.when(there, F.col("page")).otherwise(F.col("good")).alias("good"), F.when(there, F.col("empty")).otherwise(F.col("page")).alias("empty"),
            (F.col("n_requests") + 1).alias("n_requests"),
        )
    last = F.greatest(F.col("good"), F.lit(1))
    return reduce(DataFrame.unionByName, done).select(key, last.alias("last_valid_page"), (last * size).alias("estimated_total"), "n_requests")


def sort_option_summary(df: DataFrame, sort: str, page: str, n_items: str = "n_items", has_more: str = "has_more", size: int = fv.PAGE_SIZE) -> DataFrame:
    """Per sort option: items, more-flag, highest page with items, estimate.

    The row 'ALL' holds the best of the estimates; it is rolled up from one row per option.
    """
    per_sort = df.groupBy(sort).agg(
        F.sum(n_items).cast("bigint").alias("items"),
        F.bool_or(has_more).alias("has_more"),
        F.coalesce(F.max(F.when(F.col(n_items) > 0, F.col(page))), F.lit(1)).cast("bigint").alias("max_page"),
    )
    estimated = per_sort.withColumn(
        "estimated_total", F.when(F.col("has_more"), F.col("max_page") * size).otherwise(F.col("items"))
    )
    return (
        estimated.rollup(sort)
        .agg(
            F.sum("items").alias("items"),
            F.bool_or("has_more").alias("has_more"),
            F.max("max_page").alias("max_page"),
            F.max("estimated_total").alias("estimated_total"),
        )
        .withColumn(sort, F.coalesce(F.col(sort), F.lit("ALL")))
    )


def sample_top(df: DataFrame, key: str, order: list[Column], n: int = 3) -> DataFrame:
    return top_per_key(df, [key], order, n, rank="sample_no")


def page_slice(df: DataFrame, order: list[Column], page: int, size: int, deep: int = DEEP_ROWS) -> DataFrame:
    """One page of an ordered table.

    Up to `deep` rows the rows before the page meet in one task; beyond, the table is
    written in order and only the files with the page are read.
    """
    if page * size <= deep:
        return top_rows(df, order, page * size).offset((page - 1) * size)
    return rows_between(df, order, (page - 1) * size + 1, page * size, scratch_dir(df.sparkSession, "ordered"))


def page_slice_per_key(df: DataFrame, key: str, order_id: str, page: int, size: int) -> DataFrame:
    """The same page of every key, ordered by a unique integer id."""
    first = (page - 1) * size
    return numbered(df, [key], order_id).filter(F.col("position").between(first + 1, first + size))


def sort_orders(id_col: str) -> dict[str, list[Column]]:
    """Request option -> ordering; every ordering ends in the unique id."""
    tie = F.col(id_col).asc()
    return {
        "POPULARITY": [F.col("rank").asc_nulls_last(), tie],
        "PRICE_LOW": [F.col("price").asc_nulls_last(), tie],
        "PRICE_HIGH": [F.col("price").desc_nulls_last(), tie],
        "REVIEW": [F.col("review_count").desc_nulls_last(), tie],
        "RECENT": [F.col("created_at").desc_nulls_last(), tie],
        "SALE": [F.col("discount_rate").desc_nulls_last(), tie],
        "RATING": [F.col("rating").desc_nulls_last(), tie],
        fv.RECOMMEND_SORT: [F.col("helpful").desc_nulls_last(), tie],
        "최신순": [F.col("created_at").desc_nulls_last(), tie],
        "랭킹순": [F.col("rank").asc_nulls_last(), tie],
        "평점 높은순": [F.col("rating").desc_nulls_last(), tie],
        "평점 낮은순": [F.col("rating").asc_nulls_last(), tie],
    }


def order_by_option(df: DataFrame, option: str, id_col: str) -> DataFrame:
    orders = sort_orders(id_col)
    if option not in orders:
        raise ValueError(f"unknown sort option {option!r}; known: {sorted(orders)}")
    return df.orderBy(*orders[option])


def filter_flags(df: DataFrame, **flags: bool | None) -> DataFrame:
    """Keep rows whose flag columns have the asked value; flags left at None do not count."""
    for name, wanted in flags.items():
        if wanted is not None:
            df = df.filter(F.col(name) == F.lit(wanted))
    return df


def filter_any_keyword(df: DataFrame, col: str, words: list[str], n: int | None = None, order: list[Column] | None = None) -> DataFrame:
    """Rows whose lower-cased column holds any of the words; the first n of them on request."""
    kept = df.filter(text.contains_any(F.lower(F.col(col)), [w.lower() for w in words]))
    if n is None:
        return kept
    return top_rows(kept, order, n) if order else kept.limit(n)


def batch_id(df: DataFrame, pages_per_batch: int = fv.PAGES_PER_BATCH, page: str = "page") -> DataFrame:
    """Number of the checkpoint batch a page belongs to, from 0."""
    return df.withColumn("batch", F.floor((F.col(page) - 1) / F.lit(pages_per_batch)))
