"""Queries on counts, statistics and top lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numbers
from ..operators import scoring, shaping, sketches, summaries
from ..session import scratch_dir
from ..sources.tables import write_partitioned
from . import views as v
from .registry import query


@query("accuracy", f"""
WITH {v.SCORED}
SELECT round(avg(CASE WHEN true_label = pred_label THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS n_judged
FROM v_predicted WHERE true_label <> 'neutral'
""")
def accuracy(spark: SparkSession, folder: str) -> DataFrame:
    rows = shaping.with_true_label(shaping.valid_for_scoring(v.scored(spark, folder)))
    judged = summaries.accuracy(scoring.with_correct(scoring.with_pred_label(rows)))
    return judged.withColumn("accuracy", F.round("accuracy", 6))


@query("sample_counts", f"""
WITH {v.LABELLED}
SELECT true_label, count(*) AS n_rows FROM v_labelled GROUP BY true_label
""")
def sample_counts(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.sample_counts(shaping.with_true_label(shaping.valid_for_scoring(v.reviews(spark, folder))))


@query("top_brands", f"""
WITH {v.PRODUCTS_SQL}
SELECT brand, count(*) AS n_products FROM v_products GROUP BY brand ORDER BY n_products DESC, brand LIMIT 10
""")
def top_brands(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.top_brands(v.products(spark, folder))


@query("price_stats", f"""
WITH {v.PRICE_TEXTS}
SELECT CAST(sum(price) // count(*) AS BIGINT) AS mean_price, max(price) AS max_price, min(price) AS min_price, count(*) AS n_prices
FROM v_price_text WHERE price_text <> 'N/A'
""")
def price_stats(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.price_stats(v.price_texts(spark, folder), "price_text")


@query("price_ranges", f"""
WITH {v.PRICE_TEXTS}, ranged AS (
  SELECT CASE WHEN price_text = 'N/A' THEN NULL WHEN price < 10000 THEN '1만원 미만' WHEN price < 30000 THEN '1-3만원'
              WHEN price < 50000 THEN '3-5만원' ELSE '5만원 이상' END AS price_range FROM v_price_text)
SELECT price_range, count(*) AS n_products, round(count(*) * 100.0 / (SELECT count(*) FROM ranged), 1) AS percentage
FROM ranged WHERE price_range IS NOT NULL GROUP BY price_range
""")
def price_ranges(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.price_ranges(v.price_texts(spark, folder), numbers.price_number(F.col("price_text")))


@query("catalog_totals", f"""
WITH {v.PRODUCTS_SQL}
SELECT count(*) AS n_products, count(DISTINCT brand) AS n_brands FROM v_products
""")
def catalog_totals(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.catalog_totals(v.products(spark, folder))


@query("catalog_totals_approximate", """
SELECT count(*) AS n_orders, TRUE AS customers_in_bound FROM orders
""")
def catalog_totals_approximate(spark: SparkSession, folder: str) -> DataFrame:
    """The estimate of distinct values next to the exact number, on the orders of all customers."""
    orders = v.table(spark, folder, "orders").select("o_custkey")
    guess = summaries.catalog_totals(orders, "o_custkey", approximate=True)
    exact = summaries.catalog_totals(orders, "o_custkey").withColumnRenamed("n_brands", "exact")
    near = F.abs(F.col("n_brands") - F.col("exact")) <= 0.15 * F.col("exact")  # three deviations of 5 %
    # one row each, with the same count of all orders
    return guess.join(exact, "n_products").select(F.col("n_products").alias("n_orders"), near.alias("customers_in_bound"))


@query("daily_sketches", f"""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_orders, min(o_totalprice) AS lowest, max(o_totalprice) AS highest,
       TRUE AS quartiles_in_bound, TRUE AS customers_in_bound
FROM orders GROUP BY 1
""")
def daily_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """Sketches of every day's orders, kept by date and merged over years; estimates held against exact ranks and counts."""
    orders = v.table(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("day"), "o_totalprice", "o_custkey")
    target = scratch_dir(spark, "order-sketches")
    months = sketches.daily(orders, ["day"], F.col("o_totalprice"), F.col("o_custkey")).withColumn("month", F.date_format("day", "yyyy-MM"))
    write_partitioned(months, target, ["month"])
    year = F.year("day").alias("year")
    found = sketches.figures(sketches.merged(spark.read.parquet(target).withColumn("year", year), ["year"]))
    # one row for each year
    checked = orders.withColumn("year", year).join(F.broadcast(found.select("year", "quantiles")), "year")
    ranks = [F.avg((F.col("o_totalprice") <= F.col("quantiles")[i]).cast("int")).alias(f"r{i}") for i in range(3)]
    exact = checked.groupBy("year").agg(F.count_distinct("o_custkey").alias("customers"), *ranks)
    # at most one row has the price of a quantile, so its rank moves by one row
    slack = F.lit(sketches.RANK_ERROR) + 1 / F.col("n_rows")
    inside = [F.abs(F.col(f"r{i}") - q) <= slack for i, q in enumerate((0.25, 0.5, 0.75))]
    near = F.abs(F.col("n_brands") - F.col("customers")) <= sketches.COUNT_ERROR * F.col("customers")
    return found.join(exact, "year").select(
        "year", F.col("n_rows").alias("n_orders"), "lowest", "highest", (inside[0] & inside[1] & inside[2]).alias("quartiles_in_bound"), near.alias("customers_in_bound")
    )


@query("brand_avg_price", f"""
WITH {v.PRODUCTS_SQL}
SELECT brand, round(avg(price), 6) AS avg_price FROM v_products GROUP BY brand
""")
def brand_avg_price(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.brand_avg_price(v.products(spark, folder)).withColumn("avg_price", F.round("avg_price", 6))


@query("top_rated", f"""
WITH {v.PRODUCTS_SQL}
SELECT product_id, name, brand, rating, review_count FROM v_products ORDER BY rating DESC, product_id LIMIT 10
""")
def top_rated(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.top_rated(v.products(spark, folder).select("product_id", "name", "brand", "rating", "review_count"))


@query("top_ranked", f"""
WITH {v.PRODUCTS_SQL}
SELECT product_id, rank, name, brand, price FROM v_products ORDER BY rank, product_id LIMIT 10
""")
def top_ranked(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.top_ranked(v.products(spark, folder).select("product_id", "rank", "name", "brand", "price"))


@query("collection_summary", f"""
WITH {v.REVIEWS}, {v.PRODUCTS_SQL}, c AS (SELECT product_id, count(*) AS n FROM v_reviews GROUP BY product_id)
SELECT count(*) AS n_products, count(n) AS n_with_reviews, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_reviews
FROM v_products p LEFT JOIN c ON p.product_id = c.product_id
""")
def collection_summary(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.collection_summary(v.products(spark, folder), v.reviews(spark, folder))


@query("review_counts", f"""
WITH {v.REVIEWS}
SELECT product_id, count(*) AS n_reviews FROM v_reviews GROUP BY product_id
""")
def review_counts(spark: SparkSession, folder: str) -> DataFrame:
    return summaries.review_counts(v.reviews(spark, folder))


@query("reviews_per_product", f"""
WITH {v.REVIEWS}
SELECT product_id, CAST(floor(doc_id / 2000) AS BIGINT) AS part, count(*) AS n_in_part,
       string_agg(review_uid, ',' ORDER BY doc_id) AS reviews
FROM v_reviews GROUP BY 1, 2
""")
def reviews_per_product(spark: SparkSession, folder: str) -> DataFrame:
    listed = summaries.reviews_per_product(v.reviews(spark, folder), "product_id", "doc_id", "review_uid", span=2000)
    return listed.withColumn("reviews", F.array_join("reviews", ","))


@query("job_result", f"""
WITH {v.CRAWL_PAGES}, t AS (
  SELECT job, CAST(sum(n_items) AS BIGINT) AS n_items, count(*) FILTER (WHERE n_items = 0) AS n_failed FROM v_crawl_pages GROUP BY job)
SELECT job, n_items, n_failed, CASE WHEN n_items = 0 AND n_failed > 0 THEN 'error' ELSE 'success' END AS status,
       CASE WHEN n_items = 0 AND n_failed > 0 THEN 'all pages failed' WHEN n_items = 0 THEN 'no items found' ELSE n_items || ' items' END AS message,
       '{v.SCRAPED_AT}' AS scraped_at
FROM t
""")
def job_result(spark: SparkSession, folder: str) -> DataFrame:
    events = v.table(spark, folder, "events").select(F.col("user_id").alias("job"), F.when(F.col("event_type") == "error", 0).otherwise(20).alias("n_items"))
    return summaries.job_result(events, "job", F.col("n_items"), F.col("n_items") == 0, v.SCRAPED_AT)
