"""Counts, statistics and top lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import numbers
from .ordering import top_rows


def accuracy(df: DataFrame, true: str = "true_label", correct: str = "is_correct") -> DataFrame:
    """Share of right predictions over rows whose true label is not neutral; null without any."""
    judged = df.filter(F.col(true) != fv.NEUTRAL)
    return judged.agg(F.avg(F.col(correct).cast("int")).alias("accuracy"), F.count(F.lit(1)).alias("n_judged"))


def sample_counts(df: DataFrame, label: str = "true_label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))


def top_brands(df: DataFrame, n: int = 10, brand: str = "brand") -> DataFrame:
    counted = df.groupBy(brand).agg(F.count(F.lit(1)).alias("n_products"))
    return top_rows(counted, [F.col("n_products").desc(), F.col(brand)], n)


def price_stats(df: DataFrame, price: str = "price") -> DataFrame:
    """Mean rounded down, highest and lowest of the prices that are numbers."""
    amount = numbers.price_number(F.col(price).cast("string"))
    stats = df.select(amount.alias("_p")).agg(
        F.sum("_p").alias("_total"), F.count("_p").alias("n_prices"), F.max("_p").alias("max_price"), F.min("_p").alias("min_price")
    )
    mean = F.floor(F.try_divide(F.col("_total"), F.col("n_prices")))
    return stats.select(mean.alias("mean_price"), "max_price", "min_price", "n_prices")


def price_ranges(df: DataFrame, price: Column, edges: list[int] = fv.PRICE_EDGES, labels: list[str] = fv.PRICE_LABELS) -> DataFrame:
    """Products per price range, as a share of all products, in one aggregation.

    Unreadable prices (null) are in no range but count in the total.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("one label more than edges is needed")
    lows, highs = [None, *edges], [*edges, None]
    counts = []
    for low, high, label in zip(lows, highs, labels):
        inside = F.col("_p").isNotNull()
        if low is not None:
            inside = inside & (F.col("_p") >= low)
        if high is not None:
            inside = inside & (F.col("_p") < high)
        counts.append(F.struct(F.lit(label).alias("price_range"), F.count_if(inside).alias("n_products")))
    totals = df.select(price.alias("_p")).agg(F.count(F.lit(1)).alias("_all"), F.array(*counts).alias("_ranges"))
    share = F.try_divide(F.col("n_products") * 100.0, F.col("_all"))
    return totals.select("_all", F.inline("_ranges")).select("price_range", "n_products", F.round(share, 1).alias("percentage"))


def catalog_totals(df: DataFrame, brand: str = "brand", approximate: bool = False) -> DataFrame:
    brands = F.approx_count_distinct(brand) if approximate else F.count_distinct(brand)
    return df.agg(F.count(F.lit(1)).alias("n_products"), brands.alias("n_brands"))


def brand_avg_price(df: DataFrame, brand: str = "brand", price: str = "price") -> DataFrame:
    return df.groupBy(brand).agg(F.avg(price).alias("avg_price")).orderBy(F.col("avg_price").desc(), brand)


def top_rated(df: DataFrame, n: int = 10, rating: str = "rating", id_col: str = "product_id") -> DataFrame:
    return top_rows(df, [F.col(rating).desc_nulls_last(), F.col(id_col)], n)


def top_ranked(df: DataFrame, n: int = 10, rank: str = "rank", id_col: str = "product_id") -> DataFrame:
    return top_rows(df, [F.col(rank).asc_nulls_last(), F.col(id_col)], n)


def review_counts(reviews: DataFrame, key: str = "product_id") -> DataFrame:
    return reviews.groupBy(key).agg(F.count(F.lit(1)).alias("n_reviews"))


def collection_summary(products: DataFrame, reviews: DataFrame, key: str = "product_id") -> DataFrame:
    """Products, products with reviews, and reviews of those products."""
    joined = products.select(key).join(review_counts(reviews, key), key, "left")
    return joined.agg(
        F.count(F.lit(1)).alias("n_products"),
        F.count("n_reviews").alias("n_with_reviews"),
        F.coalesce(F.sum("n_reviews"), F.lit(0)).cast("bigint").alias("n_reviews"),
    )


def reviews_per_product(reviews: DataFrame, key: str, order_id: str, value: str, span: int = 10_000) -> DataFrame:
    """Review lists per product, in parts.

    A part covers an id range of `span`, so no list grows with the product's popularity.
    """
    parts = reviews.groupBy(key, F.floor(F.col(order_id) / F.lit(span)).alias("part"))
    listed = F.sort_array(F.collect_list(F.struct(order_id, value)))
    return parts.agg(F.count(F.lit(1)).alias("n_in_part"), F.transform(listed, lambda r: r[value]).alias("reviews"))


def job_result(df: DataFrame, key: str, n_items: Column, failed: Column, moment: str) -> DataFrame:
    """One row per job: status, item count, time and message."""
    totals = df.groupBy(key).agg(F.sum(n_items).cast("bigint").alias("n_items"), F.count_if(failed).alias("n_failed"))
    status = F.when((F.col("n_items") == 0) & (F.col("n_failed") > 0), "error").otherwise("success")
    message = (
        F.when((F.col("n_items") == 0) & (F.col("n_failed") > 0), "all pages failed")
        .when(F.col("n_items") == 0, "no items found")
        .otherwise(F.concat(F.col("n_items").cast("string"), F.lit(" items")))
    )
    return totals.withColumns({"status": status, "message": message, "scraped_at": F.lit(moment)})
