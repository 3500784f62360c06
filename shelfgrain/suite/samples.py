"""Queries on samples, deduplication and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sampling, shaping
from ..sources.bucketed import CoPartitioned, write_co_partitioned
from . import views as v
from .registry import query

LIMIT = 301
SEED = 42
COLUMNS = ["review_uid", "star", "true_label"]


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    return shaping.with_true_label(shaping.valid_for_scoring(v.reviews(spark, folder))).select(*COLUMNS)


@query("sample_none", f"""
WITH {v.LABELLED}
SELECT review_uid, star, true_label FROM v_labelled
""")
def sample_none(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.sample(_labelled(spark, folder), LIMIT, "none")


@query("sample_head", f"""
WITH {v.LABELLED}
SELECT review_uid, star, true_label FROM v_labelled ORDER BY review_uid LIMIT {LIMIT}
""")
def sample_head(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.sample(_labelled(spark, folder), LIMIT, "head")


@query("sample_balanced", f"""
WITH {v.LABELLED}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY true_label ORDER BY md5('{SEED}' || review_uid), review_uid) AS rn
  FROM v_labelled WHERE md5(review_uid) >= '1')
SELECT review_uid, star, true_label FROM ranked WHERE rn <= CASE true_label WHEN 'negative' THEN 100 ELSE 101 END
""")
def sample_balanced(spark: SparkSession, folder: str) -> DataFrame:
    """Some rows have no id; they take no place of others."""
    rows = _labelled(spark, folder)
    some = rows.withColumn("review_uid", F.when(F.md5("review_uid") >= "1", F.col("review_uid")))
    return sampling.sample(some, LIMIT, "balanced", SEED)


_RANDOM = f"""
{v.LABELLED}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY true_label ORDER BY md5('{SEED}' || review_uid), review_uid) AS rn FROM v_labelled),
chosen AS (SELECT review_uid, star, true_label FROM ranked WHERE true_label <> 'neutral' AND rn <= 150),
rest AS (
  SELECT review_uid, star, true_label FROM v_labelled WHERE review_uid NOT IN (SELECT review_uid FROM chosen)
  ORDER BY md5('{SEED}' || review_uid), review_uid LIMIT 1)"""


@query("sample_random", f"""
WITH {_RANDOM}
SELECT * FROM chosen UNION ALL SELECT * FROM rest
""")
def sample_random(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.sample(_labelled(spark, folder), LIMIT, "random", SEED)


@query("distinct_ids", f"""
WITH {v.DUPLICATED}
SELECT DISTINCT review_uid FROM v_dup_reviews
""")
def distinct_ids(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.distinct_ids(v.duplicated_reviews(spark, folder), "review_uid")


@query("dedup_by_id", f"""
WITH {v.DUPLICATED}
SELECT review_uid, source, arrival, content FROM v_dup_reviews WHERE review_uid <> ''
QUALIFY row_number() OVER (PARTITION BY review_uid ORDER BY arrival) = 1
""")
def dedup_by_id(spark: SparkSession, folder: str) -> DataFrame:
    rows = v.duplicated_reviews(spark, folder).drop("doc_id")
    return sampling.dedup_first(rows, "review_uid", [F.col("arrival")])


@query("dedup_by_content", f"""
WITH {v.DUPLICATED}
SELECT review_uid, source, arrival, content FROM v_dup_reviews
QUALIFY row_number() OVER (PARTITION BY content ORDER BY arrival) = 1
""")
def dedup_by_content(spark: SparkSession, folder: str) -> DataFrame:
    rows = v.duplicated_reviews(spark, folder).drop("doc_id")
    return sampling.dedup_by_text(rows, "content", [F.col("arrival")])


@query("ordered_distinct", f"""
WITH {v.DUPLICATED}
SELECT review_uid, min(arrival) AS first_seen FROM v_dup_reviews GROUP BY review_uid ORDER BY first_seen, review_uid
""")
def ordered_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.ordered_distinct(v.duplicated_reviews(spark, folder), "review_uid", "arrival")


@query("product_reviews_join", f"""
WITH {v.REVIEWS}, {v.PRODUCTS_SQL}
SELECT p.product_id, p.name, r.review_uid, r.star FROM v_products p LEFT JOIN v_reviews r ON p.product_id = r.product_id
""")
def product_reviews_join(spark: SparkSession, folder: str) -> DataFrame:
    products = v.products(spark, folder).select("product_id", "name")
    return sampling.reviews_of(products, v.reviews(spark, folder).select("product_id", "review_uid", "star"))


_HOT_SQL = f"""{v.REVIEWS}, {v.PRODUCTS_SQL},
hot AS (SELECT CASE WHEN doc_id % 3 = 0 THEN '1' ELSE product_id END AS product_id, review_uid, star FROM v_reviews)"""


def _co_partitioned(spark: SparkSession, folder: str) -> CoPartitioned:
    """Products and reviews in the same buckets; a third of the reviews are of one product."""
    hot = F.when(F.col("doc_id") % 3 == 0, "1").otherwise(F.col("product_id"))
    reviews = v.reviews(spark, folder).select(hot.alias("product_id"), "review_uid", "star")
    return write_co_partitioned(reviews, v.products(spark, folder).select("product_id", "name"), "product_id", "review_uid", buckets=16)


@query("co_partitioned_join", f"""
WITH {_HOT_SQL}
SELECT p.product_id, p.name, r.review_uid, r.star FROM v_products p LEFT JOIN hot r ON p.product_id = r.product_id
""")
def co_partitioned_join(spark: SparkSession, folder: str) -> DataFrame:
    return _co_partitioned(spark, folder).join(spark).select("product_id", "name", "review_uid", "star")


@query("co_partitioned_counts", f"""
WITH {_HOT_SQL}
SELECT product_id, count(*) AS n_reviews, CAST(sum(star) AS BIGINT) AS stars, max(star) AS best FROM hot GROUP BY product_id
""")
def co_partitioned_counts(spark: SparkSession, folder: str) -> DataFrame:
    final = {"n_reviews": F.sum("n_reviews"), "stars": F.sum("stars"), "best": F.max("best")}
    return _co_partitioned(spark, folder).per_key(
        spark, F.count(F.lit(1)).alias("n_reviews"), F.sum("star").cast("bigint").alias("stars"), F.max("star").alias("best"), final=final
    )
