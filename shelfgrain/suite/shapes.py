"""Queries on labels, lookups and conformed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import shaping
from . import views as v
from .registry import query


@query("star_label", f"""
WITH {v.LABELLED}
SELECT review_uid, star, true_label FROM v_labelled
""")
def star_label(spark: SparkSession, folder: str) -> DataFrame:
    return shaping.with_true_label(shaping.valid_for_scoring(v.reviews(spark, folder))).select("review_uid", "star", "true_label")


@query("category_lookup", """
WITH dim AS (SELECT n_nationkey AS code, r_name || '_' || n_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey),
c AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN c_nationkey + 100 ELSE c_nationkey END AS code FROM customer)
SELECT c_custkey, c.code, coalesce(name, 'Unknown') AS category_name,
       CASE WHEN c.code = 1 THEN '스킨케어' WHEN c.code = 2 THEN '선케어' ELSE 'category_' || c.code END AS fixed_name
FROM c LEFT JOIN dim ON c.code = dim.code
""")
def category_lookup(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = v.table(spark, folder, "nation"), v.table(spark, folder, "region")
    dim = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("dim_code"), F.concat_ws("_", "r_name", "n_name").alias("dim_name")
    )
    code = F.when(F.col("c_custkey") % 7 == 0, F.col("c_nationkey") + 100).otherwise(F.col("c_nationkey"))
    customers = v.table(spark, folder, "customer").select("c_custkey", code.alias("code"))
    named = shaping.lookup(customers, dim, "code", "dim_code", "dim_name", "category_name", F.lit("Unknown"))
    written = F.col("code").cast("string")
    fixed = F.when(F.col("code").isin(1, 2), shaping.name_of_code(F.concat(F.lit("10400"), written)))
    return named.withColumn("fixed_name", F.coalesce(fixed, shaping.name_of_code(written)))


@query("category_prefix", """
WITH dim AS (SELECT DISTINCT p_type || '_' || p_brand AS category_name FROM part)
SELECT category_name, 'https://shop.example/' || category_name AS category_url FROM dim WHERE starts_with(category_name, 'ECONOMY')
""")
def category_prefix(spark: SparkSession, folder: str) -> DataFrame:
    dim = v.table(spark, folder, "part").select(F.concat_ws("_", "p_type", "p_brand").alias("category_name")).distinct()
    with_url = dim.withColumn("category_url", F.concat(F.lit("https://shop.example/"), F.col("category_name")))
    return shaping.categories_by_prefix(with_url, "ECONOMY")


@query("safe_name", """
SELECT p_partkey, replace(p_type || '/' || p_name, '/', '&') AS name, replace(replace(p_type || '/' || p_name, '/', '_'), ' ', '_') AS file_name FROM part
""")
def safe_name(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.concat_ws("/", "p_type", "p_name")
    return v.table(spark, folder, "part").select(
        "p_partkey", text.safe_name(raw).alias("name"), text.safe_name(raw, "_", spaces=True).alias("file_name")
    )


@query("product_ids", """
SELECT CAST(p_partkey AS VARCHAR) AS product_id FROM part WHERE p_partkey % 9 <> 0
""")
def product_ids(spark: SparkSession, folder: str) -> DataFrame:
    rows = v.products(spark, folder).withColumn("product_id", F.when(F.col("p_partkey") % 9 == 0, "").otherwise(F.col("product_id")))
    return shaping.product_ids(rows)


@query("conform_reviews", """
SELECT CASE doc_id % 3 WHEN 0 THEN 'a_' WHEN 1 THEN 'b_' ELSE 'c_' END || doc_id AS review_uid,
       CASE doc_id % 3 WHEN 0 THEN 'shop_a' WHEN 1 THEN 'shop_b' ELSE 'shop_c' END AS source,
       CAST(doc_id % 200 AS VARCHAR) AS product_id,
       CASE WHEN doc_id % 3 = 2 AND doc_id % 13 = 0 THEN NULL WHEN doc_id % 3 = 2 AND text = '' THEN NULL ELSE text END AS content,
       CASE WHEN doc_id % 3 = 2 AND doc_id % 23 = 0 THEN NULL ELSE CAST(doc_id % 6 AS INTEGER) END AS star,
       CAST(CASE doc_id % 3 WHEN 0 THEN CASE WHEN doc_id % 2 = 0 THEN '2024-03-05 10:11:12' ELSE '2024-03-05 10:11:12' END
                            WHEN 1 THEN '2024-03-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || ' 00:00:00'
                            ELSE '2024-03-05 00:00:00' END AS VARCHAR) AS created_at
FROM documents
""")
def conform_reviews(spark: SparkSession, folder: str) -> DataFrame:
    doc = F.col("doc_id")
    base = v.table(spark, folder, "documents").withColumn("product_id", (doc % v.PRODUCTS).cast("string"))
    grade = (doc % 6).cast("string")
    a = base.filter(doc % 3 == 0).select(
        doc.cast("string").alias("no"), "product_id", F.col("text").alias("content"), grade.alias("grade"),
        F.when(doc % 2 == 0, "2024-03-05 10:11:12").otherwise("2024-03-05T10:11:12").alias("createDate"),
    )
    b = base.filter(doc % 3 == 1).select(
        doc.cast("string").alias("review_id"), "product_id", F.col("text").alias("content"), grade.alias("rating"),
        F.concat(F.lit("24.03."), F.lpad((doc % 28 + 1).cast("string"), 2, "0"), F.lit(".")).alias("created_at"),
    )
    c = base.filter(doc % 3 == 2).select(
        doc.cast("string").alias("review_id"), "product_id",
        F.when(doc % 13 == 0, "N/A").otherwise(F.col("text")).alias("review"),
        F.when(doc % 23 == 0, "N/A").otherwise(F.concat(F.lit("5점만점에 "), grade, F.lit("점"))).alias("star"),
        F.lit("2024.03.05").alias("date"),
    )
    return shaping.conform_reviews(a, b, c).withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"))


@query("conform_products", """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, CASE p_partkey % 3 WHEN 0 THEN 'shop_a' WHEN 1 THEN 'shop_b' ELSE 'shop_c' END AS source,
       p_name AS name, CASE WHEN p_partkey % 3 = 1 AND p_partkey % 5 = 0 THEN NULL ELSE p_brand END AS brand,
       CASE WHEN p_partkey % 3 = 1 AND p_partkey % 7 = 0 THEN NULL ELSE CAST(round(p_retailprice * 100) AS BIGINT) END AS price,
       CASE WHEN p_partkey % 3 = 0 AND p_partkey % 4 = 0 THEN NULL ELSE p_size / 10.0 END AS rating,
       CASE WHEN p_partkey % 3 = 2 AND p_partkey % 6 = 2 THEN 999 ELSE p_partkey * 7 % 1000 END AS review_count,
       p_type AS category, CASE WHEN p_partkey % 3 = 1 THEN NULL ELSE '/p/' || p_partkey END AS product_url
FROM part
""")
def conform_products(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    part = v.table(spark, folder, "part")
    amount = F.round(F.col("p_retailprice") * 100).cast("bigint")
    size = (F.col("p_size") / 10.0).cast("string")
    count, url = (key * 7 % 1000), F.concat(F.lit("/p/"), key.cast("string"))
    common = [key.cast("string").alias("product_id"), F.col("p_name").alias("name")]
    a = part.filter(key % 3 == 0).select(
        *common, F.col("p_brand").alias("brand"), amount.cast("string").alias("price"),
        F.when(key % 4 == 0, "").otherwise(size).alias("rating"), count.cast("string").alias("review_count"),
        F.col("p_type").alias("category_name"), url.alias("product_url"),
    )
    b = part.filter(key % 3 == 1).select(
        *common, F.when(key % 5 == 0, "N/A").otherwise(F.col("p_brand")).alias("brand"),
        F.when(key % 7 == 0, "N/A").otherwise(amount.cast("string")).alias("price"),
        size.cast("double").alias("rating"), count.alias("review_count"), F.array("p_type", F.lit("x")).alias("categories"),
        F.lit("N/A").alias("product_url"),
    )
    c = part.filter(key % 3 == 2).select(
        *common, F.col("p_brand").alias("brand"), F.concat(F.format_number(amount, 0), F.lit("원")).alias("price"), size.alias("rating"),
        F.when(key % 6 == 2, "999+").otherwise(F.format_number(count, 0)).alias("review_count"),
        F.col("p_type").alias("category"), url.alias("url"),
    )
    return shaping.conform_products(a, b, c)
