"""Queries on JSON payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import nested as nv
from ..functions import numbers, text
from ..operators import payloads
from ..plans import collecting
from . import views as v
from .registry import query

BASE = "https://shop.example/goods/"

_RATE = "CASE WHEN p_size % 5 = 0 THEN 0 ELSE p_size END"
_PRICE = "CAST(round(p_retailprice * 100) AS BIGINT)"


@query("ranking_items", f"""
WITH {v.RANKING_SQL}
SELECT p_type AS category_code, 'category_' || p_type AS category_name, '{v.SCRAPED_AT}' AS scraped_at, page, rank,
       CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, p_brand AS brand, {_PRICE} AS price,
       CASE WHEN {_RATE} > 0 THEN {_PRICE} * 100 // (100 - {_RATE}) END AS original_price,
       CAST({_RATE} AS INTEGER) AS discount_rate,
       CAST(CASE WHEN p_partkey % 3 = 1 THEN p_size ELSE p_size * 2 END AS DOUBLE) AS rating,
       CAST(CASE WHEN p_partkey % 3 = 1 THEN p_partkey % 100 + 1 ELSE p_partkey % 500 END AS BIGINT) AS review_count,
       p_partkey * 7 % 3000 AS likes,
       'https://img.example/' || p_partkey || '.jpg' AS image_url,
       CASE WHEN p_partkey % 5 = 0 THEN 'https://shop.example/p/' ELSE '{BASE}' END || p_partkey AS product_url,
       CASE WHEN p_partkey % 4 = 0 THEN p_partkey % 50 ELSE p_partkey * 7 % 3000 END AS number_of_views,
       CASE WHEN p_partkey % 3 = 0 THEN CAST(trunc(p_size / 10.0 * 1000) AS INTEGER) ELSE 0 END AS sales
FROM v_ranked WHERE p_partkey % 29 <> 0 AND p_partkey % 31 <> 0
""")
def ranking_items(spark: SparkSession, folder: str) -> DataFrame:
    return collecting.ranking_products(v.ranking_payloads(spark, folder), v.SCRAPED_AT, v.RANKING_SPAN, BASE, categories=v.CATEGORIES)


@query("typed_node_ids", """
WITH items AS (SELECT p_partkey, p_type, CAST(floor(p_partkey / 240) AS INTEGER) + 1 AS page FROM part),
firsts AS (SELECT p_type, page, min(p_partkey) AS id FROM items GROUP BY 1, 2),
found AS (
  SELECT p_type, page, id, 0 AS seen FROM firsts UNION ALL
  SELECT i.p_type, i.page, i.p_partkey, 1 FROM items i JOIN firsts f ON i.p_type = f.p_type AND i.page = f.page
  WHERE i.p_partkey % 19 <> 0 AND i.p_partkey <> f.id)
SELECT p_type AS category_code, page, CAST(id AS VARCHAR) AS node_id,
       CAST(row_number() OVER (PARTITION BY p_type, page ORDER BY seen, id) AS INTEGER) AS position
FROM found
""")
def typed_node_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Some payloads begin with a tree of 3,000 levels."""
    pages = v.ranking_payloads(spark, folder).drop("n_items")
    tree = F.concat(F.lit('{"tree":'), F.repeat(F.lit('{"a":'), 3000), F.lit("1"), F.repeat(F.lit("}"), 3000), F.lit(","), F.expr("substr(payload, 2)"))
    deep = F.col("category_code").startswith("PROMO BRUSHED") & (F.col("page") == 1)
    return payloads.find_nodes(pages.withColumn("payload", F.when(deep, tree).otherwise(F.col("payload"))), "payload")


@query("original_price", f"""
WITH {v.PRICE_FACTS}
SELECT l_orderkey, l_linenumber, price, rate, CASE WHEN rate > 0 AND rate <> 100 THEN price * 100 // (100 - rate) END AS original_price
FROM v_price_facts
""")
def original_price(spark: SparkSession, folder: str) -> DataFrame:
    return v.price_facts(spark, folder).withColumn("original_price", numbers.original_price(F.col("price"), F.col("rate")))


@query("coalesce_truthy", """
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 4 THEN CAST(o_custkey + 1 AS VARCHAR) ELSE o_orderpriority END AS value
FROM orders
""")
def coalesce_truthy(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey") % 5
    first = F.when(key == 0, "").when(key == 1, "0").when(key == 2, "0.0").when(key == 4, (F.col("o_custkey") + 1).cast("string"))
    return v.table(spark, folder, "orders").select("o_orderkey", text.coalesce_truthy(first, F.col("o_orderpriority")).alias("value"))


@query("label_text_numbers", """
WITH t AS (
  SELECT l_orderkey, l_linenumber, CAST(floor(l_extendedprice) AS BIGINT) AS n, CAST(l_quantity AS BIGINT) AS q FROM lineitem)
SELECT l_orderkey, l_linenumber,
       CASE WHEN q % 3 = 0 THEN q ELSE n END AS viewers,
       CASE WHEN q % 3 = 0 THEN q ELSE n % 1000 END AS viewers_compat,
       n AS likes, CASE WHEN n >= 1000 THEN n // 1000 ELSE n END AS likes_compat,
       CASE WHEN q % 3 = 0 THEN q ELSE n END AS likes_last,
       CASE WHEN q % 2 = 0 THEN CAST(trunc(q / 10.0 * 1000) AS INTEGER) ELSE 0 END AS sales
FROM t
""")
def label_text_numbers(spark: SparkSession, folder: str) -> DataFrame:
    n, q = F.floor("l_extendedprice"), F.col("l_quantity").cast("bigint")
    phrase = F.lit("명이 보는 중")
    texts = F.array(
        F.lit("무료배송 3일"),
        F.concat(F.format_number(n, 0), phrase),
        F.concat(F.lit("지금 "), phrase),
        F.when(q % 3 == 0, F.concat(q.cast("string"), phrase)).otherwise("오늘"),
    )
    labels = F.array(
        F.lit("판매 많음"),
        F.when(q % 2 == 0, F.concat(F.lit("판매 "), (q / 10.0).cast("string"), F.lit("천개"))).otherwise("신상"),
        F.when(q % 2 == 0, F.lit("판매 99천개")).otherwise("한정"),
    )
    return v.table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        numbers.viewers(texts).alias("viewers"),
        numbers.viewers(texts, compat=True).alias("viewers_compat"),
        numbers.likes(texts).alias("likes"),
        numbers.likes(texts, compat=True).alias("likes_compat"),
        numbers.likes(texts, last=True).alias("likes_last"),
        numbers.sales(labels).alias("sales"),
    )


_CARD_PRICE = "CASE WHEN k % 4 = 0 THEN NULL WHEN k % 4 > 1 THEN CAST(price AS VARCHAR) WHEN k % 8 <> 1 THEN CAST(price + 1000 AS VARCHAR) ELSE 'N/A' END"
_IMAGE = """CASE WHEN k % 3 = 0 THEN 'https://img.example/r' || k || '.jpg' WHEN k % 7 = 0 THEN 'N/A'
            WHEN k % 5 <> 0 THEN 'https://img.example/a' || k || '.jpg' ELSE 'https://img.example/b' || k || '.jpg' END"""
_FLAGGED = """CASE WHEN k % 7 = 0 THEN '' WHEN k % 2 = 0 THEN 'https://img.example/b' || k || '.jpg'
              WHEN k % 5 <> 0 THEN 'https://img.example/a' || k || '.jpg' ELSE '' END"""
_BRAND = "CASE WHEN k % 6 < 2 THEN 'N/A' ELSE p_brand END"
_CATEGORIES = "CASE k % 3 WHEN 0 THEN p_type || '|beauty' WHEN 1 THEN p_type ELSE '' END"


@query("card_items", f"""
WITH {v.CARD_SQL}
SELECT page, product_id, p_name AS name, {_BRAND} AS brand, {_CARD_PRICE} AS price, {_IMAGE} AS image_url,
       CASE WHEN k % 10 = 0 THEN 0 ELSE k % 1000 END AS review_count, p_size / 10.0 AS rating,
       CASE WHEN k % 9 <> 0 THEN 'https://shop.example/window-products/beauty/' || k ELSE 'N/A' END AS product_url,
       {_CATEGORIES} AS categories, CASE WHEN k % 9 <> 0 THEN 'mall' || k % 10 ELSE 'N/A' END AS channel_name,
       '{v.SCRAPED_AT}' AS scraped_at,
       CAST(k - (page - 1) * 100 + 1 AS INTEGER) AS position
FROM v_cards
""")
def card_items(spark: SparkSession, folder: str) -> DataFrame:
    rows = collecting.card_products(v.card_payloads(spark, folder), v.SCRAPED_AT, url_base="https://shop.example/window-products/")
    return rows.withColumn("categories", F.array_join("categories", "|"))


@query("card_items_detail", f"""
WITH {v.CARD_SQL}
SELECT product_id, {_CARD_PRICE} AS price, CASE WHEN k % 8 <> 1 THEN CAST(price + 1000 AS VARCHAR) ELSE 'N/A' END AS original_price,
       CASE k % 3 WHEN 0 THEN 'https://img.example/r' || k || '.jpg' WHEN 1 THEN '' ELSE 'N/A' END AS image_url, 'N/A' AS detail_content
FROM v_cards
""")
def card_items_detail(spark: SparkSession, folder: str) -> DataFrame:
    rows = collecting.card_products(v.card_payloads(spark, folder), v.SCRAPED_AT, variant="detail")
    return rows.select("product_id", "price", "original_price", "image_url", "detail_content")


@query("card_items_discount", f"""
WITH {v.CARD_SQL}
SELECT product_id, p_name AS name, split_part(p_name, ' ', 1) AS brand,
       CASE WHEN k % 5 <> 0 THEN CAST(price - 500 AS VARCHAR) ELSE '' END AS price,
       CASE WHEN k % 4 = 0 THEN NULL WHEN k % 4 > 1 THEN CAST(price AS VARCHAR) ELSE '' END AS original_price,
       CAST(p_size % 30 AS VARCHAR) AS discount_rate,
       CAST(k % 1000 AS VARCHAR) AS review_count,
       '/window/products/' || k AS url, {_FLAGGED} AS image_url
FROM v_cards WHERE k % 10 <> 0
UNION ALL
SELECT product_id, p_name, split_part(p_name, ' ', 1), CASE WHEN k % 5 <> 0 THEN CAST(price - 500 AS VARCHAR) ELSE '' END,
       CASE WHEN k % 4 = 0 THEN NULL WHEN k % 4 > 1 THEN CAST(price AS VARCHAR) ELSE '' END, CAST(p_size % 30 AS VARCHAR), '',
       '/window/products/' || k, {_FLAGGED}
FROM v_cards WHERE k % 10 = 0
""")
def card_items_discount(spark: SparkSession, folder: str) -> DataFrame:
    rows = collecting.card_products(v.card_payloads(spark, folder), v.SCRAPED_AT, "discount", "/window/products/")
    return rows.drop("page", "position", "rating", "scraped_at")


def _cards(spark: SparkSession, folder: str) -> DataFrame:
    cards = payloads.explode_cards(v.card_payloads(spark, folder), "payload")
    return cards.withColumn("product_id", nv.member_text(F.col("product"), "id"))


@query("present_key_default", f"""
WITH {v.CARD_SQL}
SELECT product_id, {_CARD_PRICE} AS price, k % 4 <> 1 AS has_sale_price FROM v_cards
""")
def present_key_default(spark: SparkSession, folder: str) -> DataFrame:
    product = F.col("product")
    return _cards(spark, folder).select("product_id", payloads.card_price(product).alias("price"), nv.has_key(product, "salePrice").alias("has_sale_price"))


@query("pick_image", f"""
WITH {v.CARD_SQL}
SELECT product_id, {_IMAGE} AS by_field, {_FLAGGED} AS by_flag FROM v_cards
""")
def pick_image(spark: SparkSession, folder: str) -> DataFrame:
    product = F.col("product")
    return _cards(spark, folder).select("product_id", payloads.pick_image(product).alias("by_field"), payloads.pick_image(product, "flag").alias("by_flag"))


@query("category_names", f"""
WITH {v.CARD_SQL}
SELECT product_id, {_CATEGORIES} AS categories, CASE k % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS n_categories FROM v_cards
""")
def category_names(spark: SparkSession, folder: str) -> DataFrame:
    names = payloads.category_names(F.col("product"))
    return _cards(spark, folder).select("product_id", F.array_join(names, "|").alias("categories"), F.size(names).alias("n_categories"))


@query("brand_first_word", f"""
WITH {v.CARD_SQL}
SELECT product_id, {_BRAND} AS brand, split_part(p_name, ' ', 1) AS first_word FROM v_cards
""")
def brand_first_word(spark: SparkSession, folder: str) -> DataFrame:
    product = F.col("product")
    return _cards(spark, folder).select("product_id", payloads.brand_of(product).alias("brand"), payloads.brand_of(product, "first_word").alias("first_word"))


@query("review_envelope", f"""
SELECT CAST(doc_id % 200 AS VARCHAR) AS product_id, CAST(floor(doc_id / 4000) AS INTEGER) + 1 AS page,
       CAST(row_number() OVER (PARTITION BY doc_id % 200, floor(doc_id / 4000) ORDER BY doc_id) AS INTEGER) AS position,
       '{v.SCRAPED_AT}' AS scraped_at, '104001' AS category_code, '스킨케어' AS category_name, doc_id AS no, text AS content
FROM documents
""")
def review_envelope(spark: SparkSession, folder: str) -> DataFrame:
    from ..operators.shaping import name_of_code

    stamps = {"scraped_at": F.lit(v.SCRAPED_AT), "category_code": F.lit("104001"), "category_name": name_of_code(F.lit("104001"))}
    rows = payloads.explode_reviews(v.review_payloads(spark, folder), "payload", stamps)
    review = F.col("review")
    return rows.withColumns({"no": F.try_variant_get(review, "$.no", "bigint"), "content": nv.as_text(review, "$.content")}).drop("review")


@query("flatten_reviews", f"""
SELECT CAST(doc_id % 200 AS VARCHAR) AS product_id, CAST(floor(doc_id / 4000) AS INTEGER) + 1 AS page,
       CAST(row_number() OVER (PARTITION BY doc_id % 200, floor(doc_id / 4000) ORDER BY doc_id) AS INTEGER) AS position,
       CASE WHEN doc_id % 10 = 0 THEN 'own' ELSE '{v.SCRAPED_AT}' END AS scraped_at,
       CAST(doc_id AS VARCHAR) AS no, text AS content, CAST(doc_id % 6 AS VARCHAR) AS grade, source AS user_nick,
       CAST(doc_id % 7 AS VARCHAR) AS user_level, '["' || lang || '","' || source || '"]' AS tags,
       CASE WHEN doc_id % 3 = 0 THEN 'set' END AS option, CASE WHEN doc_id % 3 = 1 THEN 'dry' END AS survey_skin
FROM documents
""")
def flatten_reviews(spark: SparkSession, folder: str) -> DataFrame:
    rows = payloads.explode_reviews(v.review_payloads(spark, folder), "payload", {"scraped_at": F.lit(v.SCRAPED_AT)})
    names = ["no", "content", "grade", ("user", "nick"), ("user", "level"), "tags", "option", ("survey", "skin"), "scraped_at"]
    return payloads.flatten_one_level(rows, keys=[n if isinstance(n, tuple) else (n, None) for n in names])


@query("flatten_fields", """
SELECT CAST(doc_id % 200 AS VARCHAR) AS product_id, CAST(floor(doc_id / 4000) AS INTEGER) + 1 AS page, field, value FROM (
  SELECT doc_id, 'no' AS field, CAST(doc_id AS VARCHAR) AS value FROM documents UNION ALL
  SELECT doc_id, 'content', text FROM documents WHERE text IS NOT NULL UNION ALL
  SELECT doc_id, 'grade', CAST(doc_id % 6 AS VARCHAR) FROM documents UNION ALL
  SELECT doc_id, 'user_nick', source FROM documents WHERE source IS NOT NULL UNION ALL
  SELECT doc_id, 'user_level', CAST(doc_id % 7 AS VARCHAR) FROM documents UNION ALL
  SELECT doc_id, 'tags', '["' || lang || '","' || source || '"]' FROM documents UNION ALL
  SELECT doc_id, 'option', 'set' FROM documents WHERE doc_id % 3 = 0 UNION ALL
  SELECT doc_id, 'survey_skin', 'dry' FROM documents WHERE doc_id % 3 = 1 UNION ALL
  SELECT doc_id, 'scraped_at', 'own' FROM documents WHERE doc_id % 10 = 0)
""")
def flatten_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews of unknown shape: one row per field."""
    rows = payloads.explode_reviews(v.review_payloads(spark, folder), "payload")
    return payloads.flatten_to_map(rows).select("product_id", "page", F.explode("fields").alias("field", "value"))


@query("card_category_ids", """
WITH c AS (SELECT CAST(p_partkey AS VARCHAR) AS product_id, ['스킨케어', '마스크_팩', '향수', 'other'][p_partkey % 4 + 1] AS name FROM part)
SELECT product_id, name, CASE name WHEN '스킨케어' THEN '20006492' WHEN '마스크_팩' THEN '20006513' WHEN '향수' THEN '20006681' END AS category_id FROM c
""")
def card_category_ids(spark: SparkSession, folder: str) -> DataFrame:
    from ..operators.shaping import code_of_name

    names = F.array(*[F.lit(n) for n in ("스킨케어", "마스크_팩", "향수", "other")])
    rows = v.products(spark, folder).select("product_id", F.element_at(names, (F.col("p_partkey") % 4 + 1).cast("int")).alias("name"))
    return rows.withColumn("category_id", code_of_name(F.col("name")))


@query("payload_reviews", f"""
SELECT CAST(doc_id % 200 AS VARCHAR) AS product_id, CAST(doc_id AS VARCHAR) AS no, text AS content, source AS user_nick
FROM documents
""")
def payload_reviews(spark: SparkSession, folder: str) -> DataFrame:
    pages = v.review_payloads(spark, folder)
    keys = [("no", None), ("content", None), ("user", "nick")]
    rows = collecting.payload_reviews(pages.unionByName(pages), v.SCRAPED_AT, "no", [F.col("page"), F.col("position")], keys)
    return rows.drop("page", "position", "scraped_at")


@query("union_ragged", f"""
WITH {v.REVIEWS}
SELECT review_uid AS id, star, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS DOUBLE) AS price, source FROM v_reviews UNION ALL
SELECT CAST(p_partkey AS VARCHAR), NULL, p_name, p_retailprice, NULL FROM part UNION ALL
SELECT CAST(s_suppkey AS VARCHAR), NULL, s_name, NULL, 'supplier' FROM supplier
""")
def union_ragged(spark: SparkSession, folder: str) -> DataFrame:
    reviews = v.reviews(spark, folder).select(F.col("review_uid").alias("id"), "star", "source")
    products = v.products(spark, folder).select(F.col("product_id").alias("id"), "name", "price")
    suppliers = v.table(spark, folder, "supplier").select(F.lit("supplier").alias("source"), F.col("s_name").alias("name"), F.col("s_suppkey").cast("string").alias("id"))
    return payloads.union_all([reviews, products, suppliers])


@query("json_profile", """
WITH d AS (SELECT doc_id, doc_id % 200 AS product, floor(doc_id / 4000) AS page FROM documents),
g AS (SELECT count(*) AS n FROM d GROUP BY product, page)
SELECT '$' AS path, 'object' AS kind, count(*) AS n_nodes, 1 AS min_items, 1 AS max_items FROM g UNION ALL
SELECT '$.data', 'object', count(*), 1, 1 FROM g UNION ALL
SELECT '$.data.list', 'array', count(*), min(n), max(n) FROM g UNION ALL
SELECT '$.data.list[]', 'object', count(*),
       min(5 + CAST(doc_id % 3 <> 2 AS INTEGER) + CAST(doc_id % 10 = 0 AS INTEGER)),
       max(5 + CAST(doc_id % 3 <> 2 AS INTEGER) + CAST(doc_id % 10 = 0 AS INTEGER)) FROM d UNION ALL
SELECT '$.data.list[].no', 'number', count(*), NULL, NULL FROM d UNION ALL
SELECT '$.data.list[].content', 'string', count(*), NULL, NULL FROM d UNION ALL
SELECT '$.data.list[].grade', 'string', count(*), NULL, NULL FROM d UNION ALL
SELECT '$.data.list[].user', 'object', count(*), 2, 2 FROM d UNION ALL
SELECT '$.data.list[].user.nick', 'string', count(*), NULL, NULL FROM d UNION ALL
SELECT '$.data.list[].user.level', 'number', count(*), NULL, NULL FROM d UNION ALL
SELECT '$.data.list[].tags', 'array', count(*), 2, 2 FROM d UNION ALL
SELECT '$.data.list[].tags[]', 'string', count(*) * 2, NULL, NULL FROM d UNION ALL
SELECT '$.data.list[].option', 'string', count(*), NULL, NULL FROM d WHERE doc_id % 3 = 0 UNION ALL
SELECT '$.data.list[].survey', 'object', count(*), 1, 1 FROM d WHERE doc_id % 3 = 1 UNION ALL
SELECT '$.data.list[].survey.skin', 'string', count(*), NULL, NULL FROM d WHERE doc_id % 3 = 1 UNION ALL
SELECT '$.data.list[].scraped_at', 'string', count(*), NULL, NULL FROM d WHERE doc_id % 10 = 0
""")
def json_profile(spark: SparkSession, folder: str) -> DataFrame:
    return payloads.json_profile(v.review_payloads(spark, folder), "payload")


@query("first_existing_path", """
SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'data -> products' WHEN 1 THEN 'data -> window -> cards'
                    WHEN 2 THEN 'data -> items' WHEN 3 THEN 'data -> results' END AS found_path,
       CAST(CASE p_partkey % 5 WHEN 0 THEN 2 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN length(p_name) END AS INTEGER) AS n_found
FROM part
""")
def first_existing_path(spark: SparkSession, folder: str) -> DataFrame:
    return payloads.first_existing_path(v.shaped_payloads(spark, folder), "payload")


@query("keys_like", """
SELECT DISTINCT CAST(floor(p_partkey / 100) AS INTEGER) + 1 AS page, 'totalCount' AS count_keys, 'page|pageInfo' AS page_keys FROM part
""")
def keys_like(spark: SparkSession, folder: str) -> DataFrame:
    top = nv.as_object(nv.parsed(F.col("payload")), "$.data.pagedCards")
    return v.card_payloads(spark, folder).select(
        "page",
        F.array_join(payloads.keys_like(top, ["total", "count"]), "|").alias("count_keys"),
        F.array_join(payloads.keys_like(top, ["page", "info"]), "|").alias("page_keys"),
    )
