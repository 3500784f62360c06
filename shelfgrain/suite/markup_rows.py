"""Queries on HTML pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import markup as mk
from ..functions import numbers, text
from ..operators import markup, shaping
from ..plans import collecting
from ..session import scratch_dir
from ..sources import landing
from . import views as v
from .registry import query

BASE = "https://shop.example"
_STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_PRICE = "format('{:,}', CAST(round(p_retailprice * 100) AS BIGINT))"


@query("html_links", r"""
WITH navs AS (SELECT page_id, regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1) AS nav FROM pages),
links AS (
  SELECT page_id, unnest(regexp_extract_all(nav, '<a href="([^"]*)">', 1)) AS href,
         unnest(regexp_extract_all(nav, '<a href="[^"]*">([^<]*)</a>', 1)) AS link_text,
         unnest(range(1, len(regexp_extract_all(nav, '<a href="([^"]*)">', 1)) + 1)) AS position
  FROM navs),
plain AS (
  SELECT page_id, CAST(position AS INTEGER) AS position, replace(replace(href, '&quot;', '"'), '&amp;', '&') AS href,
         trim(replace(replace(link_text, '&quot;', '"'), '&amp;', '&')) AS link_text
  FROM links)
SELECT *, replace(link_text, '/', '_') AS safe_name FROM plain
""")
def html_links(spark: SparkSession, folder: str) -> DataFrame:
    links = markup.extract_links(v.table(spark, folder, "pages").select("page_id", "html"))
    return links.withColumn("safe_name", text.safe_name(F.col("link_text"), "_"))


_LISTED = f"""
SELECT CAST(floor(p_partkey / 24) AS INTEGER) AS page, CAST(p_partkey % 24 + 1 AS INTEGER) AS position,
       'A' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS product_id, p_name || ' & <set>' AS name, p_brand AS brand,
       CASE WHEN p_partkey % 11 = 0 THEN '' ELSE {_PRICE} END AS price,
       CASE WHEN p_partkey % 4 = 0 THEN 'https://other.example' ELSE '{BASE}' END || '/goods/detail?goodsNo=A' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') || '&t=1' AS url,
       printf('%.1f', p_size * 2 / 20.0) AS rating,
       CASE WHEN p_partkey % 6 = 0 THEN '' WHEN p_partkey % 7 = 0 THEN '999+' ELSE format('{{:,}}', p_partkey * 9) END AS review_count
FROM part
"""


@query("html_fields", _LISTED)
def html_fields(spark: SparkSession, folder: str) -> DataFrame:
    return markup.extract_products(v.listing_pages(spark, folder), base=BASE)


@query("html_menu", """
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY n) AS INTEGER) AS entry, name, url FROM (
  SELECT page_id, 1 AS n, 'care_all' AS name, '/menu/' || page_id || '?sort=DISPLAY_CATEGORY_GENDER_AGE_GROUP_F20' AS url FROM pages UNION ALL
  SELECT page_id, 3, 'sun', '/sun?x=1&sort=DISPLAY_CATEGORY_GENDER_AGE_GROUP_F20' FROM pages)
""")
def html_menu(spark: SparkSession, folder: str) -> DataFrame:
    entry = '<li class="displayCategoryImageMenu_list__eEKrH">{}<span class="displayCategoryImageMenu_title__Wizki"> {} </span></button>'
    html = v.text_of(
        "<ul>", entry.format('<button data-shp-contents-id="/menu/', "").split("<span")[0], F.col("page_id"), '">',
        '<span class="displayCategoryImageMenu_title__Wizki"> care/all </span></button>',
        entry.format("<button>", "no url"), entry.format('<button data-shp-contents-id="/sun?x=1&amp;sort=RECENT">', "sun"), "</ul>",
    )
    pages = v.table(spark, folder, "pages").select("page_id", html.alias("html"))
    rows = markup.extract_menu(pages)
    return rows.select("page_id", F.when(F.col("position") == 3, 2).otherwise(F.col("position")).alias("entry"), "name", "url")


@query("url_fields", r"""
SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host,
       regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path,
       CASE WHEN regexp_matches(url, '[?&]page=') THEN regexp_extract(url, '[?&]page=([^&#]*)', 1) END AS page_param,
       regexp_extract(url, '/en/([0-9]+)', 1) AS en_id,
       regexp_extract(url || '&goodsNo=A00' || page_id, 'goodsNo=([A-Z0-9]+)', 1) AS goods_no,
       'https://shop.example/p/' || page_id AS absolute
FROM pages
""")
def url_fields(spark: SparkSession, folder: str) -> DataFrame:
    url, key = F.col("url"), F.col("page_id").cast("string")
    return v.table(spark, folder, "pages").select(
        "page_id",
        F.try_parse_url(url, F.lit("HOST")).alias("host"),
        F.try_parse_url(url, F.lit("PATH")).alias("path"),
        F.try_parse_url(url, F.lit("QUERY"), F.lit("page")).alias("page_param"),
        text.id_from_path(url, "en").alias("en_id"),
        text.id_from_query(F.concat(url, F.lit("&goodsNo=A00"), key)).alias("goods_no"),
        text.absolute_url(F.concat(F.lit("/p/"), key), BASE).alias("absolute"),
    )


@query("rating_from_width", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN '' ELSE printf('%.1f', l_quantity * 2 / 20) END AS rating FROM lineitem
""")
def rating_from_width(spark: SparkSession, folder: str) -> DataFrame:
    style = F.when(F.col("l_linenumber") == 7, "color:red").otherwise(
        F.concat(F.lit("height:3px; width: "), (F.col("l_quantity") * 2).cast("string"), F.lit("%"))
    )
    return v.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", numbers.rating_from_width(style).alias("rating"))


@query("count_in_parens", """
WITH t AS (SELECT l_orderkey, l_linenumber, CAST(floor(l_extendedprice) AS BIGINT) AS n FROM lineitem)
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 THEN '999' ELSE format('{:,}', n) END AS count_text,
       CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 THEN 999 ELSE n END AS count_value,
       l_linenumber = 6 AS capped
FROM t
""")
def count_in_parens(spark: SparkSession, folder: str) -> DataFrame:
    line = F.col("l_linenumber")
    shown = F.when(line == 7, "리뷰 없음").when(line == 6, "리뷰(999+)").otherwise(
        F.concat(F.lit("리뷰 ("), F.format_number(F.floor("l_extendedprice"), 0), F.lit(")"))
    )
    return v.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber",
        numbers.parens_count_text(shown).alias("count_text"),
        numbers.parens_count(shown).alias("count_value"),
        numbers.parens_count_capped(shown).alias("capped"),
    )


_REVIEWS = f"""
d AS (
  SELECT doc_id, doc_id % 200 AS product, CAST(floor(doc_id / 4000) AS INTEGER) + 1 AS page, n_chars,
         CASE WHEN doc_id % 29 <> 0 THEN {_STRIP.format('text')} END AS review,
         CASE WHEN doc_id % 23 <> 0 THEN doc_id % 6 || '점' END AS star FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY product, page ORDER BY doc_id) AS position FROM d)"""
_UID = "CASE WHEN doc_id % 5 <> 0 THEN CAST(doc_id AS VARCHAR) ELSE 'item ' || product || '_' || page || '_' || position END"


@query("html_blocks", f"""
WITH {_REVIEWS}
SELECT CAST(product AS VARCHAR) AS product_id, page, CAST(position AS INTEGER) AS position, 'item ' || product AS product_name,
       format('{{:,}}', product * 100) AS total_review_count, {_UID} AS review_id, star, review,
       CASE WHEN doc_id % 4 = 0 THEN '지성' END AS skin_type, '2024.03.' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') AS date,
       CASE WHEN doc_id % 3 = 0 THEN '매장' ELSE '온라인' END AS purchase_type,
       CASE WHEN doc_id % 5 <> 0 THEN CAST(n_chars % 100 AS VARCHAR) ELSE '0' END AS helpful
FROM placed WHERE star IS NOT NULL OR coalesce(length(review), 0) > 5
""")
def html_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return markup.extract_reviews(v.review_pages(spark, folder))


@query("review_uid", f"""
WITH {_REVIEWS}
SELECT doc_id, {_UID} AS review_id FROM placed
""")
def review_uid(spark: SparkSession, folder: str) -> DataFrame:
    from ..operators.ordering import numbered

    doc = F.col("doc_id")
    rows = v.table(spark, folder, "documents").select("doc_id", (doc % v.PRODUCTS).alias("product"), (F.floor(doc / v.REVIEW_SPAN) + 1).cast("int").alias("page"))
    placed = numbered(rows, ["product", "page"], "doc_id")
    element_id = F.when(doc % 5 != 0, F.concat(F.lit("gdas_"), doc.cast("string"))).otherwise("")
    name = F.concat(F.lit("item "), F.col("product").cast("string"))
    return placed.select("doc_id", text.review_uid(element_id, name, F.col("page"), F.col("position")).alias("review_id"))


@query("marker_flag", """
SELECT page_id, CASE WHEN contains(html, 'class="ad"') THEN '매장' ELSE '온라인' END AS purchase_type FROM pages
""")
def marker_flag(spark: SparkSession, folder: str) -> DataFrame:
    marked = F.contains(F.col("html"), F.lit('class="ad"'))
    return v.table(spark, folder, "pages").select("page_id", text.purchase_type(marked).alias("purchase_type"))


@query("valid_review", f"""
WITH {v.REVIEWS}
SELECT review_uid FROM v_reviews WHERE star IS NOT NULL OR length(content) > 5
""")
def valid_review(spark: SparkSession, folder: str) -> DataFrame:
    return v.reviews(spark, folder).filter(text.valid_review(F.col("star"), F.col("content"))).select("review_uid")


@query("breadcrumb", """
SELECT DISTINCT CAST(doc_id % 200 AS VARCHAR) AS product_id, CAST(floor(doc_id / 4000) AS INTEGER) + 1 AS page,
       CASE doc_id % 200 % 3 WHEN 0 THEN 'care' WHEN 1 THEN 'care_skin' ELSE 'care_skin&toner&mist' END AS category_name
FROM documents
""")
def breadcrumb(spark: SparkSession, folder: str) -> DataFrame:
    return markup.extract_breadcrumb(v.review_pages(spark, folder))


@query("html_details", """
SELECT p_partkey, CASE WHEN p_partkey % 3 <> 0 THEN p_name || p_type ELSE '' END AS description,
       CASE WHEN p_partkey % 4 <> 0 THEN 'water, ' || p_brand ELSE '' END AS ingredients,
       CASE WHEN p_partkey % 5 <> 0 THEN 'apply' ELSE '' END AS how_to_use,
       'a' || p_partkey || '.jpg' || CASE WHEN p_partkey % 2 = 0 THEN '|b' || p_partkey || '.jpg' ELSE '' END AS images
FROM part
""")
def html_details(spark: SparkSession, folder: str) -> DataFrame:
    return markup.extract_details(v.detail_pages(spark, folder)).withColumn("images", F.array_join("images", "|"))


@query("guarded_coalesce", f"""
WITH {v.LOOSE_SQL}
SELECT page, doc_id,
       CASE doc_id % 4 WHEN 0 THEN '3.5' WHEN 1 THEN '4.5' ELSE '' END AS rating,
       CASE doc_id % 3 WHEN 0 THEN 'good' WHEN 1 THEN 'fine' ELSE '' END AS title,
       CASE WHEN length(body) > 10 THEN body ELSE '' END AS content,
       'u' || doc_id % 9 AS author, '2024-07-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') AS date,
       CASE WHEN doc_id % 8 < 6 THEN CAST(doc_id % 11 AS VARCHAR) ELSE '' END AS helpful_count
FROM v_loose WHERE length(body) > 10 OR doc_id % 4 < 2
""")
def guarded_coalesce(spark: SparkSession, folder: str) -> DataFrame:
    pages = mk.with_nodes(v.loose_review_pages(spark, folder))
    items = mk.extract_rows(pages, [mk.element("div", "Review_box"), mk.element("li", "list-item"), mk.element("li")])
    # bare lists start with one extra item; blocks otherwise follow the document ids
    numbered = items.withColumn("doc_id", F.col("page") * 20 + F.col("position") - F.when(F.col("page") % 3 == 2, 2).otherwise(1))
    kept = numbered.filter(F.col("doc_id") >= F.col("page") * 20).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return markup.generic_review(kept).drop("position")


@query("candidate_blocks", f"""
WITH {v.LOOSE_SQL}, blocks AS (
  SELECT page, CASE WHEN page % 3 = 2 THEN 'long_item' ELSE 'container' END AS via, doc_id,
         CASE WHEN doc_id % 9 = 0 THEN '9' ELSE '' END || CASE doc_id % 4 WHEN 1 THEN '4.5' ELSE '' END || CASE doc_id % 3 WHEN 0 THEN 'good' WHEN 1 THEN 'fine' ELSE '' END
         || CASE WHEN doc_id % 5 = 0 THEN 'short' ELSE '' END || body || CASE WHEN doc_id % 6 = 0 THEN '평점 5' ELSE '' END
         || 'u' || doc_id % 9 || CASE WHEN doc_id % 7 = 0 THEN 'today' ELSE '' END
         || '2024-07-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || CASE WHEN doc_id % 8 < 4 THEN 'none' ELSE '' END
         || CASE WHEN doc_id % 8 < 6 THEN CAST(doc_id % 11 AS VARCHAR) ELSE '' END AS block_text
  FROM v_loose),
kept AS (SELECT * FROM blocks WHERE via = 'container' OR length(block_text) > 30)
SELECT page, via, CAST(row_number() OVER (PARTITION BY page ORDER BY doc_id) AS INTEGER) AS position, md5(block_text) AS digest FROM kept
""")
def candidate_blocks(spark: SparkSession, folder: str) -> DataFrame:
    blocks = markup.candidate_blocks(v.loose_review_pages(spark, folder))
    whole = mk.tight_text_of(F.col("block"), F.get(F.col("block"), F.lit(0)))
    return blocks.select("page", "via", "position", F.md5(whole).alias("digest"))


@query("opinion_text", r"""
SELECT doc_id FROM documents
WHERE length(regexp_replace(text, '^\s+|\s+$', '', 'g')) > 50 AND (contains(text, 'tion') OR contains(text, 'sch') OR contains(text, '만족'))
""")
def opinion_text(spark: SparkSession, folder: str) -> DataFrame:
    return v.table(spark, folder, "documents").filter(text.opinion_text(F.col("text"), ["tion", "sch", "만족"])).select("doc_id")


@query("total_items", """
SELECT DISTINCT CAST(floor(p_partkey / 24) AS INTEGER) AS page,
       CAST(CASE CAST(floor(p_partkey / 24) AS INTEGER) % 4 WHEN 0 THEN 1385 WHEN 1 THEN 288 ELSE 24 END AS BIGINT) AS total_items,
       CAST(CASE CAST(floor(p_partkey / 24) AS INTEGER) % 4 WHEN 0 THEN 1 WHEN 1 THEN 288 ELSE 24 END AS BIGINT) AS total_items_compat
FROM part
""")
def total_items(spark: SparkSession, folder: str) -> DataFrame:
    pages = v.listing_pages(spark, folder).withColumn("copy", F.col("html"))
    totals = markup.page_totals(pages)
    return markup.page_totals(totals.withColumnRenamed("total_items", "comma_aware"), "copy", compat=True).select(
        "page", F.col("comma_aware").alias("total_items"), F.col("total_items").alias("total_items_compat")
    )


@query("first_with_dot", f"""
SELECT conv_id, turn, 'r' || conv_id || '-' || turn AS review_id, role AS username,
       '24.03.' || lpad(CAST(conv_id % 28 + 1 AS VARCHAR), 2, '0') || '.' AS created_at,
       CASE WHEN turn % 2 = 0 THEN CAST(conv_id % 5 + 1 AS VARCHAR) END AS rating, {_STRIP.format('text')} AS content,
       CASE WHEN turn % 4 = 1 THEN '옵션: 50ml' END AS option
FROM conversations
""")
def first_with_dot(spark: SparkSession, folder: str) -> DataFrame:
    rows = markup.extract_review_spans(v.span_review_pages(spark, folder))
    turn = F.split_part(F.col("review_id"), F.lit("-"), F.lit(2)).cast("bigint")
    return rows.withColumn("turn", turn).drop("part", "position")


@query("stamp_metadata", f"""
WITH {v.REVIEWS}
SELECT review_uid, 'skin' AS category, product_id, '랭킹순' AS sort_option, '2025-07-02T09:30:00' AS crawling_timestamp,
       '2025-07-02' AS crawling_date, '09:30:00' AS crawling_time, 'shop_c' AS source, 'reviews' AS data_type
FROM v_reviews WHERE content IS NOT NULL AND content <> ''
""")
def stamp_metadata(spark: SparkSession, folder: str) -> DataFrame:
    import datetime as dt

    rows = shaping.stamp(v.reviews(spark, folder).select("review_uid", "content", "product_id"), category="skin", sort_option="랭킹순").drop("content")
    return shaping.category_metadata(rows, dt.datetime(2025, 7, 2, 9, 30), "shop_c", "reviews")


@query("html_grid", f"""
SELECT CAST(floor(p_partkey / 60) AS BIGINT) AS grid, CAST(p_partkey % 60 + 1 AS INTEGER) AS position,
       CASE WHEN p_partkey % 13 <> 0 THEN CAST(p_partkey AS VARCHAR) ELSE '' END AS product_id, p_brand AS brand,
       CASE WHEN p_partkey % 17 <> 0 THEN p_name ELSE '' END AS product_name,
       CASE p_partkey % 5 WHEN 0 THEN '0' WHEN 1 THEN {_PRICE} || '원' ELSE p_size || '%' END AS discount,
       CASE p_partkey % 5 WHEN 0 THEN '0' ELSE {_PRICE} || '원' END AS price,
       CASE WHEN p_partkey % 4 = 0 THEN '0' ELSE '관심 ' || p_partkey % 100 END AS interest,
       CASE WHEN p_partkey % 4 <> 0 AND p_partkey % 3 = 0 THEN '구매 ' || p_partkey % 50 ELSE '0' END AS purchase
FROM part
""")
def html_grid(spark: SparkSession, folder: str) -> DataFrame:
    return markup.extract_grid(v.grid_pages(spark, folder))


@query("selector_profile", """
WITH p AS (SELECT p_partkey AS k, CAST(floor(p_partkey / 24) AS INTEGER) % 3 AS form FROM part)
SELECT pattern, n_elements FROM (
  SELECT 'tx_' AS pattern, CAST(sum(CASE WHEN k % 11 = 0 THEN 2 WHEN k % 3 = 0 THEN 4 ELSE 6 END) AS BIGINT) AS n_elements FROM p
  UNION ALL SELECT 'prd_thumb', count(*) FROM p
  UNION ALL SELECT 'prd_item', count(*) FROM p WHERE form = 1
  UNION ALL SELECT 'info new', count(*) FROM p WHERE form = 0)
WHERE n_elements > 5
""")
def selector_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Classes in double quotes, in single quotes, and next to stray quotes."""
    return markup.selector_profile(v.listing_pages(spark, folder), ["tx_", "prd_thumb", "prd_item", "info new", "no such class"])


_CENTS = "CAST(round(p_retailprice * 100) AS BIGINT)"


@query("products_job", f"""
WITH {v.RANKING_SQL}, {v.CARD_SQL},
a AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, 'shop_a' AS shop, p_name AS name, p_brand AS brand, {_CENTS} AS price,
         CAST(CASE WHEN p_partkey % 3 = 1 THEN p_size ELSE p_size * 2 END AS DOUBLE) AS rating,
         CAST(CASE WHEN p_partkey % 3 = 1 THEN p_partkey % 100 + 1 ELSE p_partkey % 500 END AS BIGINT) AS review_count,
         'category_' || p_type AS category, CASE WHEN p_partkey % 5 = 0 THEN 'https://shop.example/p/' ELSE '/goods/' END || p_partkey AS product_url
  FROM v_ranked WHERE p_partkey % 29 <> 0 AND p_partkey % 31 <> 0),
b AS (
  SELECT product_id, 'shop_b', p_name, CASE WHEN k % 6 >= 2 THEN p_brand END,
         CAST(CASE WHEN k % 4 > 1 THEN price WHEN k % 4 = 1 AND k % 8 <> 1 THEN price + 1000 END AS BIGINT), p_size / 10.0,
         CAST(CASE WHEN k % 10 = 0 THEN 0 ELSE k % 1000 END AS BIGINT), CASE WHEN k % 3 < 2 THEN p_type END,
         CASE WHEN k % 9 <> 0 THEN '/window-products/beauty/' || k END
  FROM v_cards),
c AS (
  SELECT 'A' || lpad(CAST(p_partkey AS VARCHAR), 9, '0'), 'shop_c', p_name || ' & <set>', p_brand, CASE WHEN p_partkey % 11 <> 0 THEN {_CENTS} END,
         CAST(printf('%.1f', p_size * 2 / 20.0) AS DOUBLE),
         CAST(CASE WHEN p_partkey % 6 = 0 THEN NULL WHEN p_partkey % 7 = 0 THEN 999 ELSE p_partkey * 9 END AS BIGINT),
         'list ' || CAST(floor(p_partkey / 24) AS INTEGER) % 4,
         CASE WHEN p_partkey % 4 = 0 THEN 'https://other.example' ELSE '{BASE}' END || '/goods/detail?goodsNo=A' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') || '&t=1'
  FROM part)
SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c
""")
def products_job(spark: SparkSession, folder: str) -> DataFrame:
    """From the pages of all shops to landed files of the conformed table, and back."""
    root = scratch_dir(spark, "products")
    page = F.col("page")
    # every listing page was collected twice; behind its last page a category has an empty one, and goes on with other products
    full = v.listing_pages(spark, folder).withColumn("n_items", F.lit(24)).withColumn("category", F.concat(F.lit("list "), page % 4))
    last = F.broadcast(full.groupBy("category").agg(F.max("page").alias("last")))  # four rows
    first = full.filter(page < 4).join(last, "category")
    empty = first.withColumns({"page": (F.col("last") + 4).cast("int"), "n_items": F.lit(0), "html": F.lit("<html><body><ul></ul></body></html>")})
    behind = first.withColumns({"page": (F.col("last") + 8).cast("int"), "html": F.replace("html", F.lit("goodsNo=A"), F.lit("goodsNo=Z"))})
    lists = full.unionByName(empty.drop("last")).unionByName(behind.drop("last"))
    rows = collecting.dim_products(
        v.ranking_payloads(spark, folder), v.card_payloads(spark, folder), lists.unionByName(lists), v.SCRAPED_AT, v.RANKING_SPAN, BASE, v.CATEGORIES
    ).withColumnRenamed("source", "shop")
    collecting.land(rows, root, "all", "products", F.col("category"), F.lit("2025-07-02").cast("date"))
    stored = T.StructType([f for f in rows.schema.fields if f.name != "category"])
    read = landing.csv_reader(spark).option("recursiveFileLookup", True).schema(stored).csv(root)
    return landing.with_path_fields(read, ["category"])
