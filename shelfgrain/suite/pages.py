"""Queries on the request frontier and page control."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import text
from ..operators import ordering, paging
from ..session import scratch_dir
from ..sources import landing
from ..streaming.pages import drain_pages, kept_pages
from . import views as v
from .registry import ORACLES, query

FRONTIER_SORTS = ["POPULARITY", "RECENT"]


@query("frontier", """
WITH jobs AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, CAST(ceil(p_size / 20.0) AS BIGINT) AS n FROM part),
pages AS (SELECT product_id, CAST(unnest(generate_series(1, n)) AS INTEGER) AS page FROM jobs)
SELECT product_id, page, sort,
       'page=' || page || '&pageSize=20&goodsNo=' || product_id || '&sort=' || sort AS request,
       'params=' || replace(url_encode('{"page":' || page || ',"pageSize":20,"sort":"' || sort || '","menu":"a/b c"}'), '%2F', '/') AS encoded
FROM pages, (VALUES ('POPULARITY'), ('RECENT')) AS s(sort)
""")
def frontier(spark: SparkSession, folder: str) -> DataFrame:
    jobs = v.products(spark, folder).select("product_id", (F.col("rating") * 10).cast("bigint").alias("total"))
    rows = paging.frontier(jobs, paging.page_count(F.col("total"), 20), FRONTIER_SORTS)
    request = paging.query_string([("page", F.col("page")), ("pageSize", F.lit(20)), ("goodsNo", F.col("product_id")), ("sort", F.col("sort"))])
    encoded = paging.json_parameter({"page": F.col("page"), "pageSize": F.lit(20), "sort": F.col("sort"), "menu": F.lit("a/b c")})
    return rows.select("product_id", "page", "sort", request.alias("request"), F.concat(F.lit("params="), encoded).alias("encoded"))


@query("page_count", """
SELECT o_orderkey, CAST(ceil(floor(o_totalprice) / 24) AS BIGINT) AS pages,
       least(CAST(ceil(floor(o_totalprice) / 24) AS BIGINT), 50) AS capped_pages
FROM orders
""")
def page_count(spark: SparkSession, folder: str) -> DataFrame:
    total = F.floor("o_totalprice")
    return v.table(spark, folder, "orders").select(
        "o_orderkey", paging.page_count(total, 24).alias("pages"), paging.page_count(total, 24, 50).alias("capped_pages")
    )


@query("take_until_empty", f"""
WITH {v.CRAWL_PAGES}, stops AS (SELECT job, min(page) AS stop FROM v_crawl_pages WHERE n_items = 0 GROUP BY job)
SELECT p.job, p.page, p.n_items FROM v_crawl_pages p LEFT JOIN stops s ON p.job = s.job WHERE s.stop IS NULL OR p.page < s.stop
""")
def take_until_empty(spark: SparkSession, folder: str) -> DataFrame:
    return paging.take_until_empty(v.crawl_pages(spark, folder), "job", "page").select("job", "page", "n_items")


@query("take_until_streak", f"""
WITH {v.CRAWL_PAGES}, runs AS (
  SELECT *, sum(CASE WHEN n_items = 0 THEN 1 ELSE 0 END)
              OVER (PARTITION BY job ORDER BY page ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS empty_of_last_3
  FROM v_crawl_pages),
stops AS (SELECT job, min(page) AS stop FROM runs WHERE empty_of_last_3 = 3 GROUP BY job)
SELECT p.job, p.page, p.n_items FROM v_crawl_pages p LEFT JOIN stops s ON p.job = s.job
WHERE p.n_items > 0 AND (s.stop IS NULL OR p.page < s.stop)
""")
def take_until_streak(spark: SparkSession, folder: str) -> DataFrame:
    return paging.take_until_streak(v.crawl_pages(spark, folder), "job", "page", dense=True).select("job", "page", "n_items")


@query("stream_until_streak", ORACLES["take_until_streak"])
def stream_until_streak(spark: SparkSession, folder: str) -> DataFrame:
    """The same while pages arrive in three parts, in no order."""
    root, out, state = (scratch_dir(spark, n) for n in ("page-arrivals", "pages-kept", "page-state"))
    pages = v.crawl_pages(spark, folder).select("job", "page", "n_items")
    for part in range(3):
        pages.filter(F.pmod(F.xxhash64("job", "page"), F.lit(3)) == part).write.mode("append").parquet(root)
        drain_pages(kept_pages(spark.readStream.schema(pages.schema).parquet(root)), out, state)
    return spark.read.parquet(out).select("job", "page", F.col("n_items").cast("int").alias("n_items"))


@query("cap_per_key", f"""
WITH {v.REVIEWS}
SELECT product_id, review_uid, helpful FROM v_reviews
QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY helpful DESC, doc_id) <= 3
""")
def cap_per_key(spark: SparkSession, folder: str) -> DataFrame:
    rows = v.reviews(spark, folder).select("product_id", "review_uid", "helpful", "doc_id")
    return paging.cap_per_key(rows, "product_id", 3, [F.col("helpful").desc(), F.col("doc_id")]).drop("doc_id")


@query("estimate_total", f"""
WITH {v.CRAWL_PAGES}, stops AS (SELECT job, min(page) AS stop FROM v_crawl_pages WHERE n_items = 0 GROUP BY job)
SELECT p.job, greatest(coalesce(max(CASE WHEN s.stop IS NULL OR p.page < s.stop THEN p.page END), 1), 1) AS last_valid_page,
       greatest(coalesce(max(CASE WHEN s.stop IS NULL OR p.page < s.stop THEN p.page END), 1), 1) * 20 AS estimated_total
FROM v_crawl_pages p LEFT JOIN stops s ON p.job = s.job GROUP BY p.job
""")
def estimate_total(spark: SparkSession, folder: str) -> DataFrame:
    return paging.estimate_total(v.crawl_pages(spark, folder), "job", "page")


@query("gallop", f"""
WITH {v.CRAWL_PAGES}, stops AS (SELECT job, min(page) AS stop FROM v_crawl_pages WHERE n_items = 0 GROUP BY job),
lasts AS (
  SELECT p.job, greatest(coalesce(max(CASE WHEN s.stop IS NULL OR p.page < s.stop THEN p.page END), 1), 1) AS last_valid_page
  FROM v_crawl_pages p LEFT JOIN stops s ON p.job = s.job GROUP BY p.job)
SELECT job, last_valid_page, last_valid_page * 20 AS estimated_total, TRUE AS few_requests FROM lasts
""")
def gallop(spark: SparkSession, folder: str) -> DataFrame:
    """The last page of each job in about 2 log2 of its pages requests, answered by the pages before the first empty one."""
    pages = v.crawl_pages(spark, folder).select("job", "page", "n_items")
    place = scratch_dir(spark, "answers")
    paging.take_until_empty(pages, "job", "page").write.parquet(place)
    answers = spark.read.parquet(place)
    found = paging.gallop(pages, "job", lambda asked: answers.join(asked, ["job", "page"]))
    few = F.col("n_requests") <= 2 * F.ceil(F.log2(F.col("last_valid_page") + 1)) + 1
    return found.select("job", "last_valid_page", "estimated_total", few.alias("few_requests"))


@query("sort_option_summary", f"""
WITH {v.CRAWL_PAGES}, per_sort AS (
  SELECT sort, CAST(sum(n_items) AS BIGINT) AS items, bool_or(has_more) AS has_more,
         coalesce(max(CASE WHEN n_items > 0 THEN page END), 1) AS max_page
  FROM v_crawl_pages GROUP BY sort),
estimated AS (SELECT *, CASE WHEN has_more THEN max_page * 20 ELSE items END AS estimated_total FROM per_sort)
SELECT * FROM estimated UNION ALL
SELECT 'ALL', CAST(sum(items) AS BIGINT), bool_or(has_more), max(max_page), max(estimated_total) FROM estimated
""")
def sort_option_summary(spark: SparkSession, folder: str) -> DataFrame:
    return paging.sort_option_summary(v.crawl_pages(spark, folder), "sort", "page")


@query("sample_top", f"""
WITH {v.PRODUCTS_SQL}
SELECT category_code, CAST(row_number() OVER (PARTITION BY category_code ORDER BY price DESC, p_partkey) AS INTEGER) AS sample_no,
       product_id, name, price
FROM v_products QUALIFY sample_no <= 3
""")
def sample_top(spark: SparkSession, folder: str) -> DataFrame:
    top = paging.sample_top(v.products(spark, folder), "category_code", [F.col("price").desc(), F.col("p_partkey")])
    return top.select("category_code", "sample_no", "product_id", "name", "price")


@query("page_slice", f"""
WITH {v.PRODUCTS_SQL}
SELECT product_id, name, price FROM v_products ORDER BY price DESC, p_partkey LIMIT 20 OFFSET 40
""")
def page_slice(spark: SparkSession, folder: str) -> DataFrame:
    rows = v.products(spark, folder).select("product_id", "name", "price", "p_partkey")
    return paging.page_slice(rows, [F.col("price").desc(), F.col("p_partkey")], page=3, size=20).drop("p_partkey")


@query("page_slice_per_key", f"""
WITH {v.REVIEWS}
SELECT source, review_uid, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS position FROM v_reviews
QUALIFY position BETWEEN 11 AND 20
""")
def page_slice_per_key(spark: SparkSession, folder: str) -> DataFrame:
    rows = v.reviews(spark, folder).select("source", "review_uid", "doc_id")
    return paging.page_slice_per_key(rows, "source", "doc_id", page=2, size=10).drop("doc_id")


@query("numbered_rows", f"""
WITH {v.PRODUCTS_SQL}
SELECT category_code, product_id, row_number() OVER (PARTITION BY category_code ORDER BY p_partkey) AS position FROM v_products
""")
def numbered_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = v.products(spark, folder).select("category_code", "product_id", "p_partkey")
    return ordering.numbered(rows, ["category_code"], "p_partkey").drop("p_partkey")


@query("order_by_option", f"""
WITH {v.PRODUCTS_SQL}
SELECT product_id, price, rank FROM v_products ORDER BY price, product_id
""")
def order_by_option(spark: SparkSession, folder: str) -> DataFrame:
    return paging.order_by_option(v.products(spark, folder), "PRICE_LOW", "product_id").select("product_id", "price", "rank")


_ORDERS = {
    "POPULARITY": "rank", "PRICE_LOW": "price", "PRICE_HIGH": "price DESC", "REVIEW": "review_count DESC", "RECENT": "created_at DESC",
    "SALE": "discount_rate DESC", "RATING": "rating DESC", fv.RECOMMEND_SORT: "helpful DESC", fv.REVIEW_SORTS[0]: "created_at DESC",
    fv.REVIEW_SORTS[1]: "rank", fv.REVIEW_SORTS[2]: "rating DESC", fv.REVIEW_SORTS[3]: "rating",
}
_SORTED = """sorted AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_partkey % 17 AS rank, p_size AS price, p_partkey % 13 AS review_count, p_partkey % 29 AS created_at,
         p_partkey % 7 AS discount_rate, CASE WHEN p_partkey % 5 > 0 THEN p_size % 6 END AS rating, p_partkey % 11 AS helpful FROM part)"""


@query("order_by_options", f"WITH {_SORTED} " + " UNION ALL ".join(
    f"(SELECT '{name}' AS sort, product_id FROM sorted ORDER BY {order} NULLS LAST, product_id LIMIT 25)" for name, order in _ORDERS.items()
))
def order_by_options(spark: SparkSession, folder: str) -> DataFrame:
    """The first rows under every sort option that a request may name."""
    key = F.col("p_partkey")
    rows = v.table(spark, folder, "part").select(
        key.cast("string").alias("product_id"), (key % 17).alias("rank"), F.col("p_size").alias("price"), (key % 13).alias("review_count"),
        (key % 29).alias("created_at"), (key % 7).alias("discount_rate"), F.when(key % 5 > 0, F.col("p_size") % 6).alias("rating"), (key % 11).alias("helpful"),
    )
    options = [*fv.PRODUCT_SORTS, fv.RECOMMEND_SORT, *fv.REVIEW_SORTS]
    parts = [paging.order_by_option(rows, o, "product_id").limit(25).select(F.lit(o).alias("sort"), "product_id") for o in options]
    return reduce(DataFrame.unionAll, parts)


@query("probe_frontier", """
SELECT CAST(p_partkey AS VARCHAR) AS product_id, page, sort FROM part,
  (SELECT unnest([1, 10, 50, 100, 200, 500, 1000]) AS page), (SELECT unnest(['최신순', '랭킹순', '평점 높은순', '평점 낮은순']) AS sort)
""")
def probe_frontier(spark: SparkSession, folder: str) -> DataFrame:
    """Requests that probe how far a listing goes, under every review order."""
    return paging.probes(v.products(spark, folder).select("product_id"))


@query("filter_flags", f"""
WITH {v.REVIEWS}
SELECT review_uid, has_photo, is_experience FROM v_reviews WHERE has_photo AND NOT is_experience
""")
def filter_flags(spark: SparkSession, folder: str) -> DataFrame:
    rows = v.reviews(spark, folder).select("review_uid", "has_photo", "is_experience")
    return paging.filter_flags(rows, has_photo=True, is_experience=False)


@query("url_sort_param", f"""
WITH links AS (
  SELECT page_id, CASE WHEN page_id % 4 = 0 THEN url || '&sort=RECENT&x=1' ELSE url END AS link FROM pages)
SELECT page_id, link,
       CASE WHEN contains(link, 'sort=') THEN regexp_replace(link, 'sort=[^&]+', 'sort={fv.FORCED_SORT}', 'g')
            ELSE link || CASE WHEN contains(link, '?') THEN '&' ELSE '?' END || 'sort={fv.FORCED_SORT}' END AS sorted_link,
       CASE WHEN contains(link, 'sort=') THEN regexp_replace(link, 'sort=[^&]+', 'sort={fv.FORCED_SORT}', 'g')
            ELSE link || '?sort={fv.FORCED_SORT}' END AS plain_link
FROM links
""")
def url_sort_param(spark: SparkSession, folder: str) -> DataFrame:
    link = F.when(F.col("page_id") % 4 == 0, F.concat(F.col("url"), F.lit("&sort=RECENT&x=1"))).otherwise(F.col("url"))
    rows = v.table(spark, folder, "pages").select("page_id", link.alias("link"))
    return rows.withColumns(
        {"sorted_link": text.with_sort_param(F.col("link")), "plain_link": text.with_sort_param(F.col("link"), compat=True)}
    )


@query("page_status", """
WITH marked AS (
  SELECT page_id, CASE WHEN page_id % 40 = 7 THEN '<title>Just a moment...</title>' || html
                       WHEN page_id % 40 = 9 THEN '' ELSE html END AS html FROM pages)
SELECT page_id, CASE WHEN html IS NULL OR html = '' THEN 'empty'
                     WHEN contains(html, 'Just a moment') OR contains(html, 'Checking your browser') THEN 'blocked'
                     ELSE 'ok' END AS status FROM marked
""")
def page_status(spark: SparkSession, folder: str) -> DataFrame:
    return v.marked_pages(spark, folder).select("page_id", text.page_status(F.col("html")).alias("status"))


@query("keyword_any", """
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'POST' ELSE 'GET' END AS method, url FROM pages
WHERE contains(lower(url), 'page=') OR contains(lower(url), '/en/') OR contains(lower(url), 'https://m.')
""")
def keyword_any(spark: SparkSession, folder: str) -> DataFrame:
    return paging.filter_any_keyword(v.request_log(spark, folder), "url", ["page=", "/EN/", "https://m."])


@query("keyword_first", """
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'POST' ELSE 'GET' END AS method, url FROM pages
WHERE contains(lower(url), 'page=') OR contains(lower(url), '/en/') ORDER BY page_id LIMIT 7
""")
def keyword_first(spark: SparkSession, folder: str) -> DataFrame:
    return paging.filter_any_keyword(v.request_log(spark, folder), "url", ["page=", "/EN/"], 7, [F.col("page_id")])


@query("batch_rewrite", f"""
WITH {v.CRAWL_PAGES}, b AS (SELECT job, page, n_items, CAST(floor((page - 1) / 10) AS BIGINT) AS batch FROM v_crawl_pages)
SELECT job, page, n_items, batch FROM b WHERE batch <> 1 OR n_items > 0
""")
def batch_rewrite(spark: SparkSession, folder: str) -> DataFrame:
    """All batches are kept; then one is written again with fewer rows and replaces itself alone."""
    path = scratch_dir(spark, "batches")
    batched = paging.batch_id(v.crawl_pages(spark, folder)).select("job", "page", "n_items", "batch")
    landing.write_batches(batched, path)
    landing.write_batches(batched.filter("batch = 1 AND n_items > 0"), path)
    return spark.read.schema(batched.schema).parquet(path)
