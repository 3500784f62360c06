"""Input views over the given tables, and the same views as SQL for the checks.

Payloads and pages are built from table rows in groups over id ranges, so no group grows
with the data. Every view covers its whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import numbered

RANKING_SPAN = 240
# part types, which stand for categories: 6 x 5 x 5 words
CATEGORIES = 150
CARD_SPAN = 100
LISTING_SPAN = 24
GRID_SPAN = 60
REVIEW_SPAN = 4000
PRODUCTS = 200
SCRAPED_AT = "2025-07-02 09:30:00"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def escaped(text: Column) -> Column:
    for plain, coded in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def text_of(*parts: Column | str) -> Column:
    """Concatenation with missing parts left out."""
    return F.concat(*[F.coalesce(p.cast("string"), F.lit("")) if isinstance(p, Column) else F.lit(p) for p in parts])


def joined_by_id(order: str, part: Column, sep: str = "") -> Column:
    """The parts of a group in id order, as one text. Groups are id ranges."""
    return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, part.alias("part")))), lambda r: r["part"]), sep)


# ------------------------------------------------------------------ reviews, products


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    doc = F.col("doc_id")
    return table(spark, folder, "documents").select(
        "doc_id",
        doc.cast("string").alias("review_uid"),
        F.col("text").alias("content"),
        F.when(doc % 23 != 0, (doc % 6).cast("int")).alias("star"),
        (doc % PRODUCTS).cast("string").alias("product_id"),
        (F.col("n_chars") % 100).cast("int").alias("helpful"),
        (doc % 3 == 0).alias("has_photo"),
        (doc % 4 == 0).alias("is_experience"),
        "source",
        "lang",
    )


REVIEWS = """
v_reviews AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS review_uid, text AS content,
         CASE WHEN doc_id % 23 <> 0 THEN CAST(doc_id % 6 AS INTEGER) END AS star,
         CAST(doc_id % 200 AS VARCHAR) AS product_id, CAST(n_chars % 100 AS INTEGER) AS helpful,
         doc_id % 3 = 0 AS has_photo, doc_id % 4 = 0 AS is_experience, source, lang
  FROM documents)"""

LABELLED = REVIEWS + """,
v_labelled AS (
  SELECT *, CASE WHEN star >= 4 THEN 'positive' WHEN star <= 2 THEN 'negative' ELSE 'neutral' END AS true_label
  FROM v_reviews WHERE content IS NOT NULL AND content <> '' AND star IS NOT NULL AND star >= 1)"""


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews with a score: from the quality label where there is one, else undecided."""
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("_doc"), "quality")
    joined = reviews(spark, folder).join(labels, F.col("doc_id") == F.col("_doc"), "left").drop("_doc")
    prob = F.when(F.col("quality").isNull(), 0.5).otherwise(0.25 + 0.5 * F.col("quality"))
    return joined.withColumn("prob", prob).drop("quality")


SCORED = LABELLED + """,
v_scored AS (
  SELECT r.*, CASE WHEN l.quality IS NULL THEN 0.5 ELSE 0.25 + 0.5 * l.quality END AS prob
  FROM v_labelled r LEFT JOIN labels l ON r.doc_id = l.doc_id),
v_predicted AS (
  SELECT *, CASE WHEN prob >= 0.6 THEN 'positive' WHEN prob < 0.4 THEN 'negative' ELSE 'neutral' END AS pred_label
  FROM v_scored)"""


def duplicated_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews with repeated arrivals, and some without an id."""
    base = reviews(spark, folder).select(
        "doc_id",
        F.when(F.col("doc_id") % 31 == 0, "").otherwise(F.col("review_uid")).alias("review_uid"),
        "content",
        "source",
        (F.col("doc_id") * 2).alias("arrival"),
    )
    again = base.filter(F.col("doc_id") % 5 == 0).withColumns(
        {"arrival": F.col("arrival") + 1, "source": F.lit("again")}
    )
    return base.unionByName(again)


DUPLICATED = REVIEWS + """,
v_base AS (
  SELECT doc_id, CASE WHEN doc_id % 31 = 0 THEN '' ELSE review_uid END AS review_uid, content, source, doc_id * 2 AS arrival
  FROM v_reviews),
v_dup_reviews AS (
  SELECT * FROM v_base UNION ALL
  SELECT doc_id, review_uid, content, 'again' AS source, arrival + 1 FROM v_base WHERE doc_id % 5 = 0)"""


def products(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, folder, "part").select(
        key.cast("string").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category_code"),
        F.col("p_retailprice").alias("price"),
        (key + 1).cast("int").alias("rank"),
        (F.col("p_size") / 10.0).alias("rating"),
        (key * 7 % 1000).alias("review_count"),
        (F.col("p_size") % 30).alias("discount_rate"),
        (key * 13 % 97).cast("int").alias("helpful"),
        F.date_add(F.lit("2025-01-01").cast("date"), (key % 180).cast("int")).alias("created_at"),
        "p_partkey",
    )


PRODUCTS_SQL = """
v_products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, p_brand AS brand, p_type AS category_code,
         p_retailprice AS price, CAST(p_partkey + 1 AS INTEGER) AS rank, p_size / 10.0 AS rating,
         p_partkey * 7 % 1000 AS review_count, p_size % 30 AS discount_rate,
         CAST(p_partkey * 13 % 97 AS INTEGER) AS helpful,
         CAST(DATE '2025-01-01' + CAST(p_partkey % 180 AS INTEGER) AS DATE) AS created_at, p_partkey
  FROM part)"""


def price_facts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.floor("l_extendedprice").alias("price"),
        F.round(F.col("l_discount") * 100).cast("int").alias("rate"),
    )


PRICE_FACTS = """
v_price_facts AS (
  SELECT l_orderkey, l_linenumber, CAST(floor(l_extendedprice) AS BIGINT) AS price,
         CAST(round(l_discount * 100) AS INTEGER) AS rate
  FROM lineitem)"""


def price_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Prices as shops print them: thousands commas, a currency sign on some, N/A on some."""
    facts = price_facts(spark, folder)
    shown = F.concat(F.format_number("price", 0), F.when(F.col("l_orderkey") % 3 == 0, "원").otherwise(""))
    return facts.withColumn("price_text", F.when(F.col("l_orderkey") % 17 == 0, "N/A").otherwise(shown))


PRICE_TEXTS = PRICE_FACTS + """,
v_price_text AS (
  SELECT *, CASE WHEN l_orderkey % 17 = 0 THEN 'N/A'
                 ELSE format('{:,}', price) || CASE WHEN l_orderkey % 3 = 0 THEN '원' ELSE '' END END AS price_text
  FROM v_price_facts)"""


# ------------------------------------------------------------------------ crawl logs


def crawl_pages(spark: SparkSession, folder: str) -> DataFrame:
    """One request log per user: pages counted 1, 2, 3, ...; an error is an empty page."""
    events = table(spark, folder, "events").select(
        F.col("user_id").alias("job"),
        "event_id",
        F.col("event_type").alias("sort"),
        F.when(F.col("event_type") == "error", 0).otherwise(20).alias("n_items"),
        (F.col("value") > 50).alias("has_more"),
    )
    # ids are dense, so one level of ranges is enough
    return numbered(events, ["job"], "event_id", out="page", id_limit=1 << 32)


CRAWL_PAGES = """
v_crawl_pages AS (
  SELECT user_id AS job, event_id, event_type AS sort, CASE WHEN event_type = 'error' THEN 0 ELSE 20 END AS n_items,
         value > 50 AS has_more, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS page
  FROM events)"""


def request_log(spark: SparkSession, folder: str) -> DataFrame:
    method = F.when(F.col("page_id") % 3 == 0, "POST").otherwise("GET")
    return table(spark, folder, "pages").select("page_id", method.alias("method"), "url")


# -------------------------------------------------------------------------- payloads


def ranking_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Ranking pages per category and id range, with banners, adverts and broken items."""
    key, size = F.col("p_partkey"), F.col("p_size")
    viewers = F.format_number(key * 7 % 3000, 0)
    event = lambda count, score: F.struct(
        F.struct(F.struct(F.struct(count.alias("reviewCount"), score.alias("reviewScore")).alias("payload")).alias("amplitude")).alias("eventLog")
    )
    clicked = F.when(key % 3 == 0, 0).when(key % 3 == 1, key % 100 + 1)
    info = F.struct(
        F.col("p_name").alias("productName"),
        F.when(key % 31 == 0, "").otherwise(F.col("p_brand")).alias("brandName"),
        F.round(F.col("p_retailprice") * 100).cast("bigint").alias("finalPrice"),
        F.when(size % 5 == 0, 0).otherwise(size).alias("discountRatio"),
        F.array(
            F.struct(F.concat(viewers, F.lit("명이 보는 중")).alias("text")),
            F.struct(F.lit("무료배송").alias("text")),
            F.struct(F.when(key % 4 == 0, F.concat((key % 50).cast("string"), F.lit("명이 보는 중"))).otherwise("오늘출발").alias("text")),
        ).alias("additionalInformation"),
    )
    image = F.struct(
        F.concat(F.lit("https://img.example/"), key.cast("string"), F.lit(".jpg")).alias("url"),
        F.when(key % 3 == 0, F.array(F.struct(F.lit("한정").alias("text")), F.struct(F.concat(F.lit("판매 "), (size / 10.0).cast("string"), F.lit("천개")).alias("text")))).alias("labels"),
        event(key % 500, size * 2).alias("onClickLike"),
    )
    click = F.struct(
        F.when(key % 5 == 0, F.concat(F.lit("https://shop.example/p/"), key.cast("string"))).alias("url"),
        event(clicked, F.when(key % 3 == 1, size))["eventLog"].alias("eventLog"),
    )
    item = F.struct(
        F.when(key % 19 == 0, "AD_COLUMN").otherwise("PRODUCT_COLUMN").alias("type"),
        key.alias("id"),
        F.when(key % 29 != 0, info).alias("info"),
        image.alias("image"),
        click.alias("onClick"),
    )
    page = (F.floor(key / RANKING_SPAN) + 1).cast("int")
    grouped = (
        table(spark, folder, "part")
        .groupBy(F.col("p_type").alias("category_code"), page.alias("page"))
        .agg(F.sort_array(F.collect_list(F.struct(key.alias("at"), F.to_json(item).alias("item")))).alias("items"))
    )
    first_id = F.get(F.col("items"), F.lit(0))["at"]
    payload = text_of(
        '{"data":{"modules":[{"type":"BANNER","items":[{"type":"IMAGE","slot":{"type":"PRODUCT_COLUMN","id":',
        first_id, '}}]},{"type":"MULTICOLUMN","items":[',
        F.array_join(F.transform("items", lambda r: r["item"]), ","), ']},{"type":"MULTICOLUMN"}]}}',
    )
    return grouped.select("category_code", "page", F.size("items").alias("n_items"), payload.alias("payload"))


RANKING_SQL = """
v_items AS (
  SELECT *, CAST(floor(p_partkey / 240) AS INTEGER) + 1 AS page FROM part),
v_ranked AS (
  SELECT *, CAST((page - 1) * 240 + row_number() OVER (PARTITION BY p_type, page ORDER BY p_partkey) AS INTEGER) AS rank
  FROM v_items WHERE p_partkey % 19 <> 0)"""


def card_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Card pages with missing keys, null keys, and cards that hold no product."""
    key, size = F.col("p_partkey"), F.col("p_size")
    price = F.round(F.col("p_retailprice") * 100).cast("bigint")
    image = lambda side, flagged, present: F.struct(
        F.when(present, F.concat(F.lit(f"https://img.example/{side}"), key.cast("string"), F.lit(".jpg"))).alias("imageUrl"),
        flagged.alias("representativeImage"),
    )
    named = lambda value: F.struct(value.alias("name"))
    fields = F.struct(
        key.cast("string").alias("id"),
        F.col("p_name").alias("name"),
        F.when(key % 6 == 1, named(F.lit(None).cast("string"))).when(key % 6 != 0, named(F.col("p_brand"))).alias("brand"),
        F.when(key % 4 > 1, price).alias("salePrice"),
        F.when(key % 8 != 1, price + 1000).alias("originalPrice"),
        F.when(key % 5 != 0, price - 500).alias("pcDiscountedSalePrice"),
        (size % 30).alias("pcDiscountedRatio"),
        (size / 10.0).alias("averageReviewScore"),
        F.when(key % 10 != 0, key % 1000).alias("totalReviewCount"),
        F.when(key % 3 == 0, F.concat(F.lit("https://img.example/r"), key.cast("string"), F.lit(".jpg"))).when(key % 3 == 1, "").alias("representativeImageUrl"),
        F.when(key % 7 != 0, F.array(image("a", F.lit(False), key % 5 != 0), image("b", key % 2 == 0, F.lit(True)))).alias("images"),
        F.when(key % 3 == 0, F.array(named(F.col("p_type")), named(F.lit("")), named(F.lit("beauty")))).when(key % 3 == 1, F.array().cast("array<struct<name:string>>")).alias("categories"),
        F.when(key % 3 == 1, F.col("p_type")).alias("productCategoryName"),
        F.when(key % 9 != 0, F.struct(F.concat(F.lit("mall"), (key % 10).cast("string")).alias("name"), F.lit("BEAUTY").alias("subVertical"))).alias("channel"),
    )
    plain = F.to_json(fields)
    product = (
        F.when(key % 37 == 0, "null")
        .when(key % 41 == 0, "{}")
        .when(key % 43 == 0, '"gone"')
        .when(key % 4 == 0, F.concat(F.substring(plain, F.lit(1), F.length(plain) - 1), F.lit(',"salePrice":null}')))
        .otherwise(plain)
    )
    card = F.concat(F.lit('{"data":{"product":'), product, F.lit("}}"))
    page = (F.floor(key / CARD_SPAN) + 1).cast("int")
    cards = table(spark, folder, "part").groupBy(page.alias("page")).agg(joined_by_id("p_partkey", card, ",").alias("cards"))
    payload = text_of('{"data":{"pagedCards":{"data":[', F.col("cards"), '],"page":', F.col("page"), ',"totalCount":', F.col("page") * 100, ',"hasMore":true,"pageInfo":{"size":100},"cursor":null}}}')
    return cards.select("page", payload.alias("payload"))


CARD_SQL = """
v_cards AS (
  SELECT p_partkey AS k, CAST(p_partkey AS VARCHAR) AS product_id, CAST(round(p_retailprice * 100) AS BIGINT) AS price,
         CAST(floor(p_partkey / 100) AS INTEGER) + 1 AS page, p_name, p_brand, p_type, p_size
  FROM part WHERE p_partkey % 37 <> 0 AND p_partkey % 41 <> 0 AND p_partkey % 43 <> 0)"""


def review_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Review pages per product and id range; keys differ from review to review."""
    doc = F.col("doc_id")
    review = F.to_json(
        F.struct(
            doc.alias("no"),
            F.col("text").alias("content"),
            (doc % 6).cast("string").alias("grade"),
            F.struct(F.col("source").alias("nick"), (doc % 7).alias("level")).alias("user"),
            F.array("lang", "source").alias("tags"),
            F.when(doc % 3 == 0, "set").alias("option"),
            F.when(doc % 3 == 1, F.struct(F.lit("dry").alias("skin"))).alias("survey"),
            F.when(doc % 10 == 0, "own").alias("scraped_at"),
        )
    )
    page = (F.floor(doc / REVIEW_SPAN) + 1).cast("int")
    listed = (
        table(spark, folder, "documents")
        .groupBy((doc % PRODUCTS).cast("string").alias("product_id"), page.alias("page"))
        .agg(joined_by_id("doc_id", review, ",").alias("reviews"))
    )
    return listed.select("product_id", "page", text_of('{"data":{"list":[', F.col("reviews"), "]}}").alias("payload"))


def shaped_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """One payload per product, in one of several shapes."""
    key = F.col("p_partkey")
    items = F.to_json(F.array(F.struct(key.alias("id")), F.struct(F.col("p_size").cast("bigint").alias("id"))))
    payload = (
        F.when(key % 5 == 0, text_of('{"data":{"products":', items, "}}"))
        .when(key % 5 == 1, text_of('{"data":{"window":{"cards":', items, '},"items":[]}}'))
        .when(key % 5 == 2, text_of('{"data":{"items":{"a":1,"b":2,"c":3},"results":[1]}}'))
        .when(key % 5 == 3, text_of('{"data":{"results":"', F.col("p_name"), '","items":null}}'))
        .otherwise(text_of('{"data":{"products":', key, "}}"))
    )
    return table(spark, folder, "part").select("p_partkey", payload.alias("payload"))


# ----------------------------------------------------------------------------- pages


def marked_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The collected pages; some replaced by a challenge page, some empty."""
    key = F.col("page_id")
    html = F.when(key % 40 == 7, F.concat(F.lit("<title>Just a moment...</title>"), F.col("html"))).when(key % 40 == 9, "").otherwise(F.col("html"))
    return table(spark, folder, "pages").select("page_id", "url", html.alias("html"))


def listing_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Listing pages of 24 products in three block forms, with unclosed tags and stray quotes."""
    key = F.col("p_partkey")
    page = (F.floor(key / LISTING_SPAN)).cast("int")
    price = F.format_number(F.round(F.col("p_retailprice") * 100).cast("bigint"), 0)
    amount = lambda cls: text_of(f'<span class="{cls}"><span class="tx_num">', price, "</span>원</span>")
    prices = F.when(key % 11 == 0, "").when(key % 3 == 0, amount("tx_org")).otherwise(
        text_of('<span class="tx_org"><span class="tx_num">999,999</span>원</span>', amount("tx_cur"))
    )
    link = F.when(key % 4 == 0, "https://other.example").otherwise("")
    body = text_of(
        '<a class="prd_thumb" href="', link, "/goods/detail?goodsNo=A", F.lpad(key.cast("string"), 9, "0"),
        '&amp;t=1"><img src="x.jpg"></a><br><p class="tx_name">', escaped(F.concat(F.col("p_name"), F.lit(" & <set>"))),
        '</p><span class="tx_brand"> ', F.col("p_brand"), " </span>", prices,
        '<p class="prd_point_area"><span class="point" style="width:', F.col("p_size") * 2, '%"></span>',
        F.when(key % 6 != 0, text_of("(", F.when(key % 7 == 0, "999+").otherwise(F.format_number(key * 9, 0)), ")")), "</p>",
    )
    form = page % 3
    item = (
        F.when(form == 0, text_of(F.when(key % 4 == 1, '<div class="prd_info new"">').otherwise('<div title="5" x" class="prd_info new">'), body, "</div>"))
        .when(form == 1, text_of(F.when(key % 4 == 1, "<li data-t=it's class='prd_item'>").otherwise('<li class="prd_item">'), body))
        .otherwise(text_of("<article>", body, "</article>"))
    )
    total = F.when(F.col("page") % 4 == 0, '<p class="cate_info_tx">총 <b>1,385</b>개</p>').when(
        F.col("page") % 4 == 1, '<div class="pageing"><a href="?p=1">1</a><a href="?p=2">2</a><a href="?p=12">12</a><a>다음</a></div>'
    ).when(F.col("page") % 4 == 2, '<div class="pageing"></div>')
    grouped = table(spark, folder, "part").groupBy(page.alias("page")).agg(joined_by_id("p_partkey", item).alias("items"))
    html = text_of("<!DOCTYPE html><html><head><script>if(a<b){}</script></head><body>", total, "<ul>", F.col("items"), '</ul></body></html><i data-x="open>')
    return grouped.select("page", html.alias("html"))


def review_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Review pages per product and id range, in the list markup."""
    doc = F.col("doc_id")
    star = F.when(doc % 23 != 0, text_of('<span class="point">', doc % 6, "점</span>"))
    item = text_of(
        F.when(doc % 7 == 3, '<li title="a" b"><div class="score_area"">').otherwise("<li data-t=it's><div class=score_area>"), star, '<span class="date">2024.03.', F.lpad((doc % 28 + 1).cast("string"), 2, "0"), "</span>",
        F.when(doc % 3 == 0, '<span class="ico_offlineStore">매장</span>'), "</div>",
        F.when(doc % 4 == 0, '<p class="tag"><span>지성</span><span>쿨톤</span></p>'),
        F.when(doc % 29 != 0, text_of('<div class="txt_inner">', escaped(F.col("text")), "</div>")),
        '<div class="recom_area">', F.when(doc % 5 != 0, text_of('<button class="btn_recom" id="gdas_', doc, '">도움<span class="num">', F.col("n_chars") % 100, "</span></button>")),
        "</div></li>",
    )
    page = (F.floor(doc / REVIEW_SPAN) + 1).cast("int")
    product = (doc % PRODUCTS).cast("string")
    grouped = table(spark, folder, "documents").groupBy(product.alias("product_id"), page.alias("page")).agg(joined_by_id("doc_id", item).alias("items"))
    number = F.col("product_id").cast("int")
    trail = text_of(
        '<div class="page_location"><a class="home" href="/">홈</a><a class="cate_y">care</a>',
        F.when(number % 3 > 0, '<a class="cate_y"> skin </a>'), F.when(number % 3 > 1, '<a class="cate_y">toner</a><a class="cate_y">mist</a>'), "</div>",
    )
    html = text_of(
        "<html><body>", trail, '<p class="prd_name"> item ', F.col("product_id"), ' </p><a class="goods_reputation" href="#">리뷰<span>(',
        F.format_number(number * 100, 0), ')</span></a><ul id="gdasList">', F.col("items"), "</ul></body></html>",
    )
    return grouped.select("product_id", "page", html.alias("html"))


def span_review_pages(spark: SparkSession, folder: str) -> DataFrame:
    """One page per conversation, one review per turn, in the span markup."""
    turn, conv = F.col("turn"), F.col("conv_id")
    body = F.when(
        turn % 3 != 2, text_of('<div class="_1kMfD5ErZ6"><em>x</em><span class="_2L3vDiadT9">', escaped(F.col("text")), "</span></div>")
    ).otherwise(text_of('<div class="_3z6gI4oI6l">', escaped(F.col("text")), "</div>"))
    item = text_of(
        '<li class="BnwL_cs1av" data-shp-contents-id="r', conv, "-", turn, '"><strong class="_2L3vDiadT9">', F.col("role"),
        '</strong><span class="_2L3vDiadT9">구매</span><span class="_2L3vDiadT9">24.03.', F.lpad((conv % 28 + 1).cast("string"), 2, "0"), ".</span>",
        F.when(turn % 2 == 0, text_of('<em class="_15NU42F3kT"> ', conv % 5 + 1, " </em>")), body,
        F.when(turn % 4 == 1, '<div class="_2FXNMst_ak">옵션: 50ml<br></div>'), "</li>",
    )
    pages = table(spark, folder, "conversations").groupBy("conv_id", F.floor(turn / 100).alias("part")).agg(joined_by_id("turn", item).alias("items"))
    return pages.select("conv_id", "part", text_of("<ul>", F.col("items"), "</ul>").alias("html"))


def detail_pages(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    html = text_of(
        "<html><body>", F.when(key % 3 != 0, text_of('<div class="detail_info wide"><h2> ', F.col("p_name"), " </h2><p> ", F.col("p_type"), " </p></div>")),
        F.when(key % 4 != 0, text_of('<div class="ingredients">water, ', F.col("p_brand"), "</div>")),
        F.when(key % 5 != 0, '<div class="usage">apply</div>'),
        '<img class="prd_img" src="a', key, '.jpg"><img class="prd_img"><img class="logo" src="logo.png">',
        F.when(key % 2 == 0, text_of('<img class="big prd_img" src="b', key, '.jpg">')), "</body></html>",
    )
    return table(spark, folder, "part").select("p_partkey", html.alias("html"))


def grid_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Grid pages of 60 products in rows of six cells, some cells incomplete."""
    key = F.col("p_partkey")
    price = F.format_number(F.round(F.col("p_retailprice") * 100).cast("bigint"), 0)
    sums = F.when(key % 5 == 0, "").when(key % 5 == 1, text_of("<span>", price, "원</span>")).otherwise(
        text_of("<span>", F.col("p_size"), "%</span><span>", price, "원</span>")
    )
    people = F.when(key % 4 == 0, "").otherwise(
        text_of("<div><span>관심 ", key % 100, "</span>", F.when(key % 3 == 0, text_of("<span>구매 ", key % 50, "</span>")), "</div>")
    )
    cell = text_of(
        '<div><div><a href="/products/', F.when(key % 13 != 0, key), '?x=1"><img src="i.jpg"></a></div><div><div><a href="#"><p> ', F.col("p_brand"),
        ' </p></a><a href="#"><p>', F.when(key % 17 != 0, F.col("p_name")), "</p></a><div>", sums, "</div></div><div>", people, "</div></div></div>",
    )
    at = (F.floor(key / 6)).alias("row")
    rows = table(spark, folder, "part").groupBy(F.floor(key / GRID_SPAN).alias("grid"), at).agg(joined_by_id("p_partkey", cell).alias("cells"))
    line = text_of("<div>", F.col("cells"), "</div>")
    grids = rows.groupBy("grid").agg(joined_by_id("row", line).alias("lines"))
    return grids.select("grid", text_of("<html><body><div><main><header>top</header><article><div>menu</div>", F.col("lines"), "</article></main></div></body></html>").alias("html"))


def loose_review_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of 20 reviews under varying class names: in a container, in a list, or bare."""
    doc = F.col("doc_id")
    words = escaped(F.col("text"))
    fields = text_of(
        F.when(doc % 9 == 0, '<span class="myRating">9</span>'),
        F.when(doc % 4 == 0, '<span class="rate star-on" style="width:70%"></span>').when(doc % 4 == 1, '<span class="my-score">4.5</span>'),
        F.when(doc % 3 == 0, '<h3 class="r-title">good</h3>').when(doc % 3 == 1, '<p class="sub title">fine</p>'),
        F.when(doc % 5 == 0, '<div class="content">short</div>'),
        F.when(doc % 2 == 0, text_of('<div class="text-box">', words, "</div>")).otherwise(text_of('<span class="content">', words, "</span>")),
        F.when(doc % 6 == 0, '<span class="author">평점 5</span>'), '<span class="user-id"> u', doc % 9, " </span>",
        F.when(doc % 7 == 0, '<span class="date">today</span>'), '<p class="date">2024-07-', F.lpad((doc % 28 + 1).cast("string"), 2, "0"), "</p>",
        F.when(doc % 8 < 4, '<span class="helpful">none</span>'), F.when(doc % 8 < 6, text_of('<span class="like">', doc % 11, "</span>")),
    )
    page = F.floor(doc / 20).cast("int")
    item = (
        F.when(page % 3 == 0, text_of('<div class="Review_box">', fields, "</div>"))
        .when(page % 3 == 1, text_of('<li class="list-item">', fields, "</li>"))
        .otherwise(text_of("<li>", fields))
    )
    grouped = table(spark, folder, "documents").groupBy(page.alias("page")).agg(joined_by_id("doc_id", item).alias("items"))
    html = (
        F.when(F.col("page") % 3 == 0, text_of('<ul></ul><section class="review_list">', F.col("items"), "</section>"))
        .when(F.col("page") % 3 == 1, text_of("<ul>", F.col("items"), "</ul>"))
        .otherwise(text_of("<ol><li>short", F.col("items"), "</ol>"))
    )
    return grouped.select("page", html.alias("html"))


LOOSE_SQL = """
v_loose AS (
  SELECT doc_id, CAST(floor(doc_id / 20) AS INTEGER) AS page,
         regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS body, text
  FROM documents)"""
