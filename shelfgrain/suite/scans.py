"""Queries on sources and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import paging, payloads, sampling, scoring, shaping
from ..schemas import PRODUCT_DOCUMENT
from ..session import scratch_dir
from ..sources import landing, tables
from ..sources.landing_log import LandingLog
from ..streaming.landing import LandedFiles, drain
from . import views as v
from .registry import query

RUN_DATE = "2025-07-02"
# ids whose products share a JSON document
DOCUMENT_SPAN = 5_000


@query("review_scan", f"""
WITH {v.REVIEWS}
SELECT review_uid, content, star FROM v_reviews
WHERE content IS NOT NULL AND content <> '' AND star IS NOT NULL AND star >= 1
""")
def review_scan(spark: SparkSession, folder: str) -> DataFrame:
    return shaping.valid_for_scoring(v.reviews(spark, folder)).select("review_uid", "content", "star")


@query("scored_roundtrip", f"""
WITH {v.SCORED}
SELECT review_uid, star, true_label, pred_label, true_label = pred_label AS is_correct, DATE '{RUN_DATE}' AS run_date
FROM v_predicted
""")
def scored_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "predicted")
    rows = shaping.with_true_label(shaping.valid_for_scoring(v.scored(spark, folder)))
    done = scoring.with_correct(scoring.with_pred_label(rows))
    kept = done.select("review_uid", "star", "true_label", "pred_label", "is_correct")
    tables.write_partitioned(shaping.with_run_date(kept, RUN_DATE), path, ["run_date"], mode="overwrite")
    return spark.read.parquet(path).filter(F.col("run_date") == F.lit(RUN_DATE).cast("date"))


@query("csv_roundtrip", f"""
WITH {v.REVIEWS}
SELECT review_uid, content, star, source FROM v_reviews
""")
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    schema = T.StructType().add("review_uid", "string").add("content", "string").add("star", "integer").add("source", "string")
    landing.write_csv(v.reviews(spark, folder).select(*schema.names), path, bom=True)
    return landing.read_landed_csv(spark, path, schema)


@query("json_roundtrip", f"""
WITH {v.PRODUCTS_SQL}
SELECT product_id, name, brand AS brand_name, price, category_code || '|' || brand AS categories FROM v_products
""")
def json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "json")
    documents = v.products(spark, folder).select(
        "product_id", "name", F.struct(F.col("brand").alias("name")).alias("brand"), "price", F.array("category_code", "brand").alias("categories")
    )
    landing.write_json(documents, path)
    read = landing.read_json(spark, path, PRODUCT_DOCUMENT)
    return read.select("product_id", "name", F.col("brand.name").alias("brand_name"), "price", F.array_join("categories", "|").alias("categories"))


_CATEGORY = """CASE p_partkey % 8 WHEN 0 THEN category_code || ' & co/x' WHEN 1 THEN '100% ' || category_code || '+1'
  WHEN 2 THEN category_code || '%2Fa=b' WHEN 3 THEN NULL ELSE category_code END"""


def _category() -> Column:
    code, kind = F.col("category_code"), F.col("p_partkey") % 8
    return (
        F.when(kind == 0, F.concat(code, F.lit(" & co/x"))).when(kind == 1, F.concat(F.lit("100% "), code, F.lit("+1")))
        .when(kind == 2, F.concat(code, F.lit("%2Fa=b"))).when(kind != 3, code)
    )


@query("whole_json_files", f"""
WITH {v.PRODUCTS_SQL}
SELECT category_code, product_id, name FROM v_products
""")
def whole_json_files(spark: SparkSession, folder: str) -> DataFrame:
    """One JSON document per category and id range over many lines, read as a VARIANT of unknown shape."""
    path = scratch_dir(spark, "documents")
    items = F.sort_array(F.collect_list(F.struct("p_partkey", "product_id", "name")))
    document = F.to_json(F.struct(F.lit("x").alias("kind"), items.alias("items")), {"pretty": "true"})
    id_range = F.floor(F.col("p_partkey") / DOCUMENT_SPAN).alias("id_range")
    documents = v.products(spark, folder).groupBy("category_code", id_range).agg(document.alias("value")).drop("id_range")
    documents.write.partitionBy("category_code").option("maxRecordsPerFile", 1).text(path)
    read = landing.read_json_documents(spark, path, strict=True)
    code = F.try_url_decode(F.try_url_decode(F.regexp_extract("file_path", "category_code=([^/]*)", 1)))
    listed = read.select(code.alias("category_code"), F.explode(F.try_variant_get("document", "$.items", "array<variant>")).alias("item"))
    return listed.select("category_code", F.try_variant_get("item", "$.product_id", "string").alias("product_id"), F.try_variant_get("item", "$.name", "string").alias("name"))


@query("flatten_known_shape", f"""
WITH {v.PRODUCTS_SQL}
SELECT product_id, brand AS maker_brand_name, price AS maker_price, '["' || category_code || '"]' AS codes FROM v_products
""")
def flatten_known_shape(spark: SparkSession, folder: str) -> DataFrame:
    shaped = v.products(spark, folder).select(
        "product_id", F.struct(F.col("brand").alias("brand.name"), "price").alias("maker"), F.array("category_code").alias("codes")
    )
    return payloads.flatten_struct(shaped)


def _land_products(spark: SparkSession, folder: str) -> str:
    root = scratch_dir(spark, "landing")
    rows = v.products(spark, folder)
    placed = landing.with_landing_cols(
        rows.select("product_id", "name", "price", "category_code", "p_partkey"),
        "shop a", "products", _category(),
        F.date_add(F.lit("2025-07-01").cast("date"), (F.col("p_partkey") % 5).cast("int")),
    )
    landing.write_landing(placed.drop("p_partkey"), root, bom=True)
    return root


@query("landing_path_fields", f"""
WITH {v.PRODUCTS_SQL}
SELECT product_id, 'products' AS kind, {_CATEGORY} AS category,
       CAST(DATE '2025-07-01' + CAST(p_partkey % 5 AS INTEGER) AS DATE) AS landed_on
FROM v_products
""")
def landing_path_fields(spark: SparkSession, folder: str) -> DataFrame:
    root = _land_products(spark, folder)
    schema = T.StructType().add("product_id", "string").add("name", "string").add("price", "double").add("category_code", "string")
    # the files alone, without Spark's own reading of the folder names
    reader = landing.csv_reader(spark).option("recursiveFileLookup", True)
    rows = landing.with_path_fields(reader.schema(schema).csv(root), ["kind", "category", "landed_on"])
    return rows.select("product_id", "kind", "category", "landed_on")


@query("todo_anti_join", f"""
WITH {v.REVIEWS}, {v.PRODUCTS_SQL}
SELECT product_id, name FROM v_products WHERE product_id NOT IN (SELECT product_id FROM v_reviews)
""")
def todo_anti_join(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.exclude(v.products(spark, folder).select("product_id", "name"), v.reviews(spark, folder), "product_id")


@query("landed_manifest", f"""
WITH {v.PRODUCTS_SQL}, landed AS (SELECT DISTINCT {_CATEGORY} AS category FROM v_products),
todo AS (SELECT category FROM landed UNION SELECT brand FROM v_products)
SELECT category FROM todo WHERE NOT EXISTS (SELECT 1 FROM landed WHERE landed.category IS NOT DISTINCT FROM todo.category)
""")
def landed_manifest(spark: SparkSession, folder: str) -> DataFrame:
    root = _land_products(spark, folder)
    products = v.products(spark, folder)
    todo = products.select(F.explode(F.array(_category(), F.col("brand"))).alias("category")).distinct()
    return landing.not_yet_landed(todo, landing.manifest(spark, root, "*.csv"), "category")


@query("landing_log", f"""
WITH {v.PRODUCTS_SQL}, landed AS (SELECT DISTINCT {_CATEGORY} AS category FROM v_products WHERE p_partkey % 5 <> 4),
todo AS (SELECT DISTINCT {_CATEGORY} AS category FROM v_products UNION SELECT DISTINCT brand FROM v_products)
SELECT category FROM todo WHERE NOT EXISTS (SELECT 1 FROM landed WHERE landed.category IS NOT DISTINCT FROM todo.category)
""")
def landing_log(spark: SparkSession, folder: str) -> DataFrame:
    """Two landings on different days; what is still to do comes from their log, without listing a folder."""
    log = LandingLog(scratch_dir(spark, "logged"))
    products = v.products(spark, folder)
    rows = products.select("product_id", "name", "price", "category_code", "brand", "p_partkey")
    for day in range(2):
        part = rows.filter((F.col("p_partkey") % 5 != 4) & (F.col("p_partkey") % 2 == day))
        log.land(part, "shop", "products", _category(), F.lit(f"2025-07-0{day + 1}").cast("date"))
    todo = products.select(F.explode(F.array(_category(), F.col("brand"))).alias("category")).distinct()
    return landing.not_yet_landed(todo, log.entries(spark), "category")


@query("load_audit", f"""
WITH {v.PRODUCTS_SQL}
SELECT {_CATEGORY} AS category, count(*) AS records, 'product_id,name,price,category_code' AS columns,
       '{v.SCRAPED_AT}' AS loaded_at
FROM v_products GROUP BY 1
""")
def load_audit(spark: SparkSession, folder: str) -> DataFrame:
    root = _land_products(spark, folder)
    schema = T.StructType().add("product_id", "string").add("name", "string").add("price", "double").add("category_code", "string")
    reader = landing.csv_reader(spark).option("recursiveFileLookup", True)
    per_file = landing.load_audit(reader.schema(schema).csv(root), v.SCRAPED_AT)
    placed = per_file.withColumn("category", landing.landing_path_cols(F.col("file_path"))["category"])
    # how many files a category has depends on the cluster, its records do not
    return placed.groupBy("category", "columns", "loaded_at").agg(F.sum("records").alias("records"))


@query("column_projection", f"""
WITH {v.PRODUCTS_SQL}
SELECT product_id, name, price FROM v_products UNION ALL
SELECT 's' || CAST(s_suppkey AS VARCHAR), s_name, s_acctbal FROM supplier
""")
def column_projection(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "appended")
    columns = ["product_id", "name", "price"]
    suppliers = v.table(spark, folder, "supplier").select(
        F.col("s_acctbal").alias("price"), F.col("s_name").alias("name"), F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("product_id")
    )
    landing.append_rows(v.products(spark, folder), path, columns)
    landing.append_rows(suppliers, path, columns)
    return landing.read_landed_csv(spark, path, T.StructType().add("product_id", "string").add("name", "string").add("price", "double"))


@query("landing_stream", f"""
WITH {v.DUPLICATED}
SELECT review_uid, any_value(md5(content)) AS digest FROM v_dup_reviews WHERE review_uid <> '' GROUP BY review_uid
""")
def landing_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Parts land newest first, half a year apart, each in as many files as it has tasks, and are picked up as they land."""
    root, out, state = (scratch_dir(spark, n) for n in ("arrivals", "picked-up", "stream-state"))
    part = F.col("arrival") % 3
    rows = v.duplicated_reviews(spark, folder).select(
        "review_uid",
        F.md5("content").alias("digest"),
        F.timestamp_seconds(F.col("arrival") % 86400 + F.lit(1751414400) - part * F.lit(180 * 86400)).alias("scraped_at"),
        part.alias("part"),
    )
    for number in range(3):
        rows.filter(F.col("part") == number).drop("part").write.mode("append").parquet(root)
        drain(spark, LandedFiles(root, rows.drop("part").schema, ["review_uid"]), out, state, [F.col("scraped_at"), F.col("digest")])
    return spark.read.parquet(out).select("review_uid", "digest")


@query("page_batches", f"""
WITH {v.CRAWL_PAGES}
SELECT job, CAST(floor((page - 1) / 10) AS BIGINT) AS batch, count(*) AS n_pages, CAST(sum(n_items) AS BIGINT) AS n_items
FROM v_crawl_pages GROUP BY 1, 2
""")
def page_batches(spark: SparkSession, folder: str) -> DataFrame:
    batched = paging.batch_id(v.crawl_pages(spark, folder))
    return batched.groupBy("job", "batch").agg(F.count(F.lit(1)).alias("n_pages"), F.sum("n_items").cast("bigint").alias("n_items"))
