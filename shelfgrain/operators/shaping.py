"""Filters, lookups and the conformed tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import numbers, text
from ..schemas import CONFORMED_PRODUCTS, CONFORMED_REVIEWS


def valid_for_scoring(df: DataFrame) -> DataFrame:
    """Rows with text and at least one star."""
    content, star = F.col("content"), F.col("star")
    return df.filter(content.isNotNull() & (content != "") & star.isNotNull() & (star >= 1))


def with_true_label(df: DataFrame, star: str = "star") -> DataFrame:
    return df.withColumn("true_label", text.label_from_star(F.col(star)))


def lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str, value: str, out: str, default: Column) -> DataFrame:
    """Name for a code, or the default. No hint: Spark broadcasts the dimension only if it is small."""
    names = dim.select(F.col(dim_key).alias("_key"), F.col(value).alias("_name"))
    joined = df.join(names, df[key] == F.col("_key"), "left")
    return joined.withColumn(out, F.coalesce(F.col("_name"), default)).drop("_key", "_name")


def name_of_code(code: Column, names: dict[str, str] = fv.RANKING_CATEGORIES, default: Column | None = None) -> Column:
    """The same for a fixed table, as a literal map inside the projection."""
    pairs = [F.lit(x) for item in names.items() for x in item]
    fallback = default if default is not None else F.concat(F.lit("category_"), code)
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), fallback)


def code_of_name(name: Column, codes: dict[str, str] = fv.CARD_CATEGORIES) -> Column:
    """Id of a category name from a fixed table; null for a name it lacks."""
    pairs = [F.lit(x) for item in codes.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), name)


def category_dim(spark: SparkSession, names: dict[str, str] = fv.RANKING_CATEGORIES) -> DataFrame:
    """A fixed category table as a dimension: (category_code, category_name)."""
    return spark.createDataFrame(list(names.items()), "category_code string, category_name string")


def categories_by_prefix(dim: DataFrame, prefix: str, name: str = "category_name") -> DataFrame:
    return dim.filter(F.col(name).startswith(prefix))


def category_metadata(dim: DataFrame, at: dt.datetime, source: str, kind: str = "products") -> DataFrame:
    """Category rows stamped with the moment of the crawl."""
    moment = at.isoformat()
    return dim.withColumns(
        {
            "crawling_timestamp": F.lit(moment),
            "crawling_date": F.lit(moment[:10]),
            "crawling_time": F.lit(moment[11:19]),
            "source": F.lit(source),
            "data_type": F.lit(kind),
        }
    )


def stamp(df: DataFrame, content: str = "content", **stamps) -> DataFrame:
    """Drop rows without content and add constant columns."""
    kept = df.filter(F.col(content).isNotNull() & (F.col(content) != ""))
    return kept.withColumns({k: v if isinstance(v, Column) else F.lit(v) for k, v in stamps.items()})


def with_run_date(df: DataFrame, day: str) -> DataFrame:
    return df.withColumn("run_date", F.to_date(F.lit(day)))


def product_ids(df: DataFrame, col: str = "product_id") -> DataFrame:
    return df.filter(F.col(col) != "").select(col)


def _stars(written: Column) -> Column:
    """Last number of a written rating: '5', '5점', '4.0'."""
    return F.regexp_extract(written, r"([0-9]+)(?:\.[0-9]+)?[^0-9]*$", 1).try_cast("int")


def _review_shape(df: DataFrame, source: str, uid: Column, content: Column, star: Column, created: Column) -> DataFrame:
    cols = {
        "review_uid": uid, "source": F.lit(source), "product_id": F.col("product_id"), "content": content,
        "star": star, "created_at": text.parse_time(created),
    }
    return df.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in CONFORMED_REVIEWS.fields])


def conform_reviews(a: DataFrame, b: DataFrame, c: DataFrame) -> DataFrame:
    """Reviews of the three shops as one table.

    a: flattened payload (no, grade, content, createDate). b: span markup (review_id,
    rating, content, created_at). c: list markup (review_id, star, review, date).
    """
    parts = [
        _review_shape(a, "shop_a", F.concat(F.lit("a_"), F.col("no")), F.col("content"), _stars(F.col("grade")), F.col("createDate")),
        _review_shape(b, "shop_b", F.concat(F.lit("b_"), F.col("review_id")), F.col("content"), _stars(F.col("rating")), F.col("created_at")),
        _review_shape(c, "shop_c", F.concat(F.lit("c_"), F.col("review_id")), _stated(F.col("review")), _stars(F.col("star")), F.col("date")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _stated(value: Column) -> Column:
    """Null for the markers that stand for 'missing'."""
    return F.when((value != fv.MISSING) & (value != ""), value)


def _product_shape(df: DataFrame, source: str, **cols: Column) -> DataFrame:
    cols["source"] = F.lit(source)
    return df.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in CONFORMED_PRODUCTS.fields])


def conform_products(a: DataFrame, b: DataFrame, c: DataFrame) -> DataFrame:
    """Products of the three shops (ranking, card and listing rows) as one table."""

    def written(name: str) -> Column:
        return _stated(F.col(name).cast("string"))

    def real(name: str) -> Column:
        return written(name).try_cast("double")

    def count(name: str) -> Column:
        return numbers.price_number(F.regexp_replace(written(name), r"\+$", ""))

    parts = [
        _product_shape(
            a, "shop_a", product_id=F.col("product_id"), name=F.col("name"), brand=_stated(F.col("brand")),
            price=numbers.price_number(written("price")), rating=real("rating"), review_count=count("review_count"),
            category=F.col("category_name"), product_url=_stated(F.col("product_url")),
        ),
        _product_shape(
            b, "shop_b", product_id=F.col("product_id"), name=F.col("name"), brand=_stated(F.col("brand")),
            price=numbers.price_number(written("price")), rating=real("rating"), review_count=count("review_count"),
            category=F.get(F.col("categories"), F.lit(0)), product_url=_stated(F.col("product_url")),
        ),
        _product_shape(
            c, "shop_c", product_id=F.col("product_id"), name=F.col("name"), brand=_stated(F.col("brand")),
            price=numbers.price_number(F.col("price")), rating=real("rating"), review_count=count("review_count"),
            category=F.col("category"), product_url=_stated(F.col("url")),
        ),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
