"""From collected pages to flat product and review rows, conformed and landed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import markup, paging, payloads, sampling, shaping
from ..sources import landing


def ranking_products(
    pages: DataFrame, scraped_at: str, size: int, url_base: str = "/goods/", compat: bool = False, categories: int | None = None
) -> DataFrame:
    """Ranking payload pages (category_code, page, n_items, payload) to product rows.

    Pages after the first empty one of a category do not count. `categories` is a proven
    bound on the number of categories, if there is one.
    """
    counted = paging.take_until_empty(pages, "category_code", "page", jobs=categories).drop("n_items")
    items = payloads.explode_ranking(counted, "payload", "page", size)
    rows = payloads.project_ranking_item(items, url_base=url_base, compat=compat)
    return rows.withColumns(
        {"scraped_at": F.lit(scraped_at), "category_name": shaping.name_of_code(F.col("category_code"))}
    )


def card_products(pages: DataFrame, scraped_at: str, variant: str = "service", url_base: str = "/window-products/") -> DataFrame:
    """Product-card payload pages (category_name, page, payload) to product rows, with the id of the category."""
    rows = payloads.project_card(payloads.explode_cards(pages, "payload"), variant, url_base)
    stamps = {"scraped_at": F.lit(scraped_at)}
    if "category_name" in pages.columns:
        stamps["category_id"] = shaping.code_of_name(F.col("category_name"))
    return rows.withColumns(stamps)


def listing_products(pages: DataFrame, scraped_at: str, base: str = "", categories: int | None = None) -> DataFrame:
    """Listing pages (category, page, html, n_items if counted) to product rows, first seen per product.

    `categories` is a proven bound on the number of categories, if there is one; then pages stay where they are.
    """
    counted = _until_empty(pages, "category", categories)
    rows = markup.extract_products(counted, base=base).withColumn("scraped_at", F.lit(scraped_at))
    return sampling.dedup_first(rows, "product_id", [F.col("page"), F.col("position")])


def payload_reviews(
    pages: DataFrame, scraped_at: str, review_id: str, arrival: list[Column], keys: list[tuple[str, str | None]] | None = None
) -> DataFrame:
    """Review payload pages (product_id, page, payload) to flat rows, first seen per review id."""
    stamps = {"scraped_at": F.lit(scraped_at)}
    flat = payloads.flatten_one_level(payloads.explode_reviews(pages, "payload", stamps), keys=keys)
    return sampling.dedup_first(flat, review_id, arrival)


def listed_reviews(pages: DataFrame, scraped_at: str, category: str | None = None) -> DataFrame:
    """Review pages in list markup (product_id, page, html, n_items if counted) to rows, first seen per review id."""
    rows = shaping.stamp(markup.extract_reviews(_until_empty(pages, "product_id")), "review", scraped_at=scraped_at, category=F.lit(category))
    return sampling.dedup_first(rows, "review_id", [F.col("page"), F.col("position")])


def span_reviews(pages: DataFrame, scraped_at: str, category: str | None = None) -> DataFrame:
    """Review pages in span markup (product_id, page, html) to rows, first seen per review id."""
    rows = shaping.stamp(markup.extract_review_spans(_until_empty(pages, "product_id")), scraped_at=scraped_at, category=F.lit(category))
    return sampling.dedup_first(rows, "review_id", [F.col("page"), F.col("position")])


def _until_empty(pages: DataFrame, job: str, jobs: int | None = None) -> DataFrame:
    return paging.take_until_empty(pages, job, "page", jobs=jobs).drop("n_items") if "n_items" in pages.columns else pages


PAYLOAD_KEYS: list[tuple[str, str | None]] = [("no", None), ("content", None), ("grade", None), ("createDate", None)]


def fact_reviews(payload_pages: DataFrame, span_pages: DataFrame, list_pages: DataFrame, scraped_at: str) -> DataFrame:
    """Reviews of the three shops, from their pages to the one conformed table."""
    a = payload_reviews(payload_pages, scraped_at, "no", [F.col("page"), F.col("position")], PAYLOAD_KEYS)
    return shaping.conform_reviews(a, span_reviews(span_pages, scraped_at), listed_reviews(list_pages, scraped_at))


def dim_products(
    ranking_pages: DataFrame, card_pages: DataFrame, list_pages: DataFrame, scraped_at: str, size: int, base: str = "", categories: int | None = None
) -> DataFrame:
    """Products of the three shops, from their pages to the one conformed table. `categories` bounds those of each shop."""
    a = ranking_products(ranking_pages, scraped_at, size, categories=categories)
    b = card_products(card_pages, scraped_at)
    return shaping.conform_products(a, b, listing_products(list_pages, scraped_at, base, categories))


def land(rows: DataFrame, root: str, source: str, kind: str, category: Column, day: Column, fmt: str = "csv") -> None:
    """Write rows below the dated folders of the landing layout."""
    landing.write_landing(landing.with_landing_cols(rows, source, kind, category, day), root, fmt, bom=fmt == "csv")
