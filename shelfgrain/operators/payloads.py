"""Rows out of collected JSON payloads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import nested as nv
from ..functions import numbers, text
from ..schemas import RANKING_PAYLOAD

# ----------------------------------------------------------------- ranking payloads

MOST_COLUMNS = 10_000


def explode_ranking(df: DataFrame, payload: str, page: str, size: int) -> DataFrame:
    """One row per product item of a ranking payload, with its absolute rank.

    The rank counts every product item of the page, so an item dropped later leaves a gap.
    A payload of another shape gives no rows.
    """
    parsed = F.from_json(F.col(payload), RANKING_PAYLOAD)
    modules = F.filter(parsed["data"]["modules"], lambda m: m["type"] == fv.LIST_MODULE)
    items = F.filter(
        F.flatten(F.transform(modules, lambda m: F.coalesce(m["items"], F.array().cast(_ITEMS)))),
        lambda i: i["type"] == fv.PRODUCT_NODE,
    )
    kept = [c for c in df.columns if c != payload]
    return df.select(*kept, F.posexplode(items).alias("_at", "item")).withColumn(
        "rank", absolute_rank(F.col(page), size, F.col("_at"))
    ).drop("_at")


_ITEMS = RANKING_PAYLOAD["data"].dataType["modules"].dataType.elementType["items"].dataType


def absolute_rank(page: Column, size: int, index: Column) -> Column:
    """Rank across pages of an item at a 0-based index of its page."""
    return ((page - 1) * size + index + 1).cast("int")


def _event(node: Column) -> Column:
    return node["eventLog"]["amplitude"]["payload"]


def product_url(product_id: Column, override: Column, base: str) -> Column:
    made = F.when(product_id != "", F.concat(F.lit(base), product_id)).otherwise("")
    return F.coalesce(override, made)


def _no_texts() -> Column:
    return F.array().cast("array<struct<text:string>>")


def project_ranking_item(df: DataFrame, item: str = "item", url_base: str = "/goods/", compat: bool = False, sentinels: bool = False) -> DataFrame:
    """Product columns of a ranking item, for items with a name and a brand.

    `sentinels` returns the text form with '' for missing values instead of typed nulls.
    """
    it = F.col(item)
    info, image, click = it["info"], it["image"], it["onClick"]
    first, second = _event(click), _event(image["onClickLike"])
    texts = F.transform(F.coalesce(info["additionalInformation"], _no_texts()), lambda t: F.coalesce(t["text"], F.lit("")))
    labels = F.transform(F.coalesce(image["labels"], _no_texts()), lambda t: F.coalesce(t["text"], F.lit("")))
    product_id = F.coalesce(it["id"], F.lit(""))
    price, rate = info["finalPrice"].try_cast("bigint"), info["discountRatio"].try_cast("int")
    kept = [c for c in df.columns if c != item]
    out = df.filter(info.isNotNull()).select(
        *kept,
        product_id.alias("product_id"),
        info["productName"].alias("name"),
        info["brandName"].alias("brand"),
        price.alias("price"),
        numbers.original_price(price, rate).alias("original_price"),
        rate.alias("discount_rate"),
        text.coalesce_truthy(first["reviewScore"], second["reviewScore"]).try_cast("double").alias("rating"),
        text.coalesce_truthy(first["reviewCount"], second["reviewCount"]).try_cast("bigint").alias("review_count"),
        numbers.likes(texts, compat).alias("likes"),
        image["url"].alias("image_url"),
        product_url(product_id, click["url"], url_base).alias("product_url"),
        numbers.viewers(texts, compat).alias("number_of_views"),
        numbers.sales(labels).alias("sales"),
    )
    out = require(out, ["name", "brand"])
    if sentinels:
        plain = ["price", "original_price", "discount_rate", "rating", "review_count", "likes", "image_url"]
        out = out.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in plain})
    return out


def require(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows where every named column holds text."""
    return reduce(lambda d, c: d.filter(F.length(F.trim(F.col(c))) > 0), cols, df)


def find_nodes(df: DataFrame, payload: str, node_type: str = fv.PRODUCT_NODE) -> DataFrame:
    """Ids of the nodes of one type at any depth; per payload distinct, in document order."""
    kept = [c for c in df.columns if c != payload]
    ids = nv.typed_ids(F.col(payload), node_type)
    return df.select(*kept, F.posexplode(ids).alias("position", "node_id")).withColumn("position", F.col("position") + 1)


# -------------------------------------------------------------- product-card payloads


def explode_cards(df: DataFrame, payload: str) -> DataFrame:
    """One row per card whose product is a non-empty object, as a key -> value map."""
    kept = [c for c in df.columns if c != payload]
    cards = nv.as_list(nv.parsed(F.col(payload)), "$.data.pagedCards.data")
    rows = df.select(*kept, F.posexplode(cards).alias("_at", "_card"))
    rows = rows.withColumn("product", nv.as_object(F.col("_card"), "$.data.product")).drop("_card")
    return rows.filter(F.size("product") > 0).withColumn("position", F.col("_at") + 1).drop("_at")


def card_price(product: Column, sentinel: str | None = fv.MISSING) -> Column:
    """Sale price if that key is present, even if null; else the original price; else the sentinel."""
    return nv.first_present(product, ["salePrice", "originalPrice"], F.lit(sentinel).cast("string"))


def _not_empty(value: Column) -> Column:
    return F.when(value != "", value)


def pick_image(product: Column, rule: str = "field", sentinel: str | None = fv.MISSING) -> Column:
    """'field': the representative image, else the first image with a URL.
    'flag': the image flagged as representative, else the first image."""
    images = F.coalesce(nv.as_list(nv.member(product, "images")), F.array().cast("array<variant>"))
    urls = F.transform(images, lambda i: nv.as_text(i, "$.imageUrl"))
    if rule == "field":
        stated = _not_empty(nv.member_text(product, "representativeImageUrl"))
        return F.coalesce(stated, F.get(F.filter(urls, lambda u: u != ""), F.lit(0)), F.lit(sentinel))
    if rule == "flag":
        flagged = F.filter(images, lambda i: F.try_variant_get(i, "$.representativeImage", "boolean"))
        first_flagged = _not_empty(nv.as_text(F.get(flagged, F.lit(0)), "$.imageUrl"))
        return F.coalesce(first_flagged, F.get(urls, F.lit(0)), F.lit(""))
    raise ValueError(f"unknown image rule {rule!r}")


def category_names(product: Column) -> Column:
    """Non-empty category names, else the single product category, else an empty list."""
    listed = F.coalesce(nv.as_list(nv.member(product, "categories")), F.array().cast("array<variant>"))
    names = F.filter(F.transform(listed, lambda c: nv.as_text(c, "$.name")), lambda n: n != "")
    single = nv.member_text(product, "productCategoryName")
    return F.when(F.size(names) > 0, names).when(single != "", F.array(single)).otherwise(F.array().cast("array<string>"))


def brand_of(product: Column, rule: str = "field", sentinel: str | None = fv.MISSING) -> Column:
    """'field': the nested brand name. 'first_word': first word of the product name."""
    if rule == "field":
        brand = nv.as_object(nv.member(product, "brand"))
        return nv.get_or(brand, "name", F.lit(sentinel))
    if rule == "first_word":
        return text.first_word(F.coalesce(nv.member_text(product, "name"), F.lit("")))
    raise ValueError(f"unknown brand rule {rule!r}")


def card_url(vertical: Column, product_id: Column, base: str, sentinel: str | None = fv.MISSING) -> Column:
    known = _not_empty(vertical).isNotNull() & text.truthy(product_id).isNotNull()
    return F.when(known, F.concat(F.lit(base), F.lower(vertical), F.lit("/"), product_id)).otherwise(F.lit(sentinel))


def project_card(df: DataFrame, variant: str = "service", url_base: str = "/window-products/", product: str = "product") -> DataFrame:
    """Typed columns of a product card.

    'service': sale price first. 'detail': that, with original price and detail text.
    'discount': the discounted price as price and the sale price as original price.
    """
    p = F.col(product)
    kept = [c for c in df.columns if c != product]
    product_id = nv.member_text(p, "id")
    if variant == "discount":
        cols = {
            "product_id": nv.get_or(p, "id", F.lit("")),
            "name": nv.get_or(p, "name", F.lit("")),
            "brand": brand_of(p, "first_word"),
            "price": nv.get_or(p, "pcDiscountedSalePrice", F.lit("")),
            "original_price": nv.get_or(p, "salePrice", F.lit("")),
            "discount_rate": nv.get_or(p, "pcDiscountedRatio", F.lit("")),
            "rating": nv.get_or(p, "averageReviewScore", F.lit("")),
            "review_count": nv.get_or(p, "totalReviewCount", F.lit("")),
            "url": F.when(nv.has_key(p, "id"), F.concat(F.lit(url_base), product_id)).otherwise(""),
            "image_url": pick_image(p, "flag"),
        }
        return df.select(*kept, *[c.alias(k) for k, c in cols.items()])
    if variant not in ("service", "detail"):
        raise ValueError(f"unknown card variant {variant!r}")
    channel = nv.as_object(nv.member(p, "channel"))
    cols = {
        "product_id": product_id,
        "name": nv.get_or(p, "name", F.lit(fv.MISSING)),
        "brand": brand_of(p),
        "price": card_price(p),
        "image_url": pick_image(p),
        "review_count": nv.get_or(p, "totalReviewCount", F.lit("0")).try_cast("bigint"),
        "rating": nv.get_or(p, "averageReviewScore", F.lit("0")).try_cast("double"),
        "product_url": card_url(nv.member_text(channel, "subVertical"), product_id, url_base),
        "categories": category_names(p),
        "channel_name": nv.get_or(channel, "name", F.lit(fv.MISSING)),
    }
    if variant == "detail":
        cols["original_price"] = nv.get_or(p, "originalPrice", F.lit(fv.MISSING))
        cols["detail_content"] = nv.get_or(p, "detailContent", F.lit(fv.MISSING))
        cols["image_url"] = nv.get_or(p, "representativeImageUrl", F.lit(fv.MISSING))
    return df.select(*kept, *[c.alias(k) for k, c in cols.items()])


# ------------------------------------------------------------------- review envelopes


def explode_reviews(df: DataFrame, payload: str, stamps: dict[str, Column] | None = None) -> DataFrame:
    """One row per review of `data.list[]` as a VARIANT, with stamped columns."""
    kept = [c for c in df.columns if c != payload]
    listed = nv.as_list(nv.parsed(F.col(payload)), "$.data.list")
    rows = df.select(*kept, F.posexplode(listed).alias("position", "review"))
    return rows.withColumns({"position": F.col("position") + 1, **(stamps or {})})


def review_keys(df: DataFrame, review: str = "review") -> list[tuple[str, str | None]]:
    """The (key, child key) pairs that occur, one pair per column of the flat form.

    Distinct pairs are combined on the executors; the driver receives column names only,
    and no more than `MOST_COLUMNS` of them: keys that are ids belong in a map instead.
    """
    entries = df.select(F.explode(nv.as_object(F.col(review))).alias("key", "value"))
    children = F.map_keys(nv.as_object(F.col("value")))
    pairs = entries.select("key", F.explode(F.coalesce(children, F.array(F.lit(None).cast("string")))).alias("child"))
    found = pairs.distinct().orderBy("key", F.col("child").asc_nulls_first()).limit(MOST_COLUMNS + 1).collect()
    if len(found) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} columns; pass the keys that are wanted, or use flatten_to_map")
    return [(r["key"], r["child"]) for r in found]


def flatten_to_map(df: DataFrame, review: str = "review", sep: str = "_", out: str = "fields") -> DataFrame:
    """The flat form as one map column, name -> text, for reviews of any shape: no pass to find columns.

    Names and texts are those of `flatten_one_level`; fields without a value are left out,
    and of fields that come to have one name the first stays.
    """

    def entry(name: Column, value: Column) -> Column:
        return F.struct(F.replace(name, F.lit("."), F.lit("_")).alias("name") if sep == "_" else name.alias("name"), _scalar(value).alias("value"))

    def entries(e: Column) -> Column:
        inner = nv.as_object(e["value"])
        below = F.transform(F.map_entries(inner), lambda c: entry(F.concat(e["key"], F.lit(sep), c["key"]), c["value"]))
        return F.when(inner.isNotNull(), below).otherwise(F.array(entry(e["key"], e["value"])))

    named = F.filter(F.flatten(F.transform(F.map_entries(nv.as_object(F.col(review))), entries)), lambda e: e["value"].isNotNull())
    first = F.filter(named, lambda e, i: ~F.exists(F.slice(named, F.lit(1), i), lambda x: x["name"] == e["name"]))
    return df.select(*[c for c in df.columns if c not in (review, out)], F.map_from_entries(first).alias(out))


def flatten_one_level(df: DataFrame, review: str = "review", sep: str = "_", keys: list[tuple[str, str | None]] | None = None) -> DataFrame:
    """Flat text columns: objects become parent_child, lists JSON text, dots in names `sep`.

    A key of the review wins over a stamped column of the same name. Without `keys`, one
    extra pass finds them; landed sources with a known shape should pass them.
    """
    obj = nv.as_object(F.col(review))
    columns: dict[str, Column] = {c: F.col(c) for c in df.columns if c != review}
    for key, sub in keys if keys is not None else review_keys(df, review):
        value = nv.member(obj, key)
        if sub is None:
            plain = F.when(nv.as_object(value).isNull(), nv.as_text(value))
            name, column = key, F.when(nv.as_list(value).isNotNull(), F.to_json(value)).otherwise(plain)
        else:
            name, column = f"{key}{sep}{sub}", _scalar(nv.member(nv.as_object(value), sub))
        name = name.replace(".", "_") if sep == "_" else name
        if name in columns and name in df.columns:
            column = F.when(nv.has_key(obj, key), column).otherwise(F.col(name).cast("string"))
        elif name in columns:
            column = F.coalesce(columns[name], column)
        columns[name] = column
    return df.select(*[c.alias(name) for name, c in columns.items()])


def _scalar(value: Column) -> Column:
    return F.when(nv.as_object(value).isNotNull() | nv.as_list(value).isNotNull(), F.to_json(value)).otherwise(nv.as_text(value))


def flatten_struct(df: DataFrame, sep: str = "_") -> DataFrame:
    """The same for a table whose schema is known: struct fields to columns, arrays to JSON text."""
    columns: dict[str, Column] = {}
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if kind == "struct":
            for sub in field.dataType.fields:
                columns[f"{field.name}{sep}{sub.name}"] = F.col(f"`{field.name}`")[sub.name]
        elif kind in ("array", "map"):
            columns[field.name] = F.to_json(F.col(f"`{field.name}`"))
        else:
            columns[field.name] = F.col(f"`{field.name}`")
    return df.select(*[c.alias(name.replace(".", "_") if sep == "_" else name) for name, c in columns.items()])


def union_all(dfs: list[DataFrame]) -> DataFrame:
    """Rows of all inputs; columns an input lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


# ---------------------------------------------------------------- structure discovery


def json_profile(df: DataFrame, payload: str) -> DataFrame:
    """Per path and kind: how often it occurs, and the shortest and longest list or object."""
    return nv.every_node(df, payload).groupBy("path", "kind").agg(
        F.count(F.lit(1)).alias("n_nodes"),
        F.min("items").cast("bigint").alias("min_items"),
        F.max("items").cast("bigint").alias("max_items"),
    )


def first_existing_path(df: DataFrame, payload: str, paths: list[list[str]] = fv.PAYLOAD_PATHS) -> DataFrame:
    """The first candidate path that leads to something countable, and its item count."""
    root = nv.parsed(F.col(payload))
    name, count = F.lit(None).cast("string"), F.lit(None).cast("int")
    for path in reversed(paths):
        at = "$." + ".".join(path)
        is_text = F.schema_of_variant(F.try_variant_get(root, at, "variant")) == "STRING"
        items = F.coalesce(
            F.size(nv.as_list(root, at)), F.size(nv.as_object(root, at)), F.when(is_text, F.length(nv.as_text(root, at)))
        )
        name = F.when(items.isNotNull(), " -> ".join(path)).otherwise(name)
        count = F.when(items.isNotNull(), items).otherwise(count)
    return df.withColumns({"found_path": name, "n_found": count}).drop(payload)


def keys_like(obj: Column, words: list[str]) -> Column:
    """Keys of an object whose lower-cased name holds any of the words, sorted."""
    named = F.filter(F.map_keys(obj), lambda k: text.contains_any(F.lower(k), words))
    return F.array_sort(named)
