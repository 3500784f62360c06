"""Rows out of collected HTML pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import markup as mk
from ..functions import numbers, text

# ------------------------------------------------------------------------------ lists


def extract_links(pages: DataFrame, html: str = "html", container: str = "nav") -> DataFrame:
    """Links inside a container element: position, address and text."""
    df = mk.with_nodes(pages, html)
    boxes = mk.every(F.col("nodes"), mk.element(container))
    links = F.flatten(F.transform(boxes, lambda b: mk.every(mk.under(F.col("nodes"), b), mk.element("a", attr="href"))))
    rows = mk.explode_blocks(df, links)
    link = F.get(F.col("block"), F.lit(0))
    return rows.withColumns({"href": mk.attribute(link, "href"), "link_text": mk.tight_text_of(F.col("block"), link)}).drop("block")


def extract_menu(pages: DataFrame, html: str = "html", base: str = "", sort: str | None = fv.FORCED_SORT) -> DataFrame:
    """Category menu entries with a name and a URL; '/' in names becomes '_'."""
    rows = mk.extract_rows(mk.with_nodes(pages, html), [mk.element(*fv.MENU_ITEM)])
    blk = F.col("block")
    name = mk.tight_text_of(blk, mk.first(blk, mk.element(*fv.MENU_TITLE)))
    relative = mk.attribute(mk.first(blk, mk.element("button")), fv.MENU_URL_ATTR)
    url = F.concat(F.lit(base), F.when(relative != "", relative))
    out = rows.withColumns({"name": text.safe_name(name, "_"), "url": text.with_sort_param(url, sort) if sort else url})
    return out.drop("block").filter((F.col("name") != "") & F.col("url").isNotNull())


def extract_products(pages: DataFrame, html: str = "html", base: str = "") -> DataFrame:
    """Products of listing pages: block selectors are tried in order, the first that finds any wins."""
    selectors = [mk.element(tag, cls) for tag, cls in fv.LISTING_SELECTORS if cls]
    df = mk.with_nodes(pages, html)
    nodes = F.col("nodes")
    with_paragraph = F.filter(
        nodes, lambda n: mk.element("article")(n) & (F.size(mk.every(mk.under(nodes, n), mk.element("p"))) > 0)
    )
    found = [mk.every(nodes, s) for s in selectors]
    article_at = [cls for _, cls in fv.LISTING_SELECTORS].index(None)
    found.insert(article_at, with_paragraph)
    rows = mk.explode_blocks(df, mk.first_non_empty(found))
    return project_product(rows, base=base)


def project_product(rows: DataFrame, block: str = "block", base: str = "") -> DataFrame:
    """Product columns of a listing block; '' where the page has none."""
    blk = F.col(block)

    def field(tag: str, cls: str) -> Column:
        return F.coalesce(mk.tight_text_of(blk, mk.first(blk, mk.element(tag, cls))), F.lit(""))

    def price_in(cls: str) -> Column:
        box = mk.first(blk, mk.element("span", cls))
        amount = mk.first(mk.under(blk, box), mk.element("span", "tx_num"))
        return F.when(box.isNotNull(), F.coalesce(mk.tight_text_of(blk, amount), F.lit("")))

    href = F.coalesce(mk.attribute(mk.first(blk, mk.element("a", "prd_thumb")), "href"), F.lit(""))
    url = text.absolute_url(href, base)
    style = F.coalesce(mk.attribute(mk.first(blk, mk.element("span", "point")), "style"), F.lit(""))
    points = F.coalesce(mk.text_of(blk, mk.first(blk, mk.element("p", "prd_point_area"))), F.lit(""))
    return rows.withColumns(
        {
            "product_id": text.id_from_query(url),
            "name": field("p", "tx_name"),
            "brand": field("span", "tx_brand"),
            "price": F.coalesce(price_in("tx_cur"), price_in("tx_org"), F.lit("")),
            "url": url,
            "rating": numbers.rating_from_width(style),
            "review_count": F.coalesce(F.nullif(F.regexp_extract(points, r"\(([^()]*)\)", 1), F.lit("")), F.lit("")),
        }
    ).drop(block)


def extract_grid(pages: DataFrame, html: str = "html") -> DataFrame:
    """Ranking rows of a grid page, addressed by position; '0' or '' where a cell is missing.

    The grid is main > article > row divs > cell divs, rows starting at the second div.
    """
    df = mk.with_nodes(pages, html)
    nodes = F.col("nodes")
    main = mk.first(nodes, mk.element("main"))
    lines = mk.children(nodes, mk.child(nodes, main, "article", 1), "div")
    behind_menu = mk.let(lines, lambda found: F.slice(found, 2, F.greatest(F.size(found) - 1, F.lit(0))))
    cells = F.flatten(F.transform(behind_menu, lambda line: mk.children(nodes, line, "div")))
    rows = mk.explode_blocks(df, cells)
    blk = F.col("block")
    cell = F.get(blk, F.lit(0))

    def at(*steps: tuple[str, int]) -> Column:
        return mk.text_of(blk, mk.walk(blk, cell, *steps))

    head, info, counts = (("div", 2), ("div", 1)), ("div", 1), ("div", 2)
    link = mk.walk(blk, cell, ("div", 1), ("a", 1))
    price = [*head, ("div", 1)]
    people = [("div", 2), counts, info]
    return rows.withColumns(
        {
            "product_id": F.coalesce(text.id_from_path(mk.attribute(link, "href")), F.lit("")),
            "brand": F.coalesce(at(*head, ("a", 1), ("p", 1)), F.lit("")),
            "product_name": F.coalesce(at(*head, ("a", 2), ("p", 1)), F.lit("")),
            "discount": F.coalesce(at(*price, ("span", 1)), F.lit("0")),
            "price": F.coalesce(at(*price, ("span", 2)), at(*price, ("span", 1)), F.lit("0")),
            "interest": F.coalesce(at(*people, ("span", 1)), F.lit("0")),
            "purchase": F.coalesce(at(*people, ("span", 2)), F.lit("0")),
        }
    ).drop("block")


def extract_details(pages: DataFrame, html: str = "html") -> DataFrame:
    """Description, ingredients, usage and image list of a product page."""
    df = mk.with_nodes(pages, html)
    nodes = F.col("nodes")

    def field(cls: str) -> Column:
        return F.coalesce(mk.tight_text_of(nodes, mk.first(nodes, mk.element("div", cls))), F.lit(""))

    sources = F.transform(mk.every(nodes, mk.element("img", "prd_img")), lambda n: mk.attribute(n, "src"))
    return df.withColumns(
        {
            "description": field("detail_info"),
            "ingredients": field("ingredients"),
            "how_to_use": field("usage"),
            "images": F.filter(sources, lambda s: s != ""),
        }
    ).drop("nodes")


def page_totals(pages: DataFrame, html: str = "html", compat: bool = False) -> DataFrame:
    """Total items of a listing: stated on the page, else from the page links, else one page."""
    df = mk.with_nodes(pages, html)
    nodes = F.col("nodes")
    info = mk.tight_text_of(nodes, mk.first(nodes, mk.element("p", "cate_info_tx")))
    bar = mk.first(nodes, mk.element("div", "pageing"))
    links = mk.every(mk.under(nodes, bar), mk.element("a"))
    page_numbers = F.coalesce(F.transform(links, lambda a: mk.tight_text_of(nodes, a)), F.array().cast("array<string>"))
    return df.withColumn("total_items", numbers.total_items(info, page_numbers, compat=compat)).drop("nodes")


# ---------------------------------------------------------------------------- reviews


def extract_reviews(pages: DataFrame, html: str = "html", page: str = "page") -> DataFrame:
    """Reviews of a product page, with the page's product name and total count.

    Kept are reviews with a star, or with a text longer than five characters.
    """
    df = mk.with_nodes(pages, html)
    nodes = F.col("nodes")
    tab = mk.first(nodes, mk.element("a", "goods_reputation"))
    tab_count = mk.text_of(nodes, mk.first(mk.under(nodes, tab), mk.element("span")))
    name = mk.text_of(nodes, mk.first(nodes, mk.element("p", "prd_name")))
    listing = mk.first(nodes, lambda n: (n["tag"] == "ul") & (mk.attribute(n, "id") == "gdasList"))
    items = mk.children(nodes, listing, "li")
    df = df.withColumns({"product_name": name, "total_review_count": numbers.parens_count_text(tab_count)})
    rows = mk.explode_blocks(df, items)
    blk = F.col("block")
    score, recom, tag = (mk.first(blk, m) for m in (mk.element(cls="score_area"), mk.element(cls="recom_area"), mk.element("p", "tag")))
    button = mk.first(blk, lambda n: mk.element("button", "btn_recom")(n) & mk.attribute(n, "id").startswith("gdas_"))

    def inside(outer: Column, match: mk.Match) -> Column:
        return mk.text_of(blk, mk.first(mk.under(blk, outer), match))

    reviews = rows.withColumns(
        {
            "review_id": text.review_uid(F.coalesce(mk.attribute(button, "id"), F.lit("")), F.col("product_name"), F.col(page), F.col("position")),
            "star": inside(score, mk.element(cls="point")),
            "review": mk.text_of(blk, mk.first(blk, mk.element(cls="txt_inner"))),
            "skin_type": inside(tag, mk.element("span")),
            "date": inside(score, mk.element(cls="date")),
            "purchase_type": text.purchase_type(mk.first(blk, mk.element(cls=fv.OFFLINE_MARKER)).isNotNull()),
            "helpful": F.coalesce(inside(recom, mk.element("span", "num")), F.lit("0")),
        }
    ).drop("block")
    return reviews.filter(text.valid_review(F.col("star"), F.col("review")))


def extract_breadcrumb(pages: DataFrame, html: str = "html") -> DataFrame:
    """Category name from the breadcrumb links of a product page."""
    df = mk.with_nodes(pages, html)
    nodes = F.col("nodes")
    trail = mk.first(nodes, mk.element("div", "page_location"))
    links = mk.every(mk.under(nodes, trail), mk.element("a", "cate_y"))
    names = F.filter(F.transform(links, lambda a: mk.text_of(nodes, a)), lambda n: n != "")
    return df.withColumn("category_name", text.breadcrumb(names)).drop("nodes")


def extract_review_spans(pages: DataFrame, html: str = "html", image: bool = False) -> DataFrame:
    """Reviews marked up with spans only: the date is the first span text with a dot."""
    s = {k: mk.element(*v) for k, v in fv.SPAN_REVIEW.items() if k != "id_attr"}
    rows = mk.extract_rows(mk.with_nodes(pages, html), [s["item"]])
    blk = F.col("block")
    span_texts = F.transform(mk.every(blk, s["spans"]), lambda n: mk.text_of(blk, n))
    in_box = F.flatten(F.transform(mk.every(blk, s["content_box"]), lambda box: mk.children(blk, box)))
    content = mk.text_of(blk, mk.first(in_box, s["spans"]))
    cols = {
        "review_id": mk.attribute(F.get(blk, F.lit(0)), fv.SPAN_REVIEW["id_attr"]),
        "username": mk.text_of(blk, mk.first(blk, s["user"])),
        "created_at": F.get(F.filter(span_texts, lambda t: F.contains(t, F.lit("."))), F.lit(0)),
        "rating": mk.text_of(blk, mk.first(blk, s["rating"])),
        "content": F.coalesce(content, mk.text_of(blk, mk.first(blk, s["content_fallback"]))),
        "option": mk.text_of(blk, mk.first(blk, s["option"])),
    }
    if image:
        cols["image_url"] = mk.attribute(mk.first(blk, mk.element("img")), "src")
    return rows.withColumns(cols).drop("block")


def candidate_blocks(pages: DataFrame, html: str = "html", longer_than: int = 30) -> DataFrame:
    """Blocks that look like reviews: items of the first container that holds any,
    else every list item with a longer text. `via` tells which way found the block."""
    df = mk.with_nodes(pages, html)
    nodes = F.col("nodes")
    containers = [mk.element(cls=c) for c in fv.REVIEW_CONTAINERS] + [
        mk.element("ul"),
        mk.element(cls="goods_review"),
        mk.element(cls_like="review"),
    ]

    def is_item(n: Column) -> Column:
        words = [mk.element(cls_like=w, any_case=True)(n) for w in fv.REVIEW_BLOCK_WORDS]
        return n["tag"].isin("div", "li") & reduce(lambda a, b: a | b, words)

    found = [F.coalesce(F.filter(mk.under(nodes, mk.first(nodes, c)), is_item), F.array().cast(mk.NODE_TYPE)) for c in containers]
    long_items = F.filter(nodes, lambda n: (n["tag"] == "li") & (F.length(mk.tight_text_of(nodes, n)) > longer_than))
    df = df.withColumn("_found", mk.first_non_empty(found))
    df = df.withColumn("via", F.when(F.size("_found") > 0, "container").otherwise("long_item"))
    blocks = F.when(F.col("via") == "container", F.col("_found")).otherwise(long_items)
    return mk.explode_blocks(df, blocks).drop("_found")


def generic_review(rows: DataFrame, block: str = "block") -> DataFrame:
    """Review fields by trying class patterns in order; each candidate must pass its guard.

    Rows without content and rating are dropped. Every candidate is looked up once: it is
    bound for its guard, and the fields are bound in one struct for the last filter.
    """
    blk = F.col(block)

    def tried(selectors: list[tuple[str, str]], value) -> Column:
        """`value` of the first node for each (tag, class pattern), in order; the patterns are data, not plan."""
        listed = F.array(*[F.struct(F.lit(tag).alias("tag"), F.lit(like).alias("like")) for tag, like in selectors])

        def one(s: Column) -> Column:
            cls = lambda n: F.coalesce(F.try_element_at(n["attrs"], F.lit("class")), F.lit(""))
            return mk.let(F.get(F.filter(blk, lambda n: (n["tag"] == s["tag"]) & F.contains(cls(n), s["like"])), F.lit(0)), value)

        return F.transform(listed, one)

    def cascade(selectors: list[tuple[str, str]], guard, value=lambda n: mk.tight_text_of(blk, n)) -> Column:
        return F.coalesce(F.get(F.filter(tried(selectors, value), guard), F.lit(0)), F.lit(""))

    def stated(node: Column) -> Column:
        width = mk.let(F.coalesce(mk.attribute(node, "style"), F.lit("")), numbers.rating_from_width)
        return F.coalesce(F.nullif(mk.tight_text_of(blk, node), F.lit("")), F.nullif(width, F.lit("")))

    fields = {
        "rating": cascade(fv.GENERIC_RATING, lambda t: t.isNotNull(), stated),
        "title": cascade(fv.GENERIC_TITLE, lambda t: t.isNotNull()),
        "content": cascade(fv.GENERIC_CONTENT, lambda t: F.length(t) > 10),
        "author": cascade(fv.GENERIC_AUTHOR, lambda t: (t != "") & ~text.contains_any(F.lower(t), fv.RATING_WORDS)),
        "date": cascade(fv.GENERIC_DATE, lambda t: t.rlike("[0-9]") & (F.length(t) >= 8)),
        "helpful_count": cascade(fv.GENERIC_HELPFUL, lambda t: t.rlike("[0-9]")),
    }
    bound = F.array(F.struct(*[c.alias(k) for k, c in fields.items()]))
    kept = F.filter(bound, lambda r: (r["content"] != "") | (r["rating"] != ""))
    others = [c for c in rows.columns if c != block and c not in fields]
    return rows.select(*others, F.explode(kept).alias("_fields")).select(*others, "_fields.*")


# ----------------------------------------------------------------------------- probes


def selector_profile(pages: DataFrame, patterns: list[str], html: str = "html", more_than: int = 5) -> DataFrame:
    """Elements per class pattern over all pages, for patterns found more than five times.

    Class values, however they are quoted, are counted first, so the patterns meet one row
    per distinct value.
    """
    with_class = mk.every(F.col("nodes"), mk.element(attr="class"))
    values = mk.with_nodes(pages, html).select(F.explode(F.transform(with_class, lambda n: mk.attribute(n, "class"))).alias("value"))
    counted = values.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    matching = F.filter(F.array(*[F.lit(p) for p in patterns]), lambda p: F.contains(F.col("value"), p))
    return (
        counted.withColumn("pattern", F.explode(matching))
        .groupBy("pattern")
        .agg(F.sum("n").cast("bigint").alias("n_elements"))
        .filter(F.col("n_elements") > more_than)
    )
