"""Numbers hidden in text: prices, counts, ratings, label texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fv


def price_number(text: Column) -> Column:
    """'15,700원' -> 15700; anything that is not all digits after clean-up -> null."""
    cleaned = F.regexp_replace(text, f"[,{fv.WON}]", "")
    return F.when(cleaned.rlike("^[0-9]+$"), cleaned.try_cast("bigint"))


def original_price(price: Column, rate: Column) -> Column:
    """Price before a discount of `rate` percent; null without a discount and for 100 percent."""
    before = F.try_divide(price.cast("bigint") * 100, 100 - rate.cast("bigint"))
    return F.when((rate > 0) & (rate != 100), before.cast("bigint"))


def first_count(text: Column, compat: bool = False) -> Column:
    """First number of a text. `compat` reads '1,385' as 1, as a plain digit run."""
    if compat:
        return _digits(F.regexp_extract(text, r"([0-9]+)", 1))
    return _digits(F.regexp_extract(text, r"([0-9][0-9,]*)", 1))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, ",", "").try_cast("bigint")


def rating_from_width(style: Column) -> Column:
    """CSS width percentage on a five-point scale, one decimal; '' where there is none."""
    width = F.regexp_extract(style, fv.WIDTH_PERCENT, 1).try_cast("double")
    return F.when(width.isNotNull(), F.call_function("format_number", width / 20, F.lit("0.0"))).otherwise("")


def parens_count_text(text: Column) -> Column:
    found = F.regexp_extract(text, fv.COUNT_IN_PARENS, 1)
    return F.when(found != "", found)


def parens_count(text: Column) -> Column:
    return _digits(F.regexp_extract(text, fv.COUNT_IN_PARENS, 1))


def parens_count_capped(text: Column) -> Column:
    """True for counts the shop cut off, such as '(999+)'."""
    return F.regexp_extract(text, fv.COUNT_IN_PARENS, 2) == "+"


# label texts are searched as one text; the separator keeps a match inside one label
_SEP = "\u0001"
_TO_LAST = rf"(?s)^(?:.*{_SEP})?"


def _as_one(texts: Column) -> Column:
    return F.array_join(texts, _SEP)


def viewers(texts: Column, compat: bool = False) -> Column:
    """Viewer count of the last text that states one, else 0."""
    stated = fv.VIEWERS_PLAIN if compat else fv.VIEWERS_COMMA
    found = F.regexp_extract(_as_one(texts), f"{_TO_LAST}[^{_SEP}]*?{stated}", 1)
    return F.coalesce(_digits(found), F.lit(0).cast("bigint"))


def likes(texts: Column, compat: bool = False, last: bool = False) -> Column:
    """First number of the first (or `last`) viewer text that holds a number."""
    number = "[0-9]+" if compat else "[0-9][0-9,]*"
    start = _TO_LAST if last else f"(?:^|{_SEP})"
    viewer_text = f"(?=[^{_SEP}]*{fv.VIEWING_PHRASE})"
    return _digits(F.regexp_extract(_as_one(texts), f"{start}{viewer_text}[^{_SEP}]*?({number})", 1))


def sales(labels: Column) -> Column:
    """Sold units of the first label in the thousands form, else 0."""
    thousands = F.regexp_extract(_as_one(labels), fv.SALES_THOUSANDS, 1)
    return F.coalesce((thousands.try_cast("double") * 1000).cast("int"), F.lit(0))


def total_items(info: Column, page_numbers: Column, page_size: int = fv.GRID_PAGE_SIZE, compat: bool = False) -> Column:
    """Stated total, else highest page number x page size, else one page."""
    stated = first_count(info, compat)
    highest = F.array_max(F.transform(page_numbers, lambda p: p.try_cast("bigint")))
    paged = F.when(F.size(page_numbers) > 0, F.greatest(F.coalesce(highest, F.lit(1)), F.lit(1)) * page_size)
    return F.coalesce(stated, paged, F.lit(page_size).cast("bigint"))


def page_count(total: Column, size: int, cap: int | None = None) -> Column:
    pages = F.ceil(total / F.lit(size)).cast("bigint")
    return pages if cap is None else F.least(pages, F.lit(cap).cast("bigint"))
