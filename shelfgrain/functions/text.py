"""Text, URL, flag and label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fv


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def truthy(text: Column) -> Column:
    """The raw JSON text, or null where it is empty or a zero."""
    zero = F.coalesce(text.try_cast("double") == 0, F.lit(False))
    return F.when((text != "") & ~zero, text)


def coalesce_truthy(first: Column, second: Column) -> Column:
    return F.coalesce(truthy(first), second)


def first_word(name: Column) -> Column:
    return F.get(F.split(strip(name), r"\s+"), F.lit(0))


def safe_name(name: Column, slash: str = "&", spaces: bool = False) -> Column:
    """Name usable in a path: '/' replaced, and blanks too on request."""
    out = F.replace(name, F.lit("/"), F.lit(slash))
    return F.replace(out, F.lit(" "), F.lit("_")) if spaces else out


def breadcrumb(names: Column) -> Column:
    """a | a_b | a_b&c&... ; null for an empty trail."""
    rest = F.array_join(F.slice(names, 2, F.greatest(F.size(names) - 1, F.lit(0))), "&")
    return (
        F.when(F.size(names) == 1, F.get(names, F.lit(0)))
        .when(F.size(names) > 1, F.concat(F.get(names, F.lit(0)), F.lit("_"), rest))
    )


def percent_encode(text: Column) -> Column:
    """URL quoting that leaves '/' and '~' alone and writes blanks as %20."""
    out = F.url_encode(text)
    for coded, plain in (("+", "%20"), ("*", "%2A"), ("%2F", "/"), ("%7E", "~")):
        out = F.replace(out, F.lit(coded), F.lit(plain))
    return out


def absolute_url(url: Column, base: str) -> Column:
    return F.when((url == "") | url.startswith("http"), url).otherwise(F.concat(F.lit(base), url))


def id_from_query(url: Column, name: str = "goodsNo") -> Column:
    return F.regexp_extract(url, name + r"=([A-Z0-9]+)", 1)


def id_from_path(url: Column, segment: str = "products") -> Column:
    return F.regexp_extract(url, rf"/{segment}/([0-9]+)", 1)


def with_sort_param(url: Column, value: str = fv.FORCED_SORT, compat: bool = False) -> Column:
    """Set the sort parameter. `compat` always appends with '?', even behind another parameter."""
    joiner = F.lit("?") if compat else F.when(F.contains(url, F.lit("?")), "&").otherwise("?")
    return F.when(
        F.contains(url, F.lit("sort=")), F.regexp_replace(url, "sort=[^&]+", "sort=" + value)
    ).otherwise(F.concat(url, joiner, F.lit("sort=" + value)))


def contains_any(text: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for word in words:
        out = out | F.contains(text, F.lit(word))
    return out


def page_status(html: Column, markers: list[str] = fv.CHALLENGE_MARKERS) -> Column:
    return (
        F.when(html.isNull() | (html == ""), "empty")
        .when(contains_any(html, markers), "blocked")
        .otherwise("ok")
    )


def opinion_text(text: Column, words: list[str] = fv.OPINION_WORDS, longer_than: int = 50) -> Column:
    return (F.length(strip(text)) > longer_than) & contains_any(text, words)


def valid_review(star: Column, text: Column) -> Column:
    """A review needs a star, or a text longer than five characters."""
    return star.isNotNull() | F.coalesce(F.length(text) > 5, F.lit(False))


def review_uid(element_id: Column, name: Column, page: Column, position: Column) -> Column:
    """Suffix of the element id; without one, name, page and position make the id."""
    suffix = F.regexp_extract(element_id, "gdas_(.+)", 1)
    made = F.concat_ws("_", name, page.cast("string"), position.cast("string"))
    return F.when(suffix != "", suffix).otherwise(made)


def purchase_type(marked: Column) -> Column:
    return F.when(marked, fv.OFFLINE).otherwise(fv.ONLINE)


def label_from_star(star: Column) -> Column:
    return (
        F.when(star >= fv.STAR_POSITIVE_FROM, fv.POSITIVE)
        .when(star <= fv.STAR_NEGATIVE_UPTO, fv.NEGATIVE)
        .otherwise(fv.NEUTRAL)
    )


def label_from_prob(prob: Column, pos: float = fv.THRESH_POS, neg: float = fv.THRESH_NEG) -> Column:
    return F.when(prob >= pos, fv.POSITIVE).when(prob < neg, fv.NEGATIVE).otherwise(fv.NEUTRAL)


def parse_time(text: Column) -> Column:
    """The time forms found in landed files, as one timestamp without zone (UTC)."""
    forms = [
        "yyyy-MM-dd HH:mm:ss",
        "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS][XXX]",
        "yyyyMMdd_HHmmss",
        "yyyy-MM-dd",
        "yyyy.MM.dd[.]",
        "yy.MM.dd[.]",
    ]
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(form)) for form in forms])
