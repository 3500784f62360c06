"""Edge cases of the column functions, on hand-made values."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfgrain.functions import nested as nv
from shelfgrain.functions import numbers, text


def values(spark, expr, *columns, schema=None):
    """Apply a column expression to rows of literal values."""
    df = spark.createDataFrame([c if isinstance(c, tuple) else (c,) for c in columns], schema or "v string")
    return [r[0] for r in df.select(expr.alias("out")).collect()]


def test_price_number(spark):
    got = values(spark, numbers.price_number(F.col("v")), "15,700", "15,700원", "N/A", "", "999+", None, "24750")
    assert got == [15700, 15700, None, None, None, None, 24750]


def test_original_price_rates(spark):
    rows = [(24750, 25), (1000, 0), (1000, 100), (999, 7), (None, 5), (1000, None)]
    got = values(spark, numbers.original_price(F.col("p"), F.col("r")), *rows, schema="p long, r int")
    assert got == [33000, None, None, int(999 * 100 / 93), None, None]


@pytest.mark.parametrize("compat, viewers, likes", [(False, 1234, 1234), (True, 234, 1)])
def test_viewer_texts_with_commas(spark, compat, viewers, likes):
    texts = F.split(F.col("v"), r"\|")
    assert values(spark, numbers.viewers(texts, compat), "1,234명이 보는 중") == [viewers]
    assert values(spark, numbers.likes(texts, compat), "1,234명이 보는 중") == [likes]


def test_viewers_last_text_wins_and_likes_first(spark):
    texts = F.split(F.col("v"), r"\|")
    row = "3일 배송|12명이 보는 중|명이 보는 중|7명이 보는 중 9명이 보는 중|끝 5"
    assert values(spark, numbers.viewers(texts), row) == [7]
    assert values(spark, numbers.likes(texts), row) == [12]
    assert values(spark, numbers.likes(texts, last=True), row) == [7]
    assert values(spark, numbers.viewers(texts), "없음") == [0]
    assert values(spark, numbers.likes(texts), "없음 5") == [None]


def test_likes_takes_first_number_of_the_text_even_before_the_phrase(spark):
    texts = F.split(F.col("v"), r"\|")
    assert values(spark, numbers.likes(texts), "3층 12명이 보는 중") == [3]


def test_sales_only_thousands_first_label(spark):
    labels = F.split(F.col("v"), r"\|")
    got = values(spark, numbers.sales(labels), "판매 1.2천개", "판매 500개|판매 3천개|판매 9천개", "신상", "판매 4.35천개")
    assert got == [1200, 3000, 0, int(4.35 * 1000)]


def test_rating_from_width_rounds_like_python(spark):
    widths = ["45", "43", "100", "0", "95.5", "33.3"]
    got = values(spark, numbers.rating_from_width(F.col("v")), *[f"color:red; width: {w}%" for w in widths])
    assert got == [f"{float(w) / 20:.1f}" for w in widths]
    assert values(spark, numbers.rating_from_width(F.col("v")), "height:4px", None) == ["", ""]


def test_counts_in_parens(spark):
    col = F.col("v")
    rows = ["리뷰(10,789)", "(999+)", "none", None]
    assert values(spark, numbers.parens_count_text(col), *rows) == ["10,789", "999", None, None]
    assert values(spark, numbers.parens_count(col), *rows) == [10789, 999, None, None]
    assert values(spark, numbers.parens_count_capped(col), *rows)[:3] == [False, True, False]


@pytest.mark.parametrize("compat, stated", [(False, 1385), (True, 1)])
def test_total_items(spark, compat, stated):
    pages = F.array(F.lit("1"), F.lit("12"), F.lit("next"))
    none = F.array().cast("array<string>")
    assert values(spark, numbers.total_items(F.col("v"), pages, compat=compat), "총 1,385개", None) == [stated, 288]
    assert values(spark, numbers.total_items(F.col("v"), none), None) == [24]
    assert values(spark, numbers.total_items(F.col("v"), F.array(F.lit("next"))), None) == [24]


def test_page_count(spark):
    rows = [(0,), (1,), (24,), (25,), (5000,)]
    assert values(spark, numbers.page_count(F.col("v"), 24), *rows, schema="v long") == [0, 1, 1, 2, 209]
    assert values(spark, numbers.page_count(F.col("v"), 24, 50), *rows, schema="v long") == [0, 1, 1, 2, 50]


def test_truthiness(spark):
    rows = [("", "b"), ("0", "b"), ("0.0", "b"), (None, "b"), ("4.8", "b"), ("x", "b"), ("0", None)]
    got = values(spark, text.coalesce_truthy(F.col("a"), F.col("b")), *rows, schema="a string, b string")
    assert got == ["b", "b", "b", "b", "4.8", "x", None]


def test_labels_at_the_thresholds(spark):
    rows = [(0.6,), (0.5999,), (0.4,), (0.3999,), (None,)]
    assert values(spark, text.label_from_prob(F.col("v")), *rows, schema="v double") == [
        "positive", "neutral", "neutral", "negative", "neutral"]
    stars = [(5,), (4,), (3,), (2,), (1,)]
    assert values(spark, text.label_from_star(F.col("v")), *stars, schema="v int") == [
        "positive", "positive", "neutral", "negative", "negative"]


def test_breadcrumb(spark):
    names = F.filter(F.split(F.col("v"), ","), lambda n: n != "")
    assert values(spark, text.breadcrumb(names), "a", "a,b", "a,b,c,d", "") == ["a", "a_b", "a_b&c&d", None]


def test_sort_parameter(spark):
    col = F.col("v")
    rows = ["/m?sort=OLD&p=1", "/m", "/m?p=1"]
    assert values(spark, text.with_sort_param(col, "NEW"), *rows) == ["/m?sort=NEW&p=1", "/m?sort=NEW", "/m?p=1&sort=NEW"]
    assert values(spark, text.with_sort_param(col, "NEW", compat=True), *rows)[2] == "/m?p=1?sort=NEW"


def test_percent_encode_like_urllib(spark):
    from urllib.parse import quote

    rows = ['{"a":1,"b":"x y"}', "a/b~c*d+e", "스킨케어", "100%"]
    assert values(spark, text.percent_encode(F.col("v")), *rows) == [quote(r) for r in rows]


def test_safe_names(spark):
    assert values(spark, text.safe_name(F.col("v")), "클렌징/필링") == ["클렌징&필링"]
    assert values(spark, text.safe_name(F.col("v"), "_", spaces=True), "뷰티 디바이스/소품") == ["뷰티_디바이스_소품"]


def test_valid_review(spark):
    rows = [(5, None), (None, "short"), (None, "longer text"), (None, None)]
    got = values(spark, text.valid_review(F.col("s"), F.col("t")), *rows, schema="s int, t string")
    assert got == [True, False, True, False]


def test_review_uid(spark):
    rows = [("gdas_77", "n", 1, 2), ("", "name", 1, 2)]
    got = values(spark, text.review_uid(F.col("e"), F.col("n"), F.col("p"), F.col("i")), *rows, schema="e string, n string, p int, i int")
    assert got == ["77", "name_1_2"]


def test_time_forms(spark):
    rows = ["2025-07-02 09:30:00", "2025-07-02T09:30:00.123456+00:00", "2025-07-02T09:30:00", "20250702_093000", "2025.07.02", "25.07.02.", "soon"]
    got = values(spark, F.date_format(text.parse_time(F.col("v")), "yyyy-MM-dd HH:mm"), *rows)
    assert got == ["2025-07-02 09:30"] * 4 + ["2025-07-02 00:00"] * 2 + [None]


def test_missing_key_differs_from_null(spark):
    obj = nv.as_object(nv.parsed(F.col("v")))
    price = nv.first_present(obj, ["salePrice", "originalPrice"], F.lit("N/A"))
    rows = ['{"salePrice":null,"originalPrice":5}', '{"originalPrice":5}', "{}", '{"salePrice":7}', '{"originalPrice":null}']
    assert values(spark, price, *rows) == [None, "5", "N/A", "7", None]


def test_json_nodes_walks_any_depth_and_survives_broken_text(spark):
    deep = '{"a":' * 30 + '{"type":"T","id":9}' + "}" * 30
    ids = F.transform(F.filter(nv.json_nodes(F.col("v")), lambda n: n["type"] == "T"), lambda n: n["id"])
    assert values(spark, ids, deep, "{broken", None) == [["9"], None, None]


def test_every_node_is_found_without_python(spark):
    texts = ['{"b":[{"q":1.5},{"r":[true,null]}],"a":"x"}', "{broken", None, "[]", "7", '{"a":' * 300 + "1" + "}" * 300, '{"a":' * 1200 + "1" + "}" * 1200]
    nodes = nv.every_node(spark.createDataFrame([(t,) for t in texts], "v string"), "v")
    assert "Python" not in nodes._jdf.queryExecution().optimizedPlan().toString()
    got = sorted(map(tuple, nodes.filter(F.length("path") < 20).collect()), key=str)
    deep = [("$" + ".a" * k, "object", 1) for k in range(10)]
    assert got == sorted([
        ("$", "object", 2), ("$.b", "array", 2), ("$.b[]", "object", 1), ("$.b[]", "object", 1), ("$.b[].q", "number", None), ("$.b[].r", "array", 2),
        ("$.b[].r[]", "boolean", None), ("$.b[].r[]", "null", None), ("$.a", "string", None), ("$", "array", 0), ("$", "number", None), *deep], key=str)
    assert nodes.count() == 9 + 2 + 301


def test_ids_of_deep_payloads(spark):
    ids = nv.typed_ids(F.col("v"), "T")
    deep = '{"z":' * 3000 + '{"type":"T","id":9}' + "}" * 3000
    assert values(spark, ids, deep, '[{"type":"T","id":"b"},{"type":"U","id":1},{"type":"T","id":"a"},{"type":"T","id":"b"},{"type":"T"}]', "{broken", None) == [["9"], ["b", "a"], None, None]


def test_a_level_of_nodes_hands_on_each_value_once(spark):
    """Values end where nothing is below them; a list or object is not handed on opened as well."""
    texts = ['{"a":{"b":[1,{"c":"x"},[],{}]},"d":null}', "[]", "7", "{"]
    nodes = nv.every_node(spark.createDataFrame([(t,) for t in texts], "t string"), "t")
    assert Counter((r["path"], r["kind"], r["items"]) for r in nodes.collect()) == Counter([
        ("$", "object", 2), ("$.a", "object", 1), ("$.a.b", "array", 4), ("$.a.b[]", "number", None), ("$.a.b[]", "object", 1),
        ("$.a.b[].c", "string", None), ("$.a.b[]", "array", 0), ("$.a.b[]", "object", 0), ("$.d", "null", None), ("$", "array", 0), ("$", "number", None)])
    handed = re.findall(r"UnionLoopRef \d+, \[([^]]*)\]", nodes._jdf.queryExecution().optimizedPlan().toString())
    assert handed and all([c.split("#")[0].strip() for c in h.split(",")] == ["path", "kind", "items", "v"] for h in handed)


def test_ids_of_one_type_are_found_without_keeping_all_nodes():
    import json
    import tracemalloc

    text = json.dumps({"rows": [{"n": [1, 2, 3]}] * 20_000 + [{"type": "T", "id": 7}, {"type": "T", "id": 7}, {"type": "T", "id": None}]})
    tracemalloc.start()
    try:
        json.loads(text)
        tree = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        assert nv._ids_of(text, "T") == ["7"]
        assert tracemalloc.get_traced_memory()[1] < 1.5 * tree
        assert nv._ids_of("[1", "T") is None and nv._ids_of(None, "T") is None
    finally:
        tracemalloc.stop()
