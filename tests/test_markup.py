"""HTML reading and selection on hand-made pages."""

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfgrain.functions import markup as mk
from shelfgrain.operators import markup as om


def read(html):
    nodes = mk._Nodes()
    nodes.add_page(html)
    return nodes


def outline(html):
    """Tags with their parents' tags, texts in place."""
    n = read(html)
    return [(n.tag[i] if n.tag[i][0] != "#" else n.text[i], n.tag[n.up[i]] if n.up[i] >= 0 else "") for i in range(len(n.pos))]


def test_unclosed_list_items_and_void_tags():
    assert outline("<ul><li>a<br>b<li>c</ul>d") == [
        ("ul", ""), ("li", "ul"), ("a", "li"), ("br", "li"), ("b", "li"), ("li", "ul"), ("c", "li"), ("d", "")]


def test_nested_lists_keep_their_items():
    assert outline("<ul><li>a<ul><li>b</li></ul></li></ul>")[-2:] == [("li", "ul"), ("b", "li")]


def test_raw_text_comments_references_and_loose_signs():
    assert outline('<p title="a>b">x &lt;y&gt; &copy;</p><!-- <b> --><script>if(a<b){"</p>"}</script>1 < 2') == [
        ("p", ""), ("x <y> ©", "p"), ("script", ""), ('if(a<b){"</p>"}', "script"), ("1 < 2", "")]


def test_attributes():
    n = read('<a HREF="/x?a=1&amp;b=2" class=\'p  q\' checked data-v=7>t')
    assert dict(n.attrs[0]) == {"href": "/x?a=1&b=2", "class": "p  q", "checked": "", "data-v": "7"}
    assert n.cls[0] == ["p", "q"]


def test_stray_end_tags_do_no_harm():
    assert outline("</div><p>a</b></p></p>b") == [("p", ""), ("a", "p"), ("b", "")]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet='<>/ab="\'!-&;#p lidvscript', max_size=60))
def test_any_text_gives_a_proper_tree(html):
    n = read(html)
    for i, (pos, stop, up) in enumerate(zip(n.pos, n.stop, n.up)):
        assert pos == i and pos < stop <= len(n.pos) and up < pos
        if up >= 0:
            assert n.stop[up] >= stop, "a node ends inside its parent"


def page(spark, html, **extra):
    df = spark.createDataFrame([(html,)], "html string")
    return df.withColumns({k: F.lit(v) for k, v in extra.items()})


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def test_selectors_fall_back_in_order(spark):
    rows = om.extract_products(page(spark, '<li class="item"><p class="tx_name">a</p></li><article><p class="tx_name">b</p></article>'))
    assert [r["name"] for r in rows.collect()] == ["a"]
    only_articles = om.extract_products(page(spark, '<article>no paragraph</article><article><p class="tx_name">b</p></article>'))
    assert [r["name"] for r in only_articles.collect()] == ["b"]


def test_product_price_prefers_current(spark):
    html = '<div class="prd_info"><span class="tx_org"><span class="tx_num">9,000</span></span>{}</div>'
    assert one(om.extract_products(page(spark, html.format(""))))["price"] == "9,000"
    current = '<span class="tx_cur"><span class="tx_num">8,000</span></span>'
    assert one(om.extract_products(page(spark, html.format(current))))["price"] == "8,000"
    assert one(om.extract_products(page(spark, html.format('<span class="tx_cur">sold out</span>'))))["price"] == ""


def test_reviews_need_star_or_text(spark):
    html = (
        '<p class="prd_name">item</p><a class="goods_reputation">리뷰<span>(1,234)</span></a><ul id="gdasList">'
        '<li><div class="score_area"><span class="point">5점</span></div>'
        '<li><div class="txt_inner">tiny</div>'
        '<li><div class="txt_inner">long enough</div><button class="btn_recom" id="gdas_9"></button><ul><li>inner</li></ul></ul>'
    )
    rows = om.extract_reviews(page(spark, html, page=2)).orderBy("position").collect()
    assert [(r["review_id"], r["star"], r["review"]) for r in rows] == [("item_2_1", "5점", None), ("9", None, "long enough")]
    assert {r["total_review_count"] for r in rows} == {"1,234"}


def test_span_review_date_and_content_fallback(spark):
    item = (
        '<li class="BnwL_cs1av" data-shp-contents-id="r1"><strong class="_2L3vDiadT9">u</strong><span class="_2L3vDiadT9">x</span>'
        '<span class="_2L3vDiadT9">24.03.05.</span><span class="_2L3vDiadT9">v1.0</span>{}</li>'
    )
    direct = one(om.extract_review_spans(page(spark, item.format('<div class="_1kMfD5ErZ6"><b><span class="_2L3vDiadT9">deep</span></b><span class="_2L3vDiadT9">text</span></div>'))))
    assert (direct["created_at"], direct["content"], direct["username"]) == ("24.03.05.", "text", "u")
    assert one(om.extract_review_spans(page(spark, item.format('<div class="_3z6gI4oI6l"> other </div>'))))["content"] == "other"


def test_menu_needs_name_and_url(spark):
    li = '<li class="displayCategoryImageMenu_list__eEKrH">{}<span class="displayCategoryImageMenu_title__Wizki">{}</span></li>'
    html = li.format('<button data-shp-contents-id="/a?sort=X"></button>', "a/b") + li.format("", "none") + li.format('<button data-shp-contents-id="/c"></button>', "")
    row = one(om.extract_menu(page(spark, html), base="https://s.example", sort="NEW"))
    assert (row["name"], row["url"]) == ("a_b", "https://s.example/a?sort=NEW")


def test_grid_defaults(spark):
    cell = '<div><div><a href="/products/77?x"></a></div><div><div><a></a><a><p>n</p></a><div><span>900원</span></div></div><div></div></div></div>'
    html = f"<main><article><div>menu</div><div>{cell}</div></article></main>"
    row = one(om.extract_grid(page(spark, html)))
    assert (row["product_id"], row["brand"], row["product_name"]) == ("77", "", "n")
    assert (row["discount"], row["price"], row["interest"], row["purchase"]) == ("900원", "900원", "0", "0")


@pytest.mark.parametrize("html, via, n", [
    ('<div class="review_wrap"><div class="one Comment">a</div><p class="item">no</p></div>', "container", 1),
    ("<ol><li>short<li>" + "x" * 31 + "</ol>", "long_item", 1),
    ('<ul><li class="x">' + "y" * 40 + "</li></ul>", "long_item", 1),
])
def test_candidate_blocks(spark, html, via, n):
    rows = om.candidate_blocks(page(spark, html)).collect()
    assert len(rows) == n and {r["via"] for r in rows} == {via}


def test_page_without_anything_gives_no_rows(spark):
    empty = spark.createDataFrame([(None,), ("",)], "html string")
    assert om.extract_products(empty).count() == 0
    assert om.page_totals(empty).select("total_items").distinct().collect()[0][0] == 24


def test_quotes_out_of_place():
    assert outline('<div class="a"">x</div><p>y</p>') == [("div", ""), ("x", "div"), ("p", ""), ("y", "p")]
    n = read("""<a title="5" x" class='c'>t</a>""")
    assert n.text[1] == "t" and dict(n.attrs[0])["class"] == "c"
    n = read("<b data-t=it's class=d>t</b>")
    assert dict(n.attrs[0]) == {"data-t": "it's", "class": "d"}
    assert outline('<i>a</i><b class="open>c</b>')[:2] == [("i", ""), ("a", "i")]
    assert outline('<b class="open>c</b>') == [("b", ""), ("c", "b")]


def test_many_quoted_attributes_without_an_end_are_read_in_time():
    assert read('<b a="1" ' * 20_000).text[0].startswith("<b")


def test_nodes_are_held_in_small_parts(monkeypatch):
    """A batch of pages is not a batch of Python objects; its nodes are the same however they are cut."""
    html = ["<p class='a b'>x<br>y</p>" * 50, None, "", "z", "<ul><li>1<li>2</ul>"] * 20
    held, to_arrow = [], mk._Nodes.to_arrow
    monkeypatch.setattr(mk._Nodes, "to_arrow", lambda nodes: held.append(len(nodes.pos)) or to_arrow(nodes))
    whole = mk.nodes_of_pages(pa.array(html), most=10**9)
    assert len(held) == 1
    cut = mk.nodes_of_pages(pa.array(html), most=300)
    assert cut.equals(whole) and max(held[1:]) < 300 + 50 * 4
    assert mk.nodes_of_pages(pa.array([], pa.string())).to_pylist() == []


def test_rows_go_to_python_by_bytes(spark):
    @F.arrow_udf("long")
    def batch_bytes(texts: pa.Array) -> pa.Array:
        return pa.array([texts.nbytes] * len(texts), pa.int64())

    rows = spark.range(0, 2000, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("text"))
    assert rows.select(batch_bytes("text").alias("n")).agg(F.max("n")).first()[0] < 5 << 20
