"""Operators on hand-made tables, against plain Python where there is a rule to restate."""

import math
import os
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfgrain.functions import text
from shelfgrain.operators import ordering, paging, payloads, sampling, scoring, shaping, summaries

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def rows(df, *cols):
    return sorted((tuple(r[c] for c in (cols or df.columns)) for r in df.collect()), key=repr)


# ------------------------------------------------------------------------------ order


@FEW
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(-50, 50)), min_size=1, max_size=40, unique_by=lambda t: t[1]))
def test_numbered_matches_sorting_for_any_span(spark, data):
    df = spark.createDataFrame(data, "k string, id long")
    got = {(r["k"], r["id"]): r["position"] for r in ordering.numbered(df, ["k"], "id", span=7, id_limit=7**4).collect()}
    for key in {k for k, _ in data}:
        ids = sorted(i for k, i in data if k == key)
        assert [got[(key, i)] for i in ids] == list(range(1, len(ids) + 1))
    assert len(got) == len(data)


@pytest.mark.parametrize("n", [1, 3, 20])
def test_top_per_key_with_one_hot_key(spark, n):
    random.seed(n)
    data = [("hot" if i % 3 else f"k{i % 7}", random.random(), i) for i in range(900)]
    df = spark.createDataFrame(data, "k string, x double, id long").repartition(8)
    got = rows(ordering.top_per_key(df, ["k"], [F.col("x").desc(), F.col("id")], n), "k", "id")
    want = []
    for key in {d[0] for d in data}:
        want += [(key, d[2]) for d in sorted((d for d in data if d[0] == key), key=lambda d: (-d[1], d[2]))[:n]]
    assert got == sorted(want, key=repr)


def test_top_rows(spark):
    df = spark.range(5000).repartition(8).withColumn("x", F.col("id") * 7919 % 5003)
    got = [r["x"] for r in ordering.top_rows(df, [F.col("x")], 100).collect()]
    assert got == sorted(i * 7919 % 5003 for i in range(5000))[:100]


# ----------------------------------------------------------------------------- paging


def log(spark, data):
    return spark.createDataFrame([(j, p + 1, n) for j, ns in data.items() for p, n in enumerate(ns)], "job string, page long, n_items long")


PAGES = {
    "never": [5, 5, 5],
    "first": [0, 5, 5],
    "skip": [5, 0, 5, 0, 0, 5],
    "streak": [5, 0, 0, 0, 5, 5],
    "late": [5, 0, 0, 5, 0, 0, 0, 0, 5],
    "all": [0, 0, 0, 0],
}


def python_stop(ns, k):
    kept, streak = [], 0
    for page, n in enumerate(ns, 1):
        streak = 0 if n else streak + 1
        if streak >= k:
            break
        if n:
            kept.append(page)
    return kept


def test_take_until_empty(spark):
    got = rows(paging.take_until_empty(log(spark, PAGES), "job", "page"), "job", "page")
    assert got == sorted([(j, p) for j, ns in PAGES.items() for p in python_stop(ns, 1)], key=repr)


@pytest.mark.parametrize("k", [1, 2, 3])
def test_take_until_streak(spark, k):
    want = sorted([(j, p) for j, ns in PAGES.items() for p in python_stop(ns, k)], key=repr)
    assert rows(paging.take_until_streak(log(spark, PAGES), "job", "page", k=k, dense=True), "job", "page") == want


@FEW
@given(st.lists(st.integers(0, 1), min_size=1, max_size=60))
def test_streak_on_sparse_attempt_numbers(spark, ns):
    df = log(spark, {"j": ns}).withColumn("attempt", F.col("page") * 1000 + F.col("page") % 13)
    streak = rows(paging.take_until_streak(df, "job", "attempt"), "page")
    assert streak == sorted([(p,) for p in python_stop(ns, 3)], key=repr)
    assert set(rows(paging.take_until_empty(df, "job", "page"), "page")) <= set(streak)


def test_estimate_total_is_at_least_one_page(spark):
    probes = spark.createDataFrame([("a", 1, 0), ("a", 10, 20), ("b", 1, 20), ("b", 10, 20), ("b", 50, 0), ("b", 100, 20), ("c", 1000, 5)], "k string, page long, n_items long")
    assert rows(paging.estimate_total(probes, "k", "page")) == [("a", 1, 20), ("b", 10, 200), ("c", 1000, 20000)]


def test_sort_option_summary(spark):
    df = spark.createDataFrame([("POPULARITY", 1, 20, True), ("POPULARITY", 50, 20, False), ("RECENT", 1, 7, False)], "sort string, page long, n_items long, has_more boolean")
    got = {r["sort"]: (r["items"], r["has_more"], r["max_page"], r["estimated_total"]) for r in paging.sort_option_summary(df, "sort", "page").collect()}
    assert got == {"POPULARITY": (40, True, 50, 1000), "RECENT": (7, False, 1, 7), "ALL": (47, True, 50, 1000)}


def test_page_slices(spark):
    df = spark.range(95).withColumn("k", F.col("id") % 2)
    assert [r["id"] for r in paging.page_slice(df, [F.col("id")], 5, 20).collect()] == list(range(80, 95))
    assert rows(paging.page_slice_per_key(df, "k", "id", 2, 3), "k", "id") == sorted([(0, 6), (0, 8), (0, 10), (1, 7), (1, 9), (1, 11)], key=repr)


def test_every_sort_option_orders(spark):
    data = [(str(i), i * 7 % 10, float(i * 3 % 10), i * 9 % 10, f"2025-01-{i + 1:02d}", i * 2 % 10, float(i % 5), i % 4) for i in range(10)]
    df = spark.createDataFrame(data, "product_id string, rank int, price double, review_count int, created_at string, discount_rate int, rating double, helpful int")
    column = {"POPULARITY": "rank", "PRICE_LOW": "price", "PRICE_HIGH": "-price", "REVIEW": "-review_count", "RECENT": "-created_at", "SALE": "-discount_rate",
              "RATING": "-rating", "up_cnt_desc": "-helpful", "최신순": "-created_at", "랭킹순": "rank", "평점 높은순": "-rating", "평점 낮은순": "rating"}
    assert set(column) == set(paging.sort_orders("product_id"))
    for option, name in column.items():
        got = [r[name.lstrip("-")] for r in paging.order_by_option(df, option, "product_id").collect()]
        assert got == sorted(got, reverse=name.startswith("-")), option
    with pytest.raises(ValueError):
        paging.order_by_option(df, "NONE", "product_id")


def test_frontier_and_flags(spark):
    jobs = spark.createDataFrame([("a", 2), ("b", 0)], "job string, n int")
    assert rows(paging.frontier(jobs, F.col("n"), ["x", "y"]), "job", "page", "sort") == [("a", 1, "x"), ("a", 1, "y"), ("a", 2, "x"), ("a", 2, "y")]
    flags = spark.createDataFrame([(1, True, None), (2, False, True)], "id int, has_photo boolean, mine boolean")
    assert rows(paging.filter_flags(flags, has_photo=True, mine=None), "id") == [(1,)]
    assert paging.filter_flags(flags).count() == 2


def test_keywords_and_limit(spark):
    df = spark.createDataFrame([(1, "http://A/API/x"), (2, "http://b/"), (3, "http://c/product"), (4, None)], "id int, url string")
    assert rows(paging.filter_any_keyword(df, "url", ["api", "Product"]), "id") == [(1,), (3,)]
    assert rows(paging.filter_any_keyword(df, "url", ["api", "product"], 1, [F.col("id").desc()]), "id") == [(3,)]


# --------------------------------------------------------------------------- sampling


def labelled(spark, positive, negative, neutral):
    names = ["positive"] * positive + ["negative"] * negative + ["neutral"] * neutral
    return spark.createDataFrame([(str(i), n) for i, n in enumerate(names)], "review_uid string, true_label string").repartition(5)


def counts(df):
    return {r["true_label"]: r["n_rows"] for r in summaries.sample_counts(df).collect()}


@FEW
@given(limit=st.integers(1, 70), sizes=st.tuples(*[st.integers(0, 30)] * 3))
def test_sample_quotas(spark, limit, sizes):
    if not sum(sizes):
        return
    df = labelled(spark, *sizes)
    available = dict(zip(("positive", "negative", "neutral"), sizes))
    quota = sampling.quotas(limit)
    got = counts(sampling.sample(df, limit, "balanced"))
    assert got == {k: min(v, quota[k]) for k, v in available.items() if min(v, quota[k])}
    drawn = sampling.sample(df, limit, "random")
    ids = [r["review_uid"] for r in drawn.collect()]
    half = limit // 2
    ends = min(half, sizes[0]) + min(half, sizes[1])
    assert len(ids) == len(set(ids)) == ends + (limit % 2 if sum(sizes) > ends else 0)


def test_limit_1000_gives_1001_balanced_rows():
    assert sum(sampling.quotas(1000).values()) == 1001 + 0 and sampling.quotas(1000)["negative"] == 333


def test_sampling_repeats_and_follows_the_seed(spark):
    df = labelled(spark, 200, 200, 200)
    once, again = (rows(sampling.sample(d, 61, "random", seed=7)) for d in (df, df.repartition(3)))
    assert once == again != rows(sampling.sample(df, 61, "random", seed=8))


def test_sample_modes(spark):
    df = labelled(spark, 5, 5, 5)
    assert sampling.sample(df, 0, "random").count() == sampling.sample(df, 3, "none").count() == 15
    assert rows(sampling.sample(df, 2, "head"), "review_uid") == [("0",), ("1",)]
    with pytest.raises(ValueError):
        sampling.sample(df, 3, "other")
    with pytest.raises(ValueError):
        sampling.sample(df.drop("review_uid"), 3, "random")


def test_rows_without_id_are_not_drawn_twice(spark):
    df = spark.createDataFrame([(None, "positive")] * 3 + [("1", "negative")], "review_uid string, true_label string")
    assert rows(sampling.sample(df, 3, "random")) == [("1", "negative")]


def test_dedup(spark):
    df = spark.createDataFrame([("a", "x", 3), ("a", "y", 1), ("", "z", 0), (None, "z", 5), ("b", None, 2), ("c", None, 4)], "id string, content string, at int")
    first = sampling.dedup_first(df, "id", [F.col("at")])
    assert rows(first) == [("a", "y", 1), ("b", None, 2), ("c", None, 4)]
    assert rows(sampling.dedup_first(first, "id", [F.col("at")])) == rows(first)
    by_text = sampling.dedup_by_text(df, "content", [F.col("at")])
    assert rows(by_text, "content", "at") == [("x", 3), ("y", 1), ("z", 0), (None, 2)]


def test_joins_keep_products_without_reviews(spark):
    products = spark.createDataFrame([("1",), ("2",)], "product_id string")
    reviews = spark.createDataFrame([("1", "a"), ("1", "b"), ("9", "c")], "product_id string, uid string")
    assert rows(sampling.reviews_of(products, reviews)) == [("1", "a"), ("1", "b"), ("2", None)]
    assert rows(sampling.reviews_of(products, reviews, keep_without=False)) == [("1", "a"), ("1", "b")]
    assert rows(sampling.exclude(products, reviews, "product_id")) == [("2",)]
    assert rows(sampling.present(products, reviews, "product_id")) == [("1",)]


# -------------------------------------------------------------------------- summaries


def test_accuracy_counts_predicted_neutral_as_wrong_and_skips_true_neutral(spark):
    df = spark.createDataFrame([("positive", "positive"), ("positive", "neutral"), ("neutral", "neutral")], "true_label string, pred_label string")
    assert summaries.accuracy(scoring.with_correct(df)).collect()[0].asDict() == {"accuracy": 0.5, "n_judged": 2}
    assert summaries.accuracy(scoring.with_correct(df.filter("true_label = 'neutral'"))).collect()[0]["accuracy"] is None


def test_price_ranges_share_counts_unreadable_prices(spark):
    df = spark.createDataFrame([("0",), ("9999",), ("10000",), ("50,000원",), ("N/A",)], "price string")
    from shelfgrain.functions.numbers import price_number

    got = rows(summaries.price_ranges(df, price_number(F.col("price"))))
    assert got == sorted([("1만원 미만", 2, 40.0), ("1-3만원", 1, 20.0), ("3-5만원", 0, 0.0), ("5만원 이상", 1, 20.0)], key=repr)
    none = summaries.price_ranges(df.limit(0), price_number(F.col("price")))
    assert {r["percentage"] for r in none.collect()} == {None}


def test_price_stats_and_empty_input(spark):
    df = spark.createDataFrame([("1,000원",), ("2,001",), ("x",)], "price string")
    assert rows(summaries.price_stats(df)) == [(1500, 2001, 1000, 2)]
    assert rows(summaries.price_stats(df.limit(0))) == [(None, None, None, 0)]


def test_review_lists_come_in_bounded_parts(spark):
    df = spark.range(1000).select(F.lit("hot").alias("p"), "id", F.col("id").cast("string").alias("uid"))
    parts = summaries.reviews_per_product(df, "p", "id", "uid", span=100).collect()
    assert len(parts) == 10 and all(r["n_in_part"] == len(r["reviews"]) == 100 for r in parts)
    assert [u for r in sorted(parts, key=lambda r: r["part"]) for u in r["reviews"]] == [str(i) for i in range(1000)]


# --------------------------------------------------------------------------- payloads


def test_ranking_rank_keeps_gaps_and_bad_envelopes_give_nothing(spark):
    good = ('{"data":{"modules":[{"type":"X","items":[{"type":"PRODUCT_COLUMN","id":0}]},{"type":"MULTICOLUMN","items":['
            '{"type":"PRODUCT_COLUMN","id":1,"info":{"productName":"a","brandName":"b","finalPrice":900,"discountRatio":10}},'
            '{"type":"PRODUCT_COLUMN","id":2},{"type":"AD"},'
            '{"type":"PRODUCT_COLUMN","id":"3","info":{"productName":"c","brandName":""}},'
            '{"type":"PRODUCT_COLUMN","id":4,"info":{"productName":"d","brandName":"e"},"onClick":{"url":"/own"}}]}]}}')
    df = spark.createDataFrame([(3, good), (1, '{"data":{}}'), (1, "[]"), (1, "broken"), (1, None)], "page int, payload string")
    out = payloads.project_ranking_item(payloads.explode_ranking(df, "payload", "page", 40))
    assert rows(out, "rank", "product_id", "price", "original_price", "product_url", "sales") == [
        (81, "1", 900, 1000, "/goods/1", 0), (84, "4", None, None, "/own", 0)]
    texts = payloads.project_ranking_item(payloads.explode_ranking(df, "payload", "page", 40), sentinels=True)
    assert rows(texts, "price", "rating", "likes") == [("", "", ""), ("900", "", "")]


def test_cards_without_product_are_skipped(spark):
    cards = ['{"data":{"product":null}}', '{"data":{"product":{}}}', '{"data":{"product":"x"}}', '{"data":{}}', '{"data":{"product":{"id":5,"name":"A B"}}}']
    df = spark.createDataFrame([('{"data":{"pagedCards":{"data":[' + ",".join(cards) + "]}}}",), ('{"data":null}',)], "payload string")
    out = payloads.project_card(payloads.explode_cards(df, "payload"))
    row = out.collect()
    assert len(row) == 1
    assert row[0].asDict() == {"position": 5, "product_id": "5", "name": "A B", "brand": "N/A", "price": "N/A", "image_url": "N/A", "review_count": 0,
                               "rating": 0.0, "product_url": "N/A", "categories": [], "channel_name": "N/A"}


def test_flatten_mixed_kinds_and_own_keys(spark):
    listed = '{"data":{"list":[{"no":1,"u":{"a.b":1,"c":[1,2]},"mix":{"x":1},"cat":"own"},{"no":2,"u":null,"mix":"plain","l":[{"k":"v"}]}]}}'
    df = spark.createDataFrame([(listed,)], "payload string")
    exploded = payloads.explode_reviews(df, "payload", {"cat": F.lit("stamped")})
    got = {r["no"]: r.asDict() for r in payloads.flatten_one_level(exploded).collect()}
    assert got["1"] == {"position": 1, "cat": "own", "no": "1", "u": None, "u_a_b": "1", "u_c": "[1,2]", "mix": None, "mix_x": "1", "l": None}
    assert got["2"] == {"position": 2, "cat": "stamped", "no": "2", "u": None, "u_a_b": None, "u_c": None, "mix": "plain", "mix_x": None, "l": '[{"k":"v"}]'}
    assert "u.c" in payloads.flatten_one_level(exploded, sep=".").columns


def test_flatten_struct(spark):
    df = spark.createDataFrame([(1, (2, "x"), [1, 2])], "id int, user struct<level:int,nick:string>, tags array<int>")
    assert payloads.flatten_struct(df).collect()[0].asDict() == {"id": 1, "user_level": 2, "user_nick": "x", "tags": "[1,2]"}


def test_find_nodes_keeps_first_seen_order(spark):
    tree = '{"a":[{"type":"T","id":3},{"x":{"type":"T","id":"1"}},{"type":"T","id":3},{"type":"U","id":9},{"type":"T"}]}'
    df = spark.createDataFrame([(tree,)], "payload string")
    assert rows(payloads.find_nodes(df, "payload", "T"), "position", "node_id") == [(1, "3"), (2, "1")]


# ---------------------------------------------------------------------------- shaping


def test_fixed_category_names(spark):
    df = spark.createDataFrame([("104003",), ("9",)], "code string")
    assert rows(df.select(shaping.name_of_code(F.col("code")).alias("n"))) == [("category_9",), ("클렌징/필링",)]
    assert rows(df.select(text.safe_name(shaping.name_of_code(F.col("code"))).alias("n")))[1] == ("클렌징&필링",)


def test_fixed_dimension_and_prefix(spark):
    dim = shaping.category_dim(spark)
    assert dim.count() == 16 and rows(shaping.categories_by_prefix(dim, "헬스"), "category_code") == [("104012",)]


def test_written_stars(spark):
    df = spark.createDataFrame([("5점",), ("5점만점에 3점",), ("4",), ("4.0",), ("N/A",), (None,)], "s string")
    assert [r[0] for r in df.select(shaping._stars(F.col("s"))).collect()] == [5, 3, 4, 4, None, None]


def test_scorer_is_built_once_per_process_and_matches_the_native_form(spark):
    df = spark.createDataFrame([("good good bad",), ("",), (None,), ("BAD",)], "content string").repartition(3)
    udf = scoring.score_text(df, "content", scoring.word_count_scorer(["good"], ["bad"]), "test-words")
    both = udf.withColumn("native", scoring.lexicon_prob(F.col("content"), ["good"], ["bad"]))
    assert all(r["prob"] == r["native"] for r in both.collect())
    made = []
    assert scoring._loaded("k", lambda: made.append(1) or (lambda s: s)) is scoring._loaded("k", lambda: made.append(1))
    assert made == [1]


@pytest.mark.parametrize("mode", ["random", "balanced"])
@pytest.mark.parametrize("limit", [300, 301, 90, 2000])
def test_samples_by_cut_off_are_those_by_rank(spark, monkeypatch, mode, limit):
    names = F.array(F.lit("positive"), F.lit("neutral"), F.lit("negative"))
    rows = spark.range(1200).select(
        F.when(F.col("id") % 40 != 0, F.col("id").cast("string")).alias("review_uid"), F.element_at(names, (F.col("id") % 5 % 3 + 1).cast("int")).alias("true_label")
    )
    ranked = sorted(r["review_uid"] for r in sampling.sample(rows, limit, mode).collect())
    monkeypatch.setattr(sampling, "RANKED_ROWS", 0)
    assert sorted(r["review_uid"] for r in sampling.sample(rows, limit, mode).collect()) == ranked
    assert None not in ranked and len(set(ranked)) == len(ranked)


def test_deep_pages(spark):
    rows = spark.range(0, 1000, numPartitions=5).select((F.col("id") * 7919 % 1000).alias("id"))
    for page, size in ((1, 10), (37, 20), (50, 20), (51, 20), (100, 10)):
        want = list(range((page - 1) * size, min(page * size, 1000)))
        for deep in (0, 10_000):
            assert [r["id"] for r in paging.page_slice(rows, [F.col("id")], page, size, deep).collect()] == want


def test_numbering_takes_any_integer(spark):
    ids = [-(2**63), -1, 0, 5, 2**48 + 3, 2**63 - 1]
    rows = spark.createDataFrame([(i,) for i in ids], "id long")
    got = {r["id"]: r["position"] for r in ordering.numbered(rows.withColumn("k", F.lit(1)), ["k"], "id").collect()}
    assert got == {i: n for n, i in enumerate(ids, 1)}


def test_a_scorer_is_made_once_per_process(spark, tmp_path):
    folder = str(tmp_path)

    def factory(value):
        def make():
            import os
            import uuid

            with open(f"{folder}/{value}-{os.getpid()}-{uuid.uuid4().hex}", "w"):
                pass
            return lambda texts: texts.str.len() * 0.0 + value

        return make

    rows = spark.range(0, 64, numPartitions=16).select(F.col("id").cast("string").alias("text"))
    one = scoring.score_text(rows, "text", factory(1.0), "key", out="one")
    both = scoring.score_text(one, "text", factory(2.0), "key", out="other")
    assert {(r["one"], r["other"]) for r in both.collect()} == {(1.0, 2.0)}
    made = [name.rsplit("-", 1)[0] for name in os.listdir(folder)]
    assert len(made) == len(set(made))


def test_gallop_finds_the_last_page(spark):
    lengths = {"none": 0, "one": 1, "two": 2, "long": 37, "longer": 64}
    pages = spark.createDataFrame([(j, p, 20) for j, n in lengths.items() for p in range(1, n + 1)] + [("none", 1, 0)], "job string, page long, n_items int")
    asked = []

    def answer(frontier):
        asked.append(frontier.count())
        return pages.join(frontier, ["job", "page"])

    got = {r["job"]: (r["last_valid_page"], r["estimated_total"], r["n_requests"]) for r in paging.gallop(pages, "job", answer, size=20).collect()}
    assert {j: x[0] for j, x in got.items()} == {j: max(n, 1) for j, n in lengths.items()}
    assert got["long"][1] == 740 and all(x[2] <= 2 * math.ceil(math.log2(max(lengths[j], 1) + 1)) + 1 for j, x in got.items())
    assert sum(asked) == sum(x[2] for x in got.values())


def test_what_a_scorer_leaves_in_cycles_goes_before_the_next_batch(spark):
    def make():
        import weakref

        class Held:
            def __init__(self):
                self.itself = self

        alive = weakref.WeakSet()

        def scorer(texts):
            alive.add(Held())
            return texts.str.len() * 0 + len(alive)

        return scorer

    df = spark.range(0, 400, 1, 1).select(F.col("id").cast("string").alias("t"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        assert scoring.score_text(df, "t", make, "cycles").agg(F.max("prob")).first()[0] <= 2
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
