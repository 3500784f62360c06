"""Plans: what reaches the scan, what is limited before the shuffle, what stays native."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from shelfgrain.operators import ordering, paging, sampling, shaping
from shelfgrain.plans import collecting
from shelfgrain.plans.scoring import ScoreConfig, score_frame
from shelfgrain.sources import tables
from shelfgrain.suite.registry import ORACLES, QUERIES
from shelfgrain.suite.scores import lexicon

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_review_scan_pushes_filters_and_prunes_columns(spark, tmp_path):
    spark.createDataFrame([("1", "x", 5, "more")], "review_uid string, content string, star int, other string").write.parquet(str(tmp_path / "t"))
    text = plan(tables.read_reviews(spark, str(tmp_path / "t")).select("review_uid"))
    for pushed in ("IsNotNull(content)", "Not(EqualTo(content,))", "GreaterThanOrEqual(star,1)"):
        assert pushed in text
    assert "other" not in text


def test_limits_apply_before_the_shuffle_and_per_slice(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    wide = plan(ordering.top_per_key(df, ["k"], [F.col("id")], 50))
    assert wide.count("WindowGroupLimit") == 4 and wide.count("Partial") >= 2
    narrow = plan(ordering.top_per_key(df, ["k"], [F.col("id")], 1))
    assert narrow.count("WindowGroupLimit") == 2


def test_balanced_sample_limits_rows_before_the_shuffle(spark):
    df = spark.range(100000).select(F.col("id").cast("string").alias("review_uid"), F.element_at(F.array(F.lit("positive"), F.lit("neutral"), F.lit("negative")), (F.col("id") % 3 + 1).cast("int")).alias("true_label"))
    assert "WindowGroupLimit" in plan(sampling.sample(df, 3000, "balanced"))


def test_top_rows_sorts_no_partition(spark):
    text = plan(ordering.top_rows(spark.range(100000), [F.col("id").desc()], 10))
    assert "TakeOrderedAndProject" in text and "Sort [" not in text


def labelled_ids(spark, n):
    names = F.array(F.lit("positive"), F.lit("neutral"), F.lit("negative"))
    return spark.range(n).select(F.col("id").cast("string").alias("review_uid"), F.element_at(names, (F.col("id") % 3 + 1).cast("int")).alias("true_label"))


def test_random_sample_reads_its_input_once(spark, tmp_path):
    labelled_ids(spark, 1000).write.parquet(str(tmp_path / "t"))
    for limit in (300, 301):
        text = optimized(sampling.sample(spark.read.parquet(str(tmp_path / "t")), limit, "random"))
        assert text.count("Relation") == 1 and "Join" not in text


@pytest.mark.parametrize("mode", ["random", "balanced"])
def test_large_samples_rank_the_rows_at_the_cut_only(spark, mode):
    text = plan(sampling.sample(labelled_ids(spark, 100), 3_000_000, mode))
    for line in text.splitlines():
        if "row_number()" in line:
            assert "windowspecdefinition(true_label" in line and "_bin" in line


def test_numbering_windows_stay_within_a_range(spark):
    text = plan(ordering.numbered(spark.range(10).withColumn("k", F.lit(1)), ["k"], "id"))
    for line in text.splitlines():
        if "row_number()" in line:
            assert "windowspecdefinition(_cut" in line


@pytest.mark.parametrize("name", ["original_price", "prob_label", "rating_from_width", "label_text_numbers", "count_in_parens", "score_lexicon",
                                  "ranking_items", "card_items", "conform_reviews", "conform_products", "star_label", "url_fields"])
def test_native_queries_use_no_python(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    assert "Python" not in text and "Pandas" not in text


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"score_ml"}))
def test_no_query_multiplies_its_inputs(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["review_scan", "original_price", "html_links", "score_pandas_udf", "score_lexicon", "prob_label", "page_count"])
def test_row_wise_queries_do_not_shuffle(spark, name):
    assert "Exchange" not in plan(entry.queries()[name](spark, FOLDER))


def test_scoring_reads_its_input_once(spark, tmp_path):
    spark.createDataFrame([("1", "x", 5)], "review_uid string, content string, star int").write.parquet(str(tmp_path / "t"))
    frame = score_frame(tables.read_table(spark, str(tmp_path / "t")), ScoreConfig(test_limit=0, sample_mode="none"), lexicon)
    assert optimized(frame).count("Relation") == 1 and "Exchange" not in plan(frame)
    spread = score_frame(tables.read_table(spark, str(tmp_path / "t")), ScoreConfig(test_limit=0, npartitions=4), lexicon)
    assert "Exchange RoundRobinPartitioning(4)" in plan(spread)


def test_hot_products_are_on_a_side_that_can_be_split(spark):
    products = spark.createDataFrame([("1",)], "product_id string").hint("merge")
    reviews = spark.createDataFrame([("1", "a")], "product_id string, uid string")
    text = optimized(sampling.reviews_of(products, reviews))
    assert "Join Inner" in text and "Join LeftAnti" in text and "LeftOuter" not in text


def test_a_hot_product_is_split_at_run_time(spark):
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "20",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, value in small.items():
            spark.conf.set(k, value)
        products = spark.range(500).select(F.col("id").cast("string").alias("product_id"))
        reviews = spark.range(0, 40_000, numPartitions=8).select(
            F.when(F.col("id") % 2 == 0, "7").otherwise((F.col("id") % 500).cast("string")).alias("product_id"), F.md5(F.col("id").cast("string")).alias("uid")
        )
        joined = sampling.reviews_of(products, reviews, keep_without=False)
        assert len(joined.collect()) == 40_000
        assert "skew=true" in plan(joined)
    finally:
        for k, value in before.items():
            spark.conf.unset(k) if value is None else spark.conf.set(k, value)


def test_stop_pages_do_not_move_payloads(spark):
    pages = spark.range(0, 100, numPartitions=4).select(
        (F.col("id") % 5).cast("string").alias("category_code"), F.col("id").alias("page"), (F.col("id") % 9).alias("n_items"), F.lit("{}").alias("payload")
    )
    text = optimized(paging.take_until_empty(pages, "category_code", "page", jobs=5))
    assert "strategy=broadcast" in text
    moved = [line for line in plan(paging.take_until_empty(pages, "category_code", "page", jobs=5)).splitlines() if "Exchange hashpartitioning" in line]
    assert len(moved) <= 1  # of the stop pages alone


def test_lookup_is_not_forced_to_broadcast(spark):
    facts, dim = spark.range(5).withColumnRenamed("id", "code"), spark.range(5).select(F.col("id").alias("c"), F.lit("n").alias("name"))
    assert "strategy=broadcast" not in optimized(shaping.lookup(facts, dim, "code", "c", "name", "out", F.lit("?")))


def test_every_sql_has_its_query_and_only_the_models_have_none():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) - set(ORACLES) == {"score_ml", "score_encoder"}


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["review_uid", "star", "true_label", "prob", "pred_label", "is_correct"] and df.count() > 0


def test_listing_pages_are_not_moved(spark, tmp_path):
    """With a bound on the categories only the extracted products go through an exchange."""
    spark.range(40).select((F.col("id") % 4).cast("string").alias("category"), F.col("id").cast("int").alias("page"), (F.col("id") % 9).alias("n_items"), F.lit("<ul></ul>").alias("html")).write.parquet(str(tmp_path / "pages"))
    pages = spark.read.parquet(str(tmp_path / "pages"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        bound, free = (plan(collecting.listing_products(pages, "2025-07-02", "", n)) for n in (4, None))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the stop rows are sent to the pages; without a bound both sides are put in order by category
    assert "SortMergeJoin" not in bound.split("Window")[-1] and "BroadcastHashJoin" in bound
    assert "SortMergeJoin" in free


def test_spread_rows_make_more_tasks_not_larger_ones(spark, tmp_path):
    """`npartitions` is where spreading begins: a table of many times the advisory size is not left to three tasks."""
    spark.range(0, 20_000, 1, 8).select(F.col("id").cast("string").alias("review_uid"), F.sha2(F.col("id").cast("string"), 512).alias("content"), F.lit(5).alias("star")).write.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        frame = score_frame(tables.read_table(spark, str(tmp_path / "t")), ScoreConfig(test_limit=0, sample_mode="none", npartitions=3), lexicon)
        sizes = [r["n"] for r in frame.groupBy(F.spark_partition_id()).agg(F.count("content").alias("n"), F.max("content")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert sum(sizes) == 20_000 and len(sizes) > 12 and max(sizes) < 4_000
