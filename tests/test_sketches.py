"""Sketches that are merged say what sketches of all rows at once say, within their bounds."""

from pyspark.sql import functions as F

from shelfgrain.operators import sketches


def test_merged_days_are_within_the_bounds(spark):
    rows = spark.range(40_000).select((F.col("id") % 30).alias("day"), (F.col("id") * 7919 % 40_000).alias("price"), (F.col("id") % 700).alias("brand"))
    days = sketches.daily(rows, ["day"], F.col("price"), F.col("brand"))
    got = sketches.figures(sketches.merged(days, []), [0.1, 0.5, 0.9], [10_000.0, 30_000.0]).first()
    assert (got["n_rows"], got["lowest"], got["highest"], got["mean_price"]) == (40_000, 0.0, 39_999.0, 19_999.5)
    for q, estimate in zip((0.1, 0.5, 0.9), got["quantiles"]):
        assert abs(estimate / 40_000 - q) <= sketches.RANK_ERROR
    for edge, share in zip((0.25, 0.75), got["below"]):
        assert abs(share - edge) <= sketches.RANK_ERROR
    assert abs(got["n_brands"] - 700) <= sketches.COUNT_ERROR * 700


def test_merging_in_steps_and_missing_values(spark):
    rows = spark.createDataFrame([(1, 5.0, "a"), (1, None, None), (2, 7.0, "a"), (3, None, "b")], "day int, price double, brand string")
    days = sketches.daily(rows, ["day"], F.col("price"), F.col("brand"))
    by_day = {r["day"]: r for r in sketches.figures(days).collect()}
    assert (by_day[3]["n_rows"], by_day[3]["n_prices"], by_day[3]["quantiles"], by_day[3]["mean_price"]) == (1, 0, None, None)
    pairs = sketches.merged(days.withColumn("half", F.col("day") % 2), ["half"])
    total = sketches.figures(sketches.merged(pairs, []), [0.5]).first()
    assert (total["n_rows"], total["n_prices"], total["mean_price"], total["n_brands"]) == (4, 2, 6.0, 2)
    assert total["quantiles"][0] in (5.0, 7.0)
    assert sketches.daily(rows.limit(0), ["day"], F.col("price"), F.col("brand")).collect() == []
