"""Statistics of a day that can be added up: small sketches kept by run date, merged over any days.

Exact quantiles and distinct counts need all rows of all days again. A row of sketches
holds what one day adds to them: a KLL sketch of the prices and an HLL sketch of the
brands, next to counts, sums and bounds that are exact. Months and years are merges of a
few rows, whatever the tables hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KLL_K = 400
HLL_LG_K = 12
# with the settings above: error of a quantile's rank, and relative error of a distinct count, at three deviations or more
RANK_ERROR, COUNT_ERROR = 0.0165, 0.05


def daily(df: DataFrame, by: list[str], price: Column, brand: Column) -> DataFrame:
    """One row for each combination of `by`: n_rows, n_prices, total, lowest, highest, prices and brands (sketches).

    Missing prices and brands count in n_rows alone. A day without a price has an empty sketch.
    """
    amount = price.cast("double")
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(amount).alias("n_prices"),
        F.sum(amount).alias("total"),
        F.min(amount).alias("lowest"),
        F.max(amount).alias("highest"),
        F.kll_sketch_agg_double(amount, KLL_K).alias("prices"),
        F.hll_sketch_agg(brand.cast("string"), HLL_LG_K).alias("brands"),
    )


def merged(days: DataFrame, by: list[str]) -> DataFrame:
    """Rows of `daily`, or of this function, put together by other columns; by none, all in one row."""
    return days.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_prices").alias("n_prices"),
        F.sum("total").alias("total"),
        F.min("lowest").alias("lowest"),
        F.max("highest").alias("highest"),
        F.kll_merge_agg_double("prices").alias("prices"),
        F.hll_union_agg("brands").alias("brands"),
    )


def figures(rows: DataFrame, quantiles: list[float] | None = None, edges: list[float] | None = None) -> DataFrame:
    """Estimates from sketches: mean_price, n_brands, the price at each of `quantiles`, and the share of prices below each of `edges`.

    Quantiles and shares are null where there is no price.
    """
    known = F.col("n_prices") > 0
    at = F.array(*[F.lit(float(q)) for q in quantiles or [0.25, 0.5, 0.75]])
    out = {
        "mean_price": F.try_divide("total", "n_prices"),
        "n_brands": F.hll_sketch_estimate("brands"),
        "quantiles": F.when(known, F.kll_sketch_get_quantile_double("prices", at)),
    }
    if edges:
        out["below"] = F.when(known, F.kll_sketch_get_rank_double("prices", F.array(*[F.lit(float(e)) for e in edges])))
    return rows.withColumns(out).drop("prices", "brands", "total")
