"""Text scores, labels from scores, and the surface for user-supplied scorers."""

from __future__ import annotations

import gc
import hashlib
import sys
import types
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import text

Scorer = Callable[[pd.Series], pd.Series]
KEPT = "_shelfgrain_scorers"


def _loaded(key: str, make_scorer: Callable[[], Scorer]) -> Scorer:
    """The scorer of this process; made on first use.

    Functions may travel to the workers by value, and their module's globals with them, so
    what is to last from task to task hangs in sys.modules.
    """
    kept = sys.modules.setdefault(KEPT, types.ModuleType(KEPT)).__dict__
    if key not in kept:
        kept[key] = make_scorer()
    return kept[key]


def score_text(df: DataFrame, col: str, make_scorer: Callable[[], Scorer], key: str, out: str = "prob") -> DataFrame:
    """Probability of a positive text from a vectorised scorer, in Arrow batches.

    `make_scorer` runs on the workers, once per process, `key` and recipe, so a model
    travels as the recipe to load it, and two recipes are two scorers even under one key.
    The batch size is spark.sql.execution.arrow.maxRecordsPerBatch, and its maxBytesPerBatch.
    A scorer may leave its texts in cycles, as pandas' `.str` does; they go before the next batch.
    """
    own_key = f"{key}-{hashlib.sha256(cloudpickle.dumps(make_scorer)).hexdigest()}"

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = _loaded(own_key, make_scorer)
        for batch in batches:
            yield scorer(batch).astype("float64")
            gc.collect(1)  # cycles are few and young, but each holds a whole batch

    return df.withColumn(out, scored(F.col(col)))


def word_count_scorer(positive: list[str], negative: list[str], max_len: int = 0) -> Callable[[], Scorer]:
    """A scorer for `score_text`: smoothed share of positive words among opinion words.

    With `max_len` a scorer sees that many first words, as models with a token limit do.
    """

    def make() -> Scorer:
        wanted, unwanted = "|".join(positive), "|".join(negative)

        def scorer(texts: pd.Series) -> pd.Series:
            lower = texts.fillna("").str.lower()
            if max_len > 0:
                lower = lower.str.split().str[:max_len].str.join(" ")
            p, n = lower.str.count(wanted), lower.str.count(unwanted)
            return (p + 1) / (p + n + 2)

        return scorer

    return make


def lexicon_prob(content: Column, positive: list[str], negative: list[str]) -> Column:
    """The same share as a native expression."""
    lower = F.lower(F.coalesce(content, F.lit("")))
    p = F.regexp_count(lower, F.lit("|".join(positive)))
    n = F.regexp_count(lower, F.lit("|".join(negative)))
    return (p + 1) / (p + n + 2)


def fit_text_model(labelled: DataFrame, content: str, label: str, path: str, features: int = 1 << 14) -> PipelineModel:
    """Hashed word counts and a logistic regression, trained on labelled rows.

    The model is kept at `path` and read back, as a job that only scores would do.
    """
    stages = [
        RegexTokenizer(inputCol=content, outputCol="_words", pattern=r"\s+"),
        HashingTF(inputCol="_words", outputCol="_counts", numFeatures=features),
        LogisticRegression(featuresCol="_counts", labelCol=label, probabilityCol="_probability", maxIter=20, regParam=0.1),
    ]
    Pipeline(stages=stages).fit(labelled).write().save(path)
    return PipelineModel.load(path)


def text_tokens(content: Column) -> Column:
    """Distinct lower-cased tokens between blanks."""
    return F.array_distinct(F.filter(F.split(F.lower(F.coalesce(content, F.lit(""))), r"\s+"), lambda t: t != ""))


def fit_token_odds(labelled: DataFrame, content: str, label: str) -> DataFrame:
    """(token, odds): smoothed log-odds of label 1 for each token of the labelled texts.

    Plain sums that are combined before the shuffle, so tokens that most texts hold are no
    burden; only the two totals of the labels come to the driver.
    """
    rows = labelled.filter(F.col(label).isNotNull()).select(text_tokens(F.col(content)).alias("tokens"), F.col(label).cast("int").alias("label"))
    totals = rows.agg(F.sum("label").alias("yes"), F.count(F.lit(1)).alias("n")).first()
    all_yes, all_no = totals["yes"] or 0, totals["n"] - (totals["yes"] or 0)
    counts = rows.select("label", F.explode("tokens").alias("token")).groupBy("token").agg(F.sum("label").alias("yes"), F.count(F.lit(1)).alias("n"))
    odds = F.ln((F.col("yes") + 1) / F.lit(all_yes + 2)) - F.ln((F.col("n") - F.col("yes") + 1) / F.lit(all_no + 2))
    return counts.select("token", odds.alias("odds"))


def score_by_tokens(df: DataFrame, content: str, odds: DataFrame, out: str = "prob") -> DataFrame:
    """df with the logistic of the mean of its text's known tokens' log-odds, 0.5 without any.

    A score belongs to a text: texts are known by a digest, equal ones are worked out once,
    and every row takes the score of its own text, whatever ids it shares or lacks. A null
    text has no tokens. A token that most texts hold is a hot key of the larger side, which
    adaptive execution splits; the odds hold each token once.
    """
    marked = df.withColumn("_digest", F.md5(F.coalesce(F.col(content), F.lit(""))))
    texts = marked.select("_digest", text_tokens(F.col(content)).alias("_tokens")).dropDuplicates(["_digest"])
    tokens = texts.select("_digest", F.explode("_tokens").alias("token"))
    means = tokens.join(odds, "token").groupBy("_digest").agg((1 / (1 + F.exp(-F.avg("odds")))).alias("_mean"))
    joined = marked.join(means, "_digest", "left")
    return joined.select(*df.columns, F.coalesce("_mean", F.lit(0.5)).alias(out))


def score_with_model(df: DataFrame, model: PipelineModel, out: str = "prob") -> DataFrame:
    scored = model.transform(df).withColumn(out, vector_to_array("_probability")[1])
    return scored.drop("_words", "_counts", "_probability", "rawPrediction", "prediction")


def with_pred_label(df: DataFrame, prob: str = "prob", pos: float = fv.THRESH_POS, neg: float = fv.THRESH_NEG) -> DataFrame:
    return df.withColumn("pred_label", text.label_from_prob(F.col(prob), pos, neg))


def with_correct(df: DataFrame) -> DataFrame:
    return df.withColumn("is_correct", F.col("true_label") == F.col("pred_label"))
