"""Queries on text scores and the scoring job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import scoring, shaping, text_model
from ..plans.collecting import fact_reviews
from ..plans.scoring import ScoreConfig, score_frame, score_reviews
from ..session import scratch_dir
from . import views as v
from .registry import query

POSITIVE = ["the", "que", "und", "추천"]
NEGATIVE = ["tion", "sch", "ou", "별로"]
_SHARE = """
  (len(regexp_extract_all(lower(content), 'the|que|und|추천')) + 1)
  / CAST(len(regexp_extract_all(lower(content), 'the|que|und|추천')) + len(regexp_extract_all(lower(content), 'tion|sch|ou|별로')) + 2 AS DOUBLE)"""
_LABEL = "CASE WHEN {p} >= 0.6 THEN 'positive' WHEN {p} < 0.4 THEN 'negative' ELSE 'neutral' END"
_SCORED_TEXT = f"{v.LABELLED}, v_text AS (SELECT *, {_SHARE} AS prob FROM v_labelled)"


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    return shaping.with_true_label(shaping.valid_for_scoring(v.reviews(spark, folder)))


@query("score_pandas_udf", f"""
WITH {_SCORED_TEXT}
SELECT review_uid, round(prob, 6) AS prob, {_LABEL.format(p='prob')} AS pred_label FROM v_text
""")
def score_pandas_udf(spark: SparkSession, folder: str) -> DataFrame:
    rows = _labelled(spark, folder).select("review_uid", "content")
    scored = scoring.score_text(rows, "content", scoring.word_count_scorer(POSITIVE, NEGATIVE), "word-count")
    return scoring.with_pred_label(scored).select("review_uid", F.round("prob", 6).alias("prob"), "pred_label")


_SWAPPED = """
  (len(regexp_extract_all(lower(content), 'tion|sch|ou|별로')) + 1)
  / CAST(len(regexp_extract_all(lower(content), 'the|que|und|추천')) + len(regexp_extract_all(lower(content), 'tion|sch|ou|별로')) + 2 AS DOUBLE)"""


@query("score_two_models", f"""
WITH {_SCORED_TEXT}
SELECT review_uid, round(prob, 6) AS one, round({_SWAPPED}, 6) AS other FROM v_text
""")
def score_two_models(spark: SparkSession, folder: str) -> DataFrame:
    """Two scorers under one key."""
    rows = _labelled(spark, folder).select("review_uid", "content")
    one = scoring.score_text(rows, "content", scoring.word_count_scorer(POSITIVE, NEGATIVE), "model", out="one")
    both = scoring.score_text(one, "content", scoring.word_count_scorer(NEGATIVE, POSITIVE), "model", out="other")
    return both.select("review_uid", F.round("one", 6).alias("one"), F.round("other", 6).alias("other"))


@query("score_lexicon", f"""
WITH {_SCORED_TEXT}
SELECT review_uid, round(prob, 6) AS prob FROM v_text
""")
def score_lexicon(spark: SparkSession, folder: str) -> DataFrame:
    prob = scoring.lexicon_prob(F.col("content"), POSITIVE, NEGATIVE)
    return _labelled(spark, folder).select("review_uid", F.round(prob, 6).alias("prob"))


@query("prob_label", f"""
WITH p AS (SELECT l_orderkey, l_linenumber, l_quantity / 50 AS prob FROM lineitem)
SELECT l_orderkey, l_linenumber, {_LABEL.format(p='prob')} AS pred_label FROM p
""")
def prob_label(spark: SparkSession, folder: str) -> DataFrame:
    prob = F.col("l_quantity") / 50
    return v.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", text.label_from_prob(prob).alias("pred_label"))


@query("score_ml")
def score_ml(spark: SparkSession, folder: str) -> DataFrame:
    labels = v.table(spark, folder, "labels").select("doc_id", F.col("quality").cast("double").alias("quality"))
    reviews = v.reviews(spark, folder).filter(F.col("content").isNotNull()).select("doc_id", "review_uid", "content")
    model = scoring.fit_text_model(reviews.join(labels, "doc_id"), "content", "quality", scratch_dir(spark, "text-model"))
    return scoring.with_pred_label(scoring.score_with_model(reviews, model)).select("review_uid", F.round("prob", 6).alias("prob"), "pred_label")


@query("score_trained", f"""
WITH {v.REVIEWS},
t AS (SELECT r.doc_id, r.review_uid, list_distinct(list_filter(string_split_regex(lower(coalesce(content, '')), '[ \\t\\n\\x0b\\f\\r]+'), lambda x: x <> '')) AS tokens FROM v_reviews r),
l AS (SELECT t.doc_id, quality, tokens FROM t JOIN labels USING (doc_id) WHERE quality IS NOT NULL),
totals AS (SELECT sum(quality) AS all_yes, count(*) AS all_rows FROM l),
counts AS (SELECT token, sum(quality) AS yes, count(*) AS n FROM (SELECT quality, unnest(tokens) AS token FROM l) GROUP BY token),
odds AS (SELECT token, ln((yes + 1) / (all_yes + 2)) - ln((n - yes + 1) / (all_rows - all_yes + 2)) AS odds FROM counts, totals),
means AS (SELECT review_uid, avg(odds) AS mean FROM (SELECT review_uid, unnest(tokens) AS token FROM t) JOIN odds USING (token) GROUP BY review_uid),
p AS (SELECT review_uid, CASE WHEN mean IS NULL THEN 0.5 ELSE 1 / (1 + exp(-mean)) END AS prob FROM t LEFT JOIN means USING (review_uid))
SELECT review_uid, round(prob, 6) AS prob, {_LABEL.format(p='prob')} AS pred_label FROM p
""")
def score_trained(spark: SparkSession, folder: str) -> DataFrame:
    """A scorer trained here, by aggregation alone."""
    labels = v.table(spark, folder, "labels").select("doc_id", "quality")
    reviews = v.reviews(spark, folder).select("doc_id", "review_uid", "content")
    odds = scoring.fit_token_odds(reviews.join(labels, "doc_id"), "content", "quality")
    scored = scoring.score_by_tokens(reviews, "content", odds)
    return scoring.with_pred_label(scored).select("review_uid", F.round("prob", 6).alias("prob"), "pred_label")




def _words(content: str) -> str:
    return f"regexp_extract_all(lower(coalesce({content}, '')), '{text_model.WORDS}')"


_WHOLE, _START, _INNER, _LIMIT = 8, 4, 3, 64


@query("wordpiece_tokens", f"""
WITH RECURSIVE {v.REVIEWS},
known AS (SELECT DISTINCT unnest({_words('text')}) AS w FROM benchmark),
pieces AS (
  SELECT substr(w, 1, CAST(n AS INTEGER)) AS piece FROM known, range(1, {_START + 1}) AS r(n) WHERE n <= length(w) UNION
  SELECT w FROM known WHERE length(w) <= {_WHOLE} UNION
  SELECT '##' || substr(w, CAST(i AS INTEGER), CAST(n AS INTEGER)) FROM (SELECT w, unnest(range(2, length(w) + 1)) AS i FROM known), range(1, {_INNER + 1}) AS r(n)
  WHERE i + n - 1 <= length(w)),
vocabulary AS (SELECT piece, row_number() OVER (ORDER BY piece) + 3 AS id FROM pieces),
texts AS (SELECT review_uid, {_words('content')} AS words FROM v_reviews),
cut AS (
  SELECT w, CAST(1 AS BIGINT) AS pos, CAST([] AS BIGINT[]) AS ids FROM (SELECT DISTINCT unnest(words) AS w FROM texts) WHERE length(w) <= {text_model.LONGEST_WORD}
  UNION ALL
  SELECT w, pos + max(n), list_append(ids, arg_max(id, n)) FROM (
    SELECT cut.w, cut.pos, cut.ids, n, v.id FROM cut, range(1, {_WHOLE + 1}) AS r(n)
    JOIN vocabulary v ON v.piece = CASE WHEN cut.pos > 1 THEN '##' ELSE '' END || substr(cut.w, CAST(cut.pos AS INTEGER), CAST(n AS INTEGER))
    WHERE cut.pos + n - 1 <= length(cut.w)) GROUP BY w, pos, ids),
done AS (SELECT w, ids FROM cut WHERE pos > length(w)),
placed AS (SELECT review_uid, i, words[i] AS w FROM (SELECT review_uid, words, unnest(range(1, len(words) + 1)) AS i FROM texts)),
sequences AS (
  SELECT review_uid, flatten(list(coalesce(ids, CAST([1] AS BIGINT[])) ORDER BY i)) AS ids FROM placed LEFT JOIN done USING (w) GROUP BY review_uid),
every AS (SELECT review_uid, coalesce(ids, CAST([] AS BIGINT[])) AS ids FROM texts LEFT JOIN sequences USING (review_uid))
SELECT review_uid, CAST(len(ids) AS BIGINT) AS n_pieces, CAST(len(list_filter(ids, lambda x: x = 1)) AS BIGINT) AS n_unknown,
       len(ids) > {_LIMIT - 2} AS truncated, md5(array_to_string(list_concat(list_concat(CAST([2] AS BIGINT[]), ids[1:{_LIMIT - 2}]), CAST([3] AS BIGINT[])), ',')) AS input_md5
FROM every
""")
def wordpiece_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Word pieces of all reviews over a vocabulary of the parts of other words, cut to a limit as a model's input is."""
    vocabulary = text_model.piece_vocabulary(v.table(spark, folder, "benchmark"), "text", _WHOLE, _START, _INNER)
    reviews = v.reviews(spark, folder).select("review_uid", "content")
    cut = text_model.with_pieces(reviews, "content", vocabulary, _LIMIT)
    joined = F.array_join(F.transform("input_ids", lambda x: x.cast("string")), ",")
    return cut.select("review_uid", "n_pieces", "n_unknown", "truncated", F.md5(joined).alias("input_md5"))


def trained_encoder(spark: SparkSession, folder: str) -> str:
    """A small encoder whose head learns from labelled reviews; returns the file of its weights."""
    vocabulary = text_model.piece_vocabulary(v.table(spark, folder, "benchmark"), "text", _WHOLE, _START, _INNER)
    start, trained = (f"{scratch_dir(spark, name)}.npz" for name in ("encoder-start", "encoder"))
    text_model.save_weights(spark, text_model.seeded_weights(vocabulary), start)
    labels = v.table(spark, folder, "labels").select("doc_id", "quality")
    text_model.fit_head(v.reviews(spark, folder).select("doc_id", "content").join(labels, "doc_id"), "content", "quality", start, trained)
    return trained


@query("score_encoder")
def score_encoder(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews through the encoder that `trained_encoder` saves: pieces, truncation, forward pass, softmax."""
    name = text_model.send_weights(spark, trained_encoder(spark, folder))
    reviews = _labelled(spark, folder).select("review_uid", "content", "star", "true_label")
    scored = scoring.with_pred_label(text_model.score_with_encoder(reviews, "content", name))
    return scoring.with_correct(scored).select("review_uid", F.round("prob", 4).alias("prob"), "pred_label", "is_correct")


def lexicon(df: DataFrame, cfg: ScoreConfig | None = None) -> DataFrame:
    return df.withColumn("prob", scoring.lexicon_prob(F.col("content"), POSITIVE, NEGATIVE))


@query("score_job", f"""
WITH {_SCORED_TEXT}
SELECT review_uid, star, true_label, {_LABEL.format(p='prob')} AS pred_label, true_label = {_LABEL.format(p='prob')} AS is_correct,
       DATE '2025-07-02' AS run_date
FROM v_text
""")
def score_job(spark: SparkSession, folder: str) -> DataFrame:
    """The whole job on all reviews: from a table to the dated result table."""
    target = scratch_dir(spark, "predicted-reviews")
    v.reviews(spark, folder).select("review_uid", "content", "star").createOrReplaceTempView("fact_reviews")
    score_reviews(spark, ScoreConfig(output=target, sample_mode="none", write_mode="overwrite", run_date="2025-07-02"), lexicon)
    return spark.read.parquet(target).drop("content")


_FIRST_WORDS = r"array_to_string(list_filter(string_split_regex(lower(content), '\s+'), lambda x: x <> '')[1:40], ' ')"


@query("score_configured", f"""
WITH {v.LABELLED}, cut AS (SELECT review_uid, star, true_label, {_FIRST_WORDS} AS content FROM v_labelled),
p AS (SELECT *, {_SHARE} AS prob FROM cut),
judged AS (SELECT *, CASE WHEN prob >= 0.55 THEN 'positive' WHEN prob < 0.45 THEN 'negative' ELSE 'neutral' END AS pred_label FROM p)
SELECT review_uid, star, true_label, pred_label, true_label = pred_label AS is_correct, DATE '2025-07-03' AS run_date FROM judged
""")
def score_configured(spark: SparkSession, folder: str) -> DataFrame:
    """Settings from environment and options, rows spread anew, a vectorised scorer with a token limit."""
    target = scratch_dir(spark, "configured")
    env = {"THRESH_POS": "0.55", "MAX_LEN": "99", "WRITE_MODE": "overwrite"}
    cfg = ScoreConfig.from_args(["--thresh_neg", "0.45", "--max_len", "40", "--npartitions", "3", "--run_date", "2025-07-03", "--input", "reviews_to_score", "--output", target], env)
    v.reviews(spark, folder).select("review_uid", "content", "star").createOrReplaceTempView(cfg.input)

    def score(rows: DataFrame, given: ScoreConfig) -> DataFrame:
        return scoring.score_text(rows, "content", scoring.word_count_scorer(POSITIVE, NEGATIVE, given.max_len), "limited")

    score_reviews(spark, cfg, score)
    return spark.read.parquet(target).drop("content")


_STRIPPED = r"regexp_replace(text, '^\s+|\s+$', '', 'g')"


@query("reviews_to_scores", f"""
WITH facts AS (
  SELECT 'a_' || doc_id AS review_uid, 'shop_a' AS source, CAST(doc_id % 200 AS VARCHAR) AS product_id, text AS content, CAST(doc_id % 6 AS INTEGER) AS star FROM documents
  UNION ALL
  SELECT 'b_r' || conv_id || '-' || turn, 'shop_b', CAST(conv_id AS VARCHAR), {_STRIPPED},
         CASE WHEN turn % 2 = 0 THEN CAST(conv_id % 5 + 1 AS INTEGER) END FROM conversations
  UNION ALL
  SELECT 'c_' || CASE WHEN doc_id % 5 <> 0 THEN CAST(doc_id AS VARCHAR) ELSE 'item ' || product || '_' || page || '_' || position END, 'shop_c',
         CAST(product AS VARCHAR), review, CASE WHEN doc_id % 23 <> 0 THEN CAST(doc_id % 6 AS INTEGER) END
  FROM (SELECT *, row_number() OVER (PARTITION BY product, page ORDER BY doc_id) AS position FROM (
    SELECT doc_id, doc_id % 200 AS product, CAST(floor(doc_id / 4000) AS INTEGER) + 1 AS page,
           CASE WHEN doc_id % 29 <> 0 THEN {_STRIPPED} END AS review FROM documents))),
kept AS (SELECT *, {_SHARE} AS prob FROM facts WHERE content IS NOT NULL AND content <> '' AND content <> 'N/A' AND star >= 1),
labelled AS (
  SELECT *, CASE WHEN star >= 4 THEN 'positive' WHEN star <= 2 THEN 'negative' ELSE 'neutral' END AS true_label, {_LABEL.format(p='prob')} AS pred_label FROM kept)
SELECT review_uid, source, product_id, star, true_label, pred_label, true_label = pred_label AS is_correct, DATE '2025-07-02' AS run_date FROM labelled
""")
def reviews_to_scores(spark: SparkSession, folder: str) -> DataFrame:
    """From the pages and payloads of all shops, some collected twice, to the scored table."""
    target = scratch_dir(spark, "scored-facts")
    payloads, lists = v.review_payloads(spark, folder), v.review_pages(spark, folder)
    spans = v.span_review_pages(spark, folder).select(F.col("conv_id").cast("string").alias("product_id"), F.col("part").alias("page"), "html")
    facts = fact_reviews(payloads.unionByName(payloads.filter("page = 1")), spans, lists.unionByName(lists.filter("page = 1")), v.SCRAPED_AT)
    facts.createOrReplaceTempView("conformed_reviews")
    score_reviews(spark, ScoreConfig(input="conformed_reviews", output=target, write_mode="overwrite", run_date="2025-07-02"), lexicon)
    return spark.read.parquet(target).drop("content", "created_at")


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Scores and labels of all reviews."""
    return score_frame(v.reviews(spark, folder), ScoreConfig(sample_mode="none"), lexicon).select("review_uid", "star", "true_label", "prob", "pred_label", "is_correct")
