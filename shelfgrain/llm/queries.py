"""Registered queries of the operators on documents, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    byte_bpe, fingerprints, kd_shards, lexical_search, line_dedup, line_rules, mixing, ngram_lm, periodic_runs, quality, similarity_join,
    token_files, toxicity,
)
from .common import LOWER, UPPER, remainder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


BLANKS_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def lines_sql(documents: str = "documents") -> str:
    """Lines with key and whether they are dropped: doc_id, i, line, dropped."""
    return f"""
    split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM {documents}),
    lines AS (SELECT doc_id, i, ls[i] AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM split)),
    keyed AS (SELECT *, translate(trim(line, {BLANKS_SQL}), '{UPPER}', '{LOWER}') AS k FROM lines),
    repeated AS (
      SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= {line_dedup.MIN_CHARS}
      GROUP BY k HAVING count(DISTINCT doc_id) >= {line_dedup.MIN_DOCUMENTS}
    ),
    marked AS (
      SELECT doc_id, i, line, keeper IS NOT NULL AND doc_id <> keeper AS dropped FROM keyed LEFT JOIN repeated USING (k)
    )"""


@query("op4_line_dedup", f"""
    WITH {lines_sql()}
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
    FROM marked GROUP BY doc_id
""")
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query("op10_kd_shards")
def op10_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kd_shards.kd_shards(documents(spark, sf_dir))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def byte_vocabulary() -> tuple[dict[bytes, int], str]:
    import public_tokenizers

    return byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN


@query("op5_byte_bpe")
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digest_texts(documents(spark, sf_dir), *byte_vocabulary())


WORD_SQL = r"[^\x20\x09-\x0D]+"


def _percent(counted: str, limit: int) -> str:
    return f"100 * {counted} > {limit} * nw"


SEPARATORS_SQL = ", ".join(f"'{s}'" for s in line_rules.SEPARATORS)
PHRASES_SQL = " OR ".join(f"contains(translate(line, '{UPPER}', '{LOWER}'), '{p}')" for p in line_rules.PHRASES)
SENTENCE_END_SQL = line_rules.SENTENCE_END.replace("'", "''")


@query("op7_line_rules", f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD_SQL}') AS w FROM documents),
    words AS (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM texts)),
    windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS times FROM words WHERE c IS NOT NULL),
    covered AS (
      SELECT doc_id, count(DISTINCT i + step) AS n_repeat_words
      FROM windows, (SELECT unnest(range(0, 3)) AS step) WHERE times > 1 GROUP BY doc_id
    ),
    split AS (SELECT doc_id, string_split(t, chr(10)) AS ls FROM texts),
    lines AS (
      SELECT doc_id, i, line, len(regexp_extract_all(line, '{WORD_SQL}')) AS nw, regexp_extract_all(line, '{WORD_SQL}') AS lw
      FROM (SELECT doc_id, i, ls[i] AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM split))
    ),
    judged AS (
      SELECT doc_id, nw, nw > 0 AND row_number() OVER (PARTITION BY doc_id, line ORDER BY i) > 1 AS again,
        nw > 0 AND (NOT regexp_matches(line, '{SENTENCE_END_SQL}')
          OR {_percent("len(regexp_extract_all(line, '[" + line_rules.SYMBOLS + "]'))", line_rules.MAX_SYMBOLS)}
          OR {_percent("len(regexp_extract_all(line, '" + line_rules.SHOUT + "'))", line_rules.MAX_SHOUTS)}) AS punctuation,
        nw > 0 AND {_percent(f"len(list_filter(lw, lambda x: x IN ({SEPARATORS_SQL})))", line_rules.MAX_SEPARATORS)} AS navigation,
        nw > 0 AND nw <= {line_rules.BOILERPLATE_WORDS} AND ({PHRASES_SQL}) AS boilerplate
      FROM lines
    ),
    by_doc AS (
      SELECT doc_id, count(*) FILTER (again) AS n_dup_lines, count(*) FILTER (punctuation) AS n_bad_punctuation,
        count(*) FILTER (navigation) AS n_navigation, count(*) FILTER (boilerplate) AS n_boilerplate,
        CAST(coalesce(sum(nw) FILTER (punctuation OR navigation OR boilerplate), 0) AS BIGINT) AS lost_words
      FROM judged GROUP BY doc_id
    ),
    base AS (
      SELECT doc_id, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        len(regexp_extract_all(t, '[{line_rules.SYMBOLS}]')) AS n_symbols, coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM texts LEFT JOIN covered USING (doc_id)
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
      n_words < {line_rules.MIN_WORDS} OR 100 * n_repeat_words > {line_rules.MAX_REPEATED} * n_words AS base_failed,
      n_bad_punctuation, n_navigation, n_boilerplate, lost_words,
      NOT (n_words < {line_rules.MIN_WORDS} OR 100 * n_repeat_words > {line_rules.MAX_REPEATED} * n_words)
        AND 100 * lost_words <= {line_rules.MAX_LOST} * n_words AS kept
    FROM base JOIN by_doc USING (doc_id)
""")
def op7_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.clean_by_lines(documents(spark, sf_dir), with_text=False)


@query("op9_fingerprints")
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edited(documents(spark, sf_dir))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = remainder(F.col("doc_id"), 4) == 2
    weights = toxicity.fit(docs, labels(spark, sf_dir), ~held_out)
    return toxicity.score(docs, weights).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query("op6_quality")
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 5) == 0
    scores = quality.quality_scores(documents(spark, sf_dir), labels(spark, sf_dir), ~held_out)
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op2_mixing")
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


@query("op8_ngram_jaccard", r"""
    WITH RECURSIVE texts AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
    ),
    sets AS (
      SELECT DISTINCT doc_id, s FROM (
        SELECT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: hash(array_to_string(w[i:i + 3], ' ')))
          WHEN len(w) > 0 THEN [hash(array_to_string(w, ' '))] ELSE [] END) AS s FROM texts)
    ),
    sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
    links AS (
      SELECT a.doc_id AS a, b.doc_id AS b FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id
      JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
      GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
    ),
    edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reached AS (SELECT doc_id, doc_id AS r FROM texts UNION SELECT reached.doc_id, edges.b FROM reached JOIN edges ON reached.r = edges.a)
    SELECT t.doc_id, coalesce(n, 0) AS n_shingles, c.component_id
    FROM texts t LEFT JOIN sizes USING (doc_id) JOIN (SELECT doc_id, min(r) AS component_id FROM reached GROUP BY doc_id) c ON c.doc_id = t.doc_id
""")
def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_join.similar_documents(documents(spark, sf_dir))


@query("op1_bloom_lm")
def op1_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 7) == 2
    scores = ngram_lm.score_texts(documents(spark, sf_dir), ~held_out)
    return scores.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


TERMS_SQL = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"


@query("op11_lexical_search", f"""
    WITH docs AS (SELECT doc_id, {TERMS_SQL} AS t FROM documents),
    items AS (SELECT DISTINCT item_id, unnest({TERMS_SQL}) AS term FROM benchmark),
    totals AS (SELECT count(*) FILTER (len(t) > 0) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM docs),
    tf AS (
      SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM docs)
      WHERE term IN (SELECT term FROM items) GROUP BY doc_id, n, term
    ),
    weights AS (
      SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, totals GROUP BY term, n_docs
    ),
    parts AS (
      SELECT item_id, doc_id, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))) AS part
      FROM tf JOIN weights USING (term) JOIN items USING (term), totals
    ),
    scores AS (SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score FROM parts GROUP BY item_id, doc_id HAVING sum(part) > 0)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores) WHERE rank <= {lexical_search.TOP}
""")
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


WORD = r"[^\x20\x09-\x0D]+"


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text; in each tenth text, by crc32 of the id, the words from one place on repeat some of them."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    w = F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD), F.lit(0))
    placed = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"), F.when(h % 10 == 0, w).alias("w"))
    n = F.size("w").cast("bigint")
    a = F.col("g") % n
    placed = placed.withColumn("a", F.when(n > 0, a)).withColumn("p", 1 + F.expr("(size(w) - a) div (3 + g % 8)"))
    left = (n - F.col("a")).cast("int")
    part = F.slice("w", (F.col("a") + 1).cast("int"), F.col("p").cast("int"))
    again = F.slice(F.flatten(F.array_repeat(part, F.ceil(left / F.col("p")).cast("int"))), F.lit(1), left)
    changed = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a").cast("int")), again), " ")
    return placed.select("doc_id", F.coalesce(F.when(F.col("a").isNotNull(), changed), "text").alias("text"))


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(with_planted_runs(documents(spark, sf_dir)))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    best = found.withColumn("best", periodic_runs.strongest())
    return best.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query("op13_token_files")
def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        description = file.read()
    path = token_files.token_file_path(spark)
    token_files.write_tokens(documents(spark, sf_dir), description, path)
    return token_files.read_tokens(spark, path, digest=True)
