"""From raw documents to token ids: each stage's rows are stored and become the next stage's documents."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfgrain.llm import byte_bpe, line_dedup, mixing, quality, similarity_join
from shelfgrain.llm.common import free_shuffles, fresh, remainder, stored
from shelfgrain.llm.queries import byte_vocabulary


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; a null text is judged as an empty one."""
    free_shuffles(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, labels, remainder(F.col("doc_id"), 5) != 0)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that repeat across documents; n_chars follows the text, and a null text is empty."""
    free_shuffles(spark)
    n_lines, n_dropped = fresh(docs, "n_lines", "n_dropped")
    kept = line_dedup.dedup_lines(docs, n_lines=n_lines, n_dropped=n_dropped)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near copies, on five words at 0.8; of rows that repeat id and text one stays, and all rows without an id."""
    free_shuffles(spark)
    return similarity_join.one_of_each(docs, threshold=Fraction(4, 5), width=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as they are taken, so a document may be there twice or not at all."""
    free_shuffles(spark)
    return mixing.take(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of every row, null text as empty."""
    free_shuffles(spark)
    return byte_bpe.digest_texts(docs, *byte_vocabulary())


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", one_of_each),
    ("mixing sources", mix_sources),
    ("byte-level BPE", encode),
]

# the classifier, the mix and the encoder are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return last(spark, docs, sf_dir)
