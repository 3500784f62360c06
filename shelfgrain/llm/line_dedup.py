"""Removal of lines that repeat across documents.

Every line is normalised to a key and hashed, the distinct documents of each hash are
counted, lines over the threshold are dropped everywhere except in the last document,
and the rest is put together again by position. Plain DataFrame operations throughout:
document counts are combined before they are shuffled, so a line that a third of all
documents hold is no burden, and the final join goes by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, fresh, lowered

MIN_CHARS = 20
MIN_DOCUMENTS = 3


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return lowered(F.btrim(line, F.lit(BLANKS)))


def dedup_lines(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
    n_lines: str = "n_lines",
    n_dropped: str = "n_dropped",
) -> DataFrame:
    """The input rows with cleaned `text`, the number of lines before and of lines dropped.

    A line's key is the line without blanks at its ends, A-Z lower-cased. Keys of at least
    `min_chars` code points found in at least `min_documents` distinct ids lose all their
    lines, except in the largest id that holds them. Keys are told apart by 128 hash bits.

    A null or empty text is one empty line and stays or becomes empty text. Rows that share
    an id are one document; rows with a null id are together one document, smaller than
    all others. Equal rows all stay. Other columns pass through; those named like an output
    are replaced. An empty table gives an empty table.
    """
    names = fresh(docs, "ld_id", "ld_text", "ld_drop", "ld_lines", "ld_kept")
    doc, digest, drop, lines, kept = names
    keys = F.transform(lines_of(F.col(text)), line_key)
    exploded = (
        docs.select(F.col(id).alias("doc"), F.xxhash64(F.col(text)).alias("digest"), F.posexplode(keys).alias("at", "key"))
        .filter(F.char_length("key") >= min_chars)
        .select("doc", "digest", "at", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2"))
    )
    repeated = (
        exploded.select("h1", "h2", "doc").distinct()
        # grouped by one struct, so that the join below gets an exchange of its own, where Spark can split a hot line
        .groupBy(F.struct("h1", "h2").alias("line")).agg(F.count(F.lit(1)).alias("holders"), F.max("doc").alias("keeper"))
        .filter(F.col("holders") >= min_documents)
        .select("line.h1", "line.h2", "keeper")
    )
    doomed = (
        exploded.join(repeated, ["h1", "h2"])
        .filter(~F.col("doc").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("doc").alias(doc), F.col("digest").alias(digest))
        .agg(F.collect_set("at").alias(drop))
    )
    same = docs[id].eqNullSafe(doomed[doc]) & (F.xxhash64(docs[text]) == doomed[digest])
    split = docs.join(doomed, same, "left").withColumn(lines, lines_of(F.col(text)))
    all_lines = F.sequence(F.lit(0), F.size(lines) - 1)
    stay = F.when(F.col(drop).isNull(), all_lines).otherwise(F.array_except(all_lines, F.col(drop)))
    joined = F.array_join(F.transform(F.col(kept), lambda at: F.element_at(F.col(lines), at + 1)), "\n")
    return (
        split.withColumn(kept, stay)
        .withColumn(n_lines, F.size(lines).cast("bigint"))
        .withColumn(n_dropped, (F.size(lines) - F.size(kept)).cast("bigint"))
        .withColumn(text, F.when(F.col(drop).isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(joined))
        .drop(*names)
    )
