"""MinHash fingerprints of documents, and near-duplicates found through them.

A fingerprint holds, for each of `PERMUTATIONS` universal hash functions, the low 16 bits
of the smallest value over a text's shingles; equal places of two fingerprints estimate
their Jaccard likeness. All texts of a slice are hashed at once in numpy, a few thousand
shingles at a time so that the work stays in the processor's cache. Documents that agree in
a band of their fingerprints meet in Spark, and the Jaccard of what meets is verified on
the shingles themselves, never by listing all pairs of a band.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import giving_back, hashed, id_borders, mixed, range_of, slices, small_batches, stored, texts_of, words
from .similarity_join import digests, resolve, shingle_sets

SHINGLE_WORDS = 5
PERMUTATIONS = 128
BANDS = 32
SIMILARITY = Fraction(4, 5)
SEED = 20240817
BLOCK = 4096
# text in a task that walks it in order, and the most tasks there may be
RUN_BYTES = 32 << 20
MAX_RUNS = 20_000


def coefficients(permutations: int = PERMUTATIONS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Multiply-shift hashes of 32-bit numbers: (a * x + b) >> 32 with odd a."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, 2**63, permutations, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, permutations, dtype=np.uint64)


def windows(texts: pa.Array, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """64-bit shingles of all texts in order, and how many each text has.

    Each word, lower-cased, ends one window of `width` words; the first ones begin with
    blanks, so that short texts too have as many windows as words.
    """
    parts, code, counts = words(texts, lower=True)
    word = mixed(hashed(parts))[code]
    at = np.arange(len(code)) - np.repeat(np.cumsum(counts) - counts, counts)
    value = np.zeros(len(code), np.uint64)
    with np.errstate(over="ignore"):
        for back in range(width):
            part = np.zeros(len(code), np.uint64)
            part[back:] = word[: max(len(code) - back, 0)]
            part[at < back] = 0
            value = mixed(value * np.uint64(0x9E3779B97F4A7C15) + part + np.uint64(back))
    return value, counts


def signatures(values: np.ndarray, counts: np.ndarray, permutations: int = PERMUTATIONS) -> np.ndarray:
    """One row of 16-bit minima for each text; a text without shingles has the largest values."""
    a, b = coefficients(permutations)
    x = (values >> np.uint64(32)).astype(np.uint64)
    out = np.full((len(counts), permutations), 0xFFFFFFFF, np.uint64)
    full = np.flatnonzero(counts)
    starts = (np.cumsum(counts) - counts)[full]
    with np.errstate(over="ignore"):
        for begin in range(0, len(x), BLOCK):
            end = min(begin + BLOCK, len(x))
            first = np.searchsorted(starts, begin, side="right") - 1
            last = np.searchsorted(starts, end, side="left")
            cuts = np.maximum(starts[first:last] - begin, 0)
            rows = full[first:last]
            block = x[begin:end]
            for p in range(permutations):
                low = np.minimum.reduceat((block * a[p] + b[p]) >> np.uint64(32), cuts)
                out[rows, p] = np.minimum(out[rows, p], low)
    return (out & np.uint64(0xFFFF)).astype(np.uint16)


def fingerprints_of(texts: pa.Array, permutations: int = PERMUTATIONS) -> np.ndarray:
    return signatures(*windows(texts), permutations)


def as_hex(signature: np.ndarray) -> list[str]:
    return [row.astype(">u2").tobytes().hex() for row in signature]


def likeness(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return (one == other).mean(axis=1)


def fingerprint(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id and fingerprint (hex) of every row, null text as empty. No shuffle."""
    small_batches(docs)
    rows = docs.select(docs[id].alias("id"), docs[text].alias("text"))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(as_hex(fingerprints_of(texts_of(batch, "text"))), pa.string())], names=["id", "fingerprint"])

    return rows.mapInArrow(giving_back(made), f"id {rows.schema['id'].dataType.simpleString()}, fingerprint string").withColumnRenamed("id", id)


# --- each document next to an edited form of itself ---------------------------------


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as many first characters of what follows."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def in_order(docs: DataFrame, id: str, text: str) -> DataFrame:
    """Rows as (id, text, run, guest), each run sorted in one partition and ending with the first row of the next run as a guest.

    Runs are ranges of ids. Their borders come from approximate quantiles of the ids alone
    and are fixed numbers afterwards, so a task that is run again sees the same rows. The
    last run's guest is the very first row. Null ids sort last, in the last run.
    """
    small_batches(docs)
    rows = docs.select(docs[id].cast("bigint").alias("id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    size, known = rows.agg(F.sum(F.octet_length("text")), F.count("id")).first()
    runs = int(min(max(1, -(-(size or 0) // RUN_BYTES), rows.sparkSession.sparkContext.defaultParallelism), MAX_RUNS, max(1, known)))
    borders = id_borders(rows, "id", runs) if known else []
    # a run holds the ids from one border up to the next; the first row of each run is known from the ids alone
    placed = rows.withColumn("run", range_of(F.col("id"), borders))
    heads = [(r["run"], r["head"]) for r in placed.groupBy("run").agg(F.min("id").alias("head")).collect()]
    order = sorted(r for r, _ in heads)
    before = {r: order[i - 1] for i, r in enumerate(order)}
    guests = {head: before[r] for r, head in heads if head is not None}
    if not order:
        return placed.withColumn("guest", F.lit(0))
    only_null = [r for r, head in heads if head is None]
    table = rows.sparkSession.createDataFrame(list(guests.items()), "head bigint, to int")
    # one row for each run, and no more runs than MAX_RUNS: safe to send to all tasks
    visiting = rows.join(F.broadcast(table), F.col("id") == F.col("head")).select("id", "text", F.col("to").alias("run"), F.lit(1).alias("guest"))
    if only_null:
        visiting = visiting.unionByName(rows.filter(F.col("id").isNull()).select("id", "text", F.lit(before[only_null[0]]).alias("run"), F.lit(1).alias("guest")))
    every = placed.select("id", "text", F.col("run").cast("int").alias("run"), F.lit(0).alias("guest")).unionByName(visiting)
    return every.repartitionById(len(borders) + 1, F.col("run")).sortWithinPartitions("run", "guest", F.col("id").asc_nulls_last(), "text")


def compare_edited(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row its fingerprint, that of its edited text, and how alike both are, and it and the next row's.

    The edited text ends, in place of its last quarter, with the beginning of the next row
    in id order, the first row following the last. Rows that share an id follow in text
    order; equal rows are rows of their own; null ids come last. A null text is empty, and
    two texts without words are alike. A single row follows itself. An empty table gives
    no rows. Texts are shuffled once; each task walks its run row by row.
    """

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        closed = False
        for batch in slices(batches, "text"):
            for row in zip(*[batch.column(c).to_pylist() for c in ("id", "text", "guest")]):
                if row[2] and closed:
                    continue  # further rows that share the guest's id
                closed = bool(row[2])
                held.append(row)
                size += len(row[1])
                if size > (4 << 20) and len(held) > 1:
                    yield _compared(held)
                    held, size = held[-1:], len(row[1])
        if len(held) > 1:
            yield _compared(held)

    rows = in_order(docs, id, text)
    columns = "id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return rows.mapInArrow(giving_back(walked), columns).withColumn("id", F.col("id").cast(docs.schema[id].dataType)).withColumnRenamed("id", id)


def _compared(rows: list[tuple]) -> pa.RecordBatch:
    """Columns for all rows but the last, which only follows."""
    import hashlib

    texts = [r[1] for r in rows]
    changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
    own, other = fingerprints_of(pa.array(texts, pa.string())), fingerprints_of(pa.array(changed, pa.string()))
    first = own[:-1]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows[:-1]], pa.int64()),
            pa.array([len(t) for t in texts[:-1]], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            pa.array(as_hex(first), pa.string()),
            pa.array(as_hex(other), pa.string()),
            pa.array(likeness(first, other)),
            pa.array(likeness(first, own[1:])),
        ],
        names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


# --- near-duplicates -----------------------------------------------------------------


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", similarity: Fraction = SIMILARITY, bands: int = BANDS) -> DataFrame:
    """id, n_shingles and component_id, the smallest id reached by links, on five-word shingles.

    Texts meet in a tile if they agree in a band of their fingerprints. What meets is
    verified as in the similarity join: first against a centre of the tile, then, where a
    tile still holds several classes, pair by pair on bitmaps and on the shingles. Bands
    are a random search: a pair at 0.8 meets with probability above 0.999, and of what
    meets no link is lost.

    A text of fewer words is one shingle; texts without words link with nothing. Rows with
    equal sets link; rows with a null id take no part and have a null component.
    """
    small_batches(docs)
    rows = docs.select(docs[id].alias("id"), docs[text].alias("text"))

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values, counts = shingle_sets(texts_of(batch, "text"), SHINGLE_WORDS)
            signature = signatures(values, counts).astype(np.uint64)
            keys = np.empty((len(counts), bands), np.uint64)
            with np.errstate(over="ignore"):
                for i in range(bands):
                    keys[:, i] = mixed(np.full(len(counts), i, np.uint64) + np.uint64(1))
                    for column in signature[:, i::bands].T:
                        keys[:, i] = mixed(keys[:, i] * np.uint64(0x9E3779B97F4A7C15) + column)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(keys.view(np.int64).ravel()), bands).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(counts), pa.array(digests(values, counts).view(np.int64)), lists], names=["id", "n", "node", "keys"])

    kind = rows.schema["id"].dataType.simpleString()
    signed = stored(rows.mapInArrow(giving_back(banded), f"id {kind}, n long, node long, keys array<long>"), "minhash-bands")
    met = signed.filter("n > 0").select(F.explode("keys").alias("key"), "node").distinct()
    held = met.groupBy("key").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    tiles = stored(met.join(held, "key"), "minhash-tiles")
    found = resolve(rows, signed.select("id", "n", "node"), tiles, similarity, SHINGLE_WORDS)
    return found.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
