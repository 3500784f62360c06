"""Toxicity by multiple-instance learning.

Only documents are labelled, sentences are scored. A sentence's score is a logistic model
of its words and word beginnings; a document is toxic unless none of its sentences is:
1 - product(1 - p), the noisy-or. The likelihood of the document labels trains the sentence
model, which then tells the offending sentences.

The model is fitted in one task on at most `MAX_DOCUMENTS` labelled documents and about
`MAX_BYTES` of text, taken in the order of a hash of their ids as far as they fit, and has `FEATURES` weights. Scoring is one pass without a
shuffle, with the weights sent to all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hashed, slices, small_batches, texts_of, words

FEATURES = 1 << 20
PREFIXES = (4, 5)
MAX_DOCUMENTS = 12_000
MAX_BYTES = 48 << 20
ROUNDS = 60
RATE = 0.3
DECAY = 2e-5
# a feature counts if so many toxic texts hold it, and so many standard deviations more than would by chance
MIN_DOCUMENTS = 3
MIN_EXCESS = 5
PRIOR = -6.0
THRESHOLD = 0.3

BREAK = "\x02"
MARKS = ".,;:!?…\"'()[]{}*_“”‘’«»¡¿"
ENDS = r"[.!?…。！？][\"')\]»”’]*$"


@dataclass
class Sentences:
    """Words of a slice of texts by kind, and which sentence and text each belongs to."""

    kinds: pa.Array  # normalised distinct words
    raw: pa.Array  # the same as written
    code: np.ndarray  # kind of each word
    sentence: np.ndarray  # sentence of each word
    text: np.ndarray  # text of each sentence


def sentences_of(texts: pa.Array) -> Sentences:
    """Sentences end with a line, or a word that ends in a full stop, question or exclamation mark."""
    raw, code, counts = words(pc.replace_substring(texts, "\n", f" {BREAK} "), lower=False)
    owner = np.repeat(np.arange(len(counts)), counts)
    ending = pc.match_substring_regex(raw, ENDS).to_numpy(zero_copy_only=False) | pc.equal(raw, BREAK).to_numpy(zero_copy_only=False)
    # a new sentence begins with a text and behind an ending
    starts = np.ones(len(code), bool)
    starts[1:] = ending[code[:-1]] | (owner[1:] != owner[:-1])
    sentence = np.cumsum(starts) - 1
    kinds = pc.utf8_trim(pc.utf8_lower(raw), MARKS)
    return Sentences(kinds, raw, code, sentence, owner[starts])


def feature_table(kinds: pa.Array) -> np.ndarray:
    """For each distinct word the numbers of its features: the word and its beginnings. Feature 0 is none."""
    columns = [hashed(kinds)]
    long_enough = [pc.greater(pc.utf8_length(kinds), 0)]
    for n in PREFIXES:
        columns.append(hashed(pc.utf8_slice_codeunits(kinds, 0, n)) * np.uint64(2 * n + 1))
        long_enough.append(pc.greater_equal(pc.utf8_length(kinds), n))
    table = np.stack([1 + (c >> np.uint64(20)) % np.uint64(FEATURES - 1) for c in columns], axis=1).astype(np.int64)
    return table * np.stack([x.to_numpy(zero_copy_only=False) for x in long_enough], axis=1)


def sentence_scores(s: Sentences, weights: np.ndarray) -> np.ndarray:
    """Log-odds of each sentence; weights[0] is the intercept."""
    of_kind = np.where(feature_table(s.kinds) > 0, weights[feature_table(s.kinds)], 0).sum(axis=1) if len(s.kinds) else np.zeros(0)
    return weights[0] + np.bincount(s.sentence, weights=of_kind[s.code], minlength=len(s.text))


def noisy_or(log_odds: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """1 - product(1 - p) of each text's sentences; 0 without any."""
    none = np.bincount(text, weights=-np.logaddexp(0, log_odds), minlength=texts)
    return -np.expm1(none)


def fit_weights(texts: pa.Array, labels: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Weights by Adam on the noisy-or likelihood; features without a clear excess in toxic texts stay zero."""
    weights = np.zeros(FEATURES, np.float64)
    weights[0] = PRIOR
    n = len(labels)
    if not n:
        return weights.astype(np.float32)
    s = sentences_of(texts)
    table = feature_table(s.kinds)
    # features that toxic texts do not hold clearly more often than others stay out
    size = max(len(s.kinds), 1)
    pairs = np.unique(s.text[s.sentence] * size + s.code)
    seen, toxic = np.zeros(FEATURES), np.zeros(FEATURES)
    for column in table.T:
        held = np.unique(pairs // size * FEATURES + column[pairs % size])
        seen += np.bincount(held % FEATURES, minlength=FEATURES)
        toxic += np.bincount(held % FEATURES, weights=labels[held // FEATURES], minlength=FEATURES)
    expected = seen * labels.mean()
    telling = (toxic >= MIN_DOCUMENTS) & (toxic - expected >= MIN_EXCESS * np.sqrt(expected))
    table = np.where(telling[table], table, 0)
    used, packed = np.unique(table, return_inverse=True)
    packed = packed.reshape(table.shape)
    if used[0] != 0:
        used, packed = np.concatenate([[0], used]), packed + 1
    w, bias = np.zeros(len(used)), PRIOR
    first, second = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for step in range(1, rounds + 1):
        of_kind = w[packed].sum(axis=1)
        odds = bias + np.bincount(s.sentence, weights=of_kind[s.code], minlength=len(s.text))
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        whole = np.clip(noisy_or(odds, s.text, n), 1e-9, 1)
        # d log-likelihood / d log-odds: -p for clean texts, p (1 - P) / P for toxic ones
        slope = p * np.where(labels == 1, (1 - whole) / whole, -1.0)[s.text]
        by_kind = np.bincount(s.code, weights=slope[s.sentence], minlength=len(s.kinds))
        gradient = np.zeros(len(used) + 1)
        for column in packed.T:
            gradient[:-1] += np.bincount(column, weights=by_kind, minlength=len(used))
        gradient[:-1] = gradient[:-1] / n - DECAY * w
        gradient[0] = 0
        gradient[-1] = slope.sum() / n
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
        w += move[:-1]
        bias += move[-1]
    weights[used] = w
    weights[0] = bias
    return weights.astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, train: Column, id: str = "doc_id", text: str = "text", label: str = "toxic", max_documents: int = MAX_DOCUMENTS, max_bytes: int = MAX_BYTES) -> np.ndarray:
    """Weights from the documents for which `train`, an expression over the id, holds.

    `labels` has the id and the label 0 or 1; null labels are left out, of several labels
    of an id the largest counts. Without labelled documents every sentence has the prior.
    A text that does not fit into what is left of `max_bytes` is passed over, and those
    behind it still take part; the first always does.
    """
    small_batches(docs)
    chosen = (
        labels.filter(train & F.col(label).isNotNull()).groupBy(F.col(id).alias("id")).agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("id"), "id").limit(max_documents)
    )
    # at most max_documents short rows, which is what the broadcast is bounded by
    sample = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken, size = [], 0
        for batch in slices(batches, "text"):
            fits = np.zeros(batch.num_rows, bool)
            for i, length in enumerate(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()):
                fits[i] = size == 0 or size + length <= max_bytes
                size += length if fits[i] else 0
            taken.append(batch if fits.all() else batch.filter(pa.array(fits)))
        table = pa.Table.from_batches(taken, schema=pa.schema([("text", pa.string()), ("label", pa.int32())])).combine_chunks()
        texts = pc.fill_null(table["text"], "").combine_chunks()
        weights = fit_weights(texts if isinstance(texts, pa.Array) else pa.array([], pa.string()), table["label"].to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary())], names=["weights"])

    # only the sample goes to one task; the scan that finds it stays spread
    ordered = sample.repartition(1).sortWithinPartitions(F.xxhash64("id"), "id").select("text", "label")
    row = ordered.mapInArrow(fitted, "weights binary").first()
    return np.frombuffer(row["weights"], np.float32) if row else fit_weights(pa.array([], pa.string()), np.zeros(0))


def score(docs: DataFrame, weights: np.ndarray, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id and score of every row: the noisy-or of its sentences. A null or empty text scores 0.

    Rows that repeat or have a null id are scored like others; an empty table gives no rows.
    """
    small_batches(docs)
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    rows = docs.select(docs[id].alias("id"), docs[text].alias("text"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            s = sentences_of(texts_of(batch, "text"))
            whole = noisy_or(sentence_scores(s, sent.value.astype(np.float64)), s.text, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(whole)], names=["id", "score"])

    return rows.mapInArrow(scored, f"id {rows.schema['id'].dataType.simpleString()}, score double").withColumnRenamed("id", id)


def offending(docs: DataFrame, weights: np.ndarray, id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """id, number (from 0), score and words of each sentence that scores at least `threshold`."""
    small_batches(docs)
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    rows = docs.select(docs[id].alias("id"), docs[text].alias("text"))

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            s = sentences_of(texts_of(batch, "text"))
            p = 1 / (1 + np.exp(-sentence_scores(s, sent.value.astype(np.float64))))
            hits = np.flatnonzero(p >= threshold)
            starts = np.searchsorted(s.sentence, np.arange(len(s.text) + 1))
            first = np.searchsorted(s.text, s.text[hits])
            written = [" ".join(w for w in s.raw.take(pa.array(s.code[starts[i] : starts[i + 1]])).to_pylist() if w != BREAK) for i in hits]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(s.text[hits])), pa.array(hits - first, pa.int64()), pa.array(p[hits]), pa.array(written, pa.string())],
                names=["id", "number", "score", "sentence"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(located, f"id {kind}, number long, score double, sentence string").withColumnRenamed("id", id)
