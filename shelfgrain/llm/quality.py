"""Quality scores from document statistics.

Statistics of each text go through random Fourier features, which approximate a Gaussian
kernel, into a ridge regression on the labels; isotonic calibration turns its output into
a probability. The normal equations are sums over partitions, so any number of labelled
rows may take part. What comes to the driver is one matrix for each of `SLOTS` groups of
partitions and a histogram of `BINS` bins, whatever the size of the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import giving_back, slices, small_batches, stored, texts_of, words
from .line_rules import _sums, repeated_words

FOURIER = 256
RIDGE = 1e-3
CLIP = 6.0
SLOTS = 8
BINS = 2000
RANGE = (-0.5, 1.5)
SEED = 7
THRESHOLD = 0.3
# one training row in so many calibrates and has no part in the regression
CALIBRATE = 4

# byte classes; bytes above 127 belong to letters of other alphabets
CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "blank": b" \t\n\r\x0b\x0c", "stop": b".?", "comma": b",;:", "shout": b"!", "bar": b"|", "symbol": b"#*$%&<>=+/\\@^~{}[]_"}
STATISTICS = [
    "chars", "words", "lines", *CLASSES, "other_bytes", "word_length", "distinct", "same_as_before", "repeated", "repeated_lines",
    "ends_in_symbol", "shouted", "words_per_line", "words_per_stop", "longest_word",
]


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATISTICS for each text: logarithms of sizes, shares of bytes, words and lines."""
    n = len(texts)
    counts = {}
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    kind = np.zeros(256, np.int64)
    for i, members in enumerate(CLASSES.values(), 1):
        kind[list(members)] = i
    kind[128:] = len(CLASSES) + 1
    data = np.frombuffer(b"".join(texts.cast(pa.binary()).to_pylist()), np.uint8)
    many = len(CLASSES) + 2
    by_class = np.bincount(np.repeat(np.arange(n) * many, sizes) + kind[data], minlength=n * many).reshape(n, many)
    for i, name in enumerate([*CLASSES, "other_bytes"], 1):
        counts[name] = by_class[:, i]

    parts, code, n_words = words(texts, lower=False)
    owner = np.repeat(np.arange(n), n_words)
    of_word = lambda x: _sums(x.to_numpy(zero_copy_only=False)[code].astype(np.int64), n_words) if len(code) else np.zeros(n, np.int64)
    lengths = pc.utf8_length(parts)
    distinct = np.bincount(np.unique(owner * max(len(parts), 1) + code) // max(len(parts), 1), minlength=n)
    same = np.zeros(len(code), np.int64)
    same[1:] = (code[1:] == code[:-1]) & (owner[1:] == owner[:-1])
    split = pc.split_pattern(texts, "\n")
    n_lines = np.diff(split.offsets.to_numpy()).astype(np.int64)
    line_owner = np.repeat(np.arange(n), n_lines)
    line_code = split.flatten().dictionary_encode()
    distinct_lines = np.bincount(np.unique(line_owner * max(len(line_code.dictionary), 1) + line_code.indices.to_numpy(zero_copy_only=False)) // max(len(line_code.dictionary), 1), minlength=n)
    longest = np.zeros(n)
    np.maximum.at(longest, owner, lengths.to_numpy(zero_copy_only=False)[code] if len(code) else np.zeros(0))

    bytes_, some_words, some_lines = np.maximum(sizes, 1), np.maximum(n_words, 1), np.maximum(n_lines, 1)
    columns = [np.log1p(sizes), np.log1p(n_words), np.log1p(n_lines)]
    columns += [counts[name] / bytes_ for name in [*CLASSES, "other_bytes"]]
    columns += [
        of_word(lengths) / some_words, distinct / some_words, _sums(same, n_words) / some_words, repeated_words(code, n_words) / some_words,
        (n_lines - distinct_lines) / some_lines,
        of_word(pc.match_substring_regex(parts, r"[#*$%&|<>=!]$")) / some_words, of_word(pc.match_substring_regex(parts, r"^\p{Lu}{2,}[!.,?]*$")) / some_words,
        np.log1p(n_words / some_lines), np.log1p(n_words / np.maximum(counts["stop"], 1)), np.log1p(longest),
    ]
    return np.stack(columns, axis=1).astype(np.float32)


def with_statistics(docs: DataFrame, id: str, text: str) -> DataFrame:
    small_batches(docs)
    rows = docs.select(docs[id].alias("id"), docs[text].alias("text"))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values = statistics(texts_of(batch, "text"))
            packed = pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), len(STATISTICS)).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), packed], names=["id", "stats"])

    return rows.mapInArrow(giving_back(measured), f"id {rows.schema['id'].dataType.simpleString()}, stats array<float>")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("stats").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(STATISTICS)).astype(np.float64)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of the Fourier features, then the intercept
    steps: np.ndarray  # raw scores, ascending
    chances: np.ndarray  # calibrated score at each of them

    def features(self, stats: np.ndarray) -> np.ndarray:
        """cos(w x + b) with w from a normal distribution: inner products approximate a Gaussian kernel."""
        rng = np.random.default_rng(SEED)
        n = stats.shape[1]
        frequencies = rng.normal(0, 1 / np.sqrt(n), (n, FOURIER))
        phases = rng.uniform(0, 2 * np.pi, FOURIER)
        x = np.clip((stats - self.mean) / self.scale, -CLIP, CLIP)
        return np.hstack([np.sqrt(2 / FOURIER) * np.cos(x @ frequencies + phases), np.ones((len(x), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.steps, self.chances)


def isotonic(counts: np.ndarray, positives: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the rising sequence closest to positives / counts."""
    blocks: list[list[float]] = []  # weight, positives, bins
    for n, k in zip(counts, positives):
        blocks.append([float(n), float(k), 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            n, k, bins = blocks.pop()
            blocks[-1] = [blocks[-1][0] + n, blocks[-1][1] + k, blocks[-1][2] + bins]
    return np.concatenate([np.full(int(bins), k / n) for n, k, bins in blocks]) if blocks else np.zeros(0)


def fit(stats: DataFrame, labels: DataFrame, train: Column, id: str = "doc_id", label: str = "quality") -> Model:
    """A model from the rows of `stats` (id, stats) for whose id `train`, an expression over labels' id, holds.

    Null labels are left out, of several labels of an id the largest counts. Without
    labelled rows every score is 0.5; with labels of one kind only, every score is that.
    """
    known = labels.filter(train & F.col(label).isNotNull()).groupBy(F.col(id).alias("id")).agg(F.max(label).cast("double").alias("label"))
    rows = stored(stats.join(known, "id").withColumn("fold", F.pmod(F.xxhash64("id"), F.lit(CALIBRATE))), "quality-train")
    learn, judge = rows.filter("fold <> 0"), rows.filter("fold = 0")
    moments = learn.select(*[f(F.col("stats")[i].cast("double")).alias(f"{name}{i}") for i in range(len(STATISTICS)) for name, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    mean = np.array([moments[f"m{i}"] or 0.0 for i in range(len(STATISTICS))])
    scale = np.array([moments[f"s{i}"] or 0.0 for i in range(len(STATISTICS))])
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), np.zeros(FOURIER + 1), np.array([0.0, 1.0]), np.array([0.5, 0.5]))
    model.weights = _solve(learn, model)
    lowest, highest = RANGE
    width = (highest - lowest) / BINS

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.clip((model.raw(_matrix(batch)) - lowest) / width, 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("label")], names=["bin", "label"])

    histogram = judge.select("stats", "label").mapInArrow(giving_back(binned), "bin int, label double").groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("k")).orderBy("bin").collect()
    if histogram:
        model.steps = np.array([lowest + (r["bin"] + 0.5) * width for r in histogram])
        model.chances = isotonic(np.array([r["n"] for r in histogram]), np.array([r["k"] for r in histogram]))
    return model


def _solve(learn: DataFrame, model: Model) -> np.ndarray:
    """Ridge weights from the normal equations, summed over batches, partitions and slots."""
    size = FOURIER + 1
    schema = "slot int, squares binary, products binary, n long"

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        squares, products, n = np.zeros((size, size)), np.zeros(size), 0
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                z = model.features(_matrix(part))
                squares += z.T @ z
                products += z.T @ part.column("label").to_numpy()
                n += part.num_rows
        if n:
            yield _sums_row(TaskContext.get().partitionId() % SLOTS, squares, products, n)

    def combined(table: pa.Table) -> pa.Table:
        squares, products, n = _added(table.to_pylist(), size)
        return pa.Table.from_batches([_sums_row(table["slot"][0].as_py(), squares, products, n)])

    parts = learn.select("stats", "label").mapInArrow(giving_back(partial), schema).groupBy("slot").applyInArrow(combined, schema).collect()
    squares, products, n = _added([r.asDict() for r in parts], size)
    if not n:
        return np.zeros(size)
    penalty = np.full(size, RIDGE * n)
    penalty[-1] = 1e-9 * n
    return np.linalg.solve(squares + np.diag(penalty), products)


def _sums_row(slot: int, squares: np.ndarray, products: np.ndarray, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([squares.tobytes()]), pa.array([products.tobytes()]), pa.array([n], pa.int64())], names=["slot", "squares", "products", "n"])


def _added(rows: list[dict], size: int) -> tuple[np.ndarray, np.ndarray, int]:
    squares, products, n = np.zeros((size, size)), np.zeros(size), 0
    for r in rows:
        squares += np.frombuffer(r["squares"]).reshape(size, size)
        products += np.frombuffer(r["products"])
        n += r["n"]
    return squares, products, n


def score(stats: DataFrame, model: Model) -> DataFrame:
    """id and score of every row of `stats`."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(model.score(_matrix(batch)))], names=["id", "score"])

    return stats.mapInArrow(giving_back(scored), f"id {stats.schema['id'].dataType.simpleString()}, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, train: Column, id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """id and score (0 to 1) of every row, from a model fitted on the labelled rows that `train` names.

    Texts are read once; what follows works on their statistics. A null text is an empty
    text and scores as such. Rows that repeat or have a null id are scored like others.
    Other columns are not carried along, so their names cannot clash. An empty table gives
    no rows.
    """
    stats = stored(with_statistics(docs, id, text), "quality-stats")
    return score(stats, fit(stats, labels, train, id, label)).withColumnRenamed("id", id)


def keep_good(docs: DataFrame, labels: DataFrame, train: Column, threshold: float = THRESHOLD, id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """The input rows whose texts score at least `threshold`, with all their columns and without a shuffle.

    Each row is judged by its text alone: a null text as an empty one, rows that repeat or
    have a null id like others. Without labels every score is 0.5, so all rows stay at the
    usual threshold. An empty table gives an empty table.
    """
    model = fit(stored(with_statistics(docs, id, text), "quality-stats"), labels, train, id, label)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            yield batch.filter(pa.array(model.score(statistics(texts_of(batch, text))) >= threshold))

    return docs.mapInArrow(giving_back(kept), docs.schema)
