"""A text classifier of the usual kind: word pieces, truncation, padding, an encoder, softmax.

Spark cuts texts into words, so workers get lists of words and never parse text. A word is
cut into pieces on a trie, the longest that fits first; a task looks up each distinct word
once. Sequences are cut to a number of tokens, padded to the longest of a few of like
length, and go through a transformer encoder in numpy. Weights live in one file that Spark
sends to every executor once; a worker process reads it when it meets its first text.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scoring import _loaded

# runs of letters and digits, and every other character that is no blank
WORDS = r"[\p{L}\p{N}]+|[^\x09-\x0D\x20\p{L}\p{N}]"
PAD, UNKNOWN, START, STOP = "[PAD]", "[UNK]", "[CLS]", "[SEP]"
SPECIAL = [PAD, UNKNOWN, START, STOP]
INNER = "##"
MAX_LEN = 128
LONGEST_WORD = 100
# sequences that are padded to one length and computed together
CHUNK = 32
MAX_VOCABULARY = 500_000


# --- word pieces ----------------------------------------------------------------------


class WordPieces:
    """Pieces of words by a trie: from each place the longest piece that fits; a word with a place where none does is unknown."""

    def __init__(self, vocabulary: list[str]):
        self.number = {piece: i for i, piece in enumerate(vocabulary)}
        missing = [s for s in SPECIAL if s not in self.number]
        if missing or len(self.number) != len(vocabulary):
            raise ValueError(f"vocabulary repeats pieces or lacks {missing}")
        # a node is a dict from character to node; the piece that ends there is under ""
        self.first: dict = {}
        self.inner: dict = {}
        for piece, i in self.number.items():
            if piece not in SPECIAL:
                node = self.inner if piece.startswith(INNER) and len(piece) > len(INNER) else self.first
                for char in piece[len(INNER) :] if node is self.inner else piece:
                    node = node.setdefault(char, {})
                node[""] = i
        self.unknown = [self.number[UNKNOWN]]

    def cut(self, word: str) -> list[int]:
        if len(word) > LONGEST_WORD:
            return self.unknown
        out: list[int] = []
        at = 0
        while at < len(word):
            node, found, end = (self.inner if at else self.first), None, at
            for i in range(at, len(word)):
                node = node.get(word[i])
                if node is None:
                    break
                if "" in node:
                    found, end = node[""], i + 1
            if found is None:
                return self.unknown
            out.append(found)
            at = end
        return out

    def sequences(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of all lists of words behind each other, and how many each list has. Distinct words are cut once."""
        flat = words.flatten()
        coded = flat.dictionary_encode()
        cut = [self.cut(w) for w in coded.dictionary.to_pylist()]
        sizes = np.array([len(c) for c in cut], np.int64)
        pool = np.array([i for c in cut for i in c], np.int64)
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        begin = (np.cumsum(sizes) - sizes)[code] if len(code) else code
        each = sizes[code] if len(code) else code
        last = np.cumsum(each)
        ids = pool[np.arange(int(each.sum())) - np.repeat(last - each, each) + np.repeat(begin, each)] if len(code) else np.zeros(0, np.int64)
        n_words = np.diff(words.offsets.to_numpy())
        ends = np.concatenate([[0], last])[np.cumsum(n_words)]
        return ids, np.diff(np.concatenate([[0], ends]))


def word_list(content: Column, at_most: int | None = None) -> Column:
    """Lower-cased words of a text; a null text has none. As every word has a piece, a limit on pieces is one on words."""
    words = F.regexp_extract_all(F.lower(F.coalesce(content, F.lit(""))), F.lit(WORDS), F.lit(0))
    return words if at_most is None else F.slice(words, 1, at_most)


def piece_vocabulary(rows: DataFrame, content: str, whole: int = 8, start: int = 4, inner: int = 3) -> list[str]:
    """A vocabulary by rule, in code point order behind the special pieces: words of up to `whole` characters, the first
    1 to `start` characters of each word, and all its later parts of up to `inner` characters.

    It comes to the driver, as every tokenizer's vocabulary does: more than `MAX_VOCABULARY` pieces are refused.
    """
    word = F.explode(word_list(F.col(content)))
    words = rows.select(word.alias("w")).distinct()
    heads = F.transform(F.sequence(F.lit(1), F.least(F.lit(start), F.length("w"))), lambda n: F.substring("w", F.lit(1), n))
    size = F.length("w")
    parts = F.flatten(F.transform(
        F.sequence(F.lit(2), size), lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(inner), size - i + 1)), lambda n: F.concat(F.lit(INNER), F.substring("w", i, n)))
    ))
    own = F.concat(heads, F.when(size <= whole, F.array("w")).otherwise(F.array()), F.when(size > 1, parts).otherwise(F.array().cast("array<string>")))
    pieces = words.select(F.explode(own).alias("piece")).distinct()
    found = [r["piece"] for r in pieces.limit(MAX_VOCABULARY + 1).collect()]
    if len(found) > MAX_VOCABULARY:
        raise ValueError(f"more than {MAX_VOCABULARY} pieces")
    return [*SPECIAL, *sorted(set(found) - set(SPECIAL))]


def with_pieces(df: DataFrame, content: str, vocabulary: list[str], max_len: int = MAX_LEN) -> DataFrame:
    """df with n_pieces (of the whole text), n_unknown, truncated, and input_ids as a model gets them.

    input_ids begins with [CLS], ends with [SEP] and has at most `max_len` tokens. A null or
    blank text has these two alone.
    """
    sent = df.sparkSession.sparkContext.broadcast(vocabulary)
    key = f"pieces-{uuid.uuid4().hex}"

    @F.pandas_udf("n_pieces long, n_unknown long, truncated boolean, input_ids array<int>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tokenizer = _loaded(key, lambda: WordPieces(sent.value))
        for batch in batches:
            ids, sizes = tokenizer.sequences(pa.array(batch, pa.list_(pa.string())))
            ends = np.cumsum(sizes)
            rows = [ids[e - n : e] for e, n in zip(ends, sizes)]
            yield pd.DataFrame({
                "n_pieces": sizes,
                "n_unknown": [int((r == tokenizer.number[UNKNOWN]).sum()) for r in rows],
                "truncated": sizes > max_len - 2,
                "input_ids": [model_input(tokenizer, r, max_len) for r in rows],
            })

    return df.withColumn("_pieces", cut(word_list(F.col(content)))).select(*df.columns, "_pieces.*")


def model_input(tokenizer: WordPieces, pieces: np.ndarray, max_len: int) -> np.ndarray:
    return np.concatenate([[tokenizer.number[START]], pieces[: max_len - 2], [tokenizer.number[STOP]]]).astype(np.int32)


# --- encoder --------------------------------------------------------------------------


@dataclass
class Encoder:
    """A transformer encoder with a pooled first token, from named weights.

    Names: embed.word, embed.place, embed.norm.{scale,shift}; for each layer i
    layer.i.{query,key,value,out,up,down}.{w,b} and layer.i.norm{1,2}.{scale,shift};
    pool.{w,b}; heads (a number); head.{w,b} with two rows, negative and positive; and
    vocabulary, the pieces in order.
    """

    weights: dict[str, np.ndarray]

    def __post_init__(self) -> None:
        self.heads = int(self.weights["heads"])
        self.layers = len({k.split(".")[1] for k in self.weights if k.startswith("layer.")})

    def _norm(self, x: np.ndarray, name: str) -> np.ndarray:
        x = x - x.mean(-1, keepdims=True)
        x /= np.sqrt((x * x).mean(-1, keepdims=True) + 1e-12)
        return x * self.weights[f"{name}.scale"] + self.weights[f"{name}.shift"]

    def _dense(self, x: np.ndarray, name: str) -> np.ndarray:
        return x @ self.weights[f"{name}.w"].T + self.weights[f"{name}.b"]

    def pooled(self, ids: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """One row for each sequence; places where `mask` is 0 have no influence."""
        w = self.weights
        rows, length = ids.shape
        x = self._norm(w["embed.word"][ids] + w["embed.place"][:length], "embed.norm")
        hidden = np.where(mask[:, None, None, :] > 0, np.float32(0), np.float32(-1e9))
        split = lambda y: y.reshape(rows, length, self.heads, -1).transpose(0, 2, 1, 3)
        for i in range(self.layers):
            q, k, v = (split(self._dense(x, f"layer.{i}.{n}")) for n in ("query", "key", "value"))
            weight = softmax(q @ k.transpose(0, 1, 3, 2) / np.float32(np.sqrt(q.shape[-1])) + hidden)
            mixed = (weight @ v).transpose(0, 2, 1, 3).reshape(rows, length, -1)
            x = self._norm(x + self._dense(mixed, f"layer.{i}.out"), f"layer.{i}.norm1")
            up = self._dense(x, f"layer.{i}.up")
            up *= 0.5 * (1 + np.tanh(np.float32(0.7978846) * (up + np.float32(0.044715) * up**3)))
            x = self._norm(x + self._dense(up, f"layer.{i}.down"), f"layer.{i}.norm2")
        return np.tanh(self._dense(x[:, 0], "pool"))

    def probability(self, ids: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """The softmax share of the positive class."""
        return softmax(self._dense(self.pooled(ids, mask), "head"))[:, 1]


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(-1, keepdims=True))
    return x / x.sum(-1, keepdims=True)


def padded(rows: list[np.ndarray], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequences as a rectangle, and 1 where a token is real."""
    length = max(map(len, rows))
    ids = np.full((len(rows), length), pad, np.int64)
    mask = np.zeros((len(rows), length), np.int8)
    for i, row in enumerate(rows):
        ids[i, : len(row)] = row
        mask[i, : len(row)] = 1
    return ids, mask


def by_length(rows: list[np.ndarray], work: Callable[[np.ndarray, np.ndarray], np.ndarray], pad: int, chunk: int = CHUNK) -> np.ndarray:
    """What `work` gives for each sequence; those of like length are computed together, so little is padding."""
    order = np.argsort([len(r) for r in rows], kind="stable")
    out: np.ndarray | None = None
    for a in range(0, len(order), chunk):
        of = order[a : a + chunk]
        got = work(*padded([rows[i] for i in of], pad))
        if out is None:
            out = np.empty((len(rows), *got.shape[1:]), np.float64)
        out[of] = got
    return np.zeros(0) if out is None else out


def seeded_weights(vocabulary: list[str], width: int = 32, layers: int = 1, heads: int = 2, max_len: int = MAX_LEN, seed: int = 7) -> dict[str, np.ndarray]:
    """An encoder drawn from a seed, with an even head: what `fit_head` starts from."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[-1])).astype(np.float32)
    out = {"vocabulary": np.array(vocabulary), "heads": np.array(heads), "embed.word": draw(len(vocabulary), width), "embed.place": draw(max_len, width) / 4}
    for name in ["embed.norm", *[f"layer.{i}.norm{k}" for i in range(layers) for k in (1, 2)]]:
        out[f"{name}.scale"], out[f"{name}.shift"] = np.ones(width, np.float32), np.zeros(width, np.float32)
    for i in range(layers):
        for name, rows, columns in [*[(n, width, width) for n in ("query", "key", "value", "out")], ("up", 4 * width, width), ("down", width, 4 * width)]:
            out[f"layer.{i}.{name}.w"], out[f"layer.{i}.{name}.b"] = draw(rows, columns), np.zeros(rows, np.float32)
    out["pool.w"], out["pool.b"] = draw(width, width), np.zeros(width, np.float32)
    out["head.w"], out["head.b"] = np.zeros((2, width), np.float32), np.zeros(2, np.float32)
    return out


# --- the model as a file, and scoring with it ------------------------------------------


def save_weights(spark: SparkSession, weights: dict[str, np.ndarray], path: str) -> None:
    """Write the weights as one file to any file system that Spark reaches."""
    with tempfile.TemporaryDirectory() as folder:
        local = os.path.join(folder, "weights.npz")
        np.savez(local, **weights)
        hadoop = spark._jvm.org.apache.hadoop.fs
        target = hadoop.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).copyFromLocalFile(False, True, hadoop.Path("file://" + local), target)


def load_weights(path: str) -> dict[str, np.ndarray]:
    with np.load(path, allow_pickle=False) as file:
        return {name: file[name] for name in file.files}


def send_weights(spark: SparkSession, path: str) -> str:
    """Have Spark bring the file to every executor, once; returns the name under which tasks find it."""
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def _model(name: str) -> tuple[WordPieces, Encoder]:
    weights = load_weights(SparkFiles.get(name))
    return WordPieces([str(p) for p in weights.pop("vocabulary")]), Encoder(weights)


def _applied(df: DataFrame, content: str, name: str, kind: str, work: str, max_len: int, out: str) -> DataFrame:
    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer, encoder = _loaded(f"text-model-{name}", lambda: _model(name))
        for batch in batches:
            ids, sizes = tokenizer.sequences(pa.array(batch, pa.list_(pa.string())))
            rows = [model_input(tokenizer, ids[e - n : e], max_len) for e, n in zip(np.cumsum(sizes), sizes)]
            yield pd.Series(list(by_length(rows, getattr(encoder, work), tokenizer.number[PAD])))

    # no more than max_len - 2 pieces count, so no more words are sent
    return df.withColumn(out, run(word_list(F.col(content), max_len - 2)))


def score_with_encoder(df: DataFrame, content: str, name: str, max_len: int = MAX_LEN, out: str = "prob") -> DataFrame:
    """df with the probability of the positive class; `name` is what `send_weights` gave.

    A null or blank text is scored as the sequence of [CLS] and [SEP] alone. Every row is
    scored by itself: its score does not depend on the rows it is padded with.
    """
    return _applied(df, content, name, "double", "probability", max_len, out)


def fit_head(labelled: DataFrame, content: str, label: str, weights_path: str, out_path: str, max_len: int = MAX_LEN) -> None:
    """Train the head on labelled rows over the fixed encoder of one file, and save all weights as another."""
    spark = labelled.sparkSession
    name = send_weights(spark, weights_path)
    rows = labelled.filter(F.col(label).isNotNull())
    pooled = _applied(rows, content, name, "array<double>", "pooled", max_len, "_pooled")
    fitted = LogisticRegression(featuresCol="_vector", labelCol=label, maxIter=30, regParam=0.01).fit(
        pooled.select(array_to_vector("_pooled").alias("_vector"), F.col(label).cast("double").alias(label))
    )
    weights = load_weights(SparkFiles.get(name))
    half = np.asarray(fitted.coefficients.toArray(), np.float32) / 2
    # softmax over two rows: their difference decides
    weights["head.w"] = np.stack([-half, half])
    weights["head.b"] = np.array([-fitted.intercept / 2, fitted.intercept / 2], np.float32)
    save_weights(spark, weights, out_path)
