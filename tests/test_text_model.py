"""Word pieces, the encoder and trained scorers against plain versions and held-out labels."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfgrain.operators import scoring, text_model
from shelfgrain.suite import scores
from shelfgrain.suite import views as v

FOLDER = "/root/testdata/sf0.001"


def plain_cut(word, vocabulary):
    """Longest piece first, by trying all ends."""
    out, at = [], 0
    while at < len(word):
        for end in range(len(word), at, -1):
            piece = ("##" if at else "") + word[at:end]
            if piece in vocabulary:
                out.append(piece)
                at = end
                break
        else:
            return ["[UNK]"]
    return out


def test_pieces_are_the_longest_that_fit():
    rng = random.Random(4)
    pieces = {"".join(rng.choice("abéd") for _ in range(rng.randint(1, 4))) for _ in range(40)}
    vocabulary = [*text_model.SPECIAL, *sorted({p if rng.random() < 0.5 else "##" + p for p in pieces})]
    tokenizer = text_model.WordPieces(vocabulary)
    for _ in range(2000):
        word = "".join(rng.choice("abédc") for _ in range(rng.randint(1, 9)))
        assert [vocabulary[i] for i in tokenizer.cut(word)] == plain_cut(word, set(vocabulary) - set(text_model.SPECIAL)), word
    assert tokenizer.cut("a" * 101) == [1]


def test_sequences_of_lists():
    tokenizer = text_model.WordPieces([*text_model.SPECIAL, "a", "##b", "c"])
    ids, sizes = tokenizer.sequences(pa.array([["ab", "c"], [], ["x"], ["c", "ab", "ab"]], pa.list_(pa.string())))
    assert ids.tolist() == [4, 5, 6, 1, 6, 4, 5, 4, 5] and sizes.tolist() == [3, 0, 1, 5]
    assert text_model.WordPieces([*text_model.SPECIAL]).sequences(pa.array([[]], pa.list_(pa.string())))[1].tolist() == [0]


def test_a_vocabulary_needs_its_special_pieces():
    with pytest.raises(ValueError):
        text_model.WordPieces(["a", "b"])


def test_inputs_of_odd_texts(spark):
    vocabulary = [*text_model.SPECIAL, "!", "a", "##b", "ab"]
    rows = spark.createDataFrame([(1, None), (2, " \n"), (3, "AB a!"), (4, "ab " * 500), (5, "zz")], "id int, content string")
    got = {r["id"]: r for r in text_model.with_pieces(rows, "content", vocabulary, 8).collect()}
    assert got[1]["input_ids"] == got[2]["input_ids"] == [2, 3] and got[1]["n_pieces"] == 0
    assert got[3]["input_ids"] == [2, 7, 5, 4, 3]
    assert got[4]["n_pieces"] == 500 and got[4]["truncated"] and got[4]["input_ids"] == [2, 7, 7, 7, 7, 7, 7, 3]
    assert got[5]["n_unknown"] == 1
    assert text_model.with_pieces(rows.limit(0), "content", vocabulary).collect() == []


def plain_pooled(w, ids):
    """The encoder for one sequence, place by place."""
    norm = lambda x, n: (x - x.mean()) / math.sqrt(((x - x.mean()) ** 2).mean() + 1e-12) * w[f"{n}.scale"] + w[f"{n}.shift"]
    dense = lambda x, n: w[f"{n}.w"] @ x + w[f"{n}.b"]
    gelu = lambda x: 0.5 * x * (1 + np.tanh(0.7978846 * (x + 0.044715 * x**3)))
    x = [norm(w["embed.word"][t] + w["embed.place"][i], "embed.norm") for i, t in enumerate(ids)]
    heads = int(w["heads"])
    for k in range(2):
        q, key, val = ([np.split(dense(y, f"layer.{k}.{n}"), heads) for y in x] for n in ("query", "key", "value"))
        after = []
        for i in range(len(x)):
            mixed = []
            for h in range(heads):
                weight = np.array([math.exp(q[i][h] @ key[j][h] / math.sqrt(len(q[i][h]))) for j in range(len(x))])
                mixed.append(sum(a * val[j][h] for j, a in enumerate(weight / weight.sum())))
            y = norm(x[i] + dense(np.concatenate(mixed), f"layer.{k}.out"), f"layer.{k}.norm1")
            after.append(norm(y + dense(gelu(dense(y, f"layer.{k}.up")), f"layer.{k}.down"), f"layer.{k}.norm2"))
        x = after
    return np.tanh(dense(x[0], "pool"))


def test_forward_pass_and_padding():
    weights = text_model.seeded_weights([*text_model.SPECIAL, *"abcdefgh"], width=8, layers=2, heads=2, max_len=20)
    weights["head.w"] = np.random.default_rng(1).standard_normal((2, 8)).astype(np.float32)
    encoder = text_model.Encoder({k: x for k, x in weights.items() if k != "vocabulary"})
    rng = np.random.default_rng(2)
    rows = [rng.integers(2, 12, rng.integers(2, 20)) for _ in range(70)]
    got = text_model.by_length(rows, encoder.pooled, 0)
    want = np.array([plain_pooled(weights, r) for r in rows])
    assert np.abs(got - want).max() < 1e-4
    share = text_model.by_length(rows, encoder.probability, 0, chunk=7)
    logits = want @ weights["head.w"].T
    assert np.abs(share - 1 / (1 + np.exp(logits[:, 0] - logits[:, 1]))).max() < 1e-4


def test_saved_encoder_scores_as_the_file_says(spark):
    path = scores.trained_encoder(spark, FOLDER)
    name = text_model.send_weights(spark, path)
    rows = spark.createDataFrame([(1, None), (2, "the thing of it"), (3, "the thing of it"), (4, "word " * 4000)], "id int, content string")
    got = {r["id"]: r["prob"] for r in text_model.score_with_encoder(rows, "content", name).collect()}
    weights = text_model.load_weights(path)
    tokenizer = text_model.WordPieces([str(p) for p in weights["vocabulary"]])
    encoder = text_model.Encoder({k: x for k, x in weights.items() if k != "vocabulary"})
    for i, words in ((1, []), (2, "the thing of it".split()), (4, ["word"] * 4000)):
        pieces = np.array([p for w in words for p in tokenizer.cut(w)], np.int64)
        ids = text_model.model_input(tokenizer, pieces, text_model.MAX_LEN)
        assert abs(encoder.probability(ids[None, :].astype(np.int64), np.ones((1, len(ids)), np.int8))[0] - got[i]) < 1e-5
    assert abs(got[2] - got[3]) < 1e-6


def auc(pairs):
    ordered = sorted(pairs)
    ranks = [i for i, (_, y) in enumerate(ordered, 1) if y == 1]
    n, m = len(ranks), len(ordered) - len(ranks)
    return (sum(ranks) - n * (n + 1) / 2) / (n * m)


def test_trained_models_tell_held_out_labels_apart(spark, tmp_path):
    folder = "/root/testdata/sf0.1"
    labels = v.table(spark, folder, "labels").select("doc_id", F.col("quality").cast("double").alias("quality")).filter("quality IS NOT NULL")
    rows = v.reviews(spark, folder).select("doc_id", "content").join(labels, "doc_id")
    learn, test = rows.filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 0), rows.filter(F.crc32(F.col("doc_id").cast("string")) % 3 == 0)
    found = lambda scored: auc([(r["prob"], r["quality"]) for r in scored.select("prob", "quality").collect()])
    model = scoring.fit_text_model(learn, "content", "quality", str(tmp_path / "model"))
    assert found(scoring.score_with_model(test, model)) > 0.9
    start, trained = str(tmp_path / "start-weights.npz"), str(tmp_path / "held-out-weights.npz")
    vocabulary = text_model.piece_vocabulary(v.table(spark, folder, "benchmark"), "text")
    text_model.save_weights(spark, text_model.seeded_weights(vocabulary), start)
    text_model.fit_head(learn, "content", "quality", start, trained)
    assert found(text_model.score_with_encoder(test, "content", text_model.send_weights(spark, trained))) > 0.8


def test_token_scores_belong_to_rows(spark):
    odds = spark.createDataFrame([("good", 1.0), ("bad", -1.0)], "token string, odds double")
    rows = spark.createDataFrame([("u1", "good"), ("u1", "bad"), (None, "good good"), (None, None), ("u2", "other"), ("u2", "Bad good bad")], "uid string, content string")
    got = sorted((str(r["uid"]), str(r["content"]), round(r["prob"], 4)) for r in scoring.score_by_tokens(rows, "content", odds).collect())
    high = round(1 / (1 + math.exp(-1)), 4)
    assert got == sorted([("u1", "good", high), ("u1", "bad", round(1 - high, 4)), ("None", "good good", high), ("None", "None", 0.5), ("u2", "other", 0.5), ("u2", "Bad good bad", 0.5)])
    assert scoring.score_by_tokens(rows.limit(0), "content", odds).collect() == []
