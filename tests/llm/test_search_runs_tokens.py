"""Lexical search, periodic runs and token files against plain versions of themselves."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfgrain.llm import lexical_search, periodic_runs, queries, token_files

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, id string, n long, part int, rank int, item int, score long, hash int, n_words int, runs int, start string, block binary"
LOOP = " ".join(f"again{i % 7}" for i in range(9000))


@pytest.fixture(scope="module")
def odd(spark):
    same = "one two three four five " * 8
    texts = [None, "", " \t\n ", "one", same, same, LOOP, "x" * 5000, "Ünïcödé 漢字 😀 text.\nit's we'll  'so  \n\n", "_-!", "ONE one Two"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(4, same), (4, "another text of one"), (None, same), (None, None), (None, "one of none")]
    return spark.createDataFrame([(*r, "c", 1, 1, 1, 1, 1, 1, 1, 1, "c", b"c") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def description():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return file.read()


# --- lexical search -------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def expected_ranking(docs, items, top=10):
    """(item number, rank, id, score) from plain counting; docs and items are (id, text)."""
    split = lambda t: TERM.findall((t or "").translate(SMALL))
    bags = [(i, Counter(split(t))) for i, t in docs]
    length = sum(sum(b.values()) for _, b in bags)
    n_docs = sum(bool(b) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for k, (_, text) in enumerate(items):
        found = []
        for i, bag in bags:
            m = 10 + 90 * sum(bag.values()) * n_docs // max(length, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * m)) for t in set(split(text)) if bag[t])
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(k, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(found)[:top], 1)]
    return out


def test_search_on_odd_rows(spark, odd):
    asked = [(0, "one of two"), (1, None), (2, "!!"), (3, "漢字 again3 ONE"), (None, "text")]
    items = spark.createDataFrame([(*a, 1) for a in asked], "item_id long, text string, doc_id int")
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    for limit in (1 << 20, 5):
        got = lexical_search.search(odd, items, item_bytes=limit).collect()
        number = {a[0]: k for k, a in enumerate(asked)}
        assert sorted((number[r["item_id"]], r["rank"], r["score"]) for r in got) == sorted((k, rank, s) for k, rank, _, s in expected_ranking(docs, asked))
        assert Counter((number[r["item_id"]], r["doc_id"]) for r in got) == Counter((k, i) for k, _, i, _ in expected_ranking(docs, asked))


def test_search_of_nothing(spark, odd):
    items = spark.createDataFrame([("a", "one")], "item_id string, text string")
    assert lexical_search.search(odd.limit(0), items).collect() == []
    assert lexical_search.search(odd, items.limit(0)).collect() == []
    assert lexical_search.search(odd, items).schema["item_id"].dataType.simpleString() == "string"


def test_search_keeps_ids_of_classes_in_order(spark):
    """Thirty equal texts and a better one: a class gives its smallest ids, whatever their order in the table."""
    rows = [(i, "red fox") for i in random.Random(3).sample(range(100, 1000), 30)] + [(5000, "red red fox"), (1, "no colour at all")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = lexical_search.search(docs, spark.createDataFrame([(1, "red fox")], "item_id long, text string"))
    found = [r["doc_id"] for r in got.orderBy("rank").collect()]
    assert found == [i for _, _, i, _ in expected_ranking(rows, [(1, "red fox")])]


def test_equal_hashes_are_told_apart_by_the_bag(spark):
    bag = lambda *x: lexical_search.pack(np.array(x), np.ones(len(x), int))
    rows = [(1, 100, 7, bag(1, 2)), (2, 100, 7, bag(1, 3)), (3, 100, 7, bag(1, 2)), (4, 101, 7, bag(1, 2))]
    held = spark.createDataFrame(rows, "id long, m long, hash long, bag binary")
    assert sorted(r["ids"] for r in lexical_search._classes(held, 10).collect()) == [[1, 3], [2], [4]]


# --- periodic runs --------------------------------------------------------------------


def expected_runs(w, shortest=24, exponent=3):
    out = []
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            length = i - start + q
            own = w[start : i + q]
            if length >= max(shortest, exponent * q) and not any(own[d:] == own[: length - d] for d in range(1, q)):
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def with_loops(rng, n, letters):
    w = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        a, p = rng.randrange(n), rng.randint(1, 14)
        for i in range(a + p, min(n, a + rng.randrange(90))):
            w[i] = w[i - p]
    return w


@pytest.mark.parametrize("shortest, exponent", [(24, 3), (6, 2), (8, 4), (10, 3)])
def test_runs_of_strings(shortest, exponent):
    rng = random.Random(5)
    for _ in range(150):
        w = with_loops(rng, rng.randint(1, 150), rng.choice([1, 2, 3, 60]))
        want = expected_runs(w, shortest, exponent)
        code = np.array(w)
        assert [tuple(r) for r in periodic_runs.runs_of(code, shortest, exponent).tolist()] == want
        inside = []
        for _, begin, end in zip(*(x.tolist() for x in periodic_runs.stretches(code, np.array([len(w)]), shortest, exponent))):
            inside += [(begin + s, n, q) for s, n, q in periodic_runs.runs_of(code[begin:end], shortest, exponent).tolist()]
        assert sorted(inside, key=lambda r: (r[0], r[2])) == want


def test_common_prefixes():
    w = [1, 2, 1, 2, 2, 1, 2, 1, 2, 1]
    tree = periodic_runs.SuffixTree(w, 3)
    for i in range(len(w)):
        for j in range(i + 1, len(w) + 1):
            n = 0
            while j + n < len(w) and w[i + n] == w[j + n]:
                n += 1
            assert tree.common(np.array([i]), np.array([j]))[0] == n


def contract_row(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and w:
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]
    number = {x: i for i, x in enumerate(dict.fromkeys(w))}
    runs = expected_runs([number[x] for x in w])
    kept = [x for i, x in enumerate(w) if not any(s + q <= i < s + n for s, n, q in runs)]
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    first = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *first, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(kept)))


def test_runs_query(spark):
    texts = [r for r in queries.documents(spark, FOLDER).collect() if len((r["text"] or "").split()) < 900]
    assert len(texts) > 150
    got = {r["doc_id"]: tuple(r) for r in queries.QUERIES["op12_periodic_runs"](spark, FOLDER).collect()}
    want = [contract_row(r["doc_id"], r["text"]) for r in texts]
    assert [got[w[0]] for w in want] == want
    assert sum(w[1] > 0 for w in want) > 5


def test_runs_on_odd_rows(spark, odd):
    found = periodic_runs.periodic_runs(odd).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r["doc_id"] for r in odd.collect())
    by_id = {r["doc_id"]: r for r in found if r["doc_id"] not in (None, 4)}
    assert [tuple(x) for x in by_id[6]["runs"]] == [(0, 9000, 7)] and len(by_id[6]["collapsed"].split()) == 7
    assert [tuple(x) for x in by_id[5]["runs"]] == [(0, 40, 5)]
    assert by_id[0]["collapsed"] == by_id[2]["collapsed"] == "" and by_id[0]["n_words"] == 0
    assert periodic_runs.periodic_runs(odd.limit(0)).collect() == []
    best = periodic_runs.periodic_runs(odd).select(periodic_runs.strongest().alias("b"), F.size("runs").alias("n")).collect()
    assert all((r["b"] is None) == (r["n"] == 0) for r in best)


# --- token files ----------------------------------------------------------------------


def test_pieces_are_encoded_as_whole_texts_are(description):
    encoder, whole = token_files.PieceEncoder(description), Tokenizer.from_str(description)
    whole.encode_special_tokens = True
    assert encoder.by_piece
    rng = random.Random(8)
    parts = [*"ab zZ09'!?.,  \n\n\t\rstmdrevl'", "é", "漢", "😀", " ", "　", " ", "\x85", "\x1c", "٣", "½", "́", "'s", "'re", "'ll", "<|endoftext|>", "\x00"]
    for _ in range(120):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(rng.randint(1, 20))]
        ids, counts = encoder.encode(pa.array(texts, pa.string()))
        want = [[*e.ids, token_files.END_ID] for e in whole.encode_batch(texts, add_special_tokens=False)]
        assert counts.tolist() == list(map(len, want)) and ids.tolist() == [t for w in want for t in w]


def test_memory_of_pieces_is_bounded(description):
    small, large = token_files.PieceEncoder(description, room=2000), token_files.PieceEncoder(description)
    for k in range(5):
        texts = pa.array([f"some{k} words{k} here {i}" for i in range(50)], pa.string())
        assert small.encode(texts)[0].tolist() == large.encode(texts)[0].tolist()
    assert len(small._number) < len(large._number)


def test_pieces_of_several_slices_are_encoded_once(description):
    """Pieces are found for a group of slices and stay known at a few bytes each; alone, joined and as a group they give the same ids."""
    slices = [pa.array([f"w{i}x é漢 don't" for i in range(k, k + 4000)], pa.string()) for k in (0, 2000, 100_000)]
    slices[1:1] = [pa.array([], pa.string()), pa.array(["", ""], pa.string())]
    encoder, alone, unjoined = (token_files.PieceEncoder(description, room=2 << 20) for _ in range(3))
    assert encoder._between
    unjoined._between = None
    asked = []
    found = encoder._learn
    encoder._learn = lambda pieces: asked.append(len(pieces) - len(encoder._number)) or found(pieces)
    group = [(ids.tolist(), counts.tolist()) for ids, counts in encoder.encode_group(slices)]
    again = [(ids.tolist(), counts.tolist()) for ids, counts in encoder.encode_group(slices[::-1])]
    assert again[::-1] == group and asked[0] == len(encoder._number) > 6_000 and asked[1] == 0
    whole = Tokenizer.from_str(description)
    for texts, (ids, counts) in zip(slices, group):
        assert ids == [t for x in texts.to_pylist() for t in [*whole.encode(x, add_special_tokens=False).ids, token_files.END_ID]] and len(counts) == len(texts)
        for other in (alone, unjoined):
            own = other.encode(texts)
            assert own[0].tolist() == ids and own[1].tolist() == counts


@pytest.mark.parametrize("n", [0, 1, 63, 65, 5000, 200_000])
@pytest.mark.parametrize("kinds", [1, 3, 5000])
def test_blocks_round_trip(n, kinds):
    ids = np.minimum((np.random.default_rng(n).pareto(0.8, n) * 3).astype(np.int64), kinds - 1)
    table = token_files.frequency_table(*np.unique(ids, return_counts=True))
    assert n == 0 or table.freqs.sum() == 1 << table.bits
    for steps in (2, 256):
        block = token_files.encode_block(ids, table, check_steps=steps)
        assert token_files.decode_block(block, table).tolist() == ids.tolist()
    if n == 200_000 and kinds > 1:
        share = table.freqs / table.freqs.sum()
        assert len(token_files.encode_block(ids, table)) < 1.05 * n * float(-(share * np.log2(share)).sum()) / 8 + 40_000


def test_damage_is_found():
    ids = np.arange(5000) % 50
    table = token_files.frequency_table(*np.unique(ids, return_counts=True))
    block = bytearray(token_files.encode_block(ids, table))
    block[-9] ^= 4
    with pytest.raises(ValueError):
        token_files.decode_block(bytes(block), table)


def test_frequencies_of_many_rare_ids():
    ids = np.arange(60_000)
    counts = np.ones(60_000, int)
    counts[7] = 10**12
    table = token_files.frequency_table(ids, counts)
    assert table.freqs.min() == 1 and table.freqs.sum() == 1 << table.bits and table.freqs.argmax() == 7


def expected_tokens(rows, description):
    whole = Tokenizer.from_str(description)
    whole.encode_special_tokens = True
    return [(i, [*whole.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in rows]


def test_token_files_query(spark, description):
    rows = sorted((r["doc_id"], r["text"]) for r in queries.documents(spark, FOLDER).collect())
    start, want = 0, []
    for i, ids in expected_tokens(rows, description):
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = queries.QUERIES["op13_token_files"](spark, FOLDER).collect()
    assert sorted(map(tuple, got)) == want


def test_token_files_of_odd_rows(spark, odd, description):
    path = token_files.token_file_path(spark)
    token_files.write_tokens(odd, description, path, part_bytes=2000)
    got = sorted(token_files.read_tokens(spark, path).collect(), key=lambda r: r["start"])
    want = expected_tokens([(r["doc_id"], r["text"]) for r in odd.collect()], description)
    assert Counter((r["doc_id"], tuple(r["tokens"])) for r in got) == Counter((i, tuple(t)) for i, t in want)
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1].tolist()]
    numbers = [r["doc_id"] for r in got]
    assert numbers == sorted(numbers, key=lambda i: (i is None, i or 0))


def test_token_files_of_nothing_and_of_text_ids(spark, odd, description):
    path = token_files.token_file_path(spark)
    token_files.write_tokens(odd.limit(0), description, path)
    assert token_files.read_tokens(spark, path).collect() == []
    path = token_files.token_file_path(spark)
    token_files.write_tokens(spark.createDataFrame([("b", "two words"), ("a", None)], "doc_id string, text string"), description, path)
    assert [r["doc_id"] for r in sorted(token_files.read_tokens(spark, path).collect(), key=lambda r: r["start"])] == ["a", "b"]
