"""Operators on awkward rows, and the queries that SQL cannot express against plain Python."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from shelfgrain.llm import byte_bpe, fingerprints, kd_shards, line_dedup, line_rules, mixing, ngram_lm, quality, queries, similarity_join, toxicity

FOLDER = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 997}" for i in range(30_000)) + "."
# clashing names on purpose
SCHEMA = "doc_id long, text string, source string, lang string, id string, node long, key string, row int, size int, ld_id int, _ld_id int, mix_key int, join_gone int, n_lines string"


@pytest.fixture(scope="module")
def odd(spark):
    same = "the same text in several rows that is long enough to have some shingles. it ends here."
    texts = [None, "", " \t\n ", "one", "two words", same, same, same, LONG, LONG.replace("word7 ", "other "), "a\n\nb\n\n", "x" * 5000, "Ünïcödé 漢字 😀 text.\nline"]
    rows = [(i, t, [None, "s1", "s2"][i % 3], "en" if i % 2 else None) for i, t in enumerate(texts)]
    rows += [(5, same, "s2", "en"), (5, same, "s2", "en"), (None, same, None, None), (None, None, None, None), (None, "null id " * 60, "s1", "en")]
    return spark.createDataFrame([(*r, "c", 1, "c", 1, 1, 1, 1, 1, 1, "c") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def few_labels(spark):
    return spark.createDataFrame([(3, 1, 0), (5, 1, 0), (5, 0, 1), (8, 0, None), (12, None, 1), (99, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in queries.documents(spark, FOLDER).collect()}


@pytest.fixture(scope="module")
def sources(spark):
    return {r["doc_id"]: r["source"] for r in queries.documents(spark, FOLDER).collect()}


def ids(rows, name="doc_id"):
    return Counter(r[name] for r in rows)


def operators(spark, labels):
    anything = F.lit(True)
    return {
        "bloom_lm": lambda d: ngram_lm.score_texts(d, F.coalesce(F.col("doc_id"), F.lit(0)) % 2 == 0),
        "mixing": mixing.mix,
        "toxicity": lambda d: toxicity.score(d, toxicity.fit(d, labels, anything)),
        "line_dedup": line_dedup.dedup_lines,
        "byte_bpe": lambda d: byte_bpe.encode_texts(d, *queries.byte_vocabulary()),
        "quality": lambda d: quality.quality_scores(d, labels, anything),
        "line_rules": line_rules.clean_by_lines,
        "jaccard": similarity_join.similar_documents,
        "fingerprints": fingerprints.compare_edited,
        "kd_shards": kd_shards.kd_shards,
    }


@pytest.mark.parametrize("name", ["bloom_lm", "mixing", "toxicity", "line_dedup", "byte_bpe", "quality", "line_rules", "jaccard", "fingerprints", "kd_shards"])
def test_every_row_has_its_result(spark, odd, few_labels, name):
    got = operators(spark, few_labels)[name](odd).collect()
    assert ids(got) == ids(odd.select("doc_id").collect())


@pytest.mark.parametrize("name", ["bloom_lm", "mixing", "toxicity", "line_dedup", "byte_bpe", "quality", "line_rules", "jaccard", "fingerprints", "kd_shards"])
def test_empty_tables(spark, odd, few_labels, name):
    assert operators(spark, few_labels.limit(0))[name](odd.limit(0)).collect() == []


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_the_columns(spark, odd, name, tmp_path):
    spark.createDataFrame([(3, 1, 0), (5, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for rows in (odd, odd.limit(0)):
        out = dict(corpus_pipeline.STAGES)[name](spark, rows, str(tmp_path))
        assert out.columns == odd.columns
        found = out.collect()
        assert found or rows is not odd
        assert {r["n_lines"] for r in found} <= {"c"}


# --- language model -------------------------------------------------------------------


def expected_scores(texts, train, prior=ngram_lm.PRIOR):
    end = b"\n"
    tokens = {i: t.encode().lower().split() + [end] for i, t in texts.items()}
    one, two = Counter(), Counter()
    for i, w in tokens.items():
        if train(i):
            one.update(w)
            two.update(zip([end, *w[:-1]], w))
    n, v = sum(one.values()), len(one)
    plain = lambda w: (one[w] + 1) / (n + v + 1)
    steps = ngram_lm.levels().tolist()
    below = lambda c: max([s for s in steps if s <= c], default=0)
    return n, {
        i: (len(w), sum(one[x] > 0 for x in w), sum(math.log10(plain(x)) for x in w),
            sum(math.log10((below(two[a, b]) + prior * plain(b)) / (one[a] + prior)) for a, b in zip([end, *w[:-1]], w)))
        for i, w in tokens.items()
    }


def held(i, mod, value):
    return zlib.crc32(str(i).encode()) % mod == value


@pytest.mark.parametrize("limits", [{}, {"block_bytes": 60_000, "max_filter_bytes": 30_000}])
def test_language_model(spark, texts, limits):
    n, want = expected_scores(texts, lambda i: not held(i, 7, 2))
    if limits:
        got = ngram_lm.score_texts(queries.documents(spark, FOLDER), queries.remainder(F.col("doc_id"), 7) != 2, **limits)
    else:
        got = queries.QUERIES["op1_bloom_lm"](spark, FOLDER)
    rows = got.collect()
    assert len(rows) == len(texts)
    off = []
    for r in rows:
        tokens, known, base, score = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (tokens, known, n)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        off.append((r["score"] - score) / tokens)
    # the filter errs upwards only, and rarely
    assert min(off) > -1e-9 and sum(off) / len(off) < 0.01
    if not limits:
        assert {r["doc_id"] for r in rows if r["held_out"]} == {i for i in texts if held(i, 7, 2)}
        assert sum(r["score"] for r in rows if r["held_out"]) > sum(r["base_score"] for r in rows if r["held_out"])


def test_blocks_are_bounded_and_ids_may_be_anything(spark, monkeypatch):
    """Short texts, then long ones side by side, one id that many rows share, and text ids: no task gets more than a few shares' bytes."""
    rows = [(i, f"short text {i}") for i in range(4000)] + [(5000 + i, " ".join(f"w{(i * 7 + k) % 50}" for k in range(1500))) for i in range(300)]
    rows += [(9999, f"the one id {i} " * 300) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    limit = 200_000
    merged = []
    dealt = ngram_lm._dealt
    monkeypatch.setattr(ngram_lm, "_dealt", lambda r, a, m, b: merged.append((dealt(r, a, m, b))) or merged[-1])
    got = {}
    for name, d in (("long", docs), ("string", docs.withColumn("doc_id", F.concat(F.lit("id "), "doc_id")))):
        found = ngram_lm.score_texts(d, F.lit(True), block_bytes=limit).collect()
        got[name] = Counter((str(r["doc_id"]).removeprefix("id "), r["n_tokens"], round(r["base_score"], 6), round(r["score"], 3)) for r in found)
        sizes = merged[-1][0].groupBy("block", "share").agg(F.sum(F.octet_length("text")).alias("n")).collect()
        assert len(sizes) > 10 and max(r["n"] for r in sizes) <= 2 * limit + 20_000
    assert got["long"] == got["string"] and sum(got["long"].values()) == len(rows)


# --- mixing ---------------------------------------------------------------------------


def test_targets_reach_a_level(spark):
    sizes = {"a": 100, "b": 5, "c": 700, "é": 0, "z": 50, None: 40}
    got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    order = sorted((s for s in sizes if s), key=lambda s: s.encode()) + [None]
    weight = {s: [5, 2, 1][i % 3] for i, s in enumerate(order)}
    full, goal = set(), 1.5 * sum(sizes.values())
    while True:
        level = (goal - sum(2 * sizes[s] for s in full)) / sum(weight[s] for s in sizes if s not in full)
        above = {s for s in sizes if s not in full and level * weight[s] > 2 * sizes[s]}
        if not above:
            break
        full |= above
    assert got == pytest.approx({s: 2 * sizes[s] if s in full else level * weight[s] for s in sizes})


def test_mixing(spark, texts, sources):
    rows = queries.QUERIES["op2_mixing"](spark, FOLDER).collect()
    again = queries.QUERIES["op2_mixing"](spark, FOLDER).collect()
    key = lambda r: (r["doc_id"], r["taken"])
    assert sorted(map(key, rows)) == sorted(map(key, again))
    taken, target = defaultdict(int), {}
    for r in rows:
        assert r["size"] == len(texts[r["doc_id"]].encode().split()) and 0 <= r["taken"] <= 2 * r["size"]
        taken[sources[r["doc_id"]]] += r["taken"]
        target[sources[r["doc_id"]]] = r["target"]
    assert math.isclose(sum(target.values()), 1.5 * sum(r["size"] for r in rows))
    assert all(abs(taken[s] - target[s]) <= 0.05 * target[s] + 30 for s in target)


def test_take_gives_as_many_rows(spark, odd):
    copies = sum(r["copies"] for r in mixing.mix(odd).collect())
    assert mixing.take(odd).count() == copies


def test_flight_over_many_tasks(spark):
    rows = spark.range(5000).select(
        F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"),
        (1 + F.col("id") % 17).cast("long").alias("size"), (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0).alias("draw"),
        (F.pmod(F.xxhash64(F.lit(3), F.col("id")), F.lit(1000)) / 1000.0).alias("coin"), F.lit(0.3).alias("chance"),
    )
    before = mixing.TASK_ROWS
    mixing.TASK_ROWS = 300
    try:
        got = rows.join(mixing.balanced_sample(rows, 5000), "row").groupBy("source").agg(F.sum("size").alias("size"), F.sum(F.col("size") * F.col("more")).alias("taken"), F.count("*").alias("n")).collect()
    finally:
        mixing.TASK_ROWS = before
    assert sum(r["n"] for r in got) == 5000
    assert all(abs(r["taken"] - 0.3 * r["size"]) < 5 for r in got)


# --- classifiers ----------------------------------------------------------------------


def auc(pairs):
    good, bad = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))


@pytest.mark.parametrize("name, label, mod, value, least", [("op6_quality", "quality", 5, 0, 0.95), ("op3_toxicity", "toxic", 4, 2, 0.85)])
def test_held_out_documents(spark, name, label, mod, value, least):
    folder = "/root/testdata/sf0.1"
    truth = {r["doc_id"]: r[label] for r in queries.labels(spark, folder).collect()}
    rows = queries.QUERIES[name](spark, folder).collect()
    assert all(r["held_out"] == held(r["doc_id"], mod, value) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    judged = [(r["score"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert auc(judged) > least
    assert sum((s >= 0.3) == y for s, y in judged) / len(judged) > 0.93


def test_offending_sentences(spark):
    clean = "alpha beta gamma. delta epsilon zeta."
    docs = spark.createDataFrame([(i, clean + (" you vileword here. eta theta." if i % 3 == 0 else " eta theta.")) for i in range(90)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    weights = toxicity.fit(docs, labels, F.lit(True))
    found = toxicity.offending(docs, weights).collect()
    assert {(r["doc_id"], r["number"], r["sentence"]) for r in found} == {(i, 2, "you vileword here.") for i in range(0, 90, 3)}


# --- lines, tokens --------------------------------------------------------------------


def test_line_dedup_definitions(spark):
    line = "A line of more than twenty characters"
    rows = [(1, f"{line}\nown"), (2, f"  {line.lower()}\t\n{line}\n"), (3, f"{line}\nx\n{line}"), (None, line), (4, None), (5, "short\nshort"), (6, "short"), (7, "short")]
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ("own", 2, 1), 2: ("", 3, 2), 3: (f"{line}\nx\n{line}", 3, 0), None: ("", 1, 1), 4: ("", 1, 0), 5: ("short\nshort", 2, 0), 6: ("short", 1, 0), 7: ("short", 1, 0)}


def test_byte_bpe(spark, texts):
    ranks, pattern = queries.byte_vocabulary()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = {}
    for i, text in texts.items():
        encoded = library.encode_ordinary(text)
        want[i] = (len(encoded), sha(",".join(map(str, encoded)).encode()), sha(text.encode()))
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in queries.QUERIES["op5_byte_bpe"](spark, FOLDER).collect()}
    assert got == want
    assert public_tokenizers.PATTERN == pattern


# --- similar documents ----------------------------------------------------------------


def shingles(text, width):
    w = text.encode().lower().split()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()}


def expected_classes(texts, width=4, percent=85):
    sets = {i: shingles(t, width) for i, t in texts.items()}
    up = {i: i for i in texts}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    keys = sorted(texts)
    for x, i in enumerate(keys):
        for j in keys[x + 1 :]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                up[b] = a
    return {i: (len(sets[i]), top(i)) for i in keys}


def chained(seed=1):
    """Groups of copies, chains of near copies, and a passage that many texts share."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    passage = [word() for _ in range(60)]
    out = []
    for size in (3, 5, 8, 15, 40, 90, 130, 260):
        base = [word() for _ in range(size)]
        for _ in range(12):
            out.append(" ".join(base))
            base = list(base)
            for _ in range(rng.randrange(0, max(2, size // 25))):
                base[rng.randrange(size)] = word()
        out += [out[-1].upper(), out[-1]]
    out += [" ".join([word() for _ in range(40)] + passage + [word() for _ in range(40)]) for _ in range(150)]
    rng.shuffle(out)
    return dict(enumerate(out))


@pytest.mark.parametrize("block, keys", [(1024, 4_000_000), (16, 50)])
def test_classes_are_exact(spark, monkeypatch, block, keys):
    monkeypatch.setattr(similarity_join, "BLOCK_NODES", block)
    monkeypatch.setattr(similarity_join, "RANGE_KEYS", keys)
    texts = chained()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in similarity_join.similar_documents(docs).collect()}
    assert got == expected_classes(texts)


def test_classes_join_over_several_rounds(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(100, 140)] + [(7, 3), (3, 9), (50, 51)], "a long, b long")
    got = {r["node"]: r["class"] for r in similarity_join.classes(links).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, 3: 3, 7: 3, 9: 3, 50: 50, 51: 50}


def test_one_of_each(spark):
    texts = chained()
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts.items()] + [(0, texts[0], "x"), (None, texts[0], "x")], "doc_id long, text string, other string")
    want = sorted(i for i, (_, c) in expected_classes(texts).items() if c == i)
    rows = similarity_join.one_of_each(docs).collect()
    assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) == want
    assert sum(r["doc_id"] is None for r in rows) == 1


def test_texts_that_share_an_id_are_told_apart(spark):
    a, b, c = ("a long enough text about %s that has quite a few words so that one of them may be changed without much harm done to it at all" % x for x in "abc")
    near = a[: -len("all")] + "most"
    b, c = " ".join(reversed(b.split())), " ".join(sorted(c.split()))
    rows = [(1, a), (2, a), (2, b), (3, c), (3, c), (3, near), (4, ""), (4, ""), (4, None), (5, b), (None, a), (None, a)]
    got = similarity_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"), threshold=Fraction(4, 5), width=5).collect()
    assert Counter(map(tuple, got)) == Counter([(1, a), (2, b), (3, c), (4, ""), (4, None), (None, a), (None, a)])


def test_removal_of_copies_moves_no_texts_by_window(spark):
    docs = queries.documents(spark, FOLDER)
    kept = similarity_join.one_of_each(docs)
    assert "Window" not in kept._jdf.queryExecution().optimizedPlan().toString()


def test_pairs_wait_within_a_bound_of_bytes(monkeypatch):
    """Wide bitmaps: a tile is compared when it ends, not when 50,000 rows have come."""
    monkeypatch.setattr(similarity_join, "BUFFER_BYTES", 1 << 16)
    width = similarity_join.LARGEST_BITMAP // 8
    rows = [(key, 0, 0, 0, key * 10 + k, key * 10 + k, 3, bytes(width)) for key in range(30) for k in range(3)]
    batches = [pa.RecordBatch.from_pylist([dict(zip(("key", "p", "q", "block", "node", "class", "n", "bitmap"), r)) for r in rows[a : a + 7]]) for a in range(0, len(rows), 7)]
    seen = []

    def fed():
        for batch in batches:
            seen.append(0)
            yield batch
    found = []
    for out in similarity_join._paired(Fraction(4, 5))(fed()):
        assert len(seen) < len(batches) or found
        found += list(zip(out["a"].to_pylist(), out["b"].to_pylist()))
    assert sorted(found) == sorted((k * 10 + i, k * 10 + j) for k in range(30) for i in range(3) for j in range(i + 1, 3))


def test_fingerprints(spark, texts):
    order = sorted(texts)
    rows = {r["doc_id"]: r for r in queries.QUERIES["op9_fingerprints"](spark, FOLDER).collect()}
    assert sorted(rows) == order
    same = defaultdict(set)
    for i, following in zip(order, order[1:] + order[:1]):
        changed = fingerprints.edited(texts[i], texts[following])
        r = rows[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(texts[i]), hashlib.sha256(changed.encode()).hexdigest())
        pairs = lambda x: [x[k : k + 4] for k in range(0, len(x), 4)]
        alike = lambda a, b: sum(x == y for x, y in zip(pairs(a), pairs(b))) / fingerprints.PERMUTATIONS
        assert math.isclose(r["near_edited"], alike(r["fingerprint"], r["edited_fingerprint"]))
        assert math.isclose(r["near_next"], alike(r["fingerprint"], rows[following]["fingerprint"]))
        same[texts[i]].add(r["fingerprint"])
    assert all(len(x) == 1 for x in same.values())
    assert sum(r["near_edited"] > r["near_next"] for r in rows.values()) > 0.95 * len(rows)


def test_fingerprints_over_many_runs(spark, texts, monkeypatch):
    one = {r["doc_id"]: r for r in fingerprints.compare_edited(queries.documents(spark, FOLDER)).collect()}
    monkeypatch.setattr(fingerprints, "RUN_BYTES", 4000)
    many = {r["doc_id"]: r for r in fingerprints.compare_edited(queries.documents(spark, FOLDER)).collect()}
    assert one == many


def test_near_duplicates(spark):
    rng = random.Random(9)
    base = [f"w{rng.randrange(3000)}" for _ in range(300)]
    texts = {1: base, 2: base[:150] + ["changed"] + base[151:], 3: base[:150] + [f"v{i}" for i in range(150)], 4: base, 5: [], 7: ["two", "words"], 8: ["two", "words"]}
    # copies that differ more from each other than from what they come from
    source = [f"u{rng.randrange(3000)}" for _ in range(200)]
    for i in range(20, 50):
        copy = list(source)
        for at in rng.sample(range(200), 3):
            copy[at] = f"x{rng.randrange(3000)}"
        texts[i] = copy
    texts[60] = source
    sets = {i: shingles(" ".join(w), 5) for i, w in texts.items()}
    rows = [(i, " ".join(w)) for i, w in texts.items()] + [(6, None), (None, " ".join(base))]
    got = {r["doc_id"]: r["component_id"] for r in fingerprints.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    reached = {i: i for i in texts}
    for _ in texts:
        for i in texts:
            for j in texts:
                if sets[i] and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                    reached[i] = min(reached[i], reached[j])
    assert got == {**reached, 6: 6, None: None}


# --- shards ---------------------------------------------------------------------------


def test_shards(spark, texts):
    rows = queries.QUERIES["op10_kd_shards"](spark, "/root/testdata/sf0.1").collect()
    size, slots, places = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in rows:
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        places[r["text_crc32"], r["size"]].add(r["shard"])
        assert r["law"] == "bytes" and r["grown_shard"] is None
    mean, largest = sum(size.values()) / 24, max(r["size"] for r in rows)
    assert sorted(size) == list(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(abs(s - mean) for s in size.values()) < 0.02 * mean + largest
    assert all(len(p) == 1 for p in places.values())
    small = {r["doc_id"]: r for r in queries.QUERIES["op10_kd_shards"](spark, FOLDER).collect()}
    assert {i: (r["size"], r["text_crc32"]) for i, r in small.items()} == {i: (len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in texts.items()}


def test_a_hot_value_and_hot_copies_are_cut(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the same text").otherwise(F.concat(F.lit("text "), F.col("id"))).alias("text"),
        F.lit("one").alias("source"), F.lit(None).cast("string").alias("lang"),
    )
    size = {r["shard"]: r["bytes"] for r in kd_shards.kd_shards(docs).groupBy("shard").agg(F.sum("size").alias("bytes")).collect()}
    mean = sum(size.values()) / 24
    assert len(size) == 24 and max(abs(s - mean) for s in size.values()) < 0.03 * mean


def test_shards_of_many_gigabytes(spark):
    """Rows of 2^34 bytes each fall where they fall with 2^5 bytes each: every figure of a cut is only scaled."""
    docs = spark.range(1000).select(
        F.col("id").alias("doc_id"), F.lpad(F.col("id").cast("string"), 24, "0").alias("text"),
        F.concat(F.lit("s"), F.col("id") % 7).alias("source"), F.concat(F.lit("l"), F.col("id") % 3).alias("lang"),
    )
    light = {r["doc_id"]: r for r in kd_shards.kd_shards(docs, row_bytes=8).collect()}
    heavy = {r["doc_id"]: r for r in kd_shards.kd_shards(docs, row_bytes=(1 << 34) - 24).collect()}
    assert {r["size"] for r in light.values()} == {1 << 5} and {r["size"] for r in heavy.values()} == {1 << 34}
    assert len(light) == 1000 and {i: (r["shard"], r["slot"]) for i, r in heavy.items()} == {i: (r["shard"], r["slot"]) for i, r in light.items()}
    counts = Counter(r["shard"] for r in heavy.values())
    assert sorted(counts) == list(range(24)) and all(40 <= n <= 43 for n in counts.values())


# --- pipeline -------------------------------------------------------------------------


def test_pipeline(spark, texts):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "n-gram Jaccard join", "mixing sources", "byte-level BPE"]
    docs, before = queries.documents(spark, FOLDER), None
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        rows = out.collect()
        if name == "quality classifier":
            good = {r["doc_id"] for r in quality.quality_scores(docs, queries.labels(spark, FOLDER), queries.remainder(F.col("doc_id"), 5) != 0).filter("score >= 0.3").collect()}
            assert {r["doc_id"] for r in rows} == good
        elif name == "line dedup":
            holders = defaultdict(set)
            key = lambda line: line.strip(" \t\n\x0b\x0c\r").encode().lower().decode()
            for i, text in before.items():
                for line in text.split("\n"):
                    holders[key(line)].add(i)
            gone = lambda i, k: len(k) >= 20 and len(holders[k]) >= 3 and max(holders[k]) != i
            assert {r["doc_id"]: r["text"] for r in rows} == {i: "\n".join(x for x in t.split("\n") if not gone(i, key(x))) for i, t in before.items()}
        elif name == "n-gram Jaccard join":
            assert sorted(r["doc_id"] for r in rows) == sorted(i for i, (_, c) in expected_classes(before, 5, 80).items() if c == i)
        elif name == "mixing sources":
            decided = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect() if r["copies"]}
            assert ids(rows) == Counter(decided)
        else:
            assert len(rows) == docs.count() and all(r["decoded_sha256"] == hashlib.sha256(before[r["doc_id"]].encode()).hexdigest() for r in rows)
            break
        assert out.columns == docs.columns
        before = {r["doc_id"]: r["text"] or "" for r in rows}
        docs = spark.createDataFrame(rows, out.schema)


def test_join_stage_takes_five_words_at_four_fifths(spark):
    """Copies with a replaced passage of 9 to 30 in 150 words, around a Jaccard of 0.8 on five words."""
    rng = random.Random(4)
    texts = {}
    for n in range(9, 31):
        base = [f"w{rng.randrange(4000)}" for _ in range(150)]
        texts[2 * n] = " ".join(base)
        texts[2 * n + 1] = " ".join(base[:60] + [f"x{rng.randrange(4000)}" for _ in range(n)] + base[60 + n :])
    sets = {i: shingles(t, 5) for i, t in texts.items()}
    linked = lambda i, j: 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])
    # links do not go beyond the pair, so a copy goes if it links with any smaller id
    want = [i for i in sorted(texts) if not any(linked(i, j) for j in texts if j < i)]
    assert want != sorted(i for i, (_, c) in expected_classes(texts).items() if c == i)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    stage = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"]
    assert sorted(r["doc_id"] for r in stage(spark, docs, FOLDER).collect()) == want


def test_a_long_text_does_not_end_the_toxicity_sample(spark):
    clean = "alpha beta gamma. delta epsilon zeta."
    docs = spark.createDataFrame([(i, clean + (" you vileword here." if i % 3 == 0 else " eta theta.")) for i in range(90)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    second = docs.orderBy(F.xxhash64("doc_id"), "doc_id").limit(2).collect()[1]["doc_id"]
    docs = docs.withColumn("text", F.when(F.col("doc_id") == second, F.concat("text", F.repeat(F.lit(" eta theta."), 500_000))).otherwise(F.col("text")))
    weights = toxicity.fit(docs, labels, F.lit(True), max_bytes=1 << 20)
    rows = docs.filter(F.col("doc_id") != second)
    found = {r["doc_id"]: r["score"] for r in toxicity.score(rows, weights).collect()}
    assert min(s for i, s in found.items() if i % 3 == 0) > 0.5 > max(s for i, s in found.items() if i % 3)
