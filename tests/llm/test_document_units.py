"""The parts of the operators that need no Spark, against plain definitions."""

import base64
import math
import random
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfgrain.llm import byte_bpe, fingerprints, line_rules, mixing, ngram_lm, quality, similarity_join, toxicity
from shelfgrain.llm.common import words

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = byte_bpe.read_ranks(PATH)
ENCODER = byte_bpe.Encoder(RANKS, public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ODD = " \t\n\x0b\x0c\r\x1c\x85  　'’stllre09½٠.,;!#|éßñçÉ漢😀aAzZ"


def test_ranks_are_read():
    with open(PATH, "rb") as file:
        first = file.readline().split()
    assert RANKS[base64.b64decode(first[0])] == int(first[1])


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=ODD, max_size=40) | st.text(max_size=30))
def test_encoding_is_the_librarys(text):
    ids = ENCODER.encode(text)
    assert ids == LIBRARY.encode_ordinary(text)
    assert ENCODER.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 3000, "ab" * 900, "é" * 500, " " * 700, "\n" * 300, "x " * 400, "0123456789" * 200, "'s't're'll" * 50])
def test_long_pieces(text):
    assert ENCODER.encode(text) == LIBRARY.encode_ordinary(text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(sorted(RANKS)), min_size=1, max_size=6), st.integers(0, 60), st.integers(0, 60), st.binary(max_size=12))
def test_prefix_table_after_appends_and_edits(tokens, start, length, new):
    table = byte_bpe.PrefixTable(ENCODER.vocabulary)
    for token in tokens:
        table.append(token)
    assert table.last == byte_bpe.PrefixTable(ENCODER.vocabulary, b"".join(tokens)).last
    start = min(start, len(table.data))
    stop = min(start + length, len(table.data))
    table.edit(start, stop, new)
    assert table.last == byte_bpe.PrefixTable(ENCODER.vocabulary, table.data).last


def test_edit_near_the_front_leaves_the_rest():
    data = b"the quick brown fox jumps over the lazy dog " * 50
    table = byte_bpe.PrefixTable(ENCODER.vocabulary, data)
    assert table.edit(10, 12, b"xyz") < 200
    assert table.last == byte_bpe.PrefixTable(ENCODER.vocabulary, table.data).last


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=ODD, max_size=60), st.lists(st.tuples(st.integers(0, 60), st.integers(0, 10), st.text(alphabet=ODD, max_size=8)), max_size=4))
def test_encoded_text_after_edits(text, edits):
    held = byte_bpe.EncodedText(ENCODER, text)
    for start, length, new in edits:
        start = min(start, len(held.text))
        held.edit(start, min(start + length, len(held.text)), new)
        assert held.tokens() == LIBRARY.encode_ordinary(held.text)
    held.append(" 'l")
    held.append("l end")
    assert held.tokens() == LIBRARY.encode_ordinary(held.text)


def test_words_are_those_of_the_pattern():
    import re

    texts = [" a\x0bB\x0c c\x1cd\x85e ", "", "  ", "x", "É é\tA-Z\r\n"]
    parts, code, counts = words(pa.array(texts), lower=False)
    assert [parts[i].as_py() for i in code] == [w for t in texts for w in re.findall(r"[^\x20\x09-\x0D]+", t)]
    assert counts.tolist() == [len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in texts]


def brute_set(text, width):
    w = text.encode().lower().split()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()}


def test_shingle_sets():
    texts = ["a b c d e a b c d", "a b", "", " ", "A B c D", "x y z w x y z w"]
    values, counts = similarity_join.shingle_sets(pa.array(texts))
    assert counts.tolist() == [len(brute_set(t, 4)) for t in texts]
    assert len(set(values.tolist())) == len(set().union(*[brute_set(t, 4) for t in texts]))


@pytest.mark.parametrize("threshold", [Fraction(1, 5), Fraction(1, 2), Fraction(3, 5), Fraction(4, 5)])
def test_sets_share_a_key_at_any_threshold(threshold):
    rng = random.Random(5)
    bands = similarity_join.Bands(threshold)
    for small in range(4, 60):
        largest = int(small / threshold)
        for large in {max(small + 1, largest - 2), max(small + 1, largest)}:
            if not similarity_join.reach(threshold, small, small + large):
                continue
            whole = [rng.getrandbits(64) for _ in range(large)]
            values = np.concatenate([np.sort(np.array(whole[:n], np.uint64)) for n in (small, large)])
            keys, owner = similarity_join.part_keys(values, np.array([small, large]), bands)
            assert set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist()), (small, large)


def test_bands_of_the_registered_thresholds_stay():
    for threshold in (similarity_join.THRESHOLD, Fraction(4, 5)):
        starts = similarity_join.Bands(threshold).starts.tolist()
        assert all(b == max(a + 1, int(a * similarity_join.GROWTH)) for a, b in zip(starts, starts[1:]))


def test_similar_sets_always_share_a_key():
    rng = random.Random(3)
    bands = similarity_join.Bands(similarity_join.THRESHOLD)
    for _ in range(400):
        size = rng.choice([4, 6, 7, 9, 14, 22, 30, 60, 200])
        one = {rng.getrandbits(64) for _ in range(size)}
        other = set(one)
        while True:  # change as much as the threshold allows
            further = set(other)
            if rng.random() < 0.5 and len(further) > 1:
                further.discard(rng.choice(sorted(further)))
            if rng.random() < 0.6:
                further.add(rng.getrandbits(64))
            if 100 * len(one & further) < 85 * len(one | further):
                break
            other = further
        if one == other:
            continue
        values = np.concatenate([np.sort(np.array(list(s), np.uint64)) for s in (one, other)])
        keys, owner = similarity_join.part_keys(values, np.array([len(one), len(other)]), bands)
        assert set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist()), (len(one), len(other))


def test_bitmaps_bound_the_overlap():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(1, 400))
        one = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        other = np.unique(np.concatenate([one[rng.random(len(one)) < rng.random()], rng.integers(0, 2**63, int(rng.integers(1, 200)), dtype=np.uint64)]))
        a, b = (np.frombuffer(x, np.uint64) for x in similarity_join.bitmaps(np.concatenate([one, other]), np.array([len(one), len(other)])))
        assert similarity_join.most_overlap(a, b, len(one), len(other)) >= len(np.intersect1d(one, other))


def test_signatures_do_not_depend_on_the_slice():
    texts = [" ".join(f"w{(i * j) % 97}" for j in range(n)) for i, n in enumerate([0, 1, 3, 5, 400, 9000, 2, 0, 50], 2)]
    together = fingerprints.fingerprints_of(pa.array(texts))
    for text, row in zip(texts, together):
        assert (fingerprints.fingerprints_of(pa.array([text]))[0] == row).all()


def test_signature_estimates_jaccard():
    one = [f"w{i}" for i in range(2000)]
    other = one[:1500] + [f"x{i}" for i in range(500)]
    a, b = fingerprints.fingerprints_of(pa.array([" ".join(one), " ".join(other)]))
    assert abs((a == b).mean() - 0.6) < 0.15


def test_log_frequency_filter_counts_from_below():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 2**63, 30_000, dtype=np.uint64))
    counts = np.maximum(1, rng.pareto(1.0, len(keys)) * 3).astype(np.int64)
    ranges = 3
    at = ngram_lm.range_numbers(keys, ranges)
    pages = [ngram_lm.filter_page(keys[at == r] & np.uint64(0xFFFFFFFF), counts[at == r])[0] for r in range(ranges)]
    model = ngram_lm.Filter(ranges, 0, np.array([8 * len(p) for p in pages]), np.concatenate(pages))
    found, steps = model.counts(keys), ngram_lm.levels()
    exact = steps[np.searchsorted(steps, counts, side="right") - 1]
    assert (found >= exact).all() and (found == exact).mean() > 0.98
    unseen = np.setdiff1d(rng.integers(0, 2**63, 20_000, dtype=np.uint64), keys)
    assert (model.counts(unseen) > 0).mean() < 0.03


def test_isotonic_is_the_best_rising_fit():
    rng = np.random.default_rng(4)
    n = rng.integers(1, 20, 40)
    k = rng.binomial(n, np.linspace(0.1, 0.9, 40))
    fit = quality.isotonic(n, k)
    assert (np.diff(fit) >= -1e-12).all()
    # means over any front block cannot be beaten: min-max form of the solution
    for i in range(40):
        best = max(min(k[a : b + 1].sum() / n[a : b + 1].sum() for b in range(i, 40)) for a in range(i + 1))
        assert math.isclose(fit[i], best, abs_tol=1e-9)


def test_statistics_do_not_depend_on_the_slice():
    texts = ["", "Hello world. Hello world.\nSECOND line!!", "a | b | c", "é è 1 2 3\n\n", "x " * 500]
    together = quality.statistics(pa.array(texts))
    assert together.shape == (len(texts), len(quality.STATISTICS)) and np.isfinite(together).all()
    for text, row in zip(texts, together):
        assert np.allclose(quality.statistics(pa.array([text]))[0], row)


def test_noisy_or_of_sentences():
    s = toxicity.sentences_of(pa.array(["One two. Three four\nfive", "", "Six!"]))
    assert s.text.tolist() == [0, 0, 0, 2] and len(np.unique(s.sentence)) == len(s.text)
    odds = np.array([0.0, 0.0, -50, 1.0])
    whole = toxicity.noisy_or(odds, s.text, 3)
    assert np.allclose(whole, [0.75, 0, 1 / (1 + math.exp(-1))])


def test_multiple_instances_find_the_word():
    rng = random.Random(5)
    make = lambda bad: ". ".join(" ".join(rng.choice("alpha beta gamma delta epsilon zeta".split()) for _ in range(8)) + (" vilething" if bad and i == 2 else "") for i in range(5)) + "."
    labels = np.array([i % 4 == 0 for i in range(400)], int)
    weights = toxicity.fit_weights(pa.array([make(x) for x in labels]), labels)
    s = toxicity.sentences_of(pa.array([make(1), make(0)]))
    whole = toxicity.noisy_or(toxicity.sentence_scores(s, weights.astype(float)), s.text, 2)
    assert whole[0] > 0.5 > 0.3 > whole[1]
    scores = toxicity.sentence_scores(s, weights.astype(float))[s.text == 0]
    assert np.argmax(scores) == 2


def test_flight_keeps_words_and_documents():
    rng = random.Random(6)
    sizes = [rng.randint(1, 2000) for _ in range(500)]
    flight, done = mixing.Flight(), {}
    for i, size in enumerate(sizes):
        done.update(flight.add(0.37, float(size), rng.random(), i))
    rest = {w[3]: w[0] for w in [*flight.waiting, *flight.queue]}
    assert len(rest) <= mixing.LANDING + 2
    at = lambda i: done.get(i, rest.get(i))
    assert math.isclose(sum(at(i) for i in range(500)), 0.37 * 500, rel_tol=1e-6)
    assert math.isclose(sum(at(i) * s for i, s in enumerate(sizes)), 0.37 * sum(sizes), rel_tol=1e-6)
    done.update(flight.land())
    assert abs(sum(done[i] * s for i, s in enumerate(sizes)) - 0.37 * sum(sizes)) < 30


def test_flight_keeps_chances():
    rng = random.Random(7)
    taken = np.zeros(30)
    for _ in range(3000):
        flight, done = mixing.Flight(), {}
        for i in range(30):
            done.update(flight.add(0.2 + 0.02 * (i % 20), float(1 + i % 7), rng.random(), i))
        for i, x in done.items():
            taken[i] += x
        for w in [*flight.waiting, *flight.queue]:
            taken[w[3]] += w[0]
    assert np.abs(taken / 3000 - (0.2 + 0.02 * (np.arange(30) % 20))).max() < 0.05


def brute_repeats(w):
    from collections import Counter

    seen = Counter(zip(w, w[1:], w[2:]))
    return len({i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)})


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=12), min_size=1, max_size=5))
def test_repeated_words(texts):
    _, code, counts = words(pa.array([" ".join(t) for t in texts]), lower=False)
    assert line_rules.repeated_words(code, counts).tolist() == [brute_repeats(t) for t in texts]
