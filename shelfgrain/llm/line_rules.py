"""Cleaning by lines first, documents second.

Each line is held against punctuation, navigation and boilerplate rules; failing lines go,
and a document that loses more than `MAX_LOST` of its words goes with them. Every document
is judged by itself, so rows stay where they are: no shuffle. Words, lines and repeats of a
whole slice of documents are worked out at once on arrays of word numbers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import giving_back, slices, small_batches, texts_of, words

MIN_WORDS = 50
MAX_REPEATED = 50  # percent of the words
MAX_LOST = 50  # percent of the words
MAX_SYMBOLS = 30  # percent of a line's words
MAX_SHOUTS = 20  # percent of a line's words that end in !!
MAX_SEPARATORS = 20  # percent of a line's words that only separate others
BOILERPLATE_WORDS = 30  # longer lines hold more than the phrase

SYMBOLS = "#*$%&|<>"
SEPARATORS = ["|", "||", ">", ">>", "»", "›", "•", "·", "/", "::"]
SENTENCE_END = r"[.!?…。！？][\"')\]»”’]*([\x20\x09-\x0D]|$)"
SHOUT = r"!!([\x20\x09-\x0D]|$)"
PHRASES = [
    "all rights reserved", "licensed under", "released under", "terms of use", "terms of service", "privacy policy",
    "cookie policy", "use of cookies", "enable javascript", "subscribe to our newsletter", "click here", "skip to content",
    "sign in to", "log in to", "share this", "back to top", "lorem ipsum",
]

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"
RESULT = f"{BASE}, n_bad_punctuation long, n_navigation long, n_boilerplate long, lost_words long, kept boolean, clean_text string"


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of the values that belong to each of a row of groups of the given sizes."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def repeated_words(code: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Words of each text inside windows of three words that the text holds twice or more."""
    n = len(code)
    covered = np.zeros(n, bool)
    owner = np.repeat(np.arange(len(counts)), counts)
    if n >= 3:
        whole = np.flatnonzero(owner[2:] == owner[:-2])
        size = int(code.max()) + 1
        _, pair = np.unique(code[:-1] * size + code[1:], return_inverse=True)
        _, triple = np.unique(pair[:-1] * size + code[2:], return_inverse=True)
        _, window, times = np.unique(owner[whole] * (int(triple.max()) + 1) + triple[whole], return_inverse=True, return_counts=True)
        again = whole[times[window] > 1]
        for step in range(3):
            covered[again + step] = True
    return _sums(covered.astype(np.int64), counts)


def repeated_lines(lines: pa.Array, owner: np.ndarray, with_word: np.ndarray, texts: int) -> np.ndarray:
    """Lines of each text that have a word and equal an earlier line of it."""
    code = lines.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    key = (owner * (int(code.max()) + 1 if len(code) else 1) + code)[with_word]
    _, first = np.unique(key, return_index=True)
    again = np.ones(len(key), bool)
    again[first] = False
    return np.bincount(owner[with_word][again], minlength=texts).astype(np.int64)


def line_verdicts(lines: pa.Array, n_words: np.ndarray) -> dict[str, np.ndarray]:
    """Which lines fail which rule. Lines without a word fail none."""
    count = lambda pattern: pc.count_substring_regex(lines, pattern).to_numpy(zero_copy_only=False)
    symbols = count(f"[{re.escape(SYMBOLS)}]")
    ends, shouts = count(SENTENCE_END), count(SHOUT)
    parts, code, counts = words(lines, lower=False)
    separator = pc.is_in(parts, pa.array(SEPARATORS)).to_numpy(zero_copy_only=False)
    separators = _sums(separator[code].astype(np.int64), counts) if len(code) else np.zeros(len(lines), np.int64)
    phrase = pc.match_substring_regex(pc.ascii_lower(lines), "|".join(map(re.escape, PHRASES))).to_numpy(zero_copy_only=False)
    some = n_words > 0
    return {
        "punctuation": some & ((ends == 0) | (100 * symbols > MAX_SYMBOLS * n_words) | (100 * shouts > MAX_SHOUTS * n_words)),
        "navigation": some & (100 * separators > MAX_SEPARATORS * n_words),
        "boilerplate": some & phrase & (n_words <= BOILERPLATE_WORDS),
    }


def judge(texts: pa.Array) -> list[pa.Array]:
    """The columns of RESULT for a slice of texts."""
    parts, code, counts = words(texts, lower=False)
    chars = _sums(pc.utf8_length(parts).to_numpy(zero_copy_only=False)[code].astype(np.int64), counts) if len(code) else np.zeros(len(texts), np.int64)
    symbols = pc.count_substring_regex(texts, f"[{re.escape(SYMBOLS)}]").to_numpy(zero_copy_only=False)
    split = pc.split_pattern(texts, "\n")
    lines, n_lines = split.flatten(), np.diff(split.offsets.to_numpy()).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), n_lines)
    _, _, line_words = words(lines, lower=False)
    repeats = repeated_words(code, counts)
    failed = line_verdicts(lines, line_words)
    bad = failed["punctuation"] | failed["navigation"] | failed["boilerplate"]
    lost = _sums(np.where(bad, line_words, 0), n_lines)
    base_failed = (counts < MIN_WORDS) | (100 * repeats > MAX_REPEATED * counts)
    kept = ~base_failed & (100 * lost <= MAX_LOST * counts)
    stay = ~bad
    offsets = np.concatenate([[0], np.cumsum(_sums(stay.astype(np.int64), n_lines))]).astype(np.int32)
    cleaned = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), lines.filter(pa.array(stay))), "\n")
    number = lambda x: pa.array(np.asarray(x, np.int64))
    return [
        number(counts), number(chars), number(symbols), number(repeated_lines(lines, owner, line_words > 0, len(texts))), number(repeats),
        pa.array(base_failed), *[number(_sums(failed[k].astype(np.int64), n_lines)) for k in ("punctuation", "navigation", "boilerplate")],
        number(lost), pa.array(kept), pc.cast(cleaned, pa.string()),
    ]


def clean_by_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", with_text: bool = True) -> DataFrame:
    """id, counts, verdicts and the text without failing lines, one row for each input row.

    A null or empty text has no words and fails. Lines without a word are neither judged
    nor removed. Repeated rows and null ids are rows like others. Other columns are not
    carried along, so their names cannot clash. An empty table gives an empty table.
    """
    small_batches(docs)
    rows = docs.select(docs[id].alias("id"), docs[text].alias("text"))
    columns = RESULT if with_text else RESULT.rpartition(",")[0]
    names = ["id", *[c.split()[0] for c in columns.split(", ")]]

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            made = judge(texts_of(batch, "text"))
            yield pa.RecordBatch.from_arrays([batch.column("id"), *made][: len(names)], names=names)

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(giving_back(judged), f"id {kind}, {columns}").withColumnRenamed("id", id)
