"""Periodic runs of words: stretches that repeat with some period and cannot be made longer.

The words of a stretch are the letters of a string. Ukkonen's algorithm builds the suffix
trees of the string and of its reversal; an Euler tour of each, with a table of minima over
powers of two, tells in constant time how far two places agree to the right and to the left.
Every run starts a repetition of a Lyndon word that is the longest one at its place, either
in the order of the letters or in the opposite order, so the longest Lyndon words of both
orders are all candidates there are: each is extended both ways and kept if what it covers
is long enough. The orders come from the tree itself, read with its branches in one order
and in the other.

Trees are built where a run can be. A run of `min_words` words with `min_exponent` periods
shows at each of its places a short sequence of words that comes again within one period;
a text is cut down, in numpy over a whole slice of texts, to stretches whose every place
does. This loses nothing: hashes that agree by chance only make a stretch longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import giving_back, mixed, slices, small_batches, texts_of, words

MIN_WORDS = 24
MIN_EXPONENT = 3
# rounds of cutting stretches down; more would only make them shorter still
ROUNDS = 6
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
FAR = np.int64(1) << np.int64(40)


class SuffixTree:
    """Ukkonen's suffix tree of numbers 1..alphabet-1, closed by a 0, with an Euler tour for common prefixes."""

    def __init__(self, letters: list[int], alphabet: int):
        self.letters = [*letters, 0]
        self.alphabet = alphabet
        self._build()
        self._tour()

    def _build(self) -> None:
        s, size = self.letters, self.alphabet
        n = len(s)
        first, last, link, suffix = [0], [0], [0], [-1]
        child: dict[int, int] = {}
        find = child.get
        node = edge = length = waiting = leaves = 0
        for i, letter in enumerate(s):
            waiting += 1
            made = 0  # inner node that still lacks its link
            while waiting:
                if not length:
                    edge = i
                key = node * size + s[edge]
                below = find(key)
                if below is None:
                    child[key] = len(first)
                    first.append(i)
                    last.append(n)
                    link.append(0)
                    suffix.append(leaves)
                    leaves += 1
                    if made:
                        link[made] = node
                        made = 0
                else:
                    begin = first[below]
                    span = last[below] - begin
                    if length >= span:
                        node = below
                        edge += span
                        length -= span
                        continue
                    if s[begin + length] == letter:
                        length += 1
                        if made:
                            link[made] = node
                        break
                    inner = len(first)
                    child[key] = inner
                    first += (begin, i)
                    last += (begin + length, n)
                    link += (0, 0)
                    suffix += (-1, leaves)
                    leaves += 1
                    first[below] = begin + length
                    child[inner * size + letter] = inner + 1
                    child[inner * size + s[begin + length]] = below
                    if made:
                        link[made] = inner
                    made = inner
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1
        keys = np.fromiter(child.keys(), np.int64, len(child))
        below = np.fromiter(child.values(), np.int64, len(child))
        order = np.argsort(keys)
        self._below = below[order]
        self._letter = keys[order] % size
        self._begin = np.searchsorted(keys[order], np.arange(len(first) + 1, dtype=np.int64) * size)
        self._width = [b - a for a, b in zip(first, last)]
        self._suffix = suffix

    def _walk(self, below: list[int], place: list[int] | None) -> list[int]:
        """Suffixes in the order of the branches; with `place`, the tour's depths, and where each suffix stands in it."""
        begin, width, suffix = self._begin.tolist(), self._width, self._suffix
        found: list[int] = []
        tour = [0]
        # a branch not yet walked is its place in `below`, with the depth of the node above it
        stack = [(k, 0) for k in range(begin[1] - 1, begin[0] - 1, -1)]
        while stack:
            k, depth = stack.pop()
            if k < 0:
                tour.append(depth)
                continue
            node = below[k]
            if place is not None:
                stack.append((-1, depth))
            if suffix[node] >= 0:
                found.append(suffix[node])
                if place is not None:
                    place[suffix[node]] = len(tour)
                    tour.append(depth + width[node])
                continue
            depth += width[node]
            tour.append(depth)
            stack += [(j, depth) for j in range(begin[node + 1] - 1, begin[node] - 1, -1)]
        self._depths = tour
        return found

    def _tour(self) -> None:
        n = len(self.letters)
        place = [0] * n
        up = self._walk(self._below.tolist(), place)
        depths = np.array(self._depths, np.int32)
        self._place = np.array(place, np.int64)
        table = [depths]
        while 2 << (len(table) - 1) <= len(depths):
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        self._table = table
        self.rank = np.empty(n, np.int64)
        self.rank[up] = np.arange(n)

    def opposite_rank(self) -> np.ndarray:
        """Ranks of the suffixes when larger letters come first; the end still comes before all."""
        node = np.repeat(np.arange(len(self._begin) - 1), np.diff(self._begin))
        order = np.lexsort((np.where(self._letter == 0, -FAR, -self._letter), node))
        down = self._walk(self._below[order].tolist(), None)
        rank = np.empty(len(down), np.int64)
        rank[down] = np.arange(len(down))
        return rank

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of suffixes a and b (different), from the least depth between them."""
        x, y = self._place[a], self._place[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out = np.zeros(len(a), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            row = self._table[k]
            out[at] = np.minimum(row[low[at]], row[high[at] - (1 << int(k)) + 1])
        return out


def lyndon_lengths(rank: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word at each place but the last: up to the next smaller suffix."""
    ranks = rank.tolist()
    n = len(ranks) - 1
    out = [0] * n
    stack = [n]
    for i in range(n - 1, -1, -1):
        own = ranks[i]
        while ranks[stack[-1]] > own:
            stack.pop()
        out[i] = stack[-1] - i
        stack.append(i)
    return np.array(out, np.int64)


def runs_of(code: np.ndarray, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """Rows (start, length, period) of all runs of a string of numbers, by start and then period."""
    n = len(code)
    if n < min_words:
        return np.zeros((0, 3), np.int64)
    letters = np.unique(code, return_inverse=True)[1] + 1
    alphabet = int(letters.max()) + 1
    forth = SuffixTree(letters.tolist(), alphabet)
    lengths = np.concatenate([lyndon_lengths(forth.rank), lyndon_lengths(forth.opposite_rank())])
    at = np.tile(np.arange(n), 2)
    fits = lengths * min_exponent <= n
    at, period = at[fits], lengths[fits]
    if not len(at):
        return np.zeros((0, 3), np.int64)
    right = forth.common(at, at + period)
    back = SuffixTree(letters[::-1].tolist(), alphabet)
    left = back.common(n - at, n - at - period)
    length = left + period + right
    long = length >= np.maximum(min_words, min_exponent * period)
    found = np.unique(np.stack([(at - left)[long], period[long], length[long]], axis=1), axis=0)
    return found[:, [0, 2, 1]]


def _grams(code: np.ndarray, width: int) -> np.ndarray:
    """A hash of the `width` numbers from each place on; meaningless for the last places."""
    with np.errstate(over="ignore"):
        # by doubling: `power` numbers from each place on, and what is joined so far
        single = mixed(code.astype(np.uint64) + np.uint64(1))
        power, size, joined, done = single, 1, None, 0
        while True:
            if width & size:
                joined = power if joined is None else mixed(joined * np.uint64(0x9E3779B97F4A7C15) + _ahead(power, done))
                done += size
            size *= 2
            if size > width:
                return joined
            power = mixed(power * np.uint64(0xD6E8FEB86659FD93) + _ahead(power, size // 2))


def _ahead(x: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(x)
    out[: max(len(x) - by, 0)] = x[by:]
    return out


def stretches(code: np.ndarray, counts: np.ndarray, min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, begin, end) of stretches outside of which no run can be, of texts whose words follow each other.

    A run of period q and length n has n >= 2q + width - 1, so each of its places but the
    last width - 1 sees its next `width` words again q places before or behind, and q is at
    most n / min_exponent.
    """
    width = min_words * (min_exponent - 2) // min_exponent + 1
    total = len(code)
    owner = np.repeat(np.arange(len(counts)), counts)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(total)
    places = np.flatnonzero(left >= width)
    with np.errstate(over="ignore"):
        key = mixed(_grams(code, width) + owner.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))[places] if total else np.zeros(0, np.uint64)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    ordered = places[order]
    gap = (ordered[1:] - ordered[:-1])[same]
    near = np.full(total, FAR)
    near[ordered[1:][same]] = gap
    before = ordered[:-1][same]
    near[before] = np.minimum(near[before], gap)

    kept = np.flatnonzero(near < FAR)
    starts, sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for _ in range(ROUNDS):
        if not len(kept):
            return kept, kept, kept
        new = np.concatenate([[True], (np.diff(kept) > 1) | (owner[kept[1:]] != owner[kept[:-1]])])
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(kept)))
        reach = np.repeat(sizes + width - 1, sizes)
        good = (near[kept] * min_exponent <= reach) & (reach >= min_words)
        if good.all():
            break
        kept = kept[good]
    else:
        # the last cut may have opened stretches again
        new = np.concatenate([[True], (np.diff(kept) > 1) | (owner[kept[1:]] != owner[kept[:-1]])]) if len(kept) else np.zeros(0, bool)
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(kept)))
    begin = kept[starts]
    of = owner[begin]
    offset = (np.cumsum(counts) - counts)[of]
    return of, begin - offset, begin - offset + sizes + width - 1


def periodic_runs(docs: DataFrame, id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """id, n_words, runs and collapsed of every row.

    runs: (start, length, period) of all runs of at least `min_words` words and
    `min_exponent` periods, by start and then period; starts count words from 0. collapsed:
    the words joined by one space, without those that lie behind the first period of a run.

    A text without runs has an empty list and keeps all words; a null text, like one without
    words, has no words and an empty collapsed text. Repeated rows and null ids are rows like
    others. Other columns are not carried along, so their names cannot clash. An empty table
    gives no rows. Rows stay where they are: no shuffle. A text is worked on whole by one
    task; its trees take about 500 bytes for each word that lies in a stretch.
    """
    if min_exponent < 2 or min_words < 2:
        raise ValueError("a run has at least two periods and two words")
    small_batches(docs)
    rows = docs.select(docs[id].alias("id"), docs[text].alias("text"))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = texts_of(batch, "text")
            _, code, counts = words(texts, lower=False)
            runs: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            begins = np.cumsum(counts) - counts
            for of, begin, end in zip(*(x.tolist() for x in stretches(code, counts, min_words, min_exponent))):
                at = int(begins[of])
                for start, length, period in runs_of(code[at + begin : at + end], min_words, min_exponent).tolist():
                    runs[of].append({"start": begin + start, "length": length, "period": period})
            collapsed = []
            for own, n, data in zip(runs, counts.tolist(), texts.cast(pa.binary()).to_pylist()):
                parts = data.split()
                if own:
                    kept = np.ones(n, bool)
                    for run in own:
                        kept[run["start"] + run["period"] : run["start"] + run["length"]] = False
                    parts = [parts[i] for i in np.flatnonzero(kept)]
                collapsed.append(b" ".join(parts))
            kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts), pa.array(runs, kind), pc.cast(pa.array(collapsed, pa.binary()), pa.string())],
                names=["id", "n_words", "runs", "collapsed"],
            )

    schema = f"id {rows.schema['id'].dataType.simpleString()}, n_words bigint, runs {RUNS}, collapsed string"
    return rows.mapInArrow(giving_back(found), schema).withColumnRenamed("id", id)


def strongest(runs: str = "runs"):
    """The run of greatest length / period, compared exactly; of equal ones the first, then that of the smallest period."""
    better = "CASE WHEN y.length * x.period <> x.length * y.period THEN y.length * x.period > x.length * y.period WHEN y.start <> x.start THEN y.start < x.start ELSE y.period < x.period END"
    return F.expr(f"aggregate({runs}, element_at({runs}, CASE WHEN size({runs}) > 0 THEN 1 END), (x, y) -> CASE WHEN {better} THEN y ELSE x END)")
