"""Scores of texts under a bigram model kept in a log-frequency Bloom filter.

A bigram's count is quantised on a logarithmic scale, and the filter holds one event for
each level up to the count's own. A task probes level after level until one is missing; the
last level that is there gives the count, from below. Together with exact word counts this
makes a smoothed probability, (count + PRIOR * P(word)) / (count of the word before + PRIOR),
where P(word) is the add-one estimate. Counts from below keep the sum over all words at 1 or
less, but for false positives of the filter.

Counting works on packed keys: each slice of texts sends its distinct words and bigrams, by
ranges of their hashes, as a few binary rows; the task that owns a range adds them up, builds
its part of the filter and answers each block of documents with the counts of its words. A
block then meets its answers in one task and is scored there. So no word or bigram is a row
of its own, hot ones arrive added up, and blocks and ranges grow in number, not in size.
Blocks are ranges of ids, so that neighbours share their words, of `BLOCK_BYTES` on average;
one that turns out to hold more than twice that is dealt over several tasks, each of which
gets its answers.
The filter is sent to the tasks in segments of at most `MAX_FILTER_BYTES`; each segment is a
pass over the texts that scores the bigrams it holds. Only one segment is sent at a time:
where there are several, a pass is stored before the next segment leaves.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import give_back, giving_back, hashed, id_borders, mixed, range_of, slices, small_batches, stored, texts_of, words

BLOCK_BYTES = 8 << 20
SLICE_BYTES = 2 << 20
# borders between ranges of ids that every task knows; more blocks than that are even parts of a range
MAX_BORDERS = 4096
MAX_FILTER_BYTES = 256 << 20
BITS_PER_EVENT = 10
PROBES = 6
LEVEL_BASE = 1.25
PRIOR = 1000.0
# words hold no line break, so this stands for the end of a text and for what is before its first word
END = b"\n"
WORDS, BIGRAMS, TOTALS, SIZES = 0, 1, 2, 3
# blocks to be dealt whose numbers may be sent to all tasks
BROADCAST_BLOCKS = 100_000
# words of up to this many bytes are hashed all at once
TABLE_BYTES = 32
SCHEMA = "kind int, range int, block int, keys binary, counts binary, n long, v long"


def levels(base: float = LEVEL_BASE, largest: int = 1 << 40) -> np.ndarray:
    """Counts at which a new level begins: 1, 2, 3, ... and then growing by `base`."""
    out = [1]
    while out[-1] < largest:
        out.append(max(out[-1] + 1, int(out[-1] * base)))
    return np.array(out, np.int64)


def steps_of(rest: np.ndarray, level: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """Where the probes for the event (key, level) begin, and how far apart they are."""
    with np.errstate(over="ignore"):
        x = mixed(rest ^ (np.uint64(level) if np.isscalar(level) else level.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15))
    return x, (x >> np.uint64(32)) | np.uint64(1)


def bit_places(begin: np.ndarray, step: np.ndarray, probe: int, size: np.ndarray | int) -> np.ndarray:
    """Place, below `size`, of one probe."""
    with np.errstate(over="ignore"):
        place = (begin + np.uint64(probe) * step) & np.uint64(0xFFFFFFFF)
    return ((place * np.asarray(size, np.uint64)) >> np.uint64(32)).astype(np.int64)


def filter_page(rest: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, int]:
    """Packed bits that hold all levels of the counts, and the number of events."""
    top = np.searchsorted(levels(), counts, side="right")
    events = int(top.sum())
    size = max(64, -(-events * BITS_PER_EVENT // 64) * 64)
    bits = np.zeros(size, np.uint8)
    owner = np.repeat(np.arange(len(rest)), top)
    level = np.arange(events) - np.repeat(np.cumsum(top) - top, top) + 1
    x, step = steps_of(rest[owner], level)
    for probe in range(PROBES):
        bits[bit_places(x, step, probe, size)] = 1
    return np.packbits(bits, bitorder="little"), events


@dataclass
class Filter:
    """Pages of neighbouring ranges, one behind the other."""

    ranges: int
    first: int  # range of the first page
    sizes: np.ndarray  # bits of each page
    bits: np.ndarray

    def __post_init__(self) -> None:
        self.begins = np.cumsum(self.sizes) - self.sizes

    def holds(self, keys: np.ndarray) -> np.ndarray:
        at = range_numbers(keys, self.ranges)
        return (at >= self.first) & (at < self.first + len(self.sizes))

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts from below for keys that this filter holds."""
        page = range_numbers(keys, self.ranges) - self.first
        begin, size, rest = self.begins[page], self.sizes[page].astype(np.uint64), keys & np.uint64(0xFFFFFFFF)
        out = np.zeros(len(keys), np.int64)
        active = np.arange(len(keys))
        for level, count in enumerate(levels(), 1):
            x, step = steps_of(rest, level)
            for probe in range(PROBES):
                place = begin + bit_places(x, step, probe, size)
                there = (self.bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
                if not there.all():
                    active, begin, size, rest, x, step = (values[there] for values in (active, begin, size, rest, x, step))
            out[active] = count
            if not len(active):
                break
        return out


def range_numbers(keys: np.ndarray, ranges: int) -> np.ndarray:
    return (((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)


@dataclass
class Tokens:
    """Words of a slice of texts, each text closed by an end, as numbers of distinct words."""

    hashes: np.ndarray  # of each distinct word, the end last
    code: np.ndarray
    before: np.ndarray  # the token before, or the end
    counts: np.ndarray  # tokens of each text

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def bigrams(self) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed(self.hashes[self.before] * np.uint64(0xD6E8FEB86659FD93) + self.hashes[self.code])


def word_hashes(parts: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word: the sum of random numbers for its bytes and their places, scrambled.

    Words longer than `TABLE_BYTES` go one by one.
    """
    parts = parts.cast(pa.binary())
    offsets = np.frombuffer(parts.buffers()[1], np.int32)[parts.offset : parts.offset + len(parts) + 1].astype(np.int64)
    data = np.frombuffer(parts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets -= offsets[0]
    sizes = np.diff(offsets)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], sizes)
    with np.errstate(over="ignore"):
        number = mixed(np.arange(1, 256 * TABLE_BYTES + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(number[np.minimum(place, TABLE_BYTES - 1) * 256 + data])])
        out = mixed(sums[offsets[1:]] - sums[offsets[:-1]] + sizes.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))
    long = np.flatnonzero(sizes > TABLE_BYTES)
    if len(long):
        out[long] = hashed(parts.take(pa.array(long)))
    return out


def tokens_of(texts: pa.Array) -> Tokens:
    parts, code, counts = words(texts, lower=True)
    hashes = word_hashes(pa.concat_arrays([parts.cast(pa.binary()), pa.array([END], pa.binary())]))
    full = np.full(len(code) + len(counts), len(parts), np.int64)
    ends = np.cumsum(counts + 1) - 1
    inside = np.ones(len(full), bool)
    inside[ends] = False
    full[inside] = code
    before = np.concatenate([[len(parts)], full[:-1]]) if len(full) else full
    return Tokens(hashes, full, before, counts + 1)


def _rows(parts: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(zip(*parts), kinds)] if parts else [pa.array([], k) for k in kinds], names=names)


def _by_range(kind: int, block: int | None, keys: np.ndarray, counts: np.ndarray, ranges: int) -> list[tuple]:
    at = range_numbers(keys, ranges)
    order = np.argsort(at, kind="stable")
    keys, counts, at = keys[order], counts[order].astype(np.uint32), at[order]
    cuts = [*np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])), len(at)] if len(at) else [0]
    # a bigram's range and the low half of its hash are all that the filter uses
    pack = (lambda k: k.tobytes()) if kind == WORDS else (lambda k: (k & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes())
    return [(kind, int(at[a]), block, pack(keys[a:b]), counts[a:b].tobytes(), None, None) for a, b in zip(cuts, cuts[1:])]


def _counted(ranges: int):
    """mapInArrow: packed words of each block, with their counts in training texts, and packed bigrams of training texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes: Counter = Counter()
        for batch in slices(batches, "text", SLICE_BYTES):
            t = tokens_of(texts_of(batch, "text"))
            for number, size in zip(batch.column("block").to_pylist(), pc.binary_length(texts_of(batch, "text")).to_pylist()):
                sizes[number] += size
            train = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)[t.owner]
            block = batch.column("block").to_numpy()
            out = []
            for number in np.unique(block):
                here = (block == number)[t.owner]
                seen = np.bincount(t.code[here & train], minlength=len(t.hashes))
                used = np.flatnonzero(np.bincount(t.code[here], minlength=len(t.hashes)))
                out += _by_range(WORDS, int(number), t.hashes[used], seen[used], ranges)
            pairs, times = np.unique(t.bigrams()[train], return_counts=True)
            yield _rows(out + _by_range(BIGRAMS, None, pairs, times, ranges))
            give_back(cycles=False)
        yield _rows([(SIZES, number % ranges, number, None, None, size, None) for number, size in sizes.items()])

    return count


def _merged(table: pa.Table) -> pa.Table:
    """One range of words or bigrams: totals answered to each block, or a page of the filter."""
    kind, number = table["kind"][0].as_py(), table["range"][0].as_py()
    if kind == SIZES:
        total = table.group_by("block").aggregate([("n", "sum")])
        return pa.Table.from_batches([_rows([(SIZES, number, b, None, None, n, None) for b, n in zip(total["block"].to_pylist(), total["n_sum"].to_pylist())])])
    raw = table["keys"].to_pylist()
    width = np.uint64 if kind == WORDS else np.uint32
    keys = np.frombuffer(b"".join(raw), width)
    counts = np.frombuffer(b"".join(table["counts"].to_pylist()), np.uint32)
    distinct, place = np.unique(keys, return_inverse=True)
    totals = np.bincount(place, weights=counts, minlength=len(distinct)).astype(np.int64)
    if kind == BIGRAMS:
        page, events = filter_page(distinct.astype(np.uint64), totals)
        give_back()
        return pa.Table.from_batches([_rows([(BIGRAMS, number, None, page.tobytes(), None, len(distinct), events)])])
    out = [(TOTALS, number, None, None, None, int(totals.sum()), int((totals > 0).sum()))]
    sizes = np.array([len(r) // 8 for r in raw])
    block = np.repeat(table["block"].to_numpy(), sizes)
    order = np.argsort(block, kind="stable")
    block, place = block[order], place[order]
    cuts = [*np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])), len(block)]
    for a, b in zip(cuts, cuts[1:]):
        known = np.unique(place[a:b])
        known = known[totals[known] > 0]
        out.append((WORDS, number, int(block[a]), distinct[known].tobytes(), totals[known].tobytes(), None, None))
    return pa.Table.from_batches([_rows(out)])


def _scored(sent, n: int, v: int, first: bool, kind: pa.DataType):
    """cogroup function: the texts of a block and the answers to its words give one row for each text."""

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        give_back()
        model = Filter(*sent.value)
        keys = np.frombuffer(b"".join(right["keys"].to_pylist()), np.uint64)
        totals = np.frombuffer(b"".join(right["counts"].to_pylist()), np.int64)
        order = np.argsort(keys)
        keys, totals = keys[order], totals[order]
        out = []
        for batch in slices(iter(left.combine_chunks().to_batches()), "text", SLICE_BYTES):
            t = tokens_of(texts_of(batch, "text"))
            place = np.minimum(np.searchsorted(keys, t.hashes), max(len(keys) - 1, 0))
            count = np.where(keys[place] == t.hashes, totals[place], 0) if len(keys) else np.zeros(len(t.hashes), np.int64)
            plain = (count + 1) / (n + v + 1)
            pairs, where = np.unique(t.bigrams(), return_inverse=True)
            held = model.holds(pairs)
            of_pair = np.zeros(len(pairs), np.int64)
            of_pair[held] = model.counts(pairs[held])
            # a bigram is no more frequent than its words
            joint = np.minimum(np.minimum(of_pair[where], count[t.code]), count[t.before])
            chance = np.where(held[where], np.log10((joint + PRIOR * plain[t.code]) / (count[t.before] + PRIOR)), 0.0)
            rows = len(t.counts)
            total = lambda x: np.bincount(t.owner, weights=x, minlength=rows)  # noqa: E731, B023
            columns = [batch.column("id"), batch.column("train"), pa.array(total(chance))]
            if first:
                columns += [pa.array(t.counts), pa.array(total(count[t.code] > 0).astype(np.int64)), pa.array(total(np.log10(plain)[t.code]))]
            else:
                columns += [pa.array(np.zeros(rows, np.int64)), pa.array(np.zeros(rows, np.int64)), pa.array(np.zeros(rows))]
            out.append(pa.RecordBatch.from_arrays([*columns, batch.column("row")], names=NAMES))
            give_back(cycles=False)
        return pa.Table.from_batches(out, schema=pa.schema(list(zip(NAMES, [kind, pa.bool_(), pa.float64(), pa.int64(), pa.int64(), pa.float64(), pa.int64()]))))

    return score


NAMES = ["id", "train", "score", "n_tokens", "n_known", "base_score", "row"]


def score_texts(docs: DataFrame, train: Column, id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES, max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """id, trained, n_tokens, n_known, train_tokens, base_score and score of every row.

    The model learns from the rows for which `train` holds. Tokens are lower-cased words
    and an end for each text; n_known counts those seen in training. Both scores are sums
    of log10 probabilities: add-one word probabilities, and the bigram model's.

    A null text is empty: its only token is the end. Repeated rows are texts like others
    and count each time; null ids are scored like others, in blocks chosen by their text,
    and so are ids that are not whole numbers, by their hash. Many rows that share an id are
    dealt over several tasks. Other columns are not carried along, so their names cannot
    clash. Without training rows every probability is 1. An empty table gives no rows.
    """
    small_batches(docs)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id).alias("id"), body.alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    size, known, low, high = rows.agg(F.sum(F.octet_length("text")), F.count("id"), F.min("id"), F.max("id")).first()
    blocks = max(1, -(-(size or 0) // block_bytes))
    rows = rows.withColumn("block", _block_of(rows, blocks, known, low, high).cast("int"))

    counted = rows.select("text", "train", "block").mapInArrow(giving_back(_counted(blocks)), SCHEMA)
    merged = stored(counted.groupBy("kind", "range").applyInArrow(_merged, SCHEMA), "lm-counts")
    totals = merged.filter(F.col("kind") == TOTALS).agg(F.sum("n"), F.sum("v")).first()
    n, v = int(totals[0] or 0), int(totals[1] or 0)

    kind = docs.schema[id].dataType.simpleString()
    schema = f"id {kind}, train boolean, score double, n_tokens long, n_known long, base_score double, row long"
    answers = merged.filter(F.col("kind") == WORDS).select("block", "keys", "counts")
    rows = rows.withColumn("row", F.xxhash64("text"))
    rows, answers = _dealt(rows, answers, merged, block_bytes)
    passes = []
    sent = None
    for i, (model, alone) in enumerate(_segments(merged, blocks, max_filter_bytes)):
        if sent is not None:
            sent.destroy()
        # plain arrays: workers unpickle a broadcast without this package
        sent = docs.sparkSession.sparkContext.broadcast((model.ranges, model.first, model.sizes, model.bits))
        function = _scored(sent, n, v, i == 0, to_arrow_type(docs.schema[id].dataType))
        scored = rows.groupBy("block", "share").cogroup(answers.groupBy("block", "share")).applyInArrow(function, schema)
        passes.append(scored if alone else stored(scored, "lm-pass"))
    return _added(passes).select(
        F.col("id").alias(id), F.col("train").alias("trained"), "n_tokens", "n_known", F.lit(n).cast("bigint").alias("train_tokens"), "base_score", "score"
    )


def _block_of(rows: DataFrame, blocks: int, known: int, low, high) -> Column:
    """Blocks as ranges of ids of about equal counts; by hash for rows that have no whole number as id."""
    if not known or not isinstance(rows.schema["id"].dataType, T.IntegralType):
        return F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    id = F.col("id").cast("bigint")
    borders = id_borders(rows.select(id.alias("id")), "id", min(blocks, MAX_BORDERS))
    inside = -(-blocks // (len(borders) + 1))
    found = range_of(id, borders)
    if inside > 1 and blocks > MAX_BORDERS:
        # even parts of each range of ids
        edges = [low, *borders, high + 1]
        begin = F.element_at(F.array(*[F.lit(int(e)) for e in edges[:-1]]), found + 1)
        width = F.element_at(F.array(*[F.lit(max(1, int(b) - int(a))) for a, b in zip(edges, edges[1:])]), found + 1)
        found = found * inside + F.floor((id - begin) / width * inside)
    return F.when(F.col("id").isNull(), F.pmod(F.xxhash64("text"), F.lit(blocks))).otherwise(found)


def _dealt(rows: DataFrame, answers: DataFrame, merged: DataFrame, block_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Rows and answers with a share: 0, or for blocks of more than 2 x `block_bytes` one of several shares of about half of that.

    Rows go to a share at random; every share has the answers to all words of its block, so
    it makes no difference to a score. Texts do not move for it.
    """
    large = merged.filter((F.col("kind") == SIZES) & (F.col("n") > 2 * block_bytes)).select("block", F.ceil(F.col("n") / block_bytes).alias("shares"))
    n_large = large.count()
    if not n_large:
        return rows.withColumn("share", F.lit(0)), answers.withColumn("share", F.lit(0))
    side = F.broadcast(large) if n_large <= BROADCAST_BLOCKS else large
    shares = F.coalesce("shares", F.lit(1)).cast("int")
    share = F.pmod(F.xxhash64("row", F.monotonically_increasing_id()), shares).cast("int")
    spread = answers.join(side, "block", "left").withColumn("share", F.explode(F.sequence(F.lit(0), shares - 1))).drop("shares")
    return rows.join(side, "block", "left").withColumn("share", share).drop("shares"), spread


def _added(passes: list[DataFrame]) -> DataFrame:
    """The first pass with the scores of the others added; rows that share id and text share their score."""
    first, *others = passes
    if not others:
        return first
    parts = [p.groupBy("id", "row").agg(F.first("score").alias("part")) for p in others]
    rest = reduce(DataFrame.unionByName, parts).groupBy(F.col("id").alias("rest_id"), F.col("row").alias("rest_row")).agg(F.sum("part").alias("part"))
    same = F.col("id").eqNullSafe(F.col("rest_id")) & (F.col("row") == F.col("rest_row"))
    return first.join(rest, same).withColumn("score", F.col("score") + F.col("part"))


def _segments(merged: DataFrame, ranges: int, limit: int) -> Iterator[tuple[Filter, bool]]:
    """The filter in neighbouring ranges of at most `limit` bytes, a single range at least, and whether that is all of it; one empty filter if there is nothing."""
    pages = merged.filter(F.col("kind") == BIGRAMS)
    sizes = {r["range"]: r["bytes"] for r in pages.select("range", F.octet_length("keys").alias("bytes")).collect()}
    if not sizes:
        yield Filter(ranges, 0, np.full(ranges, 64, np.int64), np.zeros(8 * ranges, np.uint8)), True
        return
    first = 0
    while first < ranges:
        last, total = first, 0
        while last < ranges and (last == first or total + sizes.get(last, 8) <= limit):
            total += sizes.get(last, 8)
            last += 1
        lengths = np.array([sizes.get(r, 8) for r in range(first, last)], np.int64)
        begin = np.cumsum(lengths) - lengths
        bits = np.zeros(total, np.uint8)
        part = pages.filter((F.col("range") >= first) & (F.col("range") < last)).select("range", "keys")
        for r in part.toLocalIterator():
            at = begin[r["range"] - first]
            bits[at : at + len(r["keys"])] = np.frombuffer(r["keys"], np.uint8)
        yield Filter(ranges, first, lengths * 8, bits), first == 0 and last == ranges
        first = last
