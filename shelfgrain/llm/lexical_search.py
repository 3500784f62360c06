"""Ranked lexical search for a stated set of items, over documents grouped by their bags of terms.

A document matters to the items only by the terms it shares with them. So each text becomes
a bag, the counts of the items' terms in it, together with m, which stands for its length;
documents of equal bag and m are a class and have equal scores for all items. Classes meet
by a hash of the bag and are told apart by the bag itself. Each class is scored once, and a
ranking is filled from the ascending ids of its best classes: no more than the first `top`
ids of a class can ever be reported.

The vocabulary of the items is sent to all tasks. Items come in blocks of bounded text, each
with a search of its own, so what is sent has a bound, however many items there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import top_per_key
from .common import fresh, giving_back, slices, small_batches, stored, texts_of, words

TOP = 10
# item texts whose terms are sent to the tasks at once
ITEM_BYTES = 16 << 20
# scores that are held at once: classes x items
CELLS = 4 << 20
# bytes that are part of a term: 0-9, A-Z, a-z and all beyond ASCII; capitals become small
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
COUNTS = "n bigint, bag binary"


def term_texts(texts: pa.Array) -> pa.Array:
    """The texts with terms in small letters and a blank for every other byte."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = bytes(memoryview(texts.buffers()[2] or b"")[offsets[0] : offsets[-1]]).translate(TERM_BYTES)
    return pa.Array.from_buffers(pa.string(), len(texts), [None, pa.py_buffer((offsets - offsets[0]).astype(np.int32)), pa.py_buffer(data)])


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TERM_BYTES).split()


def pack(term: np.ndarray, times: np.ndarray) -> bytes:
    return np.concatenate([term, times]).astype(np.uint32).tobytes()


def unpack(bags: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms and counts of all bags behind each other, and the number of terms of each."""
    sizes = np.array([len(b) // 8 for b in bags], np.int64)
    flat = np.frombuffer(b"".join(bags), np.uint32).astype(np.int64)
    begin = 2 * (np.cumsum(sizes) - sizes)
    at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(begin, sizes)
    return flat[at], flat[at + np.repeat(sizes, sizes)], sizes


def _bagged(sent):
    """mapInArrow: (id, n, bag) of each text, and at a task's end the number of its texts that hold each term (id null)."""

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array(sent.value, pa.binary())
        holding = np.zeros(len(vocabulary), np.int64)
        kind = None
        for batch in slices(batches, "text"):
            kind = batch.schema.field("id").type
            distinct, code, counts = words(term_texts(texts_of(batch, "text")), lower=False)
            known = pc.fill_null(pc.index_in(distinct.cast(pa.binary()), vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            term = known[code] if len(code) else np.zeros(0, np.int64)
            owner = np.repeat(np.arange(len(counts)), counts)[term >= 0]
            pairs, times = np.unique(owner * len(vocabulary) + term[term >= 0], return_counts=True)
            owner, term = np.divmod(pairs, len(vocabulary)) if len(pairs) else (pairs, pairs)
            holding += np.bincount(term, minlength=len(vocabulary))
            cuts = np.searchsorted(owner, np.arange(len(counts) + 1))
            bags = [pack(term[a:b], times[a:b]) for a, b in zip(cuts, cuts[1:])]
            yield _bag_rows(batch.column("id"), pa.array(counts), pa.array(bags, pa.binary()))
        if kind is not None and holding.any():
            used = np.flatnonzero(holding)
            yield _bag_rows(pa.nulls(1, kind), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), used, holding[used])

    return bag


def _bag_rows(id: pa.Array, n: pa.Array, bag: pa.Array, term=(), held=()) -> pa.RecordBatch:
    lists = [pa.array([list(map(int, x))] if len(x) else [None] * len(id), pa.list_(pa.int64())) for x in (term, held)]
    return pa.RecordBatch.from_arrays([id, n, bag, *lists], names=["id", "n", "bag", "term", "held"])


def _scored(sent, top: int, kind: pa.DataType):
    """mapInArrow over classes (bag, m, ids): for each item the best documents of a task, (item, score, id)."""

    def best(scores: np.ndarray, item: np.ndarray, first: np.ndarray, ids: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
        order = np.lexsort((first, -scores, item))
        item = item[order]
        begin = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]])) if len(item) else np.zeros(0, np.int64)
        rank = np.arange(len(item)) - np.repeat(begin, np.diff(np.append(begin, len(item))))
        order = order[rank < top]
        return scores[order], item[rank < top], first[order], [ids[k] for k in order]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, begins, items, n_items = sent.value
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, object), [])
        step = max(1, CELLS // max(n_items, 1))
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                term, times, sizes = unpack(batch.column("bag").to_pylist())
                m = np.repeat(batch.column("m").to_numpy(), sizes)
                part = weights[term] * ((1_000_000_000 * times) // (1000 * times + 8 * m))
                row = np.repeat(np.arange(batch.num_rows), sizes)
                # each term's part goes to all items that have the term
                spread = (begins[1:] - begins[:-1])[term]
                at = np.arange(int(spread.sum())) - np.repeat(np.cumsum(spread) - spread, spread) + np.repeat(begins[term], spread)
                cell = np.repeat(row, spread) * n_items + items[at]
                # sums of whole numbers far below 2^53 are exact
                total = np.bincount(cell, weights=np.repeat(part, spread).astype(np.float64), minlength=batch.num_rows * n_items)
                cells = np.flatnonzero(total > 0)
                own = batch.column("ids").to_pylist()
                first = np.array([x[0] for x in own] + [None], object)[:-1]
                # only what is not below the worst kept score of an item can enter
                row, item = np.divmod(cells, n_items)
                floor = np.zeros(n_items, np.int64)
                counted = np.bincount(held[1], minlength=n_items)
                full = counted >= top
                if full.any():
                    least = np.full(n_items, np.iinfo(np.int64).max)
                    np.minimum.at(least, held[1], held[0])
                    floor[full] = least[full]
                scores = total[cells].astype(np.int64)
                enter = scores >= floor[item]
                row, item, scores = row[enter], item[enter], scores[enter]
                row, item, scores = _near_top(row, item, scores, top)
                ids = [own[k] for k in row]
                held = best(
                    np.concatenate([held[0], scores]), np.concatenate([held[1], item]),
                    _ordinal(np.concatenate([held[2], first[row]])), held[3] + ids,
                )
                held = (held[0], held[1], np.array([x[0] for x in held[3]] + [None], object)[:-1], held[3])
        # classes give their members in the order of the ranking: no more than `top` for an item
        sizes = [len(x) for x in held[3]]
        members = np.array([x for own in held[3] for x in own] + [None], object)[:-1]
        scores, item, _, ids = best(np.repeat(held[0], sizes), np.repeat(held[1], sizes), _ordinal(members), list(members))
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(scores, pa.int64()), pa.array(ids, kind)], names=["item", "score", "id"])

    return score


def _ordinal(ids: np.ndarray) -> np.ndarray:
    """Numbers in the order of the ids, nulls last."""
    known = sorted({x for x in ids if x is not None})
    number = {x: i for i, x in enumerate(known)}
    return np.array([number.get(x, len(known)) for x in ids], np.int64)


def _near_top(row: np.ndarray, item: np.ndarray, scores: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What is no worse than the `top`-th best score of its item, ties included."""
    order = np.lexsort((-scores, item))
    row, item, scores = row[order], item[order], scores[order]
    if not len(item):
        return row, item, scores
    begin = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
    size = np.diff(np.append(begin, len(item)))
    last = scores[begin + np.minimum(size, top) - 1]
    good = scores >= np.repeat(last, size)
    return row[good], item[good], scores[good]


def search(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", top: int = TOP, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """item id, rank, document id and score of each item's `top` documents with a score above 0.

    Terms are runs of ASCII letters, digits and all characters beyond ASCII, in small
    letters. A term's weight is floor(1000 ln((2N+2)/(2df+1))); a document's score is the
    sum over the item's different terms of w * (1000000000 tf div (1000 tf + 8 m)), with
    m = 10 + (90 n N div L). Equal scores stand by ascending document id.

    A null text has no terms; a document without any does not count in N, and an item
    without any has no rows. Every row is a document or an item of its own: repeated rows
    take a rank each, null document ids stand last among equal scores, and items that share
    an id each have ranks from 1. Other columns are not carried along, so their names cannot
    clash. Without documents or items there are no rows.
    """
    small_batches(docs)
    spark = docs.sparkSession
    asked = items.select(F.col(item_id).alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // item_bytes))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    found = [_search_block(docs, asked.filter(block == k).collect() if blocks > 1 else asked.collect(), id, text, top) for k in range(blocks)]
    found = [f for f in found if f is not None]
    kind = docs.schema[id].dataType.simpleString()
    item_kind = items.schema[item_id].dataType.simpleString()
    if not found:
        return spark.createDataFrame([], f"`{item_id}` {item_kind}, rank int, `{id}` {kind}, score bigint")
    name = fresh(docs.select(id), item_id)[0] if item_id == id else item_id
    rows = reduce(DataFrame.unionByName, found)
    return rows.select(F.col("item_id").cast(items.schema[item_id].dataType).alias(name), "rank", F.col("id").alias(id), "score")


def _search_block(docs: DataFrame, asked: list, id: str, text: str, top: int) -> DataFrame | None:
    spark = docs.sparkSession
    terms = [sorted(set(terms_of(r["text"]))) for r in asked]
    vocabulary = sorted({t for own in terms for t in own})
    if not vocabulary:
        return None
    rows = docs.select(docs[id].alias("id"), docs[text].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    sent = spark.sparkContext.broadcast(vocabulary)
    bags = stored(rows.mapInArrow(giving_back(_bagged(sent)), f"id {kind}, {COUNTS}, term array<bigint>, held array<bigint>"), "search-bags")
    n, length = bags.filter("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n:
        return None
    pair = bags.filter("n IS NULL").select(F.explode(F.arrays_zip("term", "held")).alias("x"))
    holding = np.zeros(len(vocabulary), np.int64)
    # as many rows as the vocabulary has terms, which has a bound
    for r in pair.groupBy(F.col("x.term").alias("term")).agg(F.sum("x.held").alias("df")).toLocalIterator():
        holding[r["term"]] = r["df"]
    weights = np.floor(1000 * np.log((2 * n + 2) / (2 * holding + 1))).astype(np.int64)

    m = F.expr(f"10 + ((90L * n * {n}L) div {length}L)")
    held = bags.filter((F.col("n") > 0) & (F.octet_length("bag") > 0)).select("id", m.alias("m"), F.xxhash64("bag").alias("hash"), "bag")
    classes = _classes(held, top)

    number = {t: k for k, t in enumerate(vocabulary)}
    pairs = sorted((number[t], k) for k, own in enumerate(terms) for t in own)
    begins = np.searchsorted([t for t, _ in pairs], np.arange(len(vocabulary) + 1))
    index = spark.sparkContext.broadcast((weights, begins, np.array([k for _, k in pairs], np.int64), len(asked)))
    from pyspark.sql.pandas.types import to_arrow_type

    function = giving_back(_scored(index, top, to_arrow_type(rows.schema["id"].dataType)))
    best = classes.select("bag", "m", "ids").mapInArrow(function, f"item bigint, score bigint, id {kind}")
    best = stored(best, "search-best")
    ranked = top_per_key(best, ["item"], [F.col("score").desc(), F.col("id").asc_nulls_last()], top, rank="rank")
    # at most ITEM_BYTES of items, so a small table
    names = spark.createDataFrame([(k, r["item_id"]) for k, r in enumerate(asked)], f"item bigint, item_id {_kind_of(asked)}")
    return ranked.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "id", "score")


def _kind_of(asked: list) -> str:
    return "bigint" if all(r["item_id"] is None or isinstance(r["item_id"], int) for r in asked) else "string"


def _classes(held: DataFrame, top: int) -> DataFrame:
    """(m, bag, ids): classes of equal bag and m with their first `top` ids, ascending.

    Rows are put together by the hash of the bag, which is compared first, and by the bag.
    Of a large class each task passes on its first ids only, and slices of the tasks do so
    again, before the class meets in one place.
    """
    keys = ["hash", "m", "bag"]
    first: list[Column] = [F.col("id").asc_nulls_last()]
    kept = top_per_key(held, keys, first, top, rank="place")
    return kept.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", F.struct("id").alias("row")))), lambda x: x["row"]["id"]).alias("ids"))
