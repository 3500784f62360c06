"""Documents whose word shingles have a Jaccard of at least a threshold, and their classes.

Sets of shingles meet in tiles: a tile is a size band and one part of the hash space, for
sets that are equal there. Sets that reach the threshold differ in few shingles, so with
more parts than that some part is equal; sets that share only a common passage hardly ever
have a whole part in common. Nothing is found by chance and nothing is lost.

Sets that are equal altogether are one node, named by a digest, before anything meets. In
each tile all nodes are held against its centre, the one that meets most others, which links
most near copies in as many tries as there are nodes. Only tiles whose nodes are not yet of one class are then looked at pair by
pair, in blocks, on bitmap signatures: set bits that differ bound the overlap from above,
and what passes goes on to the exact intersection of the sorted shingles. So classes are
exact, while the links inside a class are not all listed.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import done_with, fresh, giving_back, hashed, mixed, slices, small_batches, stored, texts_of, words

SHINGLE_WORDS = 4
THRESHOLD = Fraction(85, 100)
GROWTH = 1.6
# text whose keys are grouped in one task, and the keys that a salted group may hold
RANGE_BYTES = 32 << 20
RANGE_KEYS = 4_000_000
# nodes of a tile that are compared in one task; larger tiles are cut in blocks
BLOCK_NODES = 1024
# rows, and bytes of their bitmaps, that wait for their tile to end
BUFFER_ROWS, BUFFER_BYTES = 50_000, 48 << 20
# tasks over which the tiles around one centre are dealt
SHARES = 8
# up to so many rows of two numbers a side may be sent to all tasks
BROADCAST_ROWS = 1_000_000
SMALLEST_BITMAP, LARGEST_BITMAP = 1 << 9, 1 << 16


def shingle_sets(texts: pa.Array, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts, ascending within each, and how many each text has."""
    parts, code, counts = words(texts, lower=True)
    word = mixed(hashed(parts))[code]
    at = np.arange(len(code)) - np.repeat(np.cumsum(counts) - counts, counts)
    value = np.zeros(len(code), np.uint64)
    with np.errstate(over="ignore"):
        for back in range(width):
            part = np.zeros(len(code), np.uint64)
            part[back:] = word[: max(len(code) - back, 0)]
            part[at < back] = 0
            value = mixed(value * np.uint64(0x9E3779B97F4A7C15) + part + np.uint64(back))
    whole = at >= np.minimum(width, np.repeat(counts, counts)) - 1
    value, owner = value[whole], np.repeat(np.arange(len(counts)), counts)[whole]
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], np.bincount(owner[new], minlength=len(counts)).astype(np.int64)


class Bands:
    """Size bands and, for each, into how many parts its sets are cut.

    Sets of a and b shingles that reach the threshold t differ in at most (1-t)/(1+t) (a+b)
    of them. The tile of a band holds the pairs whose smaller set is in the band.
    """

    def __init__(self, threshold: Fraction, largest: int = 1 << 40):
        self.starts = [1]
        while self.starts[-1] <= largest:
            # the largest partner of a band's sets is at most one band up
            self.starts.append(max(self.starts[-1] + 1, int(self.starts[-1] * GROWTH), int(self.starts[-1] / threshold)))
        self.starts = np.array(self.starts, np.int64)
        last = [int(s) - 1 for s in self.starts[1:]]
        partner = [int(n / threshold) for n in last]
        differ = [int((1 - threshold) / (1 + threshold) * (n + p)) for n, p in zip(last, partner)]
        self.partner = np.array(partner, np.int64)
        self.spare = np.array([(k + 1) // 16 + (k > 0) for k in differ], np.int64)
        self.parts = np.array([k + 1 for k in differ], np.int64) + self.spare

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, sizes, side="right") - 1


def part_keys(values: np.ndarray, counts: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all sets and the set each belongs to.

    A band's parts are ranges of the hash space; a key stands for all shingles of a set in
    one part. Two sets of a tile that reach the threshold agree in more parts than either
    leaves empty, unless both leave more than the spare ones empty; such sets have keys
    for their empty parts too. So they share a key in any case.
    """
    keys, owners = [], []
    own = bands.of(counts)
    for shift in (0, -1):
        tile = own + shift
        fits = (counts > 0) & (tile >= 0)
        if shift:
            fits &= counts <= bands.partner[np.maximum(tile, 0)]
        # one part only: equal sets, which are one node anyway
        fits &= bands.parts[np.maximum(tile, 0)] > 1
        tile = np.where(fits, tile, 0)
        n_parts = np.where(fits, bands.parts[tile], 0)
        of_set = np.repeat(np.arange(len(counts)), counts)
        sel = fits[of_set]
        v, s = values[sel], of_set[sel]
        part = ((v >> np.uint64(32)) * n_parts[s].astype(np.uint64)) >> np.uint64(32)
        begin = np.cumsum(n_parts) - n_parts
        slot = begin[s] + part.astype(np.int64)
        total = int(n_parts.sum())
        with np.errstate(over="ignore"):
            first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]])) if len(slot) else np.zeros(0, np.int64)
            sums = np.add.reduceat(mixed(v), first) if len(slot) else np.zeros(0, np.uint64)
            held = np.zeros(total, np.uint64)
            held[slot[first]] = sums
            full = np.zeros(total, bool)
            full[slot[first]] = True
            set_of = np.repeat(np.arange(len(counts)), n_parts)
            number = np.arange(total) - begin[set_of]
            key = mixed(held + mixed((tile[set_of] * (1 << 40) + number + 1).astype(np.uint64)))
        empty = n_parts - np.bincount(set_of[full], minlength=len(counts))
        use = full | (empty > bands.spare[tile])[set_of]
        keys.append(key[use])
        owners.append(set_of[use])
    return np.concatenate(keys), np.concatenate(owners)


def digests(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A number for each set, equal for equal sets; empty sets have 0."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        with np.errstate(over="ignore"):
            sums = np.add.reduceat(mixed(values ^ np.uint64(0x5851F42D4C957F2D)), (np.cumsum(counts) - counts)[full])
            out[full] = mixed(sums + counts[full].astype(np.uint64))
    return out


def bitmaps(values: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """Hashed parity bitmaps, at least as wide as the next power of two: bit i is the parity of the shingles that hash to i.

    Halving a bitmap by xor gives the bitmap of half the width, so any two can be compared.
    """
    out = []
    bits = (mixed(values) >> np.uint64(48)).astype(np.int64)
    for n, v in zip(counts, np.split(bits, np.cumsum(counts)[:-1])):
        width = min(LARGEST_BITMAP, max(SMALLEST_BITMAP, 1 << int(n - 1).bit_length())) if n else SMALLEST_BITMAP
        out.append(np.packbits(np.bincount(v % width, minlength=width) & 1, bitorder="little").tobytes())
    return out


def most_overlap(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> int:
    """Upper bound of the overlap of two sets from their bitmaps (as 64-bit words)."""
    return (n_a + n_b - int(np.bitwise_count(folded(a, len(b)) ^ folded(b, len(a))).sum())) // 2


def folded(bitmap: np.ndarray, words: int) -> np.ndarray:
    while len(bitmap) > words:
        half = len(bitmap) // 2
        bitmap = bitmap[:half] ^ bitmap[half:]
    return bitmap


def reach(threshold: Fraction, overlap, total):
    """Whether sets with `total` shingles together and that overlap have the Jaccard: overlap >= t * (total - overlap)."""
    return threshold.denominator * overlap >= threshold.numerator * (total - overlap)


def _signed(width: int, threshold: Fraction, ranges: int):
    """mapInArrow: a row for each document, and rows of packed keys for each slice of documents and range of keys."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(threshold)
        for batch in slices(batches, "text"):
            values, counts = shingle_sets(texts_of(batch, "text"), width)
            nodes = digests(values, counts)
            keys, owner = part_keys(values, counts, bands)
            # equal sets of a slice have equal keys: one of them is enough
            _, first = np.unique(nodes, return_index=True)
            chosen = np.zeros(len(nodes), bool)
            chosen[first] = True
            keep = chosen[owner]
            keys, held = keys[keep], nodes[owner[keep]]
            part = ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
            order = np.argsort(part, kind="stable")
            keys, held, part = keys[order], held[order], part[order]
            cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
            ends = [*cuts[1:], len(part)]
            n, m = batch.num_rows, len(cuts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([batch.column("id"), pa.nulls(m, batch.schema.field("id").type)]),
                    pa.concat_arrays([pa.array(counts), pa.array([e - c for c, e in zip(cuts, ends)], pa.int64())]),
                    pa.concat_arrays([pa.array(nodes.view(np.int64)), pa.nulls(m, pa.int64())]),
                    pa.concat_arrays([pa.nulls(n, pa.int32()), pa.array(part[cuts].astype(np.int32))]),
                    pa.concat_arrays([pa.nulls(n, pa.binary()), pa.array([keys[c:e].tobytes() for c, e in zip(cuts, ends)], pa.binary())]),
                    pa.concat_arrays([pa.nulls(n, pa.binary()), pa.array([held[c:e].tobytes() for c, e in zip(cuts, ends)], pa.binary())]),
                ],
                names=["id", "n", "node", "range", "keys", "held"],
            )

    return sign


def _tiles(alone: bool):
    """applyInArrow: from the packed keys of a range to (key, node, held) for tiles of several nodes, with their number; `alone` keeps single ones too."""

    def meet(table: pa.Table) -> pa.Table:
        join = lambda c: np.frombuffer(b"".join(table[c].to_pylist()), np.uint64)
        keys, nodes = join("keys"), join("held")
        order = np.lexsort((nodes, keys))
        keys, nodes = keys[order], nodes[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
        keys, nodes = keys[new], nodes[new]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.concatenate([starts, [len(keys)]]))
        held = np.repeat(sizes, sizes)
        use = (held > 1) | alone
        return pa.table({"key": pa.array(keys[use].view(np.int64)), "node": pa.array(nodes[use].view(np.int64)), "held": pa.array(held[use])})

    return meet


def _with_sets(width: int):
    """mapInArrow: sorted shingles and bitmap of each text, for rows whose text still is the node that was asked for."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values, counts = shingle_sets(texts_of(batch, "text"), width)
            same = digests(values, counts).view(np.int64) == batch.column("node").to_numpy()
            sets = [v.tobytes() for v in np.split(values, np.cumsum(counts)[:-1])]
            out = pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(counts), pa.array(bitmaps(values, counts), pa.binary()), pa.array(sets, pa.binary())], names=["node", "n", "bitmap", "shingles"]
            )
            yield out.filter(pa.array(same))

    return build


def _bounded(threshold: Fraction):
    """mapInArrow: pairs whose sizes and bitmaps allow the threshold."""

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.select(["n_a", "bitmap_a", "n_b", "bitmap_b"]).to_pylist()
            keep = [
                reach(threshold, min(r["n_a"], r["n_b"]), r["n_a"] + r["n_b"])
                and reach(threshold, most_overlap(np.frombuffer(r["bitmap_a"], np.uint64), np.frombuffer(r["bitmap_b"], np.uint64), r["n_a"], r["n_b"]), r["n_a"] + r["n_b"])
                for r in rows
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return bound


def _verified(threshold: Fraction):
    """mapInArrow: pairs whose sorted shingles overlap enough."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()):
                one, other = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                keep.append(reach(threshold, len(np.intersect1d(one, other, assume_unique=True)), len(one) + len(other)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return verify


def _paired(threshold: Fraction):
    """mapInArrow over rows sorted by tile and block pair: pairs of different classes that pass the bound."""

    def compare(rows: pa.Table) -> pa.RecordBatch:
        get = lambda c: rows[c].to_numpy()
        p, q, block, node, group, n = (get(c) for c in ("p", "q", "block", "node", "class", "n"))
        starts = np.concatenate([[0], _changes(rows)])
        tile = np.repeat(np.arange(len(starts)), np.diff(np.concatenate([starts, [rows.num_rows]])))
        raw = rows["bitmap"].to_pylist()
        # bitmaps of a tile are brought to the width of its narrowest
        width = np.minimum.reduceat(np.array([len(r) // 8 for r in raw]), starts)[tile]
        found = [np.zeros((0, 2), np.int64)]
        for narrow in np.unique(width):
            of = np.flatnonzero(width == narrow)
            bits = np.stack([folded(np.frombuffer(raw[k], np.uint64), narrow) for k in of])
            for step in range(1, len(of)):
                at = np.flatnonzero(tile[of[:-step]] == tile[of[step:]])
                if not len(at):
                    break
                i, j = of[at], of[at + step]
                ok = (group[i] != group[j]) & ((p[i] == q[i]) | (block[i] != block[j])) & reach(threshold, np.minimum(n[i], n[j]), n[i] + n[j])
                at, i, j = at[ok], i[ok], j[ok]
                differ = np.bitwise_count(bits[at] ^ bits[at + step]).sum(axis=1).astype(np.int64)
                ok = reach(threshold, (n[i] + n[j] - differ) // 2, n[i] + n[j])
                found.append(np.stack([np.minimum(node[i[ok]], node[j[ok]]), np.maximum(node[i[ok]], node[j[ok]])], axis=1))
        pairs = np.unique(np.concatenate(found), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            if sum(t.num_rows for t in held) < BUFFER_ROWS and sum(t["bitmap"].nbytes for t in held) < BUFFER_BYTES:
                continue
            table = pa.concat_tables(held)
            changes = _changes(table)
            if len(changes):
                # the last tile may go on in the next batch
                yield compare(table.slice(0, changes[-1]))
                table = table.slice(changes[-1])
            held = [table.combine_chunks()]
        if held and sum(t.num_rows for t in held):
            yield compare(pa.concat_tables(held))

    return pair


def _changes(rows: pa.Table) -> np.ndarray:
    """Where a new tile or pair of blocks begins, but for the first."""
    columns = [rows[c].to_numpy() for c in ("key", "p", "q")]
    return np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1


def _verify(pairs: DataFrame, sets: DataFrame, threshold: Fraction) -> DataFrame:
    """The pairs (a, b) that reach the threshold, stored: bitmaps first, then the shingles of what is left."""
    light = lambda s: sets.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("bitmap").alias(f"bitmap_{s}"))
    whole = lambda s: sets.select(F.col("node").alias(s), F.col("shingles").alias(f"set_{s}"))
    possible = pairs.join(light("a"), "a").join(light("b"), "b").mapInArrow(giving_back(_bounded(threshold)), "a long, b long")
    return stored(possible.join(whole("a"), "a").join(whole("b"), "b").mapInArrow(giving_back(_verified(threshold)), "a long, b long"), "join-links")


def classes(links: DataFrame) -> DataFrame:
    """(node, class) for all nodes of the links (a, b); a class is named by its smallest node.

    Each round takes the smallest class among neighbours and then the class of that class,
    so the rounds grow with the logarithm of a class's diameter. Every round is stored.
    """
    both = stored(links.select(F.col("a").alias("from"), F.col("b").alias("to")).unionByName(links.select(F.col("b").alias("from"), F.col("a").alias("to"))).distinct(), "join-edges")
    state = stored(both.groupBy(F.col("from").alias("node")).agg(F.least(F.min("to"), F.col("from")).alias("class")), "join-classes")
    while True:
        near = both.join(state.select(F.col("node").alias("to"), "class"), "to").groupBy(F.col("from").alias("node")).agg(F.min("class").alias("near"))
        closer = state.select("node", "class").join(near, "node").select("node", F.col("class").alias("old"), F.least("class", "near").alias("class"))
        step = closer.join(closer.select(F.col("node").alias("class"), F.col("class").alias("next")), "class").select("node", "old", F.least("class", "next").alias("class"))
        before, state = state, stored(step, "join-classes")
        done_with(before)
        if not state.filter("class <> old").limit(1).count():
            done_with(both)
            return state.select("node", "class")


def similar_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", threshold: Fraction = THRESHOLD, width: int = SHINGLE_WORDS) -> DataFrame:
    """id, n_shingles and component_id, the smallest id that is reached by links, for every row.

    A text of fewer words than a shingle is one shingle. A null text, or one without words,
    has no shingles and links with nothing. Rows with equal sets link, so repeated rows are
    of one class. Rows with a null id take no part: their component is null. Other columns
    are not carried along, so their names cannot clash. An empty table gives no rows.
    """
    small_batches(docs)
    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, -(-size // RANGE_BYTES))
    signed = stored(rows.mapInArrow(giving_back(_signed(width, threshold, ranges)), f"id {kind}, n long, node long, range int, keys binary, held binary"), "join-keys")
    # the keys are most of it, and are done with once they have met
    members = stored(signed.filter(F.col("range").isNull()).select("id", "n", "node"), "join-members")
    tiles = _meet(signed.filter(F.col("range").isNotNull()))
    done_with(signed)
    found = resolve(rows, members, tiles, threshold, width)
    return found.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def resolve(rows: DataFrame, members: DataFrame, tiles: DataFrame, threshold: Fraction, width: int) -> DataFrame:
    """(id, n, component) for all members (id, n, node), from the tiles (key, node, held) in which nodes meet.

    `rows` are the (id, text) that the members stand for. Nodes that meet in no tile are
    not compared; those that do link exactly if they reach the threshold.
    """
    met, tiles = tiles, _centred(tiles)
    done_with(met)
    nodes = members.filter(F.col("id").isNotNull() & (F.col("n") > 0)).groupBy("node").agg(F.min("id").alias("id"))
    wanted = stored(tiles.select("node").distinct().join(nodes, "node").select("id", "node"), "join-wanted")
    wanted_side = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    sets = stored(rows.join(wanted_side, "id").select("node", "text").mapInArrow(giving_back(_with_sets(width)), "node long, n long, bitmap binary, shingles binary"), "join-sets")

    star = tiles.filter(F.col("node") != F.col("centre")).select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
    named = classes(_verify(star, sets, threshold))
    # stored, so that the bitmaps of all tiles are gone from disk before shingles move
    left = stored(_residual(tiles, named, sets, threshold), "join-pairs")
    done_with(tiles)
    more = _verify(left, sets, threshold)
    done_with(left, wanted, sets)
    if more.limit(1).count():
        of = lambda s: named.select(F.col("node").alias(s), F.col("class").alias(f"class_{s}"))
        merged = more.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("class_a", "a").alias("a"), F.coalesce("class_b", "b").alias("b"))
        upper = classes(merged).select(F.col("node").alias("class"), F.col("class").alias("upper"))
        lone = merged.select(F.col("a").alias("node")).union(merged.select(F.col("b").alias("node"))).distinct().join(named, "node", "left_anti").select("node", F.col("node").alias("class"))
        named = named.unionByName(lone).join(upper, "class", "left").select("node", F.coalesce("upper", "class").alias("class"))

    # each node's smallest id, then the smallest of its class; small sides, as only linked nodes have a class
    linked = nodes.join(named, "node")
    smallest = linked.groupBy("class").agg(F.min("id").alias("smallest"))
    of_node = nodes.join(linked.join(smallest, "class").select("node", "smallest"), "node", "left").select("node", F.coalesce("smallest", "id").alias("component"))
    known = members.filter(F.col("id").isNotNull() & (F.col("n") > 0)).join(of_node, "node").select("id", "n", "component")
    others = members.filter(F.col("id").isNull() | (F.col("n") == 0)).select("id", "n", F.col("id").alias("component"))
    return known.unionByName(others)


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", threshold: Fraction = THRESHOLD, width: int = SHINGLE_WORDS) -> DataFrame:
    """The input rows, with all their columns, without those whose class has an earlier row.

    A row is known by its id and a hash of its text, and stands in that order in its class:
    so rows that share an id are told apart, and a text that is nobody's copy stays whatever
    its id. Of rows that repeat both id and text one stays. Rows with a null id all stay, as
    do texts without words. An empty table gives an empty table.
    """
    first_id, mark, times = fresh(docs, "join_id", "join_mark", "join_times")
    hashed_text = F.xxhash64(text)
    key = F.when(F.col(id).isNotNull(), F.struct(F.col(id).alias("id"), hashed_text.alias("mark")))
    found = similar_documents(docs.select(key.alias("key"), F.col(text).alias("text")), "key", "text", threshold, width)
    gone = found.filter("key IS NOT NULL AND component_id < key").select(F.col("key.id").alias(first_id), F.col("key.mark").alias(mark)).distinct()
    # texts move only if the copies are too many to be sent to all tasks
    kept = docs.join(gone, (F.col(id) == F.col(first_id)) & (hashed_text == F.col(mark)), "left_anti")

    keys = docs.filter(F.col(id).isNotNull()).groupBy(F.col(id).alias(first_id), hashed_text.alias(mark)).agg(F.count(F.lit(1)).alias(times))
    repeated = stored(keys.filter(F.col(times) > 1).drop(times), "join-repeated")
    if not repeated.limit(1).count():
        return kept
    same = (F.col(id) == F.col(first_id)) & (hashed_text == F.col(mark))
    # rows that are there once are not touched; the others are combined before they move
    several = kept.withColumn(times, hashed_text).join(repeated, same, "left_semi").dropDuplicates([id, times]).drop(times)
    return kept.join(repeated, same, "left_anti").unionByName(several)


def _meet(packed: DataFrame) -> DataFrame:
    """Tiles of several nodes as rows (key, node, held), stored.

    Ranges of keys are even unless many nodes share a key; then a range is cut by a hash
    into groups of bounded size, each of which counts its own.
    """
    schema = "key long, node long, held long"
    large = packed.groupBy("range").agg(F.sum("n").alias("all")).filter(F.col("all") > RANGE_KEYS).select("range", F.ceil(F.col("all") / RANGE_KEYS).alias("salts"))
    if not large.limit(1).count():
        return stored(packed.groupBy("range").applyInArrow(_tiles(False), schema), "join-tiles")
    # by a hash of the row, so that a task that runs again deals alike
    salted = packed.join(large, "range", "left").withColumn("salt", F.pmod(F.xxhash64("keys", "held"), F.coalesce("salts", F.lit(1))))
    met = stored(salted.filter(F.col("salts").isNull()).groupBy("range").applyInArrow(_tiles(False), schema).unionByName(
        salted.filter(F.col("salts").isNotNull()).groupBy("range", "salt").applyInArrow(_tiles(True), schema)), "join-met")
    several = met.groupBy("key").agg(F.count(F.lit(1)).alias("nodes")).filter("nodes > 1").select("key")
    return stored(met.join(several, "key"), "join-tiles")


def _centred(tiles: DataFrame) -> DataFrame:
    """Tiles with their centre: the node that meets most nodes over all its tiles. Rows (key, node, centre), stored.

    Copies of one text differ more from each other than from it, and it meets most of them.
    """
    weights = tiles.groupBy("node").agg(F.sum("held").alias("weight"))
    top = tiles.join(weights, "node").groupBy("key").agg(F.max(F.struct("weight", "node")).alias("top"))
    return stored(tiles.join(top.select("key", F.col("top.node").alias("centre")), "key").select("key", "node", "centre"), "join-centres")


def _residual(tiles: DataFrame, named: DataFrame, sets: DataFrame, threshold: Fraction) -> DataFrame:
    """Pairs of nodes that share a tile, are of different classes so far and pass the bitmap bound."""
    labelled = tiles.join(named, "node", "left").select("key", "node", "centre", F.coalesce("class", "node").alias("class"))
    mixed_tiles = (
        labelled.groupBy("key").agg(F.min("class").alias("one"), F.max("class").alias("other"), F.count(F.lit(1)).alias("held"), F.min("centre").alias("centre"))
        .filter("one <> other")
    )
    blocks = mixed_tiles.select("key", "centre", F.ceil(F.col("held") / BLOCK_NODES).cast("int").alias("blocks"))
    rows = (
        labelled.drop("centre").join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks").cast("bigint")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("centre", "key", "node", "class", "block", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"))
        .join(sets.select("node", "n", "bitmap"), "node")
    )
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # two nodes meet in many tiles, mostly around one centre: there their pair is found once, or once in each of few shares
    dealt = rows.repartition(parts, "centre", F.pmod("key", F.lit(SHARES)), "p", "q").sortWithinPartitions("centre", "key", "p", "q")
    return dealt.mapInArrow(giving_back(_paired(threshold)), "a long, b long").distinct()
