"""Token ids in compact files: static range asymmetric numeral systems over independent blocks.

Writing takes two steps. Texts are put in id order, one range of ids for each part, and
encoded; the ids are stored with the counts that each task saw. From the counts of all ids
comes one frequency table, which all blocks share. Then every block, whole documents with
about `BLOCK_TOKENS` ids, is coded on its own: `lanes` coders take turns, id by id, and share
one stream of 32-bit words, so numpy moves all lanes at once. A block carries its final
states, a checksum of its ids, and checkpoints: the states and the place in the stream every
`CHECK_STEPS` turns, from which decoding starts at all of them at the same time.

The files are Parquet, so that any file system that Spark reaches will do and lost tasks
leave nothing half written: a row is a block with its documents, and a small table beside
the blocks holds the frequencies. Nothing else is needed to read them.

Text becomes ids by the tokenizers library. With a byte-level pre-tokenizer and no
normalizer, what it does to a piece of text does not depend on what is around it, so each
distinct piece of a task is encoded once. Pieces are cut in numpy by the pre-tokenizer's
rule; how it classes a character is asked of the library itself. Arrow finds the distinct
pieces of several slices at once, behind those that are known; they never are Python objects.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import give_back, giving_back, per_process, slices, small_batches, stored, texts_of

END_ID = 2
PART_BYTES = 64 << 20
MAX_PARTS = 20_000
SLICE_BYTES = 2 << 20
# texts whose distinct pieces are looked for at once
GROUP_BYTES = 16 << 20
BLOCK_TOKENS = 1 << 20
MAX_LANES = 1024
CHECK_STEPS = 256
# pieces that a task remembers, in bytes: their letters, ids and places; more than that and it starts afresh
PIECE_BYTES, ENTRY_BYTES = 64 << 20, 32
# new pieces that the model is given at once
JOINED = 16
# new pieces that are Python strings at the same time
LEARNT = 1 << 14
STATE_LOW, WORD = 31, 32
MAGIC = b"RNSB"
HEADER = "<4sBBHIQI"  # magic, version, bits of the table, checkpoints, lanes, ids, crc32 of the ids
LETTER, NUMBER, OTHER, BLANK = 0, 1, 2, 3


# --- frequency table -----------------------------------------------------------------


@dataclass
class Table:
    """Frequencies that sum to 2**bits, at least 1 for each id that occurs."""

    ids: np.ndarray  # ascending
    freqs: np.ndarray
    bits: int

    def __post_init__(self) -> None:
        self.begin = np.cumsum(self.freqs) - self.freqs
        self._slots: np.ndarray | None = None
        self._numbers: np.ndarray | None = None

    @property
    def numbers(self) -> np.ndarray:
        """The place in the table of each id up to the largest."""
        if self._numbers is None:
            self._numbers = np.zeros(int(self.ids[-1]) + 1 if len(self.ids) else 0, np.int32)
            self._numbers[self.ids] = np.arange(len(self.ids))
        return self._numbers

    @property
    def slots(self) -> np.ndarray:
        """The number of the id that owns each of the 2**bits slots."""
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.ids)), self.freqs).astype(np.uint32)
        return self._slots


def frequency_table(ids: np.ndarray, counts: np.ndarray) -> Table:
    """Counts scaled to a power of two, 16 times the number of ids or more (2**12 to 2**24)."""
    order = np.argsort(ids)
    ids, counts = np.asarray(ids, np.int64)[order], np.asarray(counts, np.int64)[order]
    if not len(ids):
        return Table(ids, counts, 12)
    bits = min(24, max(12, (len(ids) - 1).bit_length() + 4))
    if len(ids) > 1 << bits:
        raise ValueError("more different ids than the table can hold")
    exact = counts / counts.sum() * (1 << bits)
    freqs = np.maximum(1, np.floor(exact)).astype(np.int64)
    spare = (1 << bits) - int(freqs.sum())
    if spare > 0:
        freqs[np.lexsort((ids, freqs - exact))[:spare]] += 1
        freqs[np.argmax(freqs)] += (1 << bits) - int(freqs.sum())
    while spare < 0:
        # ids raised to 1 took more than there is: take it from the largest
        large = np.lexsort((ids, -freqs))[: max(1, int((freqs > 1).sum()) // 2)]
        give = np.minimum(freqs[large] - 1, -(spare // len(large)))
        give[np.cumsum(give) > -spare] = 0
        if not give.any():
            give[0] = min(int(freqs[large[0]]) - 1, -spare)
        freqs[large] -= give
        spare += int(give.sum())
    return Table(ids, freqs, bits)


# --- blocks --------------------------------------------------------------------------


def encode_block(ids: np.ndarray, table: Table, check_steps: int = CHECK_STEPS, max_lanes: int = MAX_LANES) -> bytes:
    """A block of ids. Id number i is in lane i mod lanes; turns are coded last to first."""
    n = len(ids)
    lanes = 1
    while lanes < max_lanes and lanes * 64 < n:
        lanes *= 2
    symbol = table.numbers[ids]
    freq, begin = table.freqs.astype(np.uint64)[symbol], table.begin.astype(np.uint64)[symbol]
    bits, word = np.uint64(table.bits), np.uint64(WORD)
    limit = freq << np.uint64(STATE_LOW - table.bits + WORD)
    steps = -(-n // lanes)
    state = np.full(lanes, 1 << STATE_LOW, np.uint64)
    words: list[np.ndarray] = []
    emitted = 0
    checks: list[tuple[int, bytes]] = []
    for step in range(steps - 1, -1, -1):
        a, b = step * lanes, min((step + 1) * lanes, n)
        x = state[: b - a]
        large = x >= limit[a:b]
        if large.any():
            out = x[large]
            words.append(out.astype(np.uint32))
            emitted += len(out)
            x[large] = out >> word
        f = freq[a:b]
        turns = x // f
        x[:] = (turns << bits) + (x - turns * f) + begin[a:b]
        if step and step % check_steps == 0:
            checks.append((emitted, state.tobytes()))
    crc = zlib.crc32(np.ascontiguousarray(ids, "<u4"))
    head = struct.pack(HEADER, MAGIC, 1, table.bits, len(checks), lanes, n, crc)
    # places of the checkpoints count words from the start, as a decoder meets them
    places = np.array([emitted - e for e, _ in reversed(checks)], "<u8").tobytes()
    states = state.tobytes() + b"".join(s for _, s in reversed(checks))
    stream = np.concatenate(words[::-1]).tobytes() if words else b""
    return head + struct.pack("<I", check_steps) + places + states + stream


def decode_block(block: bytes, table: Table) -> np.ndarray:
    """The ids of a block; raises if they do not fit its checksum. All checkpoints are started from at once."""
    size = struct.calcsize(HEADER)
    magic, version, bits, n_checks, lanes, n, crc = struct.unpack_from(HEADER, block)
    if magic != MAGIC or version != 1 or bits != table.bits:
        raise ValueError("not a block of this table")
    (check_steps,) = struct.unpack_from("<I", block, size)
    at = size + 4
    runs = n_checks + 1
    place = np.concatenate([[0], np.frombuffer(block, "<u8", n_checks, at).astype(np.int64)])
    at += 8 * n_checks
    state = np.frombuffer(block, "<u8", runs * lanes, at).astype(np.uint64).reshape(runs, lanes)
    stream = np.frombuffer(block, "<u4", offset=at + 8 * runs * lanes).astype(np.uint64)
    out = np.empty(runs * check_steps * lanes, np.uint32).reshape(runs, check_steps, lanes)
    mask, low = np.uint64((1 << bits) - 1), np.uint64(1 << STATE_LOW)
    shift, word = np.uint64(bits), np.uint64(WORD)
    freqs, begins = table.freqs.astype(np.uint64), table.begin.astype(np.uint64)
    slots, numbers = table.slots, table.ids.astype(np.uint32)
    steps = -(-n // lanes)
    stream = np.append(stream, np.zeros(runs * lanes, np.uint64))  # a damaged block may ask for more than there is
    for step in range(min(check_steps, steps)):
        # runs that still have a turn; only the last one can end early, and only its last turn can be narrow
        live = runs if (runs - 1) * check_steps + step < steps else runs - 1
        final = live == runs and (runs - 1) * check_steps + step == steps - 1 and n % lanes
        x = state[:live].ravel() if not final else np.concatenate([state[: live - 1].ravel(), state[live - 1, : n % lanes]])
        slot = x & mask
        symbol = slots[slot]
        x = freqs[symbol] * (x >> shift) + slot - begins[symbol]
        small = x < low
        owner = np.arange(len(x)) // lanes
        taken = np.bincount(owner[small], minlength=live)
        if small.any():
            # words of a run are met in the order of its lanes
            nth = np.cumsum(small) - 1 - np.repeat(np.cumsum(taken) - taken, np.bincount(owner, minlength=live))
            x[small] = (x[small] << word) | stream[np.minimum((place[owner] + nth)[small], len(stream) - 1)]
            place[:live] += taken
        if final:
            out[: live - 1, step] = numbers[symbol[: (live - 1) * lanes]].reshape(live - 1, lanes)
            out[live - 1, step, : n % lanes] = numbers[symbol[(live - 1) * lanes :]]
            state[: live - 1] = x[: (live - 1) * lanes].reshape(live - 1, lanes)
        else:
            out[:live, step] = numbers[symbol].reshape(live, lanes)
            state[:live] = x.reshape(live, lanes)
    ids = out.reshape(-1)[:n]
    if zlib.crc32(np.ascontiguousarray(ids, "<u4")) != crc:
        raise ValueError("the checksum of a block does not fit its ids")
    return ids


# --- text to ids ---------------------------------------------------------------------


def byte_letters() -> str:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else the next from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return "".join(chr(b) if b in own else chr(next(others)) for b in range(256))


class PieceEncoder:
    """Ids of texts by a tokenizer of the library, each distinct piece once."""

    def __init__(self, description: str, room: int = PIECE_BYTES):
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(description)
        self.tokenizer.encode_special_tokens = True
        shape = json.loads(description)
        before = shape.get("pre_tokenizer") or {}
        self.by_piece = (
            shape.get("normalizer") is None and shape.get("model", {}).get("type") == "BPE" and before.get("type") == "ByteLevel"
            and not before.get("add_prefix_space") and before.get("use_regex", True) and not shape.get("truncation") and not shape.get("padding")
        )
        self.room = room
        self._letter_of = dict(enumerate(byte_letters()))
        self._between = self._border(shape.get("model", {}))
        self._class_of: dict[int, int] = {}
        self._ascii = np.array([self._ask(chr(b)) if b < 128 else OTHER for b in range(256)], np.uint8)
        self.forget()

    def _border(self, model: dict) -> str | None:
        """A letter of a byte that UTF-8 never has and no merge touches: what is joined by it is encoded as if on its own."""
        if any(model.get(k) for k in ("dropout", "unk_token", "byte_fallback", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix")):
            return None
        merged = {letter for merge in model.get("merges", []) for part in merge for letter in part}
        free = [self._letter_of[b] for b in (0xC0, 0xC1, *range(0xF5, 0x100))]
        return next((letter for letter in free if letter in model.get("vocab", {}) and letter not in merged), None)

    def forget(self) -> None:
        """Empty memory: the known pieces in the order of their numbers, from 1, and the ids of all behind each other; 0 is the end of a text."""
        self._number = pa.array([], pa.binary())
        self._ids, self._begin = np.array([END_ID], np.uint32), np.array([0, 1], np.int64)
        self._left = self.room

    def _ask(self, char: str) -> int:
        """The class of a character, by what the pre-tokenizer joins it with."""
        pieces = lambda text: len(self.tokenizer.pre_tokenizer.pre_tokenize_str(text))
        if pieces("a" + char + "a") == 1:
            return LETTER
        if pieces("1" + char + "1") == 1:
            return NUMBER
        return OTHER if pieces("!" + char + "!") == 1 else BLANK

    def _classes(self, data: np.ndarray) -> np.ndarray:
        """The class of the character that each byte belongs to."""
        out = self._ascii[data]
        lead = np.flatnonzero(data >= 0xC0)
        if not len(lead):
            return out
        first = data[lead].astype(np.int64)
        more = 1 + (first >= 0xE0) + (first >= 0xF0)
        code = first & (0x3F >> more)
        padded = np.concatenate([data, np.zeros(3, np.uint8)])
        for k in (1, 2, 3):
            code = np.where(more >= k, (code << 6) | (padded[lead + k] & 0x3F), code)
        distinct, place = np.unique(code, return_inverse=True)
        for c in distinct.tolist():
            if c not in self._class_of:
                self._class_of[c] = self._ask(chr(c))
        kind = np.array([self._class_of[c] for c in distinct.tolist()], np.uint8)[place]
        for k in range(4):
            at = more >= k
            out[lead[at] + k] = kind[at]
        return out

    def cuts(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Where pieces begin in texts that follow each other and begin at `starts`."""
        n = len(data)
        kind = self._classes(data)
        begins = np.zeros(n + 1, bool)
        begins[starts] = True
        begins[n] = True
        new = begins.copy()
        new[1:n] |= kind[1:] != kind[:-1]
        # the last blank before something else is a space that joins it, or a piece of its own
        head = np.flatnonzero(new[:n] & ~begins[:n] & (kind != BLANK))
        head = head[kind[head - 1] == BLANK]
        joined = head[data[head - 1] == 32]
        new[joined] = False
        new[joined - 1] = True
        alone = head[data[head - 1] != 32]
        back = alone - 1
        for _ in range(3):
            back = np.where((data[back] & 0xC0) == 0x80, back - 1, back)
        new[back] = True
        # an apostrophe that begins a piece takes some endings with it: 's 't 'm 'd 're 've 'll
        quote = np.flatnonzero(data == 39)
        quote = quote[new[quote]]
        after = lambda k: np.where(quote + k < n, data[np.minimum(quote + k, max(n - 1, 0))], 0)
        inside = lambda k: (quote + k < n) & ~np.logical_or.reduce([begins[np.minimum(quote + j, n)] for j in range(1, k + 1)])
        one, two = after(1), after(2)
        short = inside(1) & np.isin(one, np.frombuffer(b"stmd", np.uint8))
        long = inside(2) & (((one == 114) & (two == 101)) | ((one == 118) & (two == 101)) | ((one == 108) & (two == 108)))
        for at, size in ((quote[short], 2), (quote[long & ~short], 3)):
            new[at + 1] = False
            new[at + size] = True
        new[n] = True
        return np.flatnonzero(new)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts behind each other, each text closed by the end id, and how many each has."""
        return next(self.encode_group([texts]))

    def encode_group(self, group: Iterable[pa.Array]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same for each array of texts; the distinct pieces of all of them are looked for together."""
        if not self.by_piece:
            for texts in group:
                found = [[*e.ids, END_ID] for e in self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)]
                yield np.array([t for ids in found for t in ids], np.uint32), np.array([len(ids) for ids in found], np.int64)
            return
        cut = [(pieces.dictionary_encode(), ends) for pieces, ends in map(self._pieces, group)]
        # known pieces come first, so that they keep their numbers
        merged = pa.chunked_array([self._number, *[coded.dictionary for coded, _ in cut]]).dictionary_encode()
        numbers = np.concatenate([np.zeros(0, np.int32), *[chunk.indices.to_numpy() for chunk in merged.chunks]])[len(self._number) :]
        if merged.num_chunks:
            self._learn(merged.chunk(0).dictionary)
        stops = np.cumsum([0, *[len(coded.dictionary) for coded, _ in cut]]).tolist()
        places = [(numbers[a:b], coded.indices.to_numpy(), ends) for a, b, (coded, ends) in zip(stops, stops[1:], cut)]
        del cut, merged
        begin, known = self._begin, self._ids
        if self._left <= 0:
            self.forget()
        for own, indices, ends in places:
            # a text ends with piece 0
            code = np.insert((own + 1)[indices], ends, 0)
            size = np.diff(begin)[code]
            last = np.cumsum(size)
            flat = np.repeat(begin[code] - (last - size), size)
            flat += np.arange(len(flat))
            closing = last[ends + np.arange(len(ends))]
            yield known[flat], np.diff(np.concatenate([[0], closing]))

    def _pieces(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The pieces of all texts, and for each text the number of pieces up to its end."""
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = (offsets - offsets[0]).astype(np.int64)
        starts = self.cuts(data, offsets[:-1]) if len(data) else np.zeros(1, np.int64)
        pieces = pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])
        return pieces, np.searchsorted(starts[:-1], offsets[1:]) if len(pieces) else np.zeros(len(texts), np.int64)

    def _learn(self, pieces: pa.Array) -> None:
        """Encode the pieces behind those that are known; then all are."""
        new = pieces.slice(len(self._number))
        self._number = pieces
        if not len(new):
            return
        begin, ids = [self._begin], [self._ids]
        known = len(self._ids)
        for k in range(0, len(new), LEARNT):
            own, sizes = self._model_ids(new.slice(k, LEARNT))
            begin.append(known + np.cumsum(sizes))
            ids.append(own)
            known += len(own)
        self._begin, self._ids = np.concatenate(begin), np.concatenate(ids)
        self._left -= ENTRY_BYTES * len(new) + pc.sum(pc.binary_length(new)).as_py() + sum(own.nbytes for own in ids[1:])

    def _model_ids(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces behind each other, and how many each has, by the library's model."""
        offsets = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset : pieces.offset + len(pieces) + 1]
        # one translation for all: bytes to the letters of the vocabulary
        letters = pieces.buffers()[2][offsets[0] : offsets[-1]].to_pybytes().decode("latin-1").translate(self._letter_of)
        ends = (offsets - offsets[0]).tolist()
        own = [letters[a:b] for a, b in zip(ends, ends[1:])]
        split = self.tokenizer.model.tokenize
        if not self._between or self._between in letters:
            tokens = [[t.id for t in split(piece)] for piece in own]
            return np.array([t for ids in tokens for t in ids], np.uint32), np.array(list(map(len, tokens)), np.int64)
        found: list[int] = []
        for k in range(0, len(own), JOINED):
            found.extend([t.id for t in split(self._between.join(own[k : k + JOINED]) + self._between)])
        ids = np.array(found, np.uint32)
        border = ids == self.tokenizer.token_to_id(self._between)
        return ids[~border], np.diff(np.flatnonzero(border), prepend=-1) - 1


# --- writing and reading -------------------------------------------------------------


def _by_group(encoder: PieceEncoder, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[np.ndarray, np.ndarray], tuple[int, pa.Array]]]:
    """For each batch its ids and their counts, and its part and documents. `GROUP_BYTES` of texts are taken together, but no text stays."""
    while True:
        held: list[tuple[int, pa.Array]] = []

        def texts() -> Iterator[pa.Array]:
            room = GROUP_BYTES
            for batch in batches:
                own = texts_of(batch, "text")
                room -= pc.sum(pc.binary_length(own)).as_py() or 0
                # a copy of the documents: a slice of the batch would keep its texts
                held.append((batch.column("part")[0].as_py(), batch.column("id").take(pa.array(range(batch.num_rows)))))
                del batch
                yield own
                if room <= 0:
                    return

        yield from zip(encoder.encode_group(texts()), held)
        if not held:
            return
        give_back(cycles=False)


def _encoded(sent, id_type: pa.DataType):
    """mapInArrow over a part in order: its ids in slices, and at the end how often each id occurs."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_process("token_files", str(zlib.crc32(sent.value.encode())) + str(len(sent.value)), lambda: PieceEncoder(sent.value))
        seen = np.zeros(0, np.int64)
        first = 0
        for (ids, counts), (part, docs) in _by_group(encoder, slices(batches, "text", SLICE_BYTES)):
            here = np.bincount(ids, minlength=len(seen))
            here[: len(seen)] += seen
            seen = here
            # blocks close with a document
            ends = np.cumsum(counts)
            begin = 0
            while begin < len(counts):
                before = int(ends[begin - 1]) if begin else 0
                stop = max(begin + 1, int(np.searchsorted(ends, before + BLOCK_TOKENS, side="right")))
                own = ids[before : int(ends[stop - 1])]
                yield _block_rows(part, first + before, docs.slice(begin, stop - begin), counts[begin:stop], own.astype("<u4"), id_type)
                begin = stop
            first += len(ids)
        encoder.forget()
        used = np.flatnonzero(seen)
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.list_(id_type)), pa.nulls(1, pa.list_(pa.int64())), pa.nulls(1, pa.binary()),
                 pa.array([used.tolist()], pa.list_(pa.int64())), pa.array([seen[used].tolist()], pa.list_(pa.int64()))], names=STAGED
            )

    return encode


STAGED = ["part", "first", "n", "docs", "sizes", "ids", "token", "times"]


def _block_rows(part: int, first: int, docs: pa.Array, counts: np.ndarray, ids: np.ndarray, id_type: pa.DataType) -> pa.RecordBatch:
    one = pa.array([0, len(docs)], pa.int32())
    small = ids.astype("<u2") if len(ids) and int(ids.max()) < 1 << 16 else ids
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([first], pa.int64()), pa.array([len(ids)], pa.int64()), pa.ListArray.from_arrays(one, docs),
         pa.array([counts.tolist()], pa.list_(pa.int64())), pa.array([small.tobytes()], pa.binary()), pa.nulls(1, pa.list_(pa.int64())), pa.nulls(1, pa.list_(pa.int64()))], names=STAGED
    )


def _coded(sent):
    """mapInArrow: the ids of staged rows become blocks."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(*sent.value)
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                n, raw = row.column("n")[0].as_py(), row.column("ids")[0].as_py()
                ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4")
                block = pa.array([encode_block(ids, table)], pa.binary())
                yield pa.RecordBatch.from_arrays([*[row.column(c) for c in ("part", "first", "n", "docs", "sizes")], block], names=["part", "first", "n", "docs", "sizes", "block"])

    return code


def write_tokens(docs: DataFrame, description: str, path: str, id: str = "doc_id", text: str = "text", part_bytes: int = PART_BYTES) -> None:
    """Write the ids of all texts, in ascending id order, below `path`: blocks/ and table/.

    `description` is the tokenizer's JSON. Every text ends with the id `END_ID`, so a null
    or empty text has one id. Rows that share an id follow each other by a hash of their
    texts; null ids come last. Texts that contain a special token's name are ordinary text.
    An empty table gives an empty file. Repeated rows are written each time. Other columns
    are not carried along, so their names cannot clash.
    """
    small_batches(docs)
    spark = docs.sparkSession
    rows = docs.select(docs[id].alias("id"), docs[text].alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(min(max(1, -(-size // part_bytes), min(spark.sparkContext.defaultParallelism, size >> 20)), MAX_PARTS))
    order = [F.col("id").asc_nulls_last(), F.xxhash64("text").asc()]
    placed = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order, "text").withColumn("part", F.spark_partition_id())
    kind = rows.schema["id"].dataType.simpleString()
    sent = spark.sparkContext.broadcast(description)
    from pyspark.sql.pandas.types import to_arrow_type

    schema = f"part int, first bigint, n bigint, docs array<{kind}>, sizes array<bigint>, ids binary, token array<bigint>, times array<bigint>"
    function = giving_back(_encoded(sent, to_arrow_type(rows.schema["id"].dataType)))
    staged = stored(placed.mapInArrow(function, schema), "token-ids", compression="zstd")
    seen = staged.filter("part IS NULL").select(F.explode(F.arrays_zip("token", "times")).alias("x"))
    # as many rows as the vocabulary has ids
    counts = seen.groupBy(F.col("x.token").alias("id")).agg(F.sum("x.times").alias("n")).orderBy("id").collect()
    table = frequency_table(np.array([r["id"] for r in counts], np.int64), np.array([r["n"] for r in counts], np.int64))
    spark.createDataFrame(
        [(int(i), int(f), table.bits) for i, f in zip(table.ids, table.freqs)], "id bigint, frequency bigint, bits int"
    ).coalesce(1).write.parquet(f"{path}/table")
    shared = spark.sparkContext.broadcast((table.ids, table.freqs, table.bits))
    blocks = staged.filter("part IS NOT NULL").select("part", "first", "n", "docs", "sizes", "ids")
    coded = blocks.mapInArrow(giving_back(_coded(shared)), f"part int, first bigint, n bigint, docs array<{kind}>, sizes array<bigint>, block binary")
    coded.write.option("compression", "none").parquet(f"{path}/blocks")


def read_table(spark: SparkSession, path: str) -> Table:
    """The frequency table of files that `write_tokens` wrote; as large as the vocabulary at most."""
    rows = spark.read.parquet(f"{path}/table").orderBy("id").collect()
    return Table(np.array([r["id"] for r in rows], np.int64), np.array([r["frequency"] for r in rows], np.int64), rows[0]["bits"] if rows else 12)


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """Blocks with `before`: the ids in all parts before theirs. There are at most `MAX_PARTS` parts."""
    blocks = spark.read.parquet(f"{path}/blocks")
    before, rows = 0, []
    for r in blocks.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():
        rows.append((r["part"], before))
        before += r["n"]
    return blocks.join(F.broadcast(spark.createDataFrame(rows, "part int, before bigint")), "part")


def _decoded(sent, make):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(*sent.value)
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                ids = decode_block(row.column("block")[0].as_py(), table)
                sizes = row.column("sizes").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                ends = np.cumsum(sizes)
                start = row.column("before")[0].as_py() + row.column("first")[0].as_py() + ends - sizes
                yield pa.RecordBatch.from_arrays([row.column("docs").flatten(), pa.array(start), pa.array(sizes), make(ids, ends, sizes)], names=["id", "start", "n_tokens", "made"])

    return decode


def _token_lists(ids: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids.astype(np.int32)))


def _checksums(ids: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> pa.Array:
    raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
    return pa.array([zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), sizes.tolist())], pa.int64())


def read_tokens(spark: SparkSession, path: str, id: str = "doc_id", digest: bool = False) -> DataFrame:
    """id, start (ids of all documents before it), n_tokens and tokens of each document of the files.

    With `digest`, ids_crc32 (of the ids as little-endian 32-bit numbers) in place of the
    tokens. Blocks are decoded where they are read, without a shuffle; a block whose
    checksum does not fit is an error. Empty files give no rows.
    """
    placed = _placed(spark, path)
    small_batches(placed)
    table = read_table(spark, path)
    sent = spark.sparkContext.broadcast((table.ids, table.freqs, table.bits))
    kind = placed.schema["docs"].dataType.elementType.simpleString()
    make, made, name = (_checksums, "bigint", "ids_crc32") if digest else (_token_lists, "array<int>", "tokens")
    rows = placed.select("before", "first", "docs", "sizes", "block").mapInArrow(giving_back(_decoded(sent, make)), f"id {kind}, start bigint, n_tokens bigint, made {made}")
    return rows.select(F.col("id").alias(id), "start", "n_tokens", F.col("made").alias(name))


def token_file_path(spark: SparkSession) -> str:
    return scratch_dir(spark, "token-files")
