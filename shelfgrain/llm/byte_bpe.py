"""Byte-level BPE by dynamic programming over prefixes.

Every byte prefix of a piece has exactly one valid last token: a token t ending there such
that the last token of what comes before t, and t, stay two tokens when merged together.
A table of these last tokens is enough to encode: walk it back from the end. It is also
enough to append bytes (new prefixes only look back) and to encode again near an edit
(prefixes before it stay; after it the table meets the old one once as many prefixes agree
as the longest token has bytes).

Ranks are read from a vocabulary file on the driver and sent to the tasks; the file's size
bounds what is sent. Texts are split by a pattern first and pieces are encoded one by one.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import giving_back, per_process, slices, small_batches, texts_of

# what a process may remember of pieces, words and pairs of tokens, in bytes, until its task ends
CACHE_BYTES = 128 << 20
# a remembered entry takes about this much beside its text and ids: two objects and a place in a dict
ENTRY_BYTES, PAIR_BYTES, ID_BYTES = 170, 100, 8
# longer pieces are rare and not worth remembering
CACHED_BYTES = 64
# a piece's match looks at most this far past its start or one character past its end
PATTERN_REACH = 3


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


class Vocabulary:
    """Ranks, and which two tokens may stand side by side."""

    def __init__(self, ranks: dict[bytes, int], room: int = CACHE_BYTES):
        self.ranks = ranks
        self.whole_room = self.room = room
        self.size = max(ranks.values()) + 1
        self.bytes_of = [b""] * self.size
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.longest = max(map(len, ranks))
        self._right: dict[int, list[tuple[bytes, float]]] = {}
        self._left: dict[int, list[tuple[bytes, float]]] = {}
        self._stays: dict[int, bool] = {}
        self._merged: dict[int, tuple[bytes, bytes] | None] = {}
        self._lengths = [len(token) for token in self.bytes_of]
        # finds all tokens in a piece; bytes stand as the characters of the same number
        self._automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if self.parts(rank) != (b"", b""):
                self._automaton.add_word(token.decode("latin-1"), rank)
        self._automaton.make_automaton()

    def parts(self, rank: int) -> tuple[bytes, bytes] | None:
        """The two tokens whose merge makes this one; None for a single byte.

        A token that merging its own bytes never makes has no parts and gives (b"", b"").
        """
        if rank not in self._merged:
            token = self.bytes_of[rank]
            pieces = [token[i : i + 1] for i in range(len(token))]
            while len(pieces) > 2:
                best = min(range(len(pieces) - 1), key=lambda i: (self.ranks.get(pieces[i] + pieces[i + 1], math.inf), i))
                if pieces[best] + pieces[best + 1] not in self.ranks:
                    break
                pieces[best : best + 2] = [pieces[best] + pieces[best + 1]]
            self._merged[rank] = None if len(token) == 1 else (pieces[0], pieces[1]) if len(pieces) == 2 else (b"", b"")
        return self._merged[rank]

    def _spine(self, rank: int, side: int) -> list[tuple[bytes, float]]:
        """Tokens along one edge of the merge tree, from the single byte up, each with the rank at which it is merged away."""
        known = self._right if side else self._left
        if rank not in known:
            up: list[tuple[bytes, float]] = [(self.bytes_of[rank], math.inf)]
            while (parts := self.parts(self.ranks[up[-1][0]])) is not None:
                up.append((parts[side], self.ranks[up[-1][0]]))
            known[rank] = up[::-1]
        return known[rank]

    def stay_apart(self, first: int, second: int) -> bool:
        """Whether merging the bytes of both tokens gives these two tokens; remembered, up to a bound.

        They do unless, at some time, the parts that meet at the border could merge before
        either is merged away; at equal ranks the leftmost merge goes first.
        """
        found = self._stays.get(first * self.size + second)
        if found is None:
            left, right = self._spine(first, 1), self._spine(second, 0)
            i = j = 0
            while True:
                (a, a_ends), (b, b_ends) = left[i], right[j]
                across = self.ranks.get(a + b, math.inf)
                if across < a_ends and across <= b_ends and across < math.inf:
                    found = False
                    break
                if a_ends == b_ends == math.inf:
                    found = True
                    break
                if a_ends <= b_ends:
                    i += 1
                else:
                    j += 1
            if self.room > 0:
                self.room -= PAIR_BYTES
                self._stays[first * self.size + second] = found
        return found

    def forget(self) -> None:
        """Give up what was remembered, the room is whole again."""
        for known in (self._right, self._left, self._stays):
            known.clear()
        self.room = self.whole_room

    def extend(self, data: bytes, last: list[int], upto: int) -> None:
        """Append to `last` the last tokens of the prefixes of `data` up to `upto` bytes.

        The automaton gives every token at every end, in order of the ends, so the prefix
        before a token already has its own last token, against which the token is tried.
        No more than one token can be right for each end.
        """
        known, size, lengths = self._stays.get, self.size, self._lengths
        done = len(last) - 1
        last += [-1] * (upto - done)
        base = max(0, done - self.longest + 1)
        for end, rank in self._automaton.iter(data[base:upto].decode("latin-1")):
            end += base + 1
            if end <= done or last[end] >= 0:
                continue
            start = end - lengths[rank]
            if start:
                before = last[start]
                apart = known(before * size + rank)
                if apart is None:
                    apart = self.stay_apart(before, rank)
                if not apart:
                    continue
            last[end] = rank
        if -1 in last[done + 1 :]:
            raise ValueError("the vocabulary lacks a single byte")

    def walk_back(self, last: list[int]) -> list[int]:
        out, end = [], len(last) - 1
        while end:
            out.append(last[end])
            end -= len(self.bytes_of[last[end]])
        return out[::-1]


class PrefixTable:
    """The last token of each prefix of a byte string, with exact appends and edits."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = b""
        self.last = [-1]
        self.append(data)

    def append(self, data: bytes) -> None:
        self.data += data
        self.vocabulary.extend(self.data, self.last, len(self.data))

    def edit(self, start: int, stop: int, data: bytes) -> int:
        """Replace bytes start:stop; returns the number of prefixes that were worked out anew."""
        behind = self.last[stop:]
        self.data = self.data[:start] + data + self.data[stop:]
        self.last = self.last[: start + 1]
        shift, agree = start + len(data), 0
        for end in range(start + 1, len(self.data) + 1):
            self.vocabulary.extend(self.data, self.last, end)
            # behind[0] belongs to the prefix that ends where the change does
            if end > shift:
                agree = agree + 1 if self.last[end] == behind[end - shift] else 0
                if agree >= self.vocabulary.longest:
                    self.last += behind[end - shift + 1 :]
                    return end - start
        return len(self.data) - start

    def tokens(self) -> list[int]:
        return self.vocabulary.walk_back(self.last)


class Encoder:
    """Texts to token ids and back. Encodings of short pieces and words are remembered, up to a bound in bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, room: int = CACHE_BYTES):
        self.vocabulary = Vocabulary(ranks, room)
        self._numbers = list(range(self.vocabulary.size))  # one object for each id
        self.pattern = regex.compile(pattern)
        self._pieces: dict[str, tuple[int, ...]] = {}
        self._words: dict[str, tuple[int, ...]] = {}

    def piece(self, piece: str) -> tuple[int, ...]:
        """Ids of one piece. A piece that is a token as a whole is that token."""
        found = self._pieces.get(piece)
        if found is None:
            data = piece.encode()
            rank = self.vocabulary.ranks.get(data)
            if rank is not None:
                found = (rank,)
            else:
                last = [-1]
                self.vocabulary.extend(data, last, len(data))
                found = tuple(map(self._numbers.__getitem__, self.vocabulary.walk_back(last)))
            if len(data) <= CACHED_BYTES and self._has_room(piece, found):
                self._pieces[piece] = found
        return found

    def _has_room(self, text: str, ids: tuple[int, ...]) -> bool:
        if self.vocabulary.room <= 0:
            return False
        self.vocabulary.room -= ENTRY_BYTES + len(text) + ID_BYTES * len(ids)
        return True

    def forget(self) -> None:
        self._pieces.clear()
        self._words.clear()
        self.vocabulary.forget()

    def word(self, word: str) -> tuple[int, ...] | None:
        """Ids of a word with a space before it; None where the space might belong to what precedes it."""
        if not word or word[0].isspace():
            return None
        pieces = self.pattern.findall(" " + word)
        if len(pieces) == 1:
            found = self.piece(pieces[0])
        else:
            ids: list[int] = []
            for piece in pieces:
                ids += self._pieces.get(piece) or self.piece(piece)
            found = tuple(ids)
        if len(word) <= CACHED_BYTES and self._has_room(word, found):
            self._words[word] = found
        return found

    def encode(self, text: str) -> list[int]:
        """A space before a word starts a piece, whatever is around, so words are looked up whole.

        Only runs of blanks need the pattern over the whole text.
        """
        head, *rest = text.split(" ")
        known, one = self._words.get, self.word
        out = [t for piece in self.pattern.findall(head) for t in self.piece(piece)]
        for word in rest:
            ids = known(word) or one(word)
            if ids is None:
                return [t for piece in self.pattern.findall(text) for t in self.piece(piece)]
            out += ids
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids))


class EncodedText:
    """A text with its pieces, changed in place; only pieces near a change are encoded again."""

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder = encoder
        self.text = ""
        self.ends: list[int] = []
        self.ids: list[tuple[int, ...]] = []
        self.edit(0, 0, text)

    def append(self, text: str) -> int:
        return self.edit(len(self.text), len(self.text), text)

    def edit(self, start: int, stop: int, new: str) -> int:
        """Replace characters start:stop; returns the number of pieces split anew.

        Matching starts afresh at every piece, so pieces that end well before the change
        stay, and once a new piece ends where an old one did, behind the change, so do all
        that follow.
        """
        import bisect

        keep = bisect.bisect_right(self.ends, start - PATTERN_REACH)
        shift = len(new) - (stop - start)
        self.text = self.text[:start] + new + self.text[stop:]
        old = {end + shift: i for i, end in enumerate(self.ends) if end >= stop}
        ends, ids = self.ends[:keep], self.ids[:keep]
        at, done = (ends[-1] if ends else 0), 0
        for match in self.encoder.pattern.finditer(self.text, at):
            ends.append(match.end())
            ids.append(self.encoder.piece(match.group()))
            done += 1
            if match.end() in old and match.end() >= start + len(new):
                rest = old[match.end()] + 1
                ends += [end + shift for end in self.ends[rest:]]
                ids += self.ids[rest:]
                break
        self.ends, self.ids = ends, ids
        return done

    def tokens(self) -> list[int]:
        return [t for ids in self.ids for t in ids]


def encode_texts(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, tokens (list of ids) and decoded (bytes of the ids) of every row, null text as empty.

    Rows stay where they are: no shuffle. Repeated rows and null ids are rows like others.
    An empty text has no tokens. An empty table gives an empty table.
    """
    return _per_text(docs, ranks, pattern, id, text, "tokens array<int>, decoded binary", _ids_and_bytes)


def digest_texts(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256 and decoded_sha256 of every row: `encode_texts` without moving the ids out of Python."""
    return _per_text(docs, ranks, pattern, id, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", _digests)


def _ids_and_bytes(encoder: Encoder, texts: list[str]) -> list[pa.Array]:
    ids = [encoder.encode(t) for t in texts]
    return [pa.array(ids, pa.list_(pa.int32())), pa.array([encoder.decode(x) for x in ids], pa.binary())]


def _digests(encoder: Encoder, texts: list[str]) -> list[pa.Array]:
    decimals = [b"%d" % i for i in range(encoder.vocabulary.size)]
    counts, of_ids, of_bytes = [], [], []
    for text in texts:
        ids = encoder.encode(text)
        counts.append(len(ids))
        of_ids.append(hashlib.sha256(b",".join(map(decimals.__getitem__, ids))).hexdigest())
        of_bytes.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
    return [pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]


def _per_text(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id: str, text: str, columns: str, make) -> DataFrame:
    small_batches(docs)
    sent = docs.sparkSession.sparkContext.broadcast(ranks)
    rows = docs.select(docs[id].alias("id"), docs[text].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    key = hashlib.sha256(repr((pattern, sorted(ranks.items(), key=lambda x: x[1]))).encode()).hexdigest()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_process("byte_bpe", key, lambda: Encoder(sent.value, pattern))
        for batch in slices(batches, "text"):
            made = make(encoder, texts_of(batch, "text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("id"), *made], names=["id", *[c.split()[0] for c in columns.split(", ")]])
        encoder.forget()

    return rows.mapInArrow(giving_back(encoded), f"id {kind}, {columns}").withColumnRenamed("id", id)
