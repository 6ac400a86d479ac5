"""Byte-level BPE encoding and decoding by a rank queue.

A text is split into pre-tokens by a pattern. A pre-token that the rank file lists is one token; any
other starts as single bytes, of which the neighbouring pair with the lowest rank, the leftmost of
equals, is merged until no pair has a rank. Positions form a linked list. Each rank has a bucket of
positions where such a pair begins, and a bitmap of three levels of 64-bit words names the ranks
with a bucket: three find-first-set steps give the lowest one. A merge leaves stale entries in other
buckets, which are skipped when they come up, as the pair at their position has another rank by
then. So a pre-token of n bytes costs about n steps, whatever its length.

Whole texts are encoded where they are, without a shuffle; a text that is one pre-token of millions
of bytes is no special case. Workers remember the ids of short pre-tokens, up to a fixed number. The
rank file is read on the driver and broadcast; its size is that of the vocabulary.

Null and empty texts have no ids and decode to no bytes. Repeated rows get equal ids. An empty table
gives an empty result. Of `docs` only the kept columns and the text are read, so others may have any
name. A null id list counts as an empty one; an id outside the vocabulary raises.
"""

from __future__ import annotations

import base64
from array import array
from dataclasses import dataclass
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerflow.llm.words import text_blocks
from ledgerflow.session import read_text

LEVEL_BITS = 6
#: Pre-tokens of more characters are encoded each time they occur.
REMEMBERED_CHARS = 64
#: A worker forgets what it knows beyond so many pre-tokens or ids.
MOST_REMEMBERED = 400_000
MOST_REMEMBERED_IDS = 4_000_000


@dataclass(frozen=True)
class Vocabulary:
    """A rank file's text, one base64 token and its rank a line, and the pattern of pre-tokens."""

    ranks: str
    pattern: str

    @classmethod
    def load(cls, spark, path: str, pattern: str) -> Vocabulary:
        return cls(read_text(spark, path), pattern)

    def tokens(self) -> list[bytes]:
        """The bytes of each rank."""
        pairs = [line.split() for line in self.ranks.splitlines() if line]
        listed = {int(rank): base64.b64decode(token) for token, rank in pairs}
        return [listed.get(rank, b"") for rank in range(max(listed) + 1)]


class RankQueue:
    """Positions by rank; the lowest rank is found in a bitmap of three levels."""

    def __init__(self, ranks: int):
        if ranks > 1 << 3 * LEVEL_BITS:
            raise ValueError(f"the rank queue holds {1 << 3 * LEVEL_BITS} ranks, not {ranks}")
        self.buckets: dict[int, array] = {}
        self.low = [0] * (1 << 2 * LEVEL_BITS)
        self.middle = [0] * (1 << LEVEL_BITS)
        self.top = 0

    def fill(self, ranks: np.ndarray) -> None:
        """Enter each place under its rank; places with rank -1 are left out."""
        order = np.argsort(ranks, kind="stable").astype(np.int32)
        order = order[np.searchsorted(ranks[order], 0) :]
        sorted_ranks = ranks[order]
        begins = np.flatnonzero(np.diff(sorted_ranks, prepend=-1)).tolist()
        for rank, begin, end in zip(sorted_ranks[begins].tolist(), begins, [*begins[1:], len(order)]):
            self.push(rank, int(order[begin]))
            self.buckets[rank].frombytes(order[begin + 1 : end].tobytes())

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = array("i", (position,))
            word, group = rank >> LEVEL_BITS, rank >> 2 * LEVEL_BITS
            self.low[word] |= 1 << (rank & 63)
            self.middle[group] |= 1 << (word & 63)
            self.top |= 1 << group
        else:
            bucket.append(position)

    def pop(self) -> tuple[int, list[int]] | None:
        """The lowest rank with a bucket and its positions from left to right."""
        if not self.top:
            return None
        group = _first_set(self.top)
        word = group << LEVEL_BITS | _first_set(self.middle[group])
        rank = word << LEVEL_BITS | _first_set(self.low[word])
        self.low[word] &= self.low[word] - 1
        if not self.low[word]:
            self.middle[group] &= self.middle[group] - 1
            if not self.middle[group]:
                self.top &= self.top - 1
        return rank, sorted(self.buckets.pop(rank))


def _first_set(word: int) -> int:
    return (word & -word).bit_length() - 1


class Encoder:
    """Ids of texts, with a memory of short pre-tokens."""

    def __init__(self, vocabulary: Vocabulary):
        tokens = vocabulary.tokens()
        self.ranks = {token: rank for rank, token in enumerate(tokens) if token}
        self.one = np.array([self.ranks[bytes((c,))] for c in range(256)], np.int32)
        self.two = np.array([self.ranks.get(bytes((c >> 8, c & 255)), -1) for c in range(1 << 16)], np.int32)
        self.split = regex.compile(vocabulary.pattern).findall
        self.queue = RankQueue(len(tokens))
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.begins, self.ids = array("q", [0]), array("I")

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens that aren't empty, and where each one's begin, the end at last.

        All go through one queue: merges in one pre-token don't touch another, so the order among them
        doesn't matter.
        """
        whole = b"".join(pieces)
        size = len(whole)
        data = np.frombuffer(whole, np.uint8)
        bounds = np.concatenate([[0], np.cumsum([len(piece) for piece in pieces], dtype=np.int64)])
        begin = np.zeros(size + 1, np.uint8)
        begin[bounds] = 1
        ids, pairs = self.one[data], np.full(size, -1, np.int32)
        pairs[:-1] = self.two[data[:-1].astype(np.int32) << 8 | data[1:]]
        pairs[begin[1:] > 0] = -1
        for at, listed in enumerate(map(self.ranks.get, pieces)):
            if listed is not None:  # one token, whatever its parts would give
                ids[bounds[at] : bounds[at + 1]] = -1
                ids[bounds[at]] = listed
                pairs[bounds[at] : bounds[at + 1]] = -1
        queue, rank_of, begins = self.queue, self.ranks.get, begin.tobytes()
        queue.fill(pairs)
        after = array("i", np.arange(1, size + 1, dtype=np.int32).tobytes())  # where the next token begins
        before = array("i", np.arange(-1, size - 1, dtype=np.int32).tobytes())
        # The token that begins at i, and the rank of it with the next one; -1 where there is none.
        token, pair = array("i", ids.tobytes()), array("i", pairs.tobytes())
        push = queue.push
        while (lowest := queue.pop()) is not None:
            rank, places = lowest
            for at, i in enumerate(places):
                if pair[i] != rank:
                    continue  # stale
                j = after[i]
                after[i] = end = after[j]
                token[i] = rank
                token[j] = pair[j] = new = -1
                if not begins[end]:
                    before[end] = i
                    new = rank_of(whole[i : after[end]], -1)
                    if new >= 0:
                        push(new, i)
                pair[i] = new
                if not begins[i]:
                    left = before[i]
                    pair[left] = wider = rank_of(whole[left:end], -1)
                    if wider >= 0:
                        push(wider, left)
                        if wider < rank:
                            new = wider
                if 0 <= new < rank:  # the new pair goes first
                    for rest in places[at + 1 :]:
                        push(rank, rest)
                    break
        ids = np.frombuffer(token, np.int32)
        alive = np.flatnonzero(ids >= 0)
        return ids[alive].astype(np.uint32), np.searchsorted(alive, bounds)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's begin, the end at last."""
        if len(self.known) > MOST_REMEMBERED or len(self.ids) > MOST_REMEMBERED_IDS:
            self.forget()
        known = self.known
        split = list(map(self.split, texts))
        counts = list(map(len, split))
        pieces = list(chain.from_iterable(split))
        new = list(dict.fromkeys(filterfalse(known.__contains__, pieces)))
        if new:
            self._learn(new)
        place = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
        for piece in new:
            if len(piece) > REMEMBERED_CHARS:
                del known[piece]
        begins, ids = np.frombuffer(self.begins, np.int64), np.frombuffer(self.ids, np.uint32)
        sizes = begins[place + 1] - begins[place]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        out = ids[np.arange(ends[-1]) + np.repeat(begins[place] - ends[:-1], sizes)]
        return out, ends[np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])]

    def _learn(self, pieces: list[str]) -> None:
        ids, at = self.merge([piece.encode() for piece in pieces])
        first = len(self.begins) - 1
        self.begins.frombytes((at[1:] + len(self.ids)).astype(np.int64).tobytes())
        self.ids.frombytes(ids.tobytes())
        self.known.update(zip(pieces, range(first, first + len(pieces))))


#: The encoder of this worker, kept between its tasks.
_ENCODERS: dict[Vocabulary, Encoder] = {}


def _encoder(vocabulary: Vocabulary) -> Encoder:
    if vocabulary not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[vocabulary] = Encoder(vocabulary)
    return _ENCODERS[vocabulary]


def encode_texts(docs: DataFrame, vocabulary: Vocabulary, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` and `ids`: the ids of the whole text as little-endian unsigned 32-bit integers."""
    rows = docs.select(*keep, "text")
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        encoder = _encoder(shared.value)
        for part, _, _ in text_blocks(batches):
            texts = part.column(len(keep))
            ids, at = encoder.encode(["" if text is None else text for text in texts.to_pylist()])
            kept = part.columns[: len(keep)]
            yield pa.RecordBatch.from_arrays([*kept, _binary(ids.astype("<u4").view(np.uint8), at * 4)], [*keep, "ids"])

    return rows.mapInArrow(run, _with(rows.drop("text").schema, "ids"))


def decode_ids(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """All columns of `encoded`, and `decoded`: the bytes of its `ids`."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)
    place = encoded.columns.index("ids")

    def run(batches):
        tokens = shared.value.tokens()
        begins = np.concatenate([[0], np.cumsum([len(token) for token in tokens])])
        data = np.frombuffer(b"".join(tokens), np.uint8)
        for part, raw, offsets in text_blocks(_as_large(batches, place), "ids"):
            ids = np.ascontiguousarray(raw).view("<u4").astype(np.int64)
            if len(ids) and ids.max() >= len(tokens):
                raise ValueError(f"id {ids.max()} is outside the vocabulary of {len(tokens)}")
            sizes = begins[ids + 1] - begins[ids]
            ends = np.concatenate([[0], np.cumsum(sizes)])
            out = data[np.arange(ends[-1]) + np.repeat(begins[ids] - ends[:-1], sizes)]
            columns = [column.cast(pa.binary()) if i == place else column for i, column in enumerate(part.columns)]
            yield pa.RecordBatch.from_arrays([*columns, _binary(out, ends[offsets // 4])], [*part.schema.names, "decoded"])

    return encoded.mapInArrow(run, _with(encoded.schema, "decoded"))


def _with(schema: T.StructType, name: str) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(name, T.BinaryType())])


def _as_large(batches, place: int):
    """Batches whose id lists aren't null."""
    for batch in batches:
        columns = list(batch.columns)
        columns[place] = pc.fill_null(columns[place].cast(pa.large_binary()), b"")
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names)


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A column of byte strings over one buffer."""
    if offsets[-1] >= 1 << 31:
        buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
        return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, buffers).cast(pa.binary())
    buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers)
