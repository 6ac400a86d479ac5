"""Best-two-fit packing of documents into sequences of a fixed most length.

A document's tokens are cut into pieces only if they are longer than a sequence. Whole sequences
leave at once. The rest are packed in two levels, each task with one bounded pool at a time. A bin is
filled greedily with the longest piece that fits. Then its smallest piece may make way for two
unpacked pieces that fill the larger gap better: the pair with the largest sum that fits and that
exceeds what it replaces. Bins that stay visibly open are packed again in larger pools, made of
such pieces alone.

Words are independent in this tokenizer: its pre-tokenizer splits at white space. So each distinct
word of a block is tokenized once and the ids are laid out by array operations. A task holds the ids of one pool once
and copies them out a small batch at a time; the second level packs lengths, and a join brings the ids.

Null and empty texts give one token, the end mark. Repeated rows are packed each on its own. Order
and ties don't change the lengths of a pool; empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import os
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.tables import Scratch
from ledgerflow.llm.words import BLOCK_BYTES, give_back, span_hashes, text_blocks, word_spans


@dataclass(frozen=True)
class Packing:
    tokenizer: str
    length: int = 2048
    end_id: int = 0
    #: Tokens of the pieces that a task packs together.
    pool_tokens: int = 8 << 20
    #: A pool with so many pieces is packed as it is; only very short ones are as many.
    pool_pieces: int = 1 << 18
    #: Tokens of which a task packs left-over pieces together.
    second_pool_tokens: int = 16 << 20
    #: A bin with at least so much room is packed again.
    open_room: int = 16
    #: Words whose ids a worker remembers, at about 40 bytes each.
    cached_words: int = 1_500_000


#: Words that the tokenizer gets at once; what it returns takes far more memory than their ids.
ENCODED_WORDS = 4096


class WordTokenizer:
    """Ids of whole texts; a distinct word is tokenized once, and forgotten only when too many are known."""

    def __init__(self, path: str, cached_words: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.most = cached_words
        self.forget()

    def forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.starts, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.uint32)
        self.ids = np.zeros(0, np.uint32)

    def learn(self, hashes: np.ndarray, words: list[str]) -> None:
        sizes, ids = [], [self.ids]
        for at in range(0, len(words), ENCODED_WORDS):
            found = [x.ids for x in self.tokenizer.encode_batch_fast(words[at : at + ENCODED_WORDS], add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, found), np.uint32, len(found)))
            ids.append(np.fromiter((i for x in found for i in x), np.uint32, int(sizes[-1].sum())))
        starts = len(self.ids) + np.cumsum(np.concatenate(sizes), dtype=np.int64) - np.concatenate(sizes)
        self.ids = np.concatenate(ids)
        at = np.searchsorted(self.hashes, hashes)  # both in order
        self.hashes = np.insert(self.hashes, at, hashes)
        self.starts = np.insert(self.starts, at, starts)
        self.sizes = np.insert(self.sizes, at, np.concatenate(sizes))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and each text's first id."""
        starts, ends, first = word_spans(data, offsets)
        hashes, at, place = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.hashes) > self.most:
            self.forget()
        known = np.searchsorted(self.hashes, hashes)
        new = np.ones(len(hashes), bool)
        inside = known < len(self.hashes)
        new[inside] = self.hashes[known[inside]] != hashes[inside]
        if new.any():
            words = [data[starts[i] : ends[i]].tobytes().decode("utf-8", "replace") for i in at[new]]
            self.learn(hashes[new], words)
            known = np.searchsorted(self.hashes, hashes)
        where = known[place]
        sizes = self.sizes[where]
        total = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes, out=total[1:])
        take = np.repeat(self.starts[where] - total[:-1], sizes)
        take += np.arange(total[-1])
        return self.ids[take], total[first]


_TOKENIZERS: dict[tuple[str, int], WordTokenizer] = {}


def worker_tokenizer(path: str, cached_words: int) -> WordTokenizer:
    """The tokenizer of this process; a worker's next task finds the words of its last one."""
    key = (path, cached_words)
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = WordTokenizer(path, cached_words)
    return _TOKENIZERS[key]


def cut_points(first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, number and size of each piece, of documents with so many ids and an end mark."""
    sizes = np.diff(first) + 1
    pieces = -(-sizes // length)
    doc = np.repeat(np.arange(len(sizes)), pieces)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return doc, number, np.minimum(length, sizes[doc] - number * length)


def best_two_fit(lengths: np.ndarray, most: int) -> list[list[int]]:
    """Bins of piece numbers, each of at most `most` in total."""
    stock: dict[int, list[int]] = defaultdict(list)
    for i, size in enumerate(lengths.tolist()):
        stock[size].append(i)
    count = np.bincount(lengths, minlength=most + 1)
    present = count > 0
    left = len(lengths)

    def largest(room: int) -> int:
        """The longest unpacked length of at most `room`, or 0."""
        back = present[room::-1] if room >= 0 else present[:0]
        at = int(back.argmax()) if len(back) else 0
        return room - at if len(back) and back[at] and room - at > 0 else 0

    def draw(size: int) -> int:
        count[size] -= 1
        present[size] = count[size] > 0
        return stock[size].pop()

    def best_pair(room: int, beyond: int) -> tuple[int, int]:
        """Two unpacked lengths with the largest sum in (beyond, room], or zeros."""
        for total in range(room, beyond, -1):
            half = total // 2
            fits = present[1 : half + 1] & present[total - 1 : total - half - 1 : -1]
            if total % 2 == 0 and half and fits[half - 1] and count[half] < 2:
                fits[half - 1] = False
            if fits.any():
                small = int(fits.argmax()) + 1
                return small, total - small
        return 0, 0

    bins = []
    while left:
        packed, sizes, room = [], [], most
        while room and (size := largest(room)):
            packed.append(draw(size))
            sizes.append(size)
            room -= size
            left -= 1
        if room and left > 1:
            smallest = min(range(len(sizes)), key=sizes.__getitem__)
            a, b = best_pair(room + sizes[smallest], sizes[smallest])
            if a:
                back = sizes.pop(smallest)
                stock[back].append(packed.pop(smallest))
                count[back] += 1
                present[back] = True
                packed += [draw(a), draw(b)]
                left -= 1
        bins.append(packed)
    return bins


PLACED = "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"
#: Ids and rows of an Arrow batch of placed pieces, at most; one piece may have more ids.
BATCH_TOKENS, BATCH_ROWS = 1 << 18, 4096


def _lay_out(lengths: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pieces of one pool in the order of their sequences; each one's sequence, from 0, and place in it."""
    bins = best_two_fit(lengths, most)
    order = np.fromiter((i for b in bins for i in b), np.int64, len(lengths))
    sizes = np.fromiter(map(len, bins), np.int64, len(bins))
    sequence = np.repeat(np.arange(len(bins)), sizes)
    ahead = np.cumsum(lengths[order]) - lengths[order]
    offset = ahead - np.repeat(ahead[np.cumsum(sizes) - sizes], sizes) if len(bins) else ahead
    return order, sequence, offset


def _id_column(held: np.ndarray, begin: np.ndarray, length: np.ndarray) -> pa.Array:
    """The ids of some pieces, each from its first on, as bytes."""
    ends = np.cumsum(length)
    ids = held[np.arange(ends[-1]) + np.repeat(begin - (ends - length), length)]
    offsets = np.concatenate([[0], ends * held.itemsize]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])


def _placed(rows: pa.Table, held: np.ndarray, most: int, base: int) -> Iterator[pa.RecordBatch]:
    """The pieces of one pool with ids, place and their sequence's free tokens; sequences count from `base`.

    `held` has the ids of all pieces one after the other. They are copied a batch at a time.
    """
    length = rows["length"].to_numpy()
    order, sequence, offset = _lay_out(length, most)
    begin = (np.cumsum(length) - length)[order]
    length = length[order]
    room = most - np.bincount(sequence, weights=length).astype(np.int64)[sequence]
    ends = np.cumsum(length)
    at = 0
    while at < len(order):
        to = int(np.searchsorted(ends, ends[at] - length[at] + BATCH_TOKENS, side="right"))
        to = min(max(to, at + 1), at + BATCH_ROWS)
        part = rows.take(pa.array(order[at:to]))
        part = part.append_column("ids", _id_column(held, begin[at:to], length[at:to]))
        for name, values in (("sequence_id", sequence + base), ("offset", offset), ("room", room)):
            part = part.append_column(name, pa.array(values[at:to]))
        yield from part.combine_chunks().to_batches()
        at = to


def pack(docs: DataFrame, scratch: Scratch, p: Packing) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian 32 bit), sequence_id and offset of each piece."""

    def first_level(batches):
        from pyspark import TaskContext

        tokenizer = worker_tokenizer(p.tokenizer, p.cached_words)
        base = TaskContext.get().partitionId() << 36
        pool: list[pa.Table] = []
        held = np.empty(p.pool_tokens + BLOCK_BYTES, "<u4")  # the ids of the pool's pieces; takes memory where written
        pieces = tokens = 0

        def close():
            nonlocal base, pieces, tokens
            rows = pa.concat_tables(pool).combine_chunks()
            pool.clear()
            yield from _placed(rows, held[:tokens], p.length, base)
            base += rows.num_rows
            pieces = tokens = 0

        for part, data, offsets in text_blocks(batches):
            ids, first = tokenizer.encode(data, offsets)
            doc, number, size = cut_points(first, p.length)
            marked = np.insert(ids, first[1:], p.end_id).astype("<u4")  # an end mark after each text
            columns = [
                part.column("doc_id").take(pa.array(doc)),
                pa.array(number.astype(np.int32)),
                pa.array(number * p.length),
                pa.array(size),
            ]
            pool.append(pa.table(columns, names=["doc_id", "piece", "start", "length"]))
            if tokens + len(marked) > len(held):
                held = np.concatenate([held[:tokens], marked])
            else:
                held[tokens : tokens + len(marked)] = marked
            pieces += len(size)
            tokens += len(marked)
            if tokens >= p.pool_tokens or pieces >= p.pool_pieces:
                yield from close()
        if pool:
            yield from close()
        del held
        give_back()

    packed = docs.select("doc_id", "text").mapInArrow(first_level, f"{PLACED}, room long")
    packed = scratch.put("first", packed)
    closed = packed.where(F.col("room") < p.open_room).drop("room")
    opened = packed.where(F.col("room") >= p.open_room).drop("room")
    pools = max(1, -(-(opened.agg(F.sum("length")).first()[0] or 0) // p.second_pool_tokens))
    most = p.length

    def second_level(key, rows):
        rows = rows.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        order, sequence, offset = _lay_out(rows["length"].to_numpy(), most)
        moved = rows.select(["sequence_id", "offset"]).take(pa.array(order))
        moved = moved.append_column("to_sequence", pa.array(sequence - ((key[0].as_py() + 1) << 36)))
        return moved.append_column("to_offset", pa.array(offset))

    pool = F.pmod(F.xxhash64("sequence_id"), F.lit(pools))
    lengths = opened.select("sequence_id", "offset", "length")  # ids aren't gathered in a group
    moves = lengths.groupBy(pool.alias("pool")).applyInArrow(
        second_level, "sequence_id long, offset long, to_sequence long, to_offset long"
    )
    again = opened.join(moves, ["sequence_id", "offset"]).select(
        "doc_id", "piece", "start", "length", "ids", F.col("to_sequence").alias("sequence_id"), F.col("to_offset").alias("offset")
    )
    return closed.unionByName(again)
