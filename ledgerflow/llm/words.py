"""Words of many texts at once, as arrays over one buffer of UTF-8 bytes.

A word is a run of bytes other than space and 0x09 to 0x0D. These separators are single bytes in
UTF-8, so words can be found without decoding. Hashes are 64 bit and depend on content alone.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes handled at a time; a longer text forms a block of its own.
BLOCK_BYTES = 1 << 20
#: The same where nothing is shared between texts: the arrays over a block then stay in the processor's cache.
SMALL_BLOCK_BYTES = 1 << 17
#: Bytes whose hashes are computed together; the arrays over them take eight times as much.
HASHED_BYTES = 1 << 18

IN_WORD = np.ones(256, bool)
IN_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Letters and digits: ASCII ones, and every byte of other characters.
ALPHANUMERIC = np.array([chr(c).isalnum() or c >= 128 for c in range(256)])

_BYTE_CODES = np.random.default_rng(20240501).integers(1, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every input bit reaches every output bit."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers() -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, as many as bytes are hashed together."""
    if not _POWERS:
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            steps = np.full(HASHED_BYTES + 1, base, np.uint64)
            steps[0] = 1
            _POWERS.append(np.cumprod(steps, dtype=np.uint64))
    return _POWERS


def _long_hash(span: np.ndarray) -> np.uint64:
    """The hash of a span of more bytes than are hashed together, from the sums of its parts."""
    if len(span) > 2 * BLOCK_BYTES:
        return np.uint64(int.from_bytes(hashlib.blake2b(span.tobytes(), digest_size=8).digest(), "little"))
    total = len(span)
    for at in range(0, len(span), HASHED_BYTES):
        part = span[at : at + HASHED_BYTES]
        total += int((_BYTE_CODES[part] * _powers()[0][: len(part)]).sum()) * pow(_BASE, at, 2**64)
    return mix(np.array([total % 2**64], np.uint64))[0]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span; spans are in order and don't overlap."""
    powers, inverse = _powers()
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        to = int(np.searchsorted(ends, base + HASHED_BYTES, side="right"))
        if to <= at:
            out[at] = _long_hash(data[base : int(ends[at])])
            at += 1
            continue
        piece = data[base : int(ends[to - 1])]
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_BYTE_CODES[piece] * powers[: len(piece)], out=sums[1:])
        s, e = starts[at:to] - base, ends[at:to] - base
        out[at:to] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))
        at = to
    return out


def word_spans(
    data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray = IN_WORD
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte positions where words start and end, and each text's first word, one past the last at the end."""
    inside = in_word[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[offsets[offsets < len(data)]] = False
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[offsets[offsets > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def text_sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of each text's positions are set."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def owners(first: np.ndarray) -> np.ndarray:
    """The text of each item, given each text's first item."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def windows(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each run of `width` words that lies within one text."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    last = np.repeat(first[1:], np.diff(first))[:count]
    starts = np.flatnonzero(np.arange(count) + width <= last)
    total = np.zeros(len(starts), np.uint64)
    for k in range(width):
        total += hashes[starts + k] * np.uint64(pow(_BASE, k + 1, 2**64))
    return starts, mix(total)


def give_back() -> None:
    """Return to the system what a task has freed; a worker lives on after it and would keep that memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def text_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and each text's first byte; a null text has no bytes."""
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, values = column.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(values, np.uint8)[offsets[0] : offsets[-1]] if values is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def text_blocks(
    batches: Iterator[pa.RecordBatch], column: str = "text", block: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Consecutive rows with about a block of text: the rows, their bytes, and each text's first byte."""
    for batch in batches:
        data, offsets = text_arrays(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + block, side="right")) - 1)
            yield batch.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
            at = to
        del batch, data, offsets  # before the next one arrives
        give_back()
