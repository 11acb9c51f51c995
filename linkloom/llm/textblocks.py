"""Whole texts as byte blocks inside a task, and the words in them.

A task gets Arrow batches. Their text column is already one byte buffer with
offsets, so words, word hashes and word windows of many documents come out
of a few numpy passes instead of a Python loop per word. Blocks are cut at
document boundaries at about ``BLOCK_BYTES``; only a longer single document
makes a larger block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1_000_000
HASH_PIECE = 1_000_000
MAX_POWERS = 4096

SEPARATORS = np.zeros(256, dtype=bool)
SEPARATORS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit multipliers drawn from a counter."""
    with np.errstate(over="ignore"):
        return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                     + np.uint64(seed)) | np.uint64(1)


def _byte_table(lower: bool) -> np.ndarray:
    table = odd_constants(256, 17)
    if lower:
        table[ord("A"):ord("Z") + 1] = table[ord("a"):ord("z") + 1]
    return table


BYTE_VALUES = {False: _byte_table(False), True: _byte_table(True)}
BYTE_POWERS = odd_constants(MAX_POWERS, 29)


@dataclass
class TextBlock:
    """Bytes of consecutive documents; document i is data[offsets[i]:offsets[i + 1]]."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text_bytes(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


@dataclass
class Words:
    """Maximal runs of non-separator bytes: start, end and document of each."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray  # first[i]:first[i + 1] are the words of document i


def text_column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Byte buffer and offsets of a string column; null reads as empty."""
    col = batch.column(batch.schema.get_field_index(name))
    if not pa.types.is_string(col.type):
        col = col.cast(pa.string())
    if col.null_count:
        col = pc.fill_null(col, "")
    _, offsets, data = col.buffers()
    if len(col) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    off = np.frombuffer(offsets, np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf, off


def blocks(batch: pa.RecordBatch, name: str = "text",
           target: int = BLOCK_BYTES, most: int = 1 << 30) -> Iterator[tuple[int, int, TextBlock]]:
    """(first row, end row, block) over a batch; at most ``most`` rows a block."""
    data, off = text_column(batch, name)
    at, n = 0, len(off) - 1
    while at < n:
        stop = int(np.searchsorted(off, off[at] + target, side="right")) - 1
        stop = min(n, max(stop, at + 1), at + most)
        yield at, stop, TextBlock(data[off[at]:off[stop]], off[at:stop + 1] - off[at])
        at = stop


def split_words(block: TextBlock, separators: np.ndarray = SEPARATORS) -> Words:
    data, off = block.data, block.offsets
    n = len(data)
    inside = np.zeros(n + 1, dtype=bool)
    np.logical_not(separators[data], out=inside[:n])
    edge = np.zeros(n + 1, dtype=bool)  # a document begins here
    edge[off[:-1][off[:-1] < n]] = True
    begins = inside[:n].copy()
    begins[1:] &= ~inside[:n - 1] | edge[1:n] if n else False
    stops = inside[:n] & (~inside[1:] | edge[1:])
    if n:
        stops[n - 1] = inside[n - 1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(stops) + 1
    doc = np.searchsorted(off[1:], start, side="right")
    first = np.searchsorted(start, off, side="left")
    return Words(start, end, doc, first)


def hash_words(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit hash of each byte range (sorted, disjoint ranges)."""
    out = np.zeros(len(start), dtype=np.uint64)
    at = 0
    while at < len(start):
        stop = int(np.searchsorted(start, start[at] + HASH_PIECE))
        stop = max(stop, at + 1)
        if end[stop - 1] - start[at] > 2 * HASH_PIECE:  # ends in a very long one: that by pieces
            stop = max(stop - 1, at)
            if stop == at:
                total = int(end[at] - start[at])
                for low in range(int(start[at]), int(end[at]), HASH_PIECE):
                    high = min(low + HASH_PIECE, int(end[at]))
                    place = np.arange(low - start[at], high - start[at]) % MAX_POWERS
                    total += int((BYTE_VALUES[lower][data[low:high]] * BYTE_POWERS[place]).sum(dtype=np.uint64))
                out[at] = total & 0xFFFFFFFFFFFFFFFF
                at += 1
                continue
        lengths = end[at:stop] - start[at:stop]
        total = int(lengths.sum())
        heads = np.cumsum(lengths) - lengths
        within = np.arange(total) - np.repeat(heads, lengths)
        index = within + np.repeat(start[at:stop], lengths)
        value = BYTE_VALUES[lower][data[index]] * BYTE_POWERS[within % MAX_POWERS]
        out[at:stop] = np.add.reduceat(value, heads) + lengths.astype(np.uint64)
        at = stop
    return mix64(out)


def hash_windows(words: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the ``size``-word windows that stay in one document."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(doc[:n] == doc[size - 1:])
    factors = odd_constants(size, 43)
    value = np.zeros(len(at), dtype=np.uint64)
    for j in range(size):
        value += words[at + j] * factors[j]
    return at, mix64(value)


def n_code_points(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Code points of each document (bytes that do not continue one)."""
    heads = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    return heads[offsets[1:]] - heads[offsets[:-1]]
