"""The texts of an Arrow batch as flat numpy arrays: words, lines, windows and their 64-bit hashes.

Everything works on UTF-8 bytes, over whole texts. A null text counts as empty. A chunk holds a few hundred texts, so
memory follows the chunk and not the batch; one text longer than a chunk is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
SHINGLE_WORDS = 5

_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xD6E8FEB86659FD93)


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags, true for bytes in the (first, last) ranges."""
    table = np.zeros(256, bool)
    for first, last in ranges:
        table[first:last + 1] = True
    return table


WHITE = byte_set((0x20, 0x20), (0x09, 0x0D))
#: All ASCII but digits and lower-case letters.
NOT_ALPHANUMERIC = byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser: every input bit reaches every output bit."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xA0761D6478BD642F)
    x ^= x >> np.uint64(32)
    return x


@dataclass
class Chunk:
    """Texts ``first`` to ``last`` (exclusive) of a batch: their bytes, and offsets from 0 with one more at the end."""
    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def texts(self) -> int:
        return self.last - self.first

    def lowered(self) -> Chunk:
        """A to Z in lower case, nothing else changed."""
        return Chunk(self.first, self.last, _LOWER[self.data], self.offsets)


@dataclass
class Spans:
    """Words or lines of a chunk in text order. ``bounds`` has the first span of each text, and the number of all."""
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def chunks(column: pa.Array | pa.ChunkedArray, most: int = CHUNK_BYTES) -> Iterator[Chunk]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    count = len(column)
    if not count:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + count + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    first = 0
    while first < count:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), count)
        yield Chunk(first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        first = last


def split(chunk: Chunk, separators: np.ndarray) -> Spans:
    """Runs of bytes that are not separators, never across two texts."""
    inside = ~separators[chunk.data]
    size = len(inside)
    edge = np.zeros(size + 1, bool)
    edge[chunk.offsets] = True
    before = np.empty(size, bool)
    after = np.empty(size, bool)
    if size:
        before[0], after[-1] = False, False
        before[1:] = inside[:-1]
        after[:-1] = inside[1:]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    bounds = np.searchsorted(start, chunk.offsets)
    return Spans(start, end, np.repeat(np.arange(chunk.texts), np.diff(bounds)), bounds)


def lines(chunk: Chunk) -> Spans:
    """What a split at each line feed gives, empty lines included; an empty text has one empty line."""
    feeds = np.flatnonzero(chunk.data == 10)
    start = np.concatenate([chunk.offsets[:-1], feeds + 1])
    end = np.concatenate([chunk.offsets[1:] , feeds])
    text_of_feed = np.searchsorted(chunk.offsets, feeds, "right") - 1
    text = np.concatenate([np.arange(chunk.texts), text_of_feed])
    order = np.lexsort((start, text))
    start, text = start[order], text[order]
    # Each line ends at the feed before the next line of the text, the last one at the end of the text.
    end = np.empty_like(start)
    last = np.ones(len(start), bool)
    last[:-1] = text[1:] != text[:-1]
    end[:-1] = start[1:] - 1
    end[last] = chunk.offsets[1:]
    return Spans(start, end, text, np.searchsorted(text, np.arange(chunk.texts + 1)))


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each span's bytes. Spans are in order and do not overlap; empty ones get a hash of their own."""
    length = end - start
    total = int(length.sum())
    if not total:
        return mix(np.zeros(len(start), np.uint64))
    powers = np.cumprod(np.full(int(length.max()), _P, np.uint64))
    at = np.cumsum(length) - length
    place = np.arange(total) - np.repeat(at, length)
    value = (data[place + np.repeat(start, length)].astype(np.uint64) + np.uint64(1)) * powers[place]
    summed = np.zeros(len(start), np.uint64)
    full = length > 0
    summed[full] = np.add.reduceat(value, at[full])
    return mix(summed + length.astype(np.uint64) * _Q)


def windows(words: Spans, hashes: np.ndarray, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of each run of ``size`` words within a text."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = np.flatnonzero(words.text[:count] == words.text[size - 1:])
    summed = np.zeros(len(inside), np.uint64)
    for i in range(size):
        summed = summed * _Q + hashes[inside + i]
    return mix(summed, 1), inside


def sorted_within(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A copy with each text's values sorted."""
    out = values.copy()
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a > 1:
            out[a:b].sort()
    return out


def repeated(values: np.ndarray, bounds: np.ndarray, first_too: bool) -> np.ndarray:
    """Flags of values that occur more than once in their text; without ``first_too`` the first occurrence is not one."""
    flags = np.zeros(len(values), bool)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a > 1:
            order = np.argsort(values[a:b], kind="stable")
            ranked = values[a:b][order]
            same = ranked[1:] == ranked[:-1]
            if same.any():
                flags[a + order[1:][same]] = True
                if first_too:
                    flags[a + order[:-1][same]] = True
    return flags


def shingle_sets(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Each text's set of five-word shingles as sorted distinct hashes, and the bounds of the sets.

    A-Z are lowered. A text with fewer words has its whole sequence as the only shingle, one without words none.
    """
    chunk = chunk.lowered()
    words = split(chunk, WHITE)
    hashes = hash_spans(chunk.data, words.start, words.end)
    found, first = windows(words, hashes)
    counts = words.counts
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE_WORDS))
    if len(short):
        alone = np.zeros(len(short), np.uint64)
        for i in range(SHINGLE_WORDS - 1):
            has = counts[short] > i
            alone[has] = alone[has] * _Q + hashes[words.bounds[short[has]] + i]
        text = np.concatenate([words.text[first], short])
        found = np.concatenate([found, mix(alone + counts[short].astype(np.uint64), 2)])
        order = np.argsort(text, kind="stable")
        text, found = text[order], found[order]
    else:
        text = words.text[first]
    edges = np.arange(chunk.texts + 1)
    ranked = sorted_within(found, np.searchsorted(text, edges))
    keep = np.ones(len(ranked), bool)
    keep[1:] = (ranked[1:] != ranked[:-1]) | (text[1:] != text[:-1])
    return ranked[keep], np.searchsorted(text[keep], edges)


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of each text's values."""
    total = np.concatenate([np.zeros(1, values.dtype if values.dtype != bool else np.int64), np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]
