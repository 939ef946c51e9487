"""Words of whole Arrow text columns, found and hashed by array operations.

A column's texts lie back to back in one byte buffer. All words of all texts are found
in one pass over it; no Python loop runs over texts or words. UTF-8 bytes of 0x80 and
above never are separators, so byte-wise splitting gives the words of the characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes that part words ``[^\x20\x09-\x0D]+``.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z are lower case.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

ODD = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0xD6E8FEB86659FD93)
MASKS = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of the result depends on every bit of ``x``."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_buffer(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins and the last ends. Null is empty."""
    texts = texts.cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, np.int64, n + 1, texts.offset * 8)
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    whole = np.frombuffer(data, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """The words of a column of texts: where each lies, and in which row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
        inside = is_word[data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        seams = offsets[1:-1]
        seams = seams[(seams > 0) & (seams < len(data))]
        first[seams] = inside[seams]
        last[seams - 1] = inside[seams - 1]
        self.data = data
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.starts, offsets)  # words of row r: bounds[r]:bounds[r + 1]
        self.counts = np.diff(self.bounds)
        self.rows = np.repeat(np.arange(len(offsets) - 1), self.counts)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes, eight bytes at a time."""
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eights = np.ndarray((len(self.data) + 1,), np.dtype("<u8"), padded, strides=(1,))
        length = self.ends - self.starts
        h = mix(length.astype(np.uint64) * ODD + STEP)
        if not len(h):
            return h
        h = mix(h ^ (eights[self.starts] & MASKS[np.minimum(length, 8)]))
        live, at = np.flatnonzero(length > 8), 8
        while len(live):
            part = eights[self.starts[live] + at] & MASKS[np.minimum(length[live] - at, 8)]
            h[live] = mix((h[live] * ODD) ^ part)
            at += 8
            live = live[length[live] > at]
        return h

    def of_row(self, row: int) -> slice:
        return slice(self.bounds[row], self.bounds[row + 1])


def space_words(texts: pa.Array | pa.ChunkedArray, lower: bool = False) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+``; with A-Z made lower case if asked."""
    data, offsets = text_buffer(texts)
    return Words(LOWER[data] if lower else data, offsets, ~SPACES)


def join_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash of two neighbouring sequences from the hashes of each."""
    return mix(left * STEP + right)


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` neighbours; runs across rows are included."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, at, power, size = None, 0, h, 1
    while size <= k:
        if k & size:
            part = power[at : at + n]
            out = part if out is None else join_hashes(out[:n], part)
            at += size
        size *= 2
        if size <= k:
            power = join_hashes(power[: -(size // 2)], power[size // 2 :])
    return mix(out + np.uint64(k))


def whole_runs(rows: np.ndarray, k: int) -> np.ndarray:
    """Starts of runs of ``k`` words that lie in one row."""
    n = len(rows) - k + 1
    return np.flatnonzero(rows[:n] == rows[k - 1 :]) if n > 0 else np.zeros(0, np.int64)


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most_bytes`` of text; a longer text comes alone.

    It keeps the memory of array operations over all bytes of a batch small.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offsets = text_buffer(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + most_bytes, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to
