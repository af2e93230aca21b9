"""Words of whole Arrow batches as arrays: byte classes in, starts, ends and word numbers out.

Words are runs of word bytes in UTF-8. Every class used here holds all bytes from 0x80 on, so runs of bytes are
runs of code points. Rows are taken in blocks of about ``max_bytes`` of text; a longer text is a block by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 3_000_000


def _table(word: str, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    fold = np.arange(256, dtype=np.uint8)
    if lower:
        fold[65:91] += 32
    if word == "alnum":
        ok = (fold >= 0x80) | ((fold >= 0x30) & (fold <= 0x39)) | ((fold >= 0x61) & (fold <= 0x7A))
    else:
        ok = ~((fold == 0x20) | ((fold >= 0x09) & (fold <= 0x0D)))
    return fold, ok


#: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z became a-z.
ALNUM = _table("alnum", True)
#: ``[^\\x20\\x09-\\x0D]+`` as it is, and after A-Z became a-z.
SPACED = _table("spaced", False)
SPACED_LOWER = _table("spaced", True)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def column_of(batch: pa.RecordBatch, path: str) -> pa.Array:
    """A column, or ``struct.field``."""
    name, _, field = path.partition(".")
    column = batch.column(batch.schema.get_field_index(name))
    return column.field(column.type.get_field_index(field)) if field else column


def blocks(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = BLOCK_BYTES
           ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with the bytes and offsets of column ``text``, which may be ``struct.field``."""
    for batch in batches:
        data, offsets = text_bytes(column_of(batch, text))
        first, n = 0, batch.num_rows
        while first < n:
            last = int(np.searchsorted(offsets, offsets[first] + max_bytes, side="right")) - 1
            last = min(max(last, first + 1), n)
            yield batch.slice(first, last - first), data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
            first = last


@dataclass
class Words:
    """Words of a block of rows: byte ranges, words before each row, word numbers and the word of each number."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    mask: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.rows)

    def numbered(self) -> tuple[np.ndarray, pa.Array]:
        """Number of each word and the distinct words (binary) in number order; equal numbers mean equal bytes."""
        lengths = self.ends - self.starts
        offsets = np.zeros(len(lengths) + 1, np.int64)
        np.cumsum(lengths, out=offsets[1:])
        packed = self.data[self.mask]
        array = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
        coded = array.dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def find_words(data: np.ndarray, offsets: np.ndarray, kind: tuple[np.ndarray, np.ndarray] = ALNUM) -> Words:
    """The words of each row; a word never crosses rows."""
    fold, ok = kind
    data = fold[data] if fold[65] != 65 else data
    mask = ok[data]
    first, last = mask.copy(), mask.copy()
    if len(mask):
        first[1:] &= ~mask[:-1]
        last[:-1] &= ~mask[1:]
        filled = offsets[:-1] < offsets[1:]
        heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
        first[heads] = mask[heads]
        last[tails] = mask[tails]
    starts = np.flatnonzero(first)
    return Words(data, starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets), mask)


def bits_for(n: int) -> int:
    """Bits that hold the numbers 0 .. n - 1, one at least."""
    return max(1, int(n - 1).bit_length())


def lines_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The \\n-separated lines of the rows: first line of each row; row, start and end of each line. Every row has one."""
    breaks = np.flatnonzero(data == 10)
    counts = np.searchsorted(breaks, offsets[1:]) - np.searchsorted(breaks, offsets[:-1]) + 1
    first = np.cumsum(counts) - counts
    rows = np.repeat(np.arange(len(counts)), counts)
    start, end = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
    head, tail = np.zeros(len(rows), bool), np.zeros(len(rows), bool)
    head[first], tail[first + counts - 1] = True, True
    start[head], start[~head] = offsets[:-1], breaks + 1
    end[tail], end[~tail] = offsets[1:], breaks
    return first, rows, start, end


def numbered_lines(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number for each line; equal numbers mean equal bytes. The lines cover all bytes but the line ends."""
    offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    packed = np.ascontiguousarray(data[data != 10])
    array = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
    return array.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def within(flags: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """How many flags are set in each range."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[end] - total[start]
