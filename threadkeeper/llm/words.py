"""Vectorised words of Arrow text columns.

A word is a maximal run of bytes outside space and 0x09-0x0D, with A-Z folded
to lower case; its name is a 64-bit hash.  Everything works on the column's
own UTF-8 buffer, a bounded number of bytes at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

STEP = 1 << 18  # bytes whose powers are held at once
_MULT = np.uint64(0x9E3779B97F4A7C15 | 1)


def _inverse_pow2(x: int) -> int:
    return pow(x, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64))
FOLDED = np.arange(256, dtype=np.uint8)
FOLDED[ord("A") : ord("Z") + 1] += 32
BLOCKS = 64
LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NO_LETTER = np.zeros(256, bool)  # ASCII but for letters; bytes of other code points stay in words
NO_LETTER[:128] = [not chr(b).isalpha() for b in range(128)]
POW = _powers(int(_MULT), STEP + 1)
INV = _powers(_inverse_pow2(int(_MULT)), STEP + 1)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    if pa.types.is_large_string(column.type):
        column, kind = column, np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def slices(batch: pa.RecordBatch, column: str, most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Row ranges of a batch whose text has about ``most`` bytes (one row at least)."""
    _, at = text_buffer(batch.column(column))
    row, n = 0, batch.num_rows
    while row < n:
        end = int(np.searchsorted(at, at[row] + most, "right")) - 1
        end = min(n, max(end, row + 1))
        yield batch.slice(row, end - row)
        row = end


def word_bounds(data: np.ndarray, at: np.ndarray, blanks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions where words start and end; none crosses a text's edge."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    blank = blanks[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    before = np.empty(len(data), bool)  # a blank or a text's edge stands before the byte
    before[0] = True
    before[1:] = blank[:-1]
    before |= edge[:-1]
    after = np.empty(len(data), bool)
    after[-1] = True
    after[:-1] = blank[1:]
    after |= edge[1:]
    word = ~blank
    return np.flatnonzero(word & before), np.flatnonzero(word & after) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span with A-Z folded; equal bytes get equal hashes.

    Spans of up to ``BLOCKS`` bytes are mixed eight bytes at a time, so spans of
    one length up to eight never collide; a longer one gets its BLAKE2 digest."""
    size = ends - starts
    folded = np.zeros(len(data) + 8, np.uint8)
    folded[: len(data)] = FOLDED[data]
    eight = np.ndarray(len(data) + 1, "<u8", folded, strides=(1,))  # the eight bytes from each position on
    out = mix(size.astype(np.uint64) + _MULT)
    left = np.flatnonzero(size <= BLOCKS)
    for k in range(0, BLOCKS, 8):
        left = left[size[left] > k]
        if not len(left):
            break
        out[left] = mix(out[left] ^ (eight[starts[left] + k] & LOW_BYTES[np.minimum(size[left] - k, 8)]))
    for i in np.flatnonzero(size > BLOCKS):
        out[i] = int.from_bytes(hashlib.blake2b(folded[starts[i] : ends[i]], digest_size=8).digest(), "little")
    return out


def word_hashes(column: pa.Array, blanks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, first word of each text and the end)."""
    data, at = text_buffer(column)
    starts, ends = word_bounds(data, at, blanks)
    return span_hashes(data, starts, ends), np.searchsorted(starts, at)
