"""Words of Arrow string columns as numpy arrays, without a Python object for each word."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

U64 = np.uint64
CHUNK_BYTES = 2 << 20

# The bytes \x20 and \x09-\x0D end a word; none of them is part of a longer UTF-8 character.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit values (a bijection)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
        return h ^ (h >> U64(31))


_BASE = 0x9E3779B97F4A7C15 | 5
_INVERSE = pow(_BASE, -1, 1 << 64)
_LETTER = mix(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93))


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        out = np.full(size, base, dtype=U64)
        out[0] = 1
        return np.multiply.accumulate(out)


def powers(base: int, size: int) -> np.ndarray:
    """base**0 .. base**(size-1) modulo 2**64."""
    return _powers(base, 1 << max(16, (size - 1).bit_length()))[:size]


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def string_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the n + 1 offsets into them; null is empty."""
    texts = texts.cast(pa.large_string() if not pa.types.is_large_binary(texts.type) else texts.type)
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_large_string(texts.type) else b"")
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each; a longer text is a range of its own."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(rows, max(high, low + 1))
        yield low, high
        low = high


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return _LOWER[data]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and n + 1 offsets that say which words a text has."""
    inside = ~_SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = offsets[:-1] < offsets[1:]
    heads, tails = offsets[:-1][full], offsets[1:][full] - 1
    first[heads], last[tails] = inside[heads], inside[tails]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


_TURN = U64(0xC2B2AE3D27D4EB4F)
#: Masks that keep the first k bytes of a word.
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)
SPANS_AT_ONCE = 1 << 18


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes.

    A span's words of eight bytes are scattered with their place before they are
    added up. A sum of letter times power would be shorter, but modulo 2**64 it
    is equal for certain unlike strings, whatever the base.
    """
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.as_strided(padded.view(np.uint8), (len(data) + 1, 8), (1, 1))
    out = np.zeros(len(starts), U64)
    for low in range(0, len(starts), SPANS_AT_ONCE):
        first, size = starts[low : low + SPANS_AT_ONCE], (ends - starts)[low : low + SPANS_AT_ONCE]
        count = (size + 7) // 8
        begin = np.cumsum(count) - count
        nth = np.arange(int(count.sum())) - np.repeat(begin, count)
        at = np.repeat(first, count) + 8 * nth
        word = np.ascontiguousarray(words[at]).view("<u8").ravel()
        word &= _KEEP[np.minimum(np.repeat(size, count) - 8 * nth, 8)]
        with np.errstate(over="ignore"):
            word = mix(word + (nth + 1).astype(U64) * _TURN)
            full = np.flatnonzero(count)
            total = np.zeros(len(first), U64)
            if len(full):
                total[full] = np.add.reduceat(word, begin[full])
            out[low : low + SPANS_AT_ONCE] = mix(total + size.astype(U64))
    return out


_PLACES = mix(np.arange(1, 65, dtype=U64)) | U64(1)


def shingles(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside a text, and n + 1 offsets by text.

    A text of fewer words gives its whole sequence as one, one without words none.
    """
    with np.errstate(over="ignore"):
        count = np.diff(bounds)
        made = np.where(count >= size, count - size + 1, np.minimum(count, 1))
        at = np.concatenate([[0], np.cumsum(made)])
        begin = np.repeat(bounds[:-1] - at[:-1], made) + np.arange(at[-1])
        length = np.repeat(np.minimum(count, size), made)
        total = length.astype(U64)
        for k in range(size):
            here = np.minimum(begin + k, max(len(hashes) - 1, 0))
            part = hashes[here] * _PLACES[k] if len(hashes) else np.zeros(0, U64)
            total = total + np.where(k < length, part, U64(0))
        return mix(total), at
