"""Hashes of words and word shingles over Arrow text columns, whole batches at a time in numpy.

A word is a run of letters, digits and any characters beyond ASCII, in lower case; ASCII punctuation, spaces and
controls separate words. Hashes have 64 bits: equal words always agree, and different ones practically never do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SEPARATES = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
#: What a byte adds to its word's hash; nothing, if it separates.
_VALUES = np.where(_SEPARATES, 0, np.arange(1, 257)).astype(np.uint64)
#: Bytes of text hashed at a time; a longer text is taken alone.
CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, words of each text) of lower-case UTF-8 texts data[offsets[i]:offsets[i + 1]]."""
    separates = _SEPARATES[data]
    before = np.empty(len(data), dtype=bool)
    before[1:] = separates[:-1]
    before[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    starts = np.flatnonzero(~separates & before)
    counts = np.diff(np.searchsorted(starts, offsets))
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    first = starts[0]
    lengths = np.diff(np.append(starts, len(data)))
    at = np.arange(first, len(data), dtype=np.int32) - np.repeat(starts.astype(np.int32), lengths)
    part = _VALUES[data[first:]] * constants(int(lengths.max()), 11)[at]
    return mix(np.add.reduceat(part, starts - first)), counts


def shingles(words: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every k-word shingle, shingles of each text); a text of fewer words, if any, is one shingle."""
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(len(counts), np.int64)
    place = constants(k, 23)
    padded = np.append(words, np.zeros(k - 1, np.uint64))
    total = np.zeros(len(words), np.uint64)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(words))  # words from here to the text's end
    for j in range(k):
        total += np.where(left > j, padded[j : j + len(words)], np.uint64(0)) * place[j]
    first = np.zeros(len(words), dtype=bool)
    first[(np.cumsum(counts) - counts)[counts > 0]] = True
    return mix(total[(left >= k) | first]), np.where(counts > 0, np.maximum(counts - k + 1, 1), 0)


def chunks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of lower-case pieces of a text column without nulls, about CHUNK bytes each."""
    if not len(texts):
        return
    lower = pc.utf8_lower(texts)
    wide = np.int64 if pa.types.is_large_string(lower.type) else np.int32
    offsets = np.frombuffer(lower.buffers()[1], wide)[lower.offset : lower.offset + len(lower) + 1].astype(np.int64)
    data = np.frombuffer(lower.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(lower):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK, side="right")) - 1)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end
