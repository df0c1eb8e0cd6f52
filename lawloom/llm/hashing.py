"""Word and shingle hashes of Arrow text columns, computed with numpy over whole batches."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in groups of about this many bytes, so that memory stays small.
CHUNK_BYTES = 1 << 19
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTE_KEYS = np.random.default_rng(20240).integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WHITE = np.zeros(256, dtype=bool)
_IS_WHITE[[32, 9, 10, 11, 12, 13]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread every bit of the input over the output (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_chunks(column: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    filled = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(filled.buffers()[1], dtype=np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = np.frombuffer(filled.buffers()[2] or b"", dtype=np.uint8)
    row = 0
    while row < len(filled):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + chunk_bytes, "right")) - 1)
        end = min(end, len(filled))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


@dataclass
class Words:
    """hash, first byte and end byte of every word; bounds[i]:bounds[i+1] are the words of text i."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray


def hash_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words are runs of non-white bytes within a text, hashed with A-Z lower-cased."""
    n = len(data)
    ink = np.concatenate(([False], ~_IS_WHITE[data], [False]))
    begins = ink[1:-1] & ~ink[:-2]
    stops = ink[1:-1] & ~ink[2:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    begins[inner] = ink[1:-1][inner]
    stops[inner - 1] = ink[1:-1][inner - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    powers = np.full(n, _ODD, dtype=np.uint64)
    if n:
        powers[0] = 1
    powers = np.multiply.accumulate(powers)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE_KEYS[_LOWER[data]] * powers, out=sums[1:])
    inverse = np.full(n, np.uint64(pow(int(_ODD), -1, 1 << 64)), dtype=np.uint64)
    if n:
        inverse[0] = 1
    inverse = np.multiply.accumulate(inverse)
    hashes = mix64((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return Words(hashes, starts, ends, np.searchsorted(starts, offsets))


def hash_windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each window of `size` consecutive words."""
    count = max(0, len(hashes) - size + 1)
    total = np.zeros(count, dtype=np.uint64)
    for k in range(size):
        total = mix64(total + hashes[k : k + count] * np.uint64(2 * k + 3))
    return total


def shingle_sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash), sorted and distinct: the shingles of every text.

    A text with fewer words than `size` has its whole sequence as its only shingle.
    """
    bounds = words.bounds
    counts = np.diff(bounds)
    text_of_word = np.repeat(np.arange(len(counts)), counts)
    windows = hash_windows(words.hashes, size)
    inside = text_of_word[: len(windows)] == text_of_word[size - 1 :][: len(windows)]
    texts, hashes = text_of_word[: len(windows)][inside], windows[inside]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        whole = [hash_windows(words.hashes[bounds[i] : bounds[i + 1]], counts[i])[0] ^ np.uint64(counts[i]) for i in short]
        texts, hashes = np.concatenate((texts, short)), np.concatenate((hashes, np.array(whole, dtype=np.uint64)))
    order = np.lexsort((hashes, texts))
    texts, hashes = texts[order], hashes[order]
    new = np.ones(len(texts), dtype=bool)
    new[1:] = (texts[1:] != texts[:-1]) | (hashes[1:] != hashes[:-1])
    return texts[new], hashes[new]
