"""Elias-Fano sequences and a two-level n-gram trie made of them, for whole arrays of queries."""

from __future__ import annotations

import tempfile

import numpy as np

_ONE, _WORD = np.uint64(1), np.uint64(64)


def _set_bits(positions: np.ndarray, length: int) -> np.ndarray:
    bits = np.zeros((length + 63) // 64 * 64 + 64, dtype=np.uint8)
    bits[positions] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


class EliasFano:
    """A sequence that never falls, of n numbers below a universe, in about 2 + log2(universe / n) bits each.

    Low bits are packed side by side; high parts are the gaps between ones of a bit string.
    """

    def __init__(self, values: np.ndarray, universe: int):
        n = len(values)
        self.n = n
        self.low_bits = max(0, (int(universe) // max(n, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        low = values & np.uint64((1 << self.low_bits) - 1)
        high = (values >> np.uint64(self.low_bits)).astype(np.int64)
        self.high = _set_bits(high + np.arange(n), n + (int(universe) >> self.low_bits) + 1)
        shifts = np.arange(self.low_bits, dtype=np.uint64)
        packed = np.zeros(n * self.low_bits // 64 + 2, dtype=np.uint64)
        for first in range(0, n, 1 << 16):  # a stretch at a time: a byte for each bit
            part = low[first : first + (1 << 16)]
            bits = ((part[:, None] >> shifts) & _ONE).astype(np.uint8).ravel()
            words = np.packbits(np.concatenate((bits, np.zeros(-len(bits) % 64, dtype=np.uint8))), bitorder="little")
            at = first * self.low_bits // 64  # 65536 numbers fill whole words
            packed[at : at + len(words) // 8] = words.view(np.uint64)
        self.low = packed
        self.ones_before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.high), dtype=np.int64)))

    def arrays(self) -> dict[str, np.ndarray]:
        return {"high": self.high, "low": self.low, "ones_before": self.ones_before}

    def __getitem__(self, index: np.ndarray) -> np.ndarray:
        """The numbers at the given places."""
        word = np.searchsorted(self.ones_before, index, "right") - 1
        rest = (index - self.ones_before[word]).astype(np.uint64)
        bits, place = self.high[word].copy(), np.zeros(len(index), dtype=np.uint64)
        for width in (32, 16, 8, 4, 2, 1):  # the place of one number `rest` of the word
            step = np.uint64(width)
            ones = np.bitwise_count(bits & np.uint64((1 << width) - 1)).astype(np.uint64)
            beyond = rest >= ones
            rest = rest - np.where(beyond, ones, np.uint64(0))
            bits = np.where(beyond, bits >> step, bits)
            place = place + np.where(beyond, step, np.uint64(0))
        high = word.astype(np.uint64) * _WORD + place - index.astype(np.uint64)
        if not self.low_bits:
            return high
        at = index.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (at // _WORD).astype(np.int64), at % _WORD
        spill = np.where(shift > 0, self.low[word + 1] << ((_WORD - shift) % _WORD), np.uint64(0))
        low = ((self.low[word] >> shift) | spill) & np.uint64((1 << self.low_bits) - 1)
        return (high << np.uint64(self.low_bits)) | low

    def successor(self, first: np.ndarray, end: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The first place in [first, end) whose number is at least the target; `end` if none is."""
        low, high = first.astype(np.int64).copy(), end.astype(np.int64).copy()
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) // 2
            less = self[middle] < target[open_]
            low[open_] = np.where(less, middle + 1, low[open_])
            high[open_] = np.where(less, high[open_], middle)
            open_ = open_[low[open_] < high[open_]]
        return low


class NgramTrie:
    """Contexts and their successors, with a code for each successor and each context.

    Level one holds the contexts and a monotone pointer to each one's first successor;
    level two holds the successors of all contexts in one sequence. In it each list is
    raised by what the lists before it can reach, so that it never falls, and a word is
    searched relative to its context. The levels lie in one memory-mapped file, which goes
    when the trie does.
    """

    def __init__(self, contexts: np.ndarray, counts: np.ndarray, successors: np.ndarray, codes: np.ndarray, context_codes: np.ndarray):
        """`contexts` sorted; `counts`: successors of each; `successors` sorted within each context."""
        ends = np.cumsum(counts, dtype=np.int64)
        starts = ends - counts
        most = successors[ends - 1] if len(contexts) else np.zeros(0, dtype=np.int64)
        offsets = np.concatenate(([0], np.cumsum(most + 1)))
        lists = successors + np.repeat(offsets[:-1], counts)
        self.contexts = EliasFano(contexts, int(contexts[-1]) + 1 if len(contexts) else 1)
        self.pointers = EliasFano(np.concatenate((starts, ends[-1:] if len(ends) else [0])), len(successors) + 1)
        self.offsets = EliasFano(offsets, int(offsets[-1]) + 1)
        self.successors = EliasFano(lists, int(offsets[-1]) + 1)
        self.codes, self.context_codes = codes.astype(np.uint16), context_codes.astype(np.uint16)
        self._map()

    def _map(self) -> None:
        """Move all arrays to one file, and map it."""
        levels = [self.contexts, self.pointers, self.offsets, self.successors]
        named = [(x, k, a) for x in levels for k, a in x.arrays().items()]
        named += [(self, "codes", self.codes), (self, "context_codes", self.context_codes)]
        with tempfile.TemporaryFile() as file:
            places = []
            for _, _, array in named:
                file.write(b"\0" * (-file.tell() % 8))
                places.append(file.tell())
                file.write(array.tobytes())
            file.write(b"\0" * 8)
            file.flush()
            mapped = np.memmap(file, dtype=np.uint8, mode="r")
            for (owner, name, array), place in zip(named, places, strict=True):
                setattr(owner, name, mapped[place : place + array.nbytes].view(array.dtype))

    @property
    def n_bytes(self) -> int:
        levels = (self.contexts, self.pointers, self.offsets, self.successors)
        return sum(a.nbytes for x in levels for a in x.arrays().values()) + self.codes.nbytes + self.context_codes.nbytes

    def find(self, contexts: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the context or -1, place of the successor or -1) for each pair."""
        n = len(contexts)
        if not self.contexts.n:
            return np.full(n, -1), np.full(n, -1)
        distinct, which = np.unique(contexts, return_inverse=True)
        zero = np.zeros(len(distinct), dtype=np.int64)
        place = self.contexts.successor(zero, zero + self.contexts.n, distinct.astype(np.uint64))
        inside = np.minimum(place, self.contexts.n - 1)
        known = (place < self.contexts.n) & (self.contexts[inside] == distinct.astype(np.uint64))
        first, end = self.pointers[inside].astype(np.int64), self.pointers[inside + 1].astype(np.int64)
        raised, reach = self.offsets[inside], self.offsets[inside + 1] - self.offsets[inside]
        found = np.full(n, -1)
        # a word beyond the list's last would be looked for in the next list
        ask = np.flatnonzero(known[which] & (words.astype(np.uint64) < reach[which]))
        of = which[ask]
        target = raised[of] + words[ask].astype(np.uint64)
        at = self.successors.successor(first[of], end[of], target)
        hit = at < end[of]
        hit[hit] = self.successors[at[hit]] == target[hit]
        found[ask[hit]] = at[hit]
        return np.where(known, inside, -1)[which], found
