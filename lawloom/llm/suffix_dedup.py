"""Exact substring deduplication: strings dealt by anchors, suffixes sorted by a difference cover.

A byte goes if it lies in a string of `length` bytes that also starts in a document with
a smaller id. Strings are UTF-8 bytes, never cross documents, and may overlap.

1. Each string of `length` bytes has an anchor: the smallest hash of its GRAM-byte grams,
   which depends on the string alone. Anchors found in one document only, counted over
   all documents, rule their strings out; so do anchors without a smaller or a larger id.
2. What is left of the texts is cut into stretches of neighbouring strings with one
   anchor, and each part of the anchors gets the stretches of its own: equal strings
   meet there. Equal stretches of a batch of documents travel once. Strings of an anchor
   that is found more than HOT_ANCHOR times go one by one to the part of the hash of all
   their bytes: around a common passage each document has strings of its own with an
   anchor of the passage, which would otherwise all come to one part. Texts are dealt by
   DEALT_BYTES to parts of PART_BYTES, so that a row holds many anchors or stretches:
   there is a row for each pair of the two.
3. A stretch that is the only one of its anchor equals no other string. A part sorts the
   suffixes of the others, SORTED_STRINGS at a time with whole anchors, by the difference cover {1, 2} modulo 3:
   triples of characters at the sampled places are sorted and named, the names are read as
   a string and sorted again where they repeat, until they stand for nearly `length` bytes,
   the remaining suffixes are merged in, and adjacent prefixes of `length` bytes are
   compared. Equal ones get the smallest id. The order is that of a part, not of the
   corpus: strings that are found once are never sorted.
4. Starts with a smaller id elsewhere become spans, and the texts are rewritten.

Both exchanges pre-aggregate in the batch, so a string of a third of all documents comes
to its part once for every batch.

Defined results: a null text is empty; rows with the same id never remove each other's
bytes; a null id counts as larger than all others; an empty table gives an empty result;
extra columns are carried. A removed span may cut a character; `kept` is bytes.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lawloom.llm.common import forget, map_texts, staged, text_or_empty
from lawloom.llm.hashing import mix64, text_chunks
from lawloom.llm.packing import join_packed, pack, runs, to_batch, unpack

GRAM = 24
#: Anchors are compared by this many bits; a collision costs a comparison, no result.
ANCHOR_BITS = 48
#: Text whose anchors and stretches come to one part, and text that a task deals together, about.
PART_BYTES, DEALT_BYTES = 1 << 24, 1 << 24
#: Strings that are sorted together, about, and stretches of a text that are dealt together, in bytes.
SORTED_STRINGS, _HELD_BYTES = 1 << 20, 1 << 25
#: An anchor found more often is dealt by whole strings; the parts of rarer ones stay bounded.
HOT_ANCHOR = 1 << 14
#: Bytes whose anchors are found together: a place in them fits beside a hash, and their
#: arrays of 8 bytes a place are small enough for the allocator to use the same memory again.
CHUNK_BYTES = 15_000
_NULL_ID = (1 << 63) - 1
_FACTORS = np.random.default_rng(978).integers(1, 1 << 62, 4, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Spans, and two for each of their documents, known to fit a broadcast (about 32 bytes each).
MAX_BROADCAST_SPANS = 1_000_000


# ---- anchors ----


def _eights(data: np.ndarray, kind: str = "<u8") -> np.ndarray:
    """A view of the numbers of 8 bytes from each place of contiguous bytes."""
    return np.ndarray((max(0, len(data) - 7),), dtype=kind, buffer=data, strides=(1,))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each place, eight by eight."""
    n = max(0, len(data) - GRAM + 1)
    eight = _eights(np.ascontiguousarray(data)).astype(np.uint64)
    h = eight[:n] * _FACTORS[0]
    for k, factor in zip(range(8, GRAM, 8), _FACTORS[1:], strict=False):
        h ^= h >> np.uint64(32)
        h += eight[k : k + n]
        h *= factor
    h ^= h >> np.uint64(29)
    h *= _FACTORS[3]
    h >>= np.uint64(64 - ANCHOR_BITS)
    return h


def _anchor_names(grams: np.ndarray) -> np.ndarray:
    """Anchors as evenly spread numbers of ANCHOR_BITS; smallest hashes are not even."""
    return mix64(grams) >> np.uint64(64 - ANCHOR_BITS)


def anchor_of_strings(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of grams, place of the anchor of the string from each place): the leftmost smallest."""
    block = max(CHUNK_BYTES, 2 * length)
    step = block - length + 1
    if len(data) > block:  # blocks that overlap
        firsts = range(0, len(data) - length + 1, step)
        blocks = [anchor_of_strings(data[a : a + block], length) for a in firsts]
        grams = np.concatenate([*(g[:step] for g, _ in blocks[:-1]), blocks[-1][0]])
        return grams, np.concatenate([anchor + a for a, (_, anchor) in zip(firsts, blocks, strict=True)])
    grams = gram_hashes(data)
    window = length - GRAM + 1
    # the hash above the place: the minimum of these is the leftmost smallest hash
    keyed = grams << np.uint64(64 - ANCHOR_BITS) | (np.arange(len(grams), dtype=np.uint64) & np.uint64((1 << (64 - ANCHOR_BITS)) - 1))
    span, width = keyed, 1
    while width * 2 <= window:
        span = np.minimum(span[: len(span) - width], span[width:])
        width *= 2
    n = max(0, len(data) - length + 1)
    least = np.minimum(span[:n], span[window - width : window - width + n])
    return grams, (least & np.uint64((1 << (64 - ANCHOR_BITS)) - 1)).astype(np.int64)


def _own_ids(column: pa.Array) -> np.ndarray:
    return np.array([_NULL_ID if i is None else i for i in column.to_pylist()], dtype=np.int64)


def _ordered(ids: np.ndarray) -> np.ndarray:
    """Ids as unsigned numbers in the same order, for packing."""
    return ids.view(np.uint64) ^ np.uint64(1 << 63)


def _strings(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of grams, anchor of the string from each place, places whose string lies in one text) of texts in a row."""
    grams, anchor = anchor_of_strings(data, length)
    inside = np.ones(len(anchor), dtype=bool)
    for end in offsets[1:-1]:
        inside[max(0, end - length + 1) : end] = False
    return grams, anchor, np.flatnonzero(inside)


def _batch_name(made: int) -> str:
    from pyspark import TaskContext

    return f"{TaskContext.get().partitionId()}-{made}"


_ANCHORS = "batch string, part long, hashes binary, lows binary, highs binary, counts binary, keys binary, ids binary, places binary"


def deal_anchors(docs: DataFrame, length: int, parts: int) -> DataFrame:
    """Per batch and part: distinct anchors with lowest and highest id, and where they are."""

    def dealt(name: str, found: list[tuple]) -> pa.RecordBatch:
        hashes, ids, places = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(hashes)
        hashes, ids, places = hashes[order], _ordered(ids[order]), places[order].astype(np.uint32)
        starts, ends = runs(hashes)
        lows = np.minimum.reduceat(ids, starts)
        # the highest id as its distance from the lowest, which is mostly 0
        further = np.maximum.reduceat(ids, starts) - lows
        times, distinct = (ends - starts).astype(np.uint32), hashes[starts]
        rows = []
        part = distinct * np.uint64(parts) >> np.uint64(ANCHOR_BITS)
        for a, b in zip(*runs(part), strict=True):
            key = np.repeat(np.arange(b - a, dtype=np.uint32), times[a:b])
            own = slice(starts[a], ends[b - 1])
            blobs = (distinct[a:b], lows[a:b], further[a:b], times[a:b], key, ids[own], places[own])
            rows.append((name, int(part[a]), *(pack(x) for x in blobs)))
        return to_batch(rows, ["batch", "part", "hashes", "lows", "highs", "counts", "keys", "ids", "places"])

    def deal(batches):
        found, size, made = [], 0, 0
        for batch in batches:
            own = _own_ids(batch.column(0))
            for row, end, data, offsets in text_chunks(batch.column(1), CHUNK_BYTES):
                if len(data) >= length:
                    grams, anchor, starts = _strings(data, offsets, length)
                    at = anchor[starts]
                    at = at[np.append(True, at[1:] != at[:-1])[: len(at)]]  # anchors never go back
                    text = np.searchsorted(offsets, at, "right") - 1
                    found.append((_anchor_names(grams[at]), own[row:end][text], at - offsets[text]))
                    size += len(data)
                if size > DEALT_BYTES:
                    yield dealt(_batch_name(made), found)
                    found, size, made = [], 0, made + 1
        if any(len(names) for names, _, _ in found):
            yield dealt(_batch_name(made), found)

    return map_texts(docs, deal, _ANCHORS)


def _extremes(group: pa.Table) -> pa.Table:
    """Lowest and highest id of every hash of a part, in the order of each batch's hashes, and the hot ones.

    0 and 0 for a hash of one document; a highest id is never 0.
    """
    hashes, lows, highs, counts = (join_packed(group[c]) for c in ("hashes", "lows", "highs", "counts"))
    highs = lows + highs
    order = np.argsort(hashes)
    starts, ends = runs(hashes[order])
    which = np.empty(len(order), dtype=np.int64)
    which[order] = np.repeat(np.arange(len(starts)), ends - starts)
    low = np.minimum.reduceat(lows[order], starts)[which]
    high = np.maximum.reduceat(highs[order], starts)[which]
    low, high = np.where(low < high, low, np.uint64(0)), np.where(low < high, high, np.uint64(0))
    times = np.add.reduceat(counts[order].astype(np.int64), starts)[which]
    hot = np.where(times > HOT_ANCHOR, hashes, np.uint64(0))
    cut = np.cumsum([len(unpack(b.as_py())) for b in group["hashes"]])[:-1]
    return pa.table(
        {
            "batch": group["batch"],
            "part": group["part"],
            "low": pa.array([pack(x) for x in np.split(low, cut)], pa.binary()),
            "high": pa.array([pack(x) for x in np.split(high, cut)], pa.binary()),
            "hot": pa.array([pack(x) for x in np.split(hot, cut)], pa.binary()),
        }
    )


def _shared_anchors(batches):
    """(id, place, hot) of the anchors that documents with a smaller or a larger id have, too.

    hot: the hash, if the anchor is dealt by whole strings. A place would not do, since rows
    with one id can have several texts.
    """
    for batch in batches:
        for keys, ids, places, high, hot in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            key, own, place = unpack(keys), unpack(ids), unpack(places)
            kept = unpack(high)[key] > 0  # then another document has it
            back = (own[kept] ^ np.uint64(1 << 63)).view(np.int64)
            hashes = unpack(hot)[key][kept].astype(np.int64)  # of ANCHOR_BITS
            yield pa.RecordBatch.from_arrays(
                [pa.array(back), pa.array(place[kept].astype(np.int32)), pa.array(hashes, mask=hashes == 0)],
                ["anchor_id", "place", "hot"],
            )


# ---- stretches ----

_STRETCHES = "batch string, part long, anchors binary, texts binary, lengths binary, lows binary, keys binary, ids binary, tags binary, starts binary"


def _stretch_hashes(text: np.ndarray, first: np.ndarray, end: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name the bytes of each stretch of strings of `length` bytes with one anchor."""
    lengths = end - first
    one = lengths.astype(np.uint64) * _FACTORS[0]
    two = ~one
    eight = _eights(text)
    for k in range(0, 2 * length - GRAM, 8):  # at most so many bytes; shorter ones read their last eight again
        word = eight[first + np.minimum(k, lengths - 8)]
        one ^= word
        one *= _FACTORS[1]
        one ^= one >> np.uint64(32)
        two += word
        two *= _FACTORS[2]
        two ^= two >> np.uint64(29)
    return mix64(one), mix64(two)


def _pieces(text: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of the stretches, one after the other."""
    before = np.cumsum(lengths) - lengths
    return text[np.repeat(first - before, lengths) + np.arange(lengths.sum())]


def _dealt(name: str, chunks: list[tuple], parts: int) -> pa.RecordBatch:
    """Rows (batch, part, ...) of the stretches of some texts; equal stretches travel once."""
    text, lengths, one, two, own, tag, anchor, place = (np.concatenate(x) for x in zip(*chunks, strict=True))
    own, first = _ordered(own), np.cumsum(lengths) - lengths
    # by anchor, then by hash; of two texts with these bits, copies may travel more than once
    order = np.argsort(anchor >> np.uint64(24) << np.uint64(24) | one >> np.uint64(40))
    first, lengths, one, two, own, tag, anchor, place = (x[order] for x in (first, lengths, one, two, own, tag, anchor, place))
    anchor >>= np.uint64(32)
    part = anchor * np.uint64(parts) >> np.uint64(32)
    new = np.ones(len(order), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    distinct = np.cumsum(new) - 1
    rows = []
    for a, b in zip(*runs(part), strict=True):
        lead = np.flatnonzero(new[a:b]) + a
        blobs = (
            anchor[lead].astype(np.uint32), _pieces(text, first[lead], lengths[lead]), lengths[lead].astype(np.uint32),
            np.minimum.reduceat(own[a:b], lead - a), (distinct[a:b] - distinct[a]).astype(np.uint32), own[a:b], tag[a:b], place[a:b],
        )
        rows.append((name, int(part[a]), *(pack(x) for x in blobs)))
    return to_batch(rows, ["batch", "part", "anchors", "texts", "lengths", "lows", "keys", "ids", "tags", "starts"])


def deal_stretches(docs: DataFrame, length: int, parts: int) -> DataFrame:
    """Per batch and part: distinct stretches with their lowest id, and where they are.

    docs: (id, text, anchors, hot), anchors being the places of those that other documents
    have, hot the names of those that are dealt by whole strings.
    """

    def deal(batches):
        chunks, size, held, made = [], 0, 0, 0
        for batch in batches:
            own = _own_ids(batch.column(0))
            marked, hot = batch.column(2), np.unique(batch.column(3).flatten().to_numpy(zero_copy_only=False)).astype(np.uint64)
            marks = pc.list_value_length(marked).to_numpy(zero_copy_only=False)
            until, marked = np.concatenate(([0], np.cumsum(marks))), marked.flatten().to_numpy(zero_copy_only=False)
            for row, end, data, offsets in text_chunks(batch.column(1), CHUNK_BYTES):
                if len(data) < length:
                    continue
                grams, anchor, starts = _strings(data, offsets, length)
                # other texts of the same id have places, too
                at = np.repeat(offsets[:-1], marks[row:end]) + marked[until[row] : until[end]]
                at = at[at + GRAM <= np.repeat(offsets[1:], marks[row:end])]
                repeated = np.zeros(len(grams), dtype=bool)
                repeated[at] = True
                place = anchor[starts]
                mine = repeated[place]
                starts, place = starts[mine], place[mine]
                if not len(starts):
                    continue
                new = np.ones(len(starts), dtype=bool)  # texts end with places that start no string
                new[1:] = (starts[1:] > starts[:-1] + 1) | (place[1:] != place[:-1])
                if len(hot):  # a hot anchor is hot in every text that shares it
                    alone = np.isin(_anchor_names(grams[place]), hot)
                    new |= alone
                    new[1:] |= alone[:-1]
                first = starts[new]
                last = starts[np.append(new[1:], True)]
                one, two = _stretch_hashes(data, first, last + length, length)
                key = mix64(_anchor_names(grams[place[new]]))
                if len(hot):
                    key = np.where(alone[new], one, key)
                text = np.searchsorted(offsets, first, "right") - 1
                tags = np.zeros(end - row, dtype=np.uint32)
                for i in np.unique(text):
                    tags[i] = zlib.crc32(data[offsets[i] : offsets[i + 1]])
                lengths = last + length - first
                pieces = _pieces(data, first, lengths)
                chunks.append((pieces, lengths, one, two, own[row:end][text], tags[text], key, (first - offsets[text]).astype(np.uint32)))
                size, held = size + len(data), held + len(pieces)
                if size > DEALT_BYTES or held > _HELD_BYTES:
                    yield _dealt(_batch_name(made), chunks, parts)
                    chunks, size, held, made = [], 0, 0, made + 1
        if chunks:
            yield _dealt(_batch_name(made), chunks, parts)

    return map_texts(docs, deal, _STRETCHES)


# ---- the strings of a part ----


def _names(key: np.ndarray) -> np.ndarray:
    """For each key, how many are smaller: equal keys have one name."""
    order = np.argsort(key)
    first, ends = runs(key[order])
    names = np.empty(len(order), dtype=np.uint64)
    names[order] = np.repeat(first, ends - first).astype(np.uint64)
    return names


def _refined(names: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Names of the pairs (name, following): only names that repeat are sorted again.

    Names and `following` are below 2^32: a part of the corpus has fewer places than that.
    """
    again = np.flatnonzero(np.bincount(names.astype(np.int64))[names.astype(np.int64)] > 1)
    out = names.copy()
    if len(again):
        key = names[again] << np.uint64(32) | following[again]
        order = np.argsort(key)
        key = key[order]
        name = key >> np.uint64(32)
        at = np.arange(len(key))
        new, other = np.ones(len(key), dtype=bool), np.ones(len(key), dtype=bool)
        new[1:], other[1:] = key[1:] != key[:-1], name[1:] != name[:-1]
        behind = np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(other, at, 0))
        out[again[order]] = name + behind.astype(np.uint64)
    return out


def _merged_order(kind: np.ndarray, own: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The order of all suffixes: the sampled ones sorted by name, the remaining ones merged in.

    kind: place modulo 3. A remaining suffix (0) is compared with a sampled one by the bytes
    before the next places that are sampled in both: `one` on for kind 1, `two` on for kind 2.
    """
    sampled, rest = np.flatnonzero(kind), np.flatnonzero(kind == 0)
    sampled, rest = sampled[np.argsort(own[sampled])], rest[np.argsort(one[rest])]
    firsts, seconds = sampled[kind[sampled] == 1], sampled[kind[sampled] == 2]
    before = np.searchsorted(one[firsts], one[rest]) + np.searchsorted(two[seconds], two[rest])
    place = np.zeros(len(kind), dtype=bool)
    place[before + np.arange(len(rest))] = True
    order = np.empty(len(kind), dtype=np.int64)
    order[place], order[~place] = rest, sampled
    return order


def suffix_order(text: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(order of the suffixes from `starts` by their first `length` bytes, whether each differs there from the one before).

    Difference cover {1, 2} modulo 3, with characters of 4 bytes: triples at the sampled
    places are sorted and named; the names, read as a string, are sorted and named again
    where they repeat, each time for twice the bytes; the remaining suffixes are merged in;
    neighbours are compared.
    """
    padded = np.concatenate((text, np.zeros(2 * length + 64, dtype=np.uint8)))
    two_characters = _eights(padded, ">u8")
    reaches = [12]  # bytes that a name stands for, multiples of 3
    while reaches[-1] * 2 <= length - 2:
        reaches.append(reaches[-1] * 2)
    reach = reaches[-1]
    # what the last names leave of the prefix: names again at a sampled place, and up to 2 bytes
    left = [length - shift - reach for shift in (0, 1, 2)]
    steps = [sorted({0, *(n - n % 3 for n in left)})]
    for shorter in reversed(reaches[:-1]):
        steps.insert(0, sorted({*steps[0], *(step + shorter for step in steps[0])}))
    near = np.zeros(len(padded), dtype=bool)
    for shift in (0, 1, 2):
        near[starts + shift] = True

    def sampled(steps: list[int]) -> np.ndarray:
        wanted = near.copy()
        for step in steps[1:]:
            wanted[step:] |= near[: len(near) - step]
        wanted[::3] = False
        return np.flatnonzero(wanted)

    names = np.zeros(len(padded), dtype=np.uint64)
    at = sampled(steps[0])
    names[at] = _refined(_names(two_characters[at].astype(np.uint64)), two_characters[at + 8].astype(np.uint64) >> np.uint64(32))
    for shorter, needed in zip(reaches[:-1], steps[1:], strict=True):
        at = sampled(needed)
        names[at] = _refined(names[at], names[at + shorter])

    def prefix(kinds: tuple[int, ...], shift: int) -> np.ndarray:
        """Numbers in the order of the prefixes, for starts whose place `shift` on is sampled."""
        key = np.zeros(len(starts), dtype=np.uint64)
        mine = np.flatnonzero((kind == kinds[0]) | (kind == kinds[1]))
        at = starts[mine] + shift
        step, tail = left[shift] - left[shift] % 3, left[shift] % 3
        number = _refined(names[at], names[at + step]) if step else names[at]
        for k in range(shift):
            number = number | padded[at - 1 - k].astype(np.uint64) << np.uint64(32 + 8 * k)
        for k in range(tail):
            number = number << np.uint64(8) | padded[at + step + reach + k].astype(np.uint64)
        key[mine] = number
        return key

    kind = starts % 3
    own, one, two = prefix((1, 2), 0), prefix((0, 1), 1), prefix((0, 2), 2)
    order = _merged_order(kind, own, one, two)
    left_kind, right_kind = kind[order][:-1], kind[order][1:]
    both = (left_kind != 0) & (right_kind != 0)
    second = (left_kind == 2) | (right_kind == 2)
    new = np.ones(len(order), dtype=bool)
    a, b = order[:-1], order[1:]
    new[1:] = np.where(both, own[a] != own[b], np.where(second, two[a] != two[b], one[a] != one[b]))
    return order, new


def lowest_ids(text: np.ndarray, starts: np.ndarray, ids: np.ndarray, length: int) -> np.ndarray:
    """For each start, the smallest id among the starts with the same `length` bytes."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    order, new = suffix_order(text, starts, length)
    heads = np.flatnonzero(new)
    best = np.empty(len(starts), dtype=ids.dtype)
    best[order] = np.repeat(np.minimum.reduceat(ids[order], heads), np.diff(np.append(heads, len(order))))
    return best


def _counted(counts: np.ndarray) -> np.ndarray:
    """0 ... counts[0] - 1, 0 ... counts[1] - 1, ..."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _string_starts(lengths: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the starts of all strings of stretches that lie one after the other, the first string of each stretch)"""
    begin = np.cumsum(lengths) - lengths
    return np.repeat(begin, counts) + _counted(counts), np.cumsum(counts) - counts


def _sort_part(length: int):
    def sort(group: pa.Table) -> pa.Table:
        anchors, text, lengths, lows = (join_packed(group[c]) for c in ("anchors", "texts", "lengths", "lows"))
        lengths = lengths.astype(np.int64)
        counts = lengths - length + 1  # strings of each stretch
        begin = np.cumsum(lengths) - lengths
        # stretches that several batches have are sorted once, with their lowest id
        one, two = _stretch_hashes(text, begin, begin + lengths, length)
        order = np.argsort(anchors.astype(np.uint64) << np.uint64(32) | one >> np.uint64(32))
        anchors, one, two = anchors[order], one[order], two[order]
        new = np.ones(len(order), dtype=bool)  # two texts with these bits cost a comparison, no result
        new[1:] = (anchors[1:] != anchors[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        heads = np.flatnonzero(new)
        lead, lowest = order[heads], np.minimum.reduceat(lows[order], heads)
        which = np.empty(len(order), dtype=np.int64)
        which[order] = np.cumsum(new) - 1
        times = counts[lead]
        place = np.cumsum(times) - times
        found = np.repeat(lowest, times)
        # equal strings have one anchor: only anchors of several stretches need an order
        first, end = runs(anchors[heads])
        several = end - first > 1
        first, end = first[several], end[several]
        strings = np.cumsum([times[a:b].sum() for a, b in zip(first, end, strict=True)]) if len(first) else np.zeros(0)
        for a, b in zip(*runs((strings - 1) // SORTED_STRINGS), strict=True):
            mine = np.repeat(first[a:b], end[a:b] - first[a:b]) + _counted(end[a:b] - first[a:b])
            starts, _ = _string_starts(lengths[lead[mine]], times[mine])
            pieces = _pieces(text, begin[lead[mine]], lengths[lead[mine]])
            at = np.repeat(place[mine], times[mine]) + _counted(times[mine])
            found[at] = lowest_ids(pieces, starts, found[at], length)
        best = found[np.repeat(place[which], counts) + _counted(counts)]
        of_row = np.add.reduceat(counts, np.cumsum([0] + [len(unpack(b.as_py())) for b in group["lengths"]][:-1]))
        cut = np.cumsum(of_row)[:-1]
        answers = [pack(x) for x in np.split(best, cut)]
        return pa.table({"batch": group["batch"], "part": group["part"], "best": pa.array(answers, pa.binary())})

    return sort


#: A span as one number: its first byte, and its end in the lower bits.
_END_BITS = 32


def _removed_starts(length: int):
    def expand(batches):
        for batch in batches:
            for lengths, keys, ids, tags, starts, best in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                counts = unpack(lengths).astype(np.int64) - length + 1
                keys, ids, tags, best = unpack(keys), unpack(ids), unpack(tags), unpack(best)
                times = counts[keys]
                until = np.cumsum(times)
                at = _counted(times)
                gone = best[np.repeat((np.cumsum(counts) - counts)[keys], times) + at] < np.repeat(ids, times)
                # runs of removed strings of a stretch
                begins = gone & (at == 0)
                begins[1:] |= gone[1:] & ~gone[:-1]
                ends = gone.copy()
                ends[:-1] &= ~gone[1:] | (at[1:] == 0)
                begins, ends = np.flatnonzero(begins), np.flatnonzero(ends)
                of = np.searchsorted(until, begins, "right")
                first = unpack(starts).astype(np.int64)[of] + at[begins]
                back = (ids[of] ^ np.uint64(1 << 63)).view(np.int64)
                span = first << _END_BITS | first + (ends - begins) + length
                columns = [pa.array(back), pa.array(tags[of].astype(np.int64)), pa.array(span)]
                yield pa.RecordBatch.from_arrays(columns, ["span_id", "tag", "span"])

    return expand


def repeated_spans(docs: DataFrame, length: int = 50) -> DataFrame:
    """(span_id, tag, spans) of (id, text) rows: spans (first, end), in order, of ids with removed bytes.

    tag: crc32 of the text, since rows with one id can have several texts.
    """
    plain = docs.select("id", "text")
    size = plain.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    parts = int(size // PART_BYTES) + 1
    dealt = staged(deal_anchors(plain, length, parts), "anchors")
    extremes = dealt.select("batch", "part", "hashes", "lows", "highs", "counts").groupBy("part").applyInArrow(
        _extremes, "batch string, part long, low binary, high binary, hot binary"
    )
    flags = (
        dealt.select("batch", "part", "keys", "ids", "places").join(extremes, ["batch", "part"])
        .select("keys", "ids", "places", "high", "hot")
        .mapInArrow(_shared_anchors, "anchor_id long, place int, hot long")
    )
    shared = staged(flags, "shared-anchors", free_shuffles=True)
    forget(dealt)
    flags = (
        shared.groupBy("anchor_id").agg(F.collect_list("place").alias("anchors"), F.collect_set("hot").alias("hot"))
    )
    marked = plain.join(flags, F.col("id") == F.col("anchor_id")).select("id", "text", "anchors", "hot")
    stretches = staged(deal_stretches(marked, length, parts), "stretches", free_shuffles=True)
    forget(shared)
    best = stretches.select("batch", "part", "anchors", "texts", "lengths", "lows").groupBy("part").applyInArrow(
        _sort_part(length), "batch string, part long, best binary"
    )
    pieces = (
        stretches.select("batch", "part", "lengths", "keys", "ids", "tags", "starts").join(best, ["batch", "part"])
        .select("lengths", "keys", "ids", "tags", "starts", "best")
        .mapInArrow(_removed_starts(length), "span_id long, tag long, span long")
    )
    collected = pieces.groupBy("span_id", "tag").agg(F.sort_array(F.collect_list("span")).alias("spans"))

    def merge(batches):
        for batch in batches:
            counts, spans = merged(pc.list_value_length(batch.column(2)).to_numpy(), batch.column(2).flatten().to_numpy())
            values = pa.StructArray.from_arrays(
                [pa.array(spans >> _END_BITS), pa.array(spans & ((1 << _END_BITS) - 1))], ["first", "end"]
            )
            offsets = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
            columns = [batch.column(0), batch.column(1), pa.ListArray.from_arrays(offsets, values)]
            yield pa.RecordBatch.from_arrays(columns, ["span_id", "tag", "spans"])

    schema = "span_id long, tag long, spans array<struct<first: bigint, end: bigint>>"
    spans = staged(map_texts(collected, merge, schema), "spans", free_shuffles=True)
    forget(stretches)
    return spans


def merged(counts: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(spans of each row, spans) of rows of spans in order of their beginning, those that touch made one."""
    row = np.repeat(np.arange(len(counts)), counts) << _END_BITS
    first, end = row | spans >> _END_BITS, row | spans & ((1 << _END_BITS) - 1)
    reach = np.maximum.accumulate(end)
    begins = np.flatnonzero(np.append(True, first[1:] > reach[:-1])[: len(spans)])
    ends = reach[np.append(begins[1:], len(spans)) - 1] if len(begins) else reach
    found = spans[begins] >> _END_BITS << _END_BITS | ends & ((1 << _END_BITS) - 1)
    return np.bincount(row[begins] >> _END_BITS, minlength=len(counts)), found


def remove_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """The documents with `kept` (bytes), `n_bytes`, `n_removed` and `n_spans`; these names are replaced."""
    if length < 2 * GRAM:
        raise ValueError(f"strings of at least {2 * GRAM} bytes, not {length}")
    docs = docs.drop("kept", "n_bytes", "n_removed", "n_spans")
    id_ = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID))
    spans = repeated_spans(docs.select(id_.alias("id"), text_or_empty("text").alias("text")), length)

    def cut(batches):
        for batch in batches:
            spans = batch.column(batch.num_columns - 1)
            many = pc.fill_null(pc.list_value_length(spans), 0).to_numpy()
            spans = spans.flatten()
            first, end = (spans.field(i).to_numpy() for i in (0, 1))
            removed = np.bincount(np.repeat(np.arange(len(many)), many), end - first, len(many)).astype(np.int64)
            until, sizes, pieces = np.concatenate(([0], np.cumsum(many))), [], []
            for row, stop, data, offsets in text_chunks(batch.column(batch.schema.get_field_index("text"))):
                mine = slice(until[row], until[stop])
                begin = np.repeat(offsets[:-1], many[row:stop])
                edge = np.zeros(len(data) + 1, dtype=np.int8)
                edge[begin + first[mine]] = 1
                np.subtract.at(edge, begin + end[mine], 1)  # a span can end where the next text's begins
                pieces.append(data[np.cumsum(edge[:-1], dtype=np.int8) == 0])
                sizes.append(np.diff(offsets))
            sizes = np.concatenate([*sizes, np.zeros(0, dtype=np.int64)])
            kept = np.concatenate([*pieces, np.zeros(0, dtype=np.uint8)])
            offsets = np.concatenate(([0], np.cumsum(sizes - removed))).astype(np.int32)
            kept = pa.BinaryArray.from_buffers(pa.binary(), len(many), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
            columns = [kept, *(pa.array(x.astype(np.int64)) for x in (sizes, removed, many))]
            names = [*batch.schema.names[:-1], "kept", "n_bytes", "n_removed", "n_spans"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names)

    spans = spans.withColumnsRenamed({"span_id": "_cut_id", "tag": "_cut_tag", "spans": "_cut_spans"})
    same = (id_ == F.col("_cut_id")) & (F.crc32(text_or_empty("text")) == F.col("_cut_tag"))
    held = spans.agg(F.coalesce(F.sum(F.size("_cut_spans") + 2), F.lit(0))).first()[0]
    joined = docs.join(F.broadcast(spans) if held <= MAX_BROADCAST_SPANS else spans, same, "left").select(
        *[F.col(f"`{c}`") for c in docs.columns], "_cut_spans"
    )
    schema = T.StructType(list(docs.schema.fields))
    for name, kind in (("kept", "binary"), ("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long")):
        schema = schema.add(name, kind)
    return map_texts(joined, cut, schema)
