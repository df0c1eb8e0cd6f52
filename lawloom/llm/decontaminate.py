"""Benchmark decontamination by SimHash of item-sized windows.

For every size that a benchmark item has (in words), all windows of that size in every
document are considered. A window and an item are similar by the weighted Jaccard
similarity of their shingle multisets; an item's shingle weighs ln(1 + items / items
that have it), a shingle that the item lacks weighs the most, ln(1 + items).

1. A bitmap of fixed size marks the shingles of items, of each size apart. A window of
   which less than the similarity's share is marked cannot be similar; it goes no further.
2. The others get a 128-bit SimHash. Fingerprints are cut into `radius` + 1 blocks; two
   fingerprints within the radius agree in a block, so a join on (size, block, bits)
   finds every item within it, and the distance is then counted.
3. Candidates are verified by the exact similarity of window and item.

The radius of 32 of 128 bits is three deviations above the distance expected at 0.8.

Words are runs of letters and digits, lower-cased. Defined results: null or wordless
texts and items match nothing; an item shorter than a shingle is one shingle; a document
shorter than an item is one window for it; rows with the same id are one document, items
with the same id one item with several texts; a null id can be found as such; empty
tables give an empty result; only the ids and texts are read.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawloom.llm.common import broadcast_if_small, map_texts, staged, text_or_empty
from lawloom.llm.hashing import hash_windows, hash_words, mix64, text_chunks

#: Bits of the bitmap that is sent to all tasks (2 MB).
MARK_BITS = 1 << 24
FINGERPRINT_BITS = 128
#: Found ids known to fit a broadcast.
MAX_BROADCAST_IDS = 200_000


def plain_words(text: Column) -> Column:
    """Lower-case letters and digits, everything else a space."""
    return F.regexp_replace(F.lower(text_or_empty(text)), r"[^\p{L}\p{N}]+", " ")


def _marks(shingles: np.ndarray, size: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Two positions in the bitmap; a size gives other positions than no size."""
    salt = 0 if size is None else (2 * size + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
    keyed = mix64(shingles + np.uint64(salt))
    mask = np.uint64(MARK_BITS - 1)
    return (keyed & mask).astype(np.int64), ((keyed >> np.uint64(32)) & mask).astype(np.int64)


def _fingerprints(shingles: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Two words of SimHash for each stretch of `length` shingles: which bits most have set."""
    low = int(starts.min())
    used = shingles[low : int(starts.max()) + length]
    halves = [mix64(used ^ np.uint64(0xA5)), mix64(used ^ np.uint64(0x5A5A))]
    raw = np.stack(halves, axis=1).view(np.uint8).reshape(len(used), 16)
    votes = np.unpackbits(raw, axis=1).astype(np.int32) * 2 - 1
    sums = np.concatenate((np.zeros((1, FINGERPRINT_BITS), dtype=np.int32), np.cumsum(votes, axis=0)))
    at = starts - low
    return np.packbits(sums[at + length] - sums[at] >= 0, axis=1).view(np.int64)


def _shingles(word_hashes: np.ndarray, size: int, words_per_shingle: int) -> np.ndarray:
    """Shingles for windows of `size` words: a small window is one shingle."""
    width = min(size, words_per_shingle)
    return hash_windows(word_hashes, width) ^ np.uint64(width)


def item_profiles(items: DataFrame, words_per_shingle: int) -> DataFrame:
    """(item_id, size, fp1, fp2, shingles) of the items that have words."""

    def profile(batches):
        for batch in batches:
            rows: list[tuple] = []
            ids = batch.column(0).to_pylist()
            for first, end, data, offsets in text_chunks(batch.column(1)):
                words = hash_words(data, offsets)
                for i in range(end - first):
                    own = words.hashes[words.bounds[i] : words.bounds[i + 1]]
                    if len(own):
                        shingles = _shingles(own, len(own), words_per_shingle)
                        prints = _fingerprints(shingles, np.zeros(1, dtype=np.int64), len(shingles))[0]
                        rows.append((ids[first + i], len(own), int(prints[0]), int(prints[1]), shingles.view(np.int64).tolist()))
            names = ["item_id", "size", "fp1", "fp2", "shingles"]
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays(columns, names)

    plain = items.select(F.col("item_id").cast("long").alias("item_id"), plain_words(F.col("text")).alias("text"))
    return map_texts(plain, profile, "item_id long, size int, fp1 long, fp2 long, shingles array<long>")


def _bitmap(profiles: DataFrame) -> np.ndarray:
    """The marks of all items: at most MARK_BITS / 64 words reach the driver."""

    def mark(batches):
        for batch in batches:
            found = []
            for size, shingles in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                values = np.array(shingles, dtype=np.int64).view(np.uint64)
                found += [*_marks(values, None), *_marks(values, size)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found) if found else [], pa.int64())], ["position"])

    positions = profiles.select("size", "shingles").mapInArrow(mark, "position long")
    word = F.shiftright("position", 6).alias("word")
    words = positions.groupBy(word).agg(F.bit_or(F.expr("shiftleft(1L, cast(position & 63 as int))")).alias("bits"))
    bits = np.zeros(MARK_BITS // 64, dtype=np.int64)
    for row in words.collect():
        bits[row["word"]] = row["bits"]
    return bits


def marked_windows(
    docs: DataFrame, bits: np.ndarray, sizes: list[int], words_per_shingle: int, percent: int
) -> DataFrame:
    """(doc_id, start, size, fp1, fp2, shingles) of the windows with enough marked shingles."""

    def is_marked(shingles: np.ndarray, size: int | None) -> np.ndarray:
        one, two = _marks(shingles, size)
        hit = lambda p: (bits[p >> 6] >> (p & 63)) & 1
        return (hit(one) & hit(two)).astype(bool)

    def windows_of(words: np.ndarray):
        for size in sizes:
            shingles = _shingles(words, min(size, max(len(words), 1)), words_per_shingle)
            length = min(max(1, size - words_per_shingle + 1), len(shingles))
            if not length:
                continue
            marked = np.concatenate(([0], np.cumsum(is_marked(shingles, size))))
            counts = marked[length:] - marked[:-length]
            starts = np.flatnonzero(100 * counts >= percent * length)
            if len(starts):
                prints = _fingerprints(shingles, starts, length)
                for start, fp in zip(starts, prints, strict=True):
                    yield int(start), size, int(fp[0]), int(fp[1]), shingles[start : start + length].view(np.int64)

    def scan(batches):
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
        names = ["doc_id", "start", "size", "fp1", "fp2", "shingles"]
        widths = sorted({min(s, words_per_shingle) for s in sizes})
        for batch in batches:
            ids = batch.column(0)
            for first, end, data, offsets in text_chunks(batch.column(1)):
                words = hash_words(data, offsets)
                # texts with any marked shingle; windows over two texts only cost a second look
                hit = np.zeros(end - first, dtype=bool)
                for width in widths:
                    marks = np.flatnonzero(is_marked(hash_windows(words.hashes, width) ^ np.uint64(width), None))
                    hit[np.searchsorted(words.bounds, marks, "right") - 1] = True
                rows = []
                for i in np.flatnonzero(hit):
                    own = words.hashes[words.bounds[i] : words.bounds[i + 1]]
                    rows += [(ids[first + int(i)].as_py(), *found) for found in windows_of(own)]
                columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays(columns, names)

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), plain_words(F.col("text")).alias("text"))
    return map_texts(plain, scan, "doc_id long, start int, size int, fp1 long, fp2 long, shingles array<long>")


def _blocks(radius: int) -> Column:
    """(block, bits) for each of radius + 1 blocks: of two fingerprints within the radius one agrees."""
    edges = [FINGERPRINT_BITS * i // (radius + 1) for i in range(radius + 2)]
    parts = []
    for block, (low, high) in enumerate(zip(edges, edges[1:], strict=False)):
        bits = []
        for word, name in enumerate(("fp1", "fp2")):
            a, b = max(low, 64 * word) - 64 * word, min(high, 64 * word + 64) - 64 * word
            if a < b:
                value = F.shiftrightunsigned(F.col(name), a)
                bits.append(value if b - a == 64 else value.bitwiseAND(F.lit((1 << (b - a)) - 1)))
        parts.append(F.struct(F.lit(block).alias("block"), F.hash(*bits).alias("bits")))
    return F.inline(F.array(*parts))


def weighted_similarity(window: list[int], item: dict[int, tuple[int, float]], most: float) -> float:
    """Weighted Jaccard similarity of a window and an item {shingle: (times, weight)}."""
    own = Counter(window)
    shared = sum(min(n, own[s]) * w for s, (n, w) in item.items())
    union = sum(max(n, own[s]) * w for s, (n, w) in item.items())
    union += sum(n for s, n in own.items() if s not in item) * most
    return shared / union if union else 0.0


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    words_per_shingle: int = 5,
    percent: int = 80,
    radius: int = 32,
) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, similarity): each document's best window of each item in it."""
    profiles = staged(item_profiles(items, words_per_shingle), "items")
    sizes = sorted(row["size"] for row in profiles.select("size").distinct().collect())  # at most the longest item
    n_items = profiles.select("item_id").distinct().count()
    most = math.log(1 + n_items)
    windows = staged(marked_windows(docs, _bitmap(profiles), sizes, words_per_shingle, percent), "windows")

    # equal windows of many documents are looked up once
    content = F.xxhash64("shingles"), F.xxhash64(F.lit("second"), "shingles")
    named = windows.withColumns({"c1": content[0], "c2": content[1]})
    distinct = named.groupBy("size", "c1", "c2").agg(
        F.first("fp1").alias("fp1"), F.first("fp2").alias("fp2"), F.first("shingles").alias("shingles")
    )
    distinct = staged(distinct, "distinct-windows")
    by_block = distinct.select("size", "c1", "c2", "fp1", "fp2", _blocks(radius))
    item_rows = profiles.select("item_id", "size", "fp1", "fp2", F.xxhash64("shingles").alias("text_no"))
    item_blocks = item_rows.select(
        "item_id", "text_no", F.col("size").alias("i_size"), F.col("fp1").alias("i1"), F.col("fp2").alias("i2"), _blocks(radius)
    ).withColumnsRenamed({"block": "i_block", "bits": "i_bits"})
    distance = F.bit_count(F.col("fp1").bitwiseXOR(F.col("i1"))) + F.bit_count(F.col("fp2").bitwiseXOR(F.col("i2")))
    candidates = (
        by_block.join(
            item_blocks,
            (F.col("size") == F.col("i_size")) & (F.col("block") == F.col("i_block")) & (F.col("bits") == F.col("i_bits")),
        )
        .filter(distance <= radius)
        .select("size", "c1", "c2", "item_id", "text_no")
        .distinct()
    )

    # weights of the items' shingles
    exploded = profiles.select("item_id", F.xxhash64("shingles").alias("text_no"), F.explode("shingles").alias("shingle"))
    rarity = exploded.groupBy(F.col("shingle").alias("s")).agg(F.count_distinct("item_id").alias("df"))
    weighted = (
        exploded.groupBy("item_id", "text_no", "shingle").agg(F.count("*").cast("int").alias("times"))
        .join(rarity, F.col("shingle") == F.col("s"))
        .groupBy(F.col("item_id").alias("w_item"), F.col("text_no").alias("w_text"))
        .agg(F.collect_list(F.struct("shingle", "times", F.log(1 + F.lit(n_items) / F.greatest("df", F.lit(1))).alias("weight"))).alias("profile"))
    )

    def verify(batches):
        for batch in batches:
            rows = batch.to_pylist()
            keep = []
            for row in rows:
                item = {p["shingle"]: (p["times"], p["weight"]) for p in row["profile"]}
                similarity = weighted_similarity(row["shingles"], item, most)
                if 100 * similarity >= percent - 1e-9:
                    keep.append((row["size"], row["c1"], row["c2"], row["item_id"], similarity))
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
            names = ["v_size", "v1", "v2", "item_id", "similarity"]
            yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in keep], t) for i, t in enumerate(types)], names)

    verified = (
        candidates.join(weighted, F.col("item_id").eqNullSafe(F.col("w_item")) & (F.col("text_no") == F.col("w_text")))
        .join(distinct.select("size", "c1", "c2", "shingles"), ["size", "c1", "c2"])
        .select("size", "c1", "c2", "item_id", "shingles", "profile")
        .mapInArrow(verify, "v_size int, v1 long, v2 long, item_id long, similarity double")
    )
    hits = named.select("doc_id", "start", "size", "c1", "c2").join(
        staged(verified, "verified"), (F.col("size") == F.col("v_size")) & (F.col("c1") == F.col("v1")) & (F.col("c2") == F.col("v2"))
    )
    best = F.max(F.struct(F.round("similarity", 12).alias("s"), (-F.col("start")).alias("at"), "size", "similarity"))
    return hits.groupBy("doc_id", "item_id").agg(best.alias("best")).select(
        "doc_id",
        "item_id",
        (-F.col("best.at")).alias("start_word"),
        F.col("best.size").alias("n_words"),
        F.col("best.similarity").alias("similarity"),
    )


def without_leaks(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that hold no item; a null id is dropped if any row with a null id holds one."""
    leaks = staged(find_leaks(docs, items, **options).select(F.col("doc_id").alias("_leak_id")).distinct(), "leaks")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_leak_id"))
    return docs.join(broadcast_if_small(leaks, MAX_BROADCAST_IDS), same, "left_anti")
