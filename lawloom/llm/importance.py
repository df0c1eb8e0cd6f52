"""Importance resampling of documents towards the distribution of target texts.

Features are the words and word pairs of a text; a feature's bucket is its crc32 modulo
the number of buckets. The CRCs of a batch are computed at once: distinct features of
equal length are the columns of one matrix of bytes, every step takes one byte of all of
them, and the results go back to the features' places.

Scales: two scans of the texts. Between tasks go bucket counts (a bounded number for each
task), and five numbers for each document. Ranks need no sort in one task: documents are
counted by score (scores have a bounded range), and ordered within a score.

Odd input: a null text has no words and weight 0. A null id is drawn as the empty id.
Rows with equal ids are rows of their own, ordered by their other results. Words of any
length and empty tables are fine. Columns beside `doc_id` and `text` are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lawloom.llm.common import map_texts, staged
from lawloom.llm.hashing import text_chunks

BUCKETS = 10_000
_CHUNK_BYTES = 1 << 20
#: Columns of a matrix that are read byte by byte; longer features are cut into blocks of this size.
_BLOCK = 256
_POLYNOMIAL = 0xEDB88320  # of crc32, bits reversed
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


# ---- crc32 of many byte strings ----


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1)
    return table


_TABLE = _crc_table()


def _read_columns(state: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """CRC registers after the rows of `matrix`, one byte for every register each."""
    for row in matrix:
        state = _TABLE[(state ^ row) & 0xFF] ^ (state >> 8)
    return state


def _block_shift() -> np.ndarray:
    """shift[k][b]: the register with byte b at place k, after a block of zero bytes."""
    registers = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32)[:, None])).ravel()
    return _read_columns(registers, np.zeros((_BLOCK, 1), dtype=np.uint8)).reshape(4, 256)


_SHIFT = _block_shift()


def _read_blocks(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Registers after `blocks` (string, block): a register is linear, so a block's own is added after a shift."""
    for own in blocks.T:
        state = _SHIFT[0][state & 0xFF] ^ _SHIFT[1][state >> 8 & 0xFF] ^ _SHIFT[2][state >> 16 & 0xFF] ^ _SHIFT[3][state >> 24] ^ own
    return state


def crc32_all(strings: pa.BinaryArray) -> np.ndarray:
    """Unsigned crc32 of every string, by matrices of equal length."""
    offsets = np.frombuffer(strings.buffers()[1], dtype=np.int32)[strings.offset : strings.offset + len(strings) + 1].astype(np.int64)
    data = np.frombuffer(strings.buffers()[2] or b"", dtype=np.uint8)
    lengths = np.diff(offsets)
    order = np.argsort(lengths, kind="stable")
    sizes, firsts = np.unique(lengths[order], return_index=True)
    out = np.empty(len(strings), dtype=np.uint32)
    for size, members in zip(sizes.tolist(), np.split(order, firsts[1:])):
        head = size % _BLOCK if size > _BLOCK else size
        begins = offsets[members]
        state = np.full(len(members), 0xFFFFFFFF, dtype=np.uint32)
        state = _read_columns(state, data[begins[None, :] + np.arange(head)[:, None]])
        if size > head:
            places = (begins[:, None] + np.arange(head, size, _BLOCK)[None, :]).ravel()
            own = np.zeros(len(places), dtype=np.uint32)
            own = _read_columns(own, (data[places + k] for k in range(_BLOCK)))
            state = _read_blocks(state, own.reshape(len(members), -1))
        out[members] = ~state
    return out


# ---- features ----


class _Features:
    """Buckets of a group of texts: of every word, and of the pair that starts at it.

    `pair_bucket` is -1 where a text ends; words bounds[i]:bounds[i+1] are of text i.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, buckets: int):
        low = _LOWER[data]
        ink = np.concatenate(([False], _IS_WORD[low], [False]))
        begins, stops = ink[1:-1] & ~ink[:-2], ink[1:-1] & ~ink[2:]
        inner = offsets[1:-1]
        inner = inner[(inner > 0) & (inner < len(data))]
        begins[inner] = ink[1:-1][inner]
        stops[inner - 1] = ink[1:-1][inner - 1]
        starts = np.flatnonzero(begins)
        lengths = np.flatnonzero(stops) + 1 - starts
        self.bounds = np.searchsorted(starts, offsets)
        ends = np.zeros(len(starts) + 1, dtype=np.int32)
        np.cumsum(lengths, out=ends[1:])
        words = pa.BinaryArray.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(low[ink[1:-1]])]
        ).dictionary_encode()
        codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        distinct = words.dictionary
        self.word_bucket = (crc32_all(distinct) % np.uint32(buckets)).astype(np.int64)[codes] if len(codes) else codes

        last = np.zeros(len(codes), dtype=bool)
        ends_of_texts = self.bounds[1:] - 1
        last[ends_of_texts[ends_of_texts >= self.bounds[:-1]]] = True
        inside = np.flatnonzero(~last)
        pairs = pa.array(codes[inside] * max(1, len(distinct)) + codes[np.minimum(inside + 1, len(codes) - 1)]).dictionary_encode()
        both = pairs.dictionary.to_numpy()
        joined = pc.binary_join_element_wise(
            distinct.take(pa.array(both // max(1, len(distinct)))), distinct.take(pa.array(both % max(1, len(distinct)))), b" "
        )
        self.pair_bucket = np.full(len(codes), -1, dtype=np.int64)
        if len(inside):
            found = (crc32_all(joined) % np.uint32(buckets)).astype(np.int64)
            self.pair_bucket[inside] = found[pairs.indices.to_numpy(zero_copy_only=False)]


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, text_column: str = "text") -> DataFrame:
    """(bucket, n): features of all texts, repeats counted."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0), _CHUNK_BYTES):
                found = _Features(data, offsets, buckets)
                total += np.bincount(found.word_bucket, minlength=buckets)
                total += np.bincount(found.pair_bucket + 1, minlength=buckets + 1)[1:]
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    parts = map_texts(texts.select(F.col(text_column).cast("string").alias("text")), count, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Gain of every bucket, in thousandths: log of its smoothed share in the target over that in the corpus.

    Brings at most `buckets` rows of each side to the driver.
    """
    s, t = [0] * buckets, [0] * buckets
    for counts, into in ((corpus, s), (target, t)):
        for row in counts.collect():
            into[row["bucket"]] = row["n"]
    s_all, t_all = sum(s), sum(t)
    return [
        math.floor(1000 * math.log(float(t[b] + 1) * float(s_all + buckets) / (float(s[b] + 1) * float(t_all + buckets))))
        for b in range(buckets)
    ]


def weigh_documents(docs: DataFrame, gains: list[int]) -> DataFrame:
    """(doc_id, n_words, n_features, weight): the floored mean of the gains of a document's features."""
    table = np.array(gains, dtype=np.int64)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, weights = [], []
            for _, _, data, offsets in text_chunks(batch.column(1), _CHUNK_BYTES):
                found = _Features(data, offsets, len(table))
                gain = table[found.word_bucket] + np.where(found.pair_bucket >= 0, table[found.pair_bucket], 0)
                sums = np.concatenate(([0], np.cumsum(gain)))
                n = np.diff(found.bounds)
                features = np.maximum(2 * n - 1, 0)
                total = sums[found.bounds[1:]] - sums[found.bounds[:-1]]
                n_words.append(n)
                weights.append(np.where(n > 0, total // np.maximum(features, 1), 0))
            if n_words:
                n = np.concatenate(n_words).astype(np.int64)
                columns = [pa.array(n), pa.array(np.maximum(2 * n - 1, 0)), pa.array(np.concatenate(weights))]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_words", "n_features", "weight"])

    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]])
    return map_texts(docs.select("doc_id", F.col("text").cast("string").alias("text")), weigh, schema)


# ---- drawing ----


def gumbel_thousandths(key: Column, seed: int) -> Column:
    """Gumbel noise of a key, in floored thousandths, the same on every run."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((draw + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, buckets: int = BUCKETS, seed: int = 7
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document of `docs` (doc_id, text).

    Of the documents with `min_words` words or more, `percent` per cent are drawn without
    replacement, with chances that follow their weights: those with the highest scores,
    weight and Gumbel noise, ties to the smaller id. They are ranked 1, 2, ...; the
    others have no rank. `target` has the texts whose distribution is wanted.
    """
    gains = bucket_gains(bucket_counts(docs, buckets), bucket_counts(target, buckets), buckets)
    weighed = weigh_documents(docs, gains)
    scored = staged(weighed.withColumn("score", F.col("weight") + gumbel_thousandths(F.col("doc_id"), seed)), "importance")
    able = F.col("n_words") >= min_words

    # One count for each score: gains and noise are bounded, and so is the number of scores.
    counts = scored.filter(able).groupBy("score").agg(F.count("*").alias("n")).collect()
    wanted = percent * sum(r["n"] for r in counts) // 100
    ahead, before = [], 0
    for row in sorted(counts, key=lambda r: -r["score"]):
        if before >= wanted:
            break
        ahead.append((row["score"], before))
        before += row["n"]
    lowest = ahead[-1][0] if ahead else None
    named = ("doc_id", "n_features", "weight", "score")
    if lowest is None:
        return scored.select(*named, F.lit(None).cast("long").alias("rank"))

    chosen = able & (F.col("score") >= lowest)
    places = F.broadcast(scored.sparkSession.createDataFrame(ahead, "_score long, _ahead long"))
    within = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features", "weight")
    ranked = (
        scored.filter(chosen)
        .withColumn("_place", F.row_number().over(within))
        .join(places, F.col("score") == F.col("_score"))
        .withColumn("rank", F.col("_ahead") + F.col("_place"))
        .select(*named, F.when(F.col("rank") <= wanted, F.col("rank")).alias("rank"))
    )
    return ranked.unionByName(scored.filter(~chosen).select(*named, F.lit(None).cast("long").alias("rank")))
