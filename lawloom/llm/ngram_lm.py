"""Language-model scoring with an Elias-Fano n-gram trie.

The model is a bigram model with Dirichlet smoothing, so every distribution sums to one:

    P(w | v) = (c(v w) + strength * P(w)) / (c(v) + strength)
    P(w)     = (c(w) + 0.5) / (N + 0.5 * (V + 1))

Counts come from the training documents; a text starts in its own context and ends with a
token of its own. Probabilities are stored as multiples of STEP in log10, in 16 bits.

1. Blocks of documents number their distinct words; a block ships each word once. Parts
   of the words, by hash, add the counts up and give every word a number.
2. With these, a block ships each of its distinct bigrams once, with the documents that
   hold it, to the part of the bigram's context. A context that is more than a part's
   share is dealt out by its successors as well.
3. A part makes the trie of its contexts and their successors from the training counts,
   asks it for every bigram shipped there, and returns the sums of each document.

A part holds about PART_TOKENS tokens whatever the size of the corpus: no vocabulary and
no trie is ever whole in one place.

Defined results: a null text is empty and consists of its end token; rows with the same
id are scored each; a null id counts as '' for the fold and is returned; with no
training text all probabilities are equal; an empty table gives an empty result; only
doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawloom.llm.common import forget, map_texts, staged, text_or_empty
from lawloom.llm.elias_fano import NgramTrie
from lawloom.llm.hashing import hash_words, mix64, text_chunks
from lawloom.llm.packing import join_packed, pack, runs, schema_batch, unpack

#: Quantum of the stored log10 probabilities.
STEP = 2.0**-10
BLOCK_TOKENS = 1 << 20
PART_TOKENS = 1 << 20
_END = np.uint64(0x9D5C0FB1E2A7C613)
#: Number of the context in which texts start; words are numbered from 1.
_BEGIN = 0


# ---- blocks ----

_BLOCK = pa.schema(
    [("block", pa.string()), ("n", pa.int64()), ("ids", pa.list_(pa.int64())), ("train", pa.list_(pa.bool_()))]
    + [(k, pa.binary()) for k in ("lengths", "tokens", "words", "counts")]
)
_BLOCK_SQL = "block string, n long, ids array<long>, train array<boolean>, lengths binary, tokens binary, words binary, counts binary"


def document_blocks(docs: DataFrame) -> DataFrame:
    """Blocks of about BLOCK_TOKENS tokens from (doc_id, train, text).

    words: distinct word hashes, the commonest first; tokens: places in them, document
    after document; counts: of each word in the block's training documents.
    """

    def numbered(batches):
        from pyspark import TaskContext

        made, held, n_held = 0, [], 0

        def block():
            nonlocal made
            hashes = np.concatenate([h for _, _, h in held])
            lengths = np.array([len(h) for _, _, h in held], dtype=np.uint32)
            words, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
            order = np.argsort(-counts, kind="stable")
            place = np.empty(len(words), dtype=np.uint32)
            place[order] = np.arange(len(words), dtype=np.uint32)
            tokens = place[inverse]
            in_training = np.repeat(np.array([t for _, t, _ in held]), lengths)
            trained = np.bincount(tokens[in_training], minlength=len(words)).astype(np.uint32)
            made += 1
            name = f"{TaskContext.get().partitionId()}-{made}"
            ids, train = [i for i, _, _ in held], [t for _, t, _ in held]
            columns = (pack(lengths), pack(tokens), pack(words[order]), pack(trained))
            return schema_batch([(name, len(tokens), ids, train, *columns)], _BLOCK)

        for batch in batches:
            ids, train = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, end, data, offsets in text_chunks(batch.column(2)):
                words = hash_words(data, offsets)
                for i in range(end - first):
                    own = np.append(words.hashes[words.bounds[i] : words.bounds[i + 1]], _END)
                    held.append((ids[first + i], train[first + i], own))
                    n_held += len(own)
                if n_held >= BLOCK_TOKENS:
                    yield block()
                    held, n_held = [], 0
        if held:
            yield block()

    return map_texts(docs.select("doc_id", "train", "text"), numbered, _BLOCK_SQL)


# ---- word counts and numbers ----

_PART = pa.schema([("block", pa.string()), ("part", pa.int64()), ("words", pa.binary()), ("counts", pa.binary())])
_TOTALS_SQL = "block string, part long, totals binary, numbers binary, n_distinct long, n_tokens long"


def _part_of_words(words: np.ndarray, parts: int) -> np.ndarray:
    return (mix64(words) >> np.uint64(8)) % np.uint64(parts)


def word_totals(blocks: DataFrame, parts: int) -> DataFrame:
    """Training count and number of every word of every block, part by part in the block's order."""

    def deal(batches):
        for batch in batches:
            for name, words, counts in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                words, counts = unpack(words), unpack(counts)
                part = _part_of_words(words, parts)
                order = np.argsort(part, kind="stable")
                starts, ends = runs(part[order])
                rows = [
                    (name, int(part[order[a]]), pack(words[order[a:b]]), pack(counts[order[a:b]]))
                    for a, b in zip(starts, ends, strict=True)
                ]
                yield schema_batch(rows, _PART)

    def add(group: pa.Table) -> pa.Table:
        sizes = [len(unpack(b.as_py())) for b in group["words"]]
        words, counts = join_packed(group["words"]), join_packed(group["counts"])
        distinct, inverse = np.unique(words, return_inverse=True)
        total = np.bincount(inverse, weights=counts).astype(np.uint64)
        part = group["part"][0].as_py()
        numbers = (np.arange(len(distinct), dtype=np.uint64) * np.uint64(parts) + np.uint64(part + 1))[inverse]
        if not len(numbers) or numbers.max() < 1 << 32:
            numbers = numbers.astype(np.uint32)
        cut = np.cumsum(sizes)[:-1]
        own = [(pack(t), pack(n)) for t, n in zip(np.split(total[inverse], cut), np.split(numbers, cut), strict=True)]
        first = [1] + [0] * (len(sizes) - 1)  # the part's own figures once
        return pa.table(
            {
                "block": group["block"],
                "part": group["part"],
                "totals": pa.array([t for t, _ in own], pa.binary()),
                "numbers": pa.array([n for _, n in own], pa.binary()),
                "n_distinct": pa.array([f * int((total > 0).sum()) for f in first], pa.int64()),
                "n_tokens": pa.array([f * int(total.sum()) for f in first], pa.int64()),
            }
        )

    dealt = blocks.select("block", "words", "counts").mapInArrow(deal, "block string, part long, words binary, counts binary")
    return dealt.groupBy("part").applyInArrow(add, _TOTALS_SQL)


_NUMBERED_SQL = "block string, ids array<long>, train array<boolean>, lengths binary, tokens binary, totals binary, numbers binary"


def with_totals(blocks: DataFrame, totals: DataFrame, parts: int) -> DataFrame:
    """The blocks with the total and the number of each of their words."""

    def put(left: pa.Table, right: pa.Table) -> pa.Table:
        words = unpack(left["words"][0].as_py())
        part = _part_of_words(words, parts)
        total, number = np.zeros(len(words), dtype=np.uint64), np.zeros(len(words), dtype=np.uint64)
        rows = zip(*(right[c].to_pylist() for c in ("part", "totals", "numbers")), strict=True)
        places = np.split(np.argsort(part, kind="stable"), np.cumsum(np.bincount(part.astype(np.int64), minlength=parts))[:-1])
        for p, totals, numbers in rows:
            total[places[p]], number[places[p]] = unpack(totals), unpack(numbers)
        if not len(number) or number.max() < 1 << 32:
            total, number = total.astype(np.uint32) if total.max(initial=0) < 1 << 32 else total, number.astype(np.uint32)
        kept = left.select(["block", "ids", "train", "lengths", "tokens"])
        return kept.append_column("totals", pa.array([pack(total)], pa.binary())).append_column(
            "numbers", pa.array([pack(number)], pa.binary())
        )

    left = blocks.select("block", "ids", "train", "lengths", "tokens", "words").groupBy("block")
    right = totals.select("block", "part", "totals", "numbers").groupBy("block")
    return left.cogroup(right).applyInArrow(put, _NUMBERED_SQL)


# ---- scores ----


class Unigrams:
    """log10 P(w) from the training counts."""

    def __init__(self, n_tokens: int, n_distinct: int):
        self.n_tokens, self.n_distinct = n_tokens, n_distinct

    def log10(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.n_tokens + 0.5 * (self.n_distinct + 1)))


_DEALT_COLUMNS = ("contexts", "context_counts", "words", "word_counts", "trained", "times", "docs")
_DEALT = pa.schema([("block", pa.string()), ("part", pa.int64())] + [(c, pa.binary()) for c in _DEALT_COLUMNS])
_DEALT_SQL = "block string, part long, " + ", ".join(f"{c} binary" for c in _DEALT_COLUMNS)


def deal_bigrams(numbered: DataFrame, parts: int, part_tokens: int) -> DataFrame:
    """Each block's distinct bigrams by part, with counts and the documents (places in the block) that hold them."""

    def deal(batches):
        for batch in batches:
            for name, train, *blobs in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                lengths, tokens, totals, numbers = map(unpack, blobs)
                doc = np.repeat(np.arange(len(lengths), dtype=np.uint32), lengths)
                n = len(totals)
                ends = np.cumsum(lengths, dtype=np.int64)
                before = np.concatenate(([n], tokens[:-1])).astype(np.int64)
                before[ends[:-1]] = n  # place n stands for the beginning
                end_count = totals[tokens[-1]]  # as many texts end as begin
                context_totals = np.append(totals, end_count).astype(np.uint64)
                context_numbers = np.append(numbers, _BEGIN).astype(np.uint64)
                key = before.astype(np.uint64) * np.uint64(n + 1) + tokens.astype(np.uint64)
                order = np.argsort(key, kind="stable")
                starts, stops = runs(key[order])
                of_type = order[starts]
                context, word = before[of_type], tokens[of_type]
                slices = context_totals[context] // np.uint64(part_tokens) + np.uint64(1)
                share = mix64(numbers[word].astype(np.uint64)) % slices
                part = mix64(context_numbers[context] * np.uint64(0x9E3779B97F4A7C15) + share) % np.uint64(parts)
                trained = np.add.reduceat(np.array(train)[doc[order]].astype(np.uint32), starts)
                types = np.argsort(part, kind="stable")
                times = (stops - starts).astype(np.uint32)
                places = np.repeat(starts[types], times[types]) + _within(times[types])
                docs = doc[order][places]
                cut = np.concatenate(([0], np.cumsum(times[types], dtype=np.int64)))
                rows = []
                for a, b in zip(*runs(part[types]), strict=True):
                    t = types[a:b]
                    columns = (
                        context_numbers[context[t]], context_totals[context[t]], numbers[word[t]], totals[word[t]],
                        trained[t], times[t], docs[cut[a] : cut[b]],
                    )
                    rows.append((name, int(part[t[0]]), *(pack(_narrow(c)) for c in columns)))
                yield schema_batch(rows, _DEALT)

    columns = numbered.select("block", "train", "lengths", "tokens", "totals", "numbers")
    return columns.mapInArrow(deal, _DEALT_SQL)


def _within(times: np.ndarray) -> np.ndarray:
    """0, 1, ... times[0] - 1, 0, 1, ..."""
    total = np.cumsum(times, dtype=np.int64)
    return np.arange(total[-1] if len(total) else 0) - np.repeat(total - times, times)


def _narrow(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint32) if values.max(initial=0) < 1 << 32 else values.astype(np.uint64)


def build_trie(
    contexts: np.ndarray, context_counts: np.ndarray, words: np.ndarray, probabilities: np.ndarray, counts: np.ndarray, strength: float
) -> NgramTrie:
    """Trie of the bigrams with a count, sorted by context and word; probabilities: P(w)."""
    seen = counts > 0
    contexts, context_counts, words, probabilities, counts = (x[seen] for x in (contexts, context_counts, words, probabilities, counts))
    smoothed = (counts + strength * probabilities) / (context_counts + strength)
    starts, ends = runs(contexts)
    left_over = strength / (context_counts[starts] + strength)
    return NgramTrie(
        contexts[starts].astype(np.int64), ends - starts, words.astype(np.int64), quantised(smoothed), quantised(left_over)
    )


def quantised(probabilities: np.ndarray) -> np.ndarray:
    return np.minimum(np.rint(-np.log10(probabilities) / STEP), 65535).astype(np.uint32)


def _documents(group: pa.Table, unigrams: Unigrams, strength: float):
    """(block, documents, sums of codes) for each row of a part."""
    times = join_packed(group["times"])
    contexts, context_counts, words, word_counts, trained = (
        join_packed(group[c]).astype(np.int64) for c in ("contexts", "context_counts", "words", "word_counts", "trained")
    )
    order = np.lexsort((words, contexts))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (contexts[order][1:] != contexts[order][:-1]) | (words[order][1:] != words[order][:-1])
    which = np.empty(len(order), dtype=np.int64)
    which[order] = np.cumsum(new) - 1
    first = order[new]
    counts = np.bincount(which, weights=trained)
    chance = 10.0 ** unigrams.log10(word_counts[first])
    trie = build_trie(contexts[first], context_counts[first], words[first], chance, counts, strength)
    context_at, word_at = trie.find(contexts[first], words[first])
    unseen = quantised(chance) + np.where(context_at >= 0, trie.context_codes[context_at].astype(np.uint32), 0) if trie.contexts.n else quantised(chance)
    codes = np.where(word_at >= 0, trie.codes[word_at].astype(np.uint32), unseen) if len(trie.codes) else unseen
    start = 0
    for block, own_times, docs in zip(group["block"].to_pylist(), group["times"], group["docs"], strict=True):
        own_times, docs = unpack(own_times.as_py()), unpack(docs.as_py())
        each = np.repeat(codes[which[start : start + len(own_times)]], own_times)
        start += len(own_times)
        sums = np.bincount(docs, weights=each)
        held = np.flatnonzero(np.bincount(docs))
        yield block, held.astype(np.uint32), sums[held].astype(np.uint64)


_RESULT_COLUMNS = "block string, kind int, ids array<long>, train array<boolean>, a binary, b binary, c binary"
_RESULT = pa.schema(
    [("block", pa.string()), ("kind", pa.int32()), ("ids", pa.list_(pa.int64())), ("train", pa.list_(pa.bool_()))]
    + [(k, pa.binary()) for k in "abc"]
)


def score_documents(docs: DataFrame, train: Column, strength: float = 8.0) -> DataFrame:
    """(doc_id, in_training, n_tokens, n_known, train_tokens, base_score, score) for every row.

    `train` says which rows the model learns from. base_score: log10 by P(w) alone.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"), text_or_empty("text").alias("text"))
    blocks = staged(document_blocks(rows), "lm-blocks")
    parts = int(blocks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] // PART_TOKENS) + 1
    totals = staged(word_totals(blocks, parts), "lm-totals", free_shuffles=True)
    whole = totals.agg(F.sum("n_tokens"), F.sum("n_distinct")).first()
    n_tokens, n_distinct = whole[0] or 0, whole[1] or 0
    unigrams = Unigrams(n_tokens, n_distinct)
    numbered = staged(with_totals(blocks, totals, parts), "lm-numbered", free_shuffles=True)
    for done in (blocks, totals):
        forget(done)

    def base(batches):
        for batch in batches:
            out = []
            for name, ids, train, *blobs in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                lengths, tokens, totals = map(unpack, blobs)
                doc = np.repeat(np.arange(len(lengths)), lengths)
                counts = totals[tokens].astype(np.float64)
                known = np.bincount(doc[counts > 0], minlength=len(lengths)).astype(np.uint32)
                score = np.bincount(doc, weights=unigrams.log10(counts), minlength=len(lengths))
                out.append((name, 0, ids, train, pack(lengths), pack(known), score.tobytes()))
            yield schema_batch(out, _RESULT)

    def search(group: pa.Table) -> pa.Table:
        found = [(block, 1, None, None, pack(held), pack(sums), b"") for block, held, sums in _documents(group, unigrams, strength)]
        return pa.Table.from_batches([schema_batch(found, _RESULT)])

    base_rows = numbered.select("block", "ids", "train", "lengths", "tokens", "totals").mapInArrow(base, _RESULT_COLUMNS)
    sums = deal_bigrams(numbered, parts, PART_TOKENS).groupBy("part").applyInArrow(search, _RESULT_COLUMNS)

    def put_together(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        own = next(r for r in rows if r["kind"] == 0)
        lengths, known = unpack(own["a"]), unpack(own["b"])
        total = np.zeros(len(lengths), dtype=np.uint64)
        for row in rows:
            if row["kind"] == 1:
                total[unpack(row["a"])] += unpack(row["b"])
        return pa.table(
            {
                "doc_id": pa.array(own["ids"], pa.int64()),
                "in_training": pa.array(own["train"], pa.bool_()),
                "n_tokens": lengths.astype(np.int64),
                "n_known": known.astype(np.int64),
                "train_tokens": np.full(len(lengths), n_tokens, dtype=np.int64),
                "base_score": np.frombuffer(own["c"], dtype=np.float64),
                "score": total.astype(np.float64) * -STEP,
            }
        )

    schema = "doc_id long, in_training boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return base_rows.unionByName(sums).groupBy("block").applyInArrow(put_together, schema)
