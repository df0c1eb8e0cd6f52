"""Byte-level BPE encoding and decoding, with encoded chunks reused across documents.

Texts are cut where a rolling hash of the last bytes has a given form, so equal passages
give equal chunks whatever is around them. A chunk's tokens are kept, and a chunk that
was met before is not encoded again. A cut may fall inside a word, so every join is
repaired: a window from a word boundary before the join to one after it is encoded, and
widened on the side where its outermost tokens are not those of the chunks, until both
sides agree. The tokens between the two places of agreement are then the window's.

Why that is exact: the pre-tokenizer reads from left to right without looking back, and
a character followed by a space always ends a piece. Merges never cross pieces. So a
window between two such places has the tokens that the whole text has there.

Scales: no shuffle, and no state beyond a task: chunks are shared by the documents of a
task, in memory bounded by `cache_bytes`. Sharing them across tasks would ship all texts
and tokens, which costs more than encoding them.

Odd input: a null text is the empty text, with no tokens. Rows with equal or null ids are
rows of their own. Columns beside `doc_id` and `text` are not read. Special tokens that
are spelt in a text become their id, as in the tokenizers library. Empty tables give no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lawloom.llm.common import map_texts
from lawloom.llm.hashing import text_chunks

CHUNK_BYTES = 1024  # on average
CACHE_BYTES = 32 << 20
_GROUP_BYTES = 1 << 20
_ROLLING = 8  # bytes that decide about a cut
#: Fixed value: the pre-tokenizer of byte-level BPE.
PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BYTE_KEYS = np.random.default_rng(1309).integers(0, (1 << 64) - 1, 256, dtype=np.uint64, endpoint=True)


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: itself if printable, else one from 256 up."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {**{chr(b): b for b in printable}, **{chr(256 + i): b for i, b in enumerate(others)}}


@dataclass(frozen=True)
class ByteBPE:
    """A byte-level BPE vocabulary: the bytes of every ordinary token by id, and special tokens."""

    tokens: tuple[bytes, ...]
    special: tuple[tuple[str, int], ...]

    @classmethod
    def from_file(cls, path: str) -> ByteBPE:
        """Read a tokenizer file; ids must be in the order of the merges, as merging goes by id."""
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        plain = (
            model["type"] == "BPE"
            and not (model.get("dropout") or model.get("ignore_merges") or spec["normalizer"])
            and before.get("type") == "ByteLevel"
            and not before["add_prefix_space"]
            and before.get("use_regex", True)
        )
        if not plain:
            raise ValueError(f"{path}: not a plain byte-level BPE tokenizer")
        letters = _byte_letters()
        special = tuple((t["content"], t["id"]) for t in spec["added_tokens"])
        if any(t["content"].split() != [t["content"]] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens that take in white space are not supported")
        ordinary = sorted((i, word) for word, i in model["vocab"].items() if word not in dict(special))
        tokens = tuple(bytes(letters[c] for c in word) for _, word in ordinary)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [bytes(letters[c] for c in a + b) for a, b in merges]
        if [i for i, _ in ordinary] != list(range(len(tokens))) or list(tokens[len(tokens) - len(made) :]) != made:
            raise ValueError(f"{path}: ids are not in the order of the merges")
        return cls(tokens, special)

    @cached_property
    def engine(self):
        import tiktoken

        ranks = {token: i for i, token in enumerate(self.tokens)}
        return tiktoken.Encoding("byte-bpe", pat_str=PIECES, mergeable_ranks=ranks, special_tokens=dict(self.special))

    def encode_whole(self, text: str) -> list[int]:
        """Tokens of one text, without any reuse."""
        return self.engine.encode(text, allowed_special="all", disallowed_special=())

    @cached_property
    def lengths(self) -> list[int]:
        """Bytes of every token by id."""
        return np.diff(self._spelling[0]).tolist()

    @cached_property
    def _spelling(self) -> tuple[np.ndarray, np.ndarray]:
        """Offsets by id, and the bytes of all tokens one after the other."""
        spelt = dict(enumerate(self.tokens)) | {i: text.encode() for text, i in self.special}
        every = [spelt.get(i, b"") for i in range(max(spelt, default=-1) + 1)]
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in every], dtype=np.int64)))
        return offsets, np.frombuffer(b"".join(every), dtype=np.uint8)

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Texts of the tokens ids[ends[i]:ends[i + 1]]; bytes that are no UTF-8 become U+FFFD."""
        offsets, data = self._spelling
        sizes = np.diff(offsets)[ids]
        places = np.concatenate(([0], np.cumsum(sizes)))
        spelt = data[np.repeat(offsets[ids] - places[:-1], sizes) + np.arange(places[-1])].tobytes()
        bounds = places[ends].tolist()
        return [spelt[a:b].decode("utf-8", "replace") for a, b in zip(bounds, bounds[1:])]

    def __getstate__(self):
        return {"tokens": self.tokens, "special": self.special}


def cut_points(data: np.ndarray, offsets: np.ndarray, chunk_bytes: int = CHUNK_BYTES) -> list[np.ndarray]:
    """For each text, the offsets where its chunks start, and its end.

    A cut depends on the bytes just before it alone, and lies between characters.
    """
    n = len(data)
    hashed = np.zeros(n, dtype=np.uint64)
    keys = _BYTE_KEYS[data]
    for back in range(_ROLLING):  # Horner's rule: the oldest byte has the highest power
        hashed *= np.uint64(0x9E3779B97F4A7C15)
        shift = _ROLLING - 1 - back
        hashed[shift:] += keys[: max(0, n - shift)]
    cut = hashed <= np.uint64(((1 << 64) - 1) // chunk_bytes)
    places = np.flatnonzero(cut[:-1] & ((data[1:] & 0xC0) != 0x80)) + 1 if n else np.zeros(0, dtype=np.int64)
    bounds = np.searchsorted(places, offsets)
    out = []
    for i in range(len(offsets) - 1):
        inner = places[bounds[i] : bounds[i + 1]]
        inner = inner[(inner >= offsets[i] + _ROLLING) & (inner < offsets[i + 1])]
        out.append(np.concatenate(([offsets[i]], inner, [offsets[i + 1]])))
    return out


class ChunkEncoder:
    """Encodes texts by chunks and keeps the tokens of chunks; at most about `cache_bytes` of them."""

    def __init__(self, bpe: ByteBPE, chunk_bytes: int = CHUNK_BYTES, cache_bytes: int = CACHE_BYTES):
        self.bpe, self.chunk_bytes, self.cache_bytes = bpe, chunk_bytes, cache_bytes
        self.young: dict[bytes, list[int]] = {}
        self.old: dict[bytes, list[int]] = {}
        self.held = self.met = self.encoded = self.windows = 0

    def _tokens(self, chunk: bytes) -> list[int]:
        self.met += 1
        tokens = self.young.get(chunk)
        if tokens is None:
            tokens = self.old.get(chunk)
            if tokens is None:
                self.encoded += 1
                tokens = self.bpe.encode_whole(chunk.decode())
            self.young[chunk] = tokens
            self.held += 100 + len(chunk) + 8 * len(tokens)
            if 2 * self.held > self.cache_bytes:  # forget what was not met since the last time
                self.old, self.young, self.held = self.young, {}, 0
        return tokens

    def encode(self, text: bytes, cuts: list[int]) -> list[int]:
        """Tokens of a text that is cut into chunks at `cuts` (from 0 to its length).

        A cut with fewer than two word boundaries in the chunk before it is left out.
        """
        done: list[int] = []  # tokens of text[:start]
        start, near = 0, None
        for end in [*cuts[1:-1], len(text)]:
            inner = end < len(text)
            a1 = _boundary_before(text, start, end) if inner else 0
            a0 = _boundary_before(text, start, a1 - 1) if a1 > 0 else -1
            if inner and a0 < 0:
                continue
            tokens = self._tokens(text[start:end])
            done = self._join(text, done, *near, start, tokens, end) if near else list(tokens)
            start, near = end, (a0, a1)
        return done

    def _join(self, text: bytes, done: list[int], a0: int, a1: int, join: int, tokens: list[int], end: int) -> list[int]:
        """Tokens of text[:end] from those of text[:join] and text[join:end].

        a0 and a1 are word boundaries before the join, b0 and b1 the same after it.
        """
        b0 = _boundary_after(text, join + 1, end)
        b1 = _boundary_after(text, b0 + 1, end)
        while True:
            self.windows += 1
            window = self.bpe.encode_whole(text[a0:b1].decode())
            # Left of a1 the window must repeat the tokens of `done`, right of b0 those of `tokens`.
            keep, head = self._count(reversed(done), join - a1), self._count(window, a1 - a0)
            skip, tail = self._count(tokens, b0 - join), self._count(reversed(window), b1 - b0)
            left = keep is not None and head is not None
            left = left and window[:head] == done[len(done) - keep - head : len(done) - keep]
            right = skip is not None and tail is not None
            right = right and window[len(window) - tail :] == tokens[skip : skip + tail]
            if left and right:
                done[len(done) - keep :] = window[head : len(window) - tail]
                done += tokens[skip:]
                return done
            if not left:
                a1, a0 = a0, max(0, _boundary_before(text, 0, a0 - 1))
            if not right:
                b0, b1 = b1, _boundary_after(text, b1 + 1, end)

    def _count(self, tokens: Iterable[int], size: int) -> int | None:
        """How many of the tokens make up `size` bytes; None where that is inside a token."""
        lengths, count = self.bpe.lengths, 0
        if size:
            for token in tokens:
                size -= lengths[token]
                count += 1
                if size <= 0:
                    break
        return None if size else count


def _boundary_before(text: bytes, start: int, stop: int) -> int:
    """The last word boundary in start < place <= stop, else -1: a space after an ASCII character that is none."""
    at = text.rfind(b" ", start + 1, stop + 1)
    while at > 0 and not 0x20 < text[at - 1] < 0x7F:
        at = text.rfind(b" ", start + 1, at)
    return at


def _boundary_after(text: bytes, start: int, end: int) -> int:
    """The first word boundary in start <= place < end, else `end`."""
    at = text.find(b" ", start, end)
    while at > 0 and not 0x20 < text[at - 1] < 0x7F:
        at = text.find(b" ", at + 1, end)
    return at if at > 0 else end


def encode_documents(
    docs: DataFrame, bpe: ByteBPE, chunk_bytes: int = CHUNK_BYTES, cache_bytes: int = CACHE_BYTES
) -> DataFrame:
    """(doc_id, ids, decoded): the tokens of every whole text, and the text that the tokens make."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(bpe, chunk_bytes, cache_bytes)
        for batch in batches:
            for first, end, data, offsets in text_chunks(batch.column(1), _GROUP_BYTES):
                raw = data.tobytes()
                ids = []
                for cuts in cut_points(data, offsets, chunk_bytes):
                    begin = int(cuts[0])
                    ids.append(encoder.encode(raw[begin : int(cuts[-1])], (cuts - begin).tolist()))
                ends = np.cumsum([0, *map(len, ids)])
                flat = np.array([i for part in ids for i in part], dtype=np.int32)
                columns = [
                    batch.column(0).slice(first, end - first),
                    pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), pa.array(flat)),
                    pa.array(bpe.decode_all(flat, ends), type=pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"])

    schema = T.StructType(
        [docs.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    )
    return map_texts(docs.select("doc_id", F.col("text").cast("string").alias("text")), run, schema)
