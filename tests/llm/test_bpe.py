"""Chunked encoding against the tokenizers library, and its decoding."""

from __future__ import annotations

import hashlib
import json
import random

import numpy as np
import pyarrow as pa
import pytest

from lawloom.llm import bpe, queries
from lawloom.llm.hashing import text_chunks
from tests.llm.brute import SF

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def path():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def vocabulary(path):
    return bpe.ByteBPE.from_file(path)


@pytest.fixture(scope="module")
def library(path):
    return tokenizers.Tokenizer.from_file(path)


PARTS = [
    "a", "b", " ", "  ", "\n", "\t", "\r\n", "'", "s", "'re", "'ll", "1", "23", "é", "é", "中", "文", "\x85", "\xa0", "\x1c",
    " ", "🙂", "<|endoftext|>", "<|endof", "text|>", "!", "...", "the", " word", " and the", "ß", "Ж", "²", "\x00", "_", "  \n ",
]


def texts(seed, n, longest=200):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def encode(vocabulary, values, chunk_bytes, cache_bytes=bpe.CACHE_BYTES):
    encoder, out = bpe.ChunkEncoder(vocabulary, chunk_bytes, cache_bytes), []
    for _, _, data, offsets in text_chunks(pa.array(values, type=pa.string())):
        for cuts in bpe.cut_points(data, offsets, chunk_bytes):
            out.append(encoder.encode(data.tobytes()[int(cuts[0]) : int(cuts[-1])], (cuts - cuts[0]).tolist()))
    return out, encoder


@pytest.mark.parametrize("chunk_bytes", [1, 3, 16, 60, 1024])
def test_like_the_library(vocabulary, library, chunk_bytes):
    """Tiny chunks put joins everywhere: in words, in spaces, in special tokens."""
    values = [None, *texts(chunk_bytes, 400), "a" * 5000, "中" * 3000, " " * 4000, "1 " * 2000, "ab, " * 2000]
    got, _ = encode(vocabulary, values, chunk_bytes)
    assert got == [e.ids for e in library.encode_batch([v or "" for v in values], add_special_tokens=False)]


def test_a_small_cache_changes_nothing(vocabulary):
    values = texts(5, 100) * 3
    small, encoder = encode(vocabulary, values, 16, 2000)
    large, roomy = encode(vocabulary, values, 16)
    assert small == large
    assert encoder.held <= 2000 and roomy.encoded < encoder.encoded


def test_shared_chunks_are_encoded_once(vocabulary):
    rng = random.Random(1)
    passage = " ".join(f"{rng.choice(['law', 'shop', 'tree'])}{rng.randrange(999)}" for _ in range(2000))
    _, encoder = encode(vocabulary, [f"{i} {passage} {i}" for i in range(50)], 256)
    assert encoder.met > 50 * 30 and encoder.encoded < encoder.met / 10


def test_cuts_depend_on_content_alone():
    passage = texts(2, 1, 3000)[0].encode() + " tail of the passage".encode() * 50
    def inner(text):
        ((*_, data, offsets),) = text_chunks(pa.array([text.decode()]))
        (cuts,) = bpe.cut_points(data, offsets, 32)
        assert all(data[c] & 0xC0 != 0x80 for c in cuts[:-1])
        return cuts
    alone, moved = inner(passage), inner(b"some other words " + passage)
    assert [c for c in moved - 17 if c > 100] == [c for c in alone if c > 100]


def test_every_merge_is_reached_by_its_own_pair(path, vocabulary):
    """Merging any two neighbours that spell a token, by id, then equals merging the listed pairs in order."""
    with open(path, encoding="utf-8") as file:
        merges = json.load(file)["model"]["merges"]
    letters = bpe._byte_letters()
    pairs = [tuple(bytes(letters[c] for c in part) for part in (m.split(" ") if isinstance(m, str) else m)) for m in merges]
    rank = {pair: i for i, pair in enumerate(pairs)}
    for a, b in pairs:
        parts = [bytes([x]) for x in a + b]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda k: rank.get((parts[k], parts[k + 1]), len(rank)))
            assert (parts[best], parts[best + 1]) in rank, a + b
            parts[best : best + 2] = [parts[best] + parts[best + 1]]


def test_decoding_like_the_library(vocabulary, library):
    rng = random.Random(4)
    lists = [[rng.randrange(50_257) for _ in range(rng.randint(0, 30))] for _ in range(300)]
    ends = np.cumsum([0, *map(len, lists)])
    flat = np.array([i for part in lists for i in part], dtype=np.int32)
    assert vocabulary.decode_all(flat, ends) == [library.decode(part, skip_special_tokens=False) for part in lists]


@pytest.mark.parametrize("change", [{"normalizer": {"type": "Lowercase"}}, {"model": {"type": "Unigram"}}])
def test_other_kinds_of_files_are_refused(path, tmp_path, change):
    with open(path, encoding="utf-8") as file:
        spec = json.load(file) | change
    (tmp_path / "t.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        bpe.ByteBPE.from_file(str(tmp_path / "t.json"))


def test_query_equals_the_library(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for doc_id, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids, skip_special_tokens=False))))
    assert sorted(map(tuple, queries.op13_byte_bpe(spark, SF).collect())) == sorted(want)


def test_odd_documents(spark, vocabulary, library, odd_documents, no_documents):
    got = [(r["doc_id"], r["ids"], r["decoded"]) for r in bpe.encode_documents(odd_documents, vocabulary, 64).collect()]
    rows = [(r["doc_id"], r["text"] or "") for r in odd_documents.collect()]
    assert sorted(got, key=repr) == sorted(((i, library.encode(t, add_special_tokens=False).ids, t) for i, t in rows), key=repr)
    assert bpe.encode_documents(no_documents, vocabulary).columns == ["doc_id", "ids", "decoded"]
    assert bpe.encode_documents(no_documents, vocabulary).count() == 0
