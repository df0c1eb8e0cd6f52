"""Importance resampling: matrix CRCs, weights and ranks against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import string
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from lawloom.llm import importance

_FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
_WORD = re.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text):
    w = _WORD.findall((text or "").translate(_FOLD))
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def bucket(feature, buckets):
    return zlib.crc32(feature.encode()) % buckets


def brute(docs, target, percent=25, min_words=20, buckets=10_000):
    """Rows (doc_id, n_features, weight, score, rank) of [(doc_id, text)]."""
    s = Counter(bucket(f, buckets) for _, text in docs for f in features(text))
    t = Counter(bucket(f, buckets) for text in target for f in features(text))
    s_all, t_all = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (s_all + buckets) / ((s[b] + 1.0) * (t_all + buckets)))) for b in range(buckets)]
    rows = []
    for i, text in docs:
        f = features(text)
        weight = sum(gain[bucket(x, buckets)] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= 2 * min_words - 1), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    rank = {id(r): k + 1 for k, r in enumerate(able[: percent * len(able) // 100])}
    return [(*r, rank.get(id(r))) for r in rows]


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("size", [0, 1, 3, 255, 256, 257, 511, 512, 513, 5000])
def test_crc_of_long_strings(size):
    rng = random.Random(size)
    strings = [rng.randbytes(size) for _ in range(3)]
    assert importance.crc32_all(pa.array(strings, type=pa.binary())).tolist() == [zlib.crc32(s) for s in strings]


def test_crc_of_mixed_lengths_and_slices():
    rng = random.Random(5)
    strings = [rng.randbytes(rng.choice([0, 1, 2, 7, 8, 30, 300, 1025])) for _ in range(500)]
    array = pa.array(strings, type=pa.binary())
    assert importance.crc32_all(array).tolist() == [zlib.crc32(s) for s in strings]
    assert importance.crc32_all(array.slice(100, 50)).tolist() == [zlib.crc32(s) for s in strings[100:150]]
    assert importance.crc32_all(array.slice(0, 0)).tolist() == []


def _texts(rng, n):
    alphabet = ["ab", "Ab", "é", "zoé1", "x", "9", "中文", "under_score", "a-b", "\x00", "{", "Ω"]
    return ["".join(rng.choice(alphabet) + rng.choice([" ", "\n", "", ", "]) for _ in range(rng.randint(0, 90))) for _ in range(n)]


@pytest.mark.parametrize("partitions", [1, 5])
def test_like_plain_python(spark, partitions):
    rng = random.Random(partitions)
    docs = list(enumerate([None, "", "...", "one", "w" * 3000 + " x", *_texts(rng, 120)]))
    target = [None, *_texts(rng, 30)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(partitions)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    for percent, least, buckets in ((25, 20, 10_000), (60, 5, 16), (100, 1, 1), (0, 1, 50)):
        out = importance.resample(frame, wanted, percent, least, buckets)
        assert got(out) == sorted(brute(docs, target, percent, least, buckets), key=repr)


def test_ties_repeats_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(25))
    docs = [(i, text) for i in (3, 3, 1, None, None, 2)] + [(3, text + " more")]
    out = importance.resample(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(text,)], "text string"), 50)
    rows = got(out)
    assert rows == sorted(brute(docs, [text], 50), key=repr)
    assert sorted(r[4] for r in rows if r[4]) == [1, 2, 3]


def test_odd_documents(spark, odd_documents, no_documents):
    rows = got(importance.resample(odd_documents, odd_documents.select("text"), 100, 1))
    docs = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    assert rows == sorted(brute(docs, [t for _, t in docs], 100, 1), key=repr)
    assert importance.resample(no_documents, odd_documents).count() == 0
    alone = importance.resample(odd_documents, no_documents)
    assert alone.columns == ["doc_id", "n_features", "weight", "score", "rank"] and alone.count() == len(docs)


def test_drawn_documents_are_like_the_target(spark):
    rng = random.Random(9)
    law, shop = [f"law{i}" for i in range(40)], [f"shop{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choice(law if i % 5 == 0 else shop) for _ in range(60))) for i in range(400)]
    target = [(" ".join(rng.choice(law) for _ in range(60)),) for _ in range(40)]
    out = importance.resample(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(target, "text string"), 10)
    drawn = [r["doc_id"] for r in out.filter("rank IS NOT NULL").collect()]
    assert len(drawn) == 40 and sum(i % 5 == 0 for i in drawn) >= 36
