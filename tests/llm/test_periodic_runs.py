"""Run detection against a brute force over all periods."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lawloom.llm import periodic_runs, queries
from tests.llm.brute import SF, words


def brute(w, least_words=6, least_periods=4):
    """(start, length, period) of all runs: for each period, every longest stretch of equal words one period apart."""
    out = []
    for q in range(1, len(w) // least_periods + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            run, length = w[i : j + q], j + q - i
            smaller = any(run[r:] == run[:-r] for r in range(1, q))
            if length >= max(least_words, least_periods * q) and not smaller:
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(w, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def periodic(rng):
    w = [rng.randrange(rng.choice([1, 2, 3, 6])) for _ in range(rng.randint(0, 70))]
    for _ in range(rng.randint(0, 3)):
        if w:
            a, p = rng.randrange(len(w)), rng.randint(1, 9)
            w = [x if i < a else w[min(len(w) - 1, a + (i - a) % p)] for i, x in enumerate(w)] + w[: rng.randint(0, 9)]
    return w


@pytest.mark.parametrize("seed", range(4))
def test_random_periodic_texts(seed):
    rng = random.Random(seed)
    for _ in range(400):
        w = periodic(rng)
        assert periodic_runs.runs_of(w) == brute(w)
        runs, kept = periodic_runs.text_runs(" \n".join(f"w{x}" for x in w).encode())
        assert runs == brute(w) and kept.decode() == collapse([f"w{x}" for x in w], runs)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40), st.integers(1, 8), st.integers(2, 5))
def test_other_limits(w, least_words, least_periods):
    assert periodic_runs.runs_of(w, least_words, least_periods) == brute(w, least_words, least_periods)


def test_automaton_and_last_ends():
    """Every access tells, for each set of strings ending here, where they ended last."""
    rng = random.Random(3)
    for _ in range(50):
        w = [rng.randrange(2) for _ in range(rng.randint(1, 25))]
        automaton = periodic_runs.SuffixAutomaton(w)
        tree = periodic_runs.LastEnds(list(automaton.links))
        for i, state in enumerate(automaton.ends):
            seen = {i - end: automaton.lengths[node] for node, end in tree.access(state, i)}
            for n in range(1, i + 2):
                earlier = [j for j in range(n - 1, i) if w[j - n + 1 : j + 1] == w[i - n + 1 : i + 1]]
                if earlier:
                    assert seen[i - max(earlier)] >= n


def test_stretches_hold_all_runs_and_leave_plain_text():
    rng = random.Random(8)
    assert periodic_runs.stretches(np.arange(1000)) == []
    line = list(range(12))
    assert periodic_runs.stretches(np.array(line + list(range(100, 150)) + line)) == []
    for _ in range(200):
        w = periodic(rng)
        parts = periodic_runs.stretches(np.array(w, dtype=np.int64))
        for start, length, _ in brute(w):
            assert any(a <= start and start + length <= b for a, b in parts)


def test_long_runs_are_found_in_moderate_time():
    w = [i % 977 for i in range(60_000)]
    assert periodic_runs.runs_of(w) == [(0, 60_000, 977)]
    assert periodic_runs.text_runs(b"x " * 100_000) == ([(0, 100_000, 1)], b"x")


def planted(doc_id, text):
    w = words(text)
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 == 0 and w:
        n, g = len(w), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    return w


def expected(doc_id, text):
    w = planted(doc_id, text)
    runs = brute(w)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id,
        len(runs),
        *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
        digest("".join(f"{s},{n},{p}\n" for s, n, p in runs)),
        digest(collapse(w, runs)),
    )


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").filter("length(text) < 9000").collect()
    got = {r["doc_id"]: tuple(r) for r in queries.op12_periodic_runs(spark, SF).collect()}
    assert len(got) == 200 and sum(r[1] > 0 for r in got.values()) > 5
    for doc_id, text in docs:
        assert got[doc_id] == expected(doc_id, text)


def test_odd_documents(spark, odd_documents, no_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    got = [(r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic_runs.find_runs(odd_documents).collect()]
    want = []
    for doc_id, text in rows:
        w = words(text)
        runs = brute(w) if len(w) < 1000 else [(0, 60_000, 977)]
        want.append((doc_id, runs, collapse(w, runs)))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert periodic_runs.find_runs(no_documents).count() == 0
    tails = queries.with_periodic_tails(odd_documents)
    assert sorted((r["doc_id"], words(r["text"])) for r in tails.collect() if r["doc_id"] is not None) == sorted(
        (i, planted(i, t)) for i, t in rows if i is not None
    )
