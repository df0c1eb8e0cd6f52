"""Personal data, language model, quality, mixing, licences, quality rules and line dedup."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lawloom.llm import hashing, licenses, line_dedup, mixing, ngram_lm, packing, pii, quality, quality_rules
from lawloom.llm.common import crc_fold, words
from lawloom.llm.elias_fano import EliasFano, NgramTrie
from tests.conftest import plan_of
from tests.llm import brute
from tests.llm.brute import SF
from workload.check import compare, connect


@pytest.fixture(scope="module")
def duck():
    pytest.importorskip("duckdb")
    return connect(SF)


@pytest.mark.parametrize("name", ["op7_mix_sources", "op9_quality_rules", "op10_line_dedup"])
def test_query_equals_sql(spark, duck, name):
    ok, note = compare(entry.queries()[name](spark, SF), duck, entry.oracle_sql()[name])
    assert ok, note


@pytest.mark.parametrize("name", ["op7_mix_sources", "op9_quality_rules"])
def test_native_queries_run_no_python(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    assert "InArrow" not in plan and "Python" not in plan and "Cartesian" not in plan


# ---- hashing and packing ----


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet="aAbé \t\n\x0b\x1c.", max_size=30), max_size=6))
def test_word_hashes(texts):
    import pyarrow as pa

    seen = {}
    for first, end, data, offsets in hashing.text_chunks(pa.array(texts, pa.string()), chunk_bytes=20):
        found = hashing.hash_words(data, offsets)
        for i in range(end - first):
            own = found.hashes[found.bounds[i] : found.bounds[i + 1]].tolist()
            want = brute.folded_words(texts[first + i])
            assert len(own) == len(want)
            for h, w in zip(own, want, strict=True):
                assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=50))
def test_pack_round_trip(numbers):
    values = np.array(numbers, dtype=np.uint64)
    assert (packing.unpack(packing.pack(values)) == values).all()


# ---- personal data ----


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab@.-+ (1234567890%_\n", max_size=60))
def test_base_spans_are_those_of_the_patterns(text):
    assert pii.base_spans(text) == brute.naive_spans(text)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.sampled_from(["0" * 60, "0" * 4400, "7" * 90, "1", ".", ".1.1.1", " ", "-", "+", "a", "@x.y", "at ", " dot ", "z" * 120]), max_size=5))
def test_long_runs_are_like_the_patterns(parts):
    text = "".join(parts)
    assert pii.base_spans(text) == brute.naive_spans(text)


def test_long_numbers_go_through_spark(spark):
    texts = ["0" * 5000 + ".1.1.1", "1." + "0" * 6000 + ".2.3 x", "+" + "0" * 9000, "name at " + "d" * 300 + " dot org", "w" * 400 + " 12345678901"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.find_personal_data(docs, pii.fit_field(docs)).collect()}
    assert [(s.kind, s.start, s.end) for s in found[0] if s.base] == [("ip", 0, 5006)]
    assert [(s.kind, s.start, s.end) for s in found[1] if s.base] == [("ip", 0, 6006)]
    assert not [s for s in found[2] if s.base] and len(found) == 5


def test_personal_data_on_the_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for row in entry.queries()["op1_personal_data"](spark, SF).collect():
        base = brute.naive_spans(texts[row.doc_id])
        named = [f"{k}:{s}:{e}" for k, s, e in base]
        assert row.base_sha256 == hashlib.sha256(",".join(named).encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == kind for k, _, _ in base) for kind in pii.KINDS]
        spans = row.spans.split(",") if row.spans else []
        assert not Counter(named) - Counter(spans) and len(spans) == len(named) + row.n_added
        places = [(int(s.split(":")[1]), pii.KINDS.index(s.split(":")[0])) for s in spans]
        assert places == sorted(places)


@pytest.fixture(scope="module")
def field():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("etaoinshr") for _ in range(rng.randint(1, 8)))
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def card():
        body = digits(15)
        return next(body + d for d in "0123456789" if pii.luhn(body + d))

    stretches = []
    for _ in range(400):
        kind = rng.choice(["email", "ip", "card", "phone", "none", "none"])
        datum = {
            "email": f"{word()}.{digits(2)}@{word()}.example.com", "ip": ".".join(str(rng.randint(0, 255)) for _ in range(4)),
            "card": card(), "phone": f"+1 ({digits(3)}) {digits(3)}-{digits(4)}",
            "none": rng.choice([digits(4), f"{digits(1)}.{digits(1)}", f'"{digits(20)}ab{digits(5)}"', f"{digits(2)} {word()} {digits(3)}"]),
        }[kind]
        stretches += pii.training_zones(f"{word()} {word()} {datum} {word()}. {word()}")
    return pii.train(stretches)


def test_field_adds_what_rules_miss(field):
    def added(text):
        return [(k, text[s:e]) for k, s, e, base in pii.all_spans(text, field) if not base]

    assert added("call (555) 123-4567 today") == [("phone", "(555) 123-4567")]
    assert added("write to ann at mail dot example dot com please") == [("email", "ann at mail dot example dot com")]
    assert added("nothing here, 7 of 9 at home") == [] and added("") == []


def test_program_finds_the_best_labelling(field):
    """Against all labellings of short stretches."""
    for text in ("a 555-123-4567 b", "x 1.2.3.4 y", "ann at mail dot com", "12 34 5678 90"):
        zone = (0, len(text))
        tokens, candidates = pii.segments(text, zone)
        rows = field._scores(candidates)

        def best(at, label):
            if at == len(tokens):
                return 0.0, []
            score, rest = best(at + 1, 0)
            options = [(score + field.follow[label, 0], rest)]
            for b in range(at, len(tokens)):
                for a, _, values in rows[b]:
                    if a == at:
                        for kind in range(len(pii.KINDS)):
                            score, rest = best(b + 1, kind + 1)
                            found = (pii.KINDS[kind], tokens[a][0], tokens[b][1])
                            options.append((score + values[kind] + field.follow[label, kind + 1], [found, *rest]))
            return max(options, key=lambda o: o[0])

        assert field.best(text, zone) == best(0, 0)[1]


def test_gradient_is_that_of_the_likelihood(field):
    text, gold = "a 555-123-4567 b", [(1, 5, pii.KINDS.index("phone") + 1)]
    _, candidates = pii.segments(text, (0, len(text)))
    _, follow = field.gradient(candidates, gold)

    def likelihood(model):
        rows, ahead = model._scores(candidates), {(-1, 0): 0.0}
        n = len(candidates)
        table = np.full((n + 1, len(pii.KINDS) + 1), -np.inf)
        table[0, 0] = 0
        for b in range(n):
            table[b + 1, 0] = np.logaddexp.reduce(table[b] + model.follow[:, 0])
            for a, _, values in rows[b]:
                for kind in range(len(pii.KINDS)):
                    into = np.logaddexp.reduce(table[a] + model.follow[:, kind + 1]) + values[kind]
                    table[b + 1, kind + 1] = np.logaddexp(table[b + 1, kind + 1], into)
        a, b, kind = gold[0]
        own = next(v for first, _, v in rows[b] if first == a)[kind - 1]
        path = [0] * a + [kind] + [0] * (n - b - 1)
        own += sum(model.follow[x, y] for x, y in zip([0, *path], path, strict=False))
        assert ahead
        return own - np.logaddexp.reduce(table[n])

    for place in [(0, 0), (0, 4), (4, 0)]:
        moved = pii.SemiMarkovField(field.ids, field.spans, field.follow.copy())
        moved.follow[place] += 1e-5
        assert (likelihood(moved) - likelihood(field)) / 1e-5 == pytest.approx(follow[place], abs=1e-3)


def test_zones_are_linear_and_cover_triggers():
    text = "7" * 300_000 + " " + "a" * 300_000 + "@"
    assert pii.all_spans(text, pii.SemiMarkovField()) == []
    assert pii.zones("x y 12 z 3", []) == [(2, 10)] and pii.zones("x y 12 z w 3", []) == [(2, 8), (9, 12)]
    assert pii.zones("", []) == [] and pii.zones("a 1 b", [(2, 3)]) == [(0, 2), (3, 5)]


def test_personal_data_of_odd_documents(spark, odd_documents, no_documents):
    model = pii.fit_field(odd_documents)
    rows = pii.find_personal_data(odd_documents, model).collect()
    assert len(rows) == odd_documents.count()
    spans = {r.doc_id: [(s.kind, s.base) for s in r.spans] for r in rows}
    assert spans[1] == [] and spans[10] == [("email", True)]
    assert pii.fit_field(no_documents).is_empty
    assert pii.find_personal_data(no_documents, pii.fit_field(no_documents)).count() == 0


def test_sample_keeps_clean_stretches(spark, monkeypatch):
    with_span = [(i, f"mail user{i}@host{i}.example.org now") for i in range(120)]
    clean = [(1000 + i, f"order number {7_000_000 + i} shipped") for i in range(40)]
    docs = spark.createDataFrame(with_span + clean, "doc_id long, text string")
    seen = []
    monkeypatch.setattr(pii, "train", lambda stretches: seen.append(stretches))
    pii.fit_field(docs, max_zones=50)
    kinds = Counter(bool(spans) for _, spans in seen[0])
    assert kinds == {True: 40, False: 10}


# ---- language model ----


def _bigram_scores(texts, train, strength=8.0):
    tokens = {i: [*brute.folded_words(t), None] for i, t in texts.items()}
    uni, pairs, contexts = Counter(), Counter(), Counter()
    for i, w in tokens.items():
        if train(i):
            uni.update(w)
            pairs.update(zip(["<s>", *w], w, strict=False))
            contexts.update(["<s>", *w[:-1]])
    n, v = sum(uni.values()), len(uni)
    p = lambda w: (uni[w] + 0.5) / (n + 0.5 * (v + 1))
    out = {}
    for i, w in tokens.items():
        base = sum(math.log10(p(x)) for x in w)
        score = sum(math.log10((pairs[a, b] + strength * p(b)) / (contexts[a] + strength)) for a, b in zip(["<s>", *w], w, strict=False))
        out[i] = (len(w), sum(uni[x] > 0 for x in w), n, base, score)
    return out


@pytest.mark.parametrize("part_tokens", [ngram_lm.PART_TOKENS, 2_000])
def test_language_model_against_brute_force(spark, monkeypatch, part_tokens):
    """Also with many small parts, and contexts that are dealt out."""
    monkeypatch.setattr(ngram_lm, "PART_TOKENS", part_tokens)
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(5)
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = _bigram_scores(texts, lambda i: zlib.crc32(str(i).encode()) % 5 != 1)
    rows = ngram_lm.score_documents(docs, crc_fold(F.col("doc_id"), 5) != 1).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, known, train_tokens, base, score = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, train_tokens)
        assert r.base_score == pytest.approx(base, rel=1e-9) and abs(r.score - score) <= n * ngram_lm.STEP * 1.01


def test_language_model_of_odd_documents(spark, odd_documents, no_documents):
    rows = ngram_lm.score_documents(odd_documents, F.lit(True)).collect()
    assert len(rows) == odd_documents.count() and all(r.score < 0 for r in rows)
    assert {r.doc_id: r.n_tokens for r in rows}[1] == 1 == {r.doc_id: r.n_tokens for r in rows}[3]
    untrained = ngram_lm.score_documents(odd_documents, F.lit(None).cast("boolean")).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score == pytest.approx(r.base_score, abs=0.001 * r.n_tokens) for r in untrained)
    assert ngram_lm.score_documents(no_documents, F.lit(True)).count() == 0


def test_language_model_keeps_one_staged_table(spark, tmp_path, monkeypatch):
    """Blocks and totals are deleted when the numbered blocks are written; the scores come from these."""
    from lawloom.llm import common

    monkeypatch.setattr(common, "shared_dir", lambda spark: str(tmp_path))
    docs = spark.range(40).selectExpr("id AS doc_id", "concat('a b c d', id % 7) AS text")
    scored = ngram_lm.score_documents(docs, F.lit(True))
    assert [p.name.rsplit("-", 1)[0] for p in tmp_path.glob("llm-*")] == ["llm-lm-numbered"]
    assert scored.count() == 40


def test_distributions_sum_to_one():
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 5, 50)
    p = rng.random(50)
    p /= p.sum()
    ids = np.arange(50)
    trie = ngram_lm.build_trie(np.full(50, 3), np.full(50, counts.sum()), ids, p, counts, 8.0)
    context, word = trie.find(np.full(50, 3), ids)
    assert (context == 0).all() and ((word >= 0) == (counts > 0)).all()
    codes = np.where(word >= 0, trie.codes[word].astype(int), trie.context_codes[0] + ngram_lm.quantised(p).astype(int))
    assert (10 ** (-codes * ngram_lm.STEP)).sum() == pytest.approx(1, abs=0.01)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2**40), max_size=80), st.lists(st.integers(0, 2**40), min_size=1, max_size=10))
def test_elias_fano(numbers, asked):
    values = np.array(sorted(numbers), dtype=np.uint64)
    coded = EliasFano(values, int(values[-1]) + 1 if len(values) else 1)
    assert (coded[np.arange(len(values))] == values).all()
    q = np.array(asked, dtype=np.uint64)
    zero = np.zeros(len(q), dtype=np.int64)
    if len(values):
        assert (coded.successor(zero, zero + len(values), q) == np.searchsorted(values, q)).all()


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(0, 30), st.sets(st.integers(0, 20), min_size=1), max_size=12))
def test_trie_finds_exactly_what_it_holds(lists):
    contexts = np.array(sorted(lists), dtype=np.int64)
    successors = np.array([w for c in sorted(lists) for w in sorted(lists[c])], dtype=np.int64)
    counts = np.array([len(lists[c]) for c in sorted(lists)], dtype=np.int64)
    trie = NgramTrie(contexts, counts, successors, np.arange(len(successors)), np.arange(len(contexts)))
    pairs = [(c, w) for c in range(32) for w in range(23)]
    at, found = trie.find(*(np.array(x) for x in zip(*pairs, strict=True)))
    order = {p: i for i, p in enumerate((c, w) for c in sorted(lists) for w in sorted(lists[c]))}
    assert found.tolist() == [order.get(p, -1) for p in pairs]
    assert at.tolist() == [sorted(lists).index(c) if c in lists else -1 for c, _ in pairs]


# ---- quality ----


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = entry.queries()["op5_quality_classifier"](spark, sf).join(labels, "doc_id").filter("held_out").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) > 0.9
    assert sum(s >= 0.7 for s in good) / len(good) > 0.97 and sum(s < 0.7 for s in bad) / len(bad) > 0.8


def test_risk_is_minimised_without_negatives():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(2, 1, (400, 1)), rng.normal(-2, 1, (400, 1))
    mixed = np.concatenate((rng.normal(2, 1, (600, 1)), bad))
    one = lambda x: np.hstack([np.ones_like(x), x])
    weights = quality.minimise_risk(one(good), one(mixed), 0.6)
    assert (one(good) @ weights > 0).mean() > 0.95 and (one(bad) @ weights < 0).mean() > 0.95


def test_quality_of_odd_documents(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(4, 1), (6, 1), (6, 0), (7, None), (None, 1), (9, 1)], "doc_id long, quality int")
    model = quality.fit_quality(odd_documents, labels)
    scored = quality.score_documents(odd_documents, model).collect()
    assert len(scored) == odd_documents.count() and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in scored)
    for untaught in (quality.fit_quality(odd_documents, labels.limit(0)), quality.fit_quality(no_documents, labels)):
        assert {r.score for r in quality.score_documents(odd_documents, untaught).collect()} == {0.5}
    assert quality.score_documents(no_documents, model).count() == 0


# ---- mixing ----


@settings(max_examples=25, deadline=None)
@given(st.dictionaries(st.sampled_from("abcdefgh"), st.integers(0, 1000), min_size=1))
def test_targets_share_the_excess(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(rows).collect()}
    assert got == pytest.approx(brute.targets(sizes))


def test_mix_of_odd_documents(spark, odd_documents, no_documents):
    counted = mixing.copy_counts(odd_documents).collect()
    assert len(counted) == odd_documents.count()
    sizes = Counter()
    for r in counted:
        sizes[r.source] += r.size
    want = brute.targets(dict(sizes))
    for r in counted:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert r.copies == (brute.copies(r.doc_id, r.target / r.source_size) if r.source_size else 0) and r.copies <= 2
    mixed = mixing.mix_sources(odd_documents)
    assert mixed.count() == sum(r.copies for r in counted)
    assert sorted(mixed.columns) == sorted(odd_documents.columns)
    assert sorted(map(str, mixed.collect())) == sorted(map(str, mixing.mix_sources(odd_documents.repartition(3)).collect()))
    assert mixing.mix_sources(no_documents).count() == 0


def test_mix_comes_near_its_targets(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "repeat('w ', 5 + CAST(id % 7 AS INT)) AS text", "concat('s', id % 3) AS source")
    got = mixing.copy_counts(docs).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"))
    assert all(abs(r.taken / r.target - 1) < 0.05 for r in got.collect())


# ---- licences ----


def test_licenses_and_inheritance(spark, odd_documents, no_documents):
    mit = "Copyright someone\nReleased under the MIT License.\n"
    rows = [
        (1, "Licensed under the Apache License, Version 2.0.", "p/LICENSE"),
        (2, "some text about nothing", "p/a/b/c.txt"),
        (3, mit, "p/a/LICENSE.md"),
        (4, "more text", "p/a/d.txt"),
        (5, "text", "q/e.txt"),
        (6, "text", None),
        (7, "intro\nThis work is licensed under the GNU General Public License, version 3.", "p/f.txt"),
        (8, "a license is a thing that people talk about at length in many words", "p/g.txt"),
        (9, None, "p/h.txt"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, path string")
    got = {r.doc_id: (r.license, r.origin, r.license_dir) for r in licenses.scan_licenses(docs).collect()}
    assert got == {
        1: ("Apache-2.0", "own", None), 2: ("MIT", "inherited", "p/a"), 3: ("MIT", "own", None), 4: ("MIT", "inherited", "p/a"),
        5: (None, "none", None), 6: (None, "none", None), 7: ("GPL-3.0", "own", None),
        8: ("Apache-2.0", "inherited", "p"), 9: ("Apache-2.0", "inherited", "p"),
    }
    assert licenses.scan_licenses(odd_documents, path="source").count() == odd_documents.count()
    assert licenses.scan_licenses(no_documents, path="source").count() == 0


def test_license_similarity_is_the_cosine(spark):
    texts = {1: "Released under the MIT License.", 2: "Released under some license of the MIT kind", 3: "x"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    templates = {"MIT": ("Released under the MIT License.",), "B": ("Licensed under B 1.0.",)}
    import re

    terms = lambda t: re.findall(licenses.TERM_PATTERN, t.lower())
    known = {w for texts_ in templates.values() for t in texts_ for w in terms(t)}
    df = Counter(w for t in texts.values() for w in set(terms(t)) & known)
    weight = lambda w: math.log(4 / (1 + df[w])) + 1 if w in known else 1.0

    def cosine(a, b):
        u, v = ({w: n * weight(w) for w, n in Counter(terms(t)).items()} for t in (a, b))
        return sum(u[w] * v.get(w, 0) for w in u) / math.sqrt(sum(x * x for x in u.values()) * sum(x * x for x in v.values()))

    best = {round(max(cosine(t, x) for xs in templates.values() for x in xs), 9) for t in (texts[1], texts[2])}
    assert {r.similarity for r in licenses.best_templates(docs, templates).collect()} == best


BSD_HEADER = """\
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:"""
MPL_HEADER = """\
This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""


def test_wrapped_headers_above_long_code(spark):
    import textwrap

    rng = random.Random(4)
    code = "\n".join(f"    x{rng.randrange(999)} = f{rng.randrange(99)}(y{rng.randrange(999)}, {i})" for i in range(200))
    full = {k: max(licenses.TEMPLATES[k], key=len) for k in ("MIT", "BSD-3-Clause", "Apache-2.0", "GPL-3.0")}
    texts = {"BSD-3-Clause": [BSD_HEADER], "MPL-2.0": [MPL_HEADER], None: ["with or without the conditions of use"]}
    for name, text in full.items():
        texts.setdefault(name, []).extend("\n".join(textwrap.wrap(text, width)) for width in (36, 70))
    rows, want = [], {}
    for name, headers in texts.items():
        for header in headers:
            for mark, before in (("", ""), ("# ", ""), (" * ", "#!/bin/x\n\n/*\n"), ("// ", code + "\n")):
                commented = "\n".join(mark + line for line in header.split("\n"))
                rows.append((len(rows), f"{before}{commented}\n\n{code}"))
                want[len(rows) - 1] = name
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("path", F.lit("a"))
    got = {r.doc_id: r.license if r.origin == "own" else None for r in licenses.scan_licenses(docs).collect()}
    assert got == want


def test_cues_lose_no_similar_segment():
    weights = {t: 1.0 + (i % 7) for i, t in enumerate(sorted({t for x in licenses.TEMPLATES.values() for y in x for t in licenses._terms_of(y)}))}
    for template in licenses._weighted(licenses.TEMPLATES, weights):
        found = licenses.cues(template, weights, 0.7)
        rest = math.sqrt(sum(w * w for t, w in template.weights.items() if t not in found)) / template.norm
        assert rest < 0.7 and found


# ---- rules and lines ----


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=25))
def test_repeated_window_words(spark, tokens):
    windows = Counter(tuple(tokens[i : i + 3]) for i in range(len(tokens) - 2))
    covered = {i + k for i in range(len(tokens) - 2) if windows[tuple(tokens[i : i + 3])] > 1 for k in range(3)}
    df = spark.createDataFrame([(" ".join(tokens),)], "text string")
    assert df.select(quality_rules.repeated_window_words(words(F.col("text")))).first()[0] == len(covered)


def test_frequent_lines_deplete_documents(spark):
    own = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"Menu HOME about\n{own} d{i}", "h") for i in range(8)]
    rows += [(10 + i, "menu  home ABOUT\n" * 20 + " ".join(f"x{j}" for j in range(30)), "g") for i in range(3)]
    rows += [(20 + i, f"{own}\n{own} e{i}", "k") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: (r.words_removed, r.kept) for r in quality_rules.judge_documents(docs, max_docs=5, min_share=0.7).collect()}
    assert all(got[i] == (3, True) for i in range(8))
    assert all(got[10 + i][0] == 0 for i in range(3))  # three documents of their host
    assert all(got[20 + i] == (60, False) for i in range(8))


def test_rules_of_odd_documents(spark, odd_documents, no_documents):
    rows = quality_rules.judge_documents(odd_documents, max_docs=1).collect()
    assert len(rows) == odd_documents.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by_id[1].base_failed and by_id[3].n_words == 0 and not by_id[1].kept
    assert by_id[6].words_removed == 13 == by_id[8].words_removed  # the null host has two such documents
    assert by_id[9].n_dup_lines == 1 and by_id[4].n_words == 60_000 and by_id[4].n_repeat_words == 60_000
    assert quality_rules.judge_documents(no_documents).count() == 0


def test_line_dedup_of_odd_documents(spark, odd_documents, no_documents):
    done = line_dedup.dedup_lines(odd_documents)
    rows = done.collect()
    assert len(rows) == odd_documents.count()
    by_id = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in rows if r.doc_id is not None}
    assert by_id[1] == ("", 1, 0) and by_id[6] == ("x", 2, 1) and by_id[9] == ("", 2, 2)
    assert by_id[10][0].startswith("this very line") and by_id[10][2] == 0  # the largest id keeps it
    assert sorted(r.text for r in rows if r.doc_id is None) == ["", "no id at all"]
    assert line_dedup.dedup_lines(no_documents).count() == 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a" * 40, "B" * 41, " " + "b" * 41, "short", "", "é" * 40]), max_size=6), min_size=1, max_size=12))
def test_line_dedup_against_brute_force(spark, texts):
    docs = {i: "\n".join(lines) for i, lines in enumerate(texts)}
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(frame, min_docs=3).collect()} == brute.line_dedup(docs, min_docs=3)
