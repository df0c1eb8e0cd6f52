"""Jaccard join, suffix dedup and decontamination against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lawloom.llm import decontaminate, jaccard_join, suffix_dedup
from lawloom.llm.components import connected_components
from lawloom.llm.prefix_tree import links_among, links_between
from tests.llm import brute
from tests.llm.brute import SF


def _texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


# ---- Jaccard join ----


def test_jaccard_join_on_the_table(spark):
    sets = {i: brute.shingles(t, 3) for i, t in _texts(spark).items()}
    want = {i: (len(sets[i]), c) for i, c in brute.components(sets, 90).items()}
    rows = entry.queries()["op3_ngram_jaccard_join"](spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want and len(rows) == len(want)


@pytest.mark.parametrize("percent,size,home", [(80, 2, 4), (90, 3, 8)])
def test_jaccard_join_of_many_near_copies(spark, percent, size, home):
    """Families of edited copies, larger than a home's parts, at every similarity."""
    rng = random.Random(percent)
    texts = []
    for family in range(6):
        base = [rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randint(0, 30)) for _ in range(120)]
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 9])):
                copy[rng.randrange(len(copy))] = f"x{rng.randint(0, 500)}"
            texts.append(" ".join(copy[: rng.choice([120, 120, 115, 108])]))
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    sets = {i: brute.shingles(t, size) for i, t in rows}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard_join.near_duplicate_components(docs, size, percent, home_size=home)
    assert {r.doc_id: r.component_id for r in got.collect()} == brute.components(sets, percent)


@pytest.mark.parametrize("percent", [60, 80, 90, 97])
def test_similar_sets_have_an_equal_cell(percent):
    rng = np.random.default_rng(percent)
    similar = 0
    for _ in range(600):
        one = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 150), dtype=np.uint64))
        two = one[rng.random(len(one)) > rng.uniform(0, (100 - percent) / 80)]
        two = np.union1d(two, rng.integers(0, 1 << 63, rng.integers(0, len(one) // 10 + 2), dtype=np.uint64))
        both = len(np.intersect1d(one, two))
        if 100 * both >= percent * (len(one) + len(two) - both) and both < max(len(one), len(two)):
            similar += 1
            sizes = np.array([len(one), len(two)])
            texts, cells = jaccard_join.set_cells(sizes, np.repeat([0, 1], sizes), np.concatenate((one, two)), percent)
            assert len(np.intersect1d(cells[texts == 0], cells[texts == 1]))
    assert similar > 50


def test_only_texts_that_can_have_a_link_go_on(spark, monkeypatch):
    """All texts share many shingles, but two pairs only are near copies; the copies of one text are one set."""
    rng = random.Random(11)
    texts = [[rng.choice("abcdefghijkl") for _ in range(200)] for _ in range(60)]
    texts[40], texts[41] = [*texts[3], "z"], ["z", *texts[7]]
    texts[50:60] = [texts[9]] * 10
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    read, whole_sets = [], jaccard_join.whole_sets

    def seen(docs, words_per_shingle):
        read.extend(r.doc_id for r in docs.collect())
        return whole_sets(docs, words_per_shingle)

    monkeypatch.setattr(jaccard_join, "whole_sets", seen)
    got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicate_components(docs, 3, 90).collect()}
    assert got == {i: {40: 3, 41: 7}.get(i, 9 if i >= 50 else i) for i in range(60)}
    assert sorted(read) == [3, 7, 40, 41]


def test_prefix_tree_finds_what_pairs_find():
    rng = np.random.default_rng(4)
    for _ in range(40):
        base = [np.unique(rng.integers(0, 60, rng.integers(1, 40))).astype(np.uint64) for _ in range(3)]
        sets = []
        for _ in range(25):
            own = base[rng.integers(3)]
            sets.append(np.unique(np.concatenate((own[rng.random(len(own)) > 0.05], rng.integers(0, 60, 1).astype(np.uint64)))))
        ids = np.arange(len(sets))
        as_sets = {i: set(s.tolist()) for i, s in enumerate(sets)}
        want = brute.components(as_sets, 80)
        parent = {i: i for i in ids.tolist()}

        def root(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for a, b in links_among(ids, sets, 80):
            both = len(as_sets[a] & as_sets[b])
            assert 100 * both >= 80 * len(as_sets[a] | as_sets[b])
            low, high = sorted((root(a), root(b)))
            parent[high] = low
        assert {i: root(i) for i in parent} == want
        labels = np.array([want[i] for i in ids.tolist()])
        assert links_between(ids[:12], sets[:12], labels[:12], ids[12:], sets[12:], labels[12:], 80) == []


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 240)]
    links = spark.createDataFrame([*chain, *star, (7, 7)], "a long, b long").repartition(5)
    got = {r.node: r.component for r in connected_components(links).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in [7, *range(200, 240)]}}
    assert connected_components(links.limit(0)).count() == 0


def test_jaccard_join_of_odd_documents(spark, odd_documents, no_documents):
    rows = jaccard_join.near_duplicate_components(odd_documents, 3, 90).collect()
    assert len(rows) == odd_documents.count()
    by_id = {r.doc_id: (r.n_shingles, r.component_id) for r in rows if r.doc_id is not None}
    assert by_id[1] == (0, 1) and by_id[2] == (0, 2) and by_id[3] == (0, 3)
    assert by_id[11] == (1, 11) and by_id[12] == (1, 11) and by_id[6][1] == 6
    assert all(r.component_id is None for r in rows if r.doc_id is None)
    assert jaccard_join.near_duplicate_components(no_documents, 3, 90).count() == 0


def test_rows_with_one_id_are_one_document(spark):
    rows = [(1, "a b c d"), (5, "a b c d"), (5, "e f g h"), (8, "e f g h"), (9, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in jaccard_join.near_duplicate_components(docs, 3, 90).collect()}
    assert got == {(1, 1), (5, 1), (8, 1), (9, 9)}


# ---- suffix dedup ----


def test_suffix_dedup_on_the_table(spark):
    import hashlib

    texts = sorted(_texts(spark).items())
    want = {i: (n, r, s, hashlib.sha256(k).hexdigest()) for (i, _), (n, r, s, k) in zip(texts, brute.removed(texts), strict=True)}
    rows = entry.queries()["op6_suffix_dedup"](spark, SF).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == want


@pytest.mark.parametrize("alphabet,seed", [("ab", 1), ("aé", 2), ("abcdefgh ", 3)])
def test_suffix_dedup_of_repetitive_texts(spark, alphabet, seed):
    rng = random.Random(seed)
    passages = ["".join(rng.choice(alphabet) for _ in range(n)) for n in (45, 50, 51, 80, 200)]
    texts = []
    for i in range(40):
        parts = [rng.choice(passages)[rng.randint(0, 3) :] if rng.random() < 0.6 else "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 90))) for _ in range(rng.randint(0, 5))]
        texts.append((rng.randint(0, 60), "".join(parts)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    got = suffix_dedup.remove_repeats(docs).select("doc_id", "text", "n_bytes", "n_removed", "n_spans", "kept").collect()
    wanted = dict(zip(texts, brute.removed(texts), strict=True))
    unique = {i for i, _ in texts if sum(i == j for j, _ in texts) == 1}
    for r in got:
        if r.doc_id in unique:
            assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == wanted[r.doc_id, r.text]


def test_difference_cover_sort_against_all_pairs():
    rng = np.random.default_rng(9)
    for letters in (1, 2, 4):
        text = rng.integers(97, 97 + letters, 700).astype(np.uint8)
        starts = np.sort(rng.choice(650, 300, replace=False))
        ids = rng.integers(0, 1000, 300).astype(np.uint64)
        got = suffix_dedup.lowest_ids(text, starts, ids, 50)
        raw = text.tobytes()
        for k, s in enumerate(starts):
            assert got[k] == min(i for t, i in zip(starts, ids, strict=True) if raw[t : t + 50] == raw[s : s + 50])


@pytest.mark.parametrize("length", [48, 49, 50, 51, 60, 64, 75, 97, 98, 130])
def test_suffix_order_is_the_order_of_the_prefixes(length):
    rng = np.random.default_rng(length)
    for letters in (1, 2, 3, 256):
        for repeats in (1, 3, 7):
            text = np.tile(rng.integers(0, letters, 90).astype(np.uint8), repeats + 2)
            text[rng.integers(0, len(text), repeats)] ^= 1
            starts = np.flatnonzero(rng.random(len(text) - length + 1) < rng.choice([0.3, 1.0]))
            order, new = suffix_dedup.suffix_order(text, starts, length)
            prefixes = [text[i : i + length].tobytes() for i in starts]
            sorted_ = [prefixes[i] for i in order]
            assert sorted_ == sorted(prefixes)
            assert new.tolist() == [i == 0 or sorted_[i] != sorted_[i - 1] for i in range(len(sorted_))]


def test_anchor_depends_on_the_string_alone():
    rng = np.random.default_rng(2)
    piece = rng.integers(97, 100, 50).astype(np.uint8)
    places = set()
    for before in (0, 13, 70_000):
        text = np.concatenate((rng.integers(97, 100, before).astype(np.uint8), piece, rng.integers(97, 100, 30).astype(np.uint8)))
        _, anchor = suffix_dedup.anchor_of_strings(text, 50)
        places.add(int(anchor[before]) - before)
    assert len(places) == 1


def test_suffix_dedup_of_odd_documents(spark, odd_documents, no_documents):
    rows = suffix_dedup.remove_repeats(odd_documents).collect()
    assert len(rows) == odd_documents.count() and rows[0].source is not None
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by_id[1].n_bytes == 0 and bytes(by_id[2].kept) == b""
    assert by_id[6].n_removed == 0 and by_id[7].n_removed > 50 and by_id[9].n_removed == by_id[9].n_bytes
    assert by_id[4].n_removed == 0  # its repeats are its own
    null = next(r for r in rows if r.doc_id is None and r.text)
    assert null.n_removed > 50
    assert suffix_dedup.remove_repeats(no_documents).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(no_documents, length=20)


def test_a_common_passage_is_spread_over_the_parts(spark, monkeypatch):
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    passage = word(60)
    texts = [(i, f"{word(70)}{passage}{word(70)}") for i in range(150)] + [(7, f"{passage}{word(20)}"), (7, word(90))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    largest, deal = {}, suffix_dedup.deal_stretches

    def counted(marked, length, parts):
        dealt = deal(marked, length, parts).cache()
        by_part = Counter()
        for r in dealt.select("part", "lengths").collect():
            by_part[r.part] += len(suffix_dedup.unpack(r.lengths))
        largest[suffix_dedup.HOT_ANCHOR] = max(by_part.values()) / sum(by_part.values())
        return dealt

    monkeypatch.setattr(suffix_dedup, "deal_stretches", counted)
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 1 << 9)
    kept = []
    for hot in (1 << 14, 30):
        monkeypatch.setattr(suffix_dedup, "HOT_ANCHOR", hot)
        rows = suffix_dedup.remove_repeats(docs).collect()
        kept.append(sorted((r.doc_id, r.text, r.n_removed, bytes(r.kept)) for r in rows))
    assert kept[0] == kept[1]
    wanted = dict(zip(texts, brute.removed(texts), strict=True))
    assert all((removed, raw) == (wanted[i, text][1], wanted[i, text][3]) for i, text, removed, raw in kept[1] if i != 7)
    assert largest[1 << 14] > 0.2 > 5 * largest[30] / 2


def test_rows_of_parts_hold_many_batches(spark, monkeypatch):
    """Rows are as many as dealt texts times parts: small batches are dealt together."""
    rng = random.Random(5)
    passages = ["".join(rng.choice("abcdefgh ") for _ in range(120)) for _ in range(200)]
    texts = [(i, f"{rng.choice(passages)}{i:06d}{rng.choice(passages)}") for i in range(4000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    rows, dealt = {}, {name: getattr(suffix_dedup, name) for name in ("deal_anchors", "deal_stretches")}

    def counted(name):
        def deal(*given):
            made = dealt[name](*given).cache()
            rows[name] = made.count()
            return made

        return deal

    for name in dealt:
        monkeypatch.setattr(suffix_dedup, name, counted(name))
    got = suffix_dedup.remove_repeats(docs.select("doc_id", "text")).select("doc_id", "n_removed", "kept").collect()
    wanted = {i: (removed, kept) for (i, _), (_, removed, _, kept) in zip(texts, brute.removed(texts), strict=True)}
    assert {r.doc_id: (r.n_removed, bytes(r.kept)) for r in got} == wanted
    assert rows["deal_anchors"] == 2 and rows["deal_stretches"] <= spark.sparkContext.defaultParallelism


def test_only_anchors_of_several_stretches_are_sorted(spark, monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(3)
    one, two, three = (rng.integers(97, 123, 60).astype(np.uint8) for _ in range(3))
    two[:50] = three[5:55]  # a common string, in stretches that differ
    seen, lowest_ids = [], suffix_dedup.lowest_ids

    def sort(text, starts, ids, length):
        seen.append(len(starts))
        return lowest_ids(text, starts, ids, length)

    monkeypatch.setattr(suffix_dedup, "lowest_ids", sort)
    blobs = [
        (np.array([7, 9, 9], dtype=np.uint32), np.concatenate((one, two, three)), np.array([9, 4, 6], dtype=np.uint64)),
        (np.array([7], dtype=np.uint32), one, np.array([2], dtype=np.uint64)),
    ]
    table = {"batch": ["a", "b"], "part": [0, 0]}
    for k, name in enumerate(("anchors", "texts", "lows")):
        table[name] = [suffix_dedup.pack(b[k]) for b in blobs]
    table["lengths"] = [suffix_dedup.pack(np.full(len(b[0]), 60, dtype=np.uint32)) for b in blobs]
    best = [suffix_dedup.unpack(b).tolist() for b in suffix_dedup._sort_part(50)(pa.table(table))["best"].to_pylist()]
    assert best == [[2] * 11 + [4] * 11 + [6] * 5 + [4] + [6] * 5, [2] * 11]
    assert seen == [22]


# ---- decontamination ----


def test_decontamination_on_the_table(spark):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    rows = entry.queries()["op4_benchmark_decontamination"](spark, SF).collect()
    want = brute.leaks(_texts(spark), items)
    assert {(r.doc_id, r.item_id): pytest.approx(r.similarity) for r in rows} == want


def test_decontamination_of_edited_passages(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(4))
    items = {i: " ".join(word() for _ in range(rng.choice([1, 3, 5, 20, 40, 41]))) for i in range(30)}
    docs = {}
    for d in range(120):
        passage = items[rng.randrange(30)].upper().split()
        for _ in range(rng.choice([0, 0, 1, 2])):
            passage[rng.randrange(len(passage))] = word()
        around = lambda: " ".join(word() for _ in range(rng.choice([0, 10, 60])))
        docs[d] = f"{around()} {', '.join(passage)}. {around()}"
    frame = lambda d, schema: spark.createDataFrame(list(d.items()), schema)
    got = decontaminate.find_leaks(frame(docs, "doc_id long, text string").repartition(3), frame(items, "item_id long, text string"))
    want = brute.leaks(docs, items)
    found = {(r.doc_id, r.item_id): r.similarity for r in got.collect()}
    assert found == pytest.approx(want)
    kept = decontaminate.without_leaks(frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string"))
    assert {r.doc_id for r in kept.collect()} == set(docs) - {d for d, _ in want}


def test_blocks_agree_within_the_radius(spark):
    rng = random.Random(1)
    rows = []
    for k in range(60):
        a = rng.getrandbits(128)
        b = a
        for bit in rng.sample(range(128), 32):
            b ^= 1 << bit
        signed = lambda x: x - (1 << 64) if x >> 63 else x
        rows += [(k, s, signed(v & (2**64 - 1)), signed(v >> 64)) for s, v in (("a", a), ("b", b))]
    prints = spark.createDataFrame(rows, "k int, side string, fp1 long, fp2 long")
    cut = prints.select("k", "side", decontaminate._blocks(32))
    agree = cut.filter("side = 'a'").join(cut.filter("side = 'b'").drop("side"), ["k", "block", "bits"])
    assert agree.select("k").distinct().count() == 60


def test_decontamination_of_odd_documents(spark, odd_documents, no_documents):
    items = spark.createDataFrame([(1, None), (2, ""), (None, "no id at all this very line"), (4, "one")], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(odd_documents, items).collect()}
    assert found == {(None, None), (11, 4), (12, 4)}
    assert decontaminate.find_leaks(no_documents, items).count() == 0
    assert decontaminate.find_leaks(odd_documents, items.limit(0)).count() == 0
    assert decontaminate.without_leaks(odd_documents, items).count() == odd_documents.count() - 4
    assert decontaminate.without_leaks(odd_documents, items.limit(0)).columns == odd_documents.columns
    assert F is not None
