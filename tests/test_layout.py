from __future__ import annotations

import time

import random
import re

import pytest
from pyspark.sql import functions as F

from lawloom import operators as op
from lawloom import plans, schemas

HEIGHT = 100.0


def frames(spark, docs, partitions=3):
    """`docs`: {doc_id: [page, ...]} with a page as a list of (y0, line)."""
    lines, pages = [], []
    for doc, doc_pages in docs.items():
        for p, page in enumerate(doc_pages):
            pages.append((doc, p, HEIGHT))
            lines += [(doc, p, HEIGHT, i, float(y), text) for i, (y, text) in enumerate(page)]
    random.Random(0).shuffle(lines)
    return (
        spark.createDataFrame(lines, schemas.LINES).repartition(partitions),
        spark.createDataFrame(pages, schemas.PAGES).repartition(partitions),
    )


def repeated(spark, docs, **kw):
    lines, pages = frames(spark, docs)
    return {(r.doc_id, r.line): (r.top_rep, r.bot_rep) for r in op.repeated_lines(lines, pages, **kw).collect()}


def starts(spark, docs):
    lines, pages = frames(spark, docs)
    return {r.doc_id: r.annex_start for r in op.annex_start(lines, pages).collect()}


def texts(spark, docs, partitions=3, **kw):
    lines, pages = frames(spark, docs, partitions)
    return {r.doc_id: r.clean_text for r in op.clean_text(lines, pages, **kw).collect()}


def test_short_documents_repeat_every_region_line(spark):
    docs = {1: [[(0, "a"), (50, "b"), (90, "c")]], 2: [[(0, "a")], [(90, "c")]]}
    assert repeated(spark, docs) == {(1, "a"): (True, False), (1, "c"): (False, True), (2, "a"): (True, False), (2, "c"): (False, True)}
    assert repeated(spark, docs, min_pages=2) == {(2, "a"): (True, False), (2, "c"): (False, True)}


def test_threshold_counts_distinct_and_empty_pages(spark):
    head = (0, "H")
    docs = {
        3: [[head, head], [], []],  # twice on one page of three: once
        4: [[head], [head], []],  # two of three
        5: [[head], [head], [], [], []],  # two of five
        6: [[head], [head], [], [], [], []],  # two of six
        7: [[], [], [], [], [head], [head]],
    }
    assert repeated(spark, docs) == {(4, "H"): (True, False), (5, "H"): (True, False)}


def test_page_numbers_count_at_the_bottom_only(spark):
    docs = {1: [[(0, "7"), (90, "8")], [(0, "7"), (90, "8")], [(0, "7"), (90, "8")]]}
    assert repeated(spark, docs) == {(1, "8"): (False, True)}


def test_regions_are_inclusive(spark):
    docs = {1: [[(15, "t"), (15.01, "x"), (84.99, "y"), (85, "b")]]}
    assert repeated(spark, docs) == {(1, "t"): (True, False), (1, "b"): (False, True)}


def test_annex_start(spark):
    title, low = [(30, "ANEXO I")], [(31, "ANEXO I")]

    def pages(n, *titled, page=title):
        return [page if p in titled else [] for p in range(n)]

    docs = {1: pages(8, 1, 5), 2: pages(8, 1), 3: pages(8, 4), 4: pages(7, 3), 5: pages(7, 2), 6: pages(1, 0), 7: pages(8, 5, page=low)}
    assert starts(spark, docs) == {1: 5, 3: 4, 4: 3, 6: 0}


def test_cut_annex(spark):
    docs = {1: [[(50, "a")], [(20, "ANEXO I"), (50, "b")], [(50, "c")]], 2: [[(50, "d")]]}
    lines, pages = frames(spark, docs)
    assert sorted(r.line for r in op.cut_annex(lines, op.annex_start(lines, pages)).collect()) == ["a", "d"]
    assert texts(spark, docs) == {1: "a\nANEXO I b\nc", 2: "d"}
    assert texts(spark, docs, remove_annex=True) == {1: "a", 2: "d"}


def test_lines_keep_their_order_and_empty_documents_are_null(spark):
    docs = {1: [[(50, f"l{i}") for i in range(12)], [(50, "z")]], 2: [[(50, "mesa")]], 3: [[]]}
    assert texts(spark, docs) == {1: " ".join(f"l{i}" for i in range(12)) + "\nz", 2: None, 3: None}


def test_own_boilerplate_rule(spark):
    docs = {1: [[(50, "mesa"), (50, "drop me")]]}
    assert texts(spark, docs, boilerplate=F.col("line").contains("drop")) == {1: "mesa"}


# --- against a plain count over the same rules ---------------------------------------


def number(line):
    return bool(re.fullmatch(r"\d{1,4}|\d{1,4}/\d{1,4}|(?i:p[áa]gina \d{1,4}( de \d{1,4})?)", line))


def brute_force(pages, remove_annex):
    n = len(pages)

    def share(region, text):
        on = sum(any(t == text and region(y) for y, t in page) for page in pages)
        return on >= 0.40 * n

    def top(y):
        return y <= HEIGHT * 0.15

    def bottom(y):
        return y >= HEIGHT * 0.85

    annexes = [p for p, page in enumerate(pages) if any(y <= 30 and t == "ANEXO I" for y, t in page)]
    end = annexes[-1] if remove_annex and annexes and annexes[-1] >= n // 2 else n
    out = []
    for page in pages[:end]:
        kept = [
            t
            for y, t in page
            if "gabinete" not in t.lower()
            and not (top(y) and not number(t) and share(top, t))
            and not (bottom(y) and share(bottom, t))
            and not (number(t) and (top(y) or bottom(y)))
        ]
        if kept:
            out.append(" ".join(kept))
    return "\n".join(out) or None


def random_docs(seed, sizes):
    rng = random.Random(seed)
    vocabulary = ["H", "F", "texto", "3", "Página 2 de 9", "1/5", "ANEXO I", "Gabinete x", "corpo", "outro"]
    return {
        doc: [[(rng.choice([0, 15, 20, 30, 50, 85, 95]), rng.choice(vocabulary)) for _ in range(rng.randint(0, 5))] for _ in range(size)]
        for doc, size in enumerate(sizes)
    }


@pytest.mark.parametrize("remove_annex", [False, True])
@pytest.mark.parametrize("partitions", [1, 5])
def test_like_brute_force(spark, partitions, remove_annex):
    docs = random_docs(partitions, [1, 1, 2, 2, 3, 3, 4, 5, 5, 6, 7, 8, 10, 12, 20] * 4)
    expected = {doc: brute_force(pages, remove_annex) for doc, pages in docs.items()}
    assert texts(spark, docs, partitions, remove_annex=remove_annex) == expected


def test_one_document_with_a_third_of_all_lines(spark):
    docs = random_docs(9, [400] + [8] * 100)
    expected = {doc: brute_force(pages, True) for doc, pages in docs.items()}
    assert texts(spark, docs, remove_annex=True) == expected


def test_explode_lines(spark):
    text = "  a ..... b \r\n\n c\x85____d　\t \n"
    blocks = spark.createDataFrame([(1, 5.0, text), (2, 6.0, "x  y")], "doc_id long, y0 double, text string")
    got = [tuple(r) for r in op.explode_lines(blocks).orderBy("doc_id", "line_in_block").collect()]
    assert got == [(1, 5.0, 0, "a b"), (1, 5.0, 2, "c"), (1, 5.0, 3, "d"), (2, 6.0, 0, "x y")]


def test_explode_lines_on_random_text(spark):
    rng = random.Random(4)
    alphabet = "ab._'… \t \n\r\x0b\x85 　"
    docs = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))) for i in range(300)]

    def normal(line):
        return re.sub(r"\s+", " ", re.sub(r"[_'.…]{3,}", " ", line)).strip()

    expected = [(i, p, normal(l)) for i, t in docs for p, l in enumerate(t.splitlines()) if normal(l)]
    blocks = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(tuple(r) for r in op.explode_lines(blocks).collect()) == expected


def test_clean_attaches_text_by_bill(spark):
    lines, pages = frames(spark, {1: [[(50, "texto")]], 2: [[(50, "outro")]], 3: [[(50, "mesa")]]})
    bills = spark.createDataFrame([(1, "u"), (2, None), (3, "u"), (4, "u"), (5, "")], "id long, urlInteiroTeor string")
    got = {r.id: r.textoInteiroTeorLimpo for r in plans.clean(bills, lines, pages).collect()}
    assert got == {1: "texto", 2: None, 3: None, 4: None, 5: None}


def test_cleaning_is_linear_in_the_lines_of_a_page(spark):
    """Every line of a long one-page document is in a region and repeats."""
    n = 160_000
    lines = spark.range(n).selectExpr(
        "1L AS doc_id", "0 AS page_no", "100.0D AS page_height", "CAST(id AS INT) AS line_no",
        "IF(id % 2 = 0, 1.0D, 50.0D) AS y0", "concat('linha ', id) AS line",
    )
    pages = spark.sql("SELECT 1L AS doc_id, 0 AS page_no, 100.0D AS page_height")
    started = time.perf_counter()
    assert op.clean_lines(lines, pages).count() == n // 2
    assert time.perf_counter() - started < 60
