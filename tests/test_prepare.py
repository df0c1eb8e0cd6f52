from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lawloom import operators as op
from tests.conftest import plan_of
from workload import text_queries

BILLS = "id long, siglaTipo string, dataApresentacao string"


def test_reasons_first_rule_wins(spark):
    rows = [
        (1, "PL", "2025-02-02T23:59"),
        (2, "PEC", "2025-07-17"),
        (3, "PLP", "2025-07-18"),
        (4, "PL", ""),
        (5, "PL", None),
        (6, "PL", "2025-03"),
        (7, "REQ", "abc"),
        (8, None, "2025-03-01"),
        (9, "PL", "20250301"),
        (10, "PL", "2025-02-01T10:00"),
    ]
    bills = spark.createDataFrame(rows, BILLS)
    reasons = {r.id: r.reason for r in bills.select("id", op.rejection_reason().alias("reason")).collect()}
    assert reasons == {
        1: None, 2: None, 3: "data", 4: "vazia", 5: "vazia", 6: "vazia", 7: "tipo", 8: "tipo", 9: None, 10: "data",
    }
    assert sorted(r.id for r in op.keep_valid(bills).collect()) == [1, 2, 9]
    counts = {r.reason: r.n for r in op.count_rejections(bills).collect()}
    assert counts == {"ok": 3, "data": 2, "vazia": 3, "tipo": 2} and sum(counts.values()) == len(rows)


def test_rules_are_arguments(spark):
    bills = spark.createDataFrame([(1, "X", "1999-01-01"), (2, "PL", "2025-03-01")], BILLS)
    rule = {"types": ["X"], "start": dt.date(1999, 1, 1), "end": dt.date(1999, 1, 1)}
    assert [r.id for r in op.keep_valid(bills, **rule).collect()] == [1]


def test_drop_fields_ignores_missing(spark):
    df = spark.createDataFrame([(1, "x", "y")], "id int, ultimoStatus string, other string")
    assert op.drop_fields(df).columns == ["id", "other"]


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_group_authors_keeps_order_and_duplicates(spark, partitions):
    rng = random.Random(1)
    # one bill holds a third of all rows
    rows = [(pos, rng.choice([7, rng.randint(0, 5), rng.randint(0, 5)]), rng.randint(0, 9)) for pos in range(600)]
    rows.append((600, None, 3))
    expected: dict[int, list[int]] = {}
    for _, bill, person in rows:
        if bill:
            expected.setdefault(bill, []).append(person)
    shuffled = rows[:]
    rng.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "pos int, idProposicao long, idDeputadoAutor long").selectExpr(
        "*", "cast(null as string) nomeAutor", "cast(null as string) siglaPartidoAutor", "'SP' siglaUFAutor"
    )
    grouped = op.group_authors(df.repartition(partitions), ["pos"])
    got = {r.idProposicao: [a.idDeputadoAutor for a in r.autores] for r in grouped.collect()}
    assert got == expected
    bills = spark.createDataFrame([(7,), (99,)], "id long")
    merged = {r.id: r.autores for r in op.merge_authors(bills, grouped).collect()}
    assert merged[99] == [] and len(merged[7]) == len(expected[7])
    assert merged[7][0].asDict() == {
        "idDeputadoAutor": expected[7][0], "nomeAutor": None, "siglaPartidoAutor": None, "siglaUFAutor": "SP",
    }


AUTORES = "id long, autores array<struct<idDeputadoAutor:long,nomeAutor:string,siglaPartidoAutor:string,siglaUFAutor:string>>"


def test_unique_authors_first_occurrence(spark):
    rows = [
        (2, [(1, "B", "P", "SP"), (4, "D", None, None)]),
        (1, [(0, "zero", "P", "SP"), (3, "C", "P", "RJ"), (1, "A", "Q", "MG"), (1, "A2", "Q", "MG"), (None, "n", "", "")]),
    ]
    df = spark.createDataFrame(rows, AUTORES)
    got = sorted(tuple(r) for r in op.unique_authors(df).collect())
    assert got == [(1, "A", "Q", "MG"), (3, "C", "P", "RJ"), (4, "D", None, None)]


def test_proposition_rows(spark):
    rows = [(5, [(3, "", "", ""), (1, "", "", ""), (3, "", "", ""), (None, "", "", ""), (0, "", "", ""), (2, "", "", "")]), (6, [])]
    df = spark.createDataFrame(rows, AUTORES).selectExpr(
        "*", "'u' urlInteiroTeor", "'t' descricaoTipo", "if(id = 5, '2025-03-01T10:00', 'bad') dataApresentacao"
    )
    got = {r.id: r for r in op.proposition_rows(df).collect()}
    assert got[5].authors == [3, 1, 2] and got[6].authors == []
    assert got[5].submission_date == dt.datetime(2025, 3, 1, 10, 0) and got[6].submission_date is None
    types = op.proposition_rows(df).schema
    assert [f.dataType.simpleString() for f in types] == ["int", "string", "string", "timestamp_ntz", "array<int>"]


def test_count_stages(spark):
    got = op.count_stages(a=spark.range(3), b=spark.range(5).filter(F.col("id") > 9)).collect()
    assert {r.stage: r.n for r in got} == {"a": 3, "b": 0}


def test_word_frequency(spark):
    docs = spark.createDataFrame([(1, "O gato, o rato e o Gato!"), (2, None), (3, "de de")], "id long, text string")
    got = {(r.id, r.word): r.frequency for r in op.word_frequency(docs, ["o", "e"]).collect()}
    assert got == {(1, "gato"): 2, (1, "rato"): 1, (3, "de"): 2}
    table = spark.createDataFrame([("o",), ("e",)], "word string")
    assert {(r.id, r.word): r.frequency for r in op.word_frequency(docs, table).collect()} == got
    everything = op.word_frequency(docs)
    assert everything.agg(F.sum("frequency")).first()[0] == op.explode_words(docs).count()
    assert "para" in op.default_stop_words(spark)


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_word_frequency_does_not_depend_on_partitions(spark, partitions):
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice("abcdef") for _ in range(2000 if i == 0 else 50))) for i in range(30)]
    df = spark.createDataFrame(docs, "id long, text string").repartition(partitions)
    expected = {}
    for i, text in docs:
        for w in text.split():
            expected[i, w] = expected.get((i, w), 0) + 1
    assert {(r.id, r.word): r.frequency for r in op.word_frequency(df).collect()} == expected


def test_texts_are_dealt_to_parts_of_bounded_size(spark, monkeypatch):
    """More text makes more parts, not larger ones, and the counts stay where the texts are."""
    from lawloom.operators import words

    monkeypatch.setattr(words, "TEXT_PART", 1000)
    for rows in (200, 800):
        docs = spark.range(rows).selectExpr("id", "if(id = 3, null, concat('a b a c', id % 7)) AS text")
        dealt = op.deal_texts(docs)
        size = docs.selectExpr("sum(octet_length(text))").first()[0]
        assert dealt.rdd.getNumPartitions() == max(size // 1000 + 1, spark.sparkContext.defaultParallelism)
        counts = op.word_frequency(dealt)
        assert plan_of(counts).count("Exchange") == 1
        assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, op.word_frequency(docs).collect()))


def test_the_query_counts_words_where_the_texts_are(spark):
    plan = plan_of(text_queries.word_frequency(spark, "/root/testdata/sf0.001"))
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan
