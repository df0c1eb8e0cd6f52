from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from lawloom import operators as op
from lawloom import plans, schemas, sinks

GOOD = {
    "text_summary": "s",
    "main_theme": "t",
    "entities": [["a", "b", "c"], ["d", "e"]],
    "sentiment": "neutro",
    "ideology": "centro",
}


def envelope(parsed, **kw):
    return json.dumps({"output": [{"type": "reasoning"}, {"content": [{"parsed": parsed}]}], **kw}, ensure_ascii=False)


def without(key):
    return {k: v for k, v in GOOD.items() if k != key}


def responses(spark, texts):
    return spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "id long, response string, error string")


def test_parse_summaries(spark):
    texts = [
        envelope(GOOD),
        envelope({**GOOD, "sentiment": "odd"}),
        envelope({**GOOD, "entities": [["a"]]}),
        envelope({**GOOD, "entities": [["a", "b"], ["c"]]}),
        envelope({**GOOD, "entities": []}),
        envelope({**GOOD, "entities": [None]}),
        envelope(without("entities")),
        envelope(without("main_theme")),
        envelope(None),
        json.dumps({"output": [{"content": [{"parsed": GOOD}]}]}),
        json.dumps({"output": []}),
        "{}",
        "not json",
        envelope(GOOD)[:40],
        None,
        "",
    ]
    parsed = op.parse_summaries(responses(spark, texts)).orderBy("id").collect()
    assert [r.ok for r in parsed] == [True, True] + [False] * 14
    assert [r.label_ok for r in parsed[:2]] == [True, False]
    both = op.parse_summaries(responses(spark, texts))
    assert sorted(tuple(r) for r in op.summary_rows(both).collect()) == [
        (0, "s", "t", "neutro", "centro"),
        (1, "s", "t", "odd", "centro"),
    ]
    assert sorted(tuple(r) for r in op.entity_rows(both).collect()) == [
        (0, "a", "b"), (0, "d", "e"), (1, "a", "b"), (1, "d", "e"),
    ]


def test_an_error_is_a_failure_even_with_a_response(spark):
    df = spark.createDataFrame([(1, envelope(GOOD), "Timeout")], "id long, response string, error string")
    assert op.parse_summaries(df).first().ok is False


def test_parse_topics(spark):
    texts = [envelope({"topic": "Cultura"}), envelope({"topic": "other"}), envelope({"topic": None}), envelope({}), "x", None]
    parsed = op.parse_topics(responses(spark, texts)).orderBy("id").collect()
    assert [(r.ok, r.label_ok) for r in parsed] == [(True, True), (True, False)] + [(False, False)] * 4
    assert sorted(tuple(r) for r in op.topic_rows(op.parse_topics(responses(spark, texts))).collect()) == [(0, "Cultura"), (1, "other")]


def test_build_requests(spark):
    docs = spark.createDataFrame([(1, "texto"), (2, None)], "id long, text string")
    got = {r.id: [(m.role, m.content) for m in r.messages] for r in op.build_requests(docs, "faça").collect()}
    assert got == {
        1: [("developer", "faça"), ("user", "texto: texto")],
        2: [("developer", "faça"), ("user", "texto: ")],
    }
    assert "extremamente-negativo" in op.summary_instructions() and "Urbanismo" in op.topic_instructions()


def test_run_model_isolates_failures_and_keeps_ids(spark):
    def model(messages):
        text = messages[-1]["content"]
        if text.endswith("3"):
            raise ValueError("três")
        return {"echo": text} if text.endswith("4") else text

    docs = spark.range(0, 700, 1, 3).select("id", F.col("id").cast("string").alias("text"))
    requests = op.build_requests(docs, "x", user_prefix="")
    got = op.run_model(requests, model, max_parallel=2)
    assert got.rdd.getNumPartitions() == 2
    rows = {r.id: (r.response, r.error) for r in got.collect()}
    assert len(rows) == 700 and rows[12] == ("12", None) and rows[13] == (None, "ValueError: três")
    assert json.loads(rows[14][0]) == {"echo": "14"}


def test_stored_responses_are_computed_once_and_resumed(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def model(messages):
        text = messages[-1]["content"]
        with open(f"{calls}/{text}", "a") as f:
            f.write("x")
        return text

    def requests(n):
        return op.build_requests(spark.range(n).select("id", F.col("id").cast("string").alias("text")), "x", user_prefix="")

    path = str(tmp_path / "responses")
    assert sinks.store_responses(requests(10), model, path).count() == 10
    stored = sinks.store_responses(requests(25), model, path, rounds=3)
    assert sorted(r.id for r in stored.collect()) == list(range(25))
    stored.count()
    assert all(p.read_text() == "x" for p in calls.iterdir()) and len(list(calls.iterdir())) == 25


def test_failed_ids_are_asked_again(spark, tmp_path):
    requests = op.build_requests(spark.range(6).select("id", F.col("id").cast("string").alias("text")), "x", user_prefix="")
    path = str(tmp_path / "responses")
    asked = tmp_path / "asked"
    asked.mkdir()

    def outage(messages):
        if int(messages[-1]["content"]) < 3:
            raise TimeoutError("down")
        return "early"

    def healthy(messages):
        (asked / messages[-1]["content"]).touch()
        return "late"

    first = {r.id: r.error for r in sinks.store_responses(requests, outage, path).collect()}
    assert sorted(i for i, e in first.items() if e) == [0, 1, 2]
    again = {r.id: (r.response, r.error) for r in sinks.store_responses(requests, healthy, path, rounds=2).collect()}
    assert again == {i: ("late" if i < 3 else "early", None) for i in range(6)}
    assert sorted(p.name for p in asked.iterdir()) == ["0", "1", "2"]


def test_analyse_end_to_end(spark, tmp_path):
    author = "array(named_struct('idDeputadoAutor', {}L, 'nomeAutor', '{}', 'siglaPartidoAutor', 'P', 'siglaUFAutor', 'SP'))"
    bills = spark.sql(
        "SELECT id, 'PL' descricaoTipo, '2025-03-01T10:00' dataApresentacao, concat('u', id) urlInteiroTeor, text"
        f" textoInteiroTeorLimpo, if(id = 1, {author.format(7, 'A')}, {author.format(7, 'B')}) autores"
        " FROM VALUES (1, 'a lei lei nova'), (2, 'falha'), (3, CAST(NULL AS STRING)) t(id, text)"
    )

    def summary_model(messages):
        if "falha" in messages[-1]["content"]:
            raise RuntimeError
        return envelope({**GOOD, "text_summary": messages[-1]["content"]})

    def topic_model(messages):
        return envelope({"topic": "Cultura" if "lei" in messages[-1]["content"] else None})

    def no_more_calls(messages):
        raise AssertionError("asked twice")

    root, responses = str(tmp_path / "db"), str(tmp_path / "responses")
    for models in ((summary_model, topic_model), (no_more_calls, no_more_calls)):
        merged = plans.analyse(bills, root, *models, max_parallel_topics=2, responses_path=responses, rounds=2)
        assert merged == {
            "authors": 1,
            "propositions": 3,
            "proposition_word_cloud": 3,
            "proposition_summary": 2,
            "proposition_ner": 4,
            "proposition_topics": 1,
        }

    def table(t):
        return sorted(tuple(r) for r in sinks.read_table(spark, root, t).collect())

    assert table(schemas.AUTHORS) == [(7, "A", "P", "SP")]
    assert [(r[0], r[4]) for r in table(schemas.PROPOSITIONS)] == [(1, [7]), (2, [7]), (3, [7])]
    assert table(schemas.WORD_CLOUD) == [(1, "lei", 2), (1, "nova", 1), (2, "falha", 1)]
    assert [r[:2] for r in table(schemas.SUMMARY)] == [(1, "texto: a lei lei nova"), (3, "texto: ")]
    assert len(table(schemas.ENTITIES)) == 4
    assert table(schemas.TOPICS) == [(1, "Cultura")]


@pytest.mark.parametrize("max_parallel", [None, 3])
def test_a_model_may_return_nothing_useful(spark, max_parallel):
    requests = op.build_requests(spark.range(5).select("id", F.lit("t").alias("text")), "x")
    parsed = op.parse_summaries(op.run_model(requests, lambda messages: None, max_parallel))
    assert [r.ok for r in parsed.collect()] == [False] * 5
