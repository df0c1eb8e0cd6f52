"""Queries around the model: requests, calls, answers."""

from __future__ import annotations

import atexit
import contextlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawloom import operators as op
from lawloom import rules, sinks, sources
from workload import stand_ins as si

LABELED = "labeled AS (SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id))"


def labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return si.texts(spark, sf_dir).join(si.table(spark, sf_dir, "labels"), "doc_id", "left")


def fetch_for_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of the documents of good quality; the others have a null text."""
    rows = labeled(spark, sf_dir).select(
        F.col("doc_id").alias("id"), F.when(F.col("quality") == 1, F.col("text")).alias("text_summary")
    )
    return sources.texts_to_classify(rows)


def build_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = op.build_requests(si.texts(spark, sf_dir), op.topic_instructions(), id_column="doc_id")
    return requests.select(
        "id",
        F.col("messages")[0]["role"].alias("system_role"),
        F.col("messages")[0]["content"].alias("system_content"),
        F.col("messages")[1]["role"].alias("user_role"),
        F.col("messages")[1]["content"].alias("user_content"),
    )


# --- answers as JSON texts ----------------------------------------------------------------


def summary_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes around the documents' own columns; some are broken, by document."""
    docs = labeled(spark, sf_dir)
    kind = F.col("doc_id") % 10
    pairs = F.array(
        F.array(F.lit("lang"), F.col("lang")), F.array(F.lit("source"), F.col("source"), F.lit("extra"))
    )
    entities = F.when(kind == 4, F.array(F.array(F.lit("short")))).when(kind == 5, F.array().cast("array<array<string>>")).when(
        kind != 6, pairs
    )
    parsed = F.struct(
        F.col("text").alias("text_summary"),
        F.when(kind != 3, F.col("source")).alias("main_theme"),
        entities.alias("entities"),
        F.when(F.col("toxic") == 1, "negativo").when(F.col("toxic") == 0, "neutro").otherwise("unknown").alias("sentiment"),
        F.when(F.col("quality") == 1, "centro").otherwise("direita").alias("ideology"),
    )
    reasoning = F.to_json(F.struct(F.lit("reasoning").alias("type")))
    message = F.to_json(F.struct(F.array(F.struct(parsed.alias("parsed"))).alias("content")))
    outputs = F.when(kind == 2, message).otherwise(F.concat_ws(",", reasoning, message))
    text = F.concat(F.lit('{"output":['), outputs, F.lit("]}"))
    # A call that failed has no response; a cut-off one is not JSON.
    response = F.when(kind == 1, F.substring_index(text, ",", 1)).when(kind != 0, text)
    return docs.select(F.col("doc_id").alias("id"), response.alias("response"), F.when(kind == 0, "Timeout").alias("error"))


SUMMARY_ANSWERS = f"""
{LABELED},
answers AS (
  SELECT doc_id AS id, text AS text_summary, source AS main_theme, lang, source,
         CASE toxic WHEN 1 THEN 'negativo' WHEN 0 THEN 'neutro' ELSE 'unknown' END AS sentiment,
         CASE quality WHEN 1 THEN 'centro' ELSE 'direita' END AS ideology,
         doc_id % 10 >= 7 AS ok
  FROM labeled)"""


def parse_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.summary_rows(op.parse_summaries(summary_responses(spark, sf_dir)))


def parse_summary_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.parse_summaries(summary_responses(spark, sf_dir)).select("id", "ok", "label_ok")


PARSE_STATUS_SQL = f"""
WITH {SUMMARY_ANSWERS}
SELECT id, ok, id % 10 NOT IN (0, 1, 2) AND sentiment <> 'unknown' AS label_ok FROM answers"""


def entities_exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.entity_rows(op.parse_summaries(summary_responses(spark, sf_dir)))


ENTITIES_SQL = f"""
WITH {SUMMARY_ANSWERS}
SELECT id, 'lang' AS entity_type, lang AS entity FROM answers WHERE ok
UNION ALL SELECT id, 'source', source FROM answers WHERE ok"""


def parse_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("doc_id") % 6
    parsed = F.struct(F.when(kind != 3, F.concat(F.col("lang"), F.lit(": "), F.col("text"))).alias("topic"))
    envelope = F.struct(
        F.array(
            F.struct(F.lit(None).cast("array<struct<parsed:struct<topic:string>>>").alias("content")),
            F.struct(F.array(F.struct(parsed.alias("parsed"))).alias("content")),
        ).alias("output")
    )
    response = F.when(kind == 1, F.lit("not json")).when(kind == 2, F.lit('{"output": []}')).otherwise(F.to_json(envelope))
    responses = si.texts(spark, sf_dir).select(
        F.col("doc_id").alias("id"), response.alias("response"), F.when(kind == 0, "Timeout").alias("error")
    )
    return op.topic_rows(op.parse_topics(responses))


# --- calls with a deterministic model -------------------------------------------------------


def summary_model(messages: list[dict[str, str]]) -> dict:
    """Stands in for a model: labels by text length, errors for some lengths."""
    text = messages[-1]["content"].removeprefix("texto: ")
    size = len(text)
    if size % 13 == 0:
        raise RuntimeError("no answer")
    if size % 17 == 0:
        return {"output": []}
    parsed = {
        "text_summary": text,
        "main_theme": f"{size} caracteres",
        "entities": [["caracteres", str(size)], ["linhas", str(text.count("\n") + 1)]],
        "sentiment": rules.SENTIMENTS[size % 7],
        "ideology": rules.IDEOLOGIES[size % 5],
    }
    return {"output": [{}, {"content": [{"parsed": parsed}]}]}


def topic_model(messages: list[dict[str, str]]) -> str:
    text = messages[-1]["content"].removeprefix("texto: ")
    if len(text) % 11 == 0:
        raise RuntimeError("no answer")
    topic = rules.TOPICS[len(text) % len(rules.TOPICS)]
    return json.dumps({"output": [{}, {"content": [{"parsed": {"topic": topic}}]}]})


def enrich_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = op.build_requests(si.texts(spark, sf_dir), op.summary_instructions(), id_column="doc_id")
    return op.summary_rows(op.parse_summaries(op.run_model(requests, summary_model)))


def enrich_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = op.build_requests(si.texts(spark, sf_dir), op.summary_instructions(), id_column="doc_id")
    return op.entity_rows(op.parse_summaries(op.run_model(requests, summary_model)))


def enrich_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = op.build_requests(si.texts(spark, sf_dir), op.topic_instructions(), id_column="doc_id")
    return op.topic_rows(op.parse_topics(op.run_model(requests, topic_model)))


def concurrent_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics from eight calls at a time in each task, by a model that fails the first time it is asked anything."""
    requests = op.build_requests(si.texts(spark, sf_dir), op.topic_instructions(), id_column="doc_id")
    asked: set[str] = set()

    def flaky(messages: list[dict[str, str]]) -> str:
        content = messages[-1]["content"]
        if content not in asked:
            asked.add(content)
            raise TimeoutError("busy")
        return topic_model(messages)

    calls = op.Calls(threads=8, tries=2, wait=0.001)
    return op.topic_rows(op.parse_topics(op.run_model(requests, flaky, calls=calls)))


def stored_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An outage first, then a healthy model: failed ids are asked again, answered ones are not."""
    path = f"{sinks.shared_dir(spark)}/responses-{uuid.uuid4().hex}"
    atexit.register(_forget, spark, path)
    requests = op.build_requests(si.texts(spark, sf_dir), op.topic_instructions(), id_column="doc_id")

    def failing(messages: list[dict[str, str]]) -> str:
        if len(messages[-1]["content"]) % 2:
            raise TimeoutError("down")
        return topic_model(messages)

    sinks.store_responses(requests, failing, path)
    responses = sinks.store_responses(requests, topic_model, path, rounds=2)
    return op.topic_rows(op.parse_topics(responses))


def _forget(spark: SparkSession, folder: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended
        sinks.remove(spark, folder)


def _sql_list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


ANSWERED = "FROM documents WHERE length(text) % 13 <> 0 AND length(text) % 17 <> 0"
ENRICH_SUMMARY_SQL = f"""
SELECT doc_id AS id, text AS text_summary, length(text) || ' caracteres' AS main_theme,
       ({_sql_list(rules.SENTIMENTS)})[length(text) % 7 + 1] AS sentiment,
       ({_sql_list(rules.IDEOLOGIES)})[length(text) % 5 + 1] AS ideology {ANSWERED}"""
ENRICH_ENTITIES_SQL = f"""
SELECT doc_id AS id, 'caracteres' AS entity_type, CAST(length(text) AS VARCHAR) AS entity {ANSWERED}
UNION ALL SELECT doc_id, 'linhas', CAST(len(string_split(text, chr(10))) AS VARCHAR) {ANSWERED}"""
ENRICH_TOPIC_SQL = f"""
SELECT doc_id AS id, ({_sql_list(rules.TOPICS)})[length(text) % {len(rules.TOPICS)} + 1] AS topic
FROM documents WHERE length(text) % 11 <> 0"""


ENTRIES = {
    "fetch_for_classification": (
        fetch_for_classification,
        f"WITH {LABELED} SELECT doc_id AS id, CASE WHEN quality = 1 THEN text ELSE '' END AS text_summary FROM labeled",
    ),
    "build_requests": (
        build_requests,
        "SELECT doc_id AS id, 'developer' AS system_role, '"
        + op.topic_instructions()
        + "' AS system_content, 'user' AS user_role, 'texto: ' || text AS user_content FROM documents",
    ),
    "parse_summary": (
        parse_summary,
        f"WITH {SUMMARY_ANSWERS} SELECT id, text_summary, main_theme, sentiment, ideology FROM answers WHERE ok",
    ),
    "parse_summary_status": (parse_summary_status, PARSE_STATUS_SQL),
    "entities_exploded": (entities_exploded, ENTITIES_SQL),
    "parse_topic": (
        parse_topic,
        "SELECT doc_id AS id, lang || ': ' || text AS topic FROM documents WHERE doc_id % 6 IN (4, 5)",
    ),
    "enrich_summary": (enrich_summary, ENRICH_SUMMARY_SQL),
    "enrich_entities": (enrich_entities, ENRICH_ENTITIES_SQL),
    "enrich_topic": (enrich_topic, ENRICH_TOPIC_SQL),
    "stored_topics": (stored_topics, ENRICH_TOPIC_SQL),
    "concurrent_topics": (concurrent_topics, ENRICH_TOPIC_SQL),
}
