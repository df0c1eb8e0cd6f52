"""Questions to a user-supplied model, its answers, and the rows made from them.

The model is any callable that takes a list of {'role', 'content'} messages and
returns the answer envelope as JSON text or as a dict. Calling it is the only place
where Python runs on the data.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lawloom import rules, schemas
from lawloom.functions.text import blank_if_null
from lawloom.operators.calls import Calls, Model, ask_all

RESPONSE_SCHEMA = "id BIGINT, response STRING, error STRING"
#: A batch of responses is handed on when it has so many rows, or so many characters.
_ROWS_PER_BATCH, _CHARS_PER_BATCH = 256, 1 << 22
_ARROW_RESPONSE = pa.schema([("id", pa.int64()), ("response", pa.string()), ("error", pa.string())])


# --- requests ---------------------------------------------------------------


def summary_instructions(
    sentiments: Iterable[str] = rules.SENTIMENTS,
    ideologies: Iterable[str] = rules.IDEOLOGIES,
    theme_words: int = rules.THEME_MAX_WORDS,
    summary_words: int = rules.SUMMARY_MAX_WORDS,
) -> str:
    """Default system text for the summary question; callers may pass their own."""
    return (
        "Analise o texto legislativo a seguir e responda em JSON.\n"
        f"text_summary: resumo com até {summary_words} palavras.\n"
        f"main_theme: tema principal com até {theme_words} palavras.\n"
        "entities: lista de pares [tipo, valor] das entidades citadas.\n"
        f"sentiment: um destes valores: {', '.join(sentiments)}.\n"
        f"ideology: um destes valores: {', '.join(ideologies)}."
    )


def topic_instructions(topics: Iterable[str] = rules.TOPICS) -> str:
    """Default system text for the topic question."""
    return "Escolha exatamente um tema para a proposição e responda em JSON.\ntopic: um destes valores: " + "; ".join(topics)


def build_requests(
    docs: DataFrame,
    instructions: str,
    id_column: str = "id",
    text_column: str = "text",
    user_prefix: str = "texto: ",
    system_role: str = "developer",
) -> DataFrame:
    """(id, messages): one request per document; the id travels with the row."""

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return docs.select(
        F.col(id_column).cast("bigint").alias("id"),
        F.array(
            message(system_role, F.lit(instructions)),
            message("user", F.concat(F.lit(user_prefix), blank_if_null(F.col(text_column)))),
        ).alias("messages"),
    )


# --- model calls ------------------------------------------------------------


def run_model(requests: DataFrame, model: Model, max_parallel: int | None = None, calls: Calls = Calls()) -> DataFrame:
    """(id, response, error): the model's answer to every request.

    Calls run in the tasks of the stage, `calls.threads` at a time in each; `calls` also
    says how often a failed one is tried. `max_parallel` caps the calls at a time of the
    whole job: the requests are spread over so many tasks that tasks times threads stay
    below it (a cap under the number of threads lowers that).

    Spark may run a task again, so write the result once before it feeds more than
    one output (`lawloom.sinks.store_responses`).
    """
    if max_parallel is not None:
        calls = replace(calls, threads=min(calls.threads, max_parallel))
        requests = requests.repartition(calls.tasks(max_parallel))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict[str, str]]]]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield batch.column(0)[i].as_py(), batch.column(1)[i].as_py()

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, chars = [], 0
        for key, response, error in ask_all(model, rows(batches), calls):
            held.append({"id": key, "response": response, "error": error})
            chars += len(response or "")
            if len(held) >= _ROWS_PER_BATCH or chars >= _CHARS_PER_BATCH:
                yield pa.RecordBatch.from_pylist(held, schema=_ARROW_RESPONSE)
                held, chars = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=_ARROW_RESPONSE)

    return requests.select("id", "messages").mapInArrow(call, RESPONSE_SCHEMA)


# --- answers ----------------------------------------------------------------


def _parsed(response: Column, answer: T.StructType) -> Column:
    """The `parsed` object at output[1].content[0]; null when any step is missing."""
    content = T.StructType().add("content", T.ArrayType(T.StructType().add("parsed", answer)))
    envelope = T.StructType().add("output", T.ArrayType(content))
    opened = F.from_json(response, envelope)
    return F.get(F.get(opened["output"], F.lit(1))["content"], F.lit(0))["parsed"]


def _no_error(responses: DataFrame) -> Column:
    return F.col("error").isNull() if "error" in responses.columns else F.lit(True)


def _parsed_once(responses: DataFrame, answer: T.StructType) -> DataFrame:
    """(id, _called, p): the explode keeps later filters from repeating the parse."""
    opened = F.explode(F.array(_parsed(F.col("response"), answer)))
    return responses.select("id", _no_error(responses).alias("_called"), opened.alias("p"))


def parse_summaries(
    responses: DataFrame,
    sentiments: Iterable[str] = rules.SENTIMENTS,
    ideologies: Iterable[str] = rules.IDEOLOGIES,
) -> DataFrame:
    """One row per response: `ok`, the five answer fields and `label_ok`.

    `ok` is false for a failed call, an answer that is not the expected JSON, a
    missing field, no entities, or an entity that is not a (type, value) pair.
    `label_ok` tells whether both labels are known ones; it filters nothing.
    """
    parsed = _parsed_once(responses, schemas.SUMMARY_ANSWER)

    def is_pair(e: Column) -> Column:
        return F.get(e, F.lit(0)).isNotNull() & F.get(e, F.lit(1)).isNotNull()

    complete = F.lit(True)
    for field in schemas.SUMMARY_ANSWER.fieldNames():
        complete = complete & F.col("p")[field].isNotNull()
    ok = F.col("_called") & complete & (F.size("p.entities") > 0) & F.forall("p.entities", is_pair)
    labels = F.col("p.sentiment").isin(*sentiments) & F.col("p.ideology").isin(*ideologies)
    return parsed.select(
        "id",
        F.coalesce(ok, F.lit(False)).alias("ok"),
        "p.text_summary",
        "p.main_theme",
        "p.entities",
        "p.sentiment",
        "p.ideology",
        F.coalesce(labels, F.lit(False)).alias("label_ok"),
    )


def summary_rows(parsed: DataFrame) -> DataFrame:
    """Rows of the summary table, of successful answers only."""
    return parsed.filter("ok").select("id", "text_summary", "main_theme", "sentiment", "ideology")


def entity_rows(parsed: DataFrame) -> DataFrame:
    """(id, entity_type, entity), one row per pair; elements after the second are ignored."""
    pairs = parsed.filter("ok").select("id", F.explode("entities").alias("e"))
    return pairs.select("id", F.get("e", F.lit(0)).alias("entity_type"), F.get("e", F.lit(1)).alias("entity"))


def parse_topics(responses: DataFrame, topics: Iterable[str] = rules.TOPICS) -> DataFrame:
    """(id, ok, topic, label_ok); a null topic counts as failed."""
    parsed = _parsed_once(responses, schemas.TOPIC_ANSWER).select("id", "_called", F.col("p.topic").alias("topic"))
    return parsed.select(
        "id",
        (F.col("_called") & F.col("topic").isNotNull()).alias("ok"),
        "topic",
        F.coalesce(F.col("topic").isin(*topics), F.lit(False)).alias("label_ok"),
    )


def topic_rows(parsed: DataFrame) -> DataFrame:
    """Rows of the topics table, of successful answers only."""
    return parsed.filter("ok").select("id", "topic")
