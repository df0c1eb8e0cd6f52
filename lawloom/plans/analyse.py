"""Cleaned bills to the six result tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawloom import schemas
from lawloom.operators import model as m
from lawloom.operators.calls import Calls
from lawloom.operators.changes import changed, settings_digest, with_digest
from lawloom.operators.normalize import proposition_rows, unique_authors
from lawloom.operators.words import deal_texts, default_stop_words, text_parts, word_frequency
from lawloom.sinks.files import remove, shared_dir
from lawloom.sinks.responses import store_responses
from lawloom.sinks.snapshots import create_tables, read_table, upsert
from lawloom.sources.tables import texts_to_classify


def analyse(
    bills: DataFrame,
    root: str,
    summary_model: m.Model,
    topic_model: m.Model,
    order_by: Sequence[str] = ("id",),
    stop_words: Iterable[str] | DataFrame | None = None,
    max_parallel_summaries: int | None = None,
    max_parallel_topics: int | None = None,
    responses_path: str | None = None,
    rounds: int = 1,
    text_column: str = "textoInteiroTeorLimpo",
    summary_calls: Calls = Calls(),
    topic_calls: Calls = Calls(),
    buckets: int = 16,
    changed_only: bool = False,
) -> dict[str, int]:
    """Fill the tables under `root`; returns the number of rows merged per table.

    Write the bills to Parquet first: they are read once per table here. Model
    responses are written once, and every later step reads them back. With
    `responses_path` they stay there, and a later run asks only for ids that have no
    response yet; without it they are deleted at the end. Calls use all task slots, and
    in each as many threads as `summary_calls` and `topic_calls` say, unless a
    `max_parallel` caps them; with a cap, raise `rounds` so that a single task does not
    hold too many requests. Tables that do not exist are made with so many `buckets`.

    With `changed_only`, words are counted only in texts that are not as they were, or
    were counted with other stop words; what was counted is noted in the table
    `text_digests`, after the counts. The result is that of counting all.
    """
    spark = bills.sparkSession
    kept = responses_path or f"{shared_dir(spark)}/responses-{uuid.uuid4().hex}"
    try:
        return _analyse(
            bills, root, order_by, stop_words, text_column, buckets, changed_only,
            lambda questions: store_responses(
                questions, summary_model, f"{kept}/summaries", max_parallel_summaries, rounds, summary_calls
            ),
            lambda questions: store_responses(questions, topic_model, f"{kept}/topics", max_parallel_topics, rounds, topic_calls),
        )
    finally:
        if responses_path is None:
            remove(spark, kept)


def _analyse(
    bills: DataFrame,
    root: str,
    order_by: Sequence[str],
    stop_words: Iterable[str] | DataFrame | None,
    text_column: str,
    buckets: int,
    changed_only: bool,
    ask_summaries: Callable[[DataFrame], DataFrame],
    ask_topics: Callable[[DataFrame], DataFrame],
) -> dict[str, int]:
    spark = bills.sparkSession
    create_tables(spark, root, buckets=buckets)
    if changed_only:
        create_tables(spark, root, [schemas.TEXT_DIGESTS], buckets)
    if stop_words is None:
        stop_words = default_stop_words(spark)

    merged = {
        "authors": upsert(spark, root, schemas.AUTHORS, unique_authors(bills, order_by)),
        "propositions": upsert(spark, root, schemas.PROPOSITIONS, proposition_rows(bills)),
        "proposition_word_cloud": count_words(bills, root, stop_words, text_column, changed_only),
    }

    questions = m.build_requests(bills, m.summary_instructions(), text_column=text_column)
    parsed = m.parse_summaries(ask_summaries(questions))
    merged["proposition_summary"] = upsert(spark, root, schemas.SUMMARY, m.summary_rows(parsed))
    merged["proposition_ner"] = upsert(spark, root, schemas.ENTITIES, m.entity_rows(parsed), mode="ignore")

    summaries = texts_to_classify(read_table(spark, root, schemas.SUMMARY))
    questions = m.build_requests(summaries, m.topic_instructions(), text_column="text_summary", user_prefix="proposição: ")
    topics = m.parse_topics(ask_topics(questions))
    merged["proposition_topics"] = upsert(spark, root, schemas.TOPICS, m.topic_rows(topics))
    return merged


def count_words(
    bills: DataFrame, root: str, stop_words: Iterable[str] | DataFrame, text_column: str = "text", changed_only: bool = False
) -> int:
    """Merge the word counts of the bills; returns the number of rows merged, see `analyse`.

    Give the bills as they are stored: their texts are shuffled once, by id. With
    `changed_only`, digests are compared first, and only the changed texts are shuffled.
    """
    spark = bills.sparkSession

    def merge(texts: DataFrame, n_bytes: int | None) -> int:
        parts = text_parts(n_bytes)
        dealt = deal_texts(texts.select("id", text_column), "id", text_column, parts)
        counts = word_frequency(dealt, stop_words, text_column=text_column)
        return upsert(spark, root, schemas.WORD_CLOUD, counts, parts=max(parts // 2 + 1, spark.sparkContext.defaultParallelism))

    size = F.octet_length(text_column)
    if not changed_only:
        return merge(bills, bills.agg(F.sum(size)).first()[0])
    named = with_digest(bills.select("id", text_column), text_column, settings_digest(stop_words))
    noted = f"{shared_dir(spark)}/changed-{uuid.uuid4().hex}"
    try:
        digests = named.select("id", "digest", size.alias("n_bytes"))
        changed(digests, read_table(spark, root, schemas.TEXT_DIGESTS)).write.parquet(noted)
        new = spark.read.schema(digests.schema).parquet(noted)
        n_new, n_bytes = new.agg(F.count("*"), F.sum("n_bytes")).first()
        if n_new < bills.count():  # if all texts are new, there is nothing to join
            ours = new.select(F.col("id").alias("_id"), F.col("digest").alias("_digest"))
            same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
            named = named.join(ours, same, "left_semi")
        merged = merge(named, n_bytes)
        upsert(spark, root, schemas.TEXT_DIGESTS, new.select("id", "digest"))
        return merged
    finally:
        remove(spark, noted)
