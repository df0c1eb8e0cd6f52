"""Words and word frequencies per document."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawloom.functions.text import tokenize


def default_stop_words(spark: SparkSession, language: str = "portuguese") -> list[str]:
    """The stop words that ship with Spark ML."""
    from pyspark.ml.feature import StopWordsRemover

    return sorted(StopWordsRemover.loadDefaultStopWords(language))


#: Bytes of text in a part: counting the words of one takes a few hundred megabytes.
TEXT_PART = 16 << 20


def text_parts(n_bytes: int | None) -> int:
    """In how many parts texts of so many bytes are counted."""
    return int(n_bytes or 0) // TEXT_PART + 1


def deal_texts(docs: DataFrame, id_column: str = "id", text_column: str = "text", parts: int | None = None) -> DataFrame:
    """The documents dealt by id to parts of about TEXT_PART bytes, however many there are.

    What a task holds then does not grow with the collection, and words counted by id
    are not shuffled again. Without `parts` the texts' bytes are summed in a pass of their
    own. For tables with a row or a few for each id: rows of one id are in one part.
    """
    if parts is None:
        parts = text_parts(docs.agg(F.sum(F.octet_length(text_column))).first()[0])
    return docs.repartition(max(parts, docs.sparkSession.sparkContext.defaultParallelism), F.col(id_column))


def explode_words(docs: DataFrame, id_column: str = "id", text_column: str = "text") -> DataFrame:
    """(id, word), one row per word occurrence."""
    words = docs.select(F.col(id_column).alias("id"), F.explode(tokenize(F.col(text_column))).alias("word"))
    return words.filter(F.col("word") != "")


def drop_stop_words(words: DataFrame, stop_words: Iterable[str] | DataFrame) -> DataFrame:
    """Remove stop words; counts of the other words are untouched.

    A list becomes a compiled set test. A DataFrame (column `word`) becomes an
    anti join, which Spark broadcasts only if its measured size allows it.
    """
    if isinstance(stop_words, DataFrame):
        return words.join(stop_words.select("word"), "word", "left_anti").select(*words.columns)
    listed = list(stop_words)
    return words.filter(~F.col("word").isin(listed)) if listed else words


def word_frequency(
    docs: DataFrame,
    stop_words: Iterable[str] | DataFrame = (),
    id_column: str = "id",
    text_column: str = "text",
) -> DataFrame:
    """(id, word, frequency) over all documents in one job.

    Counting starts before the only shuffle and its key holds the word, so an id with very
    many rows spreads over all tasks. Documents from `deal_texts` are not shuffled again.
    """
    words = drop_stop_words(explode_words(docs, id_column, text_column), stop_words)
    return words.groupBy("id", "word").agg(F.count("*").cast("int").alias("frequency"))
