"""Which texts changed since they were last worked on, by their digests."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawloom.functions.text import blank_if_null


def with_digest(docs: DataFrame, text_column: str = "text", settings: Column | str = "") -> DataFrame:
    """Add `digest`, of the text (a null text counts as empty) and of the settings it is worked on with."""
    settings = F.lit(settings) if isinstance(settings, str) else settings
    return docs.withColumn("digest", F.sha2(F.concat(settings, F.lit("\x1f"), blank_if_null(F.col(text_column))), 256))


def settings_digest(words: Iterable[str] | DataFrame) -> str:
    """Name of a set of words; the order and repeats of its words do not count.

    Of a DataFrame (column `word`), one row comes to the driver.
    """
    if isinstance(words, DataFrame):
        each = words.select("word").distinct().select(F.xxhash64("word").alias("a"), F.xxhash64(F.lit("second"), "word").alias("b"))
        summed = each.agg(F.count("*").alias("n"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
        return ":".join(str(v) for v in summed.first())
    return "\x1e".join(sorted(set(words)))


def changed(docs: DataFrame, known: DataFrame, id_column: str = "id") -> DataFrame:
    """Documents (with `digest`) whose id and digest are not among the known ones.

    Only ids and digests of the known side are read.
    """
    seen = known.select(F.col("id").alias("_seen_id"), F.col("digest").alias("_seen_digest"))
    same = (F.col(id_column) == F.col("_seen_id")) & (F.col("digest") == F.col("_seen_digest"))
    return docs.join(seen, same, "left_anti")
