"""Reads from the result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawloom.functions.text import blank_if_null


def texts_to_classify(summaries: DataFrame, limit: int | None = None) -> DataFrame:
    """(id, text_summary) with null texts as ''; `limit` takes any n rows, in no order."""
    rows = summaries.select(
        F.col("id").cast("bigint").alias("id"),
        blank_if_null(F.col("text_summary")).alias("text_summary"),
    )
    return rows if limit is None else rows.limit(limit)

