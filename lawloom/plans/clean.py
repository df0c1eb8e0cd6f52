"""Prepared bills and page lines to bills with clean text."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lawloom.operators.layout import attach_clean_text, clean_text


def clean(bills: DataFrame, lines: DataFrame, pages: DataFrame, remove_annex: bool = False, **rule: object) -> DataFrame:
    """Add `textoInteiroTeorLimpo` to every bill. `lines.doc_id` is the bill id."""
    return attach_clean_text(bills, clean_text(lines, pages, remove_annex, **rule))
