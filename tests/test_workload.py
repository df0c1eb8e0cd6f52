"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from workload import bill_queries, model_queries, text_queries
from workload.check import compare, connect

SF = "/root/testdata/sf0.001"
NAMES = sorted({**text_queries.ENTRIES, **bill_queries.ENTRIES, **model_queries.ENTRIES})


@pytest.fixture(scope="module")
def duck():
    pytest.importorskip("duckdb")
    return connect(SF)


def test_every_query_has_sql():
    assert set(NAMES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    ok, note = compare(entry.queries()[name](spark, SF), duck, entry.oracle_sql()[name])
    assert ok, note


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["doc_id", "clean_text"] and df.count() > 0
