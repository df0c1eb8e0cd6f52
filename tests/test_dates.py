from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lawloom import functions as lf


def test_parse_iso_date(evaluate):
    day = dt.date(2025, 3, 1)
    valid = ["2025-03-01", "2025-03-01T10:00", "2025-03-01Tx", "20250301", "2025-03-01 10:00", "2025-03-01 10:00:01.5"]
    invalid = ["", None, "2025", "2025-03", "2025-3-1", " 2025-03-01", "abc", "2025-13-01", "2025-02-30", "2025-03-01 25:00", "2025-03-01 x"]
    assert evaluate(valid, lf.parse_iso_date) == [day] * len(valid)
    assert evaluate(invalid, lf.parse_iso_date) == [None] * len(invalid)


def test_year_bounds_hold_for_every_valid_form(evaluate):
    start, end = dt.date(2025, 2, 2), dt.date(2025, 7, 17)
    texts = ["2025-02-02", "20250717", "2025-07-17T00:00", "2025-02-02 10:00", "2024-12-31", "2026-01-01"]
    got = evaluate(texts, lambda c: lf.may_be_between(c, start, end))
    assert got == [True, True, True, True, False, False]


def test_parse_timestamp(evaluate):
    got = evaluate(["2025-03-01T10:20", "2025-03-01", "x", None], lf.parse_timestamp)
    assert got == [dt.datetime(2025, 3, 1, 10, 20), dt.datetime(2025, 3, 1), None, None]
    texts = ["20250301", "2025-03-01 10", "2025-03-01T10:20:30,5", "2025", "2025-03", "2025-13-01", "2025-03-01T10:20-03:00", "2025-03-01T25:00"]
    full = [dt.datetime(2025, 3, 1), dt.datetime(2025, 3, 1, 10), dt.datetime(2025, 3, 1, 10, 20, 30, 500000)]
    assert evaluate(texts, lf.parse_timestamp) == full + [None] * 5


def test_flatten(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('a', 2, 'b', named_struct('c', 'x')) AS s, array(named_struct('k', 1)) AS l")
    flat = lf.flatten(df)
    assert flat.columns == ["id", "s.a", "s.b.c", "l"]
    assert flat.select(F.col("`s.b.c`")).first()[0] == "x"
    assert lf.flatten(df, "_").columns == ["id", "s_a", "s_b_c", "l"]
