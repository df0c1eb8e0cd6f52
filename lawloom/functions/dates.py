"""Strict ISO dates: what is not a full calendar date gives null, never an error."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_DASHED = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
_COMPACT = r"^[0-9]{8}\z"
_CLOCK = r"(?:[01][0-9]|2[0-3])(?::[0-5][0-9](?::[0-5][0-9](?:[.,][0-9]+)?)?)?"
_TIMESTAMP = rf"^(?:[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{8}})(?:[T ]{_CLOCK})?\z"
_DASHED_CLOCK = rf"^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} {_CLOCK}\z"


def parse_iso_date(text: Column) -> Column:
    """Date of an ISO string; whatever follows a ``T`` is ignored."""
    day = F.substring_index(text, "T", 1)
    return (
        F.when(day.rlike(_DASHED), F.try_to_date(day, "yyyy-MM-dd"))
        .when(day.rlike(_COMPACT), F.try_to_date(day, "yyyyMMdd"))
        .when(day.rlike(_DASHED_CLOCK), F.try_to_date(F.substring(day, 1, 10), "yyyy-MM-dd"))
    )


def may_be_between(text: Column, start: dt.date, end: dt.date) -> Column:
    """Necessary condition on the raw string, by year: a scan can push it down.

    Every accepted form starts with a four-digit year, so no valid date between
    `start` and `end` fails this test.
    """
    not_before = text >= f"{start.year:04d}"
    return not_before if end.year == dt.MAXYEAR else not_before & (text < f"{end.year + 1:04d}")


def parse_timestamp(text: Column) -> Column:
    """ISO string to a timestamp without time zone, null when it is not one.

    The dates that `parse_iso_date` takes, alone or with a clock after ``T`` or a
    space. An offset, a month or year alone, or any other text gives null.
    """
    dashed = F.regexp_replace(text, r"^([0-9]{4})([0-9]{2})([0-9]{2})", "$1-$2-$3")
    clock = F.regexp_replace(F.replace(dashed, F.lit(","), F.lit(".")), r"([T ][0-9]{2})\z", "$1:00")
    return F.when(text.rlike(_TIMESTAMP), clock.try_cast("timestamp_ntz"))
