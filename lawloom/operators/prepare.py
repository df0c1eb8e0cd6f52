"""Bills and authors: group, merge, filter with reasons, drop fields, count."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lawloom import rules
from lawloom.functions.dates import may_be_between, parse_iso_date


def has_id(column: Column) -> Column:
    """Ids that are null or 0 count as missing."""
    return column.isNotNull() & (column != 0)


def group_authors(
    authors: DataFrame,
    order_by: Sequence[str],
    fields: Sequence[str] = rules.AUTHOR_FIELDS,
    bill_key: str = "idProposicao",
) -> DataFrame:
    """(bill_key, autores): the authors of each bill in input order, duplicates kept.

    `order_by` are the columns that hold the input order. They travel inside the
    collected rows because a shuffle keeps no order. Lists are combined before the
    shuffle, so a bill with very many author rows reaches its reducer as a few
    arrays; the array itself is the result.
    """
    entry = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)], F.struct(*fields).alias("author"))
    grouped = authors.filter(has_id(F.col(bill_key))).groupBy(bill_key).agg(F.collect_list(entry).alias("_rows"))
    return grouped.select(bill_key, F.sort_array("_rows").getField("author").alias("autores"))


def merge_authors(bills: DataFrame, grouped: DataFrame, bill_key: str = "idProposicao") -> DataFrame:
    """Attach `autores` to every bill, an empty array where there are none."""
    joined = bills.join(grouped.withColumnRenamed(bill_key, "id"), "id", "left")
    return joined.withColumn("autores", F.coalesce("autores", F.array().cast(grouped.schema["autores"].dataType)))


def rejection_reason(
    types: Iterable[str] = rules.VALID_TYPES,
    start: dt.date = rules.START_DATE,
    end: dt.date = rules.END_DATE,
    type_column: str = "siglaTipo",
    date_column: str = "dataApresentacao",
) -> Column:
    """Name of the first rule a bill fails, null when it passes all.

    'tipo' for the type, 'vazia' for a missing or unreadable date, 'data' for a
    date outside the closed interval.
    """
    type_ok = F.coalesce(F.col(type_column).isin(*types), F.lit(False))
    day = parse_iso_date(F.col(date_column))
    return (
        F.when(~type_ok, "tipo").when(day.isNull(), "vazia").when(~day.between(F.lit(start), F.lit(end)), "data")
    )


def is_valid(
    types: Iterable[str] = rules.VALID_TYPES,
    start: dt.date = rules.START_DATE,
    end: dt.date = rules.END_DATE,
    type_column: str = "siglaTipo",
    date_column: str = "dataApresentacao",
) -> Column:
    """Whether a bill passes the rules.

    The type list and the year bounds are plain comparisons that the scan takes
    over; the exact date test runs on what is left.
    """
    raw_date = F.col(date_column)
    return (
        F.col(type_column).isin(*types)
        & may_be_between(raw_date, start, end)
        & parse_iso_date(raw_date).between(F.lit(start), F.lit(end))
    )


def keep_valid(bills: DataFrame, **rule: object) -> DataFrame:
    """Bills of a valid type presented within [start, end]; the arguments are those of `is_valid`."""
    return bills.filter(is_valid(**rule))


def count_rejections(bills: DataFrame, **rule: object) -> DataFrame:
    """(reason, n) over all bills in one pass; kept bills have the reason 'ok'."""
    reason = F.coalesce(rejection_reason(**rule), F.lit("ok"))
    return bills.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


#: Every outcome of the rules: kept, and the reasons in the order in which they are tested.
REASONS = ("ok", "tipo", "vazia", "data")


def watch_rejections(bills: DataFrame, **rule: object) -> tuple[DataFrame, Observation]:
    """The bills, and their outcomes counted by the job that reads them.

    Put the result right before the filter and write that at once: in the stage that
    writes, a task that runs twice is counted once. Then see `watched_counts`.
    """
    reason = F.coalesce(rejection_reason(**rule), F.lit("ok"))
    watch = Observation()
    return bills.observe(watch, *[F.count_if(reason == r).alias(r) for r in REASONS]), watch


def watched_counts(spark: SparkSession, watch: Observation) -> DataFrame:
    """(reason, n), as `count_rejections` gives them; waits for the job that counts."""
    counts = watch.get
    return spark.createDataFrame([(r, counts[r]) for r in REASONS if counts[r]], "reason string, n long")


def drop_fields(bills: DataFrame, fields: Iterable[str] = rules.DROPPED_FIELDS) -> DataFrame:
    """Drop the fields that exist; the others are no error."""
    return bills.drop(*fields)


def count_stages(**stages: DataFrame) -> DataFrame:
    """(stage, n): one row per named DataFrame, counted on the executors."""
    counted = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("stage"), "n") for name, df in stages.items()]
    out = counted[0]
    for other in counted[1:]:
        out = out.unionByName(other)
    return out


def count_steps(rows: DataFrame, total: str, **steps: Column) -> DataFrame:
    """(stage, n): all rows under the name `total`, and those that meet each condition, in one pass."""
    counts = [F.count("*").alias(total), *[F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in steps.items()]]
    named = [F.struct(F.lit(name).alias("stage"), F.col(f"`{name}`").alias("n")) for name in (total, *steps)]
    return rows.agg(*counts).select(F.inline(F.array(*named)))
