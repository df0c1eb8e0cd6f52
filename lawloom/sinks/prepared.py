"""Prepared bills laid out by type and month, so that later reads open what they need only."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lawloom import rules
from lawloom.functions.dates import parse_iso_date

MONTH = "mes"


def write_prepared(
    prepared: DataFrame,
    path: str,
    type_column: str = "siglaTipo",
    date_column: str = "dataApresentacao",
    mode: str = "errorifexists",
) -> None:
    """Parquet folders by type and month of presentation (yyyy-MM).

    The rows of a folder are brought together first, so that it has few files; those of
    a large one are split over several tasks. Bills without a type or a readable date go
    to the default folder.
    """
    month = F.date_format(parse_iso_date(F.col(date_column)), "yyyy-MM")
    dealt = prepared.withColumn(MONTH, month).hint("rebalance", F.col(type_column), F.col(MONTH))
    dealt.write.mode(mode).partitionBy(type_column, MONTH).parquet(path)


def read_prepared(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    types: Iterable[str] = rules.VALID_TYPES,
    start: dt.date = rules.START_DATE,
    end: dt.date = rules.END_DATE,
    among: DataFrame | None = None,
    keys: Sequence[str] = ("id",),
    type_column: str = "siglaTipo",
    date_column: str = "dataApresentacao",
) -> DataFrame:
    """Bills of these types presented within [start, end], in the columns of `schema`.

    Types and months are tests on folder names, so other folders are not opened; the
    exact date test runs on the rest. With `among` (type, date and key columns, as
    written), only bills that it names are read, and Spark prunes the folders by the
    types and months that it holds, once it knows them.
    """
    laid_out = T.StructType([f for f in schema.fields if f.name != type_column])
    laid_out = laid_out.add(type_column, T.StringType()).add(MONTH, T.StringType())
    bills = spark.read.schema(laid_out).parquet(path)
    found = bills.filter(
        F.col(type_column).isin(*types)
        & F.col(MONTH).between(f"{start:%Y-%m}", f"{end:%Y-%m}")
        & parse_iso_date(F.col(date_column)).between(F.lit(start), F.lit(end))
    )
    if among is not None:
        month = F.date_format(parse_iso_date(F.col(date_column)), "yyyy-MM")
        named = among.select(type_column, month.alias(MONTH), *keys).distinct()
        found = found.join(named, [type_column, MONTH, *keys], "left_semi")
    return found.select(*schema.names)
