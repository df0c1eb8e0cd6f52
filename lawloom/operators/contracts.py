"""Checks that a table keeps its contract: required columns and unique keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from lawloom.schemas import Table


class ContractError(ValueError):
    """Rows break the contract of a result table."""


def contract_violations(rows: DataFrame, required: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """(check, column_name, n): null counts per required column and surplus key rows.

    One pass: nulls are summed per key before and after the shuffle on the key, so
    a key that holds a large share of all rows is a few partial sums.
    """
    nulls = [F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(required)]
    per_key = rows.groupBy(*keys).agg(F.count("*").alias("_n"), *nulls)
    totals = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("_surplus"),
        *[F.coalesce(F.sum(f"_null_{i}"), F.lit(0)).alias(f"_null_{i}") for i in range(len(required))],
    )
    checks = [
        F.struct(F.lit("rows").alias("check"), F.lit("").alias("column_name"), F.col("_rows").alias("n")),
        F.struct(
            F.lit("duplicate_key").alias("check"),
            F.lit(",".join(keys)).alias("column_name"),
            F.col("_surplus").alias("n"),
        ),
    ] + [
        F.struct(F.lit("null").alias("check"), F.lit(c).alias("column_name"), F.col(f"_null_{i}").alias("n"))
        for i, c in enumerate(required)
    ]
    return totals.select(F.inline(F.array(*checks)))


def conform(rows: DataFrame, table: Table) -> DataFrame:
    """Columns of `table` in its order and types; a value that does not fit is null."""
    return rows.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in table.schema.fields])


def check_contract(rows: DataFrame, table: Table, unique_keys: bool = True) -> int:
    """Run the check and return the number of rows; raise when the contract is broken.

    Only the counts come to the driver, one row per column of the table.
    """
    found = contract_violations(rows, _required(table), table.keys).collect()
    return _raise_if_broken(table, [tuple(r) for r in found], unique_keys)


def watch_contract(rows: DataFrame, table: Table, dealt_by: Sequence[str], unique_keys: bool = True) -> tuple[DataFrame, Observation]:
    """The rows, with an observation that the pass which writes them fills, for `watched_contract`.

    The rows come dealt by the columns `dealt_by`, which follow from the key. For unique keys
    they are sorted by these and the key where they lie, and not shuffled again. Observe in
    the stage that writes: a task that runs twice counts once there.
    """
    watch, surplus = Observation(), F.lit(False)
    if unique_keys:
        keys = [*dealt_by, *table.keys]
        rows = rows.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*keys)))
        surplus = F.col("_nth") > 1
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(_required(table))]
    return rows.observe(watch, F.count("*").alias("rows"), F.count_if(surplus).alias("surplus"), *nulls).drop("_nth"), watch


def watched_contract(watch: Observation, table: Table) -> int:
    """The number of rows that were written; raises when they broke the contract."""
    seen = watch.get
    found = [("rows", "", seen["rows"]), ("duplicate_key", ",".join(table.keys), seen["surplus"])]
    return _raise_if_broken(table, found + [("null", c, seen[f"null_{i}"]) for i, c in enumerate(_required(table))], True)


def _required(table: Table) -> list[str]:
    return [f.name for f in table.schema.fields if not f.nullable]


def _raise_if_broken(table: Table, found: Sequence[tuple[str, str, int]], unique_keys: bool) -> int:
    broken = [f"{check} {name}: {n}" for check, name, n in found if n and (check == "null" or (check == "duplicate_key" and unique_keys))]
    if broken:
        raise ContractError(f"{table.name}: " + "; ".join(broken))
    return next(n for check, _, n in found if check == "rows")
