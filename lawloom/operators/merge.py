"""Keyed merge of new rows into a table, as a plan over two DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import DataFrame


def new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key is not in the target, one per key. Each side is read once."""
    keys = list(keys)
    return source.dropDuplicates(keys).join(target.select(*keys), keys, "left_anti").select(*source.columns)


def merge_tables(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    mode: Literal["update", "ignore"] = "update",
) -> DataFrame:
    """`target` with `source` merged in on `keys`.

    update: a source row replaces the target row with its key.
    ignore: a source row is added only where its key is new.

    Keys must be non-null, and unique in an update source (see `check_contract`).
    For `update`, the other side of the anti join is the source's keys alone, so when
    they are few Spark broadcasts them by measured size and the target is not shuffled.
    Both modes read the target twice at most: its keys, and its rows.
    """
    keys = list(keys)
    source = source.select(*target.columns)
    if mode == "update":
        untouched = target.join(source.select(*keys), keys, "left_anti").select(*target.columns)
        return untouched.unionByName(source)
    if mode == "ignore":
        return target.unionByName(new_rows(target, source, keys))
    raise ValueError(f"unknown merge mode: {mode}")
