"""Tables that follow a stream."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from lawloom.schemas import Table
from lawloom.sinks.snapshots import upsert


def upsert_stream(
    rows: DataFrame,
    root: str,
    table: Table,
    name: str,
    checkpoint: str,
    mode: Literal["update", "ignore"] = "update",
    attempts: int = 5,
) -> DataStreamWriter:
    """A writer that merges every batch of a stream into a table; set its trigger and start it.

    A version and the number of its batch are published together, under `name`. So a
    batch that is run again after a failure, or whose end was not noted in the
    checkpoint, changes nothing. Use one name for each checkpoint: a new checkpoint
    counts its batches from 0 again. Several streams, and other writers, may share the
    table; the slower one merges again, `attempts` times at most.
    """

    def merge(batch: DataFrame, number: int) -> None:
        upsert(batch.sparkSession, root, table, batch, mode, attempts, batch=(name, number))

    return rows.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(merge)
