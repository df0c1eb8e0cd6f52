"""Raw bills and authors to prepared bills."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lawloom import rules, schemas
from lawloom.operators.prepare import (
    drop_fields,
    group_authors,
    keep_valid,
    merge_authors,
    watch_rejections,
    watched_counts,
)
from lawloom.sinks.files import remove, shared_dir, write_json
from lawloom.sources.json_root import read_root_json, read_staged_json, stage_root_json
from lawloom.sources.split_json import read_split_json


def prepare(
    bills: DataFrame,
    authors: DataFrame,
    author_order: Sequence[str],
    dropped: Iterable[str] = rules.DROPPED_FIELDS,
    **rule: object,
) -> DataFrame:
    """Filtered bills with their authors and without the dropped fields.

    Bills are filtered first, and authors to those of the bills kept, so that neither
    shuffle holds what is dropped.
    """
    return with_authors(drop_fields(keep_valid(bills, **rule), dropped), authors, author_order)


def with_authors(kept: DataFrame, authors: DataFrame, author_order: Sequence[str]) -> DataFrame:
    """Bills with their authors; the authors of other bills are left out before they are grouped."""
    wanted = kept.select(F.col("id").alias("_kept_id")).distinct()
    theirs = authors.join(wanted, F.col("idProposicao") == F.col("_kept_id"), "left_semi")
    return merge_authors(kept, group_authors(theirs, author_order))


def prepare_files(
    spark: SparkSession,
    bills_path: str,
    authors_path: str,
    output_path: str,
    bill_schema: T.StructType | None = None,
    keep_order: bool = False,
    dropped: Iterable[str] = rules.DROPPED_FIELDS,
    split: bool = False,
    **rule: object,
) -> DataFrame:
    """Read the two raw files, write the prepared bills, return (reason, n).

    Each raw file is read once. The pass that filters the bills also counts the
    reasons, and the bills it keeps wait in the shared folder for their authors. Bills
    keep all their fields but the dropped ones: without `bill_schema`, the objects are
    staged first, one to a line, and their fields are found there. `keep_order` also
    writes `src_file` and `src_pos`, the order of the input, for
    `analyse(order_by=("src_file", "src_pos"))`. With `split`, which needs the
    `bill_schema`, the tasks share the blocks of a file (see `read_split_json`).
    """
    if split and bill_schema is None:
        raise ValueError("split files are read with a bill_schema")
    folders = []

    def read(path: str, schema: T.StructType) -> DataFrame:
        if not split:
            return read_root_json(spark, path, schema)
        rows = read_split_json(spark, path, schema)
        folders.append(rows.lawloom_folder)
        return rows

    staging = f"{shared_dir(spark)}/prepare-{uuid.uuid4().hex}"
    try:
        if bill_schema is None:
            stage_root_json(spark, bills_path, f"{staging}/objects")
            bills = read_staged_json(spark, f"{staging}/objects", schemas.RAW_BILL)
        else:
            bills = read(bills_path, bill_schema)
        watched, watch = watch_rejections(bills, **rule)
        kept = drop_fields(keep_valid(watched, **rule), dropped)
        kept.write.parquet(f"{staging}/kept")
        kept = spark.read.schema(kept.schema).parquet(f"{staging}/kept")
        authors = read(authors_path, schemas.RAW_AUTHOR)
        prepared = with_authors(kept, authors, ("src_file", "src_pos"))
        write_json(prepared if keep_order else prepared.drop("src_file", "src_pos"), output_path)
        return watched_counts(spark, watch)
    finally:
        for folder in (staging, *folders):
            remove(spark, folder)
