"""Model responses, written once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawloom.operators.calls import Calls, Model
from lawloom.operators.model import RESPONSE_SCHEMA, run_model
from lawloom.sinks.files import remove, shared_dir


def store_responses(
    requests: DataFrame,
    model: Model,
    path: str | None = None,
    max_parallel: int | None = None,
    rounds: int = 1,
    calls: Calls = Calls(),
) -> DataFrame:
    """Call the model for every request, write the responses, and return them as read back.

    Outputs made from the result never repeat a call. With a `path`, ids that have an
    answer there are skipped and failed ones asked again, so a job that was lost goes
    on where it stopped; `rounds` sets how many parts are written one after the other,
    that is, how much work a lost job can cost. `calls` says how tasks call the model
    (see `run_model`). Without a `path`, responses are in the
    shared folder, under a name of their own, until the caller removes them.
    """
    spark = requests.sparkSession
    resumable = path is not None
    folder = f"{shared_dir(spark)}/responses-{uuid.uuid4().hex}"
    path = path or folder
    if resumable:
        spark.createDataFrame([], RESPONSE_SCHEMA).write.mode("append").parquet(path)
    if rounds > 1:  # built once for all rounds
        staged = f"{folder}-requests"
        requests.write.parquet(staged)
        requests = spark.read.schema(requests.schema).parquet(staged)
    for i in range(rounds):
        part = requests
        if rounds > 1:
            part = part.filter(F.pmod(F.xxhash64("id"), F.lit(rounds)) == i)
        if resumable:
            answered = read_responses(spark, path).filter("error IS NULL").select("id")
            part = part.join(answered, "id", "left_anti")
        run_model(part, model, max_parallel, calls).write.mode("append").parquet(path)
    if rounds > 1:
        remove(spark, staged)
    return read_responses(spark, path) if resumable else spark.read.schema(RESPONSE_SCHEMA).parquet(path)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """One stored response per id: an answer if there is one, else a failure."""
    rows = spark.read.schema(RESPONSE_SCHEMA).parquet(path)
    best = F.min_by(F.struct("response", "error"), F.struct(F.col("error").isNotNull(), "response", "error"))
    return rows.groupBy("id").agg(best.alias("best")).select("id", "best.response", "best.error")
