"""Plain file outputs."""

from __future__ import annotations

import tempfile
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON Lines in UTF-8, null fields written out. Every task writes its own file."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="lawloom-")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, named by `spark.checkpoint.dir`.

    Where it is unset, a local session gets a temporary folder; on a cluster the
    setting is required, since a machine-local folder is lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_dir()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
