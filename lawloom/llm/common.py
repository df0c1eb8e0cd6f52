"""Expressions and helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lawloom.sinks.files import shared_dir

#: White space is exactly these six characters; everything else belongs to a word.
WHITE = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Rows of an Arrow batch of texts.
TEXTS_PER_BATCH = 500
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_or_empty(text: Column | str) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def fold_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, _UPPER, _UPPER.lower())


def words(text: Column) -> Column:
    return F.regexp_extract_all(text_or_empty(text), F.lit(WORD_PATTERN), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD_PATTERN)).cast("long")


def bind(value: Column, body) -> Column:
    """`body(value)` with the value computed once.

    An expression used inside a lambda is computed again for every element; a lambda's
    own argument is not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def crc_fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo the number of folds; a null key counts as ''."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit(""))), F.lit(folds))


def key_hashes(key: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes, so that keys of a very large corpus don't collide."""
    return F.xxhash64(key), F.xxhash64(F.lit("second"), key)


def row_key(*values: Column) -> Column:
    """Name of a row that survives recomputation; rows equal in all values have the same name."""
    return F.md5(F.concat_ws("\x1f", *[F.coalesce(v.cast("string"), F.lit("\x1e")) for v in values]))


def _delete(spark: SparkSession, path: str) -> None:
    try:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may be gone; the folder belongs to the job in any case
        pass


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, label: str, free_shuffles: bool = False) -> DataFrame:
    """Write to the shared folder and read back, so that no later failure recomputes it.

    The folder is deleted when the driver ends. free_shuffles: delete the shuffle files of
    the write as soon as it has ended, not when the collector finds them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"
    atexit.register(_delete, spark, path)
    if free_shuffles:
        before = spark.conf.get(_FREE_SHUFFLES)
        spark.conf.set(_FREE_SHUFFLES, "true")
        try:
            df.write.parquet(path)
        finally:
            spark.conf.set(_FREE_SHUFFLES, before)
    else:
        df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._staged_path = path
    return back


def forget(df: DataFrame) -> None:
    """Delete a staged table that nothing reads any more.

    The collection lets Spark's cleaner delete the shuffle files of finished jobs, too.
    """
    _delete(df.sparkSession, df._staged_path)
    df.sparkSession._jvm.System.gc()


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """A broadcast hint if the (staged) rows are at most `max_rows`, else the rows as they are."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def map_texts(docs: DataFrame, function, schema: str) -> DataFrame:
    """mapInArrow in small batches: texts can be long, and a batch is held as a whole.

    Lowers the session's limit of rows in a batch, since it counts when the result is computed.
    """
    conf, name = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= TEXTS_PER_BATCH:
        conf.set(name, TEXTS_PER_BATCH)
    return docs.mapInArrow(function, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
