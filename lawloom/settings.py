"""Session settings that suit the operators. None is needed for right results."""

from __future__ import annotations

from pyspark.sql import SparkSession

RECOMMENDED = {
    # Rows that a join left sorted by (document, page) are joined to page texts as
    # they come, instead of through a hash table.
    "spark.sql.execution.replaceHashWithSortAgg": "true",
    # Split the partition of one huge document even where that adds a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def recommend(spark: SparkSession) -> SparkSession:
    """Set them on a session."""
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark
