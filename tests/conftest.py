from __future__ import annotations

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", 4)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxMetadataStringLength", 10000)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Value of a one-column expression for each text."""

    def run(texts, expression):
        data = [(i, text) for i, text in enumerate(texts)]
        df = spark.createDataFrame(data, "i int, text string").select("i", expression(F.col("text")).alias("v"))
        return [row["v"] for row in sorted(df.collect(), key=lambda r: r["i"])]

    return run


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
