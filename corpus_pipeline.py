"""From raw documents to a training mix: operators of lawloom.llm in order.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of documents. Rows with null texts, null ids or equal ids go through each
stage as its operator's docstring says.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import lawloom
from lawloom.llm import decontaminate, jaccard_join, line_dedup, mixing, quality
from lawloom.llm.common import staged, table

# Python workers may not have this folder on their path.
cloudpickle.register_pickle_by_value(lawloom)


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier rejects."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return quality.score_documents(docs, model).filter("predicted = 1").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rewrite texts without the lines that other documents keep; `n_chars` follows."""
    deduplicated = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        deduplicated = deduplicated.withColumn("n_chars", F.length("text").cast("long"))
    return deduplicated.select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, 0.8), the smallest id stays.

    Documents without words are in no group, and all stay.
    """
    groups = jaccard_join.near_duplicate_components(docs, words_per_shingle=5, percent=80)
    extra = groups.filter("component_id <> doc_id").select(F.col("doc_id").alias("_extra_id")).distinct()
    return docs.join(staged(extra, "extra-copies"), F.col("doc_id") == F.col("_extra_id"), "left_anti")


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once per copy, with the number of the copy."""
    return mixing.mix_sources(docs)


STAGES = [
    ("quality classifier", keep_good_quality),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("mixing sources", mix),
]
#: A learnt classifier and a near-duplicate join are not SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written to the shared folder before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
