"""Mixing sources to target weights.

Tokens are summed per source, targets are derived from the weights, and every document
is emitted floor(rate) times plus one more time with the probability of the fraction,
where rate is its source's target over the source's tokens. The extra copy is decided by
a hash of the seed and the document's id, so reruns and retried tasks agree.

Defined results: a null text has size 0; a null source is a source of its own, ordered
last; rows with the same id share their draw; a source without tokens has target 0 and
is emitted zero times; an empty table gives an empty result; extra columns are carried.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lawloom.llm.common import broadcast_if_small, staged, word_count

#: Sources known to fit a broadcast: a name, two longs and a double each.
MAX_BROADCAST_SOURCES = 20_000


def source_targets(
    sizes: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    max_repeat: float = 2.0,
) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    The target total is `share` of all tokens, split by weight; weights go round the
    sources in code-point order. No target exceeds `max_repeat` times the source: the
    excess is shared again by weight. That fixed point is found in one pass: sources
    are taken by the level at which they fill up, and a source is full if it would be
    with all before it full. The windows run over one row per source.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    everything = Window.partitionBy()
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    levels = (
        by_source.withColumn("weight", weight)
        .withColumn("cap", F.lit(float(max_repeat)) * F.col("source_size"))
        .withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(everything))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn(
            "full",
            F.col("cap") * (F.col("all_weight") - F.col("weight_before"))
            <= F.col("weight") * (F.col("budget") - F.col("cap_before")),
        )
        .withColumn("full_cap", F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(everything))
        .withColumn("full_weight", F.sum(F.when(F.col("full"), F.col("weight")).otherwise(0.0)).over(everything))
    )
    target = F.when(F.col("full"), F.col("cap")).otherwise(
        F.col("weight") * (F.col("budget") - F.col("full_cap")) / (F.col("all_weight") - F.col("full_weight"))
    )
    return levels.select("source", "source_size", target.alias("target"))


def copy_counts(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    max_repeat: float = 2.0,
    seed: str = "mix",
    prefix: str = "",
) -> DataFrame:
    """Every document with its `size`, `source_size`, `target` and number of `copies`.

    `prefix` goes before the four new names; columns that have one of them are replaced.
    """
    sized = docs.withColumn(f"{prefix}size", word_count(F.col("text")))
    plain = sized.select("source", F.col(f"{prefix}size").alias("size"))
    targets = staged(source_targets(plain, weights, share, max_repeat), "mix-targets")
    targets = targets.select(
        F.col("source").alias("_mix_source"),
        F.col("source_size").alias("_mix_source_size"),
        F.col("target").alias("_mix_target"),
    )
    targets = broadcast_if_small(targets, MAX_BROADCAST_SOURCES)
    rate = F.when(F.col("_mix_source_size") > 0, F.col("_mix_target") / F.col("_mix_source_size")).otherwise(0.0)
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    draw = F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("double") / float(1 << 48)
    copies = (F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")).cast("long")
    return (
        sized.join(targets, F.col("source").eqNullSafe(F.col("_mix_source")), "left")
        .withColumn(f"{prefix}source_size", F.col("_mix_source_size"))
        .withColumn(f"{prefix}target", F.col("_mix_target"))
        .withColumn(f"{prefix}copies", copies)
        .drop("_mix_source", "_mix_source_size", "_mix_target")
    )


def mix_sources(docs: DataFrame, copy_column: str = "copy_no", **options) -> DataFrame:
    """The mix itself: each document once per copy, numbered from 1 in `copy_column`.

    A column of that name is replaced.
    """
    kept = [c for c in docs.columns if c.lower() != copy_column.lower()]
    counted = copy_counts(docs.select(*kept), prefix="_mix_", **options).filter(F.col("_mix_copies") > 0)
    numbers = F.sequence(F.lit(1), F.col("_mix_copies").cast("int"))
    return counted.withColumn(copy_column, F.explode(numbers)).select(*kept, copy_column)
