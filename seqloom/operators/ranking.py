"""Ranking metrics over scored candidate lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.functions.encode import metric_column

KS = (5, 10, 20)


def target_rank(scored: DataFrame, sample_key: list[str]) -> DataFrame:
    """Rank of the target: 1 + the number of candidates that score strictly higher.

    ``scored`` has one row per sample and candidate with ``score`` and ``is_target``. The target's score is spread over its
    sample by a window and the candidates above it are counted over the same partitioning, without lists. A candidate
    without a score beats nobody; a target without one comes last, behind all other candidates.
    """
    sample = Window.partitionBy(*sample_key)
    target = F.max(F.when(F.col("is_target"), F.col("score"))).over(sample)
    beats = ~F.col("is_target") & (F.col("target_score").isNull() | (F.col("score") > F.col("target_score")))
    return (
        scored.withColumn("target_score", target)
        .groupBy(*sample_key)
        .agg(F.max("target_score").alias("target_score"), (F.count_if(beats) + 1).cast("int").alias("rank"))
    )


def ranking_metrics(ranks: DataFrame, ks: tuple[int, ...] = KS) -> DataFrame:
    """Mean Hit, NDCG and MRR at each K, one row."""
    aggs = []
    for k in ks:
        hit = F.col("rank") <= k
        aggs += [
            F.avg(F.when(hit, 1.0).otherwise(0.0)).alias(f"Hit@{k}"),
            F.avg(F.when(hit, 1 / F.log2(F.col("rank") + 1)).otherwise(0.0)).alias(f"NDCG@{k}"),
            F.avg(F.when(hit, 1 / F.col("rank")).otherwise(0.0)).alias(f"MRR@{k}"),
        ]
    return ranks.agg(*aggs)


def ranking_metrics_long(metrics: DataFrame) -> DataFrame:
    """The metric row as (metric, value) rows under the names used for logging."""
    long = metrics.unpivot([], metrics.columns, "metric", "value")
    return long.withColumn("metric", metric_column(F.col("metric")))
