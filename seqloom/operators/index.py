"""Dense indices for sparse ids and label encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.operators.skew import hot_group_rows, number_rows
from seqloom.session import materialize

#: Ids that one task numbers; more are numbered range by range.
IDS_PER_TASK = 500_000


def dense_index(
    df: DataFrame, key: str, index: str = "item_idx", start: int = 1, *, distinct: bool = False
) -> DataFrame:
    """Distinct non-null values of ``key`` in ascending order, numbered from ``start`` without gaps.

    The distinct ids are written once, counted there and numbered from there; beyond ``IDS_PER_TASK`` they are numbered
    range by range, so no task sees all of them. ``distinct`` says that ``df`` is a written table with one row per key.
    """
    ids = df.select(key).where(F.col(key).isNotNull())
    if not distinct:
        ids = materialize(ids.distinct(), "ids")
    limit = min(IDS_PER_TASK, hot_group_rows(df.sparkSession))
    numbered = number_rows(ids, [], [key], position=index, total=None, max_rows=limit)
    return numbered if start == 1 else numbered.withColumn(index, F.col(index) + (start - 1))


def apply_index(df: DataFrame, index: DataFrame, key: str) -> DataFrame:
    """Attach the index; rows whose key has none are dropped."""
    return df.join(index, key)


def reverse_index(index: DataFrame, key: str, value: str) -> DataFrame:
    """Both directions of an id map as rows (direction, source id, mapped id)."""
    return index.select(
        F.inline(
            F.array(
                F.struct(F.lit("forward").alias("direction"), F.col(key).alias("from_id"), F.col(value).alias("to_id")),
                F.struct(F.lit("reverse").alias("direction"), F.col(value).alias("from_id"), F.col(key).alias("to_id")),
            )
        )
    )


def label_encode(df: DataFrame, column: str, code: str) -> DataFrame:
    """0-based rank of the value among the sorted distinct values; null stays null."""
    codes = dense_index(df, column, code, start=0).withColumn(code, F.col(code).cast("int"))
    return df.join(codes, column, "left")
