"""Ordered per-key work that does not put a hot key into one task.

A window partitioned by a key sorts all rows of that key in one task. That is right while every key is small, and it
breaks when one key owns a third of the table. The helpers here look for keys with very many rows first, keep the
ordinary window for keys of normal size and range-partition the rest by (key, order), so that a hot key becomes a run of
ordered chunks. What crosses a chunk border is one small row per chunk. Both ways give the same result, so a hot key that
is missed costs time, not rows. Null is a key like any other.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqloom.session import materialize

HOT_GROUP_ROWS = "spark.seqloom.hotGroupRows"
DEFAULT_HOT_GROUP_ROWS = 5_000_000
CHUNK = "_chunk"
# hits that a hot key is expected to have in the sample of keys that is counted
HOT_HITS = 1_000
# Spark's default for the largest rank filter it applies before the exchange
RANK_LIMIT = 1_000


def hot_group_rows(spark: SparkSession) -> int:
    """Rows of one key above which the key is cut into chunks."""
    return int(spark.conf.get(HOT_GROUP_ROWS, str(DEFAULT_HOT_GROUP_ROWS)))


@dataclass(frozen=True)
class GroupSplit:
    """Rows of normal keys, and rows of hot keys with their chunk number (``None`` when there are none)."""

    cold: DataFrame | None
    hot: DataFrame | None


def split_hot_groups(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    *,
    size_from: DataFrame | None = None,
    max_rows: int | None = None,
) -> GroupSplit:
    """Separate keys with more than ``max_rows`` rows and range-partition them by ``keys + order``.

    ``size_from`` may name a cheaper frame with at least as many rows per key (for example the scan below a join
    with a unique-keyed dimension); only its key columns are read. Where it has no more than ``max_rows`` rows, nothing else
    is done. Beyond that, keys are counted over a sample in which a hot key has about ``HOT_HITS`` rows. ``keys=[]``
    treats the whole frame as one group.
    """
    limit = max_rows or hot_group_rows(df.sparkSession)
    sized = (size_from if size_from is not None else df).select(*keys)
    rows = sized.count()
    if rows <= limit:
        return GroupSplit(df, None)
    if not keys:
        cold, hot = None, df
    else:
        share = min(1.0, HOT_HITS / limit)
        seen = sized if share == 1.0 else sized.sample(share, seed=1)
        # a key counts as hot a little before its expected hits reach the limit
        least = limit if share == 1.0 else 0.8 * limit * share
        counted = seen.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
        hot_keys = materialize(counted.where(F.col("_rows") > least), "hot-keys")
        rows = hot_keys.agg(F.sum("_rows")).first()[0]
        if not rows:
            return GroupSplit(df, None)
        rows = math.ceil(rows / share)
        listed, same = _renamed(hot_keys.select(*keys), keys, df)
        cold, hot = df.join(listed, same, "left_anti"), df.join(listed, same, "left_semi")
    chunks = max(2, math.ceil(2 * rows / limit))
    # the sampled range borders differ from run to run, so the chunk number is written down before it is used twice
    ranged = hot.repartitionByRange(chunks, *keys, *order).withColumn(CHUNK, F.spark_partition_id())
    return GroupSplit(cold, materialize(ranged, "chunks"))


def _renamed(small: DataFrame, keys: list[str], df: DataFrame) -> tuple[DataFrame, Column]:
    """``small`` with its keys renamed, and the null-safe condition that joins it to ``df``."""
    names = {k: f"_of_{k}" for k in keys}
    same = [df[k].eqNullSafe(F.col(n)) for k, n in names.items()]
    return small.withColumnsRenamed(names), reduce(Column.__and__, same)


def _join_chunk_info(hot: DataFrame, info: DataFrame, keys: list[str]) -> DataFrame:
    # one row per (hot key, chunk): at most chunks + hot keys rows; Spark broadcasts it below its size limit
    keyed = [*keys, CHUNK]
    info, same = _renamed(info, keyed, hot)
    return hot.join(info, same).drop(*[f"_of_{k}" for k in keyed])


def running_counts(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    count: str,
    *,
    upto: str = "upto",
    total: str | None = "total",
    size_from: DataFrame | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """Add the running sum of ``count`` per key in ``order`` and, optionally, its sum over the key."""
    split = split_hot_groups(df, keys, order, size_from=size_from, max_rows=max_rows)
    whole = Window.partitionBy(*keys)
    running = (Window.unboundedPreceding, Window.currentRow)
    parts = []
    if split.cold is not None:
        cold = split.cold.withColumn(upto, F.sum(count).over(whole.orderBy(*order).rowsBetween(*running)))
        parts.append(cold.withColumn(total, F.sum(count).over(whole)) if total else cold)
    if split.hot is not None:
        before = whole.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        sizes = split.hot.groupBy(*keys, CHUNK).agg(F.sum(count).alias("_rows"))
        sizes = sizes.select(
            *keys,
            CHUNK,
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"),
            F.sum("_rows").over(whole).alias("_total"),
        )
        inside = Window.partitionBy(*keys, CHUNK).orderBy(*order).rowsBetween(*running)
        hot = _join_chunk_info(split.hot, sizes, keys).withColumn(upto, F.sum(count).over(inside) + F.col("_offset"))
        hot = hot.withColumn(total, F.col("_total")) if total else hot
        parts.append(hot.drop(CHUNK, "_offset", "_total"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def number_rows(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    *,
    position: str = "pos",
    total: str | None = "n",
    size_from: DataFrame | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """Add the 1-based position of each row inside its key and, optionally, the rows of the key.

    ``order`` must be unique inside a key.
    """
    ones = df.withColumn("_one", F.lit(1).cast("long"))
    counted = running_counts(
        ones, keys, order, "_one", upto=position, total=total, size_from=size_from, max_rows=max_rows
    )
    return counted.drop("_one")


def fill_forward(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    values: list[str],
    *,
    size_from: DataFrame | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """Replace each of ``values`` by its last non-null value at or before the row, per key in ``order``.

    ``order`` must be unique inside a key among the rows that hold a value, or the value carried on is any of the last.
    """
    split = split_hot_groups(df, keys, order, size_from=size_from, max_rows=max_rows)
    parts = []
    if split.cold is not None:
        upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        parts.append(split.cold.withColumns({v: F.last(v, ignorenulls=True).over(upto) for v in values}))
    if split.hot is not None:
        rank = F.struct(*order)
        # max_by skips rows whose ordering value is null, so null values never win
        closing = split.hot.groupBy(*keys, CHUNK).agg(
            *[F.max_by(v, F.when(F.col(v).isNotNull(), rank)).alias(v) for v in values]
        )
        before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        carried = closing.select(
            *keys, CHUNK, *[F.last(v, ignorenulls=True).over(before).alias(f"_carry_{v}") for v in values]
        )
        upto = (
            Window.partitionBy(*keys, CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        hot = _join_chunk_info(split.hot, carried, keys).withColumns(
            {v: F.coalesce(F.last(v, ignorenulls=True).over(upto), F.col(f"_carry_{v}")) for v in values}
        )
        parts.append(hot.drop(CHUNK, *[f"_carry_{v}" for v in values]))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def last_rows_per_key(df: DataFrame, keys: list[str], order: list[str], n: int, rank: str = "_rn") -> DataFrame:
    """The ``n`` highest rows per key by ``order``, with their rank (1 = last).

    Up to ``RANK_LIMIT``, the rank filter lets Spark cut every map task to ``n`` rows per key before the exchange, so
    a hot key sends at most ``n`` rows per task.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def first_rows_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "_rn") -> DataFrame:
    """The ``n`` lowest rows per key; ``order`` holds sort expressions."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)
