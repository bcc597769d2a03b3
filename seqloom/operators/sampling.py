"""Repeatable sampling: negatives, splits, subsets and shuffled exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.functions.hashing import seeded_hash
from seqloom.operators.skew import fill_forward, number_rows

NUM_NEGATIVES = 99


def negative_candidates(
    samples: DataFrame, num_items: Column, *, negatives: int = NUM_NEGATIVES, seed: int = 42
) -> DataFrame:
    """Candidate lists ``[target] + negatives`` drawn with replacement from the items 1..num_items.

    Items of the sample's history and its target are not eligible. A draw picks the r-th eligible item directly:
    with the excluded items sorted, r moves up by one for each excluded item at or below it. Every draw therefore
    counts, and the list is short (empty) only when nothing is eligible. The draw is a hash of (seed, user, split
    position, draw number), so it does not depend on the partitioning.
    """
    excluded = F.array_sort(F.array_distinct(F.concat("item_seq", F.array("target"))))
    with_items = samples.withColumn("_ex", excluded).withColumn("_left", num_items - F.size("_ex"))

    def draw(i: Column) -> Column:
        r = F.lit(1) + F.pmod(seeded_hash(seed, F.col("user_id"), F.col("from_end"), i), F.col("_left"))
        return F.aggregate("_ex", r, lambda x, e: F.when(e <= x, x + 1).otherwise(x))

    drawn = F.when(F.col("_left") > 0, F.transform(F.sequence(F.lit(1), F.lit(negatives)), draw)).otherwise(
        F.array().cast("array<bigint>")
    )
    return (
        with_items.withColumn("candidates", F.concat(F.array("target"), drawn))
        .withColumn("short", F.size("candidates") <= negatives)
        .drop("_ex", "_left")
    )


def negatives_outside_history(
    samples: DataFrame, pairs: DataFrame, num_items: Column, *, negatives: int = NUM_NEGATIVES, seed: int = 42
) -> DataFrame:
    """As ``negative_candidates``, but no item that the user ever had is eligible, however long the history is.

    ``pairs`` holds each (user_id, item) once and covers the targets. The i-th seen item e has e - i eligible items
    below it, so the r-th eligible item is r plus the number of seen items with e - i < r. Seen items and draws are
    put in one line per user and that number is carried forward to the draws: no list of the history is built, and hot
    users are cut into chunks.
    """
    seen = number_rows(pairs.select("user_id", "item"), ["user_id"], ["item"], position="_i", total=None)
    sizes = pairs.groupBy("user_id").agg(F.count(F.lit(1)).alias("_seen"))
    # a user without pairs draws from all items
    sized = samples.join(sizes, "user_id", "left").withColumn("_left", num_items - F.coalesce("_seen", F.lit(0)))
    drawn = (
        sized.where("_left > 0")
        .select("user_id", "from_end", "_left", F.explode(F.sequence(F.lit(1), F.lit(negatives))).alias("_k"))
        .withColumn("_r", F.lit(1) + F.pmod(seeded_hash(seed, F.col("user_id"), F.col("from_end"), F.col("_k")), F.col("_left")))
    )
    line = drawn.select("user_id", F.col("_r").alias("_at"), F.lit(0).alias("_kind"), "from_end", "_k").unionByName(
        seen.select("user_id", (F.col("item") - F.col("_i")).alias("_at"), F.lit(1).alias("_kind"), "_i"),
        allowMissingColumns=True,
    )
    # a draw comes before the seen items at its own place: only those strictly below it count
    placed = fill_forward(line, ["user_id"], ["_at", "_kind", "_i", "from_end", "_k"], ["_i"]).where("_kind = 0")
    item = (F.col("_at") + F.coalesce("_i", F.lit(0))).alias("item")
    lists = placed.groupBy("user_id", "from_end").agg(
        F.sort_array(F.collect_list(F.struct("_k", item))).alias("_drawn")
    )
    drawn_items = F.coalesce(F.col("_drawn.item"), F.array().cast("array<bigint>"))
    return (
        samples.join(lists, ["user_id", "from_end"], "left")
        .withColumn("candidates", F.concat(F.array("target"), drawn_items))
        .withColumn("short", F.size("candidates") <= negatives)
        .drop("_drawn")
    )


def _zone_free(df: DataFrame, key: list[str]) -> list[Column]:
    """Key columns with timestamps as microseconds, so that their hash does not depend on the session's time zone."""
    kinds = dict(df.dtypes)
    return [F.unix_micros(k) if kinds[k] == "timestamp" else F.col(k) for k in key]


def hash_split(df: DataFrame, key: list[str], *, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Label rows train or test by a hash of their key, the same under any partitioning."""
    bucket = F.pmod(seeded_hash(seed, *_zone_free(df, key)), F.lit(10_000))
    return df.withColumn("split", F.when(bucket < int(test_share * 10_000), "test").otherwise("train"))


def eligible_subset(items: DataFrame, key: str, n: int = 200, seed: int = 42) -> DataFrame:
    """``n`` items in seeded random order (all items when there are fewer)."""
    return items.select(key).orderBy(seeded_hash(seed, F.col(key)), F.col(key)).limit(n)


def training_export(
    samples: DataFrame, path: str, *, key: list[str], shards: int, batch: int = 256, shuffled: bool = True, seed: int = 42
) -> None:
    """Write samples for a training loop: ``shards`` files, rows numbered into batches of ``batch`` rows.

    Rows come in seeded random order, or in key order for evaluation. A shard is sorted before it is numbered, so a
    task that is run again writes the same batches.
    """
    by = seeded_hash(seed, *_zone_free(samples, key)) if shuffled else F.lit(0)
    ordered = samples.withColumn("_by", by)
    ordered = ordered.repartition(shards, "_by") if shuffled else ordered.repartitionByRange(shards, *key)
    in_shard = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    numbered = ordered.sortWithinPartitions("_by", *key).withColumns(
        {"shard": F.spark_partition_id(), "batch": F.floor(in_shard / batch)}
    )
    numbered.drop("_by").write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
