"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.llm.common import WORD, unit_draw
from seqloom.session import materialize

#: No document is taken more often, and no source's target is above so many times its size.
MOST_COPIES = 3
SEED = 17


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``target`` of each source from ``(source, source_size)``, one row per source.

    Sources in code-point order, null last, weigh ``weights`` in turn and share the sum of all sizes. A target stops at
    three times its source's size, and what is above is shared by weight among the others. That is one level: every target
    is ``min(3 size, level * weight)``. Sources fill up in the order of ``3 size / weight``, so the level is found where
    the running sums first reach the total: of the sources that the level does not fill, the first has the highest one. Both windows run over one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (turn + 1).cast("int"))
    most = F.lit(float(MOST_COPIES)) * F.col("source_size")
    fill = Window.orderBy("full", F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    t = sizes.withColumn("weight", weight).withColumn("most", most).withColumn("full", F.col("most") / F.col("weight"))
    t = t.withColumn("total", F.sum("source_size").over(whole).cast("double"))
    filled = F.coalesce(F.sum("most").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    # the level if all sources before this one are full and this one and the later ones are not
    t = t.withColumn("level", (F.col("total") - filled) / open_weight)
    level = F.max(F.when(F.col("level") <= F.col("full"), F.col("level"))).over(whole)
    return t.withColumn("target", F.least("most", F.coalesce(level, F.lit(0.0)) * F.col("weight"))).select(
        "source", "source_size", "target"
    )


def systematic_sample(
    docs: DataFrame, seed: int = SEED, weights: tuple[int, ...] = (1, 2, 3), keys: tuple[str, ...] = ()
) -> DataFrame:
    """Each row of ``docs(doc_id, text, source)`` with its ``size``, ``source_size``, ``target`` and number of ``copies``.

    Every document of a source expects ``target / source_size`` copies. The rows of a source stand in a line by size (then
    a seeded hash, then doc_id), the expected copies are summed along the line, one random offset per source is added, and a
    document is emitted once for each integer that its stretch of the line crosses. Because neighbours are of like size,
    the words taken differ from the target by about the largest document only.

    The line is cut into chunks by a range partitioning on (source, size, hash, doc_id), so a hot source is spread over
    many tasks; running sums cross a chunk border as one row per source and chunk. The narrow rows are written once before
    the chunk numbers are used, since range borders may differ between runs; copies do not depend on them.

    A null text has size 0, and so has an empty one; a document of size 0 is emitted like any other but takes no words. A
    null source is a source of its own. Rows that repeat a doc_id count singly. A source without words has target 0 and no
    copies. Columns named as ``keys`` are kept and order rows of one doc_id, other extra columns are ignored; an empty table
    gives an empty result.
    """
    rows = docs.select(
        "doc_id",
        "source",
        *keys,
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    line = [F.col("source").asc_nulls_last(), F.col("size"), F.col("draw"), F.col("doc_id").asc_nulls_last(), *keys]
    # written before the borders are sampled, so that the texts are read and counted once
    rows = materialize(rows.withColumn("draw", unit_draw(F.lit(seed), F.col("doc_id"))), "sizes")
    rows = rows.repartitionByRange(*line).withColumn("chunk", F.spark_partition_id())
    rows = materialize(rows, "mix")
    chunks = rows.groupBy("source", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n").join(
        targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights).withColumnRenamed(
            "source", "named"
        ),
        F.col("source").eqNullSafe(F.col("named")),
    )
    chunks = chunks.select(
        F.col("source").alias("of_source"), F.col("chunk").alias("of_chunk"), "before", "source_size", "target"
    )
    within = Window.partitionBy("source", "chunk").orderBy("size", "draw", F.col("doc_id").asc_nulls_last(), *keys)
    placed = rows.withColumn("place", F.row_number().over(within)).join(
        chunks, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("chunk") == F.col("of_chunk"))
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = unit_draw(F.lit(seed), F.lit("offset"), F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")))

    def crossed(rank: Column) -> Column:
        return F.floor(offset + rank * rate)

    rank = F.col("before") + F.col("place")
    copies = F.least(crossed(rank) - crossed(rank - 1), F.lit(MOST_COPIES)).cast("int")
    return placed.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), *keys)
