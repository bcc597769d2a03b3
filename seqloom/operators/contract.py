"""Data-contract checks on staged tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.functions.hashing import seeded_hash
from seqloom.operators.clean import STAGED_COLUMNS


def staged_rules() -> dict[str, Column]:
    """Rule name to the condition that breaks it."""
    required = ["user_id", "gender_idx", "age_idx", "occupation", "target", "target_time"]
    rules = {f"{c}_not_null": F.col(c).isNull() for c in required}
    rules["gender_idx_in_0_1"] = ~F.col("gender_idx").isin(0, 1)
    rules["age_idx_not_negative"] = F.col("age_idx") < 0
    rules["target_at_least_1"] = F.col("target") < 1
    rules["target_time_in_0_1_2"] = ~F.col("target_time").isin(0, 1, 2)
    return rules


def contract_violations(df: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Violations per rule, all rules in one pass."""
    rules = rules or staged_rules()
    row = df.agg(*[F.count_if(broken).alias(name) for name, broken in rules.items()])
    return row.unpivot([], list(rules), "rule", "violations")


def contract_row_counts(source: DataFrame, staged: DataFrame) -> DataFrame:
    """Rows of source and staged table side by side."""
    counted = source.agg(F.count(F.lit(1)).alias("source_rows"))
    other = staged.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counted.select("source_rows", other.alias("staged_rows")).withColumn(
        "equal", F.col("source_rows") == F.col("staged_rows")
    )


def same_columns(df: DataFrame, columns: list[str] = STAGED_COLUMNS) -> bool:
    return set(df.columns) == set(columns)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per named table."""
    frames = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that only one of two tables has; empty when a read-back equals what was written."""
    columns = sorted(left.columns)
    a, b = left.select(*columns), right.select(*columns)
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


#: Buckets that two tables are compared in.
COMPARE_BUCKETS = 4096


def _summaries(df: DataFrame, columns: list[str], keys: list[str], buckets: int) -> DataFrame:
    """Per bucket of keys the number of rows, and sums and exclusive or of the halves of two hashes of whole rows."""
    row = df.select(
        F.pmod(seeded_hash(0, *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]), F.lit(buckets)).alias("bucket"),
        F.xxhash64(*columns).alias("_a"),
        # another order of the columns gives another hash
        F.xxhash64(F.lit(1), *reversed(columns)).alias("_b"),
    )
    halves = [F.shiftright(c, k).bitwiseAND(0xFFFFFFFF) for c in ("_a", "_b") for k in (0, 32)]
    marks = [F.sum(h) for h in halves] + [F.bit_xor(c) for c in ("_a", "_b")]
    return row.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), F.struct(*marks).alias("mark"))


def differing_buckets(left: DataFrame, right: DataFrame, keys: list[str], buckets: int = COMPARE_BUCKETS) -> DataFrame:
    """``(bucket, left_rows, right_rows)`` where the rows of two tables are not the same multiset, whatever their order.

    Each table is read once; what is shuffled is one row per bucket and task. Buckets are a seeded hash of ``keys``, so a row
    that was changed outside its keys differs in one bucket. Two different sets of rows pass as equal only if all their
    128 bits of sums and as many of exclusive ors agree.
    """
    columns = sorted(left.columns)
    if columns != sorted(right.columns):
        raise ValueError(f"columns {columns} against {sorted(right.columns)}")
    a, b = (_summaries(df, columns, keys, buckets) for df in (left, right))
    joined = a.join(b.select("bucket", F.col("rows").alias("_rows"), F.col("mark").alias("_mark")), "bucket", "full_outer")
    return joined.where(~F.col("mark").eqNullSafe(F.col("_mark"))).select(
        "bucket", F.coalesce("rows", F.lit(0)).alias("left_rows"), F.coalesce("_rows", F.lit(0)).alias("right_rows")
    )


def table_difference(left: DataFrame, right: DataFrame, keys: list[str], buckets: int = COMPARE_BUCKETS) -> DataFrame:
    """Rows that only one of two tables has, with ``bucket`` and ``side``; only rows of differing buckets are shuffled.

    Of rows that repeat, as many are listed as one side has more. Equal tables are not shuffled at all.
    """
    # as many numbers as there are buckets at most
    found = [r["bucket"] for r in differing_buckets(left, right, keys, buckets).collect()]
    number = F.pmod(seeded_hash(0, *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]), F.lit(buckets))
    if not found:
        return left.limit(0).select(number.alias("bucket"), "*", F.lit("left").alias("side"))

    def among(df: DataFrame) -> DataFrame:
        return df.select(number.alias("bucket"), *sorted(left.columns)).where(F.col("bucket").isin(found))

    return difference(among(left), among(right))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """``df`` itself, or an error when it has no row."""
    if df.isEmpty():
        raise ValueError(f"no rows in {what}")
    return df
