"""Comparison of tables by fingerprints of buckets."""

import pytest
from pyspark.sql import functions as F

from seqloom.operators import contract

SCHEMA = "k int, s string, x double, a array<int>"


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def rows(n=300):
    return [(i if i % 50 else None, f"s{i % 7}", i / 3 if i % 11 else None, [i, i % 3]) for i in range(n)]


def test_equal_tables_are_not_shuffled_by_row(spark):
    a, b = frame(spark, rows() + rows()[:40]), frame(spark, rows()[:40] + rows()[::-1], 5).select("a", "x", "s", "k")
    assert contract.differing_buckets(a, b, ["k"], 16).count() == 0
    found = contract.table_difference(a, b, ["k"], 16)
    assert found.count() == 0 and found.columns == ["bucket", "k", "s", "x", "a", "side"]
    plan = contract.differing_buckets(a, b, ["k"], 16)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [bucket" in plan and plan.count("Join FullOuter") == 1


@pytest.mark.parametrize("change", ["value", "lost", "more", "twice", "null", "swap"])
def test_changes_are_named(spark, change):
    left = rows()
    right = list(left)
    if change == "value":
        right[17] = (17, "s3", 17 / 3, [17, 99])
    elif change == "lost":
        del right[60]
    elif change == "more":
        right.append((1000, "new", 0.0, []))
    elif change == "twice":
        right += [left[5], left[5]]  # an exclusive or alone would not see it
    elif change == "null":
        right[100] = (None, None, None, None)
    else:
        right[7], right[8] = (7, left[8][1], *left[7][2:]), (8, left[7][1], *left[8][2:])
    a, b = frame(spark, left), frame(spark, right)
    want = {(side, str(tuple(r))) for side, x, y in (("left", a, b), ("right", b, a)) for r in x.exceptAll(y).collect()}
    found = contract.table_difference(a, b, ["k"], 64).collect()
    assert {(r.side, str((r.k, r.s, r.x, r.a))) for r in found} == want and len(found) == {"twice": 2, "swap": 4}.get(change, len(want))
    named = {r.bucket for r in contract.differing_buckets(a, b, ["k"], 64).collect()}
    assert named == {r.bucket for r in found} and len(named) <= 2


def test_empty_tables_and_other_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert contract.table_difference(empty, empty, ["k"]).count() == 0
    some = frame(spark, rows(5))
    assert {r.side for r in contract.table_difference(empty, some, ["k"]).collect()} == {"right"}
    assert contract.differing_buckets(some, empty, ["k"]).agg(F.sum("left_rows"), F.sum("right_rows")).first() == (5, 0)
    with pytest.raises(ValueError, match="columns"):
        contract.table_difference(some, some.drop("x"), ["k"])
