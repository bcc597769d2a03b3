"""Classifiers, report, gate and the data contract."""

import pytest
from pyspark.sql import functions as F

from seqloom.operators import classify, contract, features
from seqloom.operators.clean import STAGED_COLUMNS


@pytest.fixture(scope="module")
def samples(spark):
    df = spark.range(400).select(
        F.col("id").alias("user_id"),
        F.timestamp_seconds(F.col("id") * 10).alias("event_timestamp"),
        (F.col("id") % 2).cast("int").alias("gender_idx"),
        (F.col("id") % 7).cast("int").alias("age_idx"),
        (F.col("id") % 21).cast("int").alias("occupation"),
        (F.col("id") % 3).cast("int").alias("target_time"),
    )
    return df.withColumn("target", F.col("gender_idx").cast("long") + 1)


@pytest.mark.parametrize(
    ("kind", "params"),
    [("random_forest", {"numTrees": 3, "maxDepth": 3, "seed": 1}), ("logistic_regression", {"maxIter": 20}), ("other", {})],
)
def test_training_learns_and_predicts(spark, samples, kind, params):
    model, scored = classify.train_classifier(samples, kind, params, key=["user_id"])
    gate = classify.promotion_gate(classify.accuracy(scored)).first()
    assert gate.accuracy > 0.95 and gate.promote
    requests = spark.createDataFrame([(1,), (2,), (9999,)], "user_id long")
    online = samples.where("user_id = 1").drop("target")
    resolved = features.online_lookup_with_fallback(requests, online, samples, ["event_timestamp"])
    rows = {r.entity_id: r for r in classify.batch_predict(resolved, model).collect()}
    assert {k: r.feature_source for k, r in rows.items()} == {1: "online", 2: "offline", 9999: "missing"}
    assert rows[1].prediction == "2" and rows[2].prediction == "1"


def test_training_needs_rows(samples):
    with pytest.raises(ValueError, match="no training rows"):
        classify.train_classifier(samples.where("false"), key=["user_id"])


def test_report_with_a_class_that_is_never_predicted(spark):
    rows = [("a", "b"), ("a", "a"), ("b", "b"), ("c", "a"), ("b", "d")]
    report = classify.classification_report(spark.createDataFrame(rows, "label string, prediction string"))
    got = {r["class"]: (r.precision, r.recall, r.f1, r.support) for r in report.collect()}
    assert got == {"a": (0.5, 0.5, 0.5, 2), "b": (0.5, 0.5, 0.5, 2), "c": (0, 0, 0, 1), "d": (0, 0, 0, 0)}
    avg = {r.average: r for r in classify.classification_report_avg(report).collect()}
    assert avg["macro avg"].f1 == pytest.approx(0.25) and avg["weighted avg"].f1 == pytest.approx(0.4)


@pytest.mark.parametrize(("value", "promote"), [(0.9, True), (0.8, True), (0.5, False)])
def test_gate(spark, value, promote):
    assert classify.promotion_gate(spark.createDataFrame([(value,)], "accuracy double")).first().promote is promote


def test_contract(spark, samples):
    assert contract.same_columns(samples.select(*STAGED_COLUMNS))
    assert not contract.same_columns(samples.drop("target"))
    broken = samples.limit(3).withColumn("gender_idx", F.lit(5)).withColumn("target", F.lit(None).cast("long"))
    counts = {r.rule: r.violations for r in contract.contract_violations(samples.unionByName(broken)).collect()}
    assert counts["gender_idx_in_0_1"] == 3 and counts["target_not_null"] == 3
    assert sum(counts.values()) == 6
    assert contract.contract_row_counts(samples, samples).first().equal
    with pytest.raises(ValueError, match="no rows in users"):
        contract.require_rows(samples.where("false"), "users")


def test_missing_rate(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, 4), (5, 6)], "a int, b int")
    assert {r.feature: r.missing_rate for r in features.feature_missing_rate(df, ["a", "b"]).collect()} == {"a": 0.25, "b": 0.5}


def test_online_lookup_misses(spark):
    online = spark.createDataFrame([(1, 0, None), (2, None, None)], "user_id int, x int, y int")
    requests = spark.createDataFrame([(1,), (2,), (3,), (1,)], "user_id int")
    got = sorted((r.user_id, r.is_miss) for r in features.online_lookup(requests, online, features=["x", "y"]).collect())
    assert got == [(1, False), (1, False), (2, True), (3, True)]
