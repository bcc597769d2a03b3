"""Classifiers, their report and the promotion gate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.operators import classify, features
from seqloom.plans.bindings import SAMPLE_VIEW, Tables
from seqloom.plans.feature_queries import _ONLINE_SQL, _online, _requests
from seqloom.plans.registry import query

_PREDICTIONS = """predictions AS (SELECT l_returnflag AS label, CASE l_linestatus WHEN 'O' THEN 'N' ELSE 'R' END AS prediction FROM lineitem)"""
_REPORT = f"""{_PREDICTIONS}, classes AS (SELECT label AS class FROM predictions UNION SELECT prediction FROM predictions),
    counts AS (SELECT class, (SELECT count(*) FROM predictions WHERE label = class) AS support,
        (SELECT count(*) FROM predictions WHERE prediction = class) AS predicted,
        (SELECT count(*) FROM predictions WHERE label = class AND prediction = class) AS tp FROM classes),
    ratios AS (SELECT class, support, CASE WHEN predicted > 0 THEN tp / CAST(predicted AS DOUBLE) ELSE 0.0 END AS precision,
        CASE WHEN support > 0 THEN tp / CAST(support AS DOUBLE) ELSE 0.0 END AS recall FROM counts),
    report AS (SELECT class, precision, recall, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1,
        support FROM ratios)"""
_DIGITS = 9


def _predictions(t: Tables) -> DataFrame:
    return t.read("lineitem").select(
        F.col("l_returnflag").alias("label"), F.when(F.col("l_linestatus") == "O", "N").otherwise("R").alias("prediction")
    )


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, _DIGITS) for c in columns})


@query(f"WITH {_PREDICTIONS} SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 9) AS accuracy FROM predictions")
def accuracy(t: Tables) -> DataFrame:
    return _rounded(classify.accuracy(_predictions(t)), "accuracy")


@query(
    f"""WITH {_REPORT} SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM report"""
)
def classification_report(t: Tables) -> DataFrame:
    return _rounded(classify.classification_report(_predictions(t)), "precision", "recall", "f1")


@query(
    f"""WITH {_REPORT} SELECT 'macro avg' AS average, round(avg(precision), 9) AS precision, round(avg(recall), 9) AS recall,
    round(avg(f1), 9) AS f1, CAST(sum(support) AS BIGINT) AS support FROM report
    UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9), round(sum(recall * support) / sum(support), 9),
    round(sum(f1 * support) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM report"""
)
def classification_report_avg(t: Tables) -> DataFrame:
    report = classify.classification_report(_predictions(t))
    return _rounded(classify.classification_report_avg(report), "precision", "recall", "f1")


@query(
    f"""WITH {_PREDICTIONS}, a AS (SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 9) AS accuracy FROM predictions)
    SELECT accuracy, accuracy >= 0.8 AS promote FROM a"""
)
def promotion_gate(t: Tables) -> DataFrame:
    return classify.promotion_gate(_rounded(classify.accuracy(_predictions(t)), "accuracy"))


_FOREST = {"numTrees": 5, "maxDepth": 4, "seed": 42}


@query()
def train_classifier(t: Tables) -> DataFrame:
    """Accuracy of forest and regression on held-out samples, with the gate's decision."""
    out = None
    for kind, params in (("random_forest", _FOREST), ("logistic_regression", {"maxIter": 5})):
        _, scored = classify.train_classifier(t.fit_table, kind, params, key=["user_id", "event_timestamp"])
        row = classify.promotion_gate(classify.accuracy(scored)).withColumn("model_type", F.lit(kind))
        out = row if out is None else out.unionByName(row)
    return out


@query()
def batch_predict(t: Tables) -> DataFrame:
    """Predictions for every request, through online table, offline fallback and model."""
    model, _ = classify.train_classifier(t.fit_table, "random_forest", _FOREST, key=["user_id", "event_timestamp"])
    resolved = features.online_lookup_with_fallback(
        _requests(t), _online(t), t.staged_table, [SAMPLE_VIEW.time, *SAMPLE_VIEW.tie]
    )
    return classify.batch_predict(resolved, model)


# one tree over all features learns a label that is one of them
_TREE = {"numTrees": 1, "maxDepth": 4, "featureSubsetStrategy": "all", "seed": 42}


def _slot_model(t: Tables):
    return classify.train_classifier(
        t.fit_table, "random_forest", _TREE, key=["user_id", "event_timestamp"], target="target_time"
    )


@query(
    """SELECT user_id, CAST(target_time AS VARCHAR) AS label, CAST(target_time AS VARCHAR) AS prediction FROM fit_rows
    WHERE CAST('0x' || substr(md5('42:' || user_id || ':' || epoch_us(event_timestamp)), 1, 8) AS BIGINT) % 10000 < 2000""",
    "fit_rows",
)
def train_classifier_exact(t: Tables) -> DataFrame:
    """Held-out predictions of a label that the features determine: all are right."""
    _, scored = _slot_model(t)
    return scored.select("user_id", "label", "prediction")


@query(
    f"""WITH {_ONLINE_SQL}, offline AS (SELECT * FROM staged
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC, target DESC) = 1)
    SELECT r.user_id AS entity_id, CAST(coalesce(o.target_time, f.target_time, 0) AS VARCHAR) AS prediction,
    CASE WHEN o.user_id IS NOT NULL THEN 'online' WHEN f.user_id IS NOT NULL THEN 'offline' ELSE 'missing' END AS feature_source
    FROM requests r LEFT JOIN online o USING (user_id) LEFT JOIN offline f USING (user_id)""",
    "staged",
)
def batch_predict_exact(t: Tables) -> DataFrame:
    """The same model on every request, through online table and offline fallback; no features count as zeros."""
    model, _ = _slot_model(t)
    resolved = features.online_lookup_with_fallback(
        _requests(t), _online(t), t.staged_table, [SAMPLE_VIEW.time, *SAMPLE_VIEW.tie]
    )
    return classify.batch_predict(resolved, model)
