"""Classifier jobs on Spark ML, their report and the promotion gate."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.functions.vocab import FEATURE_COLS, TARGET_COL
from seqloom.operators.sampling import hash_split

MODEL_TYPES = {"random_forest": RandomForestClassifier, "logistic_regression": LogisticRegression}
PROMOTION_THRESHOLD = 0.8


def train_classifier(
    samples: DataFrame,
    model_type: str = "random_forest",
    hyperparams: dict | None = None,
    *,
    key: list[str],
    features: list[str] = FEATURE_COLS,
    target: str = TARGET_COL,
    seed: int = 42,
) -> tuple[PipelineModel, DataFrame]:
    """Fit on 80 % of the rows and return the model with its predictions on the rest.

    An unknown ``model_type`` trains a forest; ``hyperparams`` go to the Spark ML class unchanged. The prediction
    column holds original labels. Raises when there is no row to train on. Pass a staged table: training reads the rows
    several times. The distinct labels, at most the catalog, are kept on the driver by the label indexer.
    """
    rows = samples.na.drop(subset=[*features, target]).withColumn("_label", F.col(target).cast("string"))
    parts = hash_split(rows, key, seed=seed)
    train = parts.where("split = 'train'")
    if train.isEmpty():
        raise ValueError("no training rows: stage the samples first")
    labels = StringIndexer(inputCol="_label", outputCol="_y", stringOrderType="alphabetAsc").fit(rows)
    estimator = MODEL_TYPES.get(model_type, RandomForestClassifier)(
        featuresCol="_x", labelCol="_y", predictionCol="_p", **(hyperparams or {})
    )
    steps = [
        VectorAssembler(inputCols=features, outputCol="_x"),
        estimator,
        IndexToString(inputCol="_p", outputCol="prediction", labels=labels.labels),
    ]
    model = Pipeline(stages=steps).fit(labels.transform(train))
    scored = model.transform(parts.where("split = 'test'"))
    return model, scored.select(*key, F.col("_label").alias("label"), "prediction")


def batch_predict(resolved: DataFrame, model: PipelineModel, key: str = "user_id", features: list[str] = FEATURE_COLS) -> DataFrame:
    """Prediction per requested entity; entities without features are kept and scored on zeros."""
    filled = resolved.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in features})
    return model.transform(filled).select(F.col(key).alias("entity_id"), "prediction", "feature_source")


def accuracy(predictions: DataFrame) -> DataFrame:
    return predictions.agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"))


def classification_report(predictions: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class of label or prediction; an undefined ratio is 0.

    The rows are reduced to the confusion counts once, everything else works on those.
    """
    counts = predictions.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = counts.select(
        F.inline(
            F.array(
                F.struct(F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"), hit.cast("long").alias("tp")),
                F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"), F.lit(0).cast("long").alias("tp")),
            )
        )
    )
    per_class = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "tp")])
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    scored = per_class.withColumn("precision", ratio(F.col("tp"), F.col("predicted"))).withColumn(
        "recall", ratio(F.col("tp"), F.col("support"))
    )
    p, r = F.col("precision"), F.col("recall")
    return scored.withColumn("f1", ratio(2 * p * r, p + r)).select("class", "precision", "recall", "f1", "support")


def classification_report_avg(report: DataFrame) -> DataFrame:
    """Macro and support-weighted averages of a per-class report."""
    scores = ["precision", "recall", "f1"]
    weight = F.col("support")
    row = report.agg(
        F.struct(*[F.avg(c).alias(c) for c in scores]).alias("macro"),
        F.struct(*[(F.sum(F.col(c) * weight) / F.sum(weight)).alias(c) for c in scores]).alias("weighted"),
        F.sum(weight).alias("support"),
    )
    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(f"{name} avg").alias("average"), *[F.col(name)[c].alias(c) for c in scores], "support")
                    for name in ("macro", "weighted")
                ]
            )
        )
    )


def promotion_gate(metrics: DataFrame, threshold: float = PROMOTION_THRESHOLD) -> DataFrame:
    return metrics.withColumn("promote", F.col("accuracy") >= threshold)
