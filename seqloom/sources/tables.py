"""Staged tables, side documents and named views."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Recursive Parquet scan with partition discovery; an empty frame when the path does not exist."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def scan_project(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    return spark.read.parquet(path).select(*columns)


def table_format(spark: SparkSession, wanted: str = "delta") -> str:
    """``wanted`` if its data source is on the class path, else Parquet."""
    try:
        spark.read.format(wanted).load(f"/nonexistent/{wanted}")
    except Exception as e:  # noqa: BLE001 - any other error means that the source is there
        return "parquet" if "DATA_SOURCE_NOT_FOUND" in str(e) else wanted
    return wanted


def overwrite_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace the table including its schema."""
    writer = df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "static")
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    writer.save(path)


def register_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> int:
    """Make a stored table available under ``name``; returns its row count."""
    df = spark.read.format(fmt).load(path)
    df.createOrReplaceTempView(name)
    return df.count()


def register_views(frames: dict[str, DataFrame]) -> None:
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def stage_query(spark: SparkSession, query: str, path: str) -> None:
    """Run a SELECT and write its result as one Parquet dataset, from the executors."""
    overwrite_table(spark.sql(query), path)


def write_document(df: DataFrame, path: str) -> None:
    """JSON lines, one per row; an id map stays a table and is written row by row."""
    df.write.mode("overwrite").json(path)


def read_document(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)
