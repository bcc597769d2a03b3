"""Readers for ``::``-delimited rating files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEPARATOR = "::"


def read_lines(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """Lines of text files as column ``value``.

    The CSV reader decodes the charset; a separator that cannot occur keeps each line whole.
    """
    return (
        spark.read.schema("value string")
        .option("encoding", encoding)
        .option("sep", "\u0001")
        .option("quote", "")
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def _fields(lines: DataFrame, count: int) -> DataFrame:
    parts = lines.select(F.split(F.btrim("value", F.lit(" \t\r\n")), SEPARATOR, -1).alias("f"))
    return parts.where(F.size("f") == count)


def parse_users(lines: DataFrame) -> DataFrame:
    """user_id::gender::age::occupation::zip_code; lines with another number of fields are dropped."""
    f = F.col("f")
    return _fields(lines, 5).select(
        f[0].try_cast("bigint").alias("user_id"),
        f[1].alias("gender"),
        f[2].try_cast("int").alias("age"),
        f[3].try_cast("int").alias("occupation"),
        f[4].alias("zip_code"),
    )


def parse_movies(lines: DataFrame) -> DataFrame:
    """movie_id::title::genre|genre|..."""
    f = F.col("f")
    return _fields(lines, 3).select(
        f[0].try_cast("bigint").alias("movie_id"), f[1].alias("title"), F.split(f[2], r"\|").alias("genres")
    )


def parse_ratings(lines: DataFrame) -> DataFrame:
    """user_id::movie_id::rating::unix_seconds; ``in_time_order`` sorts them where a sink needs it."""
    f = F.col("f")
    return _fields(lines, 4).select(
        f[0].try_cast("bigint").alias("user_id"),
        f[1].try_cast("bigint").alias("movie_id"),
        f[2].try_cast("int").alias("rating"),
        f[3].try_cast("bigint").alias("rating_timestamp"),
    )


def in_time_order(ratings: DataFrame) -> DataFrame:
    return ratings.orderBy("rating_timestamp", "user_id", "movie_id")

