"""Named queries over the sample tables, each with the SQL that checks it where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.plans.bindings import Tables, with_bindings


@dataclass(frozen=True)
class Query:
    run: Callable[[Tables], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None, *bindings: str, name: str | None = None):
    """Register a function of ``Tables`` under its own name."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = Query(fn, with_bindings(sql, *bindings) if sql and bindings else sql)
        return fn

    return register


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(q: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: q.run(Tables(spark, sf_dir))

    return {name: bind(q) for name, q in QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: q.sql for name, q in QUERIES.items() if q.sql}


def as_text(array: str) -> Column:
    """A list, nested or not, as JSON text, so that results compare in any engine."""
    return F.to_json(array)
