"""Compare registered queries with their SQL on DuckDB."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return v


def _rows(rows, names: list[str]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_value(row[i]) for i in order) for row in rows]
    return sorted(out, key=repr)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences as messages; empty when both results are equal."""
    rel = con.sql(sql)
    if sorted(df.columns) != sorted(rel.columns):
        return [f"columns {sorted(df.columns)} against {sorted(rel.columns)}"]
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    duck_types = dict(zip(rel.columns, map(str, rel.types), strict=True))
    names = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "float": "FLOAT", "boolean": "BOOLEAN"}
    out = [f"{c}: {t} against {duck_types[c]}" for c, t in spark_types.items() if names.get(t) != duck_types[c]]
    got, want = _rows(df.collect(), df.columns), _rows(rel.fetchall(), rel.columns)
    if len(got) != len(want):
        out.append(f"{len(got)} rows against {len(want)}")
    bad = [(g, w) for g, w in zip(got, want, strict=False) if g != w]
    if bad:
        out.append(f"{len(bad)} rows differ, first {bad[0]}")
    return out
