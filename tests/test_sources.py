"""Readers, messages and stored tables."""

import json

import pytest
from pyspark.sql import functions as F

from seqloom import session
from seqloom.operators import contract, index
from seqloom.sources import delimited, events, tables
from seqloom.sources.schemas import NEW_USER, raw_table_schema


def test_latin1_files(spark, tmp_path):
    path = tmp_path / "movies.dat"
    path.write_bytes("1::Amélie, \"the\" film::Comedy|Romance\n2::short\n\n3::A::Drama\n".encode("latin-1"))
    rows = delimited.parse_movies(delimited.read_lines(spark, str(path))).orderBy("movie_id").collect()
    assert [(r.movie_id, r.title, r.genres) for r in rows] == [(1, 'Amélie, "the" film', ["Comedy", "Romance"]), (3, "A", ["Drama"])]


def test_users_and_ratings(spark):
    lines = spark.createDataFrame([("1::F::18::4::94110",), ("2::M::x::4::94110",), ("3::M::1::4",)], "value string")
    rows = delimited.parse_users(lines).orderBy("user_id").collect()
    assert [tuple(r) for r in rows] == [(1, "F", 18, 4, "94110"), (2, "M", None, 4, "94110")]
    lines = spark.createDataFrame([("1::5::3::900",), ("1::4::3::100",), ("9::9",)], "value string")
    assert [r.movie_id for r in delimited.in_time_order(delimited.parse_ratings(lines)).collect()] == [4, 5]


def test_messages(spark, tmp_path):
    df = spark.createDataFrame([("m7", "1999-12-31T23:59:58", {"weight": 0.25})], "id string, timestamp string, payload map<string,double>")
    sent = events.encode_events(df, ["id"], "raw-events", ["id", "timestamp", "payload"])
    assert [tuple(r) for r in events.accepted_per_topic(sent).collect()] == [("raw-events", 1)]
    events.publish(sent, path=str(tmp_path / "topic"))
    back = spark.read.parquet(str(tmp_path / "topic"))
    assert json.loads(back.first().value) == {"id": "m7", "timestamp": "1999-12-31T23:59:58", "payload": {"weight": 0.25}}


@pytest.mark.parametrize(
    ("value", "valid"),
    [
        ('{"id": "1", "timestamp": "2026-01-01T00:00:00", "payload": {}}', True),
        ('{"id": "1", "timestamp": "2026-01-01T00:00:00", "payload": {"a": {"b": 1}}}', True),
        ('{"id": "1", "timestamp": "2026-01-01T00:00:00"}', False),
        ('{"id": "1", "timestamp": "2026-01-01T00:00:00", "payload": "text"}', False),
        ('{"id": "1", "timestamp": "yesterday", "payload": {}}', False),
        ('{"timestamp": "2026-01-01T00:00:00", "payload": {}}', False),
        ('{"id": "1", "timest', False),
        ("[]", False),
        (None, False),
    ],
)
def test_validation(spark, value, valid):
    df = spark.createDataFrame([("raw-events", value)], "topic string, value string")
    assert events.validate_events(df).count() == int(valid)
    assert events.quarantine_events(df).count() == int(not valid)


def test_event_time_falls_back_per_row(spark):
    df = spark.createDataFrame([("2026-01-01T05:00:00",), (None,), ("junk",)], "timestamp string")
    df = df.withColumn("event_timestamp", F.lit("2020-05-05 00:00:00").cast("timestamp"))
    got = [r.t for r in events.derive_event_time(df).select(F.col("event_timestamp").cast("string").alias("t")).collect()]
    assert got == ["2026-01-01 05:00:00", "2020-05-05 00:00:00", "2020-05-05 00:00:00"]
    now = events.derive_event_time(df.drop("event_timestamp")).where("event_timestamp > '2026-06-01'").count()
    assert now == 2


def test_partitioned_append(spark, tmp_path):
    path = str(tmp_path / "new_user")
    schema = raw_table_schema("new-user")
    assert events.read_raw(spark, path, schema).count() == 0
    df = spark.createDataFrame([(1, "2026-01-05"), (2, "2026-11-05")], "user_id long, d string")
    df = df.withColumn("event_timestamp", F.col("d").cast("timestamp")).drop("d")
    for _ in range(2):
        events.append_raw(df, path)
    rows = events.read_raw(spark, path, schema)
    assert rows.count() == 4 and rows.where("month = '01' AND day = '05'").count() == 2
    assert (tmp_path / "new_user" / "year=2026" / "month=01" / "day=05").is_dir()
    assert len(NEW_USER) + 4 == len(rows.columns)


def test_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    fmt = tables.table_format(spark)
    assert fmt == "parquet"
    tables.overwrite_table(spark.range(5), path, fmt)
    tables.overwrite_table(spark.range(3).select(F.col("id").alias("other")), path, fmt)
    assert tables.register_table(spark, "t1", path) == 3
    tables.stage_query(spark, "SELECT other * 2 AS twice FROM t1", str(tmp_path / "staged"))
    staged = tables.scan_project(spark, str(tmp_path / "staged"), ["twice"])
    assert sorted(r.twice for r in staged.collect()) == [0, 2, 4]
    tables.register_views({"v": staged})
    assert spark.table("v").count() == 3
    assert contract.difference(staged, spark.table("v")).count() == 0
    assert contract.difference(staged, spark.range(1).select(F.col("id").alias("twice"))).count() == 2


def test_documents(spark, tmp_path):
    ids = index.reverse_index(index.dense_index(spark.range(10, 14), "id"), "id", "item_idx")
    tables.write_document(ids, str(tmp_path / "map"))
    back = tables.read_document(spark, str(tmp_path / "map"), ids.schema)
    assert contract.difference(ids, back).count() == 0 and back.count() == 8


def test_scratch_needs_a_shared_folder(spark, monkeypatch):
    class Remote:
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})
        sparkContext = type("S", (), {"master": "spark://host:7077"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_root(Remote)
    shared = type("R", (), {"conf": type("C", (), {"get": staticmethod(lambda k, d=None: "s3a://shared/x/")})})
    assert session.scratch_root(shared) == "s3a://shared/x"
