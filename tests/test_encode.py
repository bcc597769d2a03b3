"""Column expressions at their edges."""

import math

import pytest
from pyspark.sql import functions as F

from seqloom.functions import arrays, encode
from seqloom.functions.vocab import GENRES
from seqloom.operators import clean, index


def values(spark, rows, schema, expr):
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
    return [r[0] for r in df.coalesce(1).select(expr(F.col(df.columns[0]))).collect()]


def test_gender(spark):
    texts = ["F", "M", " f\t", "m", "x", None]
    assert values(spark, texts, "g string", encode.gender_code_strict) == [0, 1, 1, 1, 1, 1]
    assert values(spark, texts, "g string", encode.gender_code) == [0, 1, 0, 1, None, None]


def test_age(spark):
    assert values(spark, [1, 18, 25, 35, 45, 50, 56, 30, None], "a int", encode.age_bucket) == [0, 1, 2, 3, 4, 5, 6, 6, 6]


def test_genres(spark):
    lists = [["Action", "Western"], ["Nope", "Drama", "War", "Crime"], [], None, [None, "Comedy"]]
    want = [[1, 18, 0], [0, 8, 17], [0, 0, 0], [0, 0, 0], [0, 5, 0]]
    assert values(spark, lists, "g array<string>", encode.genre_codes) == want
    assert len(GENRES) == 18


def test_genre_text(spark):
    texts = ["Action| Drama |", " War Crime", "Children's|Sci-Fi|War|Crime", "", None]
    want = [[1, 8, 0], [17, 6, 0], [4, 15, 17], [0, 0, 0], [0, 0, 0]]
    assert values(spark, texts, "g string", lambda c: encode.genre_codes(encode.split_genres(c))) == want


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_time_slot(spark, zone):
    hours = {0: 2, 5: 2, 6: 0, 17: 0, 18: 1, 21: 1, 22: 2, 23: 2}
    times = [h * 3600 + 3599 for h in hours] + [-3600]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert values(spark, times, "t long", encode.time_slot) == [*hours.values(), 2]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_hour(spark):
    assert values(spark, ["2026-01-01 14:30:00", "bad", None], "t string", encode.hour_of) == [14, None, None]


def test_rating_bucket(spark):
    raw = [2.5, 3.5, -1.0, 9.0, 3.2, None, math.nan, math.inf]
    assert values(spark, raw, "p double", encode.rating_bucket) == [2, 4, 1, 5, 3, None, None, None]
    assert values(spark, ["4.4", "junk"], "p string", encode.rating_bucket) == [4, None]


def test_labels(spark):
    want = ["Matinee (6:00-17:59)", "Prime Time (18:00-21:59)", "Late Night (22:00-5:59)", "Unknown", "Unknown"]
    assert values(spark, [0, 1, 2, 7, None], "s int", encode.time_slot_label) == want
    assert values(spark, ["Hit@5", "NDCG@10"], "m string", encode.metric_column) == ["test_hit_at_5", "test_ndcg_at_10"]
    assert values(spark, [0.0123456], "s double", encode.latency_ms) == [12.35]


def test_padding(spark):
    lists = [[1, 2], [1, 2, 3, 4, 5], [], None]
    assert values(spark, lists, "a array<int>", lambda c: arrays.pad_left(c, 4)) == [
        [0, 0, 1, 2],
        [2, 3, 4, 5],
        [0, 0, 0, 0],
        [0, 0, 0, 0],
    ]
    nested = [[[1], [1, 2, 3, 4]], [[9, 9, 9]] * 5, []]
    got = values(spark, nested, "a array<array<int>>", lambda c: arrays.pad_lists_left(c, 3, 3))
    assert got == [[[0, 0, 0], [1, 0, 0], [1, 2, 3]], [[9, 9, 9]] * 3, [[0, 0, 0]] * 3]


def test_normalize(spark):
    df = spark.createDataFrame([(0.0, 3.0, None), (5.0, 3.0, None), (10.0, 3.0, None)], "a double, b double, c double")
    rows = clean.minmax_normalize(df, ["a", "b", "c"]).orderBy("a").collect()
    assert [tuple(r) for r in rows] == [(0.0, 3.0, None), (0.5, 3.0, None), (1.0, 3.0, None)]


def test_label_encode_keeps_null(spark):
    df = spark.createDataFrame([(30,), (None,), (10,), (20,), (10,)], "age int")
    got = sorted((r.age or -1, -1 if r.code is None else r.code) for r in index.label_encode(df, "age", "code").collect())
    assert got == [(-1, -1), (10, 0), (10, 0), (20, 1), (30, 2)]


def test_coerce_and_drop(spark):
    df = spark.createDataFrame([("1", "x"), ("no", "3.5"), (None, "4")], "id string, v string")
    out = clean.drop_null_keys(clean.coerce_numeric(df, {"id": "bigint", "v": "double"}), ["id"])
    assert [tuple(r) for r in out.collect()] == [(1, None)]
