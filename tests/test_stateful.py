"""Stateful stream operators against plain Python: several batches, late rows, restarts, bounded state."""

import random
from unittest.mock import MagicMock

import pandas as pd

from pyspark.sql import functions as F

from seqloom.operators.features import FeatureView
from seqloom.streaming import stateful

VIEW = FeatureView("seen", "user_id", "ts", ["value"], ttl_seconds=100, tie=["row_id"])
SCHEMA = "row_id long, user_id long, sec double, value double, kind string"


def stream(spark, source):
    files = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    return files.withColumn("ts", F.timestamp_micros(F.round(F.col("sec") * 1_000_000).cast("long")))


def run(spark, rows, out, checkpoint):
    with stateful.rocksdb(spark):
        query = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        query.trigger(availableNow=True).start().awaitTermination()


def test_point_in_time_join_over_batches_and_restarts(spark, tmp_path):
    rng = random.Random(6)
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    done, number = [], 0
    for batch in range(4):
        rows = []
        for _ in range(60):
            # up to 40 seconds behind: later than some rows before, never behind the watermark of 50
            sec = 200 * batch + rng.choice([rng.randint(0, 160), rng.random() * 160]) - (40 if batch and rng.random() < 0.2 else 0)
            kind = rng.choice(["e", "f", "f"])
            rows.append((number, rng.choice([1, 2, 3, 4, None]), float(sec), rng.choice([None, float(number)]), kind))
            number += 1
        rows.append((number, 9, 200 * batch + 160.0, 0.0, "e"))
        number += 1
        done += rows
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        both = stream(spark, source)
        events = both.where("kind = 'e'").select("row_id", "user_id", "ts")
        run(spark, stateful.point_in_time_stream(events, "user_id", "ts", both.where("kind = 'f'"), VIEW, late="50 seconds"), out, checkpoint)
    mark = max(r[2] for r in done if r[1] is not None) - 50
    want = {}
    for i, user, sec, _, kind in done:
        if kind == "e" and user is not None and sec < mark - 0.002:
            best = max(((s, n, v) for n, u, s, v, k in done if k == "f" and u == user and s <= sec), default=None)
            want[i] = best[2] if best and best[0] >= sec - 100 else None
    found = spark.read.parquet(out).collect()
    got = {r.row_id: r.seen__value for r in found}
    assert len(got) == len(found) and got == want
    state = spark.read.format("statestore").option("stateVarName", "features").load(checkpoint)
    assert 0 < state.count() <= sum(r[4] == "f" and r[2] >= mark - 210 for r in done)


def test_gauges_become_stale_and_fresh_again(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    batches = [
        [(1, 1, 10.0, 5.0, ""), (2, 1, 10.0, 6.0, ""), (3, 2, 12.0, None, ""), (4, None, 3.0, 1.0, "")],
        [(5, 3, 300.0, 7.0, ""), (6, 1, 9.0, 8.0, "")],  # the second is old, and too late once the watermark has moved
        [(7, 1, 301.0, 9.0, ""), (8, 3, 302.0, 7.5, "")],
        [(9, 5, 900.0, 0.0, "")],
    ]
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        rows = stateful.latest_gauge_stream(stream(spark, source), "value", "user_id", "row_id", stale_after=60, late="5 seconds")
        run(spark, rows, out, checkpoint)
    found = sorted(((r.label or 0, r.last_us // 1_000_000, r.stale, r.last_value) for r in spark.read.parquet(out).collect()))
    assert found == [
        (0, 3, False, 1.0), (0, 3, True, 1.0), (1, 10, False, 6.0), (1, 10, True, 6.0), (1, 301, False, 9.0), (1, 301, True, 9.0),
        (2, 12, False, None), (2, 12, True, None), (3, 300, False, 7.0), (3, 302, False, 7.5), (3, 302, True, 7.5), (5, 900, False, 0.0),
    ]


def test_an_entity_has_one_timer_and_few_calls_to_its_state():
    """However many rows an entity has: a timer each, with a look at all rows at each, takes the square of them."""
    handle = MagicMock()
    features, waiting = MagicMock(), MagicMock()
    handle.getListState.side_effect = lambda name, schema: {"features": features, "waiting": waiting}[name]
    handle.getValueState.return_value.exists.return_value = False
    n = 3000
    rows = [(i * 1_000_000, i % 2, f"[[{i}]]" if i % 2 == 0 else "[]", str(i)) for i in range(n)]
    processor = stateful._AsOf(100_000_000)
    processor.init(handle)
    assert not list(processor.handleInputRows((1,), iter([pd.DataFrame(rows, columns=["us", "kind", "tie", "payload"])]), None))
    handle.registerTimer.assert_called_once_with(1001)
    features.get.return_value = [(us, tie, payload) for us, kind, tie, payload in rows if not kind]
    waiting.get.return_value = [(us, payload) for us, kind, _, payload in rows if kind]
    clock = MagicMock()
    clock.getCurrentWatermarkInMs.return_value = 2000 * 1000
    found = pd.concat(processor.handleExpiredTimer((1,), clock, None))
    assert [tuple(r) for r in found.itertuples(index=False)] == [(str(i), (i - 1) * 1_000_000, str(i - 1)) for i in range(1, 2000, 2)]
    assert features.get.call_count == waiting.get.call_count == features.put.call_count == waiting.put.call_count == 1
    assert handle.registerTimer.call_count == 2 and len(waiting.put.call_args[0][0]) == 500
