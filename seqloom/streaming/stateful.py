"""Stream operators with state of their own: a point-in-time join and the last value of gauges, both with timers.

The state of an entity is kept by one task, like every keyed state; it is bounded by time, not by the length of the stream.
"""

from __future__ import annotations

import bisect
import contextlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ListState

from seqloom.operators.features import FeatureView

# columns that a processor sees must not begin with an underscore
#: Times of rows that travel as JSON keep their microseconds.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _AsOf(StatefulProcessor):
    """Feature rows and events that wait for the watermark, per entity.

    An event is answered when the watermark has passed it, for then no feature row that belongs to it can come any more. A
    feature row goes when no event that may still come or wait is within its time to live.

    Rows are lists, so a frame of them is one call to the state, and an entity has one timer, for the first of them that is
    due: when it expires, all that the watermark has passed is answered in one pass over what is held.
    """

    def __init__(self, ttl_us: int):
        self.ttl_us = ttl_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.features = handle.getListState("features", "us long, tie string, payload string")
        self.waiting = handle.getListState("waiting", "us long, payload string")
        self.due = handle.getValueState("due", "ms long")

    def _event_due(self, us: int) -> int:
        return us // 1000 + 1

    def _feature_due(self, us: int) -> int:
        return (us + self.ttl_us) // 1000 + 2

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for frame in rows:
            columns = zip(frame["us"].tolist(), frame["kind"], frame["tie"], frame["payload"], strict=True)
            events, found = [], []
            for us, kind, tie, payload in columns:
                if kind:
                    events.append((us, payload))
                else:
                    found.append((us, tie, payload))
            if events:
                self.waiting.appendList(events)
            if found:
                self.features.appendList(found)
            due = [self._event_due(min(us for us, _ in events))] if events else []
            due += [self._feature_due(min(us for us, _, _ in found))] if found else []
            first = min(due if first is None else [first, *due])
        held = self.due.get()[0] if self.due.exists() else None
        if first is not None and (held is None or first < held):
            if held is not None:
                self.handle.deleteTimer(held)
            self._wake(first)
        yield from ()

    def _wake(self, ms: int) -> None:
        self.handle.registerTimer(ms)
        self.due.update((ms,))

    @staticmethod
    def _rows(rows: list[tuple]) -> pd.DataFrame:
        event, us, feature = zip(*rows, strict=True) if rows else ((), (), ())
        # texts as plain objects: Arrow takes them in one piece
        kinds = {"event": (event, object), "feature_us": (us, "Int64"), "feature": (feature, object)}
        return pd.DataFrame({name: pd.Series(list(values), dtype=kind) for name, (values, kind) in kinds.items()})

    @staticmethod
    def _rank(tie: str) -> list[tuple]:
        """Ties as they compare: null is the smallest."""
        return [(value is not None, value) for (value,) in json.loads(tie)]

    def _known(self) -> dict[int, tuple[str, str]]:
        """For each time the feature row that counts, with its tie; of equal ties the one that came last."""
        known: dict[int, tuple[str, str]] = {}
        for us, tie, payload in self.features.get():
            if us not in known or self._rank(known[us][0]) <= self._rank(tie):
                known[us] = (tie, payload)
        return known

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        upto = timerValues.getCurrentWatermarkInMs() * 1000
        features = self._known()
        known = sorted(features)
        waiting = sorted(self.waiting.get())
        out, at = [], -1
        for us, payload in waiting:
            if us >= upto:
                break
            while at + 1 < len(known) and known[at + 1] <= us:
                at += 1
            fresh = at >= 0 and known[at] >= us - self.ttl_us
            out.append((payload, known[at] if fresh else None, features[known[at]][1] if fresh else None))
        later = waiting[len(out) :]
        kept = known[bisect.bisect_left(known, upto - self.ttl_us) :]
        if out:
            self._keep(self.waiting, later)
        if len(kept) < len(known):
            self._keep(self.features, [(us, *features[us]) for us in kept])
        due = [self._event_due(us) for us, _ in later[:1]] + [self._feature_due(us) for us in kept[:1]]
        if due:
            self._wake(min(due))
        else:
            self.due.clear()
        if out:
            yield self._rows(out)

    @staticmethod
    def _keep(state: ListState, rows: list[tuple]) -> None:
        if rows:
            state.put(rows)
        else:
            state.clear()

    def close(self) -> None:
        pass


def point_in_time_stream(
    events: DataFrame, entity: str, time: str, features: DataFrame, view: FeatureView, *, late: str = "10 minutes"
) -> DataFrame:
    """Stream form of ``point_in_time_join`` for one view: each event with the newest feature row at or before it.

    Events come out once the watermark, ``late`` behind the newest row of either stream, has passed them; rows that come later
    than that are dropped. Features of an entity are kept for the view's time to live and no longer. Of feature rows of one
    time the one with the largest tie counts. Events and feature rows without an entity or a time are left
    out. Start it inside ``rocksdb``.
    """
    ttl_us = int(view.ttl_seconds * 1_000_000)
    value = F.struct(*view.features)
    spine = events.where(F.col(entity).isNotNull() & F.col(time).isNotNull()).select(
        F.col(entity).alias("entity"),
        F.col(time).alias("time"),
        F.lit(1).alias("kind"),
        F.lit("[]").alias("tie"),
        F.to_json(F.struct(*events.columns), _JSON).alias("payload"),
    )
    rows = features.where(F.col(view.entity).isNotNull() & F.col(view.time).isNotNull()).select(
        F.col(view.entity).alias("entity"),
        F.col(view.time).alias("time"),
        F.lit(0).alias("kind"),
        F.concat(F.lit("["), F.concat_ws(",", *[F.to_json(F.array(t)) for t in view.tie]), F.lit("]")).alias("tie"),
        F.to_json(value, _JSON).alias("payload"),
    )
    both = spine.unionByName(rows).withWatermark("time", late).withColumn("us", F.unix_micros("time"))
    joined = both.groupBy("entity").transformWithStateInPandas(
        _AsOf(ttl_us), "event string, feature_us long, feature string", "Append", "EventTime"
    )
    kinds = features.select(value.alias("f")).schema["f"].dataType
    found = joined.select(
        F.from_json("event", events.schema, _JSON).alias("e"), "feature_us", F.from_json("feature", kinds, _JSON).alias("f")
    )
    return found.select(
        "e.*",
        F.timestamp_micros("feature_us").alias(f"{view.name}__time"),
        *[F.col("f")[c].alias(f"{view.name}__{c}") for c in view.features],
    )


class _LastGauge(StatefulProcessor):
    """The newest value of a label, and a timer that tells when it has become old."""

    def __init__(self, stale_us: int):
        self.stale_us = stale_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "us long, tie long, value double")

    def _rows(self, key, us: int, value: float | None, stale: bool) -> pd.DataFrame:
        frame = pd.DataFrame({"label": [key[0]], "last_us": [us], "last_value": [value], "stale": [stale]})
        return frame.astype({"last_value": "float64"})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.last.get() if self.last.exists() else None
        newest = held
        for frame in rows:
            best = frame.sort_values(["us", "tie"]).iloc[-1]
            own = (int(best["us"]), int(best["tie"]), None if pd.isna(best["value"]) else float(best["value"]))
            if newest is None or own[:2] >= (newest[0], newest[1]):
                newest = own
        if newest is not None and (held is None or tuple(newest[:2]) != (held[0], held[1])):
            self.last.update(tuple(newest))
            self.handle.registerTimer((newest[0] + self.stale_us) // 1000 + 1)
            yield self._rows(key, newest[0], newest[2], False)
        else:
            yield self._rows(key, 0, None, False).iloc[:0]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        us, _, value = self.last.get()
        # a timer of an earlier value is too early for the one that came after it
        if (us + self.stale_us) // 1000 + 1 <= expiredTimerInfo.getExpiryTimeInMs():
            yield self._rows(key, us, value, True)
        else:
            yield self._rows(key, 0, None, True).iloc[:0]

    def close(self) -> None:
        pass


def latest_gauge_stream(
    log: DataFrame, value: str, label: str, tie: str, *, stale_after: float, late: str = "10 minutes"
) -> DataFrame:
    """``(label, last_us, last_value, stale)``: a row for each change of a label's newest value, and one when it gets stale.

    The newest value is that of the largest ``(ts, tie)``, as in ``latest_gauge``. It is stale once the watermark is
    ``stale_after`` seconds past it; a later value makes the label fresh again. The state is one value per label, null is a
    label like any other. Start it inside ``rocksdb``.
    """
    rows = log.withWatermark("ts", late).select(
        F.col(label).alias("label"),
        "ts",
        F.unix_micros("ts").alias("us"),
        F.col(tie).cast("long").alias("tie"),
        F.col(value).cast("double").alias("value"),
    )
    kind = dict(rows.dtypes)["label"]
    return rows.groupBy("label").transformWithStateInPandas(
        _LastGauge(int(stale_after * 1_000_000)),
        f"label {kind}, last_us long, last_value double, stale boolean",
        "Append",
        "EventTime",
    )


@contextlib.contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams that are started inside keep their state in RocksDB, which these operators need; others stay as they are."""
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, before)
