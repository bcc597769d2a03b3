"""A partitioned message log on shared files: topics with partitions and offsets, published and consumed exactly once.

It stands in for a broker where there is none, with the same contract: a message has a topic, a partition that its key
decides, and an offset; readers go on from offsets. Both ends are Spark data sources, in batch and on streams.

Files of messages lie below ``data/``; what counts is told by the entries of ``log/``, one JSON file per publication, numbered
without gaps. An entry lists its files with their offsets and the ends of all partitions after it. One publication at a
time may commit to a log.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from seqloom.session import known_source

FORMAT = "seqloom_log"
SCHEMA = "topic string, partition int, offset long, key string, value string"
STORED = pa.schema([("key", pa.string()), ("value", pa.string())])
#: Messages of one reading task, about.
TASK_ROWS = 500_000


def message_partition(key: str | Column, partitions: int) -> Column:
    """The partition of a message: a hash of its key; messages without a key go to partition 0."""
    first = F.conv(F.substring(F.md5(F.coalesce(F.col(key) if isinstance(key, str) else key, F.lit(""))), 1, 8), 16, 10)
    whole = F.pmod(first.cast("long"), F.lit(partitions)).cast("int")
    return F.when(F.col(key).isNull() if isinstance(key, str) else key.isNull(), 0).otherwise(whole)


def _spot(topic: str, partition: int) -> str:
    return f"{topic}/{partition}"


@dataclass(frozen=True)
class Segment:
    """A file of messages and the offsets that a reader takes from it."""

    topic: str
    partition: int
    file: str
    first: int
    start: int
    end: int


class Log:
    """The entries of a log. Paths are URIs; every process opens the file system on its own."""

    def __init__(self, path: str):
        self.system, root = fs.FileSystem.from_uri(path)
        self.root = root.rstrip("/")

    def _names(self, folder: str) -> list[str]:
        found = self.system.get_file_info(fs.FileSelector(f"{self.root}/{folder}", allow_not_found=True))
        return sorted(f.base_name for f in found if f.is_file and f.base_name.endswith(".json"))

    def _json(self, name: str) -> dict:
        with self.system.open_input_stream(f"{self.root}/{name}") as f:
            return json.loads(f.read())

    def write_json(self, name: str, content: dict) -> None:
        """A file that is there as a whole or not at all."""
        parent, _, base = f"{self.root}/{name}".rpartition("/")
        self.system.create_dir(parent, recursive=True)
        draft = f"{parent}/.{base}.{uuid.uuid4().hex}"
        with self.system.open_output_stream(draft) as f:
            f.write(json.dumps(content).encode())
        self.system.move(draft, f"{parent}/{base}")

    def read_json(self, name: str) -> dict | None:
        found = self.system.get_file_info(f"{self.root}/{name}").type == fs.FileType.File
        return self._json(name) if found else None

    def entries(self, newest_first: bool = True) -> Iterator[dict]:
        for name in sorted(self._names("log"), reverse=newest_first):
            yield self._json(f"log/{name}")

    def ends(self) -> dict[str, int]:
        """For each topic and partition the offset after its last message."""
        last = next(self.entries(), None)
        return last["ends"] if last else {}

    def append(self, writer: str, batch: int, files: list[tuple[str, int, str, int]]) -> None:
        """Make files of a publication part of the log, unless the same batch of the same writer already is."""
        last = next(self.entries(), {"number": -1, "ends": {}, "batches": {}})
        if 0 <= batch <= last["batches"].get(writer, -1):
            self.drop([f for _, _, f, _ in files])
            return
        ends, segments = dict(last["ends"]), []
        for topic, partition, file, rows in sorted(files):
            start = ends.get(_spot(topic, partition), 0)
            segments.append([topic, partition, file, start, rows])
            ends[_spot(topic, partition)] = start + rows
        number = last["number"] + 1
        batches = last["batches"] | ({writer: batch} if batch >= 0 else {})
        entry = {"number": number, "writer": writer, "ends": ends, "batches": batches, "segments": segments}
        self.write_json(f"log/{number:020d}.json", entry)

    def drop(self, files: list[str]) -> None:
        for file in files:
            if self.system.get_file_info(f"{self.root}/{file}").type == fs.FileType.File:
                self.system.delete_file(f"{self.root}/{file}")

    def segments(self, start: dict[str, int], end: dict[str, int]) -> list[Segment]:
        """Files with messages from ``start`` up to ``end``, with the offsets wanted of each."""
        out = []
        for entry in self.entries():
            for topic, partition, file, first, rows in entry["segments"]:
                spot = _spot(topic, partition)
                low, high = max(first, start.get(spot, 0)), min(first + rows, end.get(spot, 0))
                if low < high:
                    out.append(Segment(topic, partition, file, first, low, high))
            before = [first for _, _, _, first, _ in entry["segments"]]
            spots = [_spot(t, p) for t, p, *_ in entry["segments"]]
            # entries before this one end where it begins; partitions that it does not touch may still go further back
            if set(spots) >= set(end) and all(b <= start.get(s, 0) for s, b in zip(spots, before, strict=True)):
                break
        return sorted(out, key=lambda s: (s.topic, s.partition, s.start))


@dataclass
class Part(InputPartition):
    segments: list[Segment]


@dataclass
class Published(WriterCommitMessage):
    files: list[tuple[str, int, str, int]] = field(default_factory=list)


def _parts(segments: list[Segment]) -> list[Part]:
    """Tasks of neighbouring segments of one partition of a topic."""
    out: list[Part] = []
    rows = 0
    for s in segments:
        last = out[-1].segments[-1] if out else None
        if last is None or (last.topic, last.partition) != (s.topic, s.partition) or rows + s.end - s.start > TASK_ROWS:
            out.append(Part([]))
            rows = 0
        out[-1].segments.append(s)
        rows += s.end - s.start
    return out


def _read(path: str, part: Part) -> Iterator[pa.RecordBatch]:
    log = Log(path)
    for s in part.segments:
        with log.system.open_input_file(f"{log.root}/{s.file}") as f:
            offset = s.first
            for batch in pq.ParquetFile(f).iter_batches(columns=STORED.names):
                low, high = max(0, s.start - offset), min(batch.num_rows, s.end - offset)
                if low < high:
                    n = high - low
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([s.topic] * n, pa.string()),
                            pa.array([s.partition] * n, pa.int32()),
                            pa.array(range(offset + low, offset + high), pa.int64()),
                            *(batch.column(c).slice(low, n) for c in STORED.names),
                        ],
                        names=["topic", "partition", "offset", *STORED.names],
                    )
                offset += batch.num_rows
                if offset >= s.end:
                    break


def _write(path: str, iterator: Iterator[pa.RecordBatch]) -> Published:
    """One file per topic and partition that the task holds."""
    log, writers, rows = Log(path), {}, {}
    log.system.create_dir(f"{log.root}/data", recursive=True)
    try:
        for batch in iterator:
            table = pa.Table.from_batches([batch])
            for topic, partition in {(t, p) for t, p in zip(*(batch.column(c).to_pylist() for c in ("topic", "partition")), strict=True)}:
                own = table.filter(pc.and_(pc.equal(table["topic"], topic), pc.equal(table["partition"], partition)))
                name = (topic, partition)
                if name not in writers:
                    file = f"data/{uuid.uuid4().hex}.parquet"
                    writers[name] = file, pq.ParquetWriter(f"{log.root}/{file}", STORED, filesystem=log.system)
                writers[name][1].write_table(own.select(STORED.names).cast(STORED))
                rows[name] = rows.get(name, 0) + own.num_rows
    finally:
        for _, writer in writers.values():
            writer.close()
    return Published([(t, p, writers[t, p][0], n) for (t, p), n in rows.items()])


def _files(messages: list[Published | None]) -> list[tuple[str, int, str, int]]:
    return [f for m in messages if m for f in m.files]


class BatchReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.topics = options["path"], _topics(options)

    def partitions(self) -> list[Part]:
        log = Log(self.path)
        ends = {s: n for s, n in log.ends().items() if _wanted(s, self.topics)}
        return _parts(log.segments({}, ends)) or [Part([])]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        return _read(self.path, partition)


def _topics(options: dict) -> list[str]:
    return [t for t in options.get("subscribe", "").split(",") if t]


def _wanted(spot: str, topics: list[str]) -> bool:
    return not topics or spot.rpartition("/")[0] in topics


class StreamReader(DataSourceStreamReader):
    """Offsets of all subscribed partitions; with a group, so many rows of a topic in a batch.

    Spark asks a Python source for the latest offset without telling where the query stands, so what was offered last is
    kept under the name of the group before Spark sees it. Spark may lag behind that by one batch after a crash, never be
    ahead, so offsets only grow, and a batch has twice the limit at most.
    """

    def __init__(self, options: dict):
        self.path, self.topics = options["path"], _topics(options)
        self.limit, self.group = int(options.get("maxrowspertrigger", 0)), options.get("group")
        if self.limit and not self.group:
            raise ValueError("a limit of rows needs a group to keep the position of the query")
        self.offered: dict[str, int] | None = None

    def _position(self) -> str:
        return f"groups/{self.group}.json"

    def initialOffset(self) -> dict:
        # a query without a checkpoint starts from the earliest offset
        self.offered = {}
        if self.group:
            Log(self.path).write_json(self._position(), {})
        return {}

    def latestOffset(self) -> dict:
        log = Log(self.path)
        ends = {s: n for s, n in log.ends().items() if _wanted(s, self.topics)}
        if not self.limit:
            return ends
        if self.offered is None:
            self.offered = log.read_json(self._position()) or {}
        after = dict(self.offered)
        for topic in {s.rpartition("/")[0] for s in ends}:
            left = self.limit
            spots = sorted((s for s in ends if s.rpartition("/")[0] == topic), key=lambda s: ends[s] - after.get(s, 0))
            for i, spot in enumerate(spots):  # partitions with little to read leave their share to the others
                take = min(ends[spot] - after.get(spot, 0), left // (len(spots) - i))
                after[spot] = after.get(spot, 0) + take
                left -= take
        if after != self.offered:
            log.write_json(self._position(), after)
            self.offered = after
        return after

    def partitions(self, start: dict, end: dict) -> list[Part]:
        if any(end.get(s, 0) < n for s, n in start.items()):
            raise ValueError("the log ends before the offsets that the query has read; is its group used by another one?")
        return _parts(Log(self.path).segments(start, end))

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        return _read(self.path, partition)


class BatchWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.writer = options["path"], options["writer"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Published:
        return _write(self.path, iterator)

    def commit(self, messages: list[Published | None]) -> None:
        Log(self.path).append(self.writer, -1, _files(messages))

    def abort(self, messages: list[Published | None]) -> None:
        Log(self.path).drop([f for _, _, f, _ in _files(messages)])


class StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, options: dict):
        self.path, self.writer = options["path"], options["writer"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Published:
        return _write(self.path, iterator)

    def commit(self, messages: list[Published | None], batchId: int) -> None:
        Log(self.path).append(self.writer, batchId, _files(messages))

    def abort(self, messages: list[Published | None], batchId: int) -> None:
        Log(self.path).drop([f for _, _, f, _ in _files(messages)])


class MessageLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> BatchReader:
        return BatchReader(dict(self.options))

    def streamReader(self, schema: StructType) -> StreamReader:
        return StreamReader({k.lower(): v for k, v in self.options.items()})

    def writer(self, schema: StructType, overwrite: bool) -> BatchWriter:
        return BatchWriter(dict(self.options))

    def streamWriter(self, schema: StructType, overwrite: bool) -> StreamWriter:
        return StreamWriter(dict(self.options))


def _keyed(messages: DataFrame, partitions: int) -> DataFrame:
    return messages.where("topic IS NOT NULL").select(
        "topic", message_partition("key", partitions).alias("partition"), "key", F.col("value").cast("string").alias("value")
    )


def publish_log(messages: DataFrame, path: str, *, partitions: int = 8) -> DataFrame:
    """Append ``messages (topic, key, value)`` in one publication; returns ``(topic, accepted)`` of those that it holds.

    All of a publication becomes visible with its entry, which the driver writes when every task is done. Files of tasks that
    failed or ran twice are in no entry. Rows of a partition are brought together first, and a large one is split; messages
    of one publication and key keep no order among each other. A message without a topic is not accepted.
    """
    spark, writer = messages.sparkSession, uuid.uuid4().hex
    rows = _keyed(messages, partitions).hint("rebalance", "topic", "partition")
    with known_source(spark, MessageLog):
        rows.write.format(FORMAT).mode("append").options(path=path, writer=writer).save()
    counts: dict[str, int] = {}
    for entry in Log(path).entries():
        if entry["writer"] == writer:
            for topic, _, _, _, n in entry["segments"]:
                counts[topic] = counts.get(topic, 0) + n
            break
    return spark.createDataFrame(sorted(counts.items()), "topic string, accepted long")


def start_publishing(
    messages: DataFrame, path: str, checkpoint: str, writer: str, *, partitions: int = 8, trigger: dict | None = None
) -> StreamingQuery:
    """Publish a stream of messages; a batch that is run again after a failure is not published twice.

    ``writer`` names the query in the log and has to stay the same over restarts.
    """
    rows = _keyed(messages, partitions).repartition("topic", "partition")
    with known_source(messages.sparkSession, MessageLog):
        return (
            rows.writeStream.format(FORMAT)
            .options(path=path, writer=writer, checkpointLocation=checkpoint)
            .outputMode("append")
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )


def read_log(spark: SparkSession, path: str, topics: list[str] | None = None) -> DataFrame:
    """All messages of the topics (of every topic without a list) with partition and offset."""
    with known_source(spark, MessageLog):
        return spark.read.format(FORMAT).options(path=path, subscribe=",".join(topics or [])).load()


def stream_log(
    spark: SparkSession, path: str, topics: list[str] | None = None, *, group: str | None = None, max_rows: int | None = None
) -> DataFrame:
    """The same messages as a stream from the earliest offset on; ``max_rows`` of a topic in a batch, kept by ``group``.

    ``group`` is the name of one query. With ``availableNow`` a run takes one batch; without a limit that is all there is.
    """
    options = {"path": path, "subscribe": ",".join(topics or [])}
    options |= {"group": group} if group else {}
    options |= {"maxRowsPerTrigger": str(max_rows)} if max_rows else {}
    with known_source(spark, MessageLog):
        return spark.readStream.format(FORMAT).options(**options).load()


def catch_up(query: StreamingQuery, path: str, topics: list[str] | None = None) -> None:
    """Wait until a running query over ``stream_log`` has done all messages that the log holds now."""
    ends = {s: n for s, n in Log(path).ends().items() if _wanted(s, topics or [])}
    while ends:
        query.processAllAvailable()  # with a limit, this is over after one batch
        if not query.isActive:
            raise query.exception() or RuntimeError("the query was stopped")
        progress = query.lastProgress
        reached = (progress and json.loads(progress.json)["sources"][0]["endOffset"]) or {}
        if all(reached.get(s, 0) >= n for s, n in ends.items()):
            return
        time.sleep(0.05)
