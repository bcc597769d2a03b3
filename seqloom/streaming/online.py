"""The online feature table, kept current by a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from seqloom.operators.features import latest_per_key
from seqloom.session import committed, delete_path
from seqloom.sources.tables import overwrite_table


def _write_newest(path: str, keys: list[str], order: list[str]):
    def write(batch: DataFrame, batch_id: int) -> None:
        # the batch owns its directory, so a replayed batch replaces what it wrote before
        newest = latest_per_key(batch, keys, order)
        overwrite_table(newest, f"{path}/batches/batch={batch_id:09d}")

    return write


def start_online_upsert(
    rows: DataFrame, path: str, checkpoint: str, keys: list[str], order: list[str], *, trigger: dict | None = None
) -> StreamingQuery:
    """Append the newest row per key of every micro-batch; cost follows the batch, not the table."""
    return (
        rows.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(_write_newest(path, keys, order))
        .start()
    )


def _number(directory: str) -> int:
    return int(directory.rpartition("=")[2])


def _current(spark: SparkSession, path: str) -> tuple[list[str], int]:
    """Directories that hold the table: the last finished snapshot and the finished batches after it; the last batch."""
    snapshots = committed(spark, f"{path}/snapshots/upto=*")[-1:]
    upto = _number(snapshots[0]) if snapshots else -1
    later = [b for b in committed(spark, f"{path}/batches/batch=*") if _number(b) > upto]
    return snapshots + later, _number(later[-1]) if later else upto


def read_online(spark: SparkSession, path: str, schema: StructType, keys: list[str], order: list[str]) -> DataFrame:
    """Current row per key: the last snapshot and all batches written since."""
    parts, _ = _current(spark, path)
    rows = spark.read.schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema)
    return latest_per_key(rows.select(*schema.names), keys, order)


def compact_online(spark: SparkSession, path: str, schema: StructType, keys: list[str], order: list[str]) -> None:
    """Fold the batches written so far into a new snapshot, while the stream goes on.

    The snapshot is named after the last batch in it and counts from the moment its write has finished; readers then leave
    out the older files. Run it from one place at a time.
    """
    parts, upto = _current(spark, path)
    if parts:
        rows = latest_per_key(spark.read.schema(schema).parquet(*parts).select(*schema.names), keys, order)
        overwrite_table(rows, f"{path}/snapshots/upto={upto:09d}")


def expire_online(spark: SparkSession, path: str) -> None:
    """Delete what the last snapshot has replaced; run it when no reader is left that began before the snapshot."""
    keep, _ = _current(spark, path)
    for directory in committed(spark, f"{path}/snapshots/upto=*") + committed(spark, f"{path}/batches/batch=*"):
        if directory not in keep:
            delete_path(spark, directory)
