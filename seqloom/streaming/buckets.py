"""An online table in hash buckets: a batch rewrites the buckets that it touches, a lookup opens those that it asks for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from seqloom.operators.features import latest_per_key
from seqloom.sources import versions

BUCKET = "_bucket"
#: Buckets of a new table.
BUCKETS = 256
#: Keys of a lookup up to which they are handed to the Parquet reader, which skips row groups by their Bloom filters.
FEW_KEYS = 1000


def _placed(rows: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """Rows with their bucket; the schema notes how many there are."""
    number: Column = F.pmod(F.hash(*keys), F.lit(buckets)).cast("int")
    return rows.select("*", number.alias(BUCKET, metadata={"buckets": buckets}))


def _buckets(version: versions.Version) -> int:
    return version.struct[BUCKET].metadata["buckets"]


def _folder(file: str) -> int:
    """The bucket of a file of the table."""
    return int(file.partition(f"/{BUCKET}=")[2].partition("/")[0])


def _touched(rows: DataFrame) -> list[int]:
    # as many numbers as there are buckets at most
    return [r[BUCKET] for r in rows.select(BUCKET).distinct().collect()]


def upsert(
    rows: DataFrame,
    root: str,
    keys: list[str],
    order: list[str],
    *,
    buckets: int = BUCKETS,
    writer: str | None = None,
    batch: int = -1,
) -> int:
    """Make the newest row per key part of the table; returns the number of buckets that were written anew.

    Only files of buckets with new rows are read and replaced, each bucket by one task and sorted by key, with Bloom filters
    on the keys. A version becomes visible as a whole; if another writer replaced one of these buckets first, the batch
    is merged again with its result. ``order`` decides as in ``latest_per_key``, so rows that come late lose. A batch of a
    streaming ``writer`` counts once. ``buckets`` is fixed when the table is made; null keys are a key like any other.
    """
    spark = rows.sparkSession
    newest = latest_per_key(rows, keys, order)
    while True:
        base = versions.current(spark, root)
        if base and base.batches.get(writer, -1) >= batch >= 0:
            return 0
        held = _buckets(base) if base else buckets
        placed = _placed(newest, keys, held)
        touched = set(_touched(placed))
        if base is None:
            base = versions.Version(-1, placed.schema.json(), [BUCKET], "", [])
        if {(f.name, f.dataType) for f in base.struct} != {(f.name, f.dataType) for f in placed.schema}:
            raise ValueError("the columns differ from those of the table")
        old = {f for f in base.files if _folder(f) in touched}
        merged = placed.select(*base.struct.names)
        if old:
            before = versions.scan_files(spark, root, base, sorted(old))
            merged = latest_per_key(before.unionByName(merged), keys, order)
        merged = merged.repartition(held, BUCKET).sortWithinPartitions(BUCKET, *keys)
        bloom = {f"parquet.bloom.filter.enabled#{k}": "true" for k in keys}
        try:
            versions.rewrite(merged, root, base, old, "upsert", writer=writer, batch=batch, options=bloom)
        except versions.Conflict:
            continue
        return len(touched)


def start_upsert(
    rows: DataFrame,
    root: str,
    checkpoint: str,
    keys: list[str],
    order: list[str],
    writer: str,
    *,
    buckets: int = BUCKETS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep the table current by a stream; ``writer`` names the query and stays the same over restarts."""

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert(batch, root, keys, order, buckets=buckets, writer=writer, batch=batch_id)

    return (
        rows.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(write)
        .start()
    )


def read(spark: SparkSession, root: str) -> DataFrame:
    """The whole table: one row per key."""
    return versions.read(spark, root).drop(BUCKET)


def rows_of(requests: DataFrame, root: str, keys: list[str]) -> DataFrame:
    """Rows of the table that may have one of the requested keys; files of other buckets are not opened.

    A handful of keys also goes to the Parquet reader, which leaves out row groups whose range or Bloom filter excludes
    them all. The result is to be joined to the requests: it holds rows of other keys too if the keys are many.
    """
    spark = requests.sparkSession
    base = versions.current(spark, root)
    if base is None:
        raise ValueError(f"{root} has no version")
    wanted = requests.select(*keys).distinct()
    asked = set(_touched(_placed(wanted, keys, _buckets(base))))
    files = [f for f in base.files if _folder(f) in asked]
    found = versions.scan_files(spark, root, base, files).drop(BUCKET)
    if len(keys) == 1:
        few = [r[0] for r in wanted.limit(FEW_KEYS + 1).collect()]
        if len(few) <= FEW_KEYS:
            found = found.where(F.col(keys[0]).isin(sorted(k for k in few if k is not None)))
    return found
