"""Helpers shared by the corpus operators: table access, seeded draws, labelled samples, Arrow batches, components."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqloom.session import delete_path, scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word of the size, shingle and mixing contracts: a run of anything but space and the control spaces.
WORD = r"[^\x20\x09-\x0D]+"
#: Texts handed to one call of a batch function, in rows and in characters (a longer text is a batch of its own).
BATCH_ROWS, BATCH_CHARS = 2000, 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: str | Column) -> Column:
    """``A-Z`` to lower case and nothing else."""
    return F.translate(text, UPPER, LOWER)


def held_out(key: str | Column, folds: int, fold: int) -> Column:
    """Whether ``crc32(key as text) mod folds`` is ``fold``; a null key is never held out."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == fold, F.lit(False))


def unit_draw(*parts: Column) -> Column:
    """A number in [0, 1) from the md5 of the parts, the same in every engine and on every run."""
    text = F.concat_ws(":", *(p.cast("string") for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, limit: int, seed: int) -> DataFrame:
    """About ``limit`` labelled documents at most, ``(text, label)``, chosen by a hash of their id.

    Two passes over the narrow label table find the share to keep; the texts are joined to the chosen ids, of which there
    are at most ``limit`` in expectation, so that side is small enough to broadcast. Labels that contradict each
    other for one document count by their largest value.
    """
    chosen = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & usable)
    n = chosen.count()
    share = min(1.0, limit / n) if n else 1.0
    chosen = (
        chosen.where(unit_draw(F.lit(seed), F.col("doc_id")) < share)
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
    )
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").select("text", "label")


def slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Borders of runs of texts within ``BATCH_ROWS`` and ``BATCH_CHARS``."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t)
        if i > start and (i - start >= BATCH_ROWS or size + n > BATCH_CHARS):
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def map_texts(
    df: DataFrame, fn: Callable[[list[str]], dict[str, list]], added: str, text: str = "text"
) -> DataFrame:
    """``df`` without ``text`` and with the columns ``added`` (a DDL string) that ``fn`` returns for each text.

    ``fn`` gets lists of texts (null is the empty text) and returns a dict of columns of the same length. Rows pass
    through Arrow batches inside the task that reads them; nothing is shuffled. A column of ``df`` that has the name of an
    added one gives way to it.
    """
    new = T.StructType.fromDDL(added).fields
    kept = [f for f in df.schema.fields if f.name not in (text, *(n.name for n in new))]
    from pyspark.sql.pandas.types import to_arrow_type

    types = {f.name: to_arrow_type(f.dataType) for f in new}
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(text).to_pylist()]
            for a, b in slices(texts):
                out = fn(texts[a:b])
                part = batch.slice(a, b - a)
                arrays = [part.column(n) for n in names] + [pa.array(out[n], types[n]) for n in types]
                yield pa.RecordBatch.from_arrays(arrays, names=names + list(types))

    return df.mapInArrow(run, T.StructType(kept + new))


#: What names a row of a table of files.
ROW = ("file", "row")


def _reads_files(df: DataFrame) -> bool:
    """Whether ``df`` is a scan with projections and filters at most, so that no row of a file comes twice."""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().head()
    return node.nodeName() == "LogicalRelation"


def with_rows(docs: DataFrame, label: str) -> DataFrame:
    """``docs`` with ``file`` and ``row``: the place where a row is stored, which no other row has, whatever its ids.

    A frame that is not read from Parquet is written first. Only files that do not change may be read by their places.
    """
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    if _reads_files(docs):
        with contextlib.suppress(AnalysisException):  # other formats do not number their rows
            return docs.select("*", *place)
    return written(docs, label)[0].select("*", *place)


def written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` as a table in the shared folder, and its path, for a step that deletes the table once the next one stands."""
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def tidy_session(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` in which the shuffle files of a write go when the write is done.

    What a job writes step by step then needs the disk of its largest step, not of all of them; queries of the
    other session keep their files.
    """
    child = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            child.conf.set(key, value)
    child.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    child.conf.set("spark.sql.parquet.compression.codec", "zstd")  # bits in hex take half of what they would
    return child


def components(edges: DataFrame, label: str) -> DataFrame:
    """Connected components of ``edges (u, v)``: ``(node, root)`` for every node with an edge, root = smallest node.

    Alternates the large-star and small-star steps (Kiveris et al., 2014) until every node hangs on its root. Edge rows
    never multiply: each step keeps at most one row per edge, a hub's minimum is a partial aggregate, and the join back is
    on the hub with one row on the other side. Every step is written to the shared folder, and deletes the one before.
    """
    spark = edges.sparkSession
    ordered = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, path = written(ordered, label)
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        kept = large.join(low, "u")
        small = kept.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(low).distinct()
        then, onto = written(small, label)
        same = spark.sql(
            "select (select struct(count(1), bit_xor(xxhash64(u, v))) from {a})"
            " = (select struct(count(1), bit_xor(xxhash64(u, v))) from {b}) as same",
            a=now,
            b=then,
        ).first()["same"]
        delete_path(spark, path)
        now, path = then, onto
        if same:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
