"""From raw documents to packed training sequences, one written stage after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.llm import mixing, packing, secrets, simhash, toxicity
from seqloom.llm.common import ROW, held_out, table, with_rows
from seqloom.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; it learns from the labelled rows of the whole ``documents`` table."""
    usable = ~held_out("doc_id", 5, 0)
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), usable)
    scored = toxicity.score(docs.select("*", F.col("text").alias("kept_text")), model)
    return scored.where("predicted = 0").withColumn("text", F.col("kept_text")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the row with the smallest doc_id (null last), then by a hash of its text.

    Rows are told apart by the place where they are stored, so repeated and null ids lose or double nothing. Texts move
    once, to the task of their place.
    """
    docs = with_rows(docs.select(*COLUMNS), "near-duplicates")
    mark = F.xxhash64("text")
    found = simhash.groups(docs.select("doc_id", "text", mark.alias("mark"), *ROW))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "mark", *ROW)
    first = found.groupBy("root").agg(F.min(order).alias("first")).select("first.file", "first.row")
    return docs.join(first, list(ROW), "left_semi").select(*COLUMNS)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; documents without one stay as they are."""
    hidden = secrets.redact(secrets.scan(docs.select(*COLUMNS).withColumn("was", F.col("text"))))
    changed = ~F.col("text").eqNullSafe(F.col("was"))
    n_chars = F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return hidden.withColumn("n_chars", n_chars).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it; rows are told apart by the place where they are stored."""
    docs = with_rows(docs.select(*COLUMNS), "mix")
    keys = ("mark", *ROW)  # a hash of the text, so that rows of one doc_id stand in the same order in every run
    taken = mixing.systematic_sample(docs.withColumn("mark", F.xxhash64("text")), keys=keys).where("copies > 0")
    drawn = docs.join(taken.select(*ROW, "copies"), list(ROW))
    return drawn.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their place in a sequence."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", clean),
    ("near_duplicates", near_duplicates),
    ("secrets", hide_secrets),
    ("mix", mix),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage is written to the shared folder and read again by the next one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Hashes and tokens of the stages have no SQL form; tests/llm compares the stages with plain Python.
ORACLE_SQL = None
