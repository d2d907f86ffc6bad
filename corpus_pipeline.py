"""From raw documents to packed sequences: the stages of the corpus pipeline, each on all rows that the one before kept.

All stages but the last return the columns of ``documents``, whatever their names. A stage decides on ids and hashes of texts;
the documents themselves meet its decisions in one join and pass through no Python. A stage's result is written as a table
before the next one begins, so a lost executor costs one stage at most.

Null texts are empty: they are scored, are copies of each other, have no near copies and pack into one end token. Rows without
an id are never copies and lose no passage; they stay until the last stage. Rows that repeat an id and a text count as
exact copies of which one stays. Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfseries.llm import exact, neardup, packing, substring, toxicity
from shelfseries.llm.staging import hold


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, learned from the labelled ones among them, does not call toxic."""
    fitted = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop(docs, fitted)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the smallest id."""
    return exact.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by shingles of five words at a similarity of 0.8 the one with the smallest id."""
    return neardup.deduplicate(docs, shingle=5, percent=80)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-word windows that a document with a smaller id has; other texts stay as they are."""
    return substring.without_repeats(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", drop_toxic), ("exact dedup", drop_exact_copies), ("near-duplicates", drop_near_copies),
    ("substring dedup", cut_repeated_passages), ("packing", pack_sequences),
]

#: Learned scores, sketches and tokens cannot be said in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other over the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = hold(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
