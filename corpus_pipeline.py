"""Documents to training sequences: five stages, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tenura.llm import decontaminate, exact_dedup, packing, simhash, toxicity
from tenura.llm.queries import vocabulary
from tenura.llm.tables import table
from tenura.session import drop_staged, stage_alone


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, does not call toxic."""
    return toxicity.clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with one text the one with the largest id."""
    return exact_dedup.keep_one(docs, exact_dedup.exact_groups(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    return simhash.keep_one(docs, simhash.near_groups(docs))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage of weight."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes in the training sequences."""
    return packing.pack_documents(docs, vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]
# The classifier and the tokenizer are beyond SQL; tests hold every stage against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the documents that stay, with their places.

    Null texts are empty, rows without an id pass the near-duplicate stage, rows that repeat are copies, extra columns are carried up to the
    last stage, and without documents there are no rows. What a stage has written is deleted once the next one has read it.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, step in STAGES:
        done = stage_alone(spark, lambda: step(spark, docs, sf_dir), name)
        if before is not None:
            drop_staged(before)
        docs = before = done
    return docs
