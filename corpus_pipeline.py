"""A corpus pipeline: stages over ``documents``, each working on what the one before kept."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import exact_dedup, jaccard_join, mixing, packing, quality
from ledgerloom.sources.workspace import settled


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    NULL and empty texts are scored as texts without words; rows that repeat one another stay or go together; without
    labels of both kinds every score is the share of good ones (0.5 without labels), so all stay or all go.
    """
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the smallest id.

    NULL and empty texts are equal; of rows that repeat an id and its text one stays; a row without an id stays only
    if no equal one has an id.
    """
    return exact_dedup.one_row_of_each(docs)


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts, the one with the smallest id.

    Texts without words are similar to none and stay; repeated rows leave one.
    """
    return jaccard_join.one_row_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix in training order, one row per use.

    Documents without words are in no mix; a NULL source is a source of its own; repeated rows are used each.
    """
    return mixing.mixed_documents(docs)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket and batch of each row of the mix, in training order.

    ``position`` is the row's place in that order, so the uses of one document can be told apart. Rows of no words
    have no batch.
    """
    return packing.pack_in_order(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_similar),
    ("mixing", mix_sources),
    ("packing", pack_batches),
]

# trained models and randomised search are not SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage; every stage is written as Parquet and read again by the next.

    Work tables of a stage are deleted when its rows are written. An empty table of documents gives no rows, and every
    stage hands on the columns of its documents, whatever their names.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settled(spark, name.replace(" ", "-"), partial(stage, spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
