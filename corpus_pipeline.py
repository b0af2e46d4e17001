"""From raw documents to training tokens: five stages, each a table of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.catalog import vocabulary
from marlstone.llm.common import bound_batches, new_path, ship, table
from marlstone.llm.credentials import redact
from marlstone.llm.decontaminate import clean
from marlstone.llm.part_enum import keep_one
from marlstone.llm.toxicity import sample, score, toxic_share, train
from marlstone.llm.trie_bpe import encode_decode


def without_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the network, trained on labelled ones, does not call toxic."""
    ship(spark)
    bound_batches(spark)  # for results that are written later
    labels = table(spark, folder, "labels")
    network = train(*sample(docs, labels), toxic_share(labels))
    return score(docs, network, keep_columns=True).filter(F.col("predicted") == 0).select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates: five words, a similarity of 0.8."""
    ship(spark)
    bound_batches(spark)  # for results that are written later
    return keep_one(docs, n=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return clean(docs, table(spark, folder, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    return redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of every remaining document, as digests."""
    ship(spark)
    bound_batches(spark)  # for results that are written later
    return encode_decode(docs, vocabulary())


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_copies),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("bpe", tokens),
]

#: No stage but the third could be told in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written and read again before the next stage."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, folder)
