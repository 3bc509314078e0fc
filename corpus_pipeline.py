"""From raw documents to a sharded training mix, in five stages over written tables.

1. toxicity: documents that score 0.5 or more go.   2. near duplicates: one document of each linked group stays.
3. decontamination: documents with a benchmark item go.   4. mixing: documents are taken as often as the target weights ask.
5. sharding: each row gets a shard and a gapless slot.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.decontaminate import without_leaks
from orderloom.llm.jaccard_join import one_per_group
from orderloom.llm.mixing import mixed_rows
from orderloom.llm.sharding import shards
from orderloom.llm.tables import table
from orderloom.llm.toxicity import toxicity
from orderloom.staged import staging_root


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score, learnt on the labels that are not held out, is below 0.5."""
    columns = docs.columns
    return toxicity(docs, table(spark, sf_dir, "labels"), columns, "stage_toxicity").filter(F.col("stage_toxicity_score") < 0.5).select(*columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of documents linked by five-word shingle sets of Jaccard similarity 0.75 or more."""
    return one_per_group(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them."""
    return mixed_rows(docs)


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard and slot."""
    return shards(docs, docs.columns)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", deal_shards),
]
ORACLE_SQL = None  # the classifier and the cube method are beyond SQL; tests/llm/test_pipeline.py checks each stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; each stage's rows are written as Parquet under spark.checkpoint.dir and read again."""
    docs = table(spark, sf_dir, "documents")
    root = f"{staging_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{root}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
