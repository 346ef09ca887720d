"""From raw documents to training sequences: filter, deduplicate, mix, pack.

Each stage takes the documents its predecessor kept and returns documents with the same columns; the
last returns the pieces of the packed sequences. A stage's result is stored as Parquet and reread, so a
lost executor never costs more than the stage it was lost in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chronotape.llm.common import stored, table
from chronotape.llm.mixing import mixed_documents
from chronotape.llm.near_duplicates import one_of_each
from chronotape.llm.packing import pack_documents
from chronotape.llm.quality import keep_quality
from chronotape.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

#: Trees, weighted sampling and a genetic search cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
