"""Corpus pipeline: language identification, exact and near-duplicate removal, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet to the
shared folder and read again as the next stage's documents. All but the last return the columns of
documents. Stages learn and compare within the documents they are given."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm import exact_dedup, language, near_dups, packing
from tallyward.llm.tables import new_path, ready, table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3. Rejects documents without a letter (or text), and only those, labelled or not; a
    null lang becomes the predicted one."""
    ready(spark)
    return language.known_documents(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4. Of equal texts the one with the largest doc_id stays."""
    ready(spark)
    return exact_dedup.kept_documents(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8. Of each group of near-duplicates the smallest doc_id stays."""
    ready(spark)
    gone = near_dups.near_duplicates(docs).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2. The pieces of packed sequences."""
    ready(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", language_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("packing", packing_stage),
]

# Classification, similarity of whole sets and packing cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
