"""The corpus pipeline: quality, exact copies, near copies, mix, packing.

Each stage takes the documents that the one before it kept and returns what it
keeps, with the columns of documents; the last returns the packed pieces. Between
stages the rows are written as Parquet to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cratewise.llm import exact_dedup, mixing, packing, quality, simhash
from cratewise.llm.common import documents, saved
from cratewise.llm.queries import vocabulary


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest doc_id stays."""
    return exact_dedup.keep_first_copies(spark, docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays, with the shingles and distance of op8."""
    return simhash.keep_one_of_each(spark, docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training mix in order of training, one row for each time a document is taken."""
    return mixing.training_mix(spark, docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences."""
    return packing.packed(docs, vocabulary())


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Tokenisation and the trained classifier have no SQL; tests/llm checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for number, (name, stage) in enumerate(STAGES):
        found = stage(spark, docs, sf_dir)
        docs = found if number == len(STAGES) - 1 else saved(found, f"stage-{name}")
    return docs
