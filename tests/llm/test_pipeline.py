"""The pipeline end to end, and its stages against plain versions."""

import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{TABLES}/documents.parquet")


def test_order_of_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"]


@pytest.mark.parametrize("name", ["quality", "exact_dedup", "near_dedup", "mixing"])
def test_stages_keep_all_columns(spark, folder, name):
    odd = spark.read.parquet(str(folder / "full" / "documents.parquet"))
    for part, rows in (("full", odd), ("empty", odd.limit(0))):
        found = dict(corpus_pipeline.STAGES)[name](spark, rows, str(folder / part))
        assert found.columns == odd.columns
        found.collect()


def test_exact_stage(spark, docs):
    kept = dict(corpus_pipeline.STAGES)["exact_dedup"](spark, docs, TABLES).select("doc_id").collect()
    first = {}
    for row in docs.select("doc_id", "text").collect():
        key = re.sub(r"[\x20\x09-\x0D]+", " ", row["text"] or "")
        first[key] = min(row["doc_id"], first.get(key, row["doc_id"]))
    assert sorted(r[0] for r in kept) == sorted(first.values())


def test_near_stage_leaves_one_of_each_group(spark, docs):
    import brute

    groups = brute.components([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    kept = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, TABLES).select("doc_id").collect()
    assert sorted(r[0] for r in kept) == sorted({c for _, _, c in groups})


def test_run(spark):
    found = corpus_pipeline.run(spark, TABLES)
    filled = found.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert filled.filter("n > 2048 or n <> end").isEmpty() and not found.isEmpty()
