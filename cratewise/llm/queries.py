"""One query per operator over the whole of ``documents``, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cratewise.llm import (
    audit, exact_dedup, imatch, licenses, mixing, packing, pii, quality, search, secrets, simhash, substrings, toxicity,
)
from cratewise.llm.common import documents

VOCABULARY = "word_bpe_49k.json"


def vocabulary() -> str:
    return public_tokenizers.path(VOCABULARY)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = pii.found_spans(docs, pii.fitted(docs))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of_kind = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    counts = [of_kind(k).alias(f"n_{k}") for k in pii.KINDS]
    every = F.concat("base", "added")  # the generators' kinds come after the base kinds
    return found.select("doc_id", *counts, F.sha2(text(F.col("base")), 256).alias("base_sha256"), text(every).alias("spans"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return licenses.scanned(docs, licenses.known_digests(spark))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix_table(documents(spark, sf_dir))
    return found.select("doc_id", "size", "source_size", "target", "taken", "position")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(spark, documents(spark, sf_dir))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.compared(spark, documents(spark, sf_dir))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.without_repeats(documents(spark, sf_dir))
    size = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["high"] - r["low"])
    spans = F.size("runs").cast("long").alias("n_spans")
    return found.select("doc_id", "n_bytes", size.alias("n_removed"), spans, F.sha2("kept", 256).alias("kept_sha256"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    found = quality.scored(docs, model)
    held = (quality.fold_of() == 0).alias("held_out")
    return found.select("doc_id", held, F.col("_score").alias("score"), F.col("_predicted").alias("predicted"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_groups(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", simhash.hex_of("fp").alias("fingerprint"), "component_id")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir), vocabulary())


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scanned(documents(spark, sf_dir))
    base, more = [r.kind for r in secrets.BASE], [r.kind for r in secrets.MORE]
    listed = secrets.listed(secrets.in_order([*base, *more], base))
    every = secrets.listed(secrets.in_order([*base, *more], [*base, *more]))
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in base]
    return found.select("doc_id", *counts, F.sha2(listed, 256).alias("base_sha256"), every.alias("spans"))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked(spark, documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    found = toxicity.scored(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    held = (toxicity.fold_of() == toxicity.HELD_OUT).alias("held_out")
    more = [F.col(f"_{name}").alias(name) for name in ("lang_threshold", "flagged")]
    return found.select("doc_id", held, F.col("_score").alias("score"), F.col("_predicted").alias("predicted"), *more)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pii, op2_license_scan, op3_mixing, op4_exact_dedup, op5_imatch,
        op6_suffix_dedup, op7_quality, op8_simhash, op9_packing, op10_secrets,
        op11_search, op12_filter_audit, op13_toxicity,
    )
}
