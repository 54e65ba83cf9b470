"""Exact deduplication as a stream with keyed state.

A stream over (digest, identifier, place) keeps, per digest, the smallest
identifier, the place of that document's content and a count, in RocksDB state
without expiry; every batch writes the groups it touched. Documents whose digest
was seen more than once are then compared byte for byte; texts that share a
digest but differ are told apart.

Cases: a null text is empty; a null doc_id is larger than any other and stays
only in a group without one; rows that repeat whole are copies of each other;
an empty table gives an empty result. Other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratewise.llm.common import BLANKS, chosen_rows, file_backed, located, saved, text_of
from cratewise.session import shared_path

#: State on the executors' disks; small stores, so no space is set aside for each, and all of one executor share
#: one bounded memory.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


#: Tasks that one group of copies is dealt to.
SALTS = 16


def normalised(column: str = "text") -> Column:
    """Every run of blanks becomes one space."""
    return F.regexp_replace(text_of(column), BLANKS, " ")


def stream_groups(spark: SparkSession, log_path: str, schema, files_per_batch: int = 1000) -> DataFrame:
    """Keyed state over the log: digest, keeper, its place, and the number of copies.

    ``files_per_batch`` bounds a micro-batch; the state carries over between
    batches and the checkpoint in the shared folder lets a run resume.
    """
    groups_path, state_path = shared_path(spark, "dedup-groups"), shared_path(spark, "dedup-state")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(log_path)
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_file", "_row")
    groups = stream.groupBy("digest").agg(F.min(first).alias("keeper"), F.count("*").alias("copies"))

    def keep(batch: DataFrame, number: int) -> None:
        # Overwriting by batch number makes a repeated batch harmless.
        batch.write.mode("overwrite").parquet(f"{groups_path}/batch={number}")

    before = {key: spark.conf.get(key, None) for key in STATE_SETTINGS}
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        writer = groups.writeStream.outputMode("update").option("checkpointLocation", state_path)
        writer.foreachBatch(keep).trigger(availableNow=True).start().awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    kind = "digest string, keeper struct<no_id: boolean, doc_id: {0}, _file: long, _row: long>, copies long, batch int"
    schema = kind.format(dict((f.name, f.dataType.simpleString()) for f in schema.fields)["doc_id"])
    written = spark.read.schema(schema).option("ignoreMissingFiles", "true")
    path = spark._jvm.org.apache.hadoop.fs.Path(groups_path)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):  # an empty log has no batch
        return spark.createDataFrame([], schema).drop("batch")
    latest = F.max(F.struct("batch", "keeper", "copies")).alias("last")
    return written.parquet(groups_path).groupBy("digest").agg(latest).select("digest", "last.keeper", "last.copies")


def exact_dedup(spark: SparkSession, docs: DataFrame, files_per_batch: int = 1000) -> DataFrame:
    """One row per document: _file, _row, doc_id, keep_id, group_size, kept, text_sha256."""
    rows = located(file_backed(docs).select("doc_id", "text"))
    log_path = shared_path(spark, "dedup-log")
    log = rows.select(F.sha2(normalised(), 256).alias("digest"), "doc_id", "_file", "_row")
    log.write.parquet(log_path)
    log = spark.read.schema(log.schema).parquet(log_path)
    groups = saved(stream_groups(spark, log_path, log.schema, files_per_batch), "dedup-state-rows")
    # Full bytes of the hits only. A group of copies is dealt to SALTS tasks, each of
    # which merges its equal rows; what they leave meets in one row per text and salt.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    hits = groups.filter("copies > 1").select("digest", salts)
    bytes_of = rows.select(normalised().alias("bytes"), "doc_id", "_file", "_row")
    salt = F.pmod(F.xxhash64("_file", "_row"), F.lit(SALTS)).cast("int").alias("salt")
    bytes_of = bytes_of.select("*", F.sha2("bytes", 256).alias("digest"), salt).join(hits, ["digest", "salt"])
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_file", "_row")
    parts = bytes_of.groupBy("digest", "salt", "bytes").agg(F.min(first).alias("keeper"), F.count("*").alias("copies"))
    classes = parts.groupBy("digest", "bytes").agg(F.min("keeper").alias("keeper"), F.sum("copies").alias("copies"))
    checked = saved(classes.select("digest", F.xxhash64("bytes").alias("other"), "keeper", "copies"), "dedup-checked")
    clashes = checked.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1")
    result = log.join(groups, "digest")
    if not clashes.isEmpty():
        # Different bytes under one digest: their rows take the class of their own bytes.
        clash = clashes.select(F.col("digest").alias("_clash"))
        split = rows.select(F.sha2(normalised(), 256).alias("digest"), F.xxhash64(normalised()).alias("other"), "doc_id", "_file", "_row")
        split = split.join(clash, F.col("digest") == F.col("_clash"), "left_semi").join(checked, ["digest", "other"])
        result = result.join(clash, F.col("digest") == F.col("_clash"), "left_anti")
        result = result.unionByName(split.select(*result.columns))
    kept = (F.col("keeper._file") == F.col("_file")) & (F.col("keeper._row") == F.col("_row"))
    return result.select(
        "_file", "_row", "doc_id",
        F.col("keeper.doc_id").alias("keep_id"),
        F.col("copies").cast("long").alias("group_size"),
        kept.alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def keep_first_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents without their later copies, all columns as they came."""
    docs = file_backed(docs)
    return chosen_rows(docs, exact_dedup(spark, docs).filter("kept"))
