"""Session settings the plans rely on, and reliable lineage cuts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Joins carry no broadcast hint on tables that grow: Spark compares the
# measured size with its threshold and otherwise sorts and merges, splitting
# hot keys at run time. Metric rows are mostly nulls: a sort needs some ten
# times the bytes that they have in a shuffle, so partitions are kept small.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    "spark.sql.session.timeZone": "UTC",
}
# Can only be set before a session starts. A report has some hundred generated
# classes; Spark's default of 100 would compile them anew in every query.
STATIC_SETTINGS = {"spark.sql.codegen.cache.maxEntries": "4096"}
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# Shuffle partitions per core that a stage starts with on a cluster; run-time
# coalescing joins those below the advisory size.
PARTITIONS_PER_CORE = 8


def is_local(spark: SparkSession) -> bool:
    return str(spark.conf.get("spark.master", "local")).startswith("local")


def configure(spark: SparkSession) -> SparkSession:
    """Applies the runtime settings to an existing session.

    On a cluster shuffles start with many partitions, unless the session names a number.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if not is_local(spark) and spark.conf.get(INITIAL_PARTITIONS, None) is None:
        wanted = PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism
        spark.conf.set(INITIAL_PARTITIONS, str(max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cratewise")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
    )
    for key, value in {**SETTINGS, **STATIC_SETTINGS}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints.

    Where none is set a folder below the warehouse serves; a warehouse on the
    driver's own disk only in local mode, where there is no other machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not is_local(spark) and (warehouse.startswith("file:") or ":" not in warehouse):
        raise ValueError("Set spark.checkpoint.dir to a folder that every executor reaches; the warehouse is on a local disk.")
    return f"{warehouse}/_shared"


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the driver's file system closes."""
    path = f"{shared_folder(spark)}/cratewise-{name}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def checkpointed(df: DataFrame) -> DataFrame:
    """Writes ``df`` to the shared folder as Parquet and reads it back, so that a
    lost executor costs a file read instead of the whole lineage, and a reader of
    a few columns reads no more than those. What ``df`` observes is then known."""
    path = shared_path(df.sparkSession, "kept")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
