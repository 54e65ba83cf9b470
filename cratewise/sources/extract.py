"""The fixed-schema extract: write it, read it back.

An extract is written beside its place, read once as a reader would, described in
a manifest and only then put in place, so that a run that fails leaves the old one.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratewise.sources.catalog import ensure_columns

PERIODS = ("Last Day", "WTD", "MTD", "YTD")
KEYS = ("Division", "Agent", "Brand", "UOM", "Target Type")
BOM = chr(0xFEFF)


def period_columns(period: str) -> list[str]:
    """The nine columns of one period, in extract order."""
    volume = period.replace(" ", "_")
    sales_vs_py = "YTD VS PY Ach" if period == "YTD" else f"{period} Sales vs PY"
    return [
        f"{volume}_Sales",
        f"{volume}_Target",
        f"{period} Ach",
        f"{volume}_PY",
        sales_vs_py,
        f"{volume}_Depletion",
        f"{period} Depletion Ach",
        f"{volume}_Depletion_PY",
        f"{period} Depletion vs PY",
    ]


STOCK_COLUMNS = ("Beginning_Stock", "Stock_per_Agent", "Avg_Daily_Depletion", "Days of Stock")
FLAG = "Stock Level Flag"
EXTRACT_COLUMNS = (
    list(KEYS) + [name for period in PERIODS for name in period_columns(period)] + list(STOCK_COLUMNS) + [FLAG]
)
EXTRACT_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType() if name in KEYS + (FLAG,) else T.DoubleType()) for name in EXTRACT_COLUMNS]
)


# Hidden from readers of the folder by its first character.
MANIFEST = "_manifest.json"


# Other headers that a column of an extract may have.
ALIASES = {"Beginning_Stock": ("Opening_Stock", "Carried_Stock"), "Stock_per_Agent": ("Stock_Balance",)}


def completed(df: DataFrame) -> DataFrame:
    """A frame in the schema of the extract: a volume that it lacks is copied from its alias, or zero."""
    wanted = {f.name: ALIASES.get(f.name, ()) for f in EXTRACT_SCHEMA.fields if isinstance(f.dataType, T.DoubleType)}
    whole = ensure_columns(df, wanted)
    return whole.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in EXTRACT_SCHEMA.fields])


def write_extract(df: DataFrame, path: str, file_format: str = "parquet", bom: bool = True) -> dict:
    """Replaces ``path`` by the extract, one file per sorted partition, and returns its manifest.

    CSV parts each carry the header, opened by a byte-order mark if asked.
    """
    if file_format not in ("parquet", "csv"):
        raise ValueError("file_format must be 'parquet' or 'csv'")
    spark, path = df.sparkSession, path.rstrip("/")
    staging = f"{path}.staging-{uuid.uuid4().hex}"
    df = df.select(*[f"`{name}`" for name in EXTRACT_COLUMNS])
    if file_format == "parquet":
        df.write.parquet(staging)
    else:
        headed = df.withColumnRenamed(KEYS[0], BOM + KEYS[0]) if bom else df
        headed.write.option("encoding", "UTF-8").csv(staging, header=True)
    manifest = {"format": file_format, "columns": EXTRACT_COLUMNS, **contents(read_extract(spark, staging, file_format))}
    publish(spark, staging, path, manifest)
    return manifest


def contents(extract: DataFrame) -> dict:
    """Number of rows, and a sum over a hash of each that doesn't depend on their order."""
    digest = F.sum(F.xxhash64(*[F.col(f"`{name}`") for name in extract.columns]).cast("decimal(38,0)"))
    row = extract.agg(F.count("*").alias("rows"), digest.alias("digest")).first()
    return {"rows": row["rows"], "checksum": str(row["digest"] or 0)}


def publish(spark: SparkSession, staging: str, path: str, manifest: dict) -> None:
    """Puts a finished folder with its manifest in the place of ``path``; the old one comes back where that fails."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    new, place, old = (hadoop.Path(p) for p in (staging, path, f"{staging}.replaced"))
    files = new.getFileSystem(conf)
    out = files.create(hadoop.Path(f"{staging}/{MANIFEST}"))
    out.write(bytearray(json.dumps(manifest, indent=1), "utf-8"))
    out.close()
    replaces = files.exists(place)
    if replaces and not files.rename(place, old):
        raise OSError(f"The extract at {path} can't be moved aside; the new one lies at {staging}.")
    if not files.rename(new, place):
        if replaces:
            files.rename(old, place)
        raise OSError(f"The new extract can't be moved to {path}; it lies at {staging}.")
    if replaces:
        files.delete(old, True)


def read_manifest(spark: SparkSession, path: str) -> dict:
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{MANIFEST}")
    stream = at.getFileSystem(spark._jsc.hadoopConfiguration()).open(at)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def read_extract(spark: SparkSession, path: str, file_format: str = "csv", verify: bool = False) -> DataFrame:
    """Reads an extract with its fixed schema; CSV headers are checked against it.

    ``verify`` compares rows and checksum with the manifest and raises where they differ.
    """
    if file_format == "parquet":
        extract = spark.read.schema(EXTRACT_SCHEMA).parquet(path)
    else:
        extract = spark.read.schema(EXTRACT_SCHEMA).option("enforceSchema", "false").csv(path, header=True)
    if verify:
        manifest, found = read_manifest(spark, path), contents(extract)
        if any(manifest[name] != value for name, value in found.items()):
            raise ValueError(f"The extract at {path} isn't the one its manifest describes: {found}.")
    return extract
