"""Source catalog: load tables, clean headers, resolve columns by spelling."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratewise.config import FACT_ROLES, KEEP_FIRST_TABLES, REQUIRED_TABLES, VIEWS
from cratewise.functions.sql import number, quoted
from cratewise.sources.footers import FileBounds

ROW_ID = "_row_id"
FACT_SOURCE = "fact_source"
# Lineage label per fact table.
FACT_LABELS = {
    "actual_shipment": "Actual Shipment",
    "py_shipment": "PY Shipment",
    "ytd_depletion": "YTD Depletion",
    "py_depletion": "PY Depletion",
    "stock": "Stock",
    "aop_target": "AOP Target",
    "sales_target": "Sales Target",
    "snop_target": "SNOP Target",
}


@dataclass(frozen=True)
class SourceSpec:
    """Where a logical table lives. CSV is read as text with a header row."""

    path: str
    format: str = "csv"
    options: Mapping[str, str] = field(default_factory=dict)


def clean_column_name(name: str) -> str:
    return str(name).strip().replace("\n", " ").replace("\r", " ").replace("  ", " ")


def clean_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_column_name(name) for name in df.columns])


def tells_files(df: DataFrame) -> bool:
    """Whether the source says which file a row comes from."""
    try:
        df.select("_metadata.file_path")
        return True
    except AnalysisException:
        return False


def with_row_id(df: DataFrame, *, from_files: bool) -> DataFrame:
    """Adds a sortable id that follows the order of rows in the source files.

    Sources without files have no order of their own: there the order is that of
    the partitions as Spark reads them.
    """
    parts = [F.monotonically_increasing_id().alias("row")]
    if from_files:
        parts = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start")] + parts
    return df.withColumn(ROW_ID, F.struct(*parts))


def without_blank_rows(df: DataFrame, name: str | None) -> DataFrame:
    """Drops rows that hold nothing.

    Of a volume fact only the role columns are looked at, in a condition that
    file formats can test themselves, so that a scan reads no other column.
    """
    roles = [optional_col(df, spellings) for spellings in FACT_ROLES.get(name, ())]
    if not any(roles):
        return df.na.drop("all", subset=[c for c in df.columns if c != ROW_ID])
    held = [f"{quoted(column)} is not null" for column in dict.fromkeys(filter(None, roles))]
    return df.filter(" or ".join(held))


def read_table(spark: SparkSession, spec: SourceSpec, name: str | None = None) -> DataFrame:
    """One table under clean headers; with row ids where the order of rows counts (or the table isn't named)."""
    reader = spark.read.format(spec.format)
    if spec.format == "csv":
        reader = reader.option("header", "true").option("inferSchema", "false")
    reader = reader.options(**dict(spec.options))
    df = reader.load(spec.path) if spec.path else reader.load()
    if name is None or name in KEEP_FIRST_TABLES:
        df = with_row_id(df, from_files=tells_files(df))
    return without_blank_rows(clean_columns(df), name)


class LoadedTables(dict):
    """Tables by name, and the bounds of their columns as far as the files tell them."""

    def __init__(self, bounds: FileBounds):
        super().__init__()
        self.bounds = bounds


def load_tables(spark: SparkSession, specs: Mapping[str, SourceSpec]) -> tuple[LoadedTables, dict[str, str]]:
    """Loads every table that can be loaded; the report maps each name to
    ``"loaded"`` or to the reason it was skipped."""
    paths = {name: spec.path for name, spec in specs.items() if spec.format == "parquet" and not spec.options}
    tables = LoadedTables(FileBounds(spark, paths))
    report: dict[str, str] = {}
    for name, spec in specs.items():
        try:
            tables[name] = read_table(spark, spec, name)
            report[name] = "loaded"
        except AnalysisException as error:
            report[name] = f"skipped: {str(error).splitlines()[0]}"
    return tables, report


def require_tables(tables: Mapping[str, DataFrame]) -> None:
    missing = [name for name in REQUIRED_TABLES if name not in tables]
    if missing:
        raise KeyError(f"No data for the tables {missing}; name a readable source for each of them.")


def tag_sources(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Adds the lineage label to every fact table."""
    return {
        name: df.withColumn(FACT_SOURCE, F.lit(FACT_LABELS[name])) if name in FACT_LABELS else df
        for name, df in tables.items()
    }


def register_views(tables: Mapping[str, DataFrame]) -> list[str]:
    """Registers the raw star schema as temporary views."""
    names = [VIEWS.get(name, name) for name in tables]
    for view, df in zip(names, tables.values(), strict=True):
        df.createOrReplaceTempView(view)
    return names


def find_col(df: DataFrame, candidates: Iterable[str], table: str) -> str:
    """First candidate header that is present."""
    candidates = list(candidates)
    found = optional_col(df, candidates)
    if found is None:
        raise KeyError(f"Table {table} needs a column under one of the headers {candidates}; it has {df.columns}.")
    return found


def optional_col(df: DataFrame, candidates: Iterable[str]) -> str | None:
    present = set(df.columns)
    return next((name for name in candidates if name in present), None)


def type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def assert_unique_columns(df: DataFrame) -> DataFrame:
    repeated = sorted({name for name in df.columns if df.columns.count(name) > 1})
    if repeated:
        raise ValueError(f"Duplicate output columns: {repeated}")
    return df


def ensure_columns(df: DataFrame, aliases: Mapping[str, Iterable[str]], default: float = 0.0) -> DataFrame:
    """Adds each missing column as a copy of its first present alias, else a constant."""
    added = []
    for name, candidates in aliases.items():
        if name not in df.columns:
            source = optional_col(df, candidates)
            added.append(f"{quoted(source) if source else number(default)} as {quoted(name)}")
    return df.selectExpr("*", *added) if added else df
