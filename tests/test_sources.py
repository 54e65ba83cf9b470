"""Loading, header cleaning, row order, the CSV and Parquet extract, checkpoints."""

import csv
import os

import pytest
from pyspark.sql import functions as F

from cratewise.__main__ import run
from cratewise.operators import mdm
from cratewise.plans.report import build_report
from cratewise.session import checkpointed, shared_folder, shared_path
from cratewise.sources import catalog
from cratewise.sources.catalog import SourceSpec, clean_column_name, load_tables
from cratewise.sources import extract as extracts
from cratewise.sources.extract import BOM, EXTRACT_COLUMNS, read_extract, read_manifest, write_extract
from mini import CONFIG, TABLES, mini_tables


def write_csv(folder, name, headers, rows, bom=False):
    path = os.path.join(folder, f"{name}.csv")
    with open(path, "w", newline="", encoding="utf-8-sig" if bom else "utf-8") as handle:
        writer = csv.writer(handle)
        writer.writerow(headers)
        writer.writerows([["" if cell is None else cell for cell in row] for row in rows])
    return path


@pytest.fixture(scope="module")
def csv_specs(tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    specs = {}
    for position, (name, (headers, rows)) in enumerate(TABLES.items()):
        spaced = [f" {header} " for header in headers]
        path = write_csv(folder, name, spaced, rows + [[None] * len(headers)], bom=position % 2 == 0)
        specs[name] = SourceSpec(str(path))
    return specs


def test_clean_column_name():
    assert clean_column_name(" Target,\nCrates ") == "Target, Crates"
    assert clean_column_name("a  b\r") == "a b"


def test_csv_tables_give_the_same_report(spark, csv_specs):
    tables, report = load_tables(spark, csv_specs)
    assert set(report.values()) == {"loaded"}
    # The blank row is dropped, headers are stripped, the byte-order mark is gone.
    for name, (headers, rows) in TABLES.items():
        assert [c for c in tables[name].columns if c != catalog.ROW_ID] == headers
        assert tables[name].count() == len(rows)
    from_csv = build_report(tables, CONFIG, reconcile=True).final_extract.collect()
    in_memory = build_report(mini_tables(spark), CONFIG).final_extract.collect()
    assert from_csv == in_memory


def test_a_whole_run_writes_extract_and_checks(spark, csv_specs, tmp_path):
    plan = {
        "sources": {name: {"path": spec.path} for name, spec in csv_specs.items()},
        "config": {"default_target_year": 2026, "brand_rules": {"families": ["LAGER"], "display_names": {"LAGER": "Big Lager"}}},
        "extract": {"path": str(tmp_path / "extract"), "format": "csv"},
        "checks": str(tmp_path / "checks"),
        "reports": str(tmp_path / "reports"),
        "day_store": str(tmp_path / "days"),
    }
    assert set(run(spark, plan).values()) == {"loaded"}
    extract = read_extract(spark, plan["extract"]["path"])
    assert extract.filter("Brand = 'Big Lager'").count() > 0
    assert spark.read.parquet(f"{plan['checks']}/reconciliation").count() == 6
    wide, both = (spark.read.parquet(f"{plan['reports']}/{name}") for name in ("wide", "two_units"))
    assert both.count() == 2 * wide.count() and "MTD Landing vs AOP %" in wide.columns
    assert spark.read.parquet(f"{plan['reports']}/regional").count() == 2
    assert spark.read.parquet(f"{plan['day_store']}/py_shipment").agg(F.sum("row_count")).first()[0] == 3


def test_missing_sources_are_reported_and_skipped(spark, csv_specs, tmp_path):
    specs = {**csv_specs, "stock": SourceSpec(str(tmp_path / "nowhere.csv"))}
    tables, report = load_tables(spark, specs)
    assert "stock" not in tables and report["stock"].startswith("skipped")
    with pytest.raises(KeyError, match="stock"):
        build_report(tables, CONFIG)


def test_row_id_follows_file_order(spark, tmp_path):
    rows = [(f"name {i % 50}", f"value {i}") for i in range(5000)]
    path = write_csv(tmp_path, "big", ["k", "v"], rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        df = catalog.read_table(spark, SourceSpec(path))
        assert df.rdd.getNumPartitions() > 4
        kept = {row["k"]: row["v"] for row in mdm.keep_first(df, "k", ["v"]).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert kept == {f"name {i}": f"value {i}" for i in range(50)}


def test_candidates_and_aliases(spark):
    df = spark.sql("select 1 as `Dep.`, 2 as `Sales Unit`")
    assert catalog.find_col(df, ["Depletion", "Dep."], "t") == "Dep."
    assert catalog.optional_col(df, ["DV"]) is None
    with pytest.raises(KeyError, match="needs a column"):
        catalog.find_col(df, ["DV"], "t")
    ensured = catalog.ensure_columns(df, {"Dep": ["Dep Crates", "Dep."], "Zero": ["none"]}).first()
    assert (ensured["Dep"], ensured["Zero"]) == (1, 0.0)
    with pytest.raises(ValueError, match="Duplicate"):
        catalog.assert_unique_columns(spark.sql("select 1 as a, 2 as a"))


@pytest.mark.parametrize("file_format", ["csv", "parquet"])
def test_extract_round_trip(spark, tmp_path, file_format):
    extract = build_report(mini_tables(spark), CONFIG).final_extract
    path = str(tmp_path / "extract")
    write_extract(extract, path, file_format)
    write_extract(extract, path, file_format)
    found = read_extract(spark, path, file_format)
    assert found.columns == EXTRACT_COLUMNS
    key = lambda row: tuple(str(cell) for cell in row[:5])
    assert sorted(found.collect(), key=key) == sorted(extract.collect(), key=key)


@pytest.mark.parametrize("file_format", ["csv", "parquet"])
def test_a_failed_run_leaves_the_old_extract(spark, tmp_path, monkeypatch, file_format):
    extract = checkpointed(build_report(mini_tables(spark), CONFIG).final_extract)
    path = str(tmp_path / "extract")
    manifest = write_extract(extract, path, file_format)
    assert manifest["rows"] == extract.count() and read_manifest(spark, path) == manifest
    old = sorted(map(str, read_extract(spark, path, file_format, verify=True).collect()))
    breaking = extract.withColumn("Agent", F.expr("if(Agent is null, raise_error('broken'), Agent)"))
    with pytest.raises(Exception, match="broken"):
        write_extract(breaking, path, file_format)
    # A run that ends after its files are written and before they are in place.
    monkeypatch.setattr(extracts, "contents", lambda df: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        write_extract(extract.limit(1), path, file_format)
    monkeypatch.undo()
    assert sorted(map(str, read_extract(spark, path, file_format, verify=True).collect())) == old
    write_extract(extract.limit(2), path, file_format)
    assert read_extract(spark, path, file_format, verify=True).count() == 2
    part = next(p for p in (tmp_path / "extract").iterdir() if p.suffix == f".{file_format}")
    part.unlink()
    with pytest.raises(ValueError, match="manifest"):
        read_extract(spark, path, file_format, verify=True)


def test_csv_parts_open_with_a_byte_order_mark(spark, tmp_path):
    path = tmp_path / "extract"
    write_extract(build_report(mini_tables(spark), CONFIG).final_extract, str(path), "csv")
    parts = [part for part in path.iterdir() if part.suffix == ".csv"]
    assert parts
    for part in parts:
        assert part.read_text(encoding="utf-8").startswith(f"{BOM}Division,Agent,Brand,UOM,Target Type,")


def test_wrong_headers_are_refused(spark, tmp_path):
    path = write_csv(tmp_path, "wrong", ["A"] + EXTRACT_COLUMNS[1:], [["x"] * 5 + ["1"] * 40 + ["y"]])
    with pytest.raises(Exception, match="(?i)header"):
        read_extract(spark, path).collect()


def test_kept_tables_lie_in_the_shared_folder(spark):
    df = checkpointed(spark.range(10))
    assert df.count() == 10
    assert all(shared_folder(spark) in path for path in df.inputFiles())
    assert shared_path(spark, "x").startswith(shared_folder(spark))


class Session:
    """Stands in for a session with some settings."""

    def __init__(self, settings):
        self.conf = dict(settings)


def test_the_shared_folder_is_the_one_the_cluster_names():
    warehouse = {"spark.sql.warehouse.dir": "s3://warehouse/", "spark.master": "yarn"}
    assert shared_folder(Session({**warehouse, "spark.checkpoint.dir": "s3://shared"})) == "s3://shared"
    assert shared_folder(Session(warehouse)) == "s3://warehouse/_shared"
    # A warehouse on the driver's disk serves in local mode only.
    for own in ("file:/work/warehouse", "/work/warehouse"):
        assert shared_folder(Session({"spark.sql.warehouse.dir": own, "spark.master": "local[4]"})) == f"{own}/_shared"
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(Session({"spark.sql.warehouse.dir": own, "spark.master": "spark://host:7077"}))
