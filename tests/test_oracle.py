"""Every registered query against its SQL on a second engine."""

import datetime

import duckdb
import pytest

import __spark_entry__ as entry_point
from workload.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return connection


def comparable(cell):
    if isinstance(cell, (bool, str, datetime.date)) or cell is None:
        return str(cell)
    return repr(float(cell))


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(comparable(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query_matches_sql(spark, folder, duck, name):
    found = entry_point.queries()[name](spark, folder)
    expected = duck.execute(entry_point.oracle_sql()[name])
    columns = [column[0] for column in expected.description]
    assert table_of(found.columns, [tuple(row) for row in found.collect()]) == table_of(columns, expected.fetchall())


def test_every_query_of_the_report_has_sql():
    assert set(QUERIES) <= set(entry_point.oracle_sql())


def test_round_trip_keeps_the_extract(spark, folder):
    queries = entry_point.queries()
    again, extract = queries["extract_csv_roundtrip"](spark, folder), queries["final_extract"](spark, folder)
    assert again.columns == extract.columns
    assert sorted(map(str, again.collect())) == sorted(map(str, extract.collect()))


def test_entry_is_the_extract(spark):
    assert len(entry_point.entry(spark).columns) == 46
