"""Every registered query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = entry._TABLES
NAMES = sorted(entry.queries())


@pytest.fixture(scope="module")
def db(sf):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def test_contract():
    assert set(entry.oracle_sql()) <= set(NAMES)
    assert os.path.exists(os.path.join(os.path.dirname(entry.__file__), "bench.py"))


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf, db, name):
    found = entry.queries()[name](spark, sf)
    rows = [tuple(row) for row in found.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    answer = db.execute(sql)
    columns = [item[0] for item in answer.description]
    assert sorted(columns) == sorted(found.columns)
    assert rows_of(found.columns, rows) == rows_of(columns, answer.fetchall())
