"""Comparison of a Spark result with the same query in DuckDB."""

import datetime
import decimal
import glob
import os

import duckdb

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def connect(sf_dir: str = SF_DIR) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda index: columns[index])
    return sorted(([_plain(row[index]) for index in order] for row in rows), key=repr)


def assert_same(frame, connection, sql: str) -> int:
    result = connection.execute(sql)
    columns = [column[0] for column in result.description]
    expected = rows_of(columns, result.fetchall())
    actual = rows_of(frame.columns, [tuple(row) for row in frame.collect()])
    assert sorted(frame.columns) == sorted(columns)
    assert len(actual) == len(expected)
    for got, wanted in zip(actual, expected):
        assert got == wanted, f"{got} instead of {wanted}"
    return len(expected)
