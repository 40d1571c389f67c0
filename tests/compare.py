"""Order-insensitive comparison of a Spark result with a DuckDB one."""

import datetime as dt
import decimal
import math

import duckdb

from retailflow.fixtures import TABLES

INTEGERS = {"tinyint", "smallint", "int", "bigint", "integer", "hugeint"}


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        raise TypeError("results hold no decimals")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


def duckdb_result(sql, sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    types = {d[0]: str(d[1]).lower() for d in result.description}
    return columns, types, _rows(columns, result.fetchall())


def spark_result(df):
    return df.columns, dict(df.dtypes), _rows(df.columns, df.collect())


def assert_same(df, sql, sf_dir):
    columns, types, rows = spark_result(df)
    expected_columns, expected_types, expected_rows = duckdb_result(sql, sf_dir)
    assert sorted(columns) == sorted(expected_columns)
    same_type = {"string": "varchar", "int": "integer"}
    for c in columns:
        assert same_type.get(types[c], types[c]) == expected_types[c], c
    assert len(rows) == len(expected_rows)
    for ours, theirs in zip(rows, expected_rows):
        assert ours == theirs
