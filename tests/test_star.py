import datetime as dt

import pytest

from retailflow import operators as op
from retailflow.functions import to_int
from rows import AS_OF, column, row_set, sales


def cleaned(spark, *changes):
    return op.clean_sales(sales(spark, *changes), AS_OF)


@pytest.mark.parametrize("text, value", [
    ("3", 3), ("3.7", 3), ("-3.7", -3), (" 7 ", 7), ("+5", 5), (".5", 0), ("4.", 4),
    ("x", None), ("3.x", None), ("1e3", None), ("", None), (None, None),
    ("2147483647", 2147483647), ("2147483648", None), ("2147483647.9", 2147483647),
    ("99999999999.5", None),
])
def test_to_int(spark, text, value):
    df = spark.createDataFrame([(text,)], "u string")
    assert df.select(to_int("u")).first()[0] == value


def test_location_keys_differ_where_a_part_is_missing(spark):
    short = {"shipping_address": "1 Main St/Cairo"}
    missing = {"shipping_address": None}
    offline = {"is_online": "no"}
    df = cleaned(spark, {}, short, missing, offline)
    dim_keys = set(column(op.location_dim(df), "location_id"))
    fact_keys = set(column(op.fact(df), "location_id"))
    assert dim_keys == {"Cairo-Giza-12345", None, "not found-not found-not found"}
    assert fact_keys == {"Cairo-Giza-12345", "Cairo", "", "not found-not found-not found"}
    assert op.location_dim(df).count() == 4


def test_fact_types(spark):
    assert op.fact(cleaned(spark, {})).dtypes == [
        ("transaction_id", "string"), ("customer_id", "string"), ("sales_agent_id", "string"),
        ("branch_id", "string"), ("product_id", "string"), ("location_id", "string"),
        ("transaction_date", "date"), ("offer", "int"), ("is_online", "string"),
        ("units", "int"), ("unit_price", "double"), ("total_paid", "double"),
        ("Extraction_Year", "int"), ("Extraction_Month", "int"),
    ]


def test_fact_keeps_rows_with_bad_numbers(spark):
    df = op.fact(cleaned(spark, {"units": "x"}, {"unit_price": "?"}, {"units": "3.7"}))
    assert sorted(column(df, "units"), key=str) == [2, 3, None]
    assert df.count() == 3


def test_date_dim(spark):
    df = op.date_dim(cleaned(spark, {}, {"units": "9"}, {"transaction_date": "2023-13-45"}))
    rows = {r.transaction_date: tuple(r)[1:] for r in df.collect()}
    assert rows == {
        dt.date(2023, 5, 7): (7, 5, 2023, 2, "Sunday"),
        None: (None, None, None, None, None),
    }


def test_dims_are_distinct_rows(spark):
    df = cleaned(spark, {}, {"units": "3"}, {"cusomter_email": "ann@mail.comx", "units": "4"})
    assert op.customer_dim(df).count() == 1
    assert op.product_dim(df).count() == 1


def test_product_listed_under_two_names_stays_twice(spark):
    df = cleaned(spark, {}, {"product_name": "Lamp II"})
    assert row_set(op.product_dim(df)) == ["('p1', 'Lamp II', 'Home')", "('p1', 'Lamp', 'Home')"]


def test_agent_dim_keeps_the_earliest_hire(spark):
    agents = spark.createDataFrame(
        [("1", "Ann", "2016-01-01"), ("1", "Ann", "2015-01-01"), ("2", "Bob", "2017-01-01")],
        "sales_person_id string, name string, hire_date string",
    )
    assert row_set(op.agent_dim(agents)) == [
        "('1', 'Ann', '2015-01-01')", "('2', 'Bob', '2017-01-01')",
    ]


def test_branch_dim(spark):
    branches = spark.createDataFrame(
        [("1", "Cairo", "2001-01-01", "A")] * 2 + [("2", "Giza", "2002-01-01", "B")],
        "branch_id string, location string, establish_date string, class string",
    )
    assert op.branch_dim(branches).count() == 2


def test_rows_not_in_matches_nulls_and_own_copies(spark):
    schema = "id string, v int"
    current = spark.createDataFrame([(None, 1), ("a", 1)], schema)
    new = spark.createDataFrame(
        [(None, 1), ("a", 1), ("a", 2), ("b", None), ("b", None), (None, 2)], schema
    )
    assert row_set(op.rows_not_in(new, current)) == ["('a', 2)", "('b', None)", "(None, 2)"]
    assert row_set(op.rows_not_in(new, current, ["id"])) == ["('b', None)"]
