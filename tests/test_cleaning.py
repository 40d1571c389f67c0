import datetime as dt

import pytest

from retailflow import operators as op
from rows import AS_OF, column, row_set, sales


def test_defaults_fill_only_columns_that_exist(spark):
    gaps = {"sales_agent_id": None, "branch_id": None, "shipping_address": None}
    row = op.fill_defaults(sales(spark, gaps)).first()
    assert (row.sales_agent_id, row.branch_id, row.shipping_address) == (
        "0", "0", "not available",
    )
    assert not {"source", "logs"} & set(row.asDict())


def test_defaults_fill_optional_columns(spark):
    df = sales(spark, {"source": None, "logs": None}, {"source": "web"}, columns=["source", "logs"])
    assert column(op.fill_defaults(df), "source") == ["not found", "web"]
    assert column(op.fill_defaults(df), "logs") == ["not found", "not found"]


def test_defaults_leave_other_nulls(spark):
    row = op.fill_defaults(sales(spark, {"customer_id": None, "offer_1": None})).first()
    assert row.customer_id is None and row.offer_1 is None


@pytest.mark.parametrize("text, rate, code", [
    ("True", 0.05, 1),
    ("true", 0.05, None),
    ("1", 0.05, None),
    ("yes", 0.05, None),
    ("t", 0.05, None),
    ("y", 0.05, None),
    (" true ", 0.05, None),
    ("False", 0.0, None),
    ("maybe", 0.0, None),
    (None, 0.0, None),
])
def test_discount_and_offer_code_read_flags_differently(spark, text, rate, code):
    row = (
        sales(spark, {"offer_1": text})
        .transform(op.with_discount).transform(op.with_offer_code).first()
    )
    assert (row.discounts, row.offer) == (rate, code)


@pytest.mark.parametrize("n, rate", [(1, 0.05), (2, 0.10), (3, 0.15), (4, 0.20), (5, 0.25)])
def test_first_flag_wins(spark, n, rate):
    flags = {f"offer_{i}": "True" for i in range(n, 6)}
    df = sales(spark, flags).transform(op.with_discount).transform(op.with_offer_code)
    assert (df.first().discounts, df.first().offer) == (rate, n)
    assert not [c for c in df.columns if c.startswith("offer_")]


def test_discount_and_code_may_come_from_different_flags(spark):
    df = sales(spark, {"offer_2": "1", "offer_4": "True"})
    row = df.transform(op.with_discount).transform(op.with_offer_code).first()
    assert (row.discounts, row.offer) == (0.10, 4)


@pytest.mark.parametrize("online, address, parts", [
    ("yes", "1 Main St/Cairo/Giza/12345", ("Cairo", "Giza", "12345")),
    ("yes", "1 Main St/Cairo", ("Cairo", None, None)),
    ("yes", "not available", (None, None, None)),
    ("yes", None, (None, None, None)),
    ("yes", "a//c/d/e", ("", "c", "d")),
    ("no", "1 Main St/Cairo/Giza/12345", ("not found",) * 3),
    ("Yes", "1 Main St/Cairo/Giza/12345", ("not found",) * 3),
    (None, "1 Main St/Cairo/Giza/12345", ("not found",) * 3),
])
def test_address_parts(spark, online, address, parts):
    row = op.with_address_parts(
        sales(spark, {"is_online": online, "shipping_address": address})
    ).first()
    assert (row.city, row.state, row.postal_code) == parts


@pytest.mark.parametrize("units, price, paid", [
    ("2", "10.5", 21.0 - 21.0 * 0.05),
    ("3.7", "10", 37.0 - 37.0 * 0.05),
    (" 2 ", "10.5", 21.0 - 21.0 * 0.05),
    ("x", "10.5", None),
    ("2", "", None),
    (None, "10.5", None),
])
def test_total_paid(spark, units, price, paid):
    df = sales(spark, {"units": units, "unit_price": price, "offer_1": "True"})
    assert column(df.transform(op.with_discount).transform(op.with_total_paid), "total_paid") == [
        paid
    ]


@pytest.mark.parametrize("email, cleaned", [
    ("a@mail.com", "a@mail.com"),
    ("a@mail.comx9", "a@mail.com"),
    ("a@mail.com.com/", "a@mail.com"),
    ("a@b.company.com", "a@b.com"),
    ("a@b.COMx", "a@b.COMx"),
    ("a@b.org", "a@b.org"),
    (None, None),
])
def test_email_is_cut_after_the_first_com(spark, email, cleaned):
    assert column(op.clean_email(sales(spark, {"cusomter_email": email})), "cusomter_email") == [
        cleaned
    ]


@pytest.mark.parametrize("text, day", [
    ("2023-5-7", dt.date(2023, 5, 7)),
    ("2023-05-07", dt.date(2023, 5, 7)),
    ("2023-13-45", None),
    ("7/5/2023", None),
    (None, None),
])
def test_dates(spark, text, day):
    row = op.with_dates(sales(spark, {"transaction_date": text}), AS_OF).first()
    assert row.transaction_date == day
    assert row.extraction_date == dt.date(2024, 2, 3)
    assert (row.Extraction_Year, row.Extraction_Month) == (2024, 2)


def test_copies_are_removed_after_defaults_are_filled(spark):
    df = sales(spark, {"sales_agent_id": None}, {"sales_agent_id": "0"}, {}, {})
    assert sorted(column(op.clean_sales(df, AS_OF), "sales_agent_id")) == ["0", "7"]


def test_copies_differing_in_any_column_stay(spark):
    df = sales(spark, {}, {"offer_5": "false"}, {"cusomter_email": "ann@mail.comx"})
    cleaned = op.clean_sales(df, AS_OF)
    assert cleaned.count() == 3
    assert cleaned.distinct().count() == 1


def test_clean_sales_schema(spark):
    assert op.clean_sales(sales(spark, {}), AS_OF).dtypes == [
        ("transaction_id", "string"), ("customer_id", "string"), ("customer_fname", "string"),
        ("cusomter_lname", "string"), ("cusomter_email", "string"),
        ("sales_agent_id", "string"), ("branch_id", "string"), ("product_id", "string"),
        ("product_name", "string"), ("product_category", "string"), ("units", "string"),
        ("unit_price", "string"), ("is_online", "string"), ("shipping_address", "string"),
        ("transaction_date", "date"), ("discounts", "double"), ("offer", "int"),
        ("city", "string"), ("state", "string"), ("postal_code", "string"),
        ("total_paid", "double"), ("extraction_date", "date"), ("Extraction_Year", "int"),
        ("Extraction_Month", "int"),
    ]


def test_derived_rows_made_distinct_equal_cleaned_rows_made_distinct(spark):
    df = sales(spark, {}, {}, {"sales_agent_id": None}, {"sales_agent_id": "0"}, {"units": "x"})
    derived = df.transform(op.fill_defaults).transform(op.derive_sales, AS_OF)
    assert row_set(derived.distinct()) == row_set(op.clean_sales(df, AS_OF).distinct())
