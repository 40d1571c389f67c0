"""Hand-made raw rows."""

SALE = {
    "transaction_id": "t1",
    "customer_id": "c1",
    "customer_fname": "Ann",
    "cusomter_lname": "Lee",
    "cusomter_email": "ann@mail.com",
    "sales_agent_id": "7",
    "branch_id": "3",
    "product_id": "p1",
    "product_name": "Lamp",
    "product_category": "Home",
    "offer_1": "False",
    "offer_2": "False",
    "offer_3": "False",
    "offer_4": "False",
    "offer_5": "False",
    "units": "2",
    "unit_price": "10.5",
    "is_online": "yes",
    "shipping_address": "1 Main St/Cairo/Giza/12345",
    "transaction_date": "2023-5-7",
}

AS_OF = "2024-02-03"


def sale(**changes):
    return {**SALE, **changes}


def sales(spark, *changes, columns=()):
    """One raw sale per dict of changes; all columns are text."""
    names = list(SALE) + list(columns)
    rows = [tuple(sale(**c).get(n) for n in names) for c in changes]
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))


def column(df, name):
    return [r[0] for r in df.select(name).collect()]


def row_set(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))
