"""Fact and dimensions of the sales star schema."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailflow.functions import fact_location_key, location_key, to_double, to_int
from retailflow.operators.quality import dedup_by_key


def customer_dim(df: DataFrame) -> DataFrame:
    return df.select(
        "customer_id", "customer_fname", "cusomter_lname", "cusomter_email"
    ).distinct()


def product_dim(df: DataFrame) -> DataFrame:
    return df.select("product_id", "product_name", "product_category").distinct()


def location_dim(df: DataFrame) -> DataFrame:
    """Places; the key is added after the distinct, which needs only the parts."""
    places = df.select("city", "state", "postal_code").distinct()
    return places.select(location_key().alias("location_id"), "city", "state", "postal_code")


def date_dim(df: DataFrame) -> DataFrame:
    """Calendar of the sale dates, its fields computed once per date."""
    day = F.col("transaction_date")
    return df.select(day).distinct().select(
        day,
        F.dayofmonth(day).alias("day"),
        F.month(day).alias("month"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.date_format(day, "EEEE").alias("day_name"),
    )


def agent_dim(df: DataFrame) -> DataFrame:
    """One row per sales person, the earliest hire."""
    agents = df.select("sales_person_id", "name", "hire_date")
    return dedup_by_key(agents, ["sales_person_id"], ["hire_date"])


def branch_dim(df: DataFrame) -> DataFrame:
    return df.select("branch_id", "location", "establish_date", "class").distinct()


def fact(df: DataFrame) -> DataFrame:
    return df.select(
        "transaction_id",
        "customer_id",
        "sales_agent_id",
        "branch_id",
        "product_id",
        fact_location_key().alias("location_id"),
        "transaction_date",
        "offer",
        "is_online",
        to_int("units").alias("units"),
        to_double("unit_price").alias("unit_price"),
        "total_paid",
        "Extraction_Year",
        "Extraction_Month",
    )


def rows_not_in(new: DataFrame, current: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The distinct rows of `new` whose key `current` does not hold yet.

    Without `keys` the whole row is the key. NULLs match NULLs, so a dimension
    row with a NULL key is not added a second time either.

    `current` is first cut down to what `new` asks about. A load is small beside
    the table it goes into, so Spark can broadcast the load for that step (an
    anti join alone could only broadcast the table) and the table is scanned
    without a shuffle.
    """
    if keys is None:
        keys = current.columns
        candidates = new.select(*keys).distinct()
    else:
        candidates = dedup_by_key(new, keys)
    asked = candidates.select(*[F.col(k).alias(f"_asked_{k}") for k in keys])
    known = current.select(*keys).join(asked, _same_key(keys, "_asked_"), "left_semi")
    known = known.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
    return candidates.join(known, _same_key(keys, "_known_"), "left_anti")


def _same_key(keys: list[str], prefix: str) -> Column:
    return reduce(and_, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])
