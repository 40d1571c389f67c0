"""Hourly batch: landing CSV to the star schema, and the reports on it."""

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailflow import operators as op
from retailflow import sources as src
from retailflow.constants import WIDE_TABLE_BUCKETS


@dataclass(frozen=True)
class HourlyTables:
    """Table names in one database."""

    database: str

    def _in(self, table: str) -> str:
        return f"{self.database}.{table}"

    @property
    def wide(self) -> str:
        return self._in("transactions_table")

    @property
    def fact(self) -> str:
        return self._in("transaction_facttable")

    @property
    def customer(self) -> str:
        return self._in("customer1_dim")

    @property
    def product(self) -> str:
        return self._in("product1_dim")

    @property
    def location(self) -> str:
        return self._in("location1_dim")

    @property
    def date(self) -> str:
        return self._in("date1_dim")


def run_hourly(
    spark: SparkSession,
    base: str,
    database: str,
    as_of: date | str,
    hour: int | str,
    buckets: int = WIDE_TABLE_BUCKETS,
    keep_history: bool = True,
) -> HourlyTables:
    """Clean one hour of sales and load it.

    The clean-up shuffle runs once, for the wide table. The star schema is then
    built from the rows of this run in that table, each dimension scanning its own
    columns. Loading an hour again replaces what it loaded before. Customers and
    products have one row per key, the first loaded. The run is marked as whole after the
    last table; until then `committed` reads leave it out.

    Without `keep_history` the wide table holds this run only and facts are
    appended as they come.
    """
    tables = HourlyTables(database)
    src.ensure_database(spark, database)
    raw = src.read_landing(spark, base, "sales_transactions", as_of, hour)
    cleaned = op.clean_sales(raw, as_of, op.dedup_spread)
    if keep_history:
        src.open_run(spark, database, as_of, hour)
        src.load_wide_run(cleaned, tables.wide, as_of, hour, buckets, gather=False)
        this_run = (F.col("extraction_date") == F.lit(as_of).cast("date")) & (
            F.col("Extraction_Hour") == int(hour)
        )
        wide = spark.table(tables.wide).where(this_run)
    else:
        src.write_wide_table(cleaned, tables.wide, buckets, gather=False)
        wide = spark.table(tables.wide)

    src.load_dim(op.customer_dim(wide), tables.customer, ["customer_id"])
    src.load_dim(op.product_dim(wide), tables.product, ["product_id"])
    src.load_dim(op.location_dim(wide), tables.location)
    src.load_dim(op.date_dim(wide), tables.date)
    if keep_history:
        src.load_fact_run(op.fact(wide), tables.fact, as_of, hour)
        src.commit_run(spark, database, as_of, hour)
    else:
        src.append_fact(op.fact(wide), tables.fact)
    return tables


def hourly_reports(spark: SparkSession, tables: HourlyTables) -> dict[str, DataFrame]:
    """The reports over all whole runs."""
    fact = src.committed(spark, tables.fact)
    product = src.one_per_key(spark, tables.product, ["product_id"])
    location = src.one_per_key(spark, tables.location)
    return {
        "top_products": op.top_products(fact, product),
        "offer_redemptions": op.offer_redemptions(fact),
        "best_offer_per_product": op.best_offer_per_product(fact, product),
        "lowest_online_cities": op.lowest_online_cities(fact, location),
    }


def landing_profile(raw: DataFrame) -> dict[str, DataFrame]:
    """What the raw sales of an hour look like before they are cleaned."""
    return {
        "row_count": op.row_count(raw),
        "null_profile": op.null_profile(raw),
        "duplicate_count": op.duplicate_count(op.fill_defaults(raw)),
    }


def wide_profile(wide: DataFrame) -> dict[str, DataFrame]:
    """Run periods and partition sizes of the cleaned table."""
    return {
        "distinct_extraction_periods": op.distinct_count(
            wide, "Extraction_Year", "Extraction_Month"
        ),
        "rows_per_month": op.group_counts(wide, ["Extraction_Month"]),
        "partition_sizes": op.partition_sizes(wide),
        "partition_profile": op.partition_profile(wide, "Extraction_Month"),
    }
