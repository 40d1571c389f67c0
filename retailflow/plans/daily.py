"""Daily batch: units by agent and product, dumped as CSV."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from retailflow import operators as op
from retailflow import sources as src


def daily_report(sales: DataFrame, agents: DataFrame) -> DataFrame:
    """Report on the wide table and the agents as landed, copies included."""
    return op.agent_product_units(sales, op.agent_dim(agents))


def run_daily(
    spark: SparkSession,
    wide_table: str,
    agents_base: str,
    agents_day: date | str,
    out: str,
    as_of: date | str,
    mode: str = "error",
) -> str:
    """Write the report over all whole runs kept in the wide table; returns its folder, named by date."""
    agents = src.read_landing(spark, agents_base, "sales_agents", agents_day)
    path = f"{out.rstrip('/')}/{as_of}"
    src.dump_csv(daily_report(src.committed(spark, wide_table), agents), path, mode)
    return path
