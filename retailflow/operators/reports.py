"""Reports over the star schema, the wide sales table and the shop events.

Facts are summed by their own key before they meet a dimension. What is joined
then has one row per key, however often a key was sold, and the sums over a
dimension that lists a key twice are still the same as those of a plain join.
"""

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailflow.constants import DAYS_BACK
from retailflow.functions import amount_parts, amount_total, offer_label, to_double


def top_products(fact: DataFrame, product: DataFrame, n: int = 10) -> DataFrame:
    """The `n` product names with the most units sold."""
    sold = fact.groupBy("product_id").agg(F.sum("units").alias("units"))
    return (
        sold.join(product.select("product_id", "product_name"), "product_id")
        .groupBy("product_name")
        .agg(F.sum("units").alias("total_sold_units"))
        .orderBy(F.desc("total_sold_units"), "product_name")
        .limit(n)
    )


def offer_redemptions(fact: DataFrame, n: int = 5) -> DataFrame:
    """How often each offer was used, the `n` most used first."""
    return (
        fact.filter(F.col("offer").isNotNull())
        .groupBy("offer")
        .agg(F.count("*").alias("total_redeemed"))
        .orderBy(F.desc("total_redeemed"), "offer")
        .limit(n)
        .select(offer_label("offer").alias("offer"), "total_redeemed")
    )


def best_offer_per_product(fact: DataFrame, product: DataFrame) -> DataFrame:
    """The most used offer of every product; the lower offer wins a tie."""
    used = (
        fact.filter(F.col("offer").isNotNull())
        .groupBy("product_id", "offer")
        .agg(F.count("*").alias("total_redeemed"))
    )
    most_used = Window.partitionBy("product_id").orderBy(F.desc("total_redeemed"), "offer")
    return (
        used.withColumn("rank", F.row_number().over(most_used))
        .filter(F.col("rank") == 1)
        .join(product.select("product_id", "product_name"), "product_id")
        .select(
            "product_name",
            offer_label("offer", "other_offer").alias("most_redeemed_offer"),
            "total_redeemed",
        )
        .orderBy(F.desc("total_redeemed"), "product_name")
    )


def lowest_online_cities(fact: DataFrame, location: DataFrame, n: int = 10) -> DataFrame:
    """The `n` cities with the lowest online sales."""
    exact, rest = amount_parts("total_paid")
    paid = (
        fact.filter(F.col("is_online") == "yes")
        .groupBy("location_id")
        .agg(F.sum(exact).alias("exact"), F.sum(rest).alias("rest"))
    )
    by_city = (
        paid.join(location.select("location_id", "city"), "location_id")
        .groupBy("city")
        .agg(F.sum("exact").alias("exact"), F.sum("rest").alias("rest"))
    )
    # Cents are rounded on the decimal where there is nothing else to add.
    sales = F.when(
        F.col("rest").isNull(), F.round("exact", 2).cast("double")
    ).otherwise(F.round(amount_total(F.col("exact"), F.col("rest")), 2))
    return (
        by_city.select("city", sales.alias("online_sales"))
        .orderBy("online_sales", "city")
        .limit(n)
    )


def join_agents(sales: DataFrame, agents: DataFrame) -> DataFrame:
    """Every sale with its agent; sales without a known agent drop out.

    One agent may hold a large share of the sales. Few agents are broadcast
    (Spark decides by their size); with many, adaptive execution splits the sales
    of a hot agent over several tasks.
    """
    same = F.col("sales_agent_id") == F.col("sales_person_id")
    return sales.join(agents, same).select(*sales.columns, *agents.columns)


def agent_product_units(sales: DataFrame, agents: DataFrame) -> DataFrame:
    """Units sold by agent name and product name.

    `units` is text in the wide table and is summed as a double.
    """
    sold = sales.groupBy("sales_agent_id", "product_name").agg(
        F.sum(to_double("units")).alias("units")
    )
    return (
        sold.join(
            agents.select("sales_person_id", "name"),
            F.col("sales_agent_id") == F.col("sales_person_id"),
        )
        .groupBy("name", "product_name")
        .agg(F.sum("units").alias("total_sold_units"))
    )


def _day_before(as_of: date | str, days: int) -> Column:
    return F.date_sub(F.lit(as_of).cast("date"), days)


def sold_on(df: DataFrame, as_of: date | str, days_back: int = DAYS_BACK) -> DataFrame:
    """Sales of exactly the day `days_back` days before `as_of`."""
    return df.filter(F.col("transaction_date") == _day_before(as_of, days_back))


def sold_since(df: DataFrame, as_of: date | str, days_back: int = DAYS_BACK) -> DataFrame:
    """Sales of that day and later."""
    return df.filter(F.col("transaction_date") >= _day_before(as_of, days_back))


def avg_amount_by_method(events: DataFrame) -> DataFrame:
    """Mean amount per payment method, over every event that has an amount."""
    exact, rest = amount_parts("totalAmount")
    sums = events.groupBy("paymentMethod").agg(
        F.sum(exact).alias("exact"),
        F.sum(rest).alias("rest"),
        F.count("totalAmount").alias("n"),
    )
    mean = F.try_divide(amount_total(F.col("exact"), F.col("rest")), F.col("n"))
    return sums.select("paymentMethod", mean.alias("avg_total_amount"))


def events_by_type(events: DataFrame) -> DataFrame:
    return events.groupBy("eventType").agg(F.count("*").alias("count"))
