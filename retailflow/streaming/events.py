"""Shop events from JSON text. All steps are row-wise and serve batch and stream."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailflow.constants import EVENT_SCHEMA


def flatten(df: DataFrame, col: str) -> DataFrame:
    return df.select(f"{col}.*")


def parse_events(df: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """Decode the `value` column; malformed text gives a row of NULLs."""
    data = F.from_json(F.col("value").cast("string"), schema)
    return df.select(data.alias("data")).transform(flatten, "data")


def normalise_events(df: DataFrame) -> DataFrame:
    """Keep a field only for the event types that own it, else its default.

    An event of the right type without the field keeps its NULL.
    """
    kind = F.col("eventType")
    purchase = kind == "purchase"
    clicked = kind == "recommendationClick"

    def kept(condition, name, default):
        return F.when(condition, F.col(name)).otherwise(default)

    return df.withColumns({
        "quantity": kept(purchase | (kind == "addToCart"), "quantity", 0),
        "totalAmount": kept(purchase, "totalAmount", 0.0),
        "paymentMethod": kept(purchase, "paymentMethod", "Unknown"),
        "recommendedProductId": kept(clicked, "recommendedProductId", "None"),
        "algorithm": kept(clicked, "algorithm", "None"),
    })


def with_event_time(df: DataFrame) -> DataFrame:
    """`timestamp` as a timestamp, its date, and its hour as two digits.

    The text has no zone; it is read in the zone of the session.
    """
    return df.withColumn("timestamp", F.col("timestamp").try_cast("timestamp")).withColumns({
        "date": F.to_date("timestamp"),
        "hour": F.date_format("timestamp", "HH"),
    })


def shape_events(df: DataFrame) -> DataFrame:
    """JSON `value` rows to the normalised events that are stored."""
    return df.transform(parse_events).transform(normalise_events).transform(with_event_time)
