"""Names and values the results depend on."""

from pyspark.sql import types as T

# ---- Fixed values: they must be exactly these for the results to be right ----

OFFER_FLAGS = ["offer_1", "offer_2", "offer_3", "offer_4", "offer_5"]

DISCOUNT_RATES = [0.05, 0.10, 0.15, 0.20, 0.25]

NULL_DEFAULTS = {
    "sales_agent_id": "0",
    "branch_id": "0",
    "shipping_address": "not available",
    "source": "not found",
    "logs": "not found",
}

MISSING_PLACE = "not found"

TRANSACTION_DATE_FORMAT = "yyyy-M-d"

# int(1.5 * 365) + 1
DAYS_BACK = 548

EXTRACTION_PARTITIONS = ["Extraction_Year", "Extraction_Month"]

WIDE_TABLE_BUCKETS = 8

COMPACTED_FILES = 2

# Landing file name without the `_<HH>.csv` ending, by entity.
LANDING_FILES = {
    "sales_transactions": "sales_transactions_SS_raw_*",
    "branches": "branches*",
    "sales_agents": "sales_agents*",
}

EVENT_SCHEMA = T.StructType([
    T.StructField("eventType", T.StringType()),
    T.StructField("customerId", T.StringType()),
    T.StructField("productId", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("totalAmount", T.DoubleType()),
    T.StructField("paymentMethod", T.StringType()),
    T.StructField("recommendedProductId", T.StringType()),
    T.StructField("algorithm", T.StringType()),
    T.StructField("metadata", T.StructType([
        T.StructField("category", T.StringType()),
        T.StructField("source", T.StringType()),
    ])),
])

# ---- End of fixed values ----

# Compaction by default: about the size of a file.
COMPACTED_BYTES = 512 << 20

# Runs of one month are told apart by these in tables that keep their history.
RUN_PARTITIONS = ["extraction_date", "Extraction_Hour"]
