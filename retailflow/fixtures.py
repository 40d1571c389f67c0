"""The test tables in the shape of the raw inputs.

Each mapping is one SQL text that Spark and DuckDB both run, so the two sides of
a check start from the same rows. Only the date patterns differ.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailflow.sources.compaction import hadoop_path

AS_OF = "2000-06-30"
LATER_RUN = "2001-01-15"

SPARK_DIALECT = {
    "order_day": "date_format(o_orderdate, 'yyyy-M-d')",
    "event_second": """date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")""",
    "hire_date": "cast(date_add(date '2015-01-01', cast(s_suppkey % 2000 as int)) as string)",
    "hire_date_later": (
        "cast(date_add(date '2015-01-01', cast(s_suppkey % 2000 + 365 as int)) as string)"
    ),
    "establish_date": "cast(date_add(date '2000-01-01', n_nationkey * 30) as string)",
}

DUCKDB_DIALECT = {
    "order_day": "strftime(o_orderdate, '%Y-%-m-%-d')",
    "event_second": "strftime(ts, '%Y-%m-%dT%H:%M:%S')",
    "hire_date": "cast(date '2015-01-01' + cast(s_suppkey % 2000 as int) as varchar)",
    "hire_date_later": (
        "cast(date '2015-01-01' + cast(s_suppkey % 2000 + 365 as int) as varchar)"
    ),
    "establish_date": "cast(date '2000-01-01' + n_nationkey * 30 as varchar)",
}

# Every column is text, as in the landed CSV. Sales of every 50th order arrive twice.
RAW_SALES = """
SELECT
  concat(cast(l_orderkey as string), '-', cast(l_linenumber as string), '-',
         cast(l_partkey as string), '-', cast(l_suppkey as string)) AS transaction_id,
  cast(c_custkey as string) AS customer_id,
  'Customer' AS customer_fname,
  replace(c_name, 'Customer#', '') AS cusomter_lname,
  concat('c', cast(c_custkey as string), '@mail.com',
         CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'x9' ELSE '.com/' END)
    AS cusomter_email,
  CASE WHEN l_orderkey % 17 <> 0 THEN cast(l_suppkey as string) END AS sales_agent_id,
  CASE WHEN l_orderkey % 11 <> 0 THEN cast(n_nationkey as string) END AS branch_id,
  cast(p_partkey as string) AS product_id,
  p_name AS product_name,
  p_type AS product_category,
  CASE WHEN k = 9 THEN NULL WHEN k = 1 THEN 'True' WHEN k = 6 THEN 'true' ELSE 'False' END
    AS offer_1,
  CASE WHEN k = 9 THEN NULL WHEN k = 2 THEN 'True' WHEN k = 7 THEN '1' ELSE 'False' END
    AS offer_2,
  CASE WHEN k = 9 THEN NULL WHEN k IN (3, 8) THEN 'True' ELSE 'False' END AS offer_3,
  CASE WHEN k = 9 THEN NULL WHEN k = 4 THEN 'True' ELSE 'False' END AS offer_4,
  CASE WHEN k = 9 THEN NULL WHEN k IN (5, 8) THEN 'True' ELSE 'False' END AS offer_5,
  cast(cast(l_quantity as int) as string) AS units,
  cast(p_retailprice as string) AS unit_price,
  CASE WHEN l_returnflag = 'N' THEN 'no' ELSE 'yes' END AS is_online,
  CASE
    WHEN l_returnflag = 'N' OR l_orderkey % 23 = 0 THEN NULL
    WHEN l_orderkey % 19 = 0
      THEN concat(cast(1 + l_orderkey % 999 as string), ' Main St/', n_name)
    ELSE concat(cast(1 + l_orderkey % 999 as string), ' Main St/', n_name, '/', r_name, '/',
                cast(10000 + n_nationkey as string))
  END AS shipping_address,
  order_day AS transaction_date
FROM (
  SELECT *, cast(round(l_discount * 100) as int) AS k FROM {lineitem}
  UNION ALL
  SELECT *, cast(round(l_discount * 100) as int) AS k FROM {lineitem} WHERE l_orderkey % 50 = 0
) lines
JOIN (
  SELECT o_orderkey, <order_day> AS order_day, c_custkey, c_name, n_nationkey, n_name, r_name
  FROM {orders}
  JOIN {customer} ON o_custkey = c_custkey
  JOIN {nation} ON c_nationkey = n_nationkey
  JOIN {region} ON n_regionkey = r_regionkey
) placed ON l_orderkey = o_orderkey
JOIN {part} ON l_partkey = p_partkey
"""

# Every seventh agent is listed a second time with a hire date one year later.
AGENTS = """
SELECT cast(s_suppkey as string) AS sales_person_id, s_name AS name, <hire_date> AS hire_date
FROM {supplier}
UNION ALL
SELECT cast(s_suppkey as string), s_name, <hire_date_later>
FROM {supplier} WHERE s_suppkey % 7 = 0
"""

BRANCHES = """
SELECT cast(n_nationkey as string) AS branch_id, n_name AS location,
       <establish_date> AS establish_date, r_name AS class
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
"""

# An `error` event stands for a malformed record: its event_kind is NULL.
EVENT_FIELDS = """
SELECT
  CASE event_type WHEN 'purchase' THEN 'purchase' WHEN 'click' THEN 'recommendationClick'
                  WHEN 'view' THEN 'productView' WHEN 'signup' THEN 'addToCart' END
    AS event_kind,
  cast(user_id as string) AS customer,
  cast(1000 + event_id % 9000 as string) AS product,
  <event_second> AS event_second,
  CASE WHEN event_type = 'signup' OR (event_type = 'purchase' AND event_id % 13 <> 0)
       THEN cast(event_id % 5 + 1 as int) END AS quantity,
  CASE WHEN event_type = 'purchase' THEN value END AS amount,
  CASE WHEN event_type = 'purchase' THEN
    CASE event_id % 3 WHEN 0 THEN 'Credit Card' WHEN 1 THEN 'Debit Card' ELSE 'PayPal' END
  END AS payment,
  CASE WHEN event_type = 'click' THEN cast(1000 + event_id % 8999 as string) END AS recommended,
  CASE WHEN event_type = 'click' THEN
    CASE event_id % 2 WHEN 0 THEN 'collaborative_filtering' ELSE 'content_based' END
  END AS algorithm,
  CASE WHEN event_type = 'view' THEN
    CASE event_id % 4 WHEN 0 THEN 'Electronics' WHEN 1 THEN 'Clothing'
                      WHEN 2 THEN 'Home & Kitchen' ELSE 'Books' END
  END AS category,
  CASE WHEN event_type = 'view' THEN
    CASE event_id % 3 WHEN 0 THEN 'Advertisement' WHEN 1 THEN 'Search' ELSE 'Direct' END
  END AS source
FROM {events}
"""

TABLES = [
    "customer", "events", "lineitem", "nation", "orders", "part", "region", "supplier",
]


def in_dialect(sql: str, dialect: dict[str, str]) -> str:
    for name, text in dialect.items():
        sql = sql.replace(f"<{name}>", text)
    return sql


def duckdb_sql(sql: str) -> str:
    return in_dialect(sql, DUCKDB_DIALECT).format(**{t: t for t in TABLES}).strip()


# Of the tables' files, for each partition that a shuffle is begun with; some 200,000 lines.
SHUFFLE_PIECE = 4 << 20
# Of files, for each task of a scan.
SCAN_PIECE = 32 << 20
# Of shuffled bytes, for each task that reads them.
TASK_PIECE = 32 << 20


def size_tasks(spark: SparkSession, sf_dir: str) -> None:
    """Begin shuffles with a number of partitions that grows with the tables, and bound what a scan gives a task.

    Adaptive execution joins small partitions to a fair size and can't cut large ones, so
    with a fixed number the memory of a task grows with the input. A task reads less than
    Spark's 128 MB of files and 64 MB of shuffled bytes: both are packed, a task sorts several times
    their size, and a shuffle into more than 200 partitions holds what it writes as well.
    """
    files = [hadoop_path(spark, f"{sf_dir}/{t}.parquet") for t in TABLES]
    size = sum(fs.getContentSummary(path).getLength() for path, fs in files if fs.exists(path))
    pieces = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHUFFLE_PIECE))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", pieces)
    spark.conf.set("spark.sql.files.maxPartitionBytes", SCAN_PIECE)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", TASK_PIECE)


def _from_tables(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    used = [t for t in TABLES if f"{{{t}}}" in sql]
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used}
    return spark.sql(in_dialect(sql, SPARK_DIALECT), **tables)


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_tables(spark, sf_dir, RAW_SALES)


def raw_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_tables(spark, sf_dir, AGENTS)


def raw_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_tables(spark, sf_dir, BRANCHES)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column `value`: a JSON text per event, NULL fields left out."""
    fields = _from_tables(spark, sf_dir, EVENT_FIELDS)
    text = F.to_json(F.struct(
        F.col("event_kind").alias("eventType"),
        F.col("customer").alias("customerId"),
        F.col("product").alias("productId"),
        F.col("event_second").alias("timestamp"),
        "quantity",
        F.col("amount").alias("totalAmount"),
        F.col("payment").alias("paymentMethod"),
        F.col("recommended").alias("recommendedProductId"),
        "algorithm",
        F.struct("category", "source").alias("metadata"),
    ))
    malformed = F.col("event_kind").isNull()
    return fields.select(F.when(malformed, "{bad").otherwise(text).alias("value"))
