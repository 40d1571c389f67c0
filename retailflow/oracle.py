"""The same results as `workload`, written as SQL for DuckDB.

Written from the rules, not from the Spark operators: casts, date parsing, keys
and sums are DuckDB's own.
"""

from retailflow import fixtures as fx
from retailflow.fixtures import AS_OF, LATER_RUN, duckdb_sql

RAW_COLUMNS = """transaction_id, customer_id, customer_fname, cusomter_lname, cusomter_email,
  sales_agent_id, branch_id, product_id, product_name, product_category,
  offer_1, offer_2, offer_3, offer_4, offer_5, units, unit_price, is_online,
  shipping_address, transaction_date"""

DISCOUNTS = """CASE
  WHEN try_cast(offer_1 AS boolean) THEN 0.05::double
  WHEN try_cast(offer_2 AS boolean) THEN 0.10::double
  WHEN try_cast(offer_3 AS boolean) THEN 0.15::double
  WHEN try_cast(offer_4 AS boolean) THEN 0.20::double
  WHEN try_cast(offer_5 AS boolean) THEN 0.25::double
  ELSE 0.0::double END"""

OFFER = """CAST(CASE WHEN offer_1 = 'True' THEN 1 WHEN offer_2 = 'True' THEN 2
  WHEN offer_3 = 'True' THEN 3 WHEN offer_4 = 'True' THEN 4 WHEN offer_5 = 'True' THEN 5
  END AS int)"""

TOTAL_PAID = """(try_cast(units AS double) * try_cast(unit_price AS double))
  - (try_cast(units AS double) * try_cast(unit_price AS double) * discounts)"""

EMAIL = r"regexp_replace(cusomter_email, '\.com.*', '.com')"

SALE_DATE = "CAST(try_strptime(transaction_date, '%Y-%m-%d') AS date)"

RUN_DATE = f"""DATE '{AS_OF}' AS extraction_date,
  CAST(year(DATE '{AS_OF}') AS int) AS "Extraction_Year",
  CAST(month(DATE '{AS_OF}') AS int) AS "Extraction_Month\""""


def _address_part(position):
    return f"""CASE WHEN is_online = 'yes'
      THEN string_split(shipping_address, '/')[{position}] ELSE 'not found' END"""


ADDRESS = f"""{_address_part(2)} AS city, {_address_part(3)} AS state,
  {_address_part(4)} AS postal_code"""


def _label(other):
    return f"""CASE offer WHEN 1 THEN 'offer_1' WHEN 2 THEN 'offer_2' WHEN 3 THEN 'offer_3'
      WHEN 4 THEN 'offer_4' WHEN 5 THEN 'offer_5' {other} END"""


# Each step names the steps it needs before it.
STEPS = {
    "raw": ([], duckdb_sql(fx.RAW_SALES)),
    "filled": (["raw"], """SELECT * REPLACE (
      coalesce(sales_agent_id, '0') AS sales_agent_id,
      coalesce(branch_id, '0') AS branch_id,
      coalesce(shipping_address, 'not available') AS shipping_address) FROM raw"""),
    "dedup": (["filled"], "SELECT DISTINCT * FROM filled"),
    "discounted": (["dedup"], f"SELECT *, {DISCOUNTS} AS discounts FROM dedup"),
    "clean": (["discounted"], f"""SELECT
      transaction_id, customer_id, customer_fname, cusomter_lname, {EMAIL} AS cusomter_email,
      sales_agent_id, branch_id, product_id, product_name, product_category,
      units, unit_price, is_online, shipping_address, {SALE_DATE} AS transaction_date,
      discounts, {OFFER} AS offer, {ADDRESS}, {TOTAL_PAID} AS total_paid, {RUN_DATE}
      FROM discounted"""),
    "fact": (["clean"], """SELECT transaction_id, customer_id, sales_agent_id, branch_id,
      product_id, concat_ws('-', city, state, postal_code) AS location_id, transaction_date,
      offer, is_online, CAST(trunc(try_cast(units AS double)) AS int) AS units,
      try_cast(unit_price AS double) AS unit_price, total_paid,
      "Extraction_Year", "Extraction_Month" FROM clean"""),
    "customer_dim": (["clean"], """SELECT DISTINCT customer_id, customer_fname, cusomter_lname,
      cusomter_email FROM clean"""),
    "product_dim": (["clean"],
                    "SELECT DISTINCT product_id, product_name, product_category FROM clean"),
    "location_dim": (["clean"], """SELECT DISTINCT
      city || '-' || state || '-' || postal_code AS location_id, city, state, postal_code
      FROM clean"""),
    "date_dim": (["clean"], """SELECT DISTINCT transaction_date,
      CAST(day(transaction_date) AS int) AS day, CAST(month(transaction_date) AS int) AS month,
      CAST(year(transaction_date) AS int) AS year,
      CAST(quarter(transaction_date) AS int) AS quarter, dayname(transaction_date) AS day_name
      FROM clean"""),
    "agents": ([], duckdb_sql(fx.AGENTS)),
    "agent_dim": (["agents"], """SELECT sales_person_id, name, hire_date FROM agents
      QUALIFY row_number() OVER (PARTITION BY sales_person_id ORDER BY hire_date, name) = 1"""),
    "branches": ([], duckdb_sql(fx.BRANCHES)),
    "event_fields": ([], duckdb_sql(fx.EVENT_FIELDS)),
    "parsed": (["event_fields"], """SELECT event_kind AS "eventType",
      CASE WHEN event_kind IS NOT NULL THEN customer END AS "customerId",
      CASE WHEN event_kind IS NOT NULL THEN product END AS "productId",
      CASE WHEN event_kind IS NOT NULL THEN event_second END AS "timestamp",
      quantity, amount AS "totalAmount", payment AS "paymentMethod",
      recommended AS "recommendedProductId", algorithm,
      category AS metadata_category, source AS metadata_source
      FROM event_fields"""),
    "timed": (["parsed"], """SELECT * REPLACE (CAST("timestamp" AS timestamp) AS "timestamp"),
      CAST(CAST("timestamp" AS timestamp) AS date) AS date,
      strftime(CAST("timestamp" AS timestamp), '%H') AS hour FROM parsed"""),
    "stored": (["timed"], """SELECT * REPLACE (
      CASE WHEN "eventType" IN ('purchase', 'addToCart') THEN quantity ELSE 0 END AS quantity,
      CASE WHEN "eventType" = 'purchase' THEN "totalAmount" ELSE 0.0 END AS "totalAmount",
      CASE WHEN "eventType" = 'purchase' THEN "paymentMethod" ELSE 'Unknown' END
        AS "paymentMethod",
      CASE WHEN "eventType" = 'recommendationClick' THEN "recommendedProductId" ELSE 'None' END
        AS "recommendedProductId",
      CASE WHEN "eventType" = 'recommendationClick' THEN algorithm ELSE 'None' END
        AS algorithm) FROM timed"""),
}


def _steps_for(names):
    ordered = []
    for name in names:
        for step in _steps_for(STEPS[name][0]) + [name]:
            if step not in ordered:
                ordered.append(step)
    return ordered


def _sql(select, *needs):
    ctes = ",\n".join(f"{name} AS ({STEPS[name][1]})" for name in _steps_for(needs))
    return f"WITH {ctes}\n{select}"


def _all_of(step):
    return _sql(f"SELECT * FROM {step}", step)


_SOLD_BY_AGENT = _sql(
    """SELECT name, product_name, sum(try_cast(units AS double)) AS total_sold_units
    FROM clean JOIN agent_dim ON sales_agent_id = sales_person_id
    GROUP BY name, product_name""", "clean", "agent_dim")

_NULL_COUNTS = " UNION ALL ".join(
    f"""SELECT '{c.strip()}' AS "Column", count(*) - count({c.strip()}) AS "NullCount" FROM raw"""
    for c in RAW_COLUMNS.split(",")
)

_TWO_RUNS = f"""SELECT "Extraction_Year" AS y, "Extraction_Month" AS m FROM clean
  UNION ALL SELECT CAST(year(DATE '{LATER_RUN}') AS int), CAST(month(DATE '{LATER_RUN}') AS int)
  FROM clean WHERE is_online = 'yes'"""

ORACLE = {
    "landing_csv_scan": _all_of("raw"),
    "agents_csv_scan": _all_of("agents"),
    "landing_mixed_headers": _sql(
        """SELECT *, CASE WHEN is_online <> 'yes' THEN 'web' END AS source FROM raw""", "raw"),
    "landing_prefix_counts": _sql(
        """SELECT 'sales_transactions' AS entity, '09' AS hour, count(*) AS rows FROM raw
        UNION ALL SELECT 'branches', '10', count(*) FROM branches
        UNION ALL SELECT 'sales_agents', '10', count(*) FROM agents""",
        "raw", "branches", "agents"),
    "landing_inventory": _sql(
        """SELECT lpad(CAST(h AS varchar), 2, '0') AS hour,
          CASE WHEN h = 7 THEN 'absent' WHEN h = 10 THEN 'empty' ELSE 'found' END AS state,
          (SELECT count(*) FROM raw WHERE h = CASE is_online WHEN 'yes' THEN 8 ELSE 9 END) AS rows
        FROM range(7, 11) t(h)""", "raw"),
    "wide_run_scan": _sql(
        """SELECT *, CAST(9 AS int) AS "Extraction_Hour" FROM clean WHERE is_online <> 'yes'""", "clean"),
    "product_history": _sql(
        "SELECT * FROM clean WHERE product_name = (SELECT min(product_name) FROM clean)", "clean"),
    "committed_runs_fact": _sql("SELECT * FROM fact WHERE is_online = 'yes'", "fact"),
    "orc_partition_scan": _all_of("clean"),
    "bucketed_table_roundtrip": _all_of("clean"),
    "dim_append_roundtrip": _sql(
        "SELECT * FROM customer_dim UNION ALL SELECT * FROM customer_dim", "customer_dim"),
    "dim_incremental": _sql(
        """SELECT product_id, CASE WHEN CAST(product_id AS bigint) % 2 = 0 THEN product_name
          ELSE product_name || ' (new)' END AS product_name, product_category FROM product_dim
        UNION ALL SELECT NULL, 'No key', 'None' WHERE EXISTS (FROM product_dim)""",
        "product_dim"),
    "fact_partition_roundtrip": _all_of("fact"),
    "daily_dump_roundtrip": _SOLD_BY_AGENT,
    "daily_two_hours": _SOLD_BY_AGENT,
    "stream_sink_roundtrip": _all_of("stored"),
    "stream_restart_roundtrip": _all_of("stored"),
    "compact_events_incremental": _all_of("stored"),
    "compact_events": _all_of("stored"),
    "compact_events_two_files": _all_of("stored"),
    "describe_fact": f"""SELECT column_name AS col_name,
      CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int'
        ELSE lower(column_type) END AS data_type
      FROM (DESCRIBE {_all_of("fact")})""",
    "describe_sections": f"""SELECT 'column' AS section, column_name AS name,
      CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int'
        ELSE lower(column_type) END AS type
      FROM (DESCRIBE {_all_of("clean")})
      UNION ALL VALUES ('partition', 'Extraction_Year', 'int'), ('partition', 'Extraction_Month', 'int'),
        ('bucket', 'product_name', '8'), ('sort', 'product_name', '8'),
        ('table', 'Type', 'managed'), ('table', 'Provider', 'orc')""",
    "null_profile": _sql(_NULL_COUNTS, "raw"),
    "row_count": _sql("SELECT count(*) AS row_count FROM raw", "raw"),
    "duplicate_groups": _sql(
        f"""SELECT {RAW_COLUMNS}, count(*) AS "count" FROM raw
        GROUP BY {RAW_COLUMNS} HAVING count(*) > 1""", "raw"),
    "duplicate_count": _sql(
        f"""SELECT CAST(coalesce(sum(n - 1), 0) AS bigint) AS total_duplicates FROM
        (SELECT count(*) AS n FROM raw GROUP BY {RAW_COLUMNS} HAVING count(*) > 1)""", "raw"),
    "dedup_exact": _sql("SELECT DISTINCT * FROM raw", "raw"),
    "dedup_by_key": _sql(
        """SELECT product_id, transaction_id, units FROM raw QUALIFY row_number() OVER
        (PARTITION BY product_id ORDER BY transaction_id, units) = 1""", "raw"),
    "distinct_extraction_periods": _sql(
        f"""SELECT count(DISTINCT y) AS "distinct_Extraction_Year",
        count(DISTINCT m) AS "distinct_Extraction_Month" FROM ({_TWO_RUNS})""", "clean"),
    "rows_per_month": _sql(
        f"""SELECT m AS "Extraction_Month", count(*) AS "count" FROM ({_TWO_RUNS})
        GROUP BY m""", "clean"),
    "partition_sizes": _sql(
        "SELECT CAST(32 AS bigint) AS partitions, count(*) AS rows FROM clean", "clean"),
    "partition_sizes_each": _sql(
        """SELECT CAST(i AS int) AS partition_id, count(branch_id) AS rows
        FROM range(32) t(i) LEFT JOIN clean ON CAST(branch_id AS int) % 32 = i GROUP BY i""", "clean"),
    "partition_profile": _sql(
        """SELECT branch_id AS value, CAST(1 AS bigint) AS partitions, count(*) AS rows
        FROM clean GROUP BY branch_id""", "clean"),
    "fill_defaults": _all_of("filled"),
    "discount_ladder": _sql(
        f"""SELECT transaction_id, offer_1, offer_2, offer_3, offer_4, offer_5,
        {DISCOUNTS} AS discounts FROM raw""", "raw"),
    "offer_code": _sql(f"SELECT transaction_id, {OFFER} AS offer FROM raw", "raw"),
    "address_parts": _sql(
        f"SELECT transaction_id, is_online, shipping_address, {ADDRESS} FROM filled", "filled"),
    "total_paid": _sql(
        f"""SELECT transaction_id, units, unit_price, discounts, {TOTAL_PAID} AS total_paid
        FROM (SELECT *, {DISCOUNTS} AS discounts FROM raw)""", "raw"),
    "email_clean": _sql(f"SELECT transaction_id, {EMAIL} AS cusomter_email FROM raw", "raw"),
    "extraction_columns": _sql(
        f"SELECT transaction_id, {SALE_DATE} AS transaction_date, {RUN_DATE} FROM raw", "raw"),
    "clean_sales": _all_of("clean"),
    "dim_customer": _all_of("customer_dim"),
    "dim_product": _all_of("product_dim"),
    "dim_location": _all_of("location_dim"),
    "dim_date": _all_of("date_dim"),
    "dim_agent": _all_of("agent_dim"),
    "dim_branch": _sql("SELECT DISTINCT * FROM branches", "branches"),
    "fact_sales": _all_of("fact"),
    "sales_agent_join": _sql(
        "SELECT * FROM clean JOIN agent_dim ON sales_agent_id = sales_person_id",
        "clean", "agent_dim"),
    "sales_on_day_548": _sql(
        f"SELECT * FROM clean WHERE transaction_date = DATE '{AS_OF}' - 548", "clean"),
    "sales_since_548": _sql(
        f"SELECT * FROM clean WHERE transaction_date >= DATE '{AS_OF}' - 548", "clean"),
    "top_products": _sql(
        """SELECT product_name, CAST(sum(units) AS bigint) AS total_sold_units
        FROM fact JOIN product_dim USING (product_id) GROUP BY product_name
        ORDER BY total_sold_units DESC, product_name LIMIT 10""", "fact", "product_dim"),
    "offer_redemptions": _sql(
        f"""SELECT {_label("")} AS offer, total_redeemed FROM
        (SELECT offer, count(*) AS total_redeemed FROM fact WHERE offer IS NOT NULL
         GROUP BY offer ORDER BY total_redeemed DESC, offer LIMIT 5)""", "fact"),
    "best_offer_per_product": _sql(
        f"""SELECT product_name, {_label("ELSE 'other_offer'")} AS most_redeemed_offer,
        total_redeemed FROM
        (SELECT product_id, offer, count(*) AS total_redeemed FROM fact
         WHERE offer IS NOT NULL GROUP BY product_id, offer
         QUALIFY row_number() OVER
           (PARTITION BY product_id ORDER BY count(*) DESC, offer) = 1)
        JOIN product_dim USING (product_id)""", "fact", "product_dim"),
    "lowest_online_cities": _sql(
        """SELECT city, CAST(round(sum(CAST(total_paid AS decimal(18,4))), 2) AS double)
          AS online_sales
        FROM fact JOIN location_dim USING (location_id) WHERE is_online = 'yes'
        GROUP BY city ORDER BY online_sales, city LIMIT 10""", "fact", "location_dim"),
    "agent_product_units": _SOLD_BY_AGENT,
    "events_parsed": _all_of("parsed"),
    "events_normalised": _all_of("stored"),
    "events_date_hour": _sql(
        """SELECT "eventType", "customerId", "productId", "timestamp", date, hour FROM timed""",
        "timed"),
    "avg_amount_by_method": _sql(
        """SELECT "paymentMethod",
        CAST(sum(CAST("totalAmount" AS decimal(18,4))) AS double) / count("totalAmount")
          AS avg_total_amount
        FROM stored GROUP BY "paymentMethod\"""", "stored"),
    "events_by_type": _sql(
        """SELECT "eventType", count(*) AS "count" FROM stored GROUP BY "eventType\"""",
        "stored"),
}


def _in_one_shape(report, item, detail, value):
    return f"""SELECT '{report}' AS report, {item} AS item, CAST({detail} AS varchar) AS detail,
      CAST({value} AS double) AS value FROM ({ORACLE[report]})"""


ORACLE["hourly_reports_stored"] = " UNION ALL ".join([
    _in_one_shape("top_products", "product_name", "NULL", "total_sold_units"),
    _in_one_shape("offer_redemptions", "offer", "NULL", "total_redeemed"),
    _in_one_shape(
        "best_offer_per_product", "product_name", "most_redeemed_offer", "total_redeemed"),
    _in_one_shape("lowest_online_cities", "city", "NULL", "online_sales"),
])
