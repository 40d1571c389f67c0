"""ORC tables of the warehouse and the CSV report dump.

Every write here removes its shuffle files when it ends (`shuffles_freed`).
"""

import threading
import uuid
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailflow.constants import EXTRACTION_PARTITIONS, RUN_PARTITIONS, WIDE_TABLE_BUCKETS
from retailflow.operators.quality import dedup_by_key
from retailflow.operators.star import rows_not_in


# Spark then removes a query's shuffle files when the query ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing: dict[str, tuple[int, str]] = {}  # by session: writes under way, setting before them
_freeing_lock = threading.Lock()
# Appends to one table share a `_temporary` folder, which the first that ends takes away from the others.
_append_locks: dict[str, threading.Lock] = defaultdict(threading.Lock)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes in here remove their shuffle files as they end, and frames stay usable.

    Spark by itself keeps them until the driver collects its garbage, so the disk of a job of
    several loads would have to hold the shuffles of all. The setting is that of the session
    again when its last write here, of whichever thread, has ended.
    """
    session = spark._jsparkSession.sessionUUID()
    with _freeing_lock:
        writes, before = _freeing.get(session) or (0, spark.conf.get(FREE_SHUFFLES, "false"))
        _freeing[session] = writes + 1, before
        spark.conf.set(FREE_SHUFFLES, True)
    try:
        yield
    finally:
        with _freeing_lock:
            writes, before = _freeing.pop(session)
            if writes > 1:
                _freeing[session] = writes - 1, before
            else:
                spark.conf.set(FREE_SHUFFLES, before)


def ensure_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{where}")


def list_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE FORMATTED {name}")


def table_sections(spark: SparkSession, name: str) -> DataFrame:
    """section, name, type of what `describe_table` lists, each part under its own name.

    Sections: `column`, `partition` (partition columns, which are columns too), `bucket` and
    `sort` (with the number of buckets as type), `table` (format and kind).
    """
    section, rows, layout = "column", [], {}
    for r in describe_table(spark, name).collect():  # a line per column of the table
        if r.col_name.startswith("# Partition Information"):
            section = "partition"
        elif r.col_name.startswith("#") and not r.col_name.startswith("# col_name"):
            section = "detail"
        elif r.col_name and not r.col_name.startswith("#"):
            if section == "detail":
                layout.setdefault(r.col_name, r.data_type)
            else:
                rows.append((section, r.col_name, r.data_type))
    for part, key in (("bucket", "Bucket Columns"), ("sort", "Sort Columns")):
        for column in layout.get(key, "[]").strip("[]").replace("`", "").split(","):
            if column.strip():
                rows.append((part, column.strip(), layout["Num Buckets"]))
    rows += [("table", key, layout[key].lower()) for key in ("Type", "Provider") if key in layout]
    return spark.createDataFrame(rows, "section string, name string, type string")


def read_run(spark: SparkSession, name: str, as_of, hour) -> DataFrame:
    """The rows of one run of a table that keeps its history; only that run's folder is read."""
    day = date.fromisoformat(str(as_of))
    return spark.table(name).where(
        (F.col("Extraction_Year") == day.year)
        & (F.col("Extraction_Month") == day.month)
        & (F.col("extraction_date") == F.lit(day))
        & (F.col("Extraction_Hour") == int(hour))
    )


def product_history(spark: SparkSession, name: str, product_name: str) -> DataFrame:
    """All rows of one product in the cleaned table; only its bucket is read, in every partition."""
    return spark.table(name).where(F.col("product_name") == product_name)


def read_orc_table(spark: SparkSession, path: str) -> DataFrame:
    """An ORC table by its root folder, partition columns included."""
    return spark.read.option("basePath", path).orc(path)


def _by_bucket(df: DataFrame, partitions: list[str], buckets: int) -> DataFrame:
    """Rows brought together by partition and bucket.

    So a task writes one bucket instead of a piece of all of them. REBALANCE
    leaves the sizes to adaptive execution: a bucket with a hot product is split
    over several tasks, small ones share a task. Take more buckets for more data.
    """
    bucket = F.pmod(F.hash("product_name"), F.lit(buckets))
    return df.withColumn("_bucket", bucket).hint("rebalance", *partitions, "_bucket").drop("_bucket")


def write_wide_table(
    df: DataFrame, name: str, buckets: int = WIDE_TABLE_BUCKETS, gather: bool = True
) -> None:
    """Overwrite the cleaned table: partitioned by run month, bucketed by product name.

    Without `gather` the rows stay in the tasks they come in, and each task writes a file per
    bucket: for rows that a shuffle has just dealt in tasks of a fair size (`dedup_spread`, or
    the joins behind `dedup_exact`).
    """
    rows = _by_bucket(df, EXTRACTION_PARTITIONS, buckets) if gather else df
    with shuffles_freed(df.sparkSession):
        (
            rows.write.format("orc")
            .partitionBy(*EXTRACTION_PARTITIONS)
            .bucketBy(buckets, "product_name")
            .sortBy("product_name")
            .mode("overwrite")
            .saveAsTable(name)
        )


def _as_run(df: DataFrame, as_of, hour) -> DataFrame:
    """Rows with the key of their run as the last columns."""
    return df.withColumns({
        "extraction_date": F.lit(as_of).cast("date"),
        "Extraction_Hour": F.lit(int(hour)),
    })


def _replace_run(df: DataFrame, name: str, as_of, hour) -> None:
    """Insert a run into a table that exists; the same run loaded before is replaced."""
    spark = df.sparkSession
    day = date.fromisoformat(str(as_of))
    run = {
        "Extraction_Year": day.year,
        "Extraction_Month": day.month,
        "extraction_date": f"DATE '{day}'",
        "Extraction_Hour": int(hour),
    }
    partition = ", ".join(f"{c} = {run[c]}" for c in EXTRACTION_PARTITIONS + RUN_PARTITIONS)
    rows = df.select(*[c for c in spark.table(name).columns if c not in run])
    view = f"_run_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(view)
    try:
        # Not by spark.sql, whose commands keep their shuffles whatever FREE_SHUFFLES says.
        state = spark._jsparkSession.sessionState()
        insert = state.sqlParser().parsePlan(
            f"INSERT OVERWRITE TABLE {name} PARTITION ({partition}) SELECT * FROM {view}"
        )
        every = getattr(state, "executePlan$default$2")()
        with shuffles_freed(spark):
            state.executePlan(insert, every).assertCommandExecuted()
    finally:
        spark.catalog.dropTempView(view)


def load_wide_run(
    df: DataFrame, name: str, as_of, hour, buckets: int = WIDE_TABLE_BUCKETS, gather: bool = True
) -> None:
    """Add the rows of one run to the cleaned table, in the place of the same run loaded before.

    The table is partitioned by run month, date and hour and bucketed by product
    name; other runs are not touched, so the table keeps its history. `gather` is that of
    `write_wide_table`.
    """
    partitions = EXTRACTION_PARTITIONS + RUN_PARTITIONS
    rows = _as_run(df, as_of, hour)
    if gather:
        rows = _by_bucket(rows, partitions, buckets)
    if df.sparkSession.catalog.tableExists(name):
        _replace_run(rows, name, as_of, hour)
    else:
        writer = rows.write.format("orc").partitionBy(*partitions)
        with shuffles_freed(df.sparkSession):
            writer.bucketBy(buckets, "product_name").sortBy("product_name").saveAsTable(name)


def load_fact_run(df: DataFrame, name: str, as_of, hour) -> None:
    """Add the facts of one run, in the place of the same run loaded before."""
    partitions = EXTRACTION_PARTITIONS + RUN_PARTITIONS
    rows = _as_run(df, as_of, hour)
    if df.sparkSession.catalog.tableExists(name):
        _replace_run(rows, name, as_of, hour)
    else:
        with shuffles_freed(df.sparkSession):
            rows.write.format("orc").partitionBy(*partitions).saveAsTable(name)


def append_dim(df: DataFrame, name: str) -> None:
    """Append all rows, also those the table already has (see `load_dim`); threads of one driver take turns."""
    with _append_locks[name.lower()], shuffles_freed(df.sparkSession):
        df.write.format("orc").mode("append").saveAsTable(name)


def append_fact(df: DataFrame, name: str) -> None:
    """Append to the fact table, one folder per run month.

    One run has one month, and its rows come in tasks of a fair size, be they
    splits of the wide table or partitions sized by adaptive execution. So no
    shuffle is added here, and each task writes one file.
    """
    with shuffles_freed(df.sparkSession):
        df.write.format("orc").partitionBy(*EXTRACTION_PARTITIONS).mode("append").saveAsTable(name)


def load_dim(df: DataFrame, name: str, keys: list[str] | None = None) -> None:
    """Append only what the dimension lacks, so a repeated load adds nothing.

    Reports join on dimensions; a row loaded twice would double their sums. With
    `keys` there is one row per key, a NULL key being one: the row loaded first
    stays, and of several in one load the smallest by the other columns. Without
    `keys` whole rows are compared.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        df = rows_not_in(df, spark.table(name), keys)
    elif keys is not None:
        df = dedup_by_key(df, keys)
    append_dim(df, name)


def dump_csv(
    df: DataFrame, path: str, mode: str = "error", files: int | None = None, **options
) -> None:
    """Write a report as CSV with a header; every value reads back as it was.

    Adaptive execution puts a small report into one file. `files` fixes the
    number; the work before the write keeps its own parallelism. Text with a
    line break is refused: it would need files that can't be split. `options` are more
    of Spark's for the writer, such as `compression`.
    """
    out = df if files is None else df.repartition(files)
    texts = [f.name for f in df.schema if f.dataType.typeName() == "string"]
    out = out.withColumns({c: _one_line(F.col(f"`{c}`"), c) for c in texts})
    with shuffles_freed(df.sparkSession):
        (
            out.write.options(**options)
            .option("header", True)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .option("escape", '"')
            .mode(mode)
            .csv(path)
        )


def _one_line(text, name: str):
    broken = text.contains("\n") | text.contains("\r")
    return F.when(broken, F.raise_error(F.lit(f"a line break in column {name}"))).otherwise(text)


def read_csv_dump(spark: SparkSession, path: str) -> DataFrame:
    """A dump as text columns; what stands unquoted and empty is NULL, quoted it is empty text."""
    reader = spark.read.option("header", True).option("escape", '"')
    return reader.option("nullValue", "\u0000").csv(path)


def drop_database(spark: SparkSession, db: str) -> None:
    """A database with its tables and their files."""
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
