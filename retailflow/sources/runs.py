"""Commit marks of hourly runs: readers see a run whole or not at all.

A run writes its tables one after another. Its mark, an empty file below the folder of the
database, is taken away before the first write and set after the last one; making
and deleting one file is a single step on every file system. So half a run, or one that stopped,
stays out of what `committed` reads.
"""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailflow.constants import RUN_PARTITIONS
from retailflow.operators.quality import dedup_by_key
from retailflow.sources.compaction import hadoop_path

MARKS = "_runs"


def _marks(spark: SparkSession, database: str):
    return hadoop_path(spark, f"{spark.catalog.getDatabase(database).locationUri}/{MARKS}")


def _mark(spark: SparkSession, database: str, as_of, hour):
    folder, fs = _marks(spark, database)
    day = date.fromisoformat(str(as_of))
    return hadoop_path(spark, f"{folder.toString()}/{day}-{int(hour):02d}")[0], fs


def open_run(spark: SparkSession, database: str, as_of, hour) -> None:
    """From now on the run counts as not loaded."""
    mark, fs = _mark(spark, database, as_of, hour)
    fs.mkdirs(mark.getParent())
    fs.delete(mark, False)


def commit_run(spark: SparkSession, database: str, as_of, hour) -> None:
    """All tables of the run are written."""
    mark, fs = _mark(spark, database, as_of, hour)
    fs.create(mark, True).close()


def committed_runs(spark: SparkSession, database: str) -> DataFrame | None:
    """extraction_date and Extraction_Hour of the runs that are whole; None where no run was ever marked."""
    folder, fs = _marks(spark, database)
    if not fs.exists(folder):
        return None
    names = [f.getPath().getName() for f in fs.listStatus(folder)]  # one per hour
    runs = [(date.fromisoformat(n[:10]), int(n[11:])) for n in names if not n.startswith((".", "_"))]
    # As SQL values, whose size Spark knows: it broadcasts them instead of shuffling a table by run,
    # which would bring all rows of an hour into one task.
    values = ", ".join(f"(DATE '{day}', {hour})" for day, hour in runs) or "(DATE '1970-01-01', 0)"
    rows = spark.sql(f"SELECT * FROM VALUES {values} AS runs(extraction_date, Extraction_Hour)")
    return rows if runs else rows.limit(0)


def committed(spark: SparkSession, name: str) -> DataFrame:
    """Rows of the whole runs of `database.table`; runs left out are not read (partition pruning).

    A table without run partitions, or of a database whose runs were never marked, is read in full.
    """
    table = spark.table(name)
    runs = committed_runs(spark, name.split(".")[0])
    if runs is None or not set(RUN_PARTITIONS) <= set(table.columns):
        return table
    return table.join(runs, RUN_PARTITIONS, "left_semi")


def one_per_key(spark: SparkSession, name: str, keys: list[str] | None = None) -> DataFrame:
    """A dimension with one row per key, should two loads at once have appended the same one.

    Of those the smallest by the other columns; without `keys`, different whole rows.
    """
    table = spark.table(name)
    return table.distinct() if keys is None else dedup_by_key(table, keys)
