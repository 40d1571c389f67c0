"""Tables that several passes of one operator read, kept where every executor sees them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailflow.sources.scratch import scratch_dir

# The words of a text, wherever words are counted.
WORD = r"[^\x20\x09-\x0D]+"


def shared_table(df: DataFrame, name: str, partition_by: list[str] | None = None, **options) -> DataFrame:
    """Write `df` as Parquet below `spark.checkpoint.dir` and read it back.

    Cuts the lineage like a checkpoint, and a lost executor takes nothing with it.
    The schema is given on reading, so empty tables come back too.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}"
    writer = df.write.option("compression", "zstd").options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """`docs` as a stored table with a number of its own for every row, and the name of that column.

    Stored, so that the numbers stay when a task is run again.
    """
    taken = {c.lower() for c in docs.columns}
    number = next(n for i in range(len(taken) + 1) if (n := f"row_{i}") not in taken)
    return shared_table(docs.withColumn(number, F.monotonically_increasing_id()), name), number


def one_of_each(rows: DataFrame, number: str, groups: DataFrame, keep: str = "smallest") -> DataFrame:
    """`rows` without all but one of each group: that with the smallest (largest) doc_id, then number.

    rows, number: of `numbered`. groups: (row, group); rows that are alone may be left out of it. A null
    id is the smallest. Groups of any size combine before their shuffle and are never joined by group.
    """
    pick = {"smallest": F.min, "largest": F.max}[keep]
    ids = rows.select(F.col(number).alias("row"), F.col("doc_id").alias("id"))
    stays = groups.join(ids, "row").groupBy("group").agg(pick(F.struct("id", "row"))["row"].alias("stays"))
    gone = groups.select("row").join(stays, F.col("row") == F.col("stays"), "left_anti").select(F.col("row").alias("gone"))
    return rows.join(gone, rows[number] == gone["gone"], "left_anti").drop(number)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
