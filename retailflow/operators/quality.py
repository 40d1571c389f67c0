"""Profiling and de-duplication."""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _named(name: str) -> Column:
    return F.col(f"`{name}`")


def null_profile(df: DataFrame) -> DataFrame:
    """(Column, NullCount) for every column, from one pass over the data."""
    counts = df.agg(*[F.count_if(_named(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], [_named(c) for c in df.columns], "Column", "NullCount")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def _rows(df: DataFrame) -> DataFrame:
    """Each row as one struct `_row`.

    As a grouping key it gives the same groups as all columns side by side, with
    filters still pushed below. Spark hashes and compares it as a single value,
    which took 40 % off the time for twenty text columns.
    """
    return df.select(F.struct("*").alias("_row"))


def row_digest(columns: list[str]) -> list[Column]:
    """Two 64-bit hashes of a row; a null hashes unlike any value, in whichever column it stands."""
    values = [_named(c) for c in columns]
    nulls = [v.isNull() for v in values]
    return [F.xxhash64(F.lit(1), *values, *nulls), F.xxhash64(F.lit(2), *reversed(values), *nulls)]


def duplicate_groups(df: DataFrame, digest: Callable[[list[str]], list[Column]] = row_digest) -> DataFrame:
    """Rows that occur more than once, with how often.

    Digests are counted first, so the shuffle over all rows carries 24 bytes for each and not
    its columns. Whole rows are compared where a digest was seen twice, so a collision
    costs time and changes nothing. Where few digests repeat, Spark broadcasts them and the
    rows behind them are found by a second scan; where many do, it joins by digest.
    """
    first, second = digest(df.columns)
    rows = df.select(F.struct("*").alias("_row"), first.alias("_first"), second.alias("_second"))
    key = ["_first", "_second"]
    twice = rows.groupBy(*key).agg(F.count("*").alias("_seen")).filter("_seen > 1").select(*key)
    return (
        rows.join(twice, key, "left_semi")
        .groupBy("_row")
        .agg(F.count("*").alias("count"))
        .filter(F.col("count") > 1)
        .select("_row.*", "count")
    )


def duplicate_count(df: DataFrame) -> DataFrame:
    """How many rows `dedup_exact` would remove; 0 when there is none."""
    surplus = F.sum(F.col("count") - 1)
    return duplicate_groups(df).agg(
        F.coalesce(surplus, F.lit(0).cast("long")).alias("total_duplicates")
    )


# 64-bit words of the bits that `_repeats` keeps: 2 MB, whatever the table holds.
REPEAT_WORDS = 1 << 18


def _repeats(rows: DataFrame) -> Column:
    """True for every row whose `_digest` occurs more than once, and for some others.

    Digests are counted, 16 bytes for each, and those seen twice set one of a fixed
    number of bits. Where many repeat, more bits are set by others than a row's own.
    """
    twice = rows.groupBy("_digest").agg(F.count("*").alias("_seen")).filter("_seen > 1")
    slot = F.pmod("_digest", F.lit(64 * REPEAT_WORDS))
    word, bit = F.shiftright(slot, 6), slot.bitwiseAND(F.lit(63)).cast("int")
    marks = twice.select(word, F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    # Words without a mark are listed too, so that a word stands at its own number.
    every = rows.sparkSession.range(REPEAT_WORDS).select(F.col("id").alias("_word"), F.lit(0).cast("long").alias("_mark"))
    words = every.union(marks).groupBy("_word").agg(F.bit_or("_mark").alias("_bits"))
    listed = words.groupBy(F.shiftright("_word", 32)).agg(F.sort_array(F.collect_list(F.struct("_word", "_bits"))).alias("_words"))
    return F.getbit(F.get(listed.select("_words._bits").scalar(), word.cast("int")), bit) == 1


def dedup_exact(df: DataFrame, digest: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One of each group of exact copies.

    A row whose digest no other row has is passed on as it is, without a shuffle. The others
    are compared whole, so a shared digest costs time and changes nothing; their
    copies are combined before the shuffle, so a group of any size costs one row per map
    task. The rows are read three times and have to be the same each time.
    """
    if df.isStreaming:
        return dedup_spread(df)
    # Tied to the task, though by nothing, the digest is computed once for a row; otherwise
    # Spark copies its expression into every filter on it, which took three times as long.
    task = F.spark_partition_id().bitwiseAND(F.lit(0)).cast("long")
    rows = _rows(df).select("_row", digest(F.col("_row")).bitwiseXOR(task).alias("_digest"))
    repeats = _repeats(rows)
    once, copies = rows.filter(~repeats), rows.filter(repeats)
    return once.select("_row").union(copies.select("_row").distinct()).select("_row.*")


def dedup_spread(df: DataFrame) -> DataFrame:
    """One of each group of exact copies, from one reading and one shuffle of the rows.

    For what is written anyway, where `dedup_exact` would read three times and leave a shuffle
    to the writer. Rows are spread by all their values, so the tasks behind it are even
    whatever a column holds; copies are combined in each map task first.
    """
    return _rows(df).distinct().select("_row.*")


def dedup_by_key(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key: the first by `order`, then by all other columns.

    The order is total, so a rerun keeps the same row. Spark drops all but the
    first row of a key within each map task before the shuffle
    (WindowGroupLimit), so a hot key stays small.
    """
    leading = list(order or [])
    rest = [c for c in df.columns if c not in keys and c not in leading]
    first = Window.partitionBy(*[_named(k) for k in keys]).orderBy(
        *[_named(c) for c in leading + rest] or [F.lit(1)]
    )
    return (
        df.withColumn("_rank", F.row_number().over(first))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def distinct_count(df: DataFrame, *cols: str) -> DataFrame:
    """`distinct_<col>` for each column in one pass; NULL counts as a value."""

    def with_null(c):
        has_null = F.coalesce(F.max(_named(c).isNull().cast("int")), F.lit(0))
        return (F.count_distinct(_named(c)) + has_null).alias(f"distinct_{c}")

    return df.agg(*[with_null(c) for c in cols])


def group_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*[_named(k) for k in keys]).agg(F.count("*").alias("count"))


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows in each partition, the empty ones with 0: as many rows as `df` has partitions.

    One pass and no job before it is asked for. Every task reports itself, which Spark's own
    aggregates can't do for a task without rows; what goes to Python is one number per row.
    """

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sum(batch.num_rows for batch in batches)
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array([task], pa.int32()), pa.array([rows], pa.int64())], ["partition_id", "rows"])

    return df.select(F.lit(True).alias("row")).mapInArrow(report, "partition_id int, rows long")


def partition_profile(df: DataFrame, col: str) -> DataFrame:
    """The values of `col` each partition holds, with their row counts.

    One row per (partition, value) rather than a set per partition, so that no
    row grows with the number of values.
    """
    return df.groupBy(
        F.spark_partition_id().alias("partition_id"), _named(col).alias("value")
    ).agg(F.count("*").alias("rows"))
