"""Stream sources and the Parquet event store."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from retailflow.sources.compaction import hadoop_path as _path


def kafka_source(spark: SparkSession, topic: str, options: dict[str, str]) -> DataFrame:
    """A topic from its earliest offset; servers and login come from the caller.

    `maxOffsetsPerTrigger` in `options` bounds the size of a micro-batch. Needs
    Spark's Kafka package on the class path.
    """
    return (
        spark.readStream.format("kafka")
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
        .load()
    )


def replay_source(spark: SparkSession, path: str, **options) -> DataFrame:
    """A folder of text files, a JSON event per line, as the same `value` column."""
    return spark.readStream.format("text").options(**options).load(path)


def start_sink(
    df: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Append to a Parquet folder, each event once, resuming from `checkpoint`.

    `available_now` stops after what is there at the start.
    """
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def forget_last_commit(spark: SparkSession, checkpoint: str) -> int:
    """Take the mark of the last finished batch out of a checkpoint; returns its number.

    The checkpoint then looks as it does after a stop between a batch's write and its mark,
    and the next run repeats that batch with the same input. The sink's log
    already holds it, so its rows stay stored once.
    """
    commits, fs = _path(spark, f"{checkpoint.rstrip('/')}/commits")
    marks = [int(f.getPath().getName()) for f in fs.listStatus(commits) if f.getPath().getName().isdigit()]
    if not marks:
        raise ValueError(f"no batch of {checkpoint} has finished")
    mark, _ = _path(spark, f"{commits.toString()}/{max(marks)}")
    fs.delete(mark, False)
    return max(marks)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """The stored events, by the root folder: its log says which files count."""
    return spark.read.parquet(path)
