"""Event stream: JSON events to the Parquet store, and the reports on it."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from retailflow import operators as op
from retailflow import streaming as st


def run_event_stream(
    source: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Store the events of a source that has a `value` column (Kafka or replay)."""
    return st.start_sink(st.shape_events(source), path, checkpoint, available_now)


def event_reports(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    events = st.read_events(spark, path)
    return {
        "avg_amount_by_method": op.avg_amount_by_method(events),
        "events_by_type": op.events_by_type(events),
    }
