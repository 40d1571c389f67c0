from .events import (
    flatten,
    normalise_events,
    parse_events,
    shape_events,
    with_event_time,
)
from .io import forget_last_commit, kafka_source, read_events, replay_source, start_sink

__all__ = [
    "flatten",
    "forget_last_commit",
    "kafka_source",
    "normalise_events",
    "parse_events",
    "read_events",
    "replay_source",
    "shape_events",
    "start_sink",
    "with_event_time",
]
