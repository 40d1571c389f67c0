from .daily import daily_report, run_daily
from .hourly import (
    HourlyTables,
    hourly_reports,
    landing_profile,
    run_hourly,
    wide_profile,
)
from .stream import event_reports, run_event_stream

__all__ = [
    "HourlyTables",
    "daily_report",
    "event_reports",
    "hourly_reports",
    "landing_profile",
    "run_daily",
    "run_event_stream",
    "run_hourly",
    "wide_profile",
]
