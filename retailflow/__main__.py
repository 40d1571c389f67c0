"""Command line of the jobs, for spark-submit and schedulers.

Master, memory, catalog and Kafka package are the session's own settings. Dates
and hours are arguments, so a run can be repeated for any day.
"""

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from retailflow import operators as op
from retailflow import plans
from retailflow import sources as src
from retailflow import streaming as st
from retailflow.constants import COMPACTED_BYTES, WIDE_TABLE_BUCKETS


PREVIEW_ROWS = 20


def _write(reports: dict[str, DataFrame], out: str, mode: str) -> None:
    """Write every report in full, and print its first rows."""
    for name, report in reports.items():
        path = f"{out.rstrip('/')}/{name}"
        src.dump_csv(report, path, mode)
        print(f"{name}: all rows in {path}, the first {PREVIEW_ROWS} below")
        src.read_csv_dump(report.sparkSession, path).show(PREVIEW_ROWS, truncate=False)


def hourly(spark: SparkSession, args: argparse.Namespace) -> None:
    tables = plans.run_hourly(
        spark, args.base, args.database, args.date, args.hour, args.buckets, not args.overwrite
    )
    _write(plans.hourly_reports(spark, tables), args.out, args.mode)


def profile(spark: SparkSession, args: argparse.Namespace) -> None:
    raw = src.read_landing(spark, args.base, "sales_transactions", args.date, args.hour)
    _write(plans.landing_profile(raw), args.out, args.mode)
    wide = spark.table(plans.HourlyTables(args.database).wide)
    _write(plans.wide_profile(wide), args.out, args.mode)


def daily(spark: SparkSession, args: argparse.Namespace) -> None:
    wide = plans.HourlyTables(args.database).wide
    sold = {f"sold_on/{args.date}": op.sold_on(spark.table(wide), args.date)}
    _write(sold, args.out, args.mode)
    path = plans.run_daily(
        spark, wide, args.agents_base, args.agents_date, args.out, args.date, args.mode
    )
    print(f"report in {path}")


def stream(spark: SparkSession, args: argparse.Namespace) -> None:
    options = dict(option.split("=", 1) for option in args.option)
    if args.topic:
        source = st.kafka_source(spark, args.topic, options)
    else:
        source = st.replay_source(spark, args.replay, **options)
    plans.run_event_stream(
        source, args.path, args.checkpoint, args.available_now
    ).awaitTermination()


def event_reports(spark: SparkSession, args: argparse.Namespace) -> None:
    _write(plans.event_reports(spark, args.path), args.out, args.mode)


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    src.compact(spark, args.src, args.dst, args.files, args.target_bytes)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="retailflow", description=__doc__)
    jobs = parser.add_subparsers(required=True)

    def job(run, *required):
        p = jobs.add_parser(run.__name__.replace("_", "-"))
        p.set_defaults(run=run)
        for name in required:
            p.add_argument(f"--{name}", required=True)
        return p

    def report_job(run, *required):
        """A job whose reports go to --out, whole."""
        p = job(run, *required, "out")
        p.add_argument("--mode", default="error")
        return p

    p = report_job(hourly, "base", "database", "date", "hour")
    p.add_argument("--buckets", type=int, default=WIDE_TABLE_BUCKETS)
    p.add_argument("--overwrite", action="store_true", help="keep no earlier run in the wide table")
    report_job(profile, "base", "database", "date", "hour")
    report_job(daily, "database", "agents-base", "agents-date", "date")
    p = job(stream, "path", "checkpoint")
    origin = p.add_mutually_exclusive_group(required=True)
    origin.add_argument("--topic")
    origin.add_argument("--replay", metavar="FOLDER")
    p.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    p.add_argument("--available-now", action="store_true")
    report_job(event_reports, "path")
    p = job(compact, "src", "dst")
    p.add_argument("--files", type=int, help="instead of a number that follows the size")
    p.add_argument("--target-bytes", type=int, default=COMPACTED_BYTES)
    return parser


def main(argv: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    # Event times carry no zone; dates and hours must not follow that of the cluster.
    builder = SparkSession.builder.appName("retailflow")
    spark = builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    args.run(spark, args)


if __name__ == "__main__":
    main()
