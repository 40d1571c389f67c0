"""The jobs as a scheduler starts them."""

import pytest
from pyspark.sql import functions as F

from retailflow import fixtures as fx
from retailflow import sources as src
from retailflow.__main__ import main

# The smaller tables have no sale on the day the daily job shows.
SF_DIR = "/root/testdata/sf0.01"


def test_batch_jobs(spark, database, tmp_path, capsys):
    day = fx.AS_OF
    base, agents, out = f"{tmp_path}/sales", f"{tmp_path}/agents", f"{tmp_path}/out"
    raw = fx.raw_sales(spark, SF_DIR).withColumns({"source": F.lit("web"), "logs": F.lit("l")})
    src.dump_csv(
        raw, f"{base}/date({day})/sales_transactions_SS_raw_1_09.csv"
    )
    src.dump_csv(fx.raw_agents(spark, SF_DIR), f"{agents}/date(2000-06-29)/sales_agents_1_00.csv")
    where = ["--base", base, "--database", database, "--date", day, "--hour", "09"]
    main(["hourly", *where, "--buckets", "4", "--out", f"{tmp_path}/hourly"])
    shown = capsys.readouterr().out
    assert "total_sold_units" in shown and "online_sales" in shown
    best = src.read_csv_dump(spark, f"{tmp_path}/hourly/best_offer_per_product")
    assert best.count() > 25 and f"all rows in {tmp_path}/hourly/best_offer" in shown
    main(["profile", *where, "--out", f"{tmp_path}/profile"])
    shown = capsys.readouterr().out
    assert "NullCount" in shown and "total_duplicates" in shown and "partition_id" in shown
    assert src.read_csv_dump(spark, f"{tmp_path}/profile/null_profile").count() == 22
    main(["daily", "--database", database, "--agents-base", agents,
          "--agents-date", "2000-06-29", "--out", out, "--date", day])
    shown = capsys.readouterr().out
    assert "1998-12-30" in shown and f"report in {out}/{day}" in shown
    assert spark.read.option("header", True).csv(f"{out}/{day}").count() > 0


def test_event_jobs(spark, tmp_path, capsys):
    fx.raw_events(spark, SF_DIR).write.text(f"{tmp_path}/topic")
    events, compacted = f"{tmp_path}/events", f"{tmp_path}/compacted"
    main(["stream", "--replay", f"{tmp_path}/topic", "--path", events,
          "--checkpoint", f"{tmp_path}/cp", "--option", "maxFilesPerTrigger=1",
          "--available-now"])
    main(["compact", "--src", events, "--dst", compacted, "--target-bytes", "100000000"])
    main(["event-reports", "--path", compacted, "--out", f"{tmp_path}/reports"])
    shown = capsys.readouterr().out
    assert "avg_total_amount" in shown and "recommendationClick" in shown
    assert spark.read.parquet(compacted).count() == fx.raw_events(spark, SF_DIR).count()


def test_stream_dates_are_utc_in_any_session(spark, tmp_path, conf):
    fx.raw_events(spark, SF_DIR).limit(50).write.text(f"{tmp_path}/topic")
    for zone in ("Asia/Tokyo", "UTC"):
        conf("spark.sql.session.timeZone", zone)
        main(["stream", "--replay", f"{tmp_path}/topic", "--path", f"{tmp_path}/{zone}/events",
              "--checkpoint", f"{tmp_path}/{zone}/cp", "--available-now"])
    conf("spark.sql.session.timeZone", "UTC")
    tokyo, utc = (spark.read.parquet(f"{tmp_path}/{z}/events") for z in ("Asia/Tokyo", "UTC"))
    assert sorted(map(str, tokyo.collect())) == sorted(map(str, utc.collect()))


def test_stream_needs_one_origin():
    with pytest.raises(SystemExit):
        main(["stream", "--path", "p", "--checkpoint", "c"])
