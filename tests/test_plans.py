import csv

import pytest

from retailflow import fixtures as fx
from retailflow import operators as op
from retailflow import plans
from retailflow import sources as src
from rows import row_set, sales

SF_DIR = "/root/testdata/sf0.001"


def landing(spark, base, hour, rows):
    src.dump_csv(rows, f"{base}/date({fx.AS_OF})/sales_transactions_SS_raw_1_{hour:02d}.csv")


@pytest.fixture
def loaded(spark, database, tmp_path):
    """Online sales land at 8, the others at 9; both hours are loaded."""
    raw = fx.raw_sales(spark, SF_DIR)
    base = str(tmp_path / "landing")
    landing(spark, base, 8, raw.filter("is_online = 'yes'"))
    landing(spark, base, 9, raw.filter("is_online <> 'yes'"))
    for hour in (8, 9):
        tables = plans.run_hourly(spark, base, database, fx.AS_OF, hour)
    return tables


def test_two_hours_load_the_star_schema_once(spark, loaded):
    cleaned = op.clean_sales(fx.raw_sales(spark, SF_DIR), fx.AS_OF)
    for table, expected in [
        (loaded.fact, op.fact(cleaned)),
        (loaded.customer, op.customer_dim(cleaned)),
        (loaded.product, op.product_dim(cleaned)),
        (loaded.location, op.location_dim(cleaned)),
        (loaded.date, op.date_dim(cleaned)),
    ]:
        assert row_set(spark.table(table).select(expected.columns)) == row_set(expected), table
    # The wide table keeps both hours.
    wide = spark.table(loaded.wide)
    assert row_set(wide.select(cleaned.columns)) == row_set(cleaned)
    assert row_set(wide.select("Extraction_Hour", "is_online").distinct()) == ["(8, 'yes')", "(9, 'no')"]


def test_an_hour_loaded_again_changes_nothing(spark, loaded, tmp_path):
    names = (loaded.wide, loaded.fact, loaded.customer, loaded.product, loaded.location, loaded.date)
    before = {n: row_set(spark.table(n)) for n in names}
    plans.run_hourly(spark, str(tmp_path / "landing"), loaded.database, fx.AS_OF, 8)
    assert {n: row_set(spark.table(n)) for n in names} == before


def test_without_history_the_wide_table_holds_the_last_hour(spark, database, tmp_path):
    raw = fx.raw_sales(spark, SF_DIR)
    base = str(tmp_path / "landing")
    landing(spark, base, 8, raw.filter("is_online = 'yes'"))
    landing(spark, base, 9, raw.filter("is_online <> 'yes'"))
    for hour in (8, 9):
        tables = plans.run_hourly(spark, base, database, fx.AS_OF, hour, keep_history=False)
    assert row_set(spark.table(tables.wide).select("is_online").distinct()) == ["('no',)"]
    assert spark.table(tables.fact).count() == op.clean_sales(raw, fx.AS_OF).count()


def test_a_renamed_product_keeps_its_total(spark, database, tmp_path):
    base = str(tmp_path / "landing")
    first = sales(spark, {"transaction_id": "t1", "units": "4"})
    second = sales(spark, {"transaction_id": "t2", "units": "6", "product_name": "New name"})
    landing(spark, base, 8, first)
    landing(spark, base, 9, second)
    for hour in (8, 9):
        tables = plans.run_hourly(spark, base, database, fx.AS_OF, hour)
    top = plans.hourly_reports(spark, tables)["top_products"]
    assert row_set(top) == ["('Lamp', 10)"]


def test_reports_on_tables_equal_reports_on_frames(spark, loaded):
    cleaned = op.clean_sales(fx.raw_sales(spark, SF_DIR), fx.AS_OF)
    fact, product = op.fact(cleaned), op.product_dim(cleaned)
    reports = plans.hourly_reports(spark, loaded)
    assert {name: row_set(df) for name, df in reports.items()} == {
        "top_products": row_set(op.top_products(fact, product)),
        "offer_redemptions": row_set(op.offer_redemptions(fact)),
        "best_offer_per_product": row_set(op.best_offer_per_product(fact, product)),
        "lowest_online_cities": row_set(op.lowest_online_cities(fact, op.location_dim(cleaned))),
    }


def test_daily_report_has_a_folder_per_run(spark, database, tmp_path):
    wide = f"{database}.wide"
    src.write_wide_table(op.clean_sales(fx.raw_sales(spark, SF_DIR), fx.AS_OF), wide)
    agents = fx.raw_agents(spark, SF_DIR)
    src.dump_csv(agents, f"{tmp_path}/agents/date(2000-06-29)/sales_agents_1_00.csv")
    for day in ("2000-06-30", "2000-07-01"):
        path = plans.run_daily(
            spark, wide, f"{tmp_path}/agents", "2000-06-29", str(tmp_path / "out"), day
        )
        assert path.endswith(f"/{day}")
        dumped = [
            (r["name"], r["product_name"], float(r["total_sold_units"]))
            for f in (tmp_path / "out" / day).glob("*.csv")
            for r in csv.DictReader(f.open())
        ]
        report = plans.daily_report(spark.table(wide), agents)
        assert sorted(dumped) == sorted(tuple(r) for r in report.collect())
