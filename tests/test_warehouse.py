import glob

import pytest
from pyspark.errors import AnalysisException

from retailflow import operators as op
from retailflow import sources as src
from rows import AS_OF, SALE, row_set, sale, sales


def cleaned(spark, *changes, as_of=AS_OF):
    return op.clean_sales(sales(spark, *changes), as_of)


def write_landing(folder, name, rows):
    folder.mkdir(parents=True, exist_ok=True)
    lines = [",".join(SALE)] + [",".join(r[c] or "" for c in SALE) for r in rows]
    (folder / name).write_text("\n".join(lines) + "\n")


def test_landing_hour_takes_all_files_of_that_hour_only(spark, tmp_path):
    day = tmp_path / "date(2024-02-03)"
    write_landing(day, "sales_transactions_SS_raw_1_09.csv", [sale(), sale(branch_id=None)])
    write_landing(day, "sales_transactions_SS_raw_2_09.csv", [sale(units="007")])
    write_landing(day, "sales_transactions_SS_raw_1_10.csv", [sale()])
    write_landing(day, "sales_transactions_other_1_09.csv", [sale()])
    df = src.read_landing(spark, str(tmp_path), "sales_transactions", "2024-02-03", 9)
    assert df.count() == 3
    assert set(dict(df.dtypes).values()) == {"string"}
    assert {r.units for r in df.collect()} == {"2", "007"}
    assert df.filter("branch_id is null").count() == 1
    whole_day = src.read_landing(spark, str(tmp_path), "sales_transactions", "2024-02-03")
    assert whole_day.count() == 4
    assert src.read_landing(spark, str(tmp_path), None, "2024-02-03").count() == 5


def test_a_day_with_two_entities_gives_the_one_asked_for(spark, tmp_path):
    day = tmp_path / "date(2024-02-03)"
    write_landing(day, "sales_transactions_SS_raw_1_09.csv", [sale()])
    (day / "sales_agents_1_09.csv").write_text("sales_person_id,name,hire_date\n7,Bob,2020-01-01\n")
    agents = src.read_landing(spark, str(tmp_path), "sales_agents", "2024-02-03")
    assert row_set(agents) == ["('7', 'Bob', '2020-01-01')"]


def test_files_of_one_hour_with_different_headers(spark, tmp_path):
    day = tmp_path / "date(2024-02-03)"
    day.mkdir()
    (day / "sales_transactions_SS_raw_1_09.csv").write_text("transaction_id,units,unit_price\nt1,2,10\n")
    (day / "sales_transactions_SS_raw_2_09.csv").write_text(
        "transaction_id,unit_price,units,source\nt2,11,3,web\n"
    )
    (day / "sales_transactions_SS_raw_3_09.csv").write_text("")
    df = src.read_landing(spark, str(tmp_path), "sales_transactions", "2024-02-03", 9)
    rows = df.select("transaction_id", "units", "unit_price", "source")
    assert row_set(rows) == ["('t1', '2', '10', None)", "('t2', '3', '11', 'web')"]


def test_missing_hour_names_the_path(spark, tmp_path):
    write_landing(tmp_path / "date(2024-02-03)", "sales_transactions_SS_raw_1_09.csv", [sale()])
    with pytest.raises(AnalysisException, match=r"(?s)PATH_NOT_FOUND.*_11\.csv"):
        src.read_landing(spark, str(tmp_path), "sales_transactions", "2024-02-03", 11)


def test_read_entity_routes_by_prefix(spark, tmp_path):
    for name, n in [("sales_transactions_SS_raw_1_09", 3), ("branches_1_09", 2),
                    ("sales_agents_1_10", 1), ("returns_1_10", 5)]:
        write_landing(tmp_path, f"{name}.csv", [sale(units=str(i)) for i in range(n)])
    base = str(tmp_path)
    assert src.read_entity(spark, base, "branches").count() == 2
    hours = src.landing_hours(src.read_entity(spark, base, "sales_transactions", with_file=True))
    assert row_set(hours) == ["('09', 3)"]
    agents = src.read_entity(spark, base, "sales_agents", with_file=True)
    assert row_set(src.landing_hours(agents)) == ["('10', 1)"]
    with pytest.raises(ValueError, match="returns"):
        src.read_entity(spark, base, "returns")


def test_landing_hour_is_that_of_the_file_not_of_a_folder(spark, tmp_path):
    folder = tmp_path / "old_10.csv_copy"
    write_landing(folder, "branches_1_09.csv", [sale()])
    rows = src.read_entity(spark, str(folder), "branches", with_file=True)
    assert row_set(src.landing_hours(rows)) == ["('09', 1)"]


def test_load_dim_by_key_keeps_the_first_row_of_a_key(spark, database):
    name = f"{database}.product"
    frame = lambda *rows: spark.createDataFrame(rows, "product_id string, product_name string")
    src.load_dim(frame(("p1", "Old"), ("p1", "Older"), (None, "x"), (None, "w")), name, ["product_id"])
    src.load_dim(frame(("p1", "New"), ("p2", "Two"), (None, "v")), name, ["product_id"])
    assert row_set(spark.table(name)) == ["('p1', 'Old')", "('p2', 'Two')", "(None, 'w')"]


def test_csv_dump_reads_back_as_it_was(spark, tmp_path):
    texts = ["  pad ", "", None, 'say "so"', "a,b", "\\", "\\n", "\t", "ü", "back\\"]
    report = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "k string, v string")
    src.dump_csv(report, f"{tmp_path}/out")
    assert row_set(src.read_csv_dump(spark, f"{tmp_path}/out")) == row_set(report)
    for broken in ("two\nlines", "two\rlines"):
        with pytest.raises(Exception, match="line break in column v"):
            src.dump_csv(spark.createDataFrame([("1", broken)], "k string, v string"), f"{tmp_path}/bad", "overwrite")


def test_two_years_read_back_from_the_root(spark, database, tmp_path):
    name = f"{database}.fact"
    src.append_fact(op.fact(cleaned(spark, {}, {"units": "3"})), name)
    src.append_fact(op.fact(cleaned(spark, {}, as_of="2025-01-01")), name)
    table = src.read_orc_table(spark, str(tmp_path / "db" / "fact"))
    assert row_set(table.groupBy("Extraction_Year", "Extraction_Month").count()) == [
        "(2024, 2, 2)", "(2025, 1, 1)",
    ]
    assert row_set(table.select(spark.table(name).columns)) == row_set(spark.table(name))


def test_wide_table_is_bucketed_and_overwritten(spark, database, tmp_path):
    name = f"{database}.wide"
    names = [{"product_name": f"n{i % 20}", "units": str(i)} for i in range(200)]
    src.write_wide_table(cleaned(spark, *names), name)
    src.write_wide_table(cleaned(spark, *names[:100], as_of="2025-01-01"), name)
    assert spark.table(name).count() == 100
    described = {r.col_name: r.data_type for r in src.describe_table(spark, name).collect()}
    assert described["Num Buckets"] == "8"
    assert described["Bucket Columns"] == described["Sort Columns"] == "[`product_name`]"
    # One bucket is written by one task, so there are no more files than buckets.
    assert len(glob.glob(f"{tmp_path}/db/wide/**/*.orc", recursive=True)) <= 8


def test_wide_table_buckets_serve_lookups_and_joins(spark, database, conf):
    name = f"{database}.wide"
    rows = [{"product_name": f"n{i % 20}", "units": str(i)} for i in range(200)]
    src.write_wide_table(cleaned(spark, *rows), name)
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    wide = spark.table(name)
    join = wide.join(wide.groupBy("product_name").count(), "product_name")
    plan = join._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert join.count() == 200
    lookup = wide.filter("product_name = 'n3'")
    assert lookup.count() == 10


def test_plain_append_doubles_and_load_does_not(spark, database):
    customers = op.customer_dim(cleaned(spark, {}, {"customer_id": "c2"}, {"customer_id": None}))
    for _ in range(2):
        src.append_dim(customers, f"{database}.plain")
        src.load_dim(customers, f"{database}.loaded")
    assert spark.table(f"{database}.plain").count() == 6
    assert row_set(spark.table(f"{database}.loaded")) == row_set(customers)


def test_load_dim_adds_new_rows_and_unmatched_null_keys_once(spark, database):
    name = f"{database}.loc"
    short = {"shipping_address": "1 Main St/Cairo"}
    src.load_dim(op.location_dim(cleaned(spark, {}, short)), name)
    src.load_dim(op.location_dim(cleaned(spark, {}, short, {"is_online": "no"})), name)
    assert spark.table(name).count() == 3


def test_csv_dump_mode(spark, tmp_path):
    report = spark.createDataFrame([("a", 1.5), ("b", None)], "name string, v double")
    path = str(tmp_path / "2024-02-03")
    src.dump_csv(report, path)
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        src.dump_csv(report, path)
    src.dump_csv(report.repartition(5), path, "overwrite", files=1)
    assert len(glob.glob(f"{path}/*.csv")) == 1
    assert row_set(spark.read.option("header", True).csv(path)) == ["('a', '1.5')", "('b', None)"]


def test_small_report_is_one_file(spark, tmp_path):
    report = spark.range(1000).selectExpr("id % 10 as k").groupBy("k").count()
    src.dump_csv(report, str(tmp_path / "out"))
    assert len(glob.glob(f"{tmp_path}/out/*.csv")) == 1


def test_databases(spark, database):
    src.ensure_database(spark, database)
    assert database in [r.namespace for r in src.list_databases(spark).collect()]


def test_describe_lists_partitions_and_provider(spark, database):
    src.append_fact(op.fact(cleaned(spark, {})), f"{database}.fact")
    rows = [tuple(r)[:2] for r in src.describe_table(spark, f"{database}.fact").collect()]
    assert ("units", "int") in rows and ("Provider", "orc") in rows
    assert rows.count(("Extraction_Year", "int")) == 2


class Settings:
    """Stands in for a session whose settings cannot be changed once it runs."""

    def __init__(self, **settings):
        self.conf = {k.replace("_", "."): v for k, v in settings.items()}


def test_scratch_dir_is_below_the_shared_folder():
    cluster = Settings(spark_checkpoint_dir="hdfs://shared/cp/", spark_master="yarn")
    one, two = src.scratch_dir(cluster), src.scratch_dir(cluster)
    assert one.startswith("hdfs://shared/cp/retailflow-") and one != two


def test_scratch_dir_is_never_one_machine_of_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        src.scratch_dir(Settings(spark_master="yarn"))
    assert src.scratch_dir(Settings(spark_master="local[4]"))
