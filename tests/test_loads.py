"""Landing reads that do not grow with files, pruned reads, whole runs, restarts and new-only compaction."""

import csv
import os
import threading
import time
import uuid

import pytest
from pyspark.sql import functions as F

from retailflow import fixtures as fx
from retailflow import operators as op
from retailflow import plans
from retailflow import sources as src
from retailflow import streaming as st
from retailflow import workload
from retailflow.sources import landing
from retailflow.sources.warehouse import FREE_SHUFFLES, _freeing
from test_scale import SF_DIR, plan_of


class Jobs:
    """Numbers of the jobs that a block of code starts."""

    def __init__(self, spark):
        self.sc = spark.sparkContext

    def __enter__(self):
        self.group = f"jobs-{uuid.uuid4()}"
        self.sc.setJobGroup(self.group, "counted")
        return self

    def __exit__(self, *_):
        self.sc._jsc.clearJobGroup()

    @property
    def count(self):
        return len(self.sc.statusTracker().getJobIdsForGroup(self.group))


def _land(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", newline="") as f:
        csv.writer(f).writerows(rows)


def test_jobs_do_not_grow_with_landing_files(spark, tmp_path):
    counts = {}
    for files in (3, 2000):
        base = f"{tmp_path}/{files}"
        for i in range(files):
            header = ["a", "b"] if i % 3 else ["b", "a"]
            _land(f"{base}/date(2024-02-03)", f"sales_transactions_SS_raw_{i}_09.csv", [header, [f"{h}{i}" for h in header]])
        open(f"{base}/date(2024-02-03)/sales_transactions_SS_raw_x_09.csv", "w").close()
        with Jobs(spark) as jobs:
            df = src.read_landing(spark, base, "sales_transactions", "2024-02-03", 9)
            assert df.count() == files
            counts[files] = jobs.count
        if files == 3:
            assert {(r.a, r.b) for r in df.collect()} == {(f"a{i}", f"b{i}") for i in range(files)}
    # Beyond 32 files Spark lists folders in a job of its own, once per read.
    assert counts[2000] <= counts[3] + 8


def test_a_header_is_the_first_line_with_text(spark, tmp_path):
    day = f"{tmp_path}/date(2024-02-03)"
    _land(day, "sales_agents_1_01.csv", [["name", "id"], ["x", "1"]])
    with open(f"{day}/sales_agents_2_01.csv", "w", newline="") as f:
        f.write('\r\n"id","name"\r\n2,"y, z"\r\n')
    rows = src.read_landing(spark, str(tmp_path), "sales_agents", "2024-02-03").collect()
    assert {(r.id, r.name) for r in rows} == {("1", "x"), ("2", "y, z")}
    assert [len(files) for _, files in landing._headers(spark, day)] == [1, 1]


def test_inventory_of_a_day_without_a_folder(spark, tmp_path):
    rows = src.landing_inventory(spark, str(tmp_path), "branches", "2024-02-03", [1, "02", 1]).collect()
    assert {(r.hour, r.state, r.files, r.bytes) for r in rows} == {("01", "absent", 0, 0), ("02", "absent", 0, 0)}


# ---- partitions ----


def test_partition_sizes_start_no_job_and_make_one_pass(spark):
    df = spark.range(0, 1000, 1, 7).repartition(13, "id")
    with Jobs(spark) as jobs:
        sizes = op.partition_sizes(df)
        assert jobs.count == 0
        rows = {r.partition_id: r.rows for r in sizes.collect()}
        assert jobs.count <= 2  # adaptive execution runs the shuffle as a job of its own
    expected = {r.p: r.n for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()}
    assert rows == {i: expected.get(i, 0) for i in range(13)}
    assert plan_of(sizes).split("== Initial Plan ==")[-1].count("Exchange") == 1


# ---- stored tables ----


def _rows_scanned(df):
    """Rows that the scans of a plan that has run gave out, before any filter."""
    df._jdf.queryExecution().toRdd().count()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def _files_read(df):
    return df.select("_metadata.file_path").distinct().count()


def test_a_run_and_a_product_read_their_own_files_only(spark, database):
    cleaned = op.clean_sales(fx.raw_sales(spark, SF_DIR), fx.AS_OF)
    name = f"{database}.wide"
    for hour in (8, 9, 10):
        src.load_wide_run(cleaned, name, fx.AS_OF, hour)
    run = src.read_run(spark, name, fx.AS_OF, 9)
    assert "PartitionFilters: [isnotnull(Extraction_Year" in plan_of(run)
    assert _files_read(run) * 3 == _files_read(spark.table(name)) and run.count() * 3 == spark.table(name).count()
    product = spark.table(name).agg(F.max("product_name")).first()[0]
    history = src.product_history(spark, name, product)
    rows = history.collect()
    assert _rows_scanned(history) * 2 < spark.table(name).count()
    assert len(rows) == spark.table(name).where(F.concat("product_name", F.lit("")) == product).count() > 0
    assert src.product_history(spark, name, "no such product").count() == 0


def _landed(spark, folder, hours):
    raw = fx.raw_sales(spark, SF_DIR)
    for h in hours:
        part = raw.where(F.crc32(F.col("transaction_id").cast("binary")) % 2 == h % 2)
        src.dump_csv(part, f"{folder}/date({fx.AS_OF})/sales_transactions_SS_raw_1_{h:02d}.csv")
    return folder


def test_readers_see_no_half_run(spark, database, tmp_path, monkeypatch):
    base = _landed(spark, f"{tmp_path}/landing", (8, 9))
    tables = plans.run_hourly(spark, base, database, fx.AS_OF, 8)
    before = src.committed(spark, tables.fact).count()
    reports = {n: sorted(map(str, r.collect())) for n, r in plans.hourly_reports(spark, tables).items()}

    def stop(*_):
        raise RuntimeError("stopped between the tables")

    for step in ("load_dim", "load_fact_run"):
        with monkeypatch.context() as m:
            m.setattr(plans.hourly.src, step, stop)
            with pytest.raises(RuntimeError):
                plans.run_hourly(spark, base, database, fx.AS_OF, 9)
        assert src.committed(spark, tables.fact).count() == before
        assert {n: sorted(map(str, r.collect())) for n, r in plans.hourly_reports(spark, tables).items()} == reports
    assert spark.table(tables.wide).count() > src.committed(spark, tables.wide).count()
    plans.run_hourly(spark, base, database, fx.AS_OF, 9)
    assert src.committed(spark, tables.fact).count() == spark.table(tables.fact).count() > before
    # An hour that is loaded again is out while it is loaded.
    src.open_run(spark, database, fx.AS_OF, 9)
    assert src.committed(spark, tables.fact).count() == before
    assert [(str(r[0]), r[1]) for r in src.committed_runs(spark, database).collect()] == [(fx.AS_OF, 8)]
    assert "dynamicpruning" in plan_of(src.committed(spark, tables.fact)).lower() or before


def test_tables_without_marks_are_read_in_full(spark, database):
    name = f"{database}.fact"
    src.append_fact(op.fact(op.clean_sales(fx.raw_sales(spark, SF_DIR), fx.AS_OF)), name)
    assert src.committed_runs(spark, database) is None
    assert src.committed(spark, name).count() == spark.table(name).count()


def test_two_loads_at_once_give_one_row_per_key(spark, database):
    name = f"{database}.product"
    src.load_dim(spark.createDataFrame([("0", "zero")], "product_id string, product_name string"), name, ["product_id"])
    both = threading.Barrier(2)

    def load(label):
        rows = spark.createDataFrame([("1", label), ("2", label)], "product_id string, product_name string")
        new = op.rows_not_in(rows, spark.table(name), ["product_id"])
        new = spark.createDataFrame(new.collect(), new.schema)
        both.wait()  # each has seen the table without the other's rows
        src.append_dim(new, name)

    threads = [threading.Thread(target=load, args=(x,)) for x in ("a", "b")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert spark.table(name).count() == 5
    rows = src.one_per_key(spark, name, ["product_id"]).collect()
    assert {(r.product_id, r.product_name) for r in rows} == {("0", "zero"), ("1", "a"), ("2", "a")}


# ---- stream ----


def _run(spark, folder):
    source = st.replay_source(spark, f"{folder}/topic")
    plans.run_event_stream(source, f"{folder}/events", f"{folder}/checkpoint", available_now=True).awaitTermination()


def test_a_repeated_batch_is_stored_once(spark, tmp_path):
    events = fx.raw_events(spark, SF_DIR)
    events.write.text(f"{tmp_path}/topic")
    with pytest.raises(Exception):
        st.forget_last_commit(spark, f"{tmp_path}/checkpoint")
    _run(spark, tmp_path)
    assert st.forget_last_commit(spark, f"{tmp_path}/checkpoint") == 0
    _run(spark, tmp_path)
    assert os.path.exists(f"{tmp_path}/checkpoint/commits/0")
    assert st.read_events(spark, f"{tmp_path}/events").count() == events.count()


def test_compaction_takes_new_files_only(spark, tmp_path, monkeypatch):
    events = fx.raw_events(spark, SF_DIR)
    for turn in range(3):
        events.write.mode("append").text(f"{tmp_path}/topic")
        _run(spark, tmp_path)
        read = src.compact_new(spark, f"{tmp_path}/events", f"{tmp_path}/compacted")
        assert 0 < read <= 8 and src.compact_new(spark, f"{tmp_path}/events", f"{tmp_path}/compacted") == 0
        assert src.read_compacted(spark, f"{tmp_path}/compacted").count() == (turn + 1) * events.count()
    events.write.mode("append").text(f"{tmp_path}/topic")
    _run(spark, tmp_path)
    # A run that stops before its folder is in place leaves its files to the next one.
    with monkeypatch.context() as m:
        m.setattr("retailflow.sources.compaction.ceil", lambda _: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            src.compact_new(spark, f"{tmp_path}/events", f"{tmp_path}/compacted")
    assert src.read_compacted(spark, f"{tmp_path}/compacted").count() == 3 * events.count()
    assert src.compact_new(spark, f"{tmp_path}/events", f"{tmp_path}/compacted") > 0
    assert src.read_compacted(spark, f"{tmp_path}/compacted").count() == 4 * events.count()


def test_an_hourly_load_reads_its_landing_once_for_the_wide_table(spark, database, tmp_path, monkeypatch):
    """Also one shuffle of the rows, behind which copies are gone: F1, F3."""
    base = _landed(spark, f"{tmp_path}/landing", (8,))
    loaded = []

    def load(df, *args, **more):
        loaded.append(plan_of(df))
        kept(df, *args, **more)

    kept = src.load_wide_run
    monkeypatch.setattr(plans.hourly.src, "load_wide_run", load)
    tables = plans.run_hourly(spark, base, database, fx.AS_OF, 8)
    assert loaded[0].count("FileScan csv") == 1 and loaded[0].count("Exchange") == 1
    cleaned = op.clean_sales(src.read_landing(spark, base, "sales_transactions", fx.AS_OF, 8), fx.AS_OF)
    assert sorted(map(str, spark.table(tables.wide).select(cleaned.columns).collect())) == sorted(map(str, cleaned.collect()))


def test_landed_hours_are_packed_and_bounded(spark, tmp_path, monkeypatch):
    """less to write; a packed file is read by one task, so it holds a bounded number of rows."""
    monkeypatch.setattr(workload, "LANDED_ROWS", 500, raising=False)
    workload._landed_hours(spark, SF_DIR, str(tmp_path))
    files = [f for _, _, names in os.walk(tmp_path) for f in names if f.startswith("part-")]
    assert files and all(f.endswith(".csv.gz") for f in files)
    sales = src.read_entity(spark, f"{tmp_path}/date({fx.AS_OF})", "sales_transactions", with_file=True)
    raw = fx.raw_sales(spark, SF_DIR)
    assert sales.groupBy("landing_file").count().agg(F.max("count")).first()[0] <= 500
    assert sorted(map(str, sales.select(raw.columns).collect())) == sorted(map(str, raw.collect()))


def test_committed_rows_are_not_shuffled_by_run(spark, database):
    """all rows of an hour came into one task."""
    rows = spark.range(100).selectExpr("id", "2000 as Extraction_Year", "6 as Extraction_Month")
    src.open_run(spark, database, fx.AS_OF, 8)
    for hour in (8, 9):
        src.load_fact_run(rows, f"{database}.fact", fx.AS_OF, hour)
    assert src.committed(spark, f"{database}.fact").count() == 0
    src.commit_run(spark, database, fx.AS_OF, 9)
    committed = src.committed(spark, f"{database}.fact")
    assert "BroadcastHashJoin" in plan_of(committed) and "Exchange hashpartitioning" not in plan_of(committed)
    assert committed.count() == 100 and {r[0] for r in committed.select("Extraction_Hour").distinct().collect()} == {9}


def _shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def _left(spark, before, seconds=20):
    """Shuffle files that came since and stay; Spark removes them a moment after the write."""
    until = time.time() + seconds
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.1)
    return left


def test_a_write_leaves_no_shuffle_files(spark, database, tmp_path):
    """the disk held the shuffles of all loads until the driver collected its garbage."""
    rows = spark.range(0, 1000, 1, 4).repartition(3, "id").selectExpr(
        "id", "concat('p', id) as product_name", "2000 as Extraction_Year", "6 as Extraction_Month"
    )
    setting, before = spark.conf.get(FREE_SHUFFLES), _shuffle_files(spark)
    kept = rows.groupBy("product_name").count()
    assert kept.count() == 1000 and _shuffle_files(spark) - before  # what the writes have to remove, they make
    before = _shuffle_files(spark)
    writes = {
        "wide": lambda: src.write_wide_table(rows, f"{database}.month"),
        "run": lambda: src.load_wide_run(rows, f"{database}.wide", fx.AS_OF, 8),
        "run again": lambda: src.load_wide_run(rows.where("id < 900"), f"{database}.wide", fx.AS_OF, 8),
        "fact": lambda: src.load_fact_run(rows, f"{database}.fact", fx.AS_OF, 8),
        "fact of another run": lambda: src.load_fact_run(rows, f"{database}.fact", fx.AS_OF, 9),
        "plain fact": lambda: src.append_fact(rows, f"{database}.facts"),
        "dimension": lambda: src.load_dim(rows, f"{database}.dim", ["id"]),
        "dimension again": lambda: src.load_dim(rows, f"{database}.dim", ["id"]),
        "dump": lambda: src.dump_csv(rows, f"{tmp_path}/dump"),
    }
    for name, write in writes.items():
        write()
        assert not _left(spark, before), name
    assert spark.conf.get(FREE_SHUFFLES) == setting and not _freeing
    sizes = {t: spark.table(f"{database}.{t}").count() for t in ("month", "wide", "fact", "facts", "dim")}
    assert sizes == {"month": 1000, "wide": 900, "fact": 2000, "facts": 1000, "dim": 1000}
    assert kept.count() == 1000 and len(kept.collect()) == len(kept.collect()) == 1000
    assert not [t.name for t in spark.catalog.listTables(database) if t.isTemporary]


def test_freeing_shuffles_ends_with_the_last_write_and_after_a_failure(spark, database, conf):
    conf(FREE_SHUFFLES, False)
    with src.warehouse.shuffles_freed(spark):
        with pytest.raises(Exception, match="line break"):
            src.append_dim(spark.range(1).select(F.raise_error(F.lit("a line break")).cast("string").alias("x")), f"{database}.t")
        assert spark.conf.get(FREE_SHUFFLES) == "true"
    assert spark.conf.get(FREE_SHUFFLES) == "false" and not _freeing
    # A run that can't be read leaves the rows loaded before.
    rows = spark.range(10).selectExpr("id", "2000 as Extraction_Year", "6 as Extraction_Month")
    src.load_fact_run(rows, f"{database}.fact", fx.AS_OF, 8)
    broken = rows.repartition(2, F.when(F.col("id") == 7, F.raise_error(F.lit("unreadable")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="unreadable"):
        src.load_fact_run(broken, f"{database}.fact", fx.AS_OF, 8)
    assert spark.table(f"{database}.fact").count() == 10
    assert spark.conf.get(FREE_SHUFFLES) == "false" and not _freeing
    src.load_fact_run(rows.limit(0), f"{database}.fact", fx.AS_OF, 8)
    assert spark.table(f"{database}.fact").count() == 0
