"""What the plans must look like to hold on large and skewed data."""

import re

import pytest
from pyspark.sql import functions as F

from retailflow import fixtures as fx
from retailflow import operators as op
from retailflow import sources as src
from retailflow.workload import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def joined_frames(spark):
    sales = op.clean_sales(fx.raw_sales(spark, SF_DIR), fx.AS_OF)
    return sales, op.agent_dim(fx.raw_agents(spark, SF_DIR))


LAZY = sorted(
    n for n in QUERIES
    if not re.search(r"roundtrip|scan|landing|compact|describe|incremental|stored|two_hours|history|committed|partition_sizes", n)
)


@pytest.mark.parametrize("name", LAZY)
def test_no_query_pairs_all_rows_or_leaves_the_jvm(spark, conf, name):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|Pandas|BroadcastHash", plan)
    assert "Exchange SinglePartition" not in plan or name in {
        # One row of totals, from partial totals of every task.
        "null_profile", "row_count", "duplicate_count", "distinct_extraction_periods",
    }


def test_copies_are_combined_before_the_shuffle(spark):
    plan = plan_of(op.clean_sales(fx.raw_sales(spark, SF_DIR), fx.AS_OF))
    assert re.search(r"HashAggregate[^\n]*\n[^\n]*Exchange[^\n]*\n[^\n]*HashAggregate", plan)
    assert "SortAggregate" not in plan


def test_rows_of_a_key_are_limited_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as v")
    plan = plan_of(op.dedup_by_key(df, ["k"], ["v"]))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_sales_of_one_agent_go_to_several_tasks(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.shuffle.partitions", "16")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "16KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    # Skewed input comes in several map outputs, which is what a split can tell apart.
    sales = spark.range(0, 60000, 1, 12).select(
        F.sha2(F.col("id").cast("string"), 256).alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("a"), F.col("id") % 300))
        .alias("sales_agent_id"),
    )
    agents = spark.createDataFrame(
        [("hot", "n")] + [(f"a{i}", "n") for i in range(300)], "sales_person_id string, name string"
    )
    joined = op.join_agents(sales, agents)
    assert joined.count() == 60000
    is_hot = (F.col("sales_agent_id") == "hot").cast("int")
    tasks = joined.select(F.spark_partition_id().alias("task"), is_hot.alias("hot"), "transaction_id")
    sums = tasks.groupBy("task").agg(F.sum("hot").alias("n"), F.max("transaction_id"))
    sizes = [r.n for r in sums.collect() if r.n]
    assert sum(sizes) == 20000
    assert len(sizes) > 3 and max(sizes) < 10000


def test_few_agents_are_broadcast_as_they_are(spark):
    plan = plan_of(op.join_agents(*joined_frames(spark)))
    assert "BroadcastHashJoin" in plan and "Generate" not in plan


@pytest.mark.parametrize("report, key", [
    (lambda f, p: op.top_products(f, p), "product_id"),
    (lambda f, p: op.best_offer_per_product(f, p), "product_id"),
])
def test_facts_are_summed_before_they_meet_a_dimension(spark, conf, report, key):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    fact = spark.range(100).selectExpr(
        "cast(id % 5 as string) product_id", "cast(id % 5 as int) offer", "1 as units"
    )
    product = spark.range(5).selectExpr(
        "cast(id as string) product_id", "cast(id as string) product_name"
    )
    plan = plan_of(report(fact, product))
    assert re.search(rf"partial_(sum|count)[^\n]*output=\[{key}", plan[plan.index("SortMerge"):])


def test_filters_and_columns_reach_the_orc_scan(spark, database):
    name = f"{database}.fact"
    src.append_fact(op.fact(op.clean_sales(fx.raw_sales(spark, SF_DIR), fx.AS_OF)), name)
    fact = spark.table(name)
    on_day = plan_of(op.sold_on(fact, fx.AS_OF))
    assert "EqualTo(transaction_date,1998-12-30)" in on_day
    since = plan_of(op.sold_since(fact, fx.AS_OF))
    assert "GreaterThanOrEqual(transaction_date,1998-12-30)" in since
    offers = plan_of(op.offer_redemptions(fact))
    assert "PushedFilters: [IsNotNull(offer)]" in offers
    assert "ReadSchema: struct<offer:int>" in offers
    assert "TakeOrderedAndProject" in offers
    month = plan_of(fact.filter("Extraction_Year = 2000 and Extraction_Month = 6"))
    assert "PartitionFilters: [isnotnull(Extraction_Year" in month


def test_dimensions_read_only_their_columns(spark, database):
    name = f"{database}.wide"
    src.write_wide_table(op.clean_sales(fx.raw_sales(spark, SF_DIR), fx.AS_OF), name)
    wide = spark.table(name)
    assert "ReadSchema: struct<transaction_date:date>" in plan_of(op.date_dim(wide))
    assert "ReadSchema: struct<city:string,state:string,postal_code:string>" in plan_of(
        op.location_dim(wide)
    )


def test_hot_bucket_is_split_over_tasks(spark, conf, database):
    """A third of the rows has one product name, so one bucket holds a third of them."""
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    conf("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16KB")
    n = 60000
    rows = spark.range(0, n, 1, 12).select(
        F.sha2(F.col("id").cast("string"), 256).alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("n"), F.col("id") % 97))
        .alias("product_name"),
        F.lit(2024).alias("Extraction_Year"),
        F.lit(2).alias("Extraction_Month"),
    )
    name = f"{database}.wide"
    src.write_wide_table(rows, name)
    written = spark.table(name)
    files = written.filter("product_name = 'hot'").groupBy("_metadata.file_path").count()
    sizes = [r[1] for r in files.collect()]
    assert written.count() == n and sum(sizes) == n // 3
    assert len(sizes) > 4 and max(sizes) < n // 6


@pytest.fixture
def dimension_and_load(spark, tmp_path):
    rows = spark.range(5000).selectExpr("cast(id as string) id", "id % 7 as v")
    rows.write.parquet(f"{tmp_path}/dim")
    rows.filter("id < 10").write.parquet(f"{tmp_path}/load")
    return spark.read.parquet(f"{tmp_path}/dim"), spark.read.parquet(f"{tmp_path}/load")


def test_small_load_shuffles_no_row_of_the_dimension(dimension_and_load):
    dimension, load = dimension_and_load
    plan = plan_of(op.rows_not_in(load, dimension))
    assert re.search(r"BroadcastHashJoin[^\n]*LeftSemi", plan)
    # Both come from making the load distinct.
    assert plan.count("Exchange hashpartitioning") == 2


def test_large_load_is_made_distinct_before_it_is_joined(dimension_and_load, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    dimension, load = dimension_and_load
    plan = plan_of(op.rows_not_in(load, dimension))
    first_scan = plan[plan.index("LeftAnti"):plan.index("FileScan")]
    assert first_scan.count("HashAggregate") == 2


def test_shuffles_begin_with_partitions_by_the_size_of_the_tables(spark, conf, monkeypatch):
    """F4 to F7, F16 to F19: with a fixed number the sorts and maps of a task grow with the tables."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    for piece in (20_000, 10_000):
        monkeypatch.setattr(fx, "SHUFFLE_PIECE", piece, raising=False)
        plan = plan_of(QUERIES["dedup_exact"](spark, SF_DIR))
        dealt = {int(n) for n in re.findall(r"hashpartitioning\(l_orderkey#\d+L?, (\d+)\)", plan)}
        assert min(dealt) >= 100_000 // piece > 4, dealt
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")


@pytest.mark.parametrize("name", [
    "wide_run_scan", "orc_partition_scan", "bucketed_table_roundtrip", "product_history", "describe_sections",
])
def test_a_stored_wide_table_shuffles_its_rows_for_the_joins_only(spark, monkeypatch, name):
    """bringing whole rows together by bucket was more than half of the shuffled bytes."""
    gathered = []
    monkeypatch.setattr(src.warehouse, "_by_bucket", lambda df, *_: gathered.append(name) or df)
    assert QUERIES[name](spark, SF_DIR).count() > 0
    assert not gathered


def test_each_run_of_the_wide_table_cleans_its_own_rows(spark, monkeypatch):
    """both loads counted the copies of all sales, so the joins ran whole for each of them."""
    loads, clean = [], op.clean_sales
    monkeypatch.setattr(op, "clean_sales", lambda df, *a: loads.append(df) or clean(df, *a))
    run = QUERIES["wide_run_scan"](spark, SF_DIR)
    counts = [df.count() for df in loads]
    assert len(counts) == 2 and sum(counts) == fx.raw_sales(spark, SF_DIR).count()
    expected = clean(fx.raw_sales(spark, SF_DIR), fx.AS_OF).filter("is_online <> 'yes'")
    kept = run.drop("Extraction_Hour").select(*expected.columns)
    assert kept.count() == expected.count()
    assert kept.exceptAll(expected).isEmpty()


def test_a_task_reads_a_bounded_piece_of_a_shuffle(spark, conf, monkeypatch):
    """a task sorted and wrote what 64 MB of packed rows hold; pieces now have a bound of their own."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1KB")
    monkeypatch.setattr(fx, "SHUFFLE_PIECE", 10_000)
    tasks = []
    for piece in (100_000, 20_000):
        monkeypatch.setattr(fx, "TASK_PIECE", piece, raising=False)
        tasks.append(QUERIES["dedup_exact"](spark, SF_DIR).rdd.getNumPartitions())
    assert tasks[1] > tasks[0] > 1
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
