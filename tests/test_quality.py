import random

from pyspark.sql import functions as F

from retailflow import operators as op
from retailflow.operators.quality import row_digest
from rows import row_set


def frame(spark, rows, schema="a string, b int"):
    return spark.createDataFrame(rows, schema)


def test_null_profile_counts_each_column_in_order(spark):
    df = frame(spark, [("x", None), (None, None), ("y", 1)])
    assert [tuple(r) for r in op.null_profile(df).collect()] == [("a", 1), ("b", 2)]


def test_null_profile_of_nothing(spark):
    assert [tuple(r) for r in op.null_profile(frame(spark, [])).collect()] == [("a", 0), ("b", 0)]


def test_null_profile_takes_any_column_name(spark):
    df = spark.createDataFrame([(1, None)], "`a.b` int, `c d` int")
    assert [tuple(r) for r in op.null_profile(df).collect()] == [("a.b", 0), ("c d", 1)]


def test_duplicates_match_nulls(spark):
    df = frame(spark, [("x", None)] * 3 + [("y", 1)] * 2 + [("z", 1)])
    assert row_set(op.duplicate_groups(df)) == ["('x', None, 3)", "('y', 1, 2)"]
    assert op.duplicate_count(df).first().total_duplicates == 3


def test_no_duplicates_count_as_zero(spark):
    assert op.duplicate_count(frame(spark, [("x", 1)])).first().total_duplicates == 0
    assert op.duplicate_count(frame(spark, [])).first().total_duplicates == 0


def test_duplicate_count_is_what_dedup_removes(spark):
    pick = random.Random(5)
    rows = [(pick.choice("abc") if pick.random() > 0.2 else None, pick.randrange(9))
            for _ in range(500)] + [("hot", 0)] * 400
    df = frame(spark, rows).repartition(7)
    surplus = op.duplicate_count(df).first().total_duplicates
    assert op.dedup_exact(df).count() + surplus == len(rows)
    assert op.dedup_exact(df).count() == len(set(rows))


def test_a_collision_of_digests_changes_nothing(spark):
    df = frame(spark, [("x", None)] * 3 + [(None, 1)] * 2 + [("y", 1), ("z", 1)])
    groups = ["('x', None, 3)", "(None, 1, 2)"]
    assert row_set(op.duplicate_groups(df)) == groups
    assert row_set(op.duplicate_groups(df, lambda columns: [F.lit(1), F.lit(2)])) == groups


def test_a_null_hashes_by_its_column(spark):
    df = frame(spark, [("x", None), (None, "x")], "a string, b string").select(*row_digest(["a", "b"]))
    assert df.distinct().count() == 2


def test_only_digests_of_all_rows_are_shuffled(spark):
    df = spark.range(2000).selectExpr("id", "repeat(cast(id % 1900 as string), 50) as text").drop("id")
    groups = op.duplicate_groups(df)
    assert groups.count() == 100
    plan = groups._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert "hashpartitioning(_first" in plan and "BroadcastHashJoin" in plan


def test_rows_without_copies_stay_where_they_are(spark):
    rows = spark.range(0, 700, 1, 7).selectExpr("id", "repeat(cast(id as string), 50) as text")
    kept = op.dedup_exact(rows.union(rows.where("id % 100 = 3")))
    at = kept.select("id", F.spark_partition_id().alias("at")).where("id % 100 <> 3 and at <> id div 100")
    assert kept.count() == 700
    assert at.count() == 0


def test_a_shared_digest_drops_no_row(spark):
    df = frame(spark, [("x", None)] * 3 + [(None, 1)] * 2 + [("y", 1), ("z", 1), (None, None)])
    rows = ["('x', None)", "('y', 1)", "('z', 1)", "(None, 1)", "(None, None)"]
    for number in (-1, 0, 7, 1 << 40):
        assert row_set(op.dedup_exact(df, lambda row: F.lit(number).cast("long"))) == rows
    assert row_set(op.dedup_exact(df, lambda row: F.shiftleft(F.xxhash64(row), 6))) == rows


def test_copies_are_found_whatever_their_digest(spark):
    """Digests that take every bit of a word, and words of several bitmaps."""
    df = spark.range(300).selectExpr("id * 999 + id % 64 as id").union(spark.range(300).selectExpr("id * 999 + id % 64 as id"))
    assert row_set(op.dedup_exact(df, lambda row: F.col("_row.id"))) == row_set(df.distinct())
    assert row_set(op.dedup_exact(df, lambda row: -F.col("_row.id") * 65537)) == row_set(df.distinct())


def test_dedup_by_key_does_not_depend_on_the_partitions(spark):
    rows = [(k, v) for k in "abcde" for v in (5, 3, 9)] + [("hot", v) for v in range(300, 0, -1)]
    expected = ["('a', 3)", "('b', 3)", "('c', 3)", "('d', 3)", "('e', 3)", "('hot', 1)"]
    for n in (1, 3, 8):
        df = frame(spark, rows).repartition(n)
        assert row_set(op.dedup_by_key(df, ["a"], ["b"])) == expected
        assert row_set(op.dedup_by_key(df, ["a"])) == expected


def test_dedup_by_key_breaks_ties_with_the_other_columns(spark):
    df = frame(spark, [("k", 1, "z"), ("k", 1, "y"), ("k", 2, "a")], "a string, b int, c string")
    assert row_set(op.dedup_by_key(df, ["a"], ["b"])) == ["('k', 1, 'y')"]


def test_dedup_by_key_over_all_columns(spark):
    df = frame(spark, [("k", 1)] * 3)
    assert row_set(op.dedup_by_key(df, ["a", "b"])) == ["('k', 1)"]


def test_distinct_count_includes_null(spark):
    row = op.distinct_count(frame(spark, [("x", 1), ("x", None), ("y", 2)]), "a", "b").first()
    assert (row.distinct_a, row.distinct_b) == (2, 3)
    assert op.distinct_count(frame(spark, []), "a").first().distinct_a == 0


def test_group_counts(spark):
    df = frame(spark, [("x", 1), ("x", 2), (None, 3)])
    assert row_set(op.group_counts(df, ["a"])) == ["('x', 2)", "(None, 1)"]


def test_partition_sizes_count_the_empty_ones(spark):
    sizes = op.partition_sizes(frame(spark, [("x", i) for i in range(7)]).repartition(50, "a"))
    assert sizes.count() == 50 and sorted(r.rows for r in sizes.collect())[-2:] == [0, 7]


def test_partition_profile(spark):
    df = frame(spark, [(c, i) for c in "xyz" for i in range(10)]).repartition(3, "a")
    by_partition = {}
    for r in df.withColumn("p", F.spark_partition_id()).collect():
        by_partition.setdefault(r.p, []).append(r.a)
    sizes = {r.partition_id: r.rows for r in op.partition_sizes(df).collect()}
    assert sizes == {p: len(by_partition.get(p, [])) for p in range(3)}
    values = {(r.partition_id, r.value): r.rows for r in op.partition_profile(df, "a").collect()}
    assert values == {(p, x): v.count(x) for p, v in by_partition.items() for x in set(v)}
