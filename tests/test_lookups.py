"""The three join plans give the same rows, and hot keys are spread over tasks."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from quayside.operators.lookups import hot_keys, lookup_join, salted_join


@pytest.fixture
def skewed(spark):
    """30,000 rows: a third hold key 7, a sixth are null, some are copies of one row."""
    n = F.col("id")
    key = F.when(n % 3 == 0, 7).when(n % 6 == 1, None).otherwise(n % 5000)
    return spark.range(0, 30_000, 1, 64).select(
        key.cast("long").alias("k"), F.when(n % 3 == 0, 0).otherwise(n).alias("n")
    )


@pytest.fixture
def table(spark):
    return spark.range(0, 4000).select(
        F.col("id").alias("k"), (F.col("id") * 2).alias("v")
    ).unionByName(spark.createDataFrame([(None, 1)], "k LONG, v LONG"))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_plans_agree(spark, skewed, table, how):
    expected = skewed.join(table, ["k"], how)
    salts = hot_keys(skewed, ["k"])
    assert salts
    for found in (
        lookup_join(skewed, table, "k", how),
        lookup_join(skewed, table, "k", how, salted=True),
        salted_join(skewed, table, ["k"], how, salts),
    ):
        assert found.columns == expected.columns
        assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()


def test_hot_keys_are_those_above_an_average_partition(spark, skewed):
    salts = hot_keys(skewed, ["k"], pieces=100)
    hashes = {row["k"]: row["h"] for row in skewed.select("k", F.xxhash64("k").alias("h")).distinct().collect()}
    assert set(salts) == {hashes[7], hashes[None]}
    assert 4 * 33 <= salts[hashes[7]] <= 4 * 35
    assert hot_keys(spark.range(1000), ["id"]) == {}
    assert hot_keys(spark.range(0), ["id"]) == {}


def test_salting_spreads_the_hot_key(spark, skewed, table):
    """Without salts one task gets every row of the hot key, copies included."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        salts = hot_keys(skewed, ["k"])

        def largest(joined):
            tasks = joined.groupBy(F.spark_partition_id()).count()
            return tasks.agg(F.max("count")).first()[0]

        plain = largest(skewed.join(table, ["k"], "left"))
        spread = largest(salted_join(skewed, table, ["k"], "left", salts))
        assert plain > 10_000
        assert spread < 7_500
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookup_rows_of_cold_keys_are_not_repeated(spark, skewed, table):
    salts = hot_keys(skewed, ["k"])
    plan = salted_join(skewed, table, ["k"], "left", salts)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def jobs(spark, plan):
    """Number of jobs that start while a query is planned."""
    group = f"planning-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        plan()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_lookup_starts_no_job_before_it_runs(spark, skewed, table):
    assert jobs(spark, lambda: lookup_join(skewed, table, "k")) == 0
    assert 1 <= jobs(spark, lambda: lookup_join(skewed, table, "k", salted=True)) <= 2


def test_salts_do_not_depend_on_row_order(spark, table):
    """A task that runs again on the same partition gives each row the same salt."""
    rows = spark.range(0, 10_000, 1, 4).select(F.lit(7).cast("long").alias("k"), F.col("id").alias("n"))
    salts = hot_keys(rows, ["k"])
    one = salted_join(rows, table, ["k"], "left", salts)
    two = salted_join(rows.sortWithinPartitions(F.desc("n")), table, ["k"], "left", salts)
    assert one.exceptAll(two).isEmpty()
    assert one.count() == 10_000


def test_manifest_with_maps_can_be_salted(spark, table):
    rows = spark.range(0, 5000, 1, 8).select(
        F.lit(7).cast("long").alias("k"), F.create_map(F.lit("a"), F.col("id").cast("string")).alias("m")
    )
    joined = salted_join(rows, table, ["k"], "left", hot_keys(rows, ["k"]))
    assert joined.where("v = 14").count() == 5000
