"""The physical plans have the shape that holds at scale."""

from __future__ import annotations

import os
import re

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from __spark_entry__ import queries
from lakeloom.operators import dims, incremental, numbering, scd2
from lakeloom.plans.flights import flight
from lakeloom.plans.medallion import SNAPSHOT_CHECKS

SMALL = "/root/testdata/sf0.001"

needs_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test data")


def initial(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@needs_data
@pytest.mark.parametrize("name", list(queries()))
def test_no_python_no_cross_join(spark, name):
    plan = initial(queries()[name](spark, SMALL))
    for word in ("Python", "Pandas", "Cartesian", "NestedLoop"):
        assert word not in plan, plan


@needs_data
def test_profile_reads_each_table_once(spark):
    plan = initial(dims.dim_aircraft_profile(flight(spark, SMALL)))
    assert len(re.findall(r"/lineitem\.parquet", plan)) == 1
    assert "Expand" in plan


@needs_data
def test_scans_are_pruned(spark):
    plan = initial(dims.home_airport(flight(spark, SMALL)))
    line_scan = [p for p in plan.split("FileScan") if "lineitem" in p][0]
    schema = re.search(r"ReadSchema: struct<([^>]*)>", line_scan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"l_orderkey", "l_partkey", "l_suppkey"}


@needs_data
def test_facts_are_never_broadcast(spark):
    plan = initial(flight(spark, SMALL))
    assert "SortMergeJoin [l_orderkey" in plan


def test_hot_keys_are_split_in_an_insert(spark, no_broadcast):
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    source = spark.range(90000).select(hot.alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
    target = spark.range(0, 60000, 2).select(
        F.when(F.col("id") % 3 == 0, F.lit("other")).otherwise(F.col("id").cast("string")).alias("k")
    )
    new = incremental.new_rows(target, source, "k")
    plan = plan_of(new)
    assert "SortMergeJoin(skew=true)" in plan
    # Copies of a key in the target collapse before they are shuffled.
    assert plan.count("HashAggregate") >= 2
    known = {r.k for r in target.collect()}
    assert new.count() == sum(r.k not in known for r in source.select("k").collect())


def test_snapshot_shuffles_each_side_once(spark, no_broadcast):
    source = spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    current = scd2.apply_snapshot(None, source, "k", ["v"], "2020-01-01 00:00:00")
    state = spark.createDataFrame(current.collect(), current.schema)
    plan = initial(scd2.advance(state, source, "k", ["v"], "2020-01-02 00:00:00"))
    assert plan.count("Exchange hashpartitioning") == 2
    assert "WindowGroupLimit" in plan


def test_snapshot_leaves_bucketed_versions_where_they_lie(spark, no_broadcast, tmp_path):
    source = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    first = scd2.advance(None, source, "k", ["v"], "2020-01-01 00:00:00")
    scd2.store_open(first, "bucketed_versions", str(tmp_path / "open"), "k", 6)
    present = spark.table("bucketed_versions")
    later = source.withColumn("v", (F.col("k") % 2).cast("int"))
    advanced = scd2.advance(present, later, "k", ["v"], "2020-01-02 00:00:00", buckets=6)
    plan = initial(advanced)
    # One exchange, of the source, and none above the scan of the open versions.
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    above = [line for line in plan.split("\n") if "bucketed_versions" in line or "Exchange" in line]
    assert "Exchange" in above[-1] and "bucketed_versions" in above[0]
    assert rows(advanced) == rows(scd2.advance(first, later, "k", ["v"], "2020-01-02 00:00:00"))
    spark.sql("drop table bucketed_versions")


@needs_data
def test_deep_nth_row_sorts_one_range_only(spark):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    plan = plan_of(numbering.nth_row(orders, ["o_totalprice", "o_orderkey"], 1200))
    assert "rangepartitioning" not in plan and "TakeOrderedAndProject" in plan


def test_snapshot_of_profiles_adds_no_shuffle_for_the_source(spark, no_broadcast):
    data = [("1", "m", "A", "B", 1, 10, 1.0, 2.0, 3)]
    flights = spark.createDataFrame(
        data,
        "aircraft_id string, airplane_model string, origin_airport string, "
        "destination_airport string, flight_cost int, distance int, fuel_consumed_litre float, "
        "avg_flight_speed_kmps double, engine_performance int",
    )
    count = "Exchange hashpartitioning"
    for one_pass, shuffles in ((True, 2), (False, 4)):
        profile = dims.dim_aircraft_profile(flights, one_pass=one_pass)
        snapshot = scd2.apply_snapshot(
            None, profile, "aircraft_id", SNAPSHOT_CHECKS, "2020-01-01 00:00:00"
        )
        assert initial(snapshot).count(count) == initial(profile).count(count) == shuffles


def test_nth_row_keeps_n_rows_per_task(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("g"))
    assert "TakeOrderedAndProject" in initial(numbering.nth_row(df, "id", 4))
    assert "WindowGroupLimit" in initial(numbering.nth_row(df, "id", 4, ["g"]))


def test_dense_id_has_no_single_task_sort(spark):
    df = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("name"))
    plan = initial(numbering.dense_id(df, "name"))
    # The one window without a partition runs over the row counts of the partitions.
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 1 and "_rows" in windows[0]
    assert "BroadcastHashJoin" in plan
    assert len(rows(numbering.dense_id(df, "name"))) == 1000
